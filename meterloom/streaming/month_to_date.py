"""Running month totals and projected bill over a stream of consumption records.

The batch chain recomputes a month from its days; here the same sums are kept up to date as records arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.functions.billing import Tariff, add_bill
from meterloom.functions.calendar import month_start
from meterloom.functions.numeric import outside


def daily_totals(records: DataFrame, late: str = "40 days") -> DataFrame:
    """Stream of (meter_id, ts, offpeak_kwh, onpeak_kwh) -> one row per meter and day.

    State holds one row per meter and open day; the watermark drops days older than ``late``.
    """
    day = F.window("ts", "1 day")
    return (
        records.withWatermark("ts", late)
        .groupBy("meter_id", day)
        .agg(F.sum("offpeak_kwh").alias("offpeak_kwh"), F.sum("onpeak_kwh").alias("onpeak_kwh"))
        .select("meter_id", F.to_date("window.start").alias("date"), "offpeak_kwh", "onpeak_kwh")
        .withColumn("total_kwh", F.col("offpeak_kwh") + F.col("onpeak_kwh"))
    )


def run_daily_totals(records: DataFrame, out: str, checkpoint: str, late: str = "40 days", change=lambda days: days) -> None:
    """Process what is available and stop. Each micro-batch writes the days it changed under its own number.

    A batch replayed after a failure overwrites its own folder, so the result holds every change once. ``change`` is
    applied to the stream of days, for example ``flag_unusual_days`` with known limits.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (
        change(daily_totals(records, late))
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()


def current_days(spark: SparkSession, out: str) -> DataFrame:
    """Latest state of every meter and day from the change folders."""
    changes = spark.read.parquet(out)
    state = [c for c in changes.columns if c not in ("meter_id", "date", "batch")]
    latest = F.max_by(F.struct(*state), "batch").alias("s")
    return changes.groupBy("meter_id", "date").agg(latest).select("meter_id", "date", "s.*")


def month_to_date(days: DataFrame, tariff: Tariff = Tariff()) -> DataFrame:
    """Consumption and bill of each month so far, priced over the days seen."""
    sums = days.groupBy("meter_id", month_start(F.col("date")).alias("month_start")).agg(
        F.count(F.lit(1)).alias("days_elapsed"),
        F.sum("offpeak_kwh").alias("cum_offpeak_kwh"),
        F.sum("onpeak_kwh").alias("cum_onpeak_kwh"),
    )
    return add_bill(sums, "projected_bill", "cum_offpeak_kwh", "cum_onpeak_kwh", "days_elapsed", tariff)


def flag_unusual_days(days: DataFrame, limits: DataFrame) -> DataFrame:
    """Days outside the meter's known fences (``low``, ``high``); a stream-static join when ``days`` is a stream."""
    known = limits.select("meter_id", "low", "high")
    return days.join(known, "meter_id", "left").withColumn(
        "is_unusual", F.coalesce(outside(F.col("total_kwh"), F.col("low"), F.col("high")), F.lit(False))
    )
