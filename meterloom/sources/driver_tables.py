"""Adapter: gives the driver's star-schema tables the shape of meter readings, weather and predictions.

Suppliers act as meters, ship dates as reading dates, order dates as weather days, orders as samples.
Every adapter reads its whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out over all cores when a file gives fewer splits than there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Rows that one task should order: the windows of a chain hold about half a kilobyte a row beyond what they take at least.
ROWS_PER_TASK = 200_000


def tasks_for(source: DataFrame) -> int:
    """As many tasks as the rows of a table ask for, whatever the session's number of shuffle partitions."""
    return max(source.sparkSession.sparkContext.defaultParallelism, -(-source.count() // ROWS_PER_TASK))


def readings(spark: SparkSession, sf_dir: str, meter: Column | None = None) -> DataFrame:
    """Cumulative registers that wrap at 2000, with nulls and duplicate dates.

    Quantities are whole numbers, so the running sums are exact in any order. The window runs over one row per
    meter and day, so its groups are bounded by the calendar however many line items a supplier has.

    Meters are dealt out over a number of tasks that grows with the line items, and lie so for all that is done per meter
    after it. Line items are dealt out by meter and date before they are combined: a task that reads them would hold a group for
    almost every row of its part of the file, and those parts grow with the table.
    """
    meter = F.col("l_suppkey") if meter is None else meter
    items = table(spark, sf_dir, "lineitem")
    tasks = tasks_for(items)
    qty = lambda flag: F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_quantity")).otherwise(0.0))
    lines = items.select(meter.cast("bigint").alias("meter_id"), F.to_date("l_shipdate").alias("read_date"),
                         "l_returnflag", "l_quantity")
    daily = (
        lines.repartition(tasks, "meter_id", "read_date").groupBy("meter_id", "read_date")
        .agg(qty("R").alias("offpeak"), qty("A").alias("peak"), qty("N").alias("shoulder"))
        .repartition(tasks, "meter_id")
    )
    so_far = W.partitionBy("meter_id").orderBy("read_date").rowsBetween(W.unboundedPreceding, 0)
    register = lambda c: F.sum(c).over(so_far) % 2000
    key = F.dayofyear("read_date") + F.col("meter_id")
    duplicated = (key % 41 == 0) & (F.col("meter_id") % 3 != 0)
    return (
        daily.select("meter_id", "read_date", register("offpeak").alias("reg_offpeak"),
                     register("peak").alias("reg_peak"), register("shoulder").alias("reg_shoulder"))
        .withColumn("copy", F.explode(F.when(duplicated, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .withColumn("reg_peak", F.when((F.col("copy") == 1) | (key % 37 != 0), F.col("reg_peak")))
        .drop("copy")
    )


def readings_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight meters only, so that many months are complete."""
    return readings(spark, sf_dir, F.col("l_suppkey") % 8)


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """meter -> weather station."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("meter_id"), (F.col("s_suppkey") % 5).alias("station_id")
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    return (
        table(spark, sf_dir, "orders")
        .groupBy((F.col("o_custkey") % 5).alias("station_id"), d.alias("date"))
        .agg(
            (10 + F.max("o_totalprice") / 25000).alias("tmax"),
            (5 + F.min("o_totalprice") / 50000).alias("tmin"),
            F.count(F.lit(1)).alias("n"),
        )
        .select(
            "station_id",
            "date",
            "tmax",
            "tmin",
            F.when(F.dayofmonth("date") % 10 != 0, (50 + 3 * F.col("n")).cast("double")).alias("humidity"),
            F.when(F.month("date").isin(6, 7, 8), 0.0).otherwise((F.col("n") - 1).cast("double")).alias("rain"),
            (F.col("tmax") / 4).alias("uv"),
        )
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four fixed formulas stand in for fitted models; one long table."""
    y = F.col("o_totalprice")
    guesses = {
        "linear_baseline": 200000.0 + (F.col("o_custkey") % 100) * 1000.0,
        "ridge": y * 0.9 + 20000.0,
        "random_forest": y + ((F.col("o_orderkey") % 21) - 10) * 1500.0,
        "polynomial_deg2": y * 1.02 - 1500.0,
    }
    rows = F.array(*[F.struct(F.lit(m).alias("model"), v.alias("yhat")) for m, v in guesses.items()])
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"))
    return orders.select(
        F.explode(rows).alias("p"),
        F.when(F.col("o_orderkey") % 5 == 0, "test").otherwise("train").alias("split"),
        F.col("o_orderkey").alias("sample_id"),
        y.alias("y"),
    ).select("p.model", "split", "sample_id", "y", "p.yhat")


def event_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily consumption per user from the event table: one dense month."""
    off = F.col("event_type").isin("purchase", "signup")
    events = table(spark, sf_dir, "events")
    return (
        events
        .groupBy(F.col("user_id").alias("meter_id"), F.to_date("ts").alias("date"))
        .agg(
            F.round(F.coalesce(F.sum(F.when(off, F.col("value"))), F.lit(0.0)), 2).alias("offpeak_kwh"),
            F.round(F.coalesce(F.sum(F.when(~off, F.col("value"))), F.lit(0.0)), 2).alias("onpeak_kwh"),
        )
        .withColumn("total_kwh", F.col("offpeak_kwh") + F.col("onpeak_kwh"))
        .repartition(tasks_for(events), "meter_id")
    )
