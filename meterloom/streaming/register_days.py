"""Daily consumption from a stream of cumulative registers, as the batch chain gives it.

The state of a meter is the last row of its closed days and one row per open day, so a difference needs no earlier data
to be read again. A day closes when the watermark is past it; its result is written once. Results of open days may still
change: they form a snapshot of at most ``late`` days per meter, which each micro-batch brings up to date.
"""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY_MS = 86_400_000
COMBINED = "meter_id bigint, day int, ts timestamp, reg_offpeak double, reg_onpeak double"
STATE = "closed int, reg_offpeak double, reg_onpeak double, days array<int>, offpeak array<double>, onpeak array<double>"
DAYS = "meter_id bigint, date date, offpeak_kwh double, onpeak_kwh double, total_kwh double, final boolean"


def _known(x):
    return None if x is None or x != x else float(x)


def _larger(a, b):
    return b if a is None else a if b is None else max(a, b)


def _combine(frames):
    """Rows of one meter and day in an Arrow batch become one before the shuffle."""
    for pdf in frames:
        best = pdf.groupby(["meter_id", "day"], as_index=False, dropna=False)[["ts", "reg_offpeak", "reg_onpeak"]].max()
        yield best[["meter_id", "day", "ts", "reg_offpeak", "reg_onpeak"]]


def _advance(key, frames, state):
    closed, last_off, last_on, days, offs, ons = state.get if state.exists else (None, None, None, [], [], [])
    rows = {d: (_known(a), _known(b)) for d, a, b in zip(days, offs, ons)}
    last = None if closed is None else (_known(last_off), _known(last_on))
    for pdf in frames:
        for day, off, on in zip(pdf["day"], pdf["reg_offpeak"], pdf["reg_onpeak"]):
            if closed is None or day > closed:
                before = rows.get(int(day), (None, None))
                rows[int(day)] = (_larger(before[0], _known(off)), _larger(before[1], _known(on)))
    edge = state.getCurrentWatermarkMs() // DAY_MS - 1  # a day more than the watermark, for any time zone
    out = [(key[0], None, None, None, None, False)]  # tells that the meter's open days are replaced
    at = last
    for day in sorted(rows):
        off, on = rows[day]
        off = off if off is not None else at[0] if at else 0.0
        if at and on is not None and at[1] is not None:
            low, high = abs(off - at[0]), abs(on - at[1])
            out.append((key[0], dt.date(1970, 1, 1) + dt.timedelta(day), low, high, low + high, day < edge))
        at = (off, on)
        if day < edge:
            closed, last = day, at
    left = sorted(d for d in rows if closed is None or d > closed)
    off, on = last or (None, None)
    state.update((closed, off, on, left, [rows[d][0] for d in left], [rows[d][1] for d in left]))
    if left:
        state.setTimeoutTimestamp((left[0] + 2) * DAY_MS)
    yield pd.DataFrame(out, columns=["meter_id", "date", "offpeak_kwh", "onpeak_kwh", "total_kwh", "final"])


def register_days(records: DataFrame, late: str = "40 days") -> DataFrame:
    """Stream of (meter_id, ts, reg_offpeak, reg_peak, reg_shoulder) -> days that closed and days that are open.

    Of several readings a day the largest registers count; missing off-peak registers take the value before (0 at the
    start), and a day without an on-peak register on it or before it has no row, as in ``daily_consumption`` over
    ``dedupe_readings(..., "max")``. Records without a time are left out, and so are those older than ``late``.
    A row without a date only tells that the meter's open days are replaced.
    """
    rows = records.where("ts IS NOT NULL").select(
        "meter_id",
        F.unix_date(F.to_date("ts")).alias("day"),
        "ts",
        F.col("reg_offpeak").cast("double").alias("reg_offpeak"),
        (F.col("reg_peak") + F.col("reg_shoulder")).cast("double").alias("reg_onpeak"),
    )
    combined = rows.mapInPandas(_combine, COMBINED).withWatermark("ts", late)
    return combined.groupBy("meter_id").applyInPandasWithState(_advance, DAYS, STATE, "update", "EventTimeTimeout")


def run_register_days(records: DataFrame, out: str, checkpoint: str, late: str = "40 days") -> None:
    """Process what is available and stop.

    Closed days go to a folder of the micro-batch. The snapshot of open days is written to one of two folders in turn,
    from the other one, so a batch that is run again after a failure finds what it found the first time.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        batch.where("final").drop("final").write.mode("overwrite").parquet(f"{out}/closed/batch={number}")
        now = batch.where("NOT final").drop("final")
        if number > 0:
            before = spark.read.parquet(f"{out}/open/{(number - 1) % 2}").drop("batch")
            now = _without(before, now).unionByName(now)
        now.withColumn("batch", F.lit(number).cast("bigint")).write.mode("overwrite").parquet(f"{out}/open/{number % 2}")
        batch.unpersist()

    query = (
        register_days(records, late)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()


def _without(before: DataFrame, now: DataFrame) -> DataFrame:
    """Open days of meters that this batch did not touch. Null meters meet each other."""
    touched = now.select(F.col("meter_id").alias("touched")).distinct()
    return before.join(touched, F.col("meter_id").eqNullSafe(F.col("touched")), "left_anti")


def current_days(spark: SparkSession, out: str) -> DataFrame:
    """All days so far: the closed ones and the newest snapshot of the open ones."""
    open_days = spark.read.parquet(f"{out}/open/*")
    newest = open_days.agg(F.max("batch")).first()[0]
    closed = spark.read.parquet(f"{out}/closed").where(F.col("batch") <= newest)
    return closed.drop("batch").unionByName(open_days.where((F.col("batch") == newest) & F.col("date").isNotNull()).drop("batch"))
