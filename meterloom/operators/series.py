"""Registers -> daily consumption.

Rows of one date are combined first (map-side), so the per-meter windows that follow run over at most one row
per calendar day: their groups are bounded however many raw rows a meter has. All windows of a chain share the
partitioning by ``meter_id``, so the chain costs one exchange after the combining one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterloom.functions.numeric import outside, tukey_high, tukey_low
from meterloom.schemas import TRAILING_ROWS

REGISTERS = ("reg_offpeak", "reg_peak", "reg_shoulder")
KWH = ("offpeak_kwh", "onpeak_kwh", "total_kwh")


def combine_registers(readings: DataFrame) -> DataFrame:
    """On-peak register = peak + shoulder and total = off-peak + on-peak; NULL if a part is NULL."""
    on = F.col("reg_peak") + F.col("reg_shoulder")
    return readings.withColumns({"reg_onpeak": on, "reg_total": F.col("reg_offpeak") + on})


def dedupe_readings(readings: DataFrame, dup_policy: str = "sum") -> DataFrame:
    """One row per meter and date.

    ``sum`` adds the registers of equal dates. A meter with any duplicate has all its dates re-aggregated, which
    turns its NULL registers into 0; a meter without keeps its NULLs. ``max`` keeps the larger register and all
    NULLs, the sensible choice for real data.
    """
    combined = combine_registers(readings)
    names = (*REGISTERS, "reg_onpeak")
    combine = {"sum": F.sum, "max": F.max}[dup_policy]
    per_date = combined.groupBy("meter_id", "read_date").agg(
        F.count(F.lit(1)).alias("n_rows"), *[combine(c).alias(c) for c in names]
    )
    if dup_policy == "max":
        return per_date.drop("n_rows")
    has_duplicate = F.max("n_rows").over(W.partitionBy("meter_id")) > 1
    flagged = per_date.withColumn("_dup", has_duplicate)
    return flagged.select(
        "meter_id",
        "read_date",
        *[F.when(F.col("_dup"), F.coalesce(c, F.lit(0.0))).otherwise(F.col(c)).alias(c) for c in names],
    )


def fill_readings(deduped: DataFrame) -> DataFrame:
    """Forward fill of the three registers, 0 before the first value. The on-peak sum stays as it was built."""
    so_far = W.partitionBy("meter_id").orderBy("read_date").rowsBetween(W.unboundedPreceding, 0)
    return deduped.withColumns(
        {c: F.coalesce(F.last(c, ignorenulls=True).over(so_far), F.lit(0.0)) for c in REGISTERS}
    )


def register_differences(filled: DataFrame, strict: bool = False) -> DataFrame:
    """Signed differences to the previous reading; the first reading and rows with a NULL difference go.

    ``strict`` also drops rows that are NULL in any other column.
    """
    order = W.partitionBy("meter_id").orderBy("read_date")
    diff = lambda c: F.col(c) - F.lag(c).over(order)
    out = filled.select(
        "*", diff("reg_offpeak").alias("offpeak_diff"), diff("reg_onpeak").alias("onpeak_diff")
    )
    out = out.na.drop() if strict else out.na.drop(subset=["offpeak_diff", "onpeak_diff"])
    return out.withColumnRenamed("read_date", "date")


def daily_consumption(filled: DataFrame, strict: bool = False) -> DataFrame:
    """Daily kWh; a register that falls (meter replaced) counts with the size of its drop."""
    return (
        register_differences(filled, strict)
        .select(
            "meter_id",
            "date",
            F.abs("offpeak_diff").alias("offpeak_kwh"),
            F.abs("onpeak_diff").alias("onpeak_kwh"),
        )
        .withColumn("total_kwh", F.col("offpeak_kwh") + F.col("onpeak_kwh"))
    )


def meter_resets(filled: DataFrame) -> DataFrame:
    """Days with a negative difference, per meter."""
    falls = (F.col("offpeak_diff") < 0) | (F.col("onpeak_diff") < 0)
    return (
        register_differences(filled)
        .groupBy("meter_id")
        .agg(F.count_if(falls).alias("reset_days"), F.count(F.lit(1)).alias("days"))
    )


def flag_outlier_days(daily: DataFrame) -> DataFrame:
    """Tukey fences on the daily total of each meter, as columns ``low``, ``high``, ``is_outlier``."""
    meter = W.partitionBy("meter_id")
    return (
        daily.withColumn("_q", F.percentile("total_kwh", F.array(F.lit(0.25), F.lit(0.75))).over(meter))
        .withColumns({
            "low": tukey_low(F.col("_q")[0], F.col("_q")[1]),
            "high": tukey_high(F.col("_q")[0], F.col("_q")[1]),
        })
        .withColumn("is_outlier", outside(F.col("total_kwh"), F.col("low"), F.col("high")))
        .drop("_q")
    )


def replace_outliers(daily: DataFrame) -> DataFrame:
    """Outlier days take the medians of the meter's other days; the total is the sum of the two medians."""
    meter = W.partitionBy("meter_id")
    usual = lambda c: F.median(F.when(~F.col("is_outlier"), F.col(c))).over(meter)
    flagged = flag_outlier_days(daily).withColumns({"_off": usual("offpeak_kwh"), "_on": usual("onpeak_kwh")})
    pick = lambda c, repl: F.when(F.col("is_outlier"), repl).otherwise(F.col(c)).alias(c)
    return flagged.select(
        "meter_id",
        "date",
        pick("offpeak_kwh", F.col("_off")),
        pick("onpeak_kwh", F.col("_on")),
        pick("total_kwh", F.col("_off") + F.col("_on")),
        "is_outlier",
    )


def clean_daily(readings: DataFrame, dup_policy: str = "sum") -> DataFrame:
    """The whole cleaning chain: combine dates, fill, difference, repair, replace outliers."""
    return replace_outliers(daily_consumption(fill_readings(dedupe_readings(readings, dup_policy))))


def raw_daily(readings: DataFrame) -> DataFrame:
    """Daily kWh straight from the rows as they came: no combining, filling or outlier handling; one row per date.

    Equal dates count as separate rows, each with the difference to the row before it (NULL if a register is). Row order
    inside a date: off-peak, then on-peak register, NULLs first. ``n_rows`` is the number of those differences, the kWh
    columns are their sums, and ``tail`` holds the last of them, as many as a trailing mean can see.

    Identical copies are counted before the shuffle. Differences are taken inside pieces of one meter and date; a piece
    hands its last registers on to the next one, so that only one row per date meets the others of its meter.
    """
    shown = TRAILING_ROWS
    counted = (
        combine_registers(readings)
        .groupBy("meter_id", F.col("read_date").alias("date"), "reg_offpeak", "reg_onpeak")
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    piece = W.partitionBy("meter_id", "date")
    order = piece.orderBy("reg_offpeak", "reg_onpeak")
    registers = F.struct(F.col("reg_offpeak").alias("off"), F.col("reg_onpeak").alias("on"))
    rows = counted.withColumns({
        "_place": F.row_number().over(order),
        "_before": F.lag(registers).over(order),
        "_rows": F.count(F.lit(1)).over(piece),
        "_registers": registers,
    })
    repeats = F.least(F.col("_copies") - 1, F.lit(shown)).cast("int")
    moved, still = _step(F.col("_registers"), F.col("_before")), _step(F.col("_registers"), F.col("_registers"))
    again, follows = F.col("_copies") > 1, F.col("_place") > 1
    listed = F.concat(F.when(follows, F.array(moved)).otherwise(F.slice(F.array(moved), 1, 0)), F.array_repeat(still, repeats))
    late = F.when(F.col("_rows") - F.col("_place") < shown, F.struct("_place", listed.alias("steps")))
    inner = lambda c: _plus(F.sum(F.when(follows, moved[c])), F.sum(F.when(again, still[c])))
    pieces = rows.groupBy("meter_id", "date").agg(
        F.sum("_copies").alias("_n"),
        F.max(F.when(~follows, F.col("_registers"))).alias("_first"),
        F.max(F.when(F.col("_place") == F.col("_rows"), F.col("_registers"))).alias("_last"),
        *[inner(c).alias(f"_{c}") for c in KWH],
        F.flatten(F.sort_array(F.collect_list(late))["steps"]).alias("_steps"),
    )
    earlier = F.lag("_last").over(W.partitionBy("meter_id").orderBy("date"))
    border = F.when(F.col("_earlier").isNotNull(), _step(F.col("_first"), F.col("_earlier")))  # a meter's first row has none
    tail = F.when(F.col("_border").isNotNull() & (F.size("_steps") < shown), F.concat(F.array("_border"), F.col("_steps")))
    return (
        pieces.withColumn("_earlier", earlier)
        .withColumn("_border", border)
        .select(
            "meter_id",
            "date",
            (F.col("_n") - F.when(F.col("_earlier").isNull(), 1).otherwise(0)).alias("n_rows"),
            *[_plus(F.col(f"_border.{c}"), F.col(f"_{c}")).alias(c) for c in KWH],
            last_of(F.coalesce(tail, F.col("_steps")), shown).alias("tail"),
        )
        .where("n_rows > 0")
    )


def _step(now: Column, before: Column) -> Column:
    off, on = F.abs(now["off"] - before["off"]), F.abs(now["on"] - before["on"])
    return F.struct(off.alias("offpeak_kwh"), on.alias("onpeak_kwh"), (off + on).alias("total_kwh"))


def _plus(a: Column, b: Column) -> Column:
    """Sum of what is there, NULL if nothing is."""
    return F.coalesce(a + b, a, b)


def last_of(items: Column, n: int) -> Column:
    return F.slice(items, F.greatest(F.size(items) - (n - 1), F.lit(1)), F.lit(n))
