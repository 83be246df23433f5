"""Partial-month scenarios: every month as it looked on a few cutoff days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterloom.functions.billing import Tariff, add_bill
from meterloom.functions.calendar import days_in_month, month_start
from meterloom.operators import weather as weather_ops
from meterloom.operators.series import KWH, last_of
from meterloom.schemas import CUTOFF_DAYS, TRAILING_ROWS


def expand_cutoffs(monthly: DataFrame, cutoffs=CUTOFF_DAYS) -> DataFrame:
    """A row per month and cutoff day that the month has."""
    days = F.array(*[F.lit(c) for c in cutoffs])
    fits = F.filter(days, lambda c: c <= F.col("days_in_month"))
    return monthly.withColumn("cutoff_day", F.explode(fits))


def _mean(items):
    """Mean of the elements that are not NULL; NULL if none is."""
    known = F.filter(items, lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, x: a + x), F.size(known))


def month_snapshots(daily: DataFrame, cutoffs=CUTOFF_DAYS) -> DataFrame:
    """State of each month at each cutoff: running sums, row count, trailing means, last date.

    Running windows over (meter, month) give every day its month-to-date state; a cutoff then simply takes the
    last day on or before it. So nothing is multiplied by the number of cutoffs before the windows, and the
    windows reuse the partitioning by meter that ``daily`` comes with. ``daily`` has one row per meter and date; where it
    stands for ``n_rows`` source rows, its ``tail`` lists the last of them for the trailing means.
    """
    if "tail" not in daily.columns:
        daily = daily.withColumns({"n_rows": F.lit(1).cast("bigint"), "tail": F.array(F.struct(*KWH))})
    month = W.partitionBy("meter_id", "month_start")
    order = month.orderBy("date")
    so_far = order.rowsBetween(W.unboundedPreceding, 0)
    trailing = order.rowsBetween(-(TRAILING_ROWS - 1), 0)
    running = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0.0))).over(so_far)
    recent = lambda c: _mean(F.col("_recent")[c])
    days = daily.withColumn("month_start", month_start(F.col("date"))).withColumns(
        {
            "cum_offpeak_kwh": running("offpeak_kwh"),
            "cum_onpeak_kwh": running("onpeak_kwh"),
            "days_elapsed": F.sum("n_rows").over(so_far),
            "_recent": last_of(F.flatten(F.collect_list("tail").over(trailing)), TRAILING_ROWS),
            "first_date": F.first("date").over(so_far),
            "_day": F.dayofmonth("date"),
            "_next_day": F.dayofmonth(F.lead("date").over(order)),
            "days_in_month": days_in_month(F.col("date")),
        }
    )
    shown_at = F.filter(
        F.array(*[F.lit(c) for c in cutoffs]),
        lambda c: (F.col("_day") <= c)
        & (F.col("_next_day").isNull() | (F.col("_next_day") > c))
        & (c <= F.col("days_in_month")),
    )
    return days.withColumn("cutoff_day", F.explode(shown_at)).select(
        "meter_id",
        "month_start",
        "cutoff_day",
        "first_date",
        F.col("date").alias("simulation_date"),
        F.weekday("date").alias("day_of_week"),
        "days_in_month",
        "days_elapsed",
        (F.col("days_in_month") - F.col("days_elapsed")).alias("days_remaining"),
        "cum_offpeak_kwh",
        "cum_onpeak_kwh",
        (F.col("cum_offpeak_kwh") + F.col("cum_onpeak_kwh")).alias("cum_total_kwh"),
        recent("offpeak_kwh").alias("avg7_offpeak"),
        recent("onpeak_kwh").alias("avg7_onpeak"),
        recent("total_kwh").alias("avg7_total"),
    )


def partial_month_scenarios(
    daily: DataFrame,
    monthly: DataFrame,
    weather: DataFrame | None = None,
    stations: DataFrame | None = None,
    tariff: Tariff = Tariff(),
    cutoffs=CUTOFF_DAYS,
) -> DataFrame:
    """Feature rows keyed by (meter, month, cutoff) with the full month's bill as label.

    ``monthly`` has a row per meter and month and carries ``bill``; months without daily rows drop out. ``stations`` maps
    meters to weather stations. Both sides of the label join lie by meter; a meter's months, a dozen a year, are packed to
    one row, so they meet without being dealt out again by month. No join carries a broadcast hint: both sides grow with the
    number of meters.
    """
    label = F.struct("month_start", F.struct("year", "month", "season", "bill"))
    labels = monthly.where("month_start IS NOT NULL").groupBy("meter_id").agg(F.map_from_entries(F.collect_list(label)).alias("_labels"))
    rows = month_snapshots(daily, cutoffs).join(labels, "meter_id").withColumn("_label", F.try_element_at("_labels", F.col("month_start")))
    rows = rows.where("_label IS NOT NULL").select("*", "_label.*").drop("_labels", "_label")
    if weather is None:
        rows = weather_ops.with_season_defaults(rows)
    else:
        rows = weather_ops.with_range_means(rows.join(stations, "meter_id", "left"), weather)
    rows = add_bill(rows, "projected_bill", "cum_offpeak_kwh", "cum_onpeak_kwh", "days_elapsed", tariff)
    return rows.select(
        "meter_id",
        "month_start",
        "cutoff_day",
        "simulation_date",
        "year",
        "month",
        "season",
        "day_of_week",
        "days_in_month",
        "days_elapsed",
        "days_remaining",
        "cum_offpeak_kwh",
        "cum_onpeak_kwh",
        "cum_total_kwh",
        "avg7_offpeak",
        "avg7_onpeak",
        "avg7_total",
        "temperature",
        "humidity",
        F.lit(0).alias("occupancy"),
        "projected_bill",
        "bill",
    )
