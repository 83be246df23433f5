"""Daily -> monthly base, with incomplete months scaled up to full length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterloom.functions.calendar import days_in_month, month_start, season
from meterloom.functions.numeric import ratio


def monthly_consumption(daily: DataFrame) -> DataFrame:
    """One row per meter and month.

    ``daily`` is already partitioned by meter, so this grouping adds no exchange.
    """
    m = F.col("month_start")
    sums = daily.groupBy("meter_id", month_start(F.col("date")).alias("month_start")).agg(
        F.sum("offpeak_kwh").alias("offpeak_kwh"),
        F.sum("onpeak_kwh").alias("onpeak_kwh"),
        F.count(F.lit(1)).cast("int").alias("days_with_data"),
    )
    scale = F.when(
        F.col("days_with_data") < F.col("days_in_month"), F.col("days_in_month") / F.col("days_with_data")
    ).otherwise(1.0)
    return (
        sums.withColumn("days_in_month", days_in_month(m))
        .withColumn("_scale", scale)
        .select(
            "meter_id",
            "month_start",
            F.year(m).alias("year"),
            F.month(m).alias("month"),
            season(F.month(m)).alias("season"),
            "days_in_month",
            "days_with_data",
            (F.col("offpeak_kwh") * F.col("_scale")).alias("offpeak_kwh"),
            (F.col("onpeak_kwh") * F.col("_scale")).alias("onpeak_kwh"),
        )
        .withColumn("total_kwh", F.col("offpeak_kwh") + F.col("onpeak_kwh"))
        .withColumns(
            {
                "kwh_per_day": F.col("total_kwh") / F.col("days_in_month"),
                "offpeak_ratio": ratio(F.col("offpeak_kwh"), F.col("total_kwh")),
            }
        )
    )


def rolling_trend(monthly: DataFrame) -> DataFrame:
    """Centred six-month mean and sample deviation of the total, with a band of one deviation.

    A row needs all six values; the edges stay NULL.
    """
    frame = W.partitionBy("meter_id").orderBy("month_start").rowsBetween(-3, 2)
    full = F.count("total_kwh").over(frame) == 6
    mean = F.when(full, F.avg("total_kwh").over(frame))
    std = F.when(full, F.stddev_samp("total_kwh").over(frame))
    return monthly.select(
        "meter_id", "month_start", "total_kwh", mean.alias("rolling_mean"), std.alias("rolling_std")
    ).withColumns(
        {
            "band_low": F.col("rolling_mean") - F.col("rolling_std"),
            "band_high": F.col("rolling_mean") + F.col("rolling_std"),
        }
    )


def stacked_components(monthly: DataFrame) -> DataFrame:
    """Components stacked for an area chart, shares in percent, and the position of the month in its series."""
    total = F.col("offpeak_kwh") + F.col("onpeak_kwh") + 0.001
    return monthly.select(
        "meter_id",
        "month_start",
        (F.row_number().over(W.partitionBy("meter_id").orderBy("month_start")) - 1).alias("position"),
        F.col("offpeak_kwh").alias("stack_offpeak"),
        (F.col("offpeak_kwh") + F.col("onpeak_kwh")).alias("stack_total"),
        (F.col("offpeak_kwh") / total * 100).alias("offpeak_pct"),
        (F.col("onpeak_kwh") / total * 100).alias("onpeak_pct"),
    )


def tariff_shares(monthly: DataFrame, by: list[str]) -> DataFrame:
    """Share of each tariff period in the consumption of a group, and the mean smoothed monthly shares."""
    total = F.col("offpeak_kwh") + F.col("onpeak_kwh")
    return monthly.groupBy(*by).agg(
        (ratio(F.sum("offpeak_kwh"), F.sum(total)) * 100).alias("offpeak_share_pct"),
        (ratio(F.sum("onpeak_kwh"), F.sum(total)) * 100).alias("onpeak_share_pct"),
        F.avg(F.col("offpeak_kwh") / (total + 0.001)).alias("mean_offpeak_ratio"),
        F.avg(F.col("onpeak_kwh") / (total + 0.001)).alias("mean_onpeak_ratio"),
    )
