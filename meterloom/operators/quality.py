"""Checks on the raw and monthly tables, as rows instead of printed lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.functions.numeric import ratio, share


def duplicate_report(readings: DataFrame) -> DataFrame:
    """Rows that share their date with another row of the meter (all of them count), per meter."""
    per_date = readings.groupBy("meter_id", "read_date").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_date.where("n > 1")
        .groupBy("meter_id")
        .agg(F.sum("n").alias("duplicate_rows"), F.count(F.lit(1)).alias("duplicate_dates"))
    )


def quality_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL and negative counts and the missing percentage of every column, in one scan."""
    wide = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns],
        *[F.count_if(F.col(c) < 0).alias(f"{c}_negatives") for c in columns],
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"{c}_nulls").alias("n_null"),
                     F.col(f"{c}_negatives").alias("n_negative"))
            for c in columns
        ]
    )
    return wide.select("n", F.inline(rows)).select(
        "column_name", F.col("n").alias("n_rows"), "n_null", "n_negative",
        ratio(F.col("n_null") * 100.0, F.col("n")).alias("null_pct"),
    )


def dataset_summary(scenarios: DataFrame) -> DataFrame:
    """Row count, period, distinct months and scenarios per month of each meter."""
    per_month = scenarios.groupBy("meter_id", "month_start").agg(
        F.count(F.lit(1)).alias("n"), F.min("simulation_date").alias("d0"), F.max("simulation_date").alias("d1")
    )
    return per_month.groupBy("meter_id").agg(
        F.sum("n").alias("n_rows"),
        F.min("d0").alias("first_date"),
        F.max("d1").alias("last_date"),
        F.count(F.lit(1)).alias("n_months"),
        (F.sum("n") / F.count(F.lit(1))).alias("rows_per_month"),
    )


def monthly_quality_flags(monthly: DataFrame, daily: DataFrame) -> DataFrame:
    """Negative and zero months, and whether more than a tenth of the days are zero, per meter."""
    months = monthly.groupBy("meter_id").agg(
        F.count_if(F.col("total_kwh") < 0).alias("negative_months"),
        F.count_if(F.col("total_kwh") == 0).alias("zero_months"),
        F.count(F.lit(1)).alias("n_months"),
    )
    days = daily.groupBy("meter_id").agg(
        F.count_if(F.col("total_kwh") == 0).alias("zero_days"), share(F.col("total_kwh") == 0).alias("zero_day_pct")
    )
    return months.join(days, "meter_id").withColumn("many_zero_days", F.col("zero_day_pct") > 10)


def numeric_validation(predictions: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """NULL, NaN and infinite values per group and column."""
    wide = predictions.groupBy(*by).agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_null") for c in columns],
        *[F.count_if(F.isnan(c)).alias(f"{c}_nan") for c in columns],
        *[F.count_if(F.abs(c) == float("inf")).alias(f"{c}_inf") for c in columns],
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"{c}_null").alias("n_null"),
                     F.col(f"{c}_nan").alias("n_nan"), F.col(f"{c}_inf").alias("n_inf"))
            for c in columns
        ]
    )
    return wide.select(*by, F.inline(rows))
