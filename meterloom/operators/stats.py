"""Descriptive statistics over any grouping (``by=[]`` is the whole table).

Everything here is either a mergeable aggregate or rests on ``ranking``; no group is gathered into one task.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.functions.calendar import SEASONS_PT
from meterloom.functions.labels import correlation_direction, correlation_strength, skew_label
from meterloom.functions.numeric import adjusted_kurtosis, adjusted_skew, outside, pearson, ratio, tukey_high, tukey_low
from meterloom.operators.joins import attach
from meterloom.operators.ranking import quantiles
from meterloom.operators.weather import in_season_order

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def long_form(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """(keep…, column_name, value), one row per cell of ``columns``."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*keep, F.inline(cells))


def describe(df: DataFrame, columns: list[str], by: list[str] = []) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max of each column."""
    cells = long_form(df, columns, by)
    key = [*by, "column_name"]
    base = cells.groupBy(*key).agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return base.join(quantiles(cells, key, "value", QUARTILES), key, "left")


def by_group(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """mean, median, sample deviation, min, max and count of ``value`` per group."""
    base = df.groupBy(*by).agg(
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.count(value).alias("n"),
    )
    return base.join(quantiles(df, by, value, {"median": 0.5}), by, "left")


def by_season(monthly: DataFrame) -> DataFrame:
    """Total and component statistics per season, all four in order even when one has no month."""
    totals = by_group(monthly, ["season"], "total_kwh")
    parts = monthly.groupBy("season").agg(
        F.avg("offpeak_kwh").alias("mean_offpeak"), F.avg("onpeak_kwh").alias("mean_onpeak")
    )
    return in_season_order(totals.join(parts, "season"), SEASONS_PT)


def by_calendar_month(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy("month").agg(
        F.avg("total_kwh").alias("mean"),
        F.stddev_samp("total_kwh").alias("std"),
        F.count(F.lit(1)).alias("n"),
        F.avg("offpeak_kwh").alias("mean_offpeak"),
        F.avg("onpeak_kwh").alias("mean_onpeak"),
    )


def moments(df: DataFrame, columns: list[str], by: list[str] = []) -> DataFrame:
    """Population skewness and excess kurtosis, and both bias-adjusted."""
    n = F.col("n").cast("double")
    return (
        long_form(df, columns, by)
        .groupBy(*by, "column_name")
        .agg(F.count("value").alias("n"), F.skewness("value").alias("skew_pop"), F.kurtosis("value").alias("kurt_pop"))
        .withColumns({"skew_adj": adjusted_skew(F.col("skew_pop"), n), "kurt_adj": adjusted_kurtosis(F.col("kurt_pop"), n)})
    )


def fences(df: DataFrame, value: str, by: list[str] = []) -> DataFrame:
    q = quantiles(df, by, value, QUARTILES)
    return q.withColumns({"low": tukey_low(F.col("q1"), F.col("q3")), "high": tukey_high(F.col("q1"), F.col("q3"))})


def tukey_outliers(df: DataFrame, value: str, by: list[str] = []) -> DataFrame:
    """The outlying rows themselves, with the fences they violate."""
    fenced = attach(df, fences(df, value, by).select(*by, "low", "high"), by)
    return fenced.where(outside(F.col(value), F.col("low"), F.col("high")))


def boxplot_stats(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Quartiles, whisker ends (outermost data inside the fences) and number of fliers."""
    limits = fences(df, value, by)
    inside = ~outside(F.col(value), F.col("low"), F.col("high"))
    return attach(df.select(*by, value), limits, by).groupBy(*by, "q1", "median", "q3", "low", "high").agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.count_if(~inside).alias("n_fliers"),
        F.count(value).alias("n"),
    )


def correlation_pairs(df: DataFrame, columns: list[str], by: list[str] = []) -> DataFrame:
    """Pearson correlation of every pair (lower triangle) from one aggregate; NULL for constant columns."""
    pairs = list(combinations(columns, 2))
    wide = df.groupBy(*by).agg(*[pearson(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(
        *[F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), F.col(f"r{i}").alias("r"))
          for i, (a, b) in enumerate(pairs)]
    )
    return wide.select(*by, F.inline(rows))


def near_perfect_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.where((F.abs("r") > 0.999) & (F.abs("r") < 1.0))


def correlations_with(pairs: DataFrame, target: str, by: list[str] = []) -> DataFrame:
    """Pairs that involve ``target``, labelled, as (variable, r)."""
    other = F.when(F.col("var_a") == target, F.col("var_b")).otherwise(F.col("var_a"))
    return pairs.where((F.col("var_a") == target) | (F.col("var_b") == target)).select(
        *by,
        other.alias("variable"),
        "r",
        correlation_strength(F.col("r")).alias("strength"),
        correlation_direction(F.col("r")).alias("direction"),
    )


def strongest_driver(pairs: DataFrame, target: str, candidates: list[str], by: list[str] = []) -> DataFrame:
    """The candidate with the largest correlation in size; the first listed wins a tie."""
    order = F.array_position(F.array(*[F.lit(c) for c in candidates]), F.col("variable"))
    rows = correlations_with(pairs, target, by).where(F.col("variable").isin(*candidates) & F.col("r").isNotNull())
    best = F.max_by(F.struct("variable", "r"), F.struct(F.abs("r"), -order)).alias("best")
    return rows.groupBy(*by).agg(best).select(*by, "best.variable", "best.r")


def histogram(df: DataFrame, value: str, bins: int, by: list[str] = []) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin is closed. Empty bins give no row."""
    rows = df.select(*by, value).where(F.col(value).isNotNull())
    limits = rows.groupBy(*by).agg(
        F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(F.lit(1)).alias("total")
    )
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.floor(F.coalesce(ratio(F.col(value) - F.col("lo"), width), F.lit(0.0)))
    return (
        attach(rows, limits, by)
        .withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
        .groupBy(*by, "bin", "lo", "hi", "total")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            *by,
            "bin",
            (F.col("lo") + F.col("bin") * width).alias("bin_low"),
            (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_high"),
            "n",
            ratio(F.col("n"), F.col("total") * width).alias("density"),
        )
    )


def normal_overlay(df: DataFrame, value: str, by: list[str] = [], points: int = 100) -> DataFrame:
    """Normal density with the group's mean and population deviation on a grid over its range."""
    params = df.groupBy(*by).agg(
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("lo"), F.max(value).alias("hi")
    )
    x = F.col("lo") + F.col("i") * (F.col("hi") - F.col("lo")) / (points - 1)
    z = ratio(F.col("x") - F.col("mean"), F.col("std"))
    return (
        params.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", x)
        .select(*by, "i", "x", "mean", "std",
                ratio(F.exp(-0.5 * z * z), F.col("std") * F.sqrt(F.lit(2.0) * F.pi())).alias("density"))
    )


def trend_line(df: DataFrame, x: str, y: str, by: list[str] = []) -> DataFrame:
    return df.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), pearson(x, y).alias("r"),
        F.count(F.lit(1)).alias("n"),
    )


def distribution_flags(df: DataFrame, value: str, by: list[str] = []) -> DataFrame:
    """Skewness labels at both limits and whether mean and median differ by more than a tenth."""
    n = F.col("n").cast("double")
    base = df.groupBy(*by).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.skewness(value).alias("skew_pop")
    )
    both = attach(base, quantiles(df, by, value, {"median": 0.5}), by)
    skew = adjusted_skew(F.col("skew_pop"), n)
    return both.select(
        *by,
        "n",
        "mean",
        "median",
        skew.alias("skew_adj"),
        skew_label(skew).alias("skew_label"),
        (F.abs("skew_pop") > 1.0).alias("strongly_skewed"),
        (F.abs(ratio(F.col("mean") - F.col("median"), F.col("median"))) > 0.1).alias("mean_median_apart"),
        (skew > 0.5).alias("suggest_log1p"),
    )


def log1p_target(df: DataFrame, value: str) -> DataFrame:
    """Add ``log1p_<value>`` and whether the column is skewed enough to use it."""
    skew = df.agg(F.skewness(value).alias("_skew"))
    return (
        attach(df, skew, [])
        .withColumn(f"log1p_{value}", F.log1p(value))
        .withColumn("use_log1p", F.abs("_skew") > 1.0)
        .drop("_skew")
    )


def season_scatter(monthly: DataFrame) -> DataFrame:
    """Points for the season-coloured scatter plots, written out as a table."""
    return monthly.select(
        "meter_id", "month_start", "season", "total_kwh", (F.col("offpeak_ratio") * 100).alias("offpeak_pct"),
        "offpeak_kwh", "onpeak_kwh", "days_in_month", "bill",
    )
