"""Quantiles of large data from sketches kept per group and month.

A sketch has a bounded size and two of them merge to one of both parts, so a report over any months and any coarser groups
reads a few rows instead of the data, and a month that changed is sketched again alone. ``ranking.quantiles`` is the exact
form; the rank of a sketched quantile is off by less than ``rank_bound(k)`` times the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.functions.calendar import month_start
from meterloom.operators.joins import attach
from meterloom.operators.ranking import cumulative_counts

K = 1024


def rank_bound(k: int = K) -> float:
    """Twice the sketch's published error at 99 % confidence, 2.296 / k ** 0.9021: more than five standard deviations."""
    return 2 * 2.296 / k**0.9021


def monthly_sketches(df: DataFrame, by: list[str], value: str, date: str = "date", k: int = K) -> DataFrame:
    """(by…, month_start, n, sketch). NULL and NaN values are left out, and so are rows without a date."""
    rows = df.select(*by, month_start(F.col(date)).alias("month_start"), F.col(value).cast("double").alias("_x"))
    known = rows.where(F.col("_x").isNotNull() & ~F.isnan("_x") & F.col("month_start").isNotNull())
    return known.groupBy(*by, "month_start").agg(F.count("_x").alias("n"), F.kll_sketch_agg_double("_x", k).alias("sketch"))


def keep(sketches: DataFrame, path: str) -> None:
    """Write the months at hand; those already there are replaced, other months stay."""
    writer = sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("month_start").parquet(path)


def kept(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """Sketches of the months from ``first`` to ``last``; other months' folders are not read."""
    rows = spark.read.parquet(path).withColumn("month_start", F.col("month_start").cast("date"))
    for bound, inside in ((first, F.col("month_start") >= F.lit(first)), (last, F.col("month_start") <= F.lit(last))):
        rows = rows.where(inside) if bound is not None else rows
    return rows


def sketched_quantiles(sketches: DataFrame, by: list[str], fractions: dict[str, float]) -> DataFrame:
    """Values at the fractions, one column each, of the merged sketches of each group; every value is one of the data."""
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("_s"))
    at = F.kll_sketch_get_quantile_double("_s", F.array(*[F.lit(float(p)) for p in fractions.values()]))
    some = merged.where("n > 0").withColumn("_at", at)
    return some.select(*by, "n", *[F.col("_at")[i].alias(name) for i, name in enumerate(fractions)])


def rank_errors(df: DataFrame, by: list[str], value: str, found: DataFrame, fractions: dict[str, float]) -> DataFrame:
    """(by…, quantile, n, rank_error): how far each sketched quantile's exact ranks lie from the wanted one, as a share of n."""
    one = [F.struct(F.lit(n).alias("quantile"), F.lit(float(p)).alias("_p"), F.col(n).alias(value)) for n, p in fractions.items()]
    wanted = found.select(*by, F.inline(F.array(*one)))
    placed = attach(cumulative_counts(df.withColumn(value, F.col(value).cast("double")), by, value), wanted, [*by, value])
    below, upto, n = F.col("n_below"), F.col("n_below") + F.col("n_at"), F.col("n_total")
    off = F.greatest(below - F.col("_p") * n, F.col("_p") * n - upto, F.lit(0.0))
    return placed.select(*by, "quantile", n.alias("n"), (off / n).alias("rank_error"))
