"""Residual structure: shape, spread against prediction, normality, trend."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom.functions import labels
from meterloom.functions.normal import log_normal_cdf, normal_quantile
from meterloom.functions.numeric import outside, pearson, ratio, tukey_high, tukey_low
from meterloom.operators.evaluate import GROUP, with_residuals
from meterloom.operators.joins import attach
from meterloom.operators.ranking import cumulative_counts, equal_parts, exact_parts, exact_rank, quantiles
from meterloom.operators.stats import QUARTILES


def residual_stats(predictions: DataFrame, by=GROUP) -> DataFrame:
    """Location, spread, quartiles and population shape of the residuals, and Tukey outliers."""
    by = list(by)
    r = with_residuals(predictions)
    base = r.groupBy(*by).agg(
        F.count("residual").alias("n"),
        F.avg("residual").alias("mean"),
        F.stddev_pop("residual").alias("std"),
        F.min("residual").alias("min"),
        F.max("residual").alias("max"),
        F.skewness("residual").alias("skew"),
        F.kurtosis("residual").alias("kurt"),
    )
    quartiles = quantiles(r, by, "residual", QUARTILES)
    limits = quartiles.select(
        *by, tukey_low(F.col("q1"), F.col("q3")).alias("low"), tukey_high(F.col("q1"), F.col("q3")).alias("high")
    )
    outliers = attach(r, limits, by).groupBy(*by).agg(
        F.count_if(outside(F.col("residual"), F.col("low"), F.col("high"))).alias("n_outliers")
    )
    joined = base.join(quartiles, by).join(outliers, by)
    return joined.withColumns(
        {
            "iqr": F.col("q3") - F.col("q1"),
            "outlier_pct": ratio(F.col("n_outliers") * 100.0, F.col("n")),
        }
    )


def jarque_bera(stats: DataFrame) -> DataFrame:
    """Statistic and exact p-value (chi-square with two degrees of freedom) from the population moments."""
    jb = F.col("n") / 6.0 * (F.col("skew") * F.col("skew") + F.col("kurt") * F.col("kurt") / 4.0)
    return stats.withColumn("jarque_bera", jb).withColumn("p_value", F.exp(-F.col("jarque_bera") / 2))


def variance_ratio(predictions: DataFrame, by=GROUP) -> DataFrame:
    """Residual variance of the top third of predictions over that of the bottom third."""
    by = list(by)
    third = lambda total: F.floor(total / 3)
    part = lambda rank, total: F.when(rank <= third(total), -1).when(rank > total - third(total), 1).otherwise(0)
    parted = exact_parts(with_residuals(predictions), by, "yhat", ["sample_id"], part, "part")
    spread = parted.groupBy(*by).agg(
        F.var_pop(F.when(F.col("part") == -1, F.col("residual"))).alias("var_low"),
        F.var_pop(F.when(F.col("part") == 1, F.col("residual"))).alias("var_high"),
    )
    return spread.withColumn(
        "variance_ratio", F.when(F.col("var_low") > 0, F.col("var_high") / F.col("var_low")).otherwise(1.0)
    )


# Fixed value: rows up to which a group's normality is tested by its moments.
FEW_ROWS = 5000


def normality(predictions: DataFrame, stats: DataFrame, by=GROUP) -> DataFrame:
    """``stats`` with test, statistic and p-value: Jarque-Bera up to FEW_ROWS rows, Anderson-Darling above."""
    by = list(by)
    tested = anderson_darling(with_residuals(predictions), "residual", by).select(*by, F.col("statistic").alias("_ad"), F.col("p_value").alias("_ad_p"))
    both = jarque_bera(stats).join(tested, by, "left")
    many = F.col("n") > FEW_ROWS
    pick = lambda a, b: F.when(many, a).otherwise(b)
    return both.withColumns(
        {
            "normality_test": pick(F.lit("anderson_darling"), F.lit("jarque_bera")),
            "normality_statistic": pick(F.col("_ad"), F.col("jarque_bera")),
            "p_value": pick(F.col("_ad_p"), F.col("p_value")),
        }
    ).drop("_ad", "_ad_p")


def residual_findings(predictions: DataFrame, by=GROUP) -> DataFrame:
    """One row per check with its status and value, and the test that decided on normality."""
    by = list(by)
    s = normality(predictions, residual_stats(predictions, by), by).join(variance_ratio(predictions, by), by)
    sided = lambda c, limit, pos, neg: (
        F.when(F.abs(c) < limit, "ok").when(c > 0, pos).otherwise(neg)
    )
    checks = [
        ("bias", sided(F.col("mean"), 0.5, "underestimation", "overestimation"), F.col("mean")),
        ("normality", F.when(F.col("p_value") > 0.05, "normal").otherwise("not_normal"), F.col("p_value")),
        ("skewness", labels.skew_label(F.col("skew")), F.col("skew")),
        ("kurtosis", labels.tail_label(F.col("kurt")), F.col("kurt")),
        ("variance", labels.variance_label(F.col("variance_ratio")), F.col("variance_ratio")),
        ("outliers", F.when(F.col("outlier_pct") < 5, "few").otherwise("many"), F.col("outlier_pct")),
        (
            "improvement",
            F.when(
                (F.col("variance_ratio") > 2) | (F.abs("skew") > 1) | (F.col("outlier_pct") > 5), "recommended"
            ).otherwise("none"),
            F.lit(None).cast("double"),
        ),
    ]
    test = lambda n: F.col("normality_test") if n == "normality" else F.lit(None).cast("string")
    rows = F.array(*[F.struct(F.lit(n).alias("check"), st.alias("status"), v.alias("value"), test(n).alias("test")) for n, st, v in checks])
    return s.select(*by, F.inline(rows))


def residual_trend(predictions: DataFrame, bins: int = 50, by=GROUP) -> DataFrame:
    """Mean residual and prediction in runs of equally many rows along the prediction axis."""
    by = list(by)
    part = lambda rank, total: equal_parts(rank, total, bins).cast("int")
    return (
        exact_parts(with_residuals(predictions), by, "yhat", ["sample_id"], part, "bin")
        .groupBy(*by, "bin")
        .agg(F.avg("yhat").alias("mean_yhat"), F.avg("residual").alias("mean_residual"), F.count(F.lit(1)).alias("n"))
    )


def cubic_weights(window: int) -> np.ndarray:
    """Row t holds the weights that give a least-squares cubic over ``window`` points its value at point t."""
    half = window // 2
    powers = np.vander((np.arange(window) - half) / max(half, 1), 4, increasing=True)
    return powers @ np.linalg.pinv(powers)


def residual_smooth(predictions: DataFrame, by=GROUP, block: int = 50_000) -> DataFrame:
    """Local cubic smoothing (Savitzky-Golay, up to 51 points) of the residuals in order of prediction.

    Positions are cut into blocks and every block also receives the rows within half a window of its borders, so
    each value is computed inside one block and no group has to sit in one task. The first and last rows of a
    group take their values from the cubic of the outermost window. Groups of at most 50 rows give no rows.
    """
    by = list(by)
    ranked = exact_rank(with_residuals(predictions), by, "yhat", ["sample_id"]).where("n_total > 50")
    half = 25  # above 50 rows the window is always the full 51 points
    window = 2 * half + 1
    if block < window:
        raise ValueError("a block must hold a full window")
    weights = cubic_weights(window)
    position = F.col("rank") - 1
    blocks = F.array_distinct(
        F.array(
            F.floor((position - 2 * half) / block), F.floor(position / block), F.floor((position + 2 * half) / block)
        )
    )
    last_block = F.floor((F.col("n_total") - 1) / block)
    spread = ranked.withColumn("_block", F.explode(blocks)).where(
        (F.col("_block") >= 0) & (F.col("_block") <= last_block)
    )
    schema = T.StructType(
        [f for f in ranked.select(*by, "sample_id", "yhat", "residual", "rank").schema.fields]
        + [T.StructField("smoothed", T.DoubleType())]
    )
    names = schema.fieldNames()

    def smooth(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank").reset_index(drop=True)
        n, start = int(pdf["n_total"].iloc[0]), int(pdf["rank"].iloc[0]) - 1
        values = pdf["residual"].to_numpy()
        at = pdf["rank"].to_numpy() - 1
        own = at // block == pdf["_block"].to_numpy()
        first = np.clip(at - half, 0, n - window) - start
        rows = np.flatnonzero(own)
        frames = np.lib.stride_tricks.sliding_window_view(values, window)[first[rows]]
        pdf = pdf.iloc[rows].copy()
        pdf["smoothed"] = np.einsum("ij,ij->i", frames, weights[at[rows] - start - first[rows]])
        return pdf[names]

    return spread.groupBy(*by, "_block").applyInPandas(smooth, schema)


def anderson_darling(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Anderson-Darling statistic against the normal with estimated mean and sample deviation.

    Equal values share one term: ranks i = a+1 … b contribute sum(2i - 1) = b² - a². So the input is the table of
    distinct values with cumulative counts, and no rank per row is needed.
    """
    params = df.groupBy(*by).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_std"))
    counts = attach(cumulative_counts(df, by, value), params, by)
    z = ratio(F.col(value) - F.col("_mean"), F.col("_std"))
    n, a = F.col("n_total").cast("double"), F.col("n_below").cast("double")
    b = a + F.col("n_at")
    squares = lambda hi, lo: (hi - lo) * (hi + lo)
    term = squares(b, a) * F.col("_log_cdf") + squares(n - a, n - b) * F.col("_log_sf")
    total = (
        counts.withColumn("_z", z).where(F.col("_z").isNotNull())
        .withColumns({"_log_cdf": log_normal_cdf(F.col("_z")), "_log_sf": log_normal_cdf(-F.col("_z"))})
        .groupBy(*by)
        .agg(F.max("n_total").alias("n"), F.sum(term / n).alias("_s"))
    )
    size = F.col("n").cast("double")
    # Fixed value: 0.787 is the 5 % point for estimated mean and deviation before the small-sample factor.
    return total.select(
        *by, "n", (-size - F.col("_s")).alias("statistic"),
        F.round(0.787 / (1 + 4 / size - 25 / size / size), 3).alias("critical_5pct"),
    ).withColumn("p_value", F.when(F.col("statistic") < F.col("critical_5pct"), 1.0).otherwise(0.01))


def qq_points(df: DataFrame, value: str, ties: list[str], by: list[str] = []) -> DataFrame:
    """Ordered values against normal quantiles at median plotting positions, with the fitted line."""
    ranked = exact_rank(df.select(*by, value, *ties), by, value, ties)
    n = F.col("n_total").cast("double")
    top = F.pow(F.lit(0.5), 1 / n)
    place = (
        F.when(F.col("rank") == F.col("n_total"), top)
        .when(F.col("rank") == 1, 1 - top)
        .otherwise((F.col("rank") - 0.3175) / (n + 0.365))
    )
    points = ranked.withColumn("theoretical", normal_quantile(place))
    line = points.groupBy(*by).agg(
        F.regr_slope(value, "theoretical").alias("slope"),
        F.regr_intercept(value, "theoretical").alias("intercept"),
        pearson(value, "theoretical").alias("r"),
    )
    return attach(points, line, by).withColumn("fitted", F.col("intercept") + F.col("slope") * F.col("theoretical"))
