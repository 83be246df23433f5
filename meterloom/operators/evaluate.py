"""Metrics, ranking and comparison over the long prediction table (model, split, sample_id, y, yhat)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterloom.functions import labels
from meterloom.functions.numeric import nan_to_null, ratio
from meterloom.operators.joins import attach, settle
from meterloom.operators.ranking import quantiles

GROUP = ["model", "split"]


def prediction_union(parts: dict[str, DataFrame]) -> DataFrame:
    """One long table from one table per model."""
    tagged = [df.withColumn("model", F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def prediction_alignment(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """Per model: predictions with a truth, predictions without, and truths without a prediction."""
    joined = predictions.select("model", "sample_id").join(
        truth.select("sample_id", F.lit(True).alias("_known")), "sample_id", "left"
    )
    counts = joined.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_predictions"), F.count("_known").alias("n_matched")
    )
    return attach(counts, truth.agg(F.count(F.lit(1)).alias("n_truth")), []).select(
        "model",
        "n_predictions",
        "n_matched",
        (F.col("n_predictions") - F.col("n_matched")).alias("n_without_truth"),
        (F.col("n_truth") - F.col("n_matched")).alias("n_without_prediction"),
        ((F.col("n_predictions") == F.col("n_matched")) & (F.col("n_truth") == F.col("n_matched"))).alias("aligned"),
    )


def with_residuals(predictions: DataFrame) -> DataFrame:
    y, yhat = nan_to_null(F.col("y")), nan_to_null(F.col("yhat"))
    return (
        predictions.withColumn("residual", y - yhat)
        .withColumn("abs_error", F.abs("residual"))
        .withColumn("pct_error", ratio(F.col("residual"), y) * 100)
    )


def model_metrics(predictions: DataFrame, by=GROUP) -> DataFrame:
    """R², MAE, MSE, RMSE, their ratio, and the largest error, in one aggregate.

    A constant target has R² 1 for a perfect fit and 0 otherwise.
    """
    r = with_residuals(predictions)
    sums = r.groupBy(*by).agg(
        F.count("residual").alias("n"),
        F.avg("abs_error").alias("mae"),
        F.avg(F.col("residual") * F.col("residual")).alias("mse"),
        F.max("abs_error").alias("max_error"),
        F.var_pop(F.when(F.col("residual").isNotNull(), F.col("y"))).alias("_var"),
        F.avg(F.when(F.col("residual").isNotNull(), F.col("y"))).alias("mean_y"),
    )
    r2 = F.when(F.col("_var") > 0, 1 - ratio(F.col("mse"), F.col("_var"))).otherwise(
        F.when(F.col("mse") == 0, 1.0).otherwise(0.0)
    )
    return sums.select(
        *by, "n", r2.alias("r2"), "mae", "mse", F.sqrt("mse").alias("rmse"),
        ratio(F.sqrt("mse"), F.col("mae")).alias("rmse_mae_ratio"), "max_error", "mean_y",
    )


def model_mape(predictions: DataFrame, by=GROUP) -> DataFrame:
    return with_residuals(predictions).groupBy(*by).agg(F.avg(F.abs("pct_error")).alias("mape"))


def rank_models(metrics: DataFrame, within: list[str] = []) -> DataFrame:
    """Rank by RMSE, model name as tie-break. ``metrics`` has one row per model, so the window is tiny."""
    position = F.row_number().over(W.partitionBy(*within).orderBy("rmse", "model"))
    return metrics.withColumn("rank", position).withColumn("is_best", F.col("rank") == 1)


def best_model(metrics: DataFrame, within: list[str] = []) -> DataFrame:
    return metrics.groupBy(*within).agg(F.min(F.struct("rmse", "model")).alias("_b")).select(
        *within, F.col("_b.model").alias("model"), F.col("_b.rmse").alias("rmse")
    )


def best_model_predictions(predictions: DataFrame, split: str = "test") -> DataFrame:
    """Rows of the model with the lowest RMSE on ``split``; its name becomes a pushed-down filter."""
    chosen = predictions.where(F.col("split") == split)
    best = best_model(model_metrics(chosen, ["model"])).first()
    name = None if best is None else best["model"]  # without rows there is no best model, and no row to return
    return chosen.where(F.col("model") == F.lit(name).cast("string"))


def metric_grades(metrics: DataFrame) -> DataFrame:
    """Verdicts on R², relative MAE and the RMSE to MAE ratio, and overall readiness."""
    mae_pct = ratio(F.col("mae"), F.col("mean_y")) * 100
    return metrics.select(
        *[c for c in GROUP if c in metrics.columns],
        labels.r2_grade(F.col("r2")).alias("r2_grade"),
        (F.col("r2") < 0.5).alias("low_r2"),
        mae_pct.alias("mae_pct"),
        labels.mae_grade(mae_pct).alias("mae_grade"),
        (ratio(F.col("rmse"), F.col("mean_y")) * 100).alias("rmse_pct"),
        labels.rmse_mae_grade(F.col("rmse_mae_ratio")).alias("ratio_grade"),
        labels.readiness(F.col("r2"), F.col("rmse_mae_ratio")).alias("readiness"),
    )


def model_spread(metrics: DataFrame, by=("split",)) -> DataFrame:
    """How far the models lie apart: best against worst (by RMSE) and the variation of RMSE."""
    ends = metrics.groupBy(*by).agg(
        F.min(F.struct("rmse", "model", "mae")).alias("b"),
        F.max(F.struct("rmse", "model", "mae")).alias("w"),
        (ratio(F.stddev_pop("rmse"), F.avg("rmse")) * 100).alias("rmse_cv_pct"),
    )
    gain = lambda c: (1 - ratio(F.col(f"b.{c}"), F.col(f"w.{c}"))) * 100
    return ends.select(
        *by,
        F.col("b.model").alias("best_model"),
        F.col("w.model").alias("worst_model"),
        gain("rmse").alias("rmse_gain_pct"),
        gain("mae").alias("mae_gain_pct"),
        "rmse_cv_pct",
        (F.col("rmse_cv_pct") < 5).alias("similar"),
    )


def comparison_with_times(metrics: DataFrame, times: DataFrame, by_id: bool = False) -> DataFrame:
    """Metrics with training seconds and rank.

    Times are matched on ``model`` when ``by_id``; otherwise a model takes the first time (by ``position``) whose
    lower-cased display name with underscores contains the model's name. Both tables have a row per model.
    """
    if by_id:
        joined = metrics.join(times.select("model", "training_seconds"), "model", "left")
        return rank_models(joined)
    name = F.replace(F.lower("model_name"), F.lit(" "), F.lit("_")).alias("_name")
    named, _ = settle(times.select("position", "training_seconds", name))
    matched = (
        metrics.join(named, F.contains(F.col("_name"), F.col("model")), "left")
        .groupBy(*metrics.columns)
        .agg(F.min(F.struct("position", "training_seconds")).alias("_t"))
        .select(*metrics.columns, F.col("_t.training_seconds").alias("training_seconds"))
    )
    return rank_models(matched)


def overfit_gap(metrics: DataFrame) -> DataFrame:
    """Train against test: RMSE gap, gap in percent of the train RMSE, R² gap, and the class."""
    at = lambda split, c: F.max(F.when(F.col("split") == split, F.col(c))).alias(f"{split}_{c}")
    wide = metrics.groupBy("model").agg(at("train", "rmse"), at("test", "rmse"), at("train", "r2"), at("test", "r2"))
    return wide.withColumns(
        {
            "rmse_gap": F.col("test_rmse") - F.col("train_rmse"),
            "rmse_gap_pct": ratio(F.col("test_rmse") - F.col("train_rmse"), F.col("train_rmse")) * 100,
            "r2_gap": F.col("train_r2") - F.col("test_r2"),
        }
    )


def fit_diagnosis(gaps: DataFrame) -> DataFrame:
    return gaps.select(
        "model", "rmse_gap_pct", "r2_gap", labels.overfit_class(F.col("rmse_gap_pct"), F.col("r2_gap")).alias("fit")
    )


def abs_error_percentiles(predictions: DataFrame, by=GROUP) -> DataFrame:
    return quantiles(
        with_residuals(predictions), list(by), "abs_error", {"p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95}
    )


def bias_summary(predictions: DataFrame, by=GROUP) -> DataFrame:
    """Counts and mean residual of both sides; 0 where a side is empty."""
    side = lambda cond, name: [
        F.count_if(cond).alias(f"n_{name}"),
        F.coalesce(F.avg(F.when(cond, F.col("residual"))), F.lit(0.0)).alias(f"mean_{name}"),
    ]
    return with_residuals(predictions).groupBy(*by).agg(
        *side(F.col("residual") > 0, "under"), *side(F.col("residual") < 0, "over"), F.count(F.lit(1)).alias("n")
    )


def bias_classes(predictions: DataFrame, by=GROUP) -> DataFrame:
    by = list(by)
    joined = (
        model_metrics(predictions, by)
        .join(bias_summary(predictions, by).drop("n"), by)
        .join(abs_error_percentiles(predictions, by), by)
    )
    return joined.select(
        *by,
        labels.accuracy_class(ratio(F.col("mae"), F.col("mean_y"))).alias("accuracy"),
        labels.bias_class(F.col("n_under"), F.col("n_over")).alias("bias"),
        labels.consistency_class(ratio(F.col("p75"), F.col("mean_y"))).alias("consistency"),
    )


def error_categories(predictions: DataFrame, by=GROUP) -> DataFrame:
    """Audit points: residual columns plus good / moderate / large against the group's MAE."""
    r = with_residuals(predictions)
    mae = r.groupBy(*by).agg(F.avg("abs_error").alias("mae"))
    return attach(r, mae, list(by)).withColumn(
        "error_category", labels.error_category(F.col("abs_error"), F.col("mae"))
    )


def audit_points(predictions: DataFrame, by=GROUP) -> DataFrame:
    """The audit table, largest errors first (a range-partitioned sort)."""
    return error_categories(predictions, by).drop("mae").orderBy(F.desc("abs_error"), "model", "sample_id")


def error_category_counts(predictions: DataFrame, by=GROUP) -> DataFrame:
    """Rows and share of each category; a category without rows is listed with 0."""
    flags = error_categories(predictions, by).groupBy(*by).agg(
        F.count("error_category").alias("total"),
        *[F.count_if(F.col("error_category") == c).alias(c) for c in ("good", "moderate", "large")],
    )
    rows = F.array(
        *[F.struct(F.lit(c).alias("error_category"), F.col(c).alias("n")) for c in ("good", "moderate", "large")]
    )
    return flags.select(*by, "total", F.inline(rows)).select(
        *by, "error_category", "n", (ratio(F.col("n"), F.col("total")) * 100).alias("share_pct")
    )


def worst_predictions(predictions: DataFrame, k: int = 5, by=GROUP) -> DataFrame:
    """The ``k`` largest errors per group. The rank filter is applied before the shuffle as well as after."""
    order = W.partitionBy(*by).orderBy(F.desc("abs_error"), "sample_id")
    return with_residuals(predictions).withColumn("position", F.row_number().over(order)).where(F.col("position") <= k)


def plot_bounds(predictions: DataFrame, by=GROUP) -> DataFrame:
    """Limits of the identity line and the two-deviation band of the residuals."""
    return with_residuals(predictions).groupBy(*by).agg(
        F.least(F.min("y"), F.min("yhat")).alias("axis_low"),
        F.greatest(F.max("y"), F.max("yhat")).alias("axis_high"),
        (F.stddev_pop("residual") * 2).alias("band"),
    )


def interval_coverage(intervals: DataFrame, by: list[str]) -> DataFrame:
    """Coverage of per-member predictions: mean ± 1.959964 population deviations of the array ``members``.

    Rows may come with ``member_mean`` and ``member_std`` in its place.
    """
    n = F.size("members").cast("double")
    mean = F.aggregate("members", F.lit(0.0), lambda a, x: a + x) / n
    var = F.aggregate("members", F.lit(0.0), lambda a, x: a + (x - F.col("member_mean")) * (x - F.col("member_mean"))) / n
    z = 1.959964
    rows = intervals if "members" not in intervals.columns else intervals.withColumn("member_mean", mean).withColumn("member_std", F.sqrt(var))
    half = z * F.col("member_std")
    covered = F.col("y").between(F.col("member_mean") - half, F.col("member_mean") + half)
    out = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("member_std").alias("mean_std"),
        (2 * z * F.avg("member_std")).alias("mean_width"),
        (F.avg(F.when(covered, 1.0).otherwise(0.0)) * 100).alias("coverage_pct"),
    )
    return out.withColumn("calibration", labels.calibration_class(F.col("coverage_pct")))


def split_summary(df: DataFrame, value: str, by=("split",)) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std_sample"),
        F.stddev_pop(value).alias("std_pop"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
