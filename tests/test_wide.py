"""Fits with more features than sums of products are made for."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterloom.operators import features, models


@pytest.fixture(scope="module")
def many(spark):
    """5,001 categories, each seen twice, a number, and a target that both decide."""
    effect = F.pmod(F.xxhash64("kind"), F.lit(100)) / 10.0
    rows = spark.range(10_002).select(
        F.format_string("c%05d", F.col("id") % 5001).alias("kind"), (F.sin("id") * 3).alias("v"), F.col("id").alias("sample_id"),
        *[F.lit(1).alias(c) for c in ("n_total", "meter_id", "month_start", "cutoff_day")], F.lit("train").alias("split"),
    )
    return rows.withColumn("bill", 4.0 + 2 * F.col("v") + effect).repartition(4)


def test_five_thousand_one_hot_columns(spark, many, monkeypatch):
    prep = features.fit_preparation(many, numeric=("v",), categorical=("kind",))
    matrix = features.model_matrix(many, prep)
    assert len(prep.feature_names()) == 5001 > models.MAX_FEATURES
    first = matrix.orderBy("sample_id").limit(3).select("features").collect()
    assert [r.features.size for r in first] == [5001] * 3 and [len(r.features.indices) for r in first] == [1, 2, 2]
    monkeypatch.setattr(models, "product_sums", None)  # nothing wide is summed up or collected
    fit = models.fit_iterative(matrix, "ridge", 1e-4)
    error = matrix.select((F.col("label") - fit.column_of()).alias("e")).agg(F.sqrt(F.avg(F.col("e") * F.col("e")))).first()[0]
    assert len(fit.coef) == 5001 and error < 0.05
    assert fit.coef[0] / prep.std["v"] == pytest.approx(2, abs=0.02)


def test_sparse_rows_equal_dense_ones(many):
    few = many.where("kind < 'c00040' and sample_id % 3 < 2").withColumn("other", F.col("sample_id") % 4)
    prep = features.fit_preparation(few.where("kind <> 'c00039'"), numeric=("v",), categorical=("kind", "other"))
    rows = lambda dense: sorted((r.sample_id, r.x) for r in features.model_matrix(few, prep, dense=dense).select("sample_id", "x").collect())
    dense, sparse = rows(10_000), rows(1)
    assert [i for i, _ in dense] == [i for i, _ in sparse] and np.allclose([x for _, x in dense], [x for _, x in sparse])


def test_iterative_fits_equal_the_closed_forms(many):
    few = many.where("kind < 'c00012'")
    prep = features.fit_preparation(few, numeric=("v",), categorical=("kind",))
    matrix = features.model_matrix(few.unionByName(few.withColumn("bill", F.col("bill") + F.cos("sample_id"))), prep).withColumn("fold", (F.col("sample_id") % 3).cast("int"))
    sums = models.product_sums(matrix)[0]
    pairs = [("ols", 0.0, models.fit_ols(sums)), ("ridge", 3.0, models.fit_ridge(sums, 3.0)), ("lasso", 0.05, models.fit_lasso_many([(sums, 0.05)], tol=1e-9)[0])]
    for kind, alpha, want in pairs:
        got = models.fit_iterative(matrix, kind, alpha, max_iter=100, tol=1e-12)
        assert got.coef == pytest.approx(want.coef, abs=2e-3) and got.intercept == pytest.approx(want.intercept, abs=2e-3)
    folds = models.product_sums(matrix, "fold")
    _, alpha, scores = models.fit_tuned("ridge", folds, (0.1, 10.0))
    _, wide_alpha, wide_scores = models.fit_tuned_wide("ridge", matrix, alphas=(0.1, 10.0), max_iter=60)
    assert wide_alpha == alpha
    # the held-out fold's own rows decide y's deviation in the estimator's scaling, so scores agree closely, not exactly
    assert [wide_scores[a] for a in (0.1, 10.0)] == pytest.approx([scores[a] for a in (0.1, 10.0)], rel=0.02)
    assert models.kernel_gamma_of(matrix) == pytest.approx(models.kernel_gamma(sums))


def test_the_width_decides_before_any_job(many, monkeypatch):
    few = many.where("kind < 'c00012'")
    prep = features.fit_preparation(few, numeric=("v",), categorical=("kind",))
    matrix = features.model_matrix(few, prep)
    by_sums = models.fit_least_squares(matrix)
    monkeypatch.setattr(models, "MAX_FEATURES", 5)
    monkeypatch.setattr(models, "product_sums", None)
    by_rows = models.fit_least_squares(matrix)
    yhat = lambda fit: [r[0] for r in matrix.orderBy("sample_id").select(fit.column()).collect()]
    assert yhat(by_rows) == pytest.approx(yhat(by_sums), abs=1e-2)


def test_a_wide_family_is_trained_and_scored(spark, monkeypatch):
    """The whole chain over rows instead of sums, on a table that either way can fit."""
    from meterloom.plans import forecast
    from meterloom.sources import driver_tables as src
    from tests.conftest import SF

    rows = forecast.scenario_table(src.readings(spark, SF), src.weather(spark, SF), src.stations(spark, SF)).where("meter_id < 5")
    by_sums = forecast.fit_linear_family(forecast.prepare(rows))
    monkeypatch.setattr(models, "MAX_FEATURES", 5)
    by_rows = forecast.fit_linear_family(forecast.prepare(rows), alphas=(1.0,), max_iter=10)
    assert by_rows.fold_sums == {} and set(by_rows.fits) == set(by_sums.fits)
    rmse = lambda t, m: t.matrix.where("split = 'train'").agg(F.sqrt(F.avg(F.pow(F.col("label") - t.fits[m].column(), 2)))).first()[0]
    assert rmse(by_rows, "linear_baseline") == pytest.approx(rmse(by_sums, "linear_baseline"), rel=1e-9)
    for m in ("linear_multiple", "ridge", "lasso"):  # a few steps only: between the best line on all features and no line
        assert rmse(by_sums, "linear_multiple") <= rmse(by_rows, m) * 1.001 and rmse(by_rows, m) < by_rows.train.agg(F.stddev_pop("label")).first()[0]
    by_rows.fits["linear_multiple"] = models.fit_iterative(by_rows.folds, "ols", max_iter=400)
    assert rmse(by_rows, "linear_multiple") == pytest.approx(rmse(by_sums, "linear_multiple"), rel=0.01)
