"""Models against closed forms in NumPy and Spark ML."""

import dataclasses
import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from meterloom.operators import features, models
from meterloom.plans import forecast
from meterloom.sources import driver_tables as src
from tests.conftest import SF


@pytest.fixture(scope="module")
def xy(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(120, 4))
    x[:, 3] = x[:, 0] + x[:, 1]  # collinear, as totals are
    y = x @ [2.0, -1.0, 0.0, 0.5] + 3 + rng.normal(scale=0.3, size=120)
    df = spark.createDataFrame(
        pd.DataFrame({"x": x.tolist(), "label": y, "sample_id": np.arange(1, 121)})
    ).withColumn("n_total", F.lit(120).cast("bigint"))
    return x, y, df.repartition(3)


def test_product_sums(xy):
    x, y, df = xy
    full = np.column_stack([np.ones(len(y)), x, y])
    assert models.product_sums(df)[0] == pytest.approx(full.T @ full)
    folds = models.product_sums(features.kfolds(df), "fold")
    assert [int(folds[i][0, 0]) for i in range(5)] == [24] * 5
    assert sum(folds.values()) == pytest.approx(full.T @ full)


def test_ols_is_the_shortest_solution(xy):
    x, y, df = xy
    fit = models.fit_ols(models.product_sums(df)[0])
    centred = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=1e-10)[0]
    assert fit.coef == pytest.approx(centred, abs=1e-8)
    assert fit.intercept == pytest.approx(y.mean() - x.mean(0) @ centred)
    got = df.select(fit.column().alias("p"), "sample_id").orderBy("sample_id").toPandas()["p"].to_numpy()
    assert got == pytest.approx(x @ fit.coef + fit.intercept)
    assert fit.squared_error(models.product_sums(df)[0]) == pytest.approx(((y - got) ** 2).sum())


def test_ridge_closed_form_and_spark_ml(xy):
    x, y, df = xy
    fit = models.fit_ridge(models.product_sums(df)[0], 10.0)
    xc = x - x.mean(0)
    assert fit.coef == pytest.approx(np.linalg.solve(xc.T @ xc + 10 * np.eye(4), xc.T @ (y - y.mean())))
    ml = LinearRegression(
        elasticNetParam=0.0, standardization=False, regParam=10.0 * y.std() / len(y), solver="normal"
    ).fit(df.withColumn("features", array_to_vector("x")))
    assert fit.coef == pytest.approx(ml.coefficients.toArray(), abs=1e-8)


def test_lasso_optimality_and_spark_ml(xy):
    x, y, df = xy
    sums = models.product_sums(df)[0]
    for alpha in (0.01, 0.1, 1.0, 100.0):
        fit = models.fit_lasso_many([(sums, alpha)], tol=1e-9)[0]
        slope = (x - x.mean(0)).T @ (y - fit.intercept - x @ fit.coef) / len(y)
        assert np.abs(slope).max() <= alpha + 1e-3
        ml = LinearRegression(
            elasticNetParam=1.0, standardization=False, regParam=alpha, maxIter=500, tol=1e-12
        ).fit(df.withColumn("features", array_to_vector("x")))
        loss = lambda c, b: ((y - b - x @ c) ** 2).mean() / 2 + alpha * np.abs(c).sum()
        assert loss(fit.coef, fit.intercept) == pytest.approx(loss(ml.coefficients.toArray(), ml.intercept), rel=1e-4)
    assert not models.fit_lasso_many([(sums, 100.0)])[0].coef.any()


def test_problems_solved_together_equal_single_ones(xy):
    _, _, df = xy
    sums = models.product_sums(df)[0]
    many = models.fit_lasso_many([(sums, a) for a in (0.01, 0.5, 50.0)])
    for fit, a in zip(many, (0.01, 0.5, 50.0)):
        assert fit.coef == pytest.approx(models.fit_lasso_many([(sums, a)])[0].coef)


def test_grid_scores_against_loops(xy):
    x, y, df = xy
    sums = models.product_sums(features.kfolds(df), "fold")
    expected = []
    for held in np.array_split(np.arange(120), 5):
        train = np.setdiff1d(np.arange(120), held)
        xc, yc = x[train] - x[train].mean(0), y[train] - y[train].mean()
        w = np.linalg.solve(xc.T @ xc + np.eye(4), xc.T @ yc)
        expected.append(((y[held] - y[train].mean() - (x[held] - x[train].mean(0)) @ w) ** 2).mean())
    assert models.grid_scores("ridge", sums, (1.0,))[1.0] == pytest.approx(-np.mean(expected))
    fit, alpha, scores = models.fit_tuned("ridge", sums)
    assert alpha == max(scores, key=scores.get) and len(scores) == 6


def test_time_series_folds_of_53_rows(spark):
    df = spark.range(1, 54).select(F.col("id").alias("sample_id"), F.lit(53).cast("bigint").alias("n_total"))
    got = features.ts_folds(df).groupBy("fold").agg(F.min("sample_id"), F.max("sample_id")).orderBy("fold").collect()
    assert [tuple(r) for r in got] == [(0, 1, 13), (1, 14, 21), (2, 22, 29), (3, 30, 37), (4, 38, 45), (5, 46, 53)]


def test_time_series_cv_against_loops(xy):
    x, y, df = xy
    row = models.time_series_cv(
        models.product_sums(features.ts_folds(df), "fold"), {"m": lambda ms: [models.fit_ridge(m, 1.0) for m in ms]}
    )[0]
    scores = []
    for k in range(5):
        start = 120 - (5 - k) * 20
        xt, yt = x[:start], y[:start]
        xc = xt - xt.mean(0)
        w = np.linalg.solve(xc.T @ xc + np.eye(4), xc.T @ (yt - yt.mean()))
        e = y[start:start + 20] - yt.mean() - (x[start:start + 20] - xt.mean(0)) @ w
        scores.append(np.sqrt((e**2).mean()))
    assert row["mean_rmse"] == pytest.approx(np.mean(scores))
    assert row["std_rmse"] == pytest.approx(np.std(scores))
    assert row["ci_high"] - row["mean_rmse"] == pytest.approx(2.776445 * np.std(scores) / 5**0.5, rel=1e-6)


def scenario_like(spark, n=50):
    rng = np.random.default_rng(0)
    base = dt.date(2024, 1, 1)
    rows = []
    for i in range(n):
        d = base + dt.timedelta(days=int(rng.integers(0, 200)))
        rows.append((i % 7, d.replace(day=1), 10, d, d.month, float(rng.normal()), 5.0, float(i)))
    return spark.createDataFrame(
        rows,
        "meter_id bigint, month_start date, cutoff_day int, simulation_date date, month int, a double, c double, bill double",
    )


def test_split_takes_the_newest_fifth(spark):
    df = scenario_like(spark)
    got = features.temporal_split(df).toPandas()
    order = got.sort_values(["simulation_date", "meter_id", "cutoff_day"])
    assert (order["split"].to_numpy() == ["train"] * 40 + ["test"] * 10).all()
    per = features.temporal_split(df, per_meter=True).toPandas()
    for _, g in per.groupby("meter_id"):
        assert (g["split"] == "test").sum() == int(len(g) * 0.2)
        assert g[g["split"] == "test"]["simulation_date"].min() >= g[g["split"] == "train"]["simulation_date"].max()


def test_preparation_sees_train_rows_only(spark):
    df = scenario_like(spark).withColumn("split", F.when(F.col("month") < 5, "train").otherwise("test"))
    prep = features.fit_preparation(df.where("split = 'train'"), numeric=("a", "c"), categorical=("month",))
    out = features.standardize(df, prep).where("split = 'train'").agg(
        F.avg("a").alias("m"), F.stddev_pop("a").alias("s"), F.max("c").alias("c")
    ).first()
    assert out.m == pytest.approx(0, abs=1e-12) and out.s == pytest.approx(1) and out.c == 0.0
    assert [n for n, _, _ in prep.one_hot_columns()] == ["month_2", "month_3", "month_4"]
    unseen = features.one_hot(df, prep).where("month >= 5").agg(*[F.max(f"month_{m}") for m in (2, 3, 4)]).first()
    assert tuple(unseen) == (0.0, 0.0, 0.0)
    altered = df.withColumn("a", F.when(F.col("split") == "test", F.col("a") * 100).otherwise(F.col("a")))
    again = features.fit_preparation(altered.where("split = 'train'"), numeric=("a", "c"), categorical=("month",))
    assert again.mean == pytest.approx(prep.mean) and again.categories == prep.categories


@pytest.fixture(scope="module")
def training(spark):
    rows = forecast.scenario_table(src.readings(spark, SF), src.weather(spark, SF), src.stations(spark, SF))
    return forecast.fit_linear_family(forecast.prepare(rows))


def kept_ids(training):
    return [r.sample_id for r in training.matrix.select("sample_id").collect()]


def test_training_end_to_end(spark, training, tmp_path):
    from meterloom.operators import evaluate

    p = forecast.long_predictions(forecast.with_linear_predictions(training))
    rmse = {
        (r.model, r.split): r.rmse for r in evaluate.model_metrics(p).collect()
    }
    assert len(rmse) == 8
    assert rmse["linear_multiple", "train"] <= rmse["ridge", "train"] + 1e-9 <= rmse["linear_baseline", "train"] + 1e-6
    sizes = {r.split: r.n for r in evaluate.split_summary(p.where("model = 'ridge'"), "y").collect()}
    total = sum(sizes.values())
    # the newest fifth of all rows is test; rows with a missing feature keep their place and are left out of both
    places = {(r.split, r.usable): r.n for r in training.rows.withColumn("usable", F.col("sample_id").isin(kept_ids(training))).groupBy("split", "usable").agg(F.count(F.lit(1)).alias("n")).collect()}
    everything = total + training.left_out
    assert places.get(("test", True), 0) + places.get(("test", False), 0) == int(everything * 0.2)
    assert sizes["test"] == places["test", True] and sizes["train"] == places["train", True] and training.left_out > 0
    assert training.sums[0, 0] == sizes["train"]
    names = training.prep.feature_names()
    models.save_fits(spark, training.fits, names, str(tmp_path / "fits"))
    back = models.load_fits(spark, str(tmp_path / "fits"))
    assert set(back) == set(training.fits)
    assert back["lasso"].coef == pytest.approx(training.fits["lasso"].coef)
    assert forecast.linear_cv(training).count() == 4
    assert training.watch.table(spark).count() == 4
    report = models.coefficient_report(spark, training.fits, names).where("model = 'linear_baseline'").first()
    assert (report.feature, report.n_nonzero) == ("cum_total_kwh", 1)


def test_other_models(spark, training):
    from meterloom.operators import evaluate

    poly, fit = forecast.polynomial_model(training)
    p = len(training.prep.feature_names())
    assert len(fit.coef) == p * (p + 3) // 2
    rmse = lambda wide: {r.split: r.rmse for r in evaluate.model_metrics(forecast.long_predictions(wide)).collect()}
    linear = rmse(training.matrix.withColumn("yhat_l", training.fits["linear_multiple"].column()))
    assert rmse(poly)["train"] <= linear["train"] * 1.001
    assert rmse(forecast.rff_model(training, width=50))["train"] > 0
    assert rmse(models.fit_huber(training.train, 5).transform(training.matrix))["train"] > 0


def test_registered_forest_has_its_full_size():
    import inspect

    from checks import queries
    from meterloom.operators import forest as forests

    assert (forests.TREES, forests.DEPTH, forests.MIN_LEAF) == (300, 30, 2)
    assert inspect.signature(forecast.fit_forest).parameters["trees"].default == 300
    assert inspect.signature(forests.fit_forest).parameters["depth"].default == 30
    assert "fit_forest(trained(spark, sf))" in inspect.getsource(queries._forest)


@pytest.fixture(scope="module")
def eight(spark, training):
    return forecast.fit_other_models(dataclasses.replace(training, others={}, forest=None), trees=5, huber_iterations=5, width=20)


def test_all_eight_models_predict_every_usable_row(spark, eight):
    from meterloom.operators import evaluate

    p = forecast.long_predictions(forecast.with_all_predictions(eight)).cache()
    usable = eight.matrix.count()
    assert {r.model: r["count"] for r in p.groupBy("model").count().collect()} == dict.fromkeys(EIGHT, usable)
    metrics = evaluate.model_metrics(p)
    assert metrics.count() == 16 and evaluate.overfit_gap(metrics).count() == 8
    assert sorted(r["rank"] for r in evaluate.rank_models(metrics, ["split"]).where("split = 'test'").collect()) == list(range(1, 9))
    assert set(eight.watch.seconds) >= EIGHT


EIGHT = {"linear_baseline", "linear_multiple", "ridge", "lasso", "polynomial_deg2", "huber_linear", "rff_ridge", "random_forest"}


def test_stored_models_score_as_those_they_were_stored_from(spark, eight, tmp_path):
    from meterloom.plans import model_store

    model_store.save(eight, str(tmp_path))
    again = forecast.long_predictions(model_store.load(spark, str(tmp_path)).predict(eight.rows))
    direct = forecast.long_predictions(forecast.with_all_predictions(eight))
    key = lambda df: sorted((r.model, r.sample_id, r.yhat) for r in df.collect())
    assert key(again) == key(direct)


def test_cross_validation_of_all_models(spark, eight):
    """Expanding windows: the folds of Huber regression and the forest against fits on the rows before each fold."""
    from meterloom.operators import forest as forests

    got = {r.model: r for r in forecast.cross_validation(eight, trees=3, huber_iterations=5).collect()}
    assert set(got) == EIGHT
    linear = {r.model: r for r in forecast.linear_cv(eight).collect()}
    assert all(got[m].mean_rmse == pytest.approx(linear[m].mean_rmse) for m in linear)
    rows = features.ts_folds(eight.train.withColumn("n_total", F.lit(eight.train.count())))
    scores = []
    train = forecast._fold_rows(eight, 5).select("sample_id", "fold", "label", "x")
    for k in range(1, 6):
        forest = forests.fit_forest(train.where(F.col("fold") < k), 3)
        pdf = forecast.with_forest_predictions(forest, train.where(F.col("fold") == k)).toPandas()
        scores.append(float(np.sqrt(((pdf.label - pdf.yhat_random_forest) ** 2).mean())))
    assert rows.where("fold = 5").count() > 0
    assert got["random_forest"].max_rmse == pytest.approx(max(scores), rel=0.2) and got["random_forest"].mean_rmse == pytest.approx(np.mean(scores), rel=0.2)


def test_training_log_keeps_runs_apart(spark, eight, tmp_path):
    from meterloom.operators import evaluate
    from meterloom.sources import training_log

    path = str(tmp_path / "log")
    times = eight.watch.table(spark)
    scores = evaluate.model_metrics(forecast.long_predictions(forecast.with_all_predictions(eight)).where("split = 'test'"), ["model"])
    training_log.append_run(path, "a", times, scores, models.forest_report(spark, eight.forest, eight.prep.feature_names()))
    training_log.append_run(path, "b", times.withColumn("training_seconds", F.lit(1.0)))
    training_log.append_run(path, "b", times.withColumn("training_seconds", F.lit(2.0)))
    assert {(r.run, r.training_seconds) for r in training_log.read_log(spark, path, "times").collect() if r.run == "b"} == {("b", 2.0)}
    assert training_log.read_log(spark, path, "importances", "a").count() == 5
    table = evaluate.comparison_with_times(training_log.read_log(spark, path, "scores", "a"), training_log.read_log(spark, path, "times", "a"), by_id=True)
    assert {r.model for r in table.where("training_seconds is not null").collect()} == EIGHT
