import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterloom.operators import diagnostics, evaluate, stats


def table(spark, y, yhat, model="m", split="test"):
    rows = [(model, split, i, float(a), float(b)) for i, (a, b) in enumerate(zip(y, yhat))]
    return spark.createDataFrame(rows, "model string, split string, sample_id bigint, y double, yhat double")


@pytest.fixture(scope="module")
def four(spark):
    return table(spark, [10, 20, 30, 40], [12, 18, 33, 39])


def test_metrics(four):
    m = evaluate.model_metrics(four).first()
    assert (m.mae, m.mse, m.max_error, m.n) == (2.0, 4.5, 3.0, 4)
    assert m.rmse == pytest.approx(2.121320, abs=1e-6)
    assert m.r2 == pytest.approx(0.964)
    assert m.rmse_mae_ratio == pytest.approx(1.060660, abs=1e-6)
    assert evaluate.model_mape(four).first().mape == pytest.approx(10.625)


def test_bias_categories_percentiles(four):
    b = evaluate.bias_summary(four).first()
    assert (b.n_under, b.mean_under, b.n_over, b.mean_over) == (2, 1.5, 2, -2.5)
    counts = {r.error_category: r.n for r in evaluate.error_category_counts(four).collect()}
    assert counts == {"good": 3, "moderate": 1, "large": 0}
    p = evaluate.abs_error_percentiles(four).first()
    assert (p.p50, p.p75, p.p90, p.p95) == pytest.approx((2, 2.25, 2.7, 2.85))


def test_constant_target(spark):
    assert evaluate.model_metrics(table(spark, [5, 5], [5, 5])).first().r2 == 1.0
    m = evaluate.model_metrics(table(spark, [5, 5], [5, 6])).first()
    assert m.r2 == 0.0
    assert evaluate.model_metrics(table(spark, [5, 5], [5, 5])).first().rmse_mae_ratio is None


def test_nan_predictions_count_as_missing(spark):
    m = evaluate.model_metrics(table(spark, [1, 2, 3], [1, float("nan"), 4])).first()
    assert (m.n, m.mae, m.max_error) == (2, 0.5, 1.0)


def test_variance_ratio(spark):
    res = [1, -1, 0, 5, 3, -3, 0]
    yhat = list(range(1, 8))
    v = diagnostics.variance_ratio(table(spark, [a + b for a, b in zip(yhat, res)], yhat)).first()
    assert (v.var_low, v.var_high, v.variance_ratio) == (1.0, 2.25, 2.25)
    assert diagnostics.variance_ratio(table(spark, [1, 1, 1], [1, 2, 3])).first().variance_ratio == 1.0


def test_smoothing_reproduces_a_cubic_and_matches_a_direct_fit(spark):
    rng = np.random.default_rng(0)
    yhat = np.sort(rng.normal(size=200))
    res = rng.normal(size=200)
    expected = []
    for i in range(200):
        lo = min(max(i - 25, 0), 200 - 51)
        x = np.arange(51) - 25.0
        expected.append(np.polyval(np.polyfit(x, res[lo:lo + 51], 3), i - lo - 25))
    df = table(spark, yhat + res, yhat)
    for block in (10**6, 60, 51):
        got = diagnostics.residual_smooth(df, block=block).orderBy("rank").toPandas()
        assert got["smoothed"].to_numpy() == pytest.approx(np.array(expected), abs=1e-8)
    assert diagnostics.residual_smooth(table(spark, range(50), range(50))).count() == 0


def test_anderson_darling_against_the_definition(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=300), [0.5] * 40])
    z = np.sort((x - x.mean()) / x.std(ddof=1))
    cdf = np.array([0.5 * (1 + __import__("math").erf(v / 2**0.5)) for v in z])
    n = len(z)
    i = np.arange(1, n + 1)
    expected = -n - np.sum((2 * i - 1) / n * (np.log(cdf) + np.log(1 - cdf[::-1])))
    df = spark.createDataFrame(pd.DataFrame({"g": "a", "x": x}))
    assert diagnostics.anderson_darling(df, "x", ["g"]).first().statistic == pytest.approx(expected)


def test_qq_points_are_ordered_and_straight_for_normal_data(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(500), "x": rng.normal(10, 2, 500)}))
    q = diagnostics.qq_points(df, "x", ["id"]).orderBy("rank").toPandas()
    assert q["theoretical"].is_monotonic_increasing and q["x"].is_monotonic_increasing
    assert q["theoretical"].iloc[0] == pytest.approx(-q["theoretical"].iloc[-1])
    assert q["slope"].iloc[0] == pytest.approx(2, abs=0.3) and q["r"].iloc[0] > 0.99


def test_comparison_takes_the_first_containing_name(spark):
    times = spark.createDataFrame(
        [(0, "ridge", "Ridge Regression", 1.0), (1, "svr", "Ridge Again", 2.0)],
        "position int, model string, model_name string, training_seconds double",
    )
    p = evaluate.prediction_union(
        {m: table(spark, [1, 2], [1, 3]).drop("model") for m in ("ridge", "linear_multiple")}
    )
    metrics = evaluate.model_metrics(p, ["model"])
    by_name = {r.model: r.training_seconds for r in evaluate.comparison_with_times(metrics, times).collect()}
    assert by_name == {"ridge": 1.0, "linear_multiple": None}
    by_id = {r.model: r["rank"] for r in evaluate.comparison_with_times(metrics, times, by_id=True).collect()}
    assert by_id == {"linear_multiple": 1, "ridge": 2}


def test_adjusted_moments_match_pandas(spark):
    x = np.random.default_rng(4).gamma(2, 3, 77)
    m = stats.moments(spark.createDataFrame(pd.DataFrame({"x": x})), ["x"]).first()
    s = pd.Series(x)
    assert (m.skew_adj, m.kurt_adj) == pytest.approx((s.skew(), s.kurt()))


def test_histogram_matches_numpy(spark):
    x = np.random.default_rng(5).normal(size=400)
    got = stats.histogram(spark.createDataFrame(pd.DataFrame({"x": x})), "x", 20).toPandas().set_index("bin")
    counts, edges = np.histogram(x, 20)
    full = got["n"].reindex(range(20)).fillna(0).to_numpy()
    assert (full == counts).all()
    density, _ = np.histogram(x, 20, density=True)
    assert got["density"].reindex(range(20)).fillna(0).to_numpy() == pytest.approx(density)


def test_constant_column_histogram_and_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert stats.histogram(df, "a", 5).first().n == 2
    assert stats.correlation_pairs(df, ["a", "b"]).first().r is None


def test_worst_predictions_limit_before_the_shuffle(spark):
    df = table(spark, range(100), [0] * 100)
    worst = evaluate.worst_predictions(df)
    assert [r.sample_id for r in worst.orderBy("position").collect()] == [99, 98, 97, 96, 95]
    plan = worst._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_report_tables_run(four):
    from meterloom.plans.forecast import report_tables

    for name, df in report_tables(four).items():
        assert df.count() >= 1 or name == "overfit", name


def test_residual_findings_cover_all_checks(four):
    found = {r.check for r in diagnostics.residual_findings(four).collect()}
    assert found == {"bias", "normality", "skewness", "kurtosis", "variance", "outliers", "improvement"}


def test_coverage(spark):
    df = spark.createDataFrame(
        [("t", 1.0, [0.0, 2.0]), ("t", 9.0, [0.0, 2.0])], "split string, y double, members array<double>"
    )
    c = evaluate.interval_coverage(df, ["split"]).first()
    assert (c.n, c.mean_std, c.coverage_pct, c.calibration) == (2, 1.0, 50.0, "under_calibrated")
    assert c.mean_width == pytest.approx(2 * 1.959964)


def test_best_model_prefers_low_rmse_then_name(spark):
    m = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.5)], "model string, rmse double")
    assert evaluate.best_model(m).first().model == "c"
    assert evaluate.best_model(m.where(F.col("model") != "c")).first().model == "a"
