"""Sizes that used to be limits, and rows at the edge of the definitions."""

from pyspark.sql import functions as F

from meterloom.operators import evaluate, features, joins, models


def test_any_number_of_categories(spark):
    df = spark.range(5000).select(F.format_string("c%05d", "id").alias("kind"), F.col("id").cast("double").alias("v"))
    prep = features.fit_preparation(df, numeric=("v",), categorical=("kind",))
    assert len(prep.feature_names()) == 5000
    rows = df.where("v % 1000 = 7")
    keys = {c: F.lit(1) for c in ("sample_id", "n_total", "split", "meter_id", "month_start", "cutoff_day", "bill")}
    x = features.model_matrix(rows.withColumns(keys), prep).select("x").collect()
    assert [sum(r["x"][1:]) for r in x] == [1.0] * 5 and {len(r["x"]) for r in x} == {5000}


def test_broadcasts_are_measured_in_bytes(spark):
    wide = spark.range(300).select("id", F.array_repeat(F.lit(1.5), 2000).alias("cuts"))
    table, fits = joins.settle(wide, 1 << 20)
    assert not fits and table.count() == 300
    _, fits = joins.settle(wide, 1 << 24)
    assert fits
    table, fits = joins.settle(spark.range(5000), 1 << 20)
    assert fits and table.count() == 5000
    table, fits = joins.settle(spark.range(5000), 1 << 10)
    assert not fits and table.count() == 5000


def test_constant_columns_become_zero(spark):
    df = spark.createDataFrame([(0.1 + 0.2,)] * 7 + [(None,)], "v double")
    prep = features.Preparation({"v": 0.3}, {"v": 1e-17})
    got = [r["v"] for r in features.standardize(df, prep).collect()]
    assert got.count(0.0) == 7 and got.count(None) == 1


def test_no_rows_have_no_best_model(spark):
    none = spark.createDataFrame([], "model string, split string, sample_id long, y double, yhat double")
    assert evaluate.best_model_predictions(none).count() == 0


def test_preparation_comes_back_as_stored(spark, tmp_path):
    prep = features.Preparation({"b": 1.5, "a": -2.0}, {"b": 0.1, "a": 3.0}, {"season": ["x", "y"], "month": [1, 2, 11]})
    features.save_preparation(spark, prep, str(tmp_path / "p"))
    back = features.load_preparation(spark, str(tmp_path / "p"))
    assert back.mean == prep.mean and list(back.mean) == list(prep.mean) and back.std == prep.std and back.categories == prep.categories


def test_all_coefficients_on_request(spark):
    fit = models.LinearFit(1.0, models.np.arange(1.0, 8.0))
    assert models.coefficient_report(spark, {"m": fit}, [f"x{i}" for i in range(7)], top=None).count() == 7
