import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterloom import schemas
from meterloom.functions.numeric import missing_as_null
from meterloom.operators import monthly, scenarios, series
from meterloom.operators import weather as wx
from meterloom.plans import forecast
from meterloom.sources import driver_tables, files


def test_household_files(spark, tmp_path):
    meter = tmp_path / "meter.csv"
    meter.write_text("Data da Leitura;Vazio;Ponta;Cheias;Estado\n2024-01-01;1;2;3;ok\n2024-01-02;4;;5;ok\n")
    r = files.read_household_csv(spark, str(meter), schemas.READINGS_HEADER, "meter_id", 1)
    assert [tuple(x) for x in r.orderBy("read_date").collect()] == [
        (1, dt.date(2024, 1, 1), 1.0, 2.0, 3.0, "ok"), (1, dt.date(2024, 1, 2), 4.0, None, 5.0, "ok")
    ]
    sky = tmp_path / "weather.csv"
    sky.write_text("Date;Temperature_Max_C;Humidity_Mean_%\n2024-01-01;10;80\n")
    w = files.read_household_csv(spark, str(sky), schemas.WEATHER_HEADER, "station_id", 1)
    assert w.columns == ["station_id", "date", "tmax", "tmin", "humidity", "rain", "uv"]
    assert (w.first().tmax, w.first().tmin) == (10.0, None)


def test_csv_round_trip_and_missing_weather(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), 1.5, None, 2.25, "ok")], schemas.READINGS)
    files.write_csv(df, str(tmp_path / "r"), sep=";")
    assert files.read_readings(spark, str(tmp_path / "r")).collect() == df.collect()
    assert files.read_weather(spark, None).count() == 0
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "x.csv").write_text("meter_id;read_date;reg_offpeak;reg_peak;reg_shoulder;state\n1;2024-01-01;abc;1;1;ok\n")
    with pytest.raises(Exception):
        files.read_readings(spark, str(bad)).collect()


def test_fixed_decimals(spark, tmp_path):
    files.write_csv(spark.createDataFrame([(1, 0.125)], "a int, b double"), str(tmp_path / "d"), digits=4)
    assert spark.read.option("header", True).csv(str(tmp_path / "d")).first().b == "0.1250"


def test_prediction_folders_and_flat_files(spark, tmp_path):
    p = spark.createDataFrame([("ridge", "test", 1, 1.0, 2.0), ("lasso", "train", 1, 1.0, 3.0)], schemas.PREDICTIONS)
    files.write_predictions(p, str(tmp_path / "p"))
    back = files.read_predictions(spark, str(tmp_path / "p"))
    assert sorted((r.model, r.split, r.yhat) for r in back.collect()) == [("lasso", "train", 3.0), ("ridge", "test", 2.0)]
    plan = back.where("split = 'test'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    for model in ("ridge", "svr_linear"):
        p.where("split = 'test'").drop("model", "split").write.parquet(str(tmp_path / "flat" / f"y_pred_{model}_test"))
    flat = files.read_flat_predictions(spark, str(tmp_path / "flat" / "y_pred_*_test"))
    assert sorted({r.model for r in flat.collect()}) == ["ridge", "svr_linear"]


def test_monthly_by_year(spark, tmp_path):
    df = spark.createDataFrame([(2023, 1.0), (2024, 2.0)], "year int, x double")
    files.write_by_year(df, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).where("year = 2024").first().x == 2.0
    files.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


@pytest.fixture(scope="module")
def weather_days(spark):
    days = pd.date_range("2024-01-03", periods=90)
    keep = [d for i, d in enumerate(days) if i not in range(20, 40)]
    pdf = pd.DataFrame(
        {"date": keep, "tmax": range(len(keep)), "rain": 1.0, "uv": 2.0, "tmin": 0.0, "humidity": [None] + [50.0] * (len(keep) - 1)}
    )
    pdf["station_id"] = 1
    df = spark.createDataFrame(pdf).withColumns({"date": F.to_date("date"), "tmax": F.col("tmax").cast("double")})
    return pdf, missing_as_null(df)


def test_weekly_and_rolling_match_pandas(weather_days):
    pdf, df = weather_days
    series_ = pdf.set_index("date")
    weekly = wx.weekly(df).toPandas().sort_values("week").reset_index(drop=True)
    rain, uv = series_["rain"].resample("W").sum(), series_["uv"].resample("W").mean()
    assert [pd.Timestamp(d) for d in weekly["week"]] == list(rain.index)
    assert weekly["rain"].to_list() == rain.to_list()
    assert weekly["uv"].isna().to_list() == uv.isna().to_list()
    rolled = wx.rolling(df).toPandas().sort_values("date")["tmax_avg30"].reset_index(drop=True)
    expected = series_["tmax"].rolling(30, center=True).mean().reset_index(drop=True)
    pd.testing.assert_series_equal(rolled, expected, check_names=False)


def test_rolling_trend_matches_pandas(spark):
    x = [float(v * v % 17) for v in range(14)]
    df = spark.createDataFrame([(1, dt.date(2023 + i // 12, i % 12 + 1, 1), v) for i, v in enumerate(x)],
                               "meter_id bigint, month_start date, total_kwh double")
    got = monthly.rolling_trend(df).toPandas().sort_values("month_start").reset_index(drop=True)
    s = pd.Series(x).rolling(6, center=True)
    pd.testing.assert_series_equal(got["rolling_mean"], s.mean(), check_names=False)
    pd.testing.assert_series_equal(got["rolling_std"], s.std(), check_names=False)


def test_weather_fill_and_fallbacks(spark, weather_days):
    _, df = weather_days
    assert wx.fill(df).where("humidity IS NULL").count() == 0
    days = spark.createDataFrame([(1, dt.date(2024, 1, d), 1.0, 1.0, 2.0) for d in (1, 4, 8)] + [(2, dt.date(2024, 1, 5), 1.0, 1.0, 2.0)],
                                 "meter_id bigint, date date, offpeak_kwh double, onpeak_kwh double, total_kwh double")
    stations = spark.createDataFrame([(1, 1)], "meter_id bigint, station_id bigint")
    snaps = scenarios.month_snapshots(days, (10,)).join(stations, "meter_id", "left")
    got = {r.meter_id: (r.temperature, r.humidity) for r in wx.with_range_means(snaps, df).collect()}
    # days 3..8 of station 1: tmax 0..5 halved, humidity unknown on the first; meter 2 has no station
    assert got == {1: (1.25, 50.0), 2: (20.0, 70.0)}


def test_repeated_weather_rows_weigh_in(spark, weather_days):
    _, df = weather_days
    one = df.where("date = date'2024-01-05'")
    days = spark.createDataFrame([(1, dt.date(2024, 1, 3), 1.0, 1.0, 2.0), (1, dt.date(2024, 1, 5), 1.0, 1.0, 2.0)],
                                 "meter_id bigint, date date, offpeak_kwh double, onpeak_kwh double, total_kwh double")
    snaps = scenarios.month_snapshots(days, (10,)).withColumn("station_id", F.lit(1).cast("bigint"))
    assert wx.with_range_means(snaps, df.unionByName(one)).first().temperature == pytest.approx((0 + 0.5 + 1 + 1) / 4)


def test_cleaning_needs_one_exchange_after_combining(spark):
    """readings -> monthly: combine dates by (meter, date), everything after shares the partitioning by meter."""
    df = spark.range(1000).select(
        (F.col("id") % 5).alias("meter_id"), F.expr("date_add(date'2024-01-01', cast(id as int))").alias("read_date"),
        *[F.col("id").cast("double").alias(c) for c in series.REGISTERS],
    )
    plan = monthly.monthly_consumption(series.clean_daily(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_meters_lie_in_as_many_tasks_as_their_rows_ask_for(spark, tmp_path, monkeypatch):
    """The session's number of shuffle partitions does not grow with the table; tasks must, and AQE must not merge them."""
    spark.range(4000).selectExpr(
        "id % 500 AS l_suppkey", "timestamp_seconds(800000000 + id * 86400) AS l_shipdate", "'R' AS l_returnflag", "2D AS l_quantity"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    plain = sorted(map(tuple, driver_tables.readings(spark, str(tmp_path)).collect()), key=str)
    monkeypatch.setattr(driver_tables, "ROWS_PER_TASK", 100, raising=False)
    rows = driver_tables.readings(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() == 40
    assert forecast.scenario_table(rows).rdd.getNumPartitions() == 40
    assert sorted(map(tuple, rows.collect()), key=str) == plain


def test_line_items_are_dealt_out_before_they_are_combined(spark, tmp_path):
    """A task that reads them, whose part of the file grows with the table, holds no groups."""
    spark.range(400).selectExpr(
        "id % 50 AS l_suppkey", "timestamp_seconds(800000000 + id * 86400) AS l_shipdate", "'R' AS l_returnflag", "2D AS l_quantity"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    plan = driver_tables.readings(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("Exchange") > plan.rindex("HashAggregate")
