"""One registered query per operator, over the driver tables seen through the adapter."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterloom.functions import billing, calendar
from meterloom.operators import diagnostics, evaluate, features, models, monthly, quality, scenarios, series, sketches, stats
from meterloom.operators import weather as wx
from meterloom.plans import forecast, model_store
from meterloom.schemas import NUMERIC_FEATURES
from meterloom.session import checkpoint_dir, checkpointed, stored
from meterloom.sources import driver_tables as src
from meterloom.sources import files, training_log
from meterloom.streaming import month_to_date, register_days

QUERIES = {}

MONTHLY_COLUMNS = ["offpeak_kwh", "onpeak_kwh", "total_kwh", "days_in_month", "offpeak_ratio", "kwh_per_day"]
KEY = ["meter_id", "month_start", "cutoff_day"]

# Display names and seconds of a training run, as the trainer prints them (fixed values of this check).
TRAINING_TIMES = [
    (0, "Linear Baseline", 0.5),
    (1, "Linear Regression (Multiple)", 1.25),
    (2, "Ridge Regression", 2.5),
    (3, "Random Forest", 30.0),
]


# The models of the prediction table.
MODELS = ("linear_baseline", "polynomial_deg2", "random_forest", "ridge")


def query(f):
    """Register under the function's name; counts come out as BIGINT and doubles rounded."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(f(spark, sf_dir))

    QUERIES[f.__name__] = run
    return run


def finish(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round for comparison, with the nudge that ``oracles.oracle`` explains."""
    out = []
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind == "double":
            c = F.round(c + F.lit(float(f"3.3e-{digits + 3}")), digits) + F.lit(0.0)
        elif kind in ("integer", "short", "byte"):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def scratch(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, on storage all executors share."""
    return f"{checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"


def filled(spark, sf):
    return series.fill_readings(series.dedupe_readings(src.readings(spark, sf)))


def daily(spark, sf):
    return series.daily_consumption(filled(spark, sf))


def base(spark, sf):
    return forecast.monthly_base(src.readings(spark, sf))


def stored_base(spark, sf):
    """The monthly base as a stored table, for statistics that read it more than once."""
    return checkpointed(base(spark, sf))


def scenario_rows(spark, sf):
    return forecast.scenario_table(src.readings(spark, sf), src.weather(spark, sf), src.stations(spark, sf))


def split_rows(spark, sf):
    return features.temporal_split(checkpointed(scenario_rows(spark, sf)))


# ---- sources ---------------------------------------------------------------------------------------------


@query
def src_readings(spark, sf):
    path = scratch(spark)
    files.write_csv(src.readings(spark, sf).withColumn("state", F.lit("ok")), path, sep=";")
    return files.read_readings(spark, path).drop("state")


@query
def src_weather(spark, sf):
    path = scratch(spark)
    files.write_csv(src.weather(spark, sf), path, sep=";")
    return files.read_weather(spark, path).unionByName(files.read_weather(spark, None))


@query
def src_monthly(spark, sf):
    path = scratch(spark)
    rows = monthly.monthly_consumption(series.clean_daily(src.readings(spark, sf)))
    files.write_csv(
        rows.select(
            "meter_id", F.date_format("month_start", "yyyy-MM").alias("month_text"), "year", "month", "season",
            "days_in_month", "offpeak_kwh", "onpeak_kwh", "total_kwh", "kwh_per_day", "offpeak_ratio",
        ),
        path,
    )
    return files.read_monthly_csv(spark, path)


@query
def model_name_extract(spark, sf):
    names = src.predictions(spark, sf).withColumn("file_name", F.concat(F.lit("y_pred_"), "model", F.lit("_test.parquet")))
    return names.groupBy("file_name").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "model", files.model_from_file_name(F.col("file_name"))
    )


@query
def prediction_files(spark, sf):
    path = scratch(spark)
    files.write_predictions(src.predictions(spark, sf), path)
    return files.read_predictions(spark, path)


@query
def flat_prediction_files(spark, sf):
    path, p = scratch(spark), src.predictions(spark, sf).where("split = 'test'")
    for m in MODELS:
        p.where(F.col("model") == m).drop("model", "split").write.parquet(f"{path}/y_pred_{m}_test")
    return files.read_flat_predictions(spark, f"{path}/y_pred_*_test")


# ---- scalar functions ------------------------------------------------------------------------------------


@query
def combine_registers(spark, sf):
    return series.combine_registers(src.readings(spark, sf)).select("meter_id", "read_date", "reg_offpeak", "reg_onpeak", "reg_total")


@query
def calendar_features(spark, sf):
    return calendar.with_calendar(src.readings(spark, sf).select("meter_id", F.col("read_date").alias("date")))


@query
def season_label(spark, sf):
    m = F.month("read_date")
    return (
        src.readings(spark, sf)
        .groupBy(m.alias("month"), calendar.season(m).alias("season"), calendar.season(m, calendar.SEASONS_EN).alias("season_en"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def weather_derive(spark, sf):
    w = src.weather(spark, sf)
    full = wx.derive(w).select("station_id", "date", "temperature", "humidity")
    one = wx.derive(w.drop("tmin", "humidity")).select(
        "station_id", "date", F.col("temperature").alias("temperature_max_only"), F.col("humidity").alias("humidity_fallback")
    )
    none = wx.derive(w.drop("tmax", "tmin")).select("station_id", "date", F.col("temperature").alias("temperature_fallback"))
    return full.join(one, ["station_id", "date"]).join(none, ["station_id", "date"])


@query
def bill_breakdown(spark, sf):
    m = monthly.monthly_consumption(series.clean_daily(src.readings(spark, sf)))
    return billing.add_bill(m, "b", breakdown=True).select("meter_id", "month_start", "b.*")


@query
def monthly_bill(spark, sf):
    return base(spark, sf)


@query
def residual_table(spark, sf):
    return evaluate.with_residuals(src.predictions(spark, sf))


@query
def error_category(spark, sf):
    return evaluate.error_categories(src.predictions(spark, sf)).select("model", "split", "sample_id", "mae", "error_category")


@query
def metric_grades(spark, sf):
    return evaluate.metric_grades(evaluate.model_metrics(src.predictions(spark, sf)))


@query
def bias_classes(spark, sf):
    return evaluate.bias_classes(src.predictions(spark, sf))


@query
def residual_findings(spark, sf):
    return diagnostics.residual_findings(src.predictions(spark, sf))


@query
def correlation_labels(spark, sf):
    return stats.correlations_with(stats.correlation_pairs(base(spark, sf), MONTHLY_COLUMNS), "total_kwh")


@query
def distribution_flags(spark, sf):
    return stats.distribution_flags(stored_base(spark, sf), "total_kwh", ["season"])


@query
def fit_diagnosis(spark, sf):
    return evaluate.fit_diagnosis(evaluate.overfit_gap(evaluate.model_metrics(src.predictions(spark, sf))))


@query
def log1p_target(spark, sf):
    return stats.log1p_target(stored_base(spark, sf).select("meter_id", "month_start", "bill"), "bill")


@query
def monthly_quality_flags(spark, sf):
    d = series.clean_daily(src.readings(spark, sf))
    return quality.monthly_quality_flags(monthly.monthly_consumption(d), d)


# ---- joins and scenarios -----------------------------------------------------------------------------------


@query
def cutoff_expand(spark, sf):
    return scenarios.expand_cutoffs(base(spark, sf).select("meter_id", "month_start", "days_in_month"))


@query
def weather_range_join(spark, sf):
    snaps = scenarios.month_snapshots(series.raw_daily(src.readings(spark, sf)))
    rows = snaps.join(src.stations(spark, sf), "meter_id", "left")
    return wx.with_range_means(rows, src.weather(spark, sf)).select(
        *KEY, "station_id", "first_date", "simulation_date", "temperature", "humidity"
    )


@query
def weather_season_default(spark, sf):
    return wx.with_season_defaults(base(spark, sf).select("meter_id", "month_start", "season"))


@query
def partial_month_scenarios(spark, sf):
    return scenario_rows(spark, sf)


@query
def partial_month_scenarios_clean(spark, sf):
    return forecast.scenario_table(src.readings_dense(spark, sf), clean=True)


@query
def event_scenarios(spark, sf):
    d = src.event_daily(spark, sf)
    return scenarios.partial_month_scenarios(d, billing.with_bill(monthly.monthly_consumption(d)))


@query
def prediction_alignment(spark, sf):
    truth = src.table(spark, sf, "orders").select(F.col("o_orderkey").alias("sample_id"))
    from_lines = src.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("sample_id")).agg(
        F.sum("l_extendedprice").alias("yhat")
    )
    p = src.predictions(spark, sf)
    parts = {m: p.where(F.col("model") == m).select("sample_id", "yhat") for m in MODELS}
    return evaluate.prediction_alignment(truth, evaluate.prediction_union({"line_total": from_lines} | parts))


@query
def prediction_union(spark, sf):
    p = src.predictions(spark, sf)
    parts = {m: p.where(F.col("model") == m).drop("model") for m in MODELS}
    return evaluate.prediction_union(parts)


@query
def comparison_with_times(spark, sf):
    path = scratch(spark)
    times = spark.createDataFrame([(i, None, n, s) for i, n, s in TRAINING_TIMES], training_log.TIMES)
    training_log.append_run(path, "first", times.withColumn("training_seconds", F.col("training_seconds") * 2))
    training_log.append_run(path, "second", times)
    times = training_log.read_log(spark, path, "times", "second")
    metrics = evaluate.model_metrics(src.predictions(spark, sf).where("split = 'test'"), ["model"])
    return evaluate.comparison_with_times(metrics, times).select(
        "rank", "model", "rmse", "mae", "r2", "max_error", "training_seconds"
    )


@query
def best_model_predictions(spark, sf):
    return evaluate.best_model_predictions(src.predictions(spark, sf))


# ---- cleaning ----------------------------------------------------------------------------------------------


@query
def duplicate_report(spark, sf):
    return quality.duplicate_report(src.readings(spark, sf))


@query
def dedupe_readings(spark, sf):
    return series.dedupe_readings(src.readings(spark, sf))


@query
def dedupe_readings_max(spark, sf):
    return series.dedupe_readings(src.readings(spark, sf), "max")


@query
def quality_profile(spark, sf):
    return quality.quality_profile(src.readings(spark, sf), ["reg_offpeak", "reg_peak", "reg_shoulder"])


@query
def fill_readings(spark, sf):
    return filled(spark, sf)


@query
def fill_weather(spark, sf):
    return wx.fill(src.weather(spark, sf))


@query
def daily_consumption(spark, sf):
    return daily(spark, sf)


@query
def raw_daily_consumption(spark, sf):
    return series.raw_daily(src.readings(spark, sf)).drop("tail")


@query
def meter_resets(spark, sf):
    return series.meter_resets(filled(spark, sf))


@query
def outlier_replacement(spark, sf):
    return series.replace_outliers(daily(spark, sf))


@query
def outlier_days_topk(spark, sf):
    first = W.partitionBy("meter_id").orderBy("date")
    days = series.flag_outlier_days(daily(spark, sf)).where("is_outlier")
    return days.withColumn("position", F.row_number().over(first)).where("position <= 10").select(
        "meter_id", "date", "total_kwh", "position"
    )


@query
def dataset_summary(spark, sf):
    return quality.dataset_summary(scenario_rows(spark, sf))


# ---- monthly and weather statistics --------------------------------------------------------------------------


@query
def monthly_consumption(spark, sf):
    return monthly.monthly_consumption(series.clean_daily(src.readings(spark, sf)))


@query
def monthly_consumption_dense(spark, sf):
    return monthly.monthly_consumption(series.clean_daily(src.readings_dense(spark, sf)))


@query
def tariff_shares(spark, sf):
    return monthly.tariff_shares(base(spark, sf), ["meter_id"])


@query
def describe_monthly(spark, sf):
    return stats.describe(stored_base(spark, sf), ["offpeak_kwh", "onpeak_kwh", "total_kwh", "kwh_per_day"])


@query
def describe_weather(spark, sf):
    return stats.describe(src.weather(spark, sf), list(wx.MEASURES))


@query
def by_calendar_month(spark, sf):
    return stats.by_calendar_month(base(spark, sf))


@query
def by_season(spark, sf):
    return stats.by_season(stored_base(spark, sf))


@query
def sketched_quantiles(spark, sf):
    """Quantiles per season from sketches kept by month: whether each is within its error bound, beside the exact quantile."""
    at, path = {"p10": 0.1, **stats.QUARTILES, "p90": 0.9}, scratch(spark)
    days = stored(daily(spark, sf).withColumn("season", calendar.season(F.month("date"))).select("season", "date", "total_kwh"))
    sketches.keep(sketches.monthly_sketches(days, ["season"], "total_kwh"), path)
    found = stored(sketches.sketched_quantiles(sketches.kept(spark, path), ["season"], at))
    errors = sketches.rank_errors(days, ["season"], "total_kwh", found, at)
    exact = stats.quantiles(days, ["season"], "total_kwh", at)
    exact = exact.select("season", F.inline(F.array(*[F.struct(F.lit(n).alias("quantile"), F.col(n).alias("exact")) for n in at])))
    return errors.join(exact, ["season", "quantile"]).select(
        "season", "quantile", "n", "exact", (F.col("rank_error") <= sketches.rank_bound()).alias("within_bound")
    )


@query
def by_year(spark, sf):
    return stats.by_group(stored_base(spark, sf), ["year"], "total_kwh")


@query
def moments_population(spark, sf):
    return stats.moments(base(spark, sf), ["offpeak_kwh", "onpeak_kwh"]).select("column_name", "n", "skew_pop", "kurt_pop")


@query
def moments_adjusted(spark, sf):
    return stats.moments(base(spark, sf), ["total_kwh", "bill"], ["meter_id"]).select(
        "meter_id", "column_name", "n", "skew_adj", "kurt_adj"
    )


@query
def tukey_outliers(spark, sf):
    return stats.tukey_outliers(stored_base(spark, sf).select("meter_id", "month_start", "total_kwh"), "total_kwh", ["meter_id"])


@query
def correlation_matrix(spark, sf):
    return stats.correlation_pairs(base(spark, sf), MONTHLY_COLUMNS)


@query
def weather_correlation(spark, sf):
    return stats.correlation_pairs(src.weather(spark, sf), list(wx.MEASURES))


@query
def near_perfect_pairs(spark, sf):
    return stats.near_perfect_pairs(stats.correlation_pairs(
            base(spark, sf).withColumn("total_wh", F.col("total_kwh") * 1000 + F.col("days_in_month")), [*MONTHLY_COLUMNS, "bill", "total_wh"]
        ))


@query
def strongest_driver(spark, sf):
    pairs = stats.correlation_pairs(base(spark, sf), ["offpeak_kwh", "onpeak_kwh", "days_in_month", "total_kwh"], ["meter_id"])
    return stats.strongest_driver(pairs, "total_kwh", ["offpeak_kwh", "onpeak_kwh", "days_in_month"], ["meter_id"])


@query
def histogram(spark, sf):
    return stats.histogram(evaluate.with_residuals(src.predictions(spark, sf)), "residual", 30, ["model", "split"])


@query
def monthly_histogram(spark, sf):
    return stats.histogram(stored_base(spark, sf), "total_kwh", 15)


@query
def boxplot_stats(spark, sf):
    return stats.boxplot_stats(stored_base(spark, sf), "total_kwh", ["season"])


@query
def normal_overlay(spark, sf):
    return stats.normal_overlay(base(spark, sf), "offpeak_kwh", ["season"])


@query
def trend_line(spark, sf):
    return stats.trend_line(base(spark, sf), "offpeak_kwh", "bill", ["season"])


@query
def season_scatter(spark, sf):
    return stats.season_scatter(base(spark, sf))


@query
def rolling_trend(spark, sf):
    return monthly.rolling_trend(base(spark, sf))


@query
def stacked_components(spark, sf):
    return monthly.stacked_components(base(spark, sf))


@query
def weather_rolling(spark, sf):
    return wx.rolling(src.weather(spark, sf))


@query
def weekly_weather(spark, sf):
    return wx.weekly(src.weather(spark, sf))


@query
def weather_summary(spark, sf):
    return wx.summary(src.weather(spark, sf), ["station_id"])


@query
def weather_by_month(spark, sf):
    return wx.by_calendar_month(src.weather(spark, sf))


@query
def weather_by_season(spark, sf):
    return wx.by_season(src.weather(spark, sf))


# ---- evaluation ----------------------------------------------------------------------------------------------


@query
def abs_error_percentiles(spark, sf):
    return evaluate.abs_error_percentiles(src.predictions(spark, sf))


@query
def model_metrics(spark, sf):
    return evaluate.model_metrics(src.predictions(spark, sf)).withColumn("mse", F.round("mse", 0))


@query
def model_mape(spark, sf):
    return evaluate.model_mape(src.predictions(spark, sf))


@query
def bias_summary(spark, sf):
    return evaluate.bias_summary(src.predictions(spark, sf))


@query
def model_spread(spark, sf):
    return evaluate.model_spread(evaluate.model_metrics(src.predictions(spark, sf)))


@query
def error_category_counts(spark, sf):
    return evaluate.error_category_counts(src.predictions(spark, sf))


@query
def residual_stats(spark, sf):
    return diagnostics.residual_stats(src.predictions(spark, sf))


@query
def variance_ratio(spark, sf):
    v = diagnostics.variance_ratio(src.predictions(spark, sf))
    return v.withColumns({"var_low": F.round("var_low", 0), "var_high": F.round("var_high", 0)})


@query
def residual_trend(spark, sf):
    return diagnostics.residual_trend(src.predictions(spark, sf))


@query
def jarque_bera(spark, sf):
    return diagnostics.jarque_bera(diagnostics.residual_stats(src.predictions(spark, sf))).select(
        "model", "split", "n", "jarque_bera", "p_value"
    )


@query
def model_ranking(spark, sf):
    return evaluate.rank_models(evaluate.model_metrics(src.predictions(spark, sf)), ["split"]).select(
        "model", "split", "rmse", "r2", "mae", "rank", "is_best"
    )


@query
def best_model(spark, sf):
    return evaluate.best_model(evaluate.model_metrics(src.predictions(spark, sf)), ["split"])


@query
def worst_predictions(spark, sf):
    return evaluate.worst_predictions(src.predictions(spark, sf))


@query
def audit_points(spark, sf):
    return evaluate.audit_points(src.predictions(spark, sf))


@query
def plot_bounds(spark, sf):
    return evaluate.plot_bounds(src.predictions(spark, sf))


@query
def overfit_gap(spark, sf):
    return evaluate.overfit_gap(evaluate.model_metrics(src.predictions(spark, sf)))


@query
def interval_coverage(spark, sf):
    p = src.predictions(spark, sf)
    one = lambda m: F.max(F.when(F.col("model") == m, F.col("yhat")))
    rows = p.groupBy("sample_id", "split").agg(
        F.max("y").alias("y"), F.array(*[one(m) for m in MODELS]).alias("members")
    )
    return evaluate.interval_coverage(rows, ["split"])


@query
def split_summary(spark, sf):
    return evaluate.split_summary(src.predictions(spark, sf), "y", ["model", "split"])


@query
def numeric_validation(spark, sf):
    o = src.table(spark, sf, "orders")
    status = F.col("o_orderstatus")
    rows = o.select(
        F.col("o_orderpriority").alias("model"),
        F.when(status != "F", F.col("o_totalprice")).alias("y"),
        F.when(status == "P", float("nan")).when(status == "F", float("-inf")).otherwise(F.col("o_totalprice")).alias("yhat"),
    )
    return quality.numeric_validation(rows, ["y", "yhat"], ["model"])


# ---- features and folds ----------------------------------------------------------------------------------------


@query
def temporal_split(spark, sf):
    return split_rows(spark, sf).select(*KEY, "sample_id", "split")


@query
def ts_folds(spark, sf):
    return features.ts_folds(split_rows(spark, sf)).select(*KEY, "sample_id", "fold")


@query
def kfolds(spark, sf):
    return features.kfolds(split_rows(spark, sf)).select(*KEY, "sample_id", "fold")


@query
def standardize(spark, sf):
    rows = checkpointed(split_rows(spark, sf))
    prep = features.fit_preparation(rows.where("split = 'train'"), categorical=())
    return features.standardize(rows, prep).select(*KEY, "split", *NUMERIC_FEATURES)


@query
def one_hot(spark, sf):
    rows = checkpointed(split_rows(spark, sf))
    prep = features.fit_preparation(rows.where("split = 'train'"), numeric=("bill",), categorical=("month", "season"))
    return features.one_hot(rows, prep).select(*KEY, *[f"`{n}`" for n, _, _ in prep.one_hot_columns()])


@query
def baseline_ols(spark, sf):
    return models.baseline_ols(split_rows(spark, sf), "cum_total_kwh", "bill")


# ---- streaming ---------------------------------------------------------------------------------------------------


def event_records(events):
    off = F.col("event_type").isin("purchase", "signup")
    return events.select(
        F.col("user_id").alias("meter_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(off, F.col("value")).otherwise(0.0).alias("offpeak_kwh"),
        F.when(off, 0.0).otherwise(F.col("value")).alias("onpeak_kwh"),
    )


def event_stream(spark, sf):
    """The event table, one file or a folder of parts, as a file stream."""
    schema = src.table(spark, sf, "events").schema
    return event_records(spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*"))


@query
def stream_unusual_days(spark, sf):
    """Days of the event stream above twice their user's daily mean, flagged while they stream."""
    days = event_records(src.table(spark, sf, "events")).groupBy("meter_id", F.to_date("ts").alias("date")).agg(
        F.sum(F.col("offpeak_kwh") + F.col("onpeak_kwh")).alias("total_kwh")
    )
    limits = days.groupBy("meter_id").agg(F.lit(0.0).alias("low"), (2 * F.avg("total_kwh")).alias("high"))
    folder = scratch(spark)
    flag = lambda stream: month_to_date.flag_unusual_days(stream, limits)
    month_to_date.run_daily_totals(event_stream(spark, sf), f"{folder}/days", f"{folder}/state", change=flag)
    found = month_to_date.current_days(spark, f"{folder}/days")
    return found.groupBy("meter_id").agg(F.count(F.lit(1)).alias("n_days"), F.count_if("is_unusual").alias("n_unusual"))


@query
def stream_month_to_date(spark, sf):
    """The event table as a file stream, processed to its end, then summed up per user and month."""
    folder = scratch(spark)
    month_to_date.run_daily_totals(event_stream(spark, sf), f"{folder}/days", f"{folder}/state")
    return month_to_date.month_to_date(month_to_date.current_days(spark, f"{folder}/days"))


@query
def stream_register_days(spark, sf):
    """Daily consumption from the registers as a file stream, which goes on twice from where it stopped."""
    folder, rows = scratch(spark), stored(src.readings(spark, sf).withColumn("ts", F.col("read_date").cast("timestamp")))
    year = F.year("read_date")
    for period in (year < 1994, year.between(1994, 1995), year > 1995):
        rows.where(period).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        register_days.run_register_days(stream, f"{folder}/days", f"{folder}/state")
    return register_days.current_days(spark, f"{folder}/days")


# ---- model fits: rows only ---------------------------------------------------------------------------------------

_TRAINED = {}


def trained(spark, sf) -> forecast.Training:
    """Prepared rows and the fitted linear family, once per session and table folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRAINED:
        _TRAINED[key] = forecast.fit_linear_family(forecast.prepare(scenario_rows(spark, sf)))
    return _TRAINED[key]


def fitted(spark, sf) -> forecast.Training:
    """All eight models, once per session and table folder."""
    t = trained(spark, sf)
    return t if t.others else forecast.fit_other_models(t)


def trained_with_map(spark, sf) -> forecast.Training:
    """``trained`` with the random features, which cross-validation takes as given."""
    t = trained(spark, sf)
    t.rff = t.rff or models.Fourier(models.kernel_gamma(t.sums), forecast.RFF_WIDTH)
    return t


_SCORED = {}


def scored(spark, sf) -> DataFrame:
    """Predictions of the eight models for every usable row, stored once per session and table folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _SCORED:
        _SCORED[key] = stored(forecast.long_predictions(forecast.with_all_predictions(fitted(spark, sf))))
    return _SCORED[key]


@query
def reloaded_predictions(spark, sf):
    """Scenario rows scored by all stored models and the stored preparation, held against the fits they were stored from."""
    t, path = fitted(spark, sf), scratch(spark)
    model_store.save(t, path)
    again = forecast.long_predictions(model_store.load(spark, path).predict(t.rows)).withColumnRenamed("yhat", "stored")
    both = again.join(scored(spark, sf).select("model", "sample_id", F.col("yhat").alias("direct")), ["model", "sample_id"])
    return both.groupBy("model", "split").agg(        F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("stored") - F.col("direct"))).alias("largest_difference")
    )


@query
def feature_vectors(spark, sf):
    t = trained(spark, sf)
    return t.matrix.select(*KEY, "split", "label", *[F.get("x", F.lit(i)).alias(n) for i, n in enumerate(t.prep.feature_names())])


@query
def linear_regression(spark, sf):
    t = trained(spark, sf)
    return models.coefficient_report(spark, {"linear_multiple": t.fits["linear_multiple"]}, t.prep.feature_names(), top=None)


def _grid(spark, t, kind):
    rows = [(kind, float(a), float(s), a == t.alphas[kind]) for a, s in t.scores[kind].items()]
    return spark.createDataFrame(rows, "model string, alpha double, score double, chosen boolean")


@query
def ridge_cv(spark, sf):
    return _grid(spark, trained(spark, sf), "ridge")


@query
def lasso_cv(spark, sf):
    return _grid(spark, trained(spark, sf), "lasso")


@query
def coefficient_report(spark, sf):
    t = trained(spark, sf)
    return models.coefficient_report(spark, t.fits, t.prep.feature_names())


@query
def predictions_long(spark, sf):
    return scored(spark, sf)


@query
def poly_regression(spark, sf):
    wide, _ = forecast.polynomial_model(trained(spark, sf))
    return evaluate.model_metrics(forecast.long_predictions(wide))


@query
def huber_linear(spark, sf):
    t = trained(spark, sf)
    return evaluate.model_metrics(forecast.long_predictions(models.fit_huber(t.train).transform(t.matrix)))


@query
def model_comparison(spark, sf):
    """The eight models' metrics on test rows with their measured training seconds from the training log."""
    t, path = fitted(spark, sf), scratch(spark)
    metrics = evaluate.model_metrics(scored(spark, sf).where("split = 'test'"), ["model"])
    training_log.append_run(path, "now", t.watch.table(spark), metrics, models.forest_report(spark, t.forest, t.prep.feature_names()))
    return evaluate.comparison_with_times(training_log.read_log(spark, path, "scores", "now"), training_log.read_log(spark, path, "times", "now"), by_id=True)


@query
def model_overfit(spark, sf):
    """Train against test for the eight models, with the verdict."""
    gaps = evaluate.overfit_gap(evaluate.model_metrics(scored(spark, sf)))
    return gaps.join(evaluate.fit_diagnosis(gaps).select("model", "fit"), "model")


@query
def rff_ridge(spark, sf):
    return evaluate.model_metrics(forecast.long_predictions(forecast.rff_model(trained(spark, sf))))


def _forest(spark, sf):
    """The forest at its full size, once per session and table folder."""
    t = forecast.fit_forest(trained(spark, sf))
    return t, t.forest


@query
def random_forest(spark, sf):
    t, forest = _forest(spark, sf)
    return evaluate.model_metrics(forecast.long_predictions(forecast.with_forest_predictions(forest, t.matrix)))


@query
def forest_report(spark, sf):
    t, forest = _forest(spark, sf)
    return models.forest_report(spark, forest, t.prep.feature_names())


@query
def rf_intervals(spark, sf):
    t, forest = _forest(spark, sf)
    return evaluate.interval_coverage(forecast.with_forest_predictions(forest, t.matrix).withColumn("y", F.col("label")), ["split"])


@query
def time_series_cv(spark, sf):
    """All eight models, Huber regression and the whole forest fitted once per fold."""
    return forecast.cross_validation(trained_with_map(spark, sf))


@query
def anderson_darling(spark, sf):
    return diagnostics.anderson_darling(evaluate.with_residuals(src.predictions(spark, sf)), "residual", ["model", "split"])


@query
def qq_points(spark, sf):
    return diagnostics.qq_points(stored_base(spark, sf), "offpeak_kwh", ["meter_id", "month_start"])


@query
def residual_smooth(spark, sf):
    return diagnostics.residual_smooth(src.predictions(spark, sf))
