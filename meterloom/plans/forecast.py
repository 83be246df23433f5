"""Readings -> monthly base -> scenarios -> trained models -> predictions -> report tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.functions import labels
from meterloom.functions.billing import Tariff, with_bill
from meterloom.operators import diagnostics, evaluate, features, models, monthly, scenarios, series
from meterloom.operators import forest as forests
from meterloom.operators.forest import Forest
from meterloom.schemas import NUMERIC_FEATURES
from meterloom.session import checkpointed, discard, stored


def monthly_base(readings: DataFrame, tariff: Tariff = Tariff(), dup_policy: str = "sum") -> DataFrame:
    """Cleaned monthly consumption with the bill of each month."""
    return with_bill(monthly.monthly_consumption(series.clean_daily(readings, dup_policy)), tariff)


def scenario_table(
    readings: DataFrame,
    weather: DataFrame | None = None,
    stations: DataFrame | None = None,
    clean: bool = False,
    tariff: Tariff = Tariff(),
    dup_policy: str = "sum",
) -> DataFrame:
    """Scenarios with features from raw daily rows (``clean=False``) or from cleaned days; labels are cleaned."""
    daily = series.clean_daily(readings, dup_policy) if clean else series.raw_daily(readings)
    return scenarios.partial_month_scenarios(
        daily, monthly_base(readings, tariff, dup_policy), weather, stations, tariff
    )


@dataclass
class Training:
    """Split and prepared rows plus everything fitted on them."""

    rows: DataFrame
    prep: features.Preparation
    matrix: DataFrame
    fold_sums: dict  # empty when there are too many features for sums of products
    left_out: int = 0  # rows with a missing feature
    test_share: float = 0.2
    fits: dict = field(default_factory=dict)
    alphas: dict = field(default_factory=dict)
    scores: dict = field(default_factory=dict)
    others: dict = field(default_factory=dict)  # model -> (array column it reads, fit)
    rff: models.Fourier | None = None
    folds: DataFrame | None = None  # stored train rows with their fold, in place of sums
    forest: Forest | None = None
    watch: models.Stopwatch = field(default_factory=models.Stopwatch)

    @property
    def train(self) -> DataFrame:
        return self.matrix.where(F.col("split") == "train")

    @property
    def test(self) -> DataFrame:
        return self.matrix.where(F.col("split") == "test")

    @property
    def sums(self):
        return sum(self.fold_sums.values())


def prepare(scenario_rows: DataFrame, test_share: float = 0.2) -> Training:
    """Split by time, fit the preparation on train rows, and sum up products per fold.

    The scenario rows and the split rows are checkpointed: the exact order and each fit below read them again,
    and none should run the chain from the raw registers to get them.
    """
    rows = checkpointed(features.temporal_split(checkpointed(scenario_rows), test_share))
    usable = features.complete_rows(rows)  # every row has its place in time; a row with a missing feature is not fitted
    prep = features.fit_preparation(usable.where(F.col("split") == "train"))
    matrix = features.model_matrix(usable, prep)
    in_train = matrix.where(F.col("split") == "train")
    # train rows are the first positions in time, so their count is what the folds divide
    n_train = F.col("n_total") - F.floor(F.col("n_total") * test_share)
    folds = features.kfolds(in_train.withColumn("n_total", n_train), models.FOLDS)
    left_out = rows.count() - usable.count()
    if len(prep.feature_names()) > models.MAX_FEATURES:
        return Training(rows, prep, matrix, {}, left_out, test_share, folds=stored(folds.drop("x")))
    return Training(rows, prep, matrix, models.product_sums(folds, "fold"), left_out, test_share)


def _fit_wide_family(t: Training, alphas=models.ALPHAS, **settings) -> Training:
    """The same four models by passes over the stored rows."""
    x = t.prep.feature_names().index("cum_total_kwh")
    value = models.vector_to_array("features")[x]
    line = models.baseline_ols(t.folds.select(F.lit("train").alias("split"), value.alias("v"), "label"), "v", "label").first()
    coef = models.np.zeros(len(t.prep.feature_names()))
    coef[x] = line["slope"] or 0.0
    t.fits["linear_baseline"] = models.LinearFit(line["intercept"], coef)
    t.fits["linear_multiple"] = t.watch.run("linear_multiple", lambda: models.fit_iterative(t.folds, "ols", **settings))
    for kind in ("ridge", "lasso"):
        t.fits[kind], t.alphas[kind], t.scores[kind] = t.watch.run(kind, lambda: models.fit_tuned_wide(kind, t.folds, alphas=alphas, **settings))
    return t


def fit_linear_family(t: Training, **wide) -> Training:
    """Baseline on the running total, least squares on all features, ridge and lasso with tuned penalty."""
    if t.folds is not None:
        return _fit_wide_family(t, **wide)
    at = NUMERIC_FEATURES.index("cum_total_kwh")
    p = len(t.prep.feature_names())

    def baseline():
        one = models.fit_ols(models.select_features(t.sums, [at]))
        coef = [0.0] * p
        coef[at] = float(one.coef[0])
        return models.LinearFit(one.intercept, models.np.array(coef))

    t.fits["linear_baseline"] = t.watch.run("linear_baseline", baseline)
    t.fits["linear_multiple"] = t.watch.run("linear_multiple", lambda: models.fit_ols(t.sums))
    for kind in ("ridge", "lasso"):
        t.fits[kind], t.alphas[kind], t.scores[kind] = t.watch.run(
            kind, lambda: models.fit_tuned(kind, t.fold_sums)
        )
    return t


RFF_ALPHA, RFF_WIDTH = 0.1, 200


def fit_other_models(t: Training, trees: int = forests.TREES, huber_iterations: int = 50, width: int = RFF_WIDTH) -> Training:
    """Polynomial, Huber, approximate kernel ridge regression and the forest, on the same train rows."""
    sums = lambda x: models.product_sums(with_spaces(t).where(F.col("split") == "train"), x=x)[0]
    t.rff = models.Fourier(models.kernel_gamma_of(t.train) if t.folds is not None else models.kernel_gamma(t.sums), width)
    squares = lambda: models.fit_least_squares(with_spaces(t).where(F.col("split") == "train"), "x2")
    t.others["polynomial_deg2"] = "x2", t.watch.run("polynomial_deg2", squares)
    t.others["huber_linear"] = "x", t.watch.run("huber_linear", lambda: models.linear_part(models.fit_huber(t.train, huber_iterations)))
    t.others["rff_ridge"] = "z", t.watch.run("rff_ridge", lambda: models.fit_ridge(sums("z"), RFF_ALPHA))
    return fit_forest(t, trees)


def fit_forest(t: Training, trees: int = forests.TREES) -> Training:
    """The forest alone, if it is not there yet."""
    if t.forest is None:
        t.forest = t.watch.run("random_forest", lambda: forests.fit_forest(t.train, trees))
    return t


def with_spaces(t: Training, matrix: DataFrame | None = None) -> DataFrame:
    """The matrix with the arrays that models read besides ``x``; those that nobody reads are never computed."""
    return models.random_fourier(models.polynomial(t.matrix if matrix is None else matrix), t.rff.gamma, t.rff.width, t.rff.seed)


def with_all_predictions(t: Training, matrix: DataFrame | None = None) -> DataFrame:
    """A column ``yhat_<model>`` for each of the eight models."""
    wide = with_linear_predictions(t, with_spaces(t, matrix))
    wide = wide.withColumns({f"yhat_{name}": fit.column(x) for name, (x, fit) in t.others.items()}).drop("x2", "z")
    return with_forest_predictions(t.forest, wide)


def with_forest_predictions(forest: Forest, wide: DataFrame) -> DataFrame:
    """The forest's mean, and ``member_mean`` and ``member_std`` of all trees' values, by ``sample_id``."""
    return wide.join(forest.summary(wide).withColumn("yhat_random_forest", F.col("member_mean")), "sample_id")


def _fold_rows(t: Training, splits: int) -> DataFrame:
    n_train = F.col("n_total") - F.floor(F.col("n_total") * t.test_share)
    return features.ts_folds(t.train.withColumn("n_total", n_train), splits)


def cross_validation(t: Training, splits: int = 5, trees: int = forests.TREES, huber_iterations: int = 50) -> DataFrame:
    """Time-series cross-validation of all eight models; tuned penalties and the random features stay as fitted.

    Models with additive sums are fitted from the running totals of per-fold sums. Huber regression and the forest are
    fitted once per fold on the rows before it, all from one stored fold table.
    """
    ordered = stored(_fold_rows(t, splits).select("sample_id", "fold", "label", "x", "features"))
    wide = with_spaces(t, ordered)
    rows = _linear_cv_rows(t, ordered)
    for name, x, fit in (("polynomial_deg2", "x2", models.fit_ols), ("rff_ridge", "z", lambda m: models.fit_ridge(m, RFF_ALPHA))):
        rows += models.time_series_cv(models.product_sums(wide, "fold", x=x), {name: lambda windows: [fit(m) for m in windows]})

    def rmse(scored: DataFrame, yhat) -> float:
        return scored.agg(F.sqrt(F.avg((F.col("label") - yhat) * (F.col("label") - yhat)))).first()[0]

    huber, forest = [], []
    for k in range(1, splits + 1):
        before, held_out = ordered.where(F.col("fold") < k), ordered.where(F.col("fold") == k)
        huber.append(rmse(held_out, models.linear_part(models.fit_huber(before, huber_iterations)).column()))
        grown = forests.fit_forest(before, trees)
        forest.append(rmse(with_forest_predictions(grown, held_out), F.col("yhat_random_forest")))
        discard(grown.subtrees)
    rows += [models.cv_row("huber_linear", huber), models.cv_row("random_forest", forest)]
    return _cv_table(t, rows)


def linear_cv(t: Training, splits: int = 5) -> DataFrame:
    """Time-series cross-validation of the linear family, penalties as already tuned."""
    return _cv_table(t, _linear_cv_rows(t, _fold_rows(t, splits)))


def _linear_cv_rows(t: Training, ordered: DataFrame) -> list[dict]:
    at = NUMERIC_FEATURES.index("cum_total_kwh")
    sums = models.product_sums(ordered, "fold")
    only = {k: models.select_features(m, [at]) for k, m in sums.items()}
    ols = lambda windows: [models.fit_ols(m) for m in windows]
    tuned = lambda kind: lambda windows: models.FITTERS[kind]([(m, t.alphas[kind]) for m in windows])
    return models.time_series_cv(only, {"linear_baseline": ols}) + models.time_series_cv(
        sums, {"linear_multiple": ols, "ridge": tuned("ridge"), "lasso": tuned("lasso")}
    )


def _cv_table(t: Training, rows: list[dict]) -> DataFrame:
    spark = t.matrix.sparkSession
    names = ["mean_rmse", "std_rmse", "min_rmse", "max_rmse", "ci_low", "ci_high"]
    return spark.createDataFrame(
        [(r["model"], *[r[n] for n in names]) for r in rows], ["model", *names]
    ).withColumn("stability", labels.stability_class(F.col("std_rmse"), F.col("mean_rmse"))).orderBy("mean_rmse")


def polynomial_model(t: Training) -> tuple[DataFrame, models.LinearFit]:
    wide = models.polynomial(t.matrix)
    fit = t.watch.run(
        "polynomial_deg2",
        lambda: models.fit_least_squares(wide.where(F.col("split") == "train"), "x2"),
    )
    return wide.withColumn("yhat_polynomial_deg2", fit.column("x2")).drop("x2"), fit


def rff_model(t: Training, alpha: float = RFF_ALPHA, width: int = RFF_WIDTH) -> DataFrame:
    """Approximate kernel ridge regression; stands in for the RBF support vector regression."""
    wide = models.random_fourier(t.matrix, models.kernel_gamma(t.sums), width)
    fit = t.watch.run(
        "rff_ridge",
        lambda: models.fit_ridge(
            models.product_sums(wide.where(F.col("split") == "train"), x="z")[0], alpha
        ),
    )
    return wide.withColumn("yhat_rff_ridge", fit.column("z")).drop("z")


def long_predictions(wide: DataFrame) -> DataFrame:
    """Columns ``yhat_<model>`` -> rows (model, split, sample_id, y, yhat), in one pass over the wide table."""
    names = [c for c in wide.columns if c.startswith("yhat_")]
    rows = F.array(
        *[F.struct(F.lit(c.removeprefix("yhat_")).alias("model"), F.col(c).alias("yhat")) for c in names]
    )
    return wide.select(F.inline(rows), "split", "sample_id", F.col("label").alias("y")).select(
        "model", "split", "sample_id", "y", "yhat"
    )


def with_linear_predictions(t: Training, wide: DataFrame | None = None) -> DataFrame:
    wide = t.matrix if wide is None else wide
    return wide.withColumns({f"yhat_{name}": fit.column() for name, fit in t.fits.items()})


def report_tables(predictions: DataFrame) -> dict[str, DataFrame]:
    """All tables of the reports over one prediction table. They share it, so pass a stored one."""
    metrics = evaluate.model_metrics(predictions)
    return {
        "metrics": metrics,
        "ranking": evaluate.rank_models(metrics, ["split"]),
        "grades": evaluate.metric_grades(metrics),
        "overfit": evaluate.fit_diagnosis(evaluate.overfit_gap(metrics)),
        "bias": evaluate.bias_classes(predictions),
        "percentiles": evaluate.abs_error_percentiles(predictions),
        "categories": evaluate.error_category_counts(predictions),
        "residuals": diagnostics.residual_stats(predictions),
        "findings": diagnostics.residual_findings(predictions),
        "worst": evaluate.worst_predictions(predictions),
    }
