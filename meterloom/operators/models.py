"""Regression models.

The linear family is fitted from sums of products. One pass over the data gives X'X, X'y, y'y per fold; every
alpha and every fold of a cross-validation is then arithmetic on p x p matrices, where p is the number of
features (about thirty), not rows. Huber regression is a Spark ML estimator; the forest is in ``forest``.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.operators.forest import Forest

# Penalty grid, folds, seed, t quantile (97.5 %, 4 degrees of freedom).
ALPHAS = (0.001, 0.01, 0.1, 1.0, 10.0, 100.0)
FOLDS = 5
SEED = 42
T_975_DF4 = 2.776445105197793

#: Features up to which products are summed; wider matrices, whose p x p sums no longer fit a driver, are fitted by passes
#: over the rows instead. The width is known before either is started.
MAX_FEATURES = 2000


def width_of(matrix: DataFrame, x: str = "x") -> int:
    row = matrix.select(F.size(x)).first()
    return 0 if row is None else row[0]


def product_sums(matrix: DataFrame, fold: str | None = None, x: str = "x", label: str = "label") -> dict[int, np.ndarray]:
    """Per fold the symmetric matrix of products of (1, x…, y), summed over rows.

    Each task adds up its own rows and ships one small matrix per fold, so the shuffle does not grow with rows.
    For up to MAX_FEATURES features; ``fit_least_squares`` and ``fit_tuned_wide`` take more.
    """
    key = F.col(fold) if fold else F.lit(0)
    rows = matrix.select(key.cast("int").alias("fold"), F.col(x).alias("x"), F.col(label).cast("double").alias("y"))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            folds = batch.column(0).to_numpy()
            values = batch.column(1).flatten().to_numpy().reshape(n, -1)
            full = np.column_stack([np.ones(n), values, batch.column(2).to_numpy()])
            for f in np.unique(folds):
                part = full[folds == f]
                products = part.T @ part
                sums[f] = sums[f] + products if f in sums else products
        for f, m in sums.items():
            upper = m[np.triu_indices(len(m))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(upper), f), pa.int32()),
                    pa.array(np.arange(len(upper)), pa.int32()),
                    pa.array(upper),
                ],
                ["fold", "cell", "value"],
            )

    cells = (
        rows.mapInArrow(partial, "fold int, cell int, value double")
        .groupBy("fold", "cell")
        .agg(F.sum("value").alias("value"))
        .toPandas()
    )
    out = {}
    for f, group in cells.groupby("fold"):
        upper = group.sort_values("cell")["value"].to_numpy()
        size = int((np.sqrt(8 * len(upper) + 1) - 1) / 2)
        m = np.zeros((size, size))
        m[np.triu_indices(size)] = upper
        out[int(f)] = m + m.T - np.diag(np.diag(m))
    return out


@dataclass(frozen=True)
class LinearFit:
    intercept: float
    coef: np.ndarray

    def column(self, x: str | Column = "x") -> Column:
        """The prediction as a Column: unrolled while short enough for code generation."""
        coef = [float(c) for c in self.coef]
        x = F.col(x) if isinstance(x, str) else x
        if len(coef) <= 64:
            total = F.lit(float(self.intercept))
            for i, c in enumerate(coef):
                total = total + F.lit(c) * F.get(x, F.lit(i))
            return total
        products = F.zip_with(x, F.lit(coef), lambda a, b: a * b)
        return F.aggregate(products, F.lit(float(self.intercept)), lambda s, v: s + v)

    def column_of(self, vector: str = "features") -> Column:
        """The prediction from an ML vector, sparse or dense."""
        return self.column(vector_to_array(vector))

    def squared_error(self, sums: np.ndarray) -> float:
        """Sum of squared errors on the rows behind ``sums``."""
        u = np.concatenate([[self.intercept], self.coef, [-1.0]])
        return max(0.0, float(u @ sums @ u))


def _centred(sums: np.ndarray):
    n = sums[0, 0]
    mean_x, mean_y = sums[0, 1:-1] / n, sums[0, -1] / n
    return n, mean_x, mean_y, sums[1:-1, 1:-1] - n * np.outer(mean_x, mean_x), sums[1:-1, -1] - n * mean_x * mean_y


def _with_intercept(coef, mean_x, mean_y) -> LinearFit:
    return LinearFit(float(mean_y - coef @ mean_x), coef)


def fit_ols(sums: np.ndarray) -> LinearFit:
    """Least squares; the shortest solution when columns are collinear (totals are sums of their parts)."""
    _, mx, my, xx, xy = _centred(sums)
    return _with_intercept(np.linalg.lstsq(xx, xy, rcond=1e-11)[0], mx, my)


def fit_ridge(sums: np.ndarray, alpha: float) -> LinearFit:
    _, mx, my, xx, xy = _centred(sums)
    return _with_intercept(np.linalg.solve(xx + alpha * np.eye(len(xy)), xy), mx, my)


def fit_lasso_many(problems: list[tuple[np.ndarray, float]], max_iter: int = 10_000, tol: float = 1e-4) -> list[LinearFit]:
    """Minimise squared error / (2 n) + alpha * |w| for several (sums, alpha) at once.

    Cyclic coordinate steps from zero; one step updates the same coordinate of all problems. A problem is done
    when its weights have settled to ``tol`` and its duality gap is below ``tol`` times the variation of y, or
    after ``max_iter`` sweeps.
    """
    parts = [_centred(sums) for sums, _ in problems]
    xx, xy = np.array([p[3] for p in parts]), np.array([p[4] for p in parts])
    yy = np.array([sums[-1, -1] - p[0] * p[2] ** 2 for (sums, _), p in zip(problems, parts)])
    penalty = np.array([p[0] * alpha for (_, alpha), p in zip(problems, parts)])
    result = np.zeros_like(xy)
    live = np.arange(len(problems))
    w, slope = np.zeros_like(xy), xy.copy()  # slope = X'(y - Xw)
    for sweep in range(1, max_iter + 1):
        change = np.zeros(len(live))
        for j in range(xy.shape[1]):
            diagonal = xx[:, j, j]
            target = slope[:, j] + diagonal * w[:, j]
            shrunk = np.sign(target) * np.maximum(np.abs(target) - penalty, 0.0)
            step = np.divide(shrunk, diagonal, out=np.zeros_like(shrunk), where=diagonal > 0) - w[:, j]
            if step.any():
                slope -= xx[:, :, j] * step[:, None]
                w[:, j] += step
                np.maximum(change, np.abs(step), out=change)
        settled = change <= tol * np.abs(w).max(axis=1)
        if settled.any() or sweep == max_iter:
            error = yy - (w * (xy + slope)).sum(axis=1)
            scale = np.minimum(1.0, penalty / np.maximum(np.abs(slope).max(axis=1), 1e-300))
            gap = (
                0.5 * error * (1 + scale**2) + penalty * np.abs(w).sum(axis=1) - scale * (yy - (w * xy).sum(axis=1))
            )
            done = (settled & (gap < tol * yy)) | (sweep == max_iter)
            if done.any():
                result[live[done]] = w[done]
                live, w, slope = live[~done], w[~done], slope[~done]
                xx, xy, yy, penalty = xx[~done], xy[~done], yy[~done], penalty[~done]
                if not len(live):
                    break
    return [_with_intercept(coef, p[1], p[2]) for coef, p in zip(result, parts)]


def fit_ridge_many(problems: list[tuple[np.ndarray, float]]) -> list[LinearFit]:
    return [fit_ridge(sums, alpha) for sums, alpha in problems]


FITTERS = {"ridge": fit_ridge_many, "lasso": fit_lasso_many}


def grid_scores(kind: str, fold_sums: dict[int, np.ndarray], alphas=ALPHAS) -> dict[float, float]:
    """Mean over folds of the negative mean squared error on the left-out fold."""
    total = sum(fold_sums.values())
    cases = [(alpha, held_out) for alpha in alphas for held_out in fold_sums.values()]
    fits = FITTERS[kind]([(total - held_out, alpha) for alpha, held_out in cases])
    errors = {alpha: [] for alpha in alphas}
    for (alpha, held_out), fit in zip(cases, fits):
        errors[alpha].append(fit.squared_error(held_out) / held_out[0, 0])
    return {alpha: -float(np.mean(e)) for alpha, e in errors.items()}


def fit_tuned(kind: str, fold_sums: dict[int, np.ndarray], alphas=ALPHAS) -> tuple[LinearFit, float, dict]:
    """Best alpha by cross-validation, refitted on all folds together; the first alpha wins a tie."""
    scores = grid_scores(kind, fold_sums, alphas)
    best = max(alphas, key=lambda a: scores[a])
    return FITTERS[kind]([(sum(fold_sums.values()), best)])[0], best, scores


def fit_iterative(matrix: DataFrame, kind: str, alpha: float = 0.0, max_iter: int = 1000, tol: float = 1e-9) -> LinearFit:
    """``kind`` ols, ridge or lasso on the vectors ``features``, sparse or dense, by passes over the rows.

    Only the coefficients, one per feature, reach the driver. The penalties are those of ``fit_ridge`` and
    ``fit_lasso_many``: the estimator divides the squared error by the rows, and ridge's penalty by the deviation of y.
    """
    if kind == "ridge":
        stats = matrix.agg(F.count("label").alias("n"), F.stddev_samp("label").alias("std")).first()
        alpha = alpha * (stats["std"] or 0.0) / max(1, stats["n"])
    return linear_part(
        LinearRegression(
            solver="l-bfgs", elasticNetParam=float(kind == "lasso"), regParam=0.0 if kind == "ols" else alpha,
            standardization=False, maxIter=max_iter, tol=tol,
        ).fit(matrix)
    )


def fit_least_squares(matrix: DataFrame, x: str = "x") -> LinearFit:
    """Least squares on the array ``x``, whatever its width."""
    if width_of(matrix, x) <= MAX_FEATURES:
        return fit_ols(product_sums(matrix, x=x)[0])
    return fit_iterative(matrix.select("label", array_to_vector(x).alias("features")), "ols")


def fit_tuned_wide(kind: str, matrix: DataFrame, fold: str = "fold", alphas=ALPHAS, **settings) -> tuple[LinearFit, float, dict]:
    """``fit_tuned`` for a matrix too wide for sums of products: one fit per penalty and fold, then one on all rows."""
    folds = [r[0] for r in matrix.select(fold).distinct().orderBy(fold).collect()]  # a handful
    scores = {}
    for alpha in alphas:
        errors = []
        for k in folds:
            fit = fit_iterative(matrix.where(F.col(fold) != k), kind, alpha, **settings)
            held_out = matrix.where(F.col(fold) == k).select("label", fit.column_of("features").alias("yhat"))
            errors.append(held_out.agg(F.avg((F.col("label") - F.col("yhat")) * (F.col("label") - F.col("yhat")))).first()[0])
        scores[alpha] = -float(np.mean(errors))
    best = max(alphas, key=lambda a: scores[a])
    return fit_iterative(matrix, kind, best, **settings), best, scores


def select_features(sums: np.ndarray, positions: list[int]) -> np.ndarray:
    """The sums for a subset of the features."""
    keep = [0, *[p + 1 for p in positions], len(sums) - 1]
    return sums[np.ix_(keep, keep)]


def baseline_ols(df: DataFrame, x: str, y: str, by: list[str] = []) -> DataFrame:
    """Straight line on one feature, per group, fitted on train rows."""
    return df.where(F.col("split") == "train").groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.count(F.lit(1)).alias("n")
    )


def time_series_cv(fold_sums: dict[int, np.ndarray], fitters: dict) -> list[dict]:
    """Expanding-window scores per model from per-fold sums (fold 0 is train only).

    The sums of a train window are the running total of the folds before it, so no fold reads data again.
    ``fitters`` map a list of train sums to a list of fits.
    """
    tests = [fold_sums[k] for k in sorted(fold_sums) if k > 0]
    windows = [fold_sums[0]]
    for held_out in tests[:-1]:
        windows.append(windows[-1] + held_out)
    rows = []
    for name, fit_all in fitters.items():
        fits = fit_all(windows)
        rows.append(
            cv_row(name, [float(np.sqrt(f.squared_error(t) / t[0, 0])) for f, t in zip(fits, tests)])
        )
    return rows


def cv_row(name: str, scores: list[float]) -> dict:
    mean, std = float(np.mean(scores)), float(np.std(scores))
    margin = T_975_DF4 * std / np.sqrt(len(scores))
    return {
        "model": name, "mean_rmse": mean, "std_rmse": std, "min_rmse": min(scores), "max_rmse": max(scores),
        "ci_low": float(mean - margin), "ci_high": float(mean + margin),
    }


def polynomial(matrix: DataFrame, degree: int = 2) -> DataFrame:
    """All products of two features and the features themselves, as array ``x2``."""
    wide = PolynomialExpansion(degree=degree, inputCol="features", outputCol="_poly").transform(matrix)
    return wide.withColumn("x2", vector_to_array("_poly")).drop("_poly")


def fit_huber(matrix: DataFrame, max_iter: int = 50):
    """Robust linear regression; stands in for the linear support vector regression."""
    return LinearRegression(loss="huber", epsilon=1.35, maxIter=max_iter, predictionCol="yhat_huber_linear").fit(matrix)


def linear_part(fitted) -> LinearFit:
    """A Spark ML linear model as the fit used here, which scores by a Column and is stored like the others."""
    return LinearFit(float(fitted.intercept), fitted.coefficients.toArray())


@dataclass(frozen=True)
class Fourier:
    """Random features are made from these numbers, so they are stored as these numbers."""

    gamma: float
    width: int = 200
    seed: int = SEED


def random_fourier(matrix: DataFrame, gamma: float, width: int = 200, seed: int = SEED) -> DataFrame:
    """Random features whose inner products approximate the RBF kernel, as array ``z``."""
    p = len(matrix.select("x").first()["x"])
    rng = np.random.default_rng(seed)
    directions = rng.normal(0.0, np.sqrt(2 * gamma), (p, width))
    shift = rng.uniform(0, 2 * np.pi, width)

    @F.pandas_udf("array<double>")
    def project(x):
        z = np.sqrt(2.0 / width) * np.cos(np.stack(x.to_numpy()) @ directions + shift)
        return x.__class__(list(z))

    return matrix.withColumn("z", project("x"))


def kernel_gamma_of(matrix: DataFrame, x: str = "x") -> float:
    """``kernel_gamma`` from the rows, for matrices of any width."""
    total = lambda f: F.sum(F.aggregate(x, F.lit(0.0), lambda a, v: a + f(v)))
    r = matrix.agg(F.sum(F.size(x)).alias("n"), total(lambda v: v).alias("s"), total(lambda v: v * v).alias("q"), F.max(F.size(x)).alias("p")).first()
    return 1.0 / (r["p"] * (r["q"] / r["n"] - (r["s"] / r["n"]) ** 2))


def kernel_gamma(sums: np.ndarray) -> float:
    """1 / (p * variance of all matrix entries)."""
    n, p = sums[0, 0], len(sums) - 2
    mean = sums[0, 1:-1].sum() / (n * p)
    return 1.0 / (p * (np.trace(sums[1:-1, 1:-1]) / (n * p) - mean * mean))


def coefficient_report(spark: SparkSession, fits: dict[str, LinearFit], names: list[str], top: int | None = 5) -> DataFrame:
    """Coefficient statistics and the largest coefficients of every linear model, all with ``top=None``."""
    rows = []
    for model, fit in fits.items():
        size = np.abs(fit.coef)
        nonzero = int((size > 0).sum())
        for place, j in enumerate(np.argsort(-size, kind="stable")[:top], 1):
            rows.append(
                (model, place, names[j], float(fit.coef[j]), float(fit.intercept), nonzero,
                 100.0 * (1 - nonzero / len(size)), float(fit.coef.mean()), float(fit.coef.std()))
            )
    return spark.createDataFrame(
        rows,
        "model string, place int, feature string, coef double, intercept double, n_nonzero int, "
        "sparsity_pct double, mean_coef double, std_coef double",
    )


def forest_report(spark: SparkSession, forest: Forest, names: list[str], top: int = 5) -> DataFrame:
    """Largest importances, depth and node count of a forest."""
    depth, nodes = forest.size()
    found = forest.importances().orderBy(F.desc("importance"), "feature").limit(top).collect()
    rows = [(place, names[r["feature"]], r["importance"], int(depth), int(nodes)) for place, r in enumerate(found, 1)]
    return spark.createDataFrame(
        rows, "place int, feature string, importance double, max_depth int, total_nodes int"
    )


def save_fits(spark: SparkSession, fits: dict[str, LinearFit], names: list[str], path: str) -> None:
    rows = [
        (m, -1, "(intercept)", float(f.intercept)) for m, f in fits.items()
    ] + [(m, i, n, float(c)) for m, f in fits.items() for i, (n, c) in enumerate(zip(names, f.coef))]
    spark.createDataFrame(rows, "model string, position int, feature string, coef double").coalesce(1).write.mode(
        "overwrite"
    ).parquet(path)


def load_fits(spark: SparkSession, path: str) -> dict[str, LinearFit]:
    table = spark.read.parquet(path).toPandas().sort_values(["model", "position"])
    out = {}
    for model, rows in table.groupby("model"):
        values = rows["coef"].to_numpy()
        out[model] = LinearFit(float(values[0]), values[1:])
    return out


class Stopwatch:
    """Training seconds per model."""

    def __init__(self):
        self.seconds: dict[str, float] = {}

    def run(self, model: str, fit):
        start = time.perf_counter()
        out = fit()
        self.seconds[model] = time.perf_counter() - start
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, m, m, s) for i, (m, s) in enumerate(self.seconds.items())]
        return spark.createDataFrame(
            rows, "position int, model string, model_name string, training_seconds double"
        ).orderBy("training_seconds")
