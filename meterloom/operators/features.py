"""Scenario rows -> model matrix: temporal split, train-only scaling, one-hot, folds."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterloom.operators.joins import attach
from meterloom.operators.ranking import equal_parts, exact_rank
from meterloom.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TARGET


def complete_rows(scenarios: DataFrame) -> DataFrame:
    """Rows without a missing feature or target; the estimators accept no others."""
    return scenarios.na.drop(subset=[*NUMERIC_FEATURES, *CATEGORICAL_FEATURES, TARGET])


def temporal_split(scenarios: DataFrame, test_share: float = 0.2, per_meter: bool = False) -> DataFrame:
    """The newest ``int(n * test_share)`` rows are test. Adds ``sample_id`` (position in time) and ``split``.

    Ties on the date go by meter and cutoff. The global order comes from ``exact_rank``; per meter a plain
    window does, as a meter has at most a few rows a month.
    """
    ties = ["meter_id", "cutoff_day"]
    if per_meter:
        meter = W.partitionBy("meter_id")
        ranked = scenarios.withColumns(
            {
                "sample_id": F.row_number().over(meter.orderBy("simulation_date", "month_start", "cutoff_day")).cast("bigint"),
                "n_total": F.count(F.lit(1)).over(meter),
            }
        )
    else:
        ranked = exact_rank(scenarios, [], "simulation_date", ties, "sample_id")
    n_test = F.floor(F.col("n_total") * test_share)
    return ranked.withColumn(
        "split", F.when(F.col("sample_id") > F.col("n_total") - n_test, "test").otherwise("train")
    )


def ts_folds(ranked: DataFrame, splits: int = 5) -> DataFrame:
    """Expanding-window folds over positions: test runs of n // (splits + 1) rows at the end of the series.

    ``fold`` is the test fold of a row, 0 for the leading rows that are only ever trained on; fold k trains on
    every row with a smaller fold number.
    """
    size = F.floor(F.col("n_total") / (splits + 1))
    start = F.col("n_total") - splits * size
    position = F.col("sample_id") - 1
    return ranked.withColumn(
        "fold",
        F.when(position < start, 0).otherwise(F.floor(F.try_divide(position - start, size)) + 1).cast("int"),
    )


def kfolds(ranked: DataFrame, folds: int = 5) -> DataFrame:
    """Contiguous folds of an unshuffled k-fold split, numbered from 0."""
    return ranked.withColumn(
        "fold", (equal_parts(F.col("sample_id"), F.col("n_total"), folds) - 1).cast("int")
    )


@dataclass(frozen=True)
class Preparation:
    """What the train rows say about scaling and categories."""

    mean: dict[str, float]
    std: dict[str, float]
    categories: dict[str, list] = field(default_factory=dict)

    def one_hot_columns(self) -> list[tuple[str, str, object]]:
        """(output name, source column, category), the first sorted category of each column left out."""
        return [(f"{c}_{v}", c, v) for c, values in self.categories.items() for v in values[1:]]

    def feature_names(self) -> list[str]:
        return [*self.mean, *[name for name, _, _ in self.one_hot_columns()]]


def fit_preparation(train: DataFrame, numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES) -> Preparation:
    """One aggregate over the train rows: means, population deviations and the sets of categories."""
    stats = train.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in numeric], *[F.stddev_pop(c).alias(f"{c}_std") for c in numeric]
    ).first()
    categories = {}
    for c in categorical:
        categories[c] = sorted(r[0] for r in train.select(c).where(F.col(c).isNotNull()).distinct().collect())
    return Preparation(
        {c: stats[f"{c}_mean"] for c in numeric}, {c: stats[f"{c}_std"] for c in numeric}, categories
    )


def save_preparation(spark: SparkSession, prep: Preparation, path: str) -> None:
    """One row per scaled column and category, so that stored models can score new rows."""
    rows = [("scale", i, c, json.dumps([prep.mean[c], prep.std[c]])) for i, c in enumerate(prep.mean)]
    rows += [("category", i, c, json.dumps(v)) for c, values in prep.categories.items() for i, v in enumerate(values)]
    spark.createDataFrame(rows, "part string, position int, name string, value string").write.mode("overwrite").parquet(path)


def load_preparation(spark: SparkSession, path: str) -> Preparation:
    rows = spark.read.parquet(path).orderBy("part", "name", "position").collect()
    scales = sorted((r for r in rows if r["part"] == "scale"), key=lambda r: r["position"])
    pairs = {r["name"]: json.loads(r["value"]) for r in scales}
    categories: dict[str, list] = {}
    for r in rows:
        if r["part"] == "category":
            categories.setdefault(r["name"], []).append(json.loads(r["value"]))
    order = [c for c in CATEGORICAL_FEATURES if c in categories] + [c for c in categories if c not in CATEGORICAL_FEATURES]
    return Preparation({c: m for c, (m, _) in pairs.items()}, {c: s for c, (_, s) in pairs.items()}, {c: categories[c] for c in order})


def standardize(df: DataFrame, prep: Preparation) -> DataFrame:
    """(x - mean) / population deviation of the train rows; a constant column becomes 0.

    Merging partial deviations leaves a rounding error on constant columns, so deviations that small count as none.
    """
    constant = lambda c: prep.std[c] is None or prep.std[c] <= 1e-9 * abs(prep.mean[c] or 0.0)
    scaled = lambda c: F.when(F.col(c).isNotNull(), 0.0) if constant(c) else (F.col(c) - F.lit(prep.mean[c])) / F.lit(prep.std[c])
    return df.withColumns({c: scaled(c) for c in prep.mean})


def one_hot(df: DataFrame, prep: Preparation) -> DataFrame:
    """0/1 columns; a category unseen in training is all zeros."""
    return df.withColumns(
        {name: F.when(F.col(c) == F.lit(v), 1.0).otherwise(0.0) for name, c, v in prep.one_hot_columns()}
    )


#: Features up to which rows are laid out as dense arrays.
DENSE = 1000


def sparse_matrix(wide: DataFrame, prep: Preparation, keep) -> DataFrame:
    """``model_matrix`` with sparse vectors: a row holds its numbers and one place per categorical column."""
    spark, hot = wide.sparkSession, []
    for c, values in prep.categories.items():
        if len(values) > 1:
            # the first category, and one unseen in training, take the place that the encoder drops
            places = spark.createDataFrame([(v, float(i)) for i, v in enumerate(values[1:])], f"_value {dict(wide.dtypes)[c]}, _{c}_place double")
            table = attach(wide.withColumn("_value", F.col(c)), places, ["_value"], "left")
            wide = table.fillna(float(len(values) - 1), [f"_{c}_place"]).drop("_value")
            last = spark.createDataFrame([(float(len(values) - 1),)], f"_{c}_place double")
            wide = OneHotEncoder(inputCol=f"_{c}_place", outputCol=f"_{c}_hot", dropLast=True).fit(last).transform(wide)
            hot.append(f"_{c}_hot")
    numbers = wide.withColumn("_numbers", array_to_vector(F.array(*[F.col(f"`{n}`").cast("double") for n in prep.mean])))
    whole = VectorAssembler(inputCols=["_numbers", *hot], outputCol="features").transform(numbers)
    return whole.select(*keep, "meter_id", "month_start", "cutoff_day", F.col(TARGET).alias("label"), "features").withColumn("x", vector_to_array("features"))


def model_matrix(df: DataFrame, prep: Preparation, keep=("sample_id", "n_total", "split"), dense: int = DENSE) -> DataFrame:
    """``x`` (array) and ``features`` (ML vector) in the order of ``prep.feature_names()``, ``label`` and keys.

    With more than ``dense`` features the vectors are sparse, made by joining each categorical column with its table of
    categories; ``x`` is laid out from them where it is read.
    """
    wide = standardize(df, prep)
    if len(prep.feature_names()) > dense:
        return sparse_matrix(wide, prep, keep)
    # one expression per categorical column, however many categories it has
    flags = lambda c, values: F.transform(F.lit(values), lambda v: F.when(F.col(c) == v, 1.0).otherwise(0.0))
    hot = [flags(c, values[1:]) for c, values in prep.categories.items() if len(values) > 1]
    x = F.concat(F.array(*[F.col(f"`{n}`").cast("double") for n in prep.mean]), *hot)
    return wide.select(
        *keep, "meter_id", "month_start", "cutoff_day", F.col(TARGET).alias("label"), x.alias("x")
    ).withColumn("features", array_to_vector("x"))
