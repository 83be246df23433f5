"""File sources and sinks: semicolon CSV in, Parquet (or rounded CSV) out, prediction folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom import schemas
from meterloom.functions.calendar import month_from_text
from meterloom.functions.numeric import missing_as_null


def _read_csv(spark, path, schema, sep, mode):
    return missing_as_null(
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", True)
        .option("dateFormat", "yyyy-MM-dd")
        .option("mode", mode)
        .csv(path)
    )


def read_readings(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Meter registers with a ``meter_id`` column and our column names."""
    return _read_csv(spark, path, schemas.READINGS, ";", mode)


def read_weather(spark: SparkSession, path: str | None, mode: str = "FAILFAST") -> DataFrame:
    """Daily weather; ``path=None`` stands for the missing optional source and gives an empty table."""
    if path is None:
        return spark.createDataFrame([], schemas.WEATHER)
    return _read_csv(spark, path, schemas.WEATHER, ";", mode)


def read_household_csv(spark: SparkSession, path: str, header: dict[str, str], key: str, key_value: int) -> DataFrame:
    """A single household's own file: rename its headers, add the key, cast everything but the date to DOUBLE.

    Columns of ``header`` that the file lacks come out as NULL, so optional weather columns need no special case
    downstream. Columns the file has beyond ``header`` stay under their own names.
    """
    raw = spark.read.option("sep", ";").option("header", True).csv(path)
    out = [F.lit(key_value).cast("bigint").alias(key)]
    for theirs, ours in header.items():
        kind = "date" if ours in ("date", "read_date") else "double"
        if theirs in raw.columns:
            out.append(F.col(f"`{theirs}`").cast(kind).alias(ours))
        else:
            out.append(F.lit(None).cast(kind).alias(ours))
    extra = [F.col(f"`{c}`") for c in raw.columns if c not in header]
    return missing_as_null(raw.select(*out, *extra))


def read_monthly_csv(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Monthly base written as text: ``yyyy-MM`` becomes a DATE again."""
    df = _read_csv(spark, path, schemas.MONTHLY_TEXT, ",", mode)
    return df.withColumn("month_start", month_from_text(F.col("month_text"))).drop("month_text")


def model_from_file_name(file_name):
    """``y_pred_ridge_test.parquet`` -> ``ridge``; empty when the name has another form."""
    return F.regexp_extract(file_name, r"y_pred_(.*)_test", 1)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Long prediction table stored as ``model=…/split=…`` folders; both keys prune partitions."""
    body = T.StructType([f for f in schemas.PREDICTIONS.fields if f.name not in ("model", "split")])
    keyed = T.StructType(
        body.fields + [T.StructField("model", T.StringType()), T.StructField("split", T.StringType())]
    )
    return spark.read.schema(keyed).parquet(path)


def read_flat_predictions(spark: SparkSession, glob: str) -> DataFrame:
    """One file or folder per model named ``y_pred_<model>_test``; rows carry ``sample_id, y, yhat``."""
    body = T.StructType([f for f in schemas.PREDICTIONS.fields if f.name not in ("model", "split")])
    df = spark.read.schema(body).parquet(glob)
    return df.select(
        model_from_file_name(F.col("_metadata.file_path")).alias("model"), F.lit("test").alias("split"), "*"
    )


def write_by_year(df: DataFrame, path: str) -> None:
    """Parquet partitioned by ``year``, so later scans of a period read only its folders."""
    df.write.mode("overwrite").partitionBy("year").parquet(path)


def write_predictions(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("model", "split").parquet(path)


def write_csv(df: DataFrame, path: str, digits: int | None = None, sep: str = ",") -> None:
    """CSV sink; ``digits`` prints doubles with a fixed number of decimals."""
    if digits is not None:
        df = df.select(
            *[
                F.format_string(f"%.{digits}f", f.name).alias(f.name) if f.dataType == T.DoubleType() else F.col(f.name)
                for f in df.schema.fields
            ]
        )
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Small result tables: grid scores, training times, importances."""
    df.write.mode("overwrite").json(path)
