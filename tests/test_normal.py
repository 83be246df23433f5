"""The normal distribution as Columns against the standard library."""

import math
from statistics import NormalDist

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import oracles
from meterloom.functions.normal import log_normal_cdf, normal_quantile

Z = [*np.linspace(-37, 37, 371).tolist(), 0.0, 1e-9, -1e-9, 0.46875 * 2**0.5, 4 * 2**0.5, -4 * 2**0.5, -5.7, 5.7]
P = [*np.linspace(0.001, 0.999, 333).tolist(), 0.5, 0.075, 0.925, 1e-300, 1e-16, 1e-11, 1 - 1e-11, 1 - 1e-16]


def test_log_cdf(spark):
    got = [r.v for r in spark.createDataFrame([(z,) for z in Z], "z double").select(log_normal_cdf(F.col("z")).alias("v")).collect()]
    for z, v in zip(Z, got):
        want = math.log1p(-0.5 * math.erfc(z / 2**0.5)) if z > 0 else math.log(0.5 * math.erfc(-z / 2**0.5))
        assert v == pytest.approx(want, rel=1e-13, abs=1e-300), z
    far = spark.range(1).select(log_normal_cdf(F.lit(-60.0)).alias("v")).first().v  # erfc itself is zero there
    assert far == pytest.approx(-1800 - math.log(60) - 0.5 * math.log(2 * math.pi) + math.log1p(-1 / 3600 + 3 / 3600**2), rel=1e-12)


def test_quantile(spark):
    rows = spark.createDataFrame([(p,) for p in P], "p double").select(normal_quantile(F.col("p")).alias("v")).collect()
    assert [r.v for r in rows] == pytest.approx([NormalDist().inv_cdf(p) for p in P], rel=1e-14)
    none = spark.createDataFrame([(0.0,), (1.0,), (-1.0,), (2.0,), (None,)], "p double").select(normal_quantile(F.col("p")).alias("v")).collect()
    assert [r.v for r in none] == [None] * 5


def test_no_python_in_the_plan(spark):
    df = spark.range(3).select(log_normal_cdf(F.col("id").cast("double")), normal_quantile(F.col("id") / 3.0))
    assert "Python" not in df._jdf.queryExecution().toString()


def test_sql_twins(spark):
    con = duckdb.connect()
    value = lambda sql, x: con.execute(f"SELECT {sql} FROM (SELECT {x!r}::DOUBLE AS v) AS one").fetchall()[0][0]
    for z in Z[::10]:
        assert value(oracles.log_cdf_sql("v"), z) == pytest.approx(math.log(0.5 * math.erfc(-z / 2**0.5)), rel=1e-9, abs=1e-15)
    for p in P[::10]:
        assert value(oracles.quantile_sql("v"), p) == pytest.approx(NormalDist().inv_cdf(p), rel=1e-13)
