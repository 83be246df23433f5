import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterloom.operators import sketches

AT = {"p01": 0.01, "q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}


@pytest.fixture(scope="module")
def days(spark):
    """Two groups over two years; one value fills a third of the rows, some are missing."""
    rows = spark.range(400_000).select(
        (F.col("id") % 2).alias("group_id"),
        F.expr("date_add(date'2023-01-01', cast(id % 730 AS int))").alias("date"),
        F.when(F.col("id") % 3 == 0, 5.0).when(F.col("id") % 1000 == 1, None).when(F.col("id") % 1000 == 2, float("nan")).otherwise(F.exp(F.randn(7))).alias("kwh"),
    )
    return rows


@pytest.mark.parametrize("k", [64, 1024])
def test_rank_errors_stay_within_the_bound(spark, days, tmp_path, k):
    path = str(tmp_path / "sketches")
    sketches.keep(sketches.monthly_sketches(days, ["group_id"], "kwh", k=k), path)
    known = days.where("kwh IS NOT NULL AND NOT isnan(kwh)")
    for by in (["group_id"], []):
        found = sketches.sketched_quantiles(sketches.kept(spark, path), by, AT)
        errors = sketches.rank_errors(known, by, "kwh", found, AT).collect()
        assert len(errors) == len(AT) * (2 if by else 1)
        assert max(r.rank_error for r in errors) <= sketches.rank_bound(k)
        assert sum(r["n"] for r in found.collect()) == known.count()


def test_a_month_is_sketched_again_alone(spark, days, tmp_path):
    path = str(tmp_path / "sketches")
    sketches.keep(sketches.monthly_sketches(days, ["group_id"], "kwh"), path)
    changed = days.where("date BETWEEN date'2023-03-01' AND date'2023-03-31'").withColumn("kwh", F.lit(1000.0))
    sketches.keep(sketches.monthly_sketches(changed, ["group_id"], "kwh"), path)
    assert sketches.kept(spark, path).select("month_start").distinct().count() == 24
    march, april = dt.date(2023, 3, 1), dt.date(2023, 4, 1)
    pruned = sketches.kept(spark, path, march, march)
    row = sketches.sketched_quantiles(pruned, [], AT).first()
    assert row["n"] == changed.count() and row["p01"] == row["p99"] == 1000.0
    assert "PartitionFilters: [isnotnull(month_start" in pruned._jdf.queryExecution().executedPlan().toString()
    assert sketches.sketched_quantiles(sketches.kept(spark, path, april, april), [], AT).first()["p99"] < 1000.0


def test_few_and_no_rows(spark):
    rows = spark.createDataFrame([(1, dt.date(2024, 1, 1), 3.0), (1, dt.date(2024, 2, 1), 1.0), (2, dt.date(2024, 1, 1), None), (3, None, 1.0)], "g int, date date, x double")
    found = sketches.sketched_quantiles(sketches.monthly_sketches(rows, ["g"], "x"), ["g"], {"low": 0.0, "high": 1.0})
    assert [tuple(r) for r in found.collect()] == [(1, 2, 1.0, 3.0)]
    assert sketches.sketched_quantiles(sketches.monthly_sketches(rows.where("g > 9"), [], "x"), [], {"low": 0.0}).count() == 0
