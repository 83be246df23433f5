"""Order statistics against pandas, with hot values and hot groups."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterloom.operators import ranking
from meterloom.operators.joins import attach, settle


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    n = 6000
    value = np.where(rng.random(n) < 0.35, 5.0, rng.normal(5, 3, n).round(2))  # a third of all rows share a value
    group = np.where(rng.random(n) < 0.7, "hot", rng.choice(["a", "b"], n))
    pdf = pd.DataFrame({"g": group, "v": value, "id": rng.permutation(n)})
    pdf = pd.concat([pdf, pd.DataFrame({"g": ["one", "two", "two"], "v": [1.0, 2.0, 4.0], "id": [n, n + 1, n + 2]})])
    return pdf.reset_index(drop=True), spark.createDataFrame(pdf).repartition(5)


@pytest.mark.parametrize("by", [["g"], []])
@pytest.mark.parametrize("rows_per_task", [20, 10**6])
def test_rank(data, by, rows_per_task):
    pdf, df = data
    got = ranking.exact_rank(df, by, "v", ["id"], rows_per_task=rows_per_task).toPandas().set_index("id")
    ordered = pdf.sort_values(["v", "id"])
    expected = (ordered.groupby("g").cumcount() + 1) if by else pd.Series(range(1, len(pdf) + 1), ordered.index)
    expected.index = ordered["id"]
    assert (got["rank"].sort_index() == expected.sort_index()).all()


@pytest.mark.parametrize("rows_per_task", [20, 10**6])
def test_parts(data, rows_per_task):
    pdf, df = data
    part = lambda rank, total: ranking.equal_parts(rank, total, 7).cast("int")
    got = ranking.exact_parts(df, ["g"], "v", ["id"], part, "part", rows_per_task).toPandas()
    assert len(got) == len(pdf)
    merged = got.sort_values(["g", "v", "id"])
    for _, group in merged.groupby("g"):
        expected = np.concatenate([np.full(len(a), i + 1) for i, a in enumerate(np.array_split(np.arange(len(group)), 7))])
        assert (group["part"].to_numpy() == expected).all()


@pytest.mark.parametrize("by", [["g"], []])
def test_quantiles(data, by):
    pdf, df = data
    got = ranking.quantiles(df, by, "v", {"q1": 0.25, "med": 0.5, "p95": 0.95}).toPandas()
    groups = pdf.groupby("g") if by else [(None, pdf)]
    for name, group in groups:
        row = got[got["g"] == name].iloc[0] if by else got.iloc[0]
        assert [row.q1, row.med, row.p95] == pytest.approx(list(np.percentile(group["v"], [25, 50, 95])))


def test_cumulative_counts(data):
    pdf, df = data
    got = ranking.cumulative_counts(df, ["g"], "v").toPandas().sort_values(["g", "v"])
    counts = pdf.groupby(["g", "v"]).size().reset_index(name="n")
    assert (got["n_at"].to_numpy() == counts["n"].to_numpy()).all()
    assert (got["n_below"].to_numpy() == (counts.groupby("g")["n"].cumsum() - counts["n"]).to_numpy()).all()


def test_attach_beyond_the_broadcast_limit(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 10)
    small = df.groupBy("k").count()
    assert settle(small, 1000)[1] and not settle(small, 100)[1]  # bytes; the ten rows take 160
    for limit in (3, 1000):
        assert attach(df, small, ["k"], limit=limit).where("count = 10").count() == 100


def test_dates_rank_by_day(spark):
    df = spark.sql("SELECT date_add(date'2024-01-01', cast(id % 40 AS int)) AS d, id FROM range(400)")
    got = ranking.exact_rank(df, [], "d", ["id"], rows_per_task=3).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 401))
    assert [(r.d, r.id) for r in got] == sorted((r.d, r.id) for r in got)
