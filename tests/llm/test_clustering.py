import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from meterloom.llm import clustering, common
from tests.conftest import SF


def brute(rows, k, rounds, dim):
    """(vec_id, cluster, distance) for every row that takes part, and the centroids, all by Python's integers."""
    kept = [(i, [math.floor(64 * x) if abs(x) < 2.0**60 else int(x) * 64 for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [min((distance(v, c), j) for j, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        best = assign()
        for j in range(len(centroids)):
            of = [v for (_, v), (_, b) in zip(kept, best) if b == j]
            if of:
                centroids[j] = [sum(x) // len(of) for x in zip(*of)]
    return [(i, j, d) for (i, _), (d, j) in zip(kept, assign())], centroids


def run(spark, rows, k=4, rounds=3, dim=3):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    placed, centroids = clustering.clusters(df, k, rounds, dim)
    return sorted(map(repr, map(tuple, placed.collect()))), centroids, clustering.with_inertia(placed, centroids)


@pytest.mark.parametrize("spread", [0.02, 1.0, 1e5, 1e9, 1e30, 1e300])
def test_against_brute_force(spark, spread):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, spread) for _ in range(3)]) for i in range(300)]
    rows += rows[:40] + [(None, [spread, 0.0, 0.0]), (7, None), (8, []), (9, [1.0, 2.0]), (10, [1.0, None, 2.0]), (11, [math.nan, 0.0, 0.0]), (12, [math.inf, 0.0, 0.0])]
    want, centroids = brute(rows, 4, 3, 3)
    got, found, table = run(spark, rows)
    bounded = [(i, j, d if d < 1 << 63 else None) for i, j, d in want]
    assert got == sorted(map(repr, bounded)) and found == centroids
    total = sum(d for *_, d in want)
    exact = all(d is not None for *_, d in bounded)
    for r in table.collect():
        of = sum(d for _, j, d in want if j == r["cluster"])
        whole = all(d is not None for _, j, d in bounded if j == r["cluster"])
        assert r["cluster_inertia"] == (of if whole and of < 1 << 63 else None)
        assert r["inertia"] == (total if exact and total < 1 << 63 else None)
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    """Whole grids of equal distances, equal vectors as several starts, more starts than different vectors."""
    rows = [(i, [float(i % 3), float(i // 3 % 2), 0.0]) for i in range(60)]
    want, centroids = brute(rows, 16, 3, 3)
    got, found, _ = run(spark, rows, k=16)
    assert got == sorted(map(repr, want)) and found == centroids
    assert len({tuple(c) for c in found}) < 16


def test_the_tree_finds_what_all_distances_do():
    rng = np.random.default_rng(1)
    for dim, span, k in [(2, 4, 16), (3, 50, 16), (8, 3, 40), (64, 60, 16), (1, 1000, 200)]:
        centroids = rng.integers(-span, span, (k, dim))
        x = np.concatenate([rng.integers(-span, span, (500, dim)), centroids])
        tree = clustering.tree_of(centroids.tolist())
        number, best, _ = clustering.nearest(tree, x)
        d = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        assert (best == d.min(axis=1)).all() and (number == d.argmin(axis=1)).all()


def test_the_tree_leaves_centroids_out():
    """On vectors near their centroids most distances are never computed."""
    rng = np.random.default_rng(2)
    centroids = rng.integers(-4000, 4000, (64, 8))
    x = centroids[rng.integers(0, 64, 2000)] + rng.integers(-20, 20, (2000, 8))
    _, _, computed = clustering.nearest(clustering.tree_of(centroids.tolist()), x)
    assert computed < 0.5 * 64 * len(x)


def test_roots_are_exact():
    squares = np.array([0, 1, 2, 3, 4, 8, 9, (1 << 62) - 1, 1 << 62, (3037000499**2) - 1], np.int64)
    assert clustering.root(squares).tolist() == [math.isqrt(int(s)) for s in squares]


def test_edges(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert clustering.with_inertia(*clustering.clusters(empty)).collect() == []
    assert clustering.with_inertia(*clustering.clusters(empty)).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    few = [(1, [0.1] * 3), (2, [0.5] * 3)]
    want, centroids = brute(few, 4, 3, 3)
    assert run(spark, few)[:2] == (sorted(map(repr, want)), centroids)
    clash = spark.createDataFrame([(1, [0.1] * 64, 5, "x", [1.0])], "`the.id` long, embedding array<float>, vec_id long, cluster string, vector array<double>")
    placed, _ = clustering.clusters(clash, id_col="the.id")
    assert [tuple(r) for r in placed.collect()] == [(1, 0, 0)]


def test_query_as_its_sql_and_brute_force(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    result = con.execute(clustering.ORACLE)
    names = [d[0] for d in result.description]
    want = sorted(tuple(r[names.index(n)] for n in sorted(names)) for r in result.fetchall())
    got = clustering.op13_clustering(spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(tuple(r[n] for n in sorted(names)) for r in got.collect()) == want
    rows = [(r["vec_id"], r["embedding"]) for r in common.table(spark, SF, "embeddings").collect()]
    direct = brute(rows, clustering.CENTROIDS, clustering.ROUNDS, clustering.DIM)[0]
    assert sorted(direct) == sorted((r["vec_id"], r["cluster"], r["distance"]) for r in got.collect())
