import math

import numpy as np
import pytest

from meterloom.llm import common, neighbours
from tests.conftest import SF


def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        at = list(ids).index(q)
        d = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
        near = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(d[i])) for i in near]
    return out


def test_recall_and_scores(spark):
    df = common.table(spark, SF, "embeddings")
    rows = df.orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    want = brute(ids, x, ids[ids % 20 == 0], 10)
    got = {}
    for r in neighbours.nearest(df, lambda v: v % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    hit = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    assert hit >= 0.9 * 10 * len(want)
    for q in got:
        exact = {a: s for a, s in brute(ids, x, [q], len(ids))[q]}
        assert all(abs(exact[a] - s) < 1e-12 for a, s in got[q]) and got[q] == sorted(got[q], key=lambda p: (p[1], p[0]))


def test_hadamard_keeps_lengths_and_buckets_split_evenly():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 16))
    assert np.allclose(np.linalg.norm(neighbours.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    one = neighbours.buckets(unit, 0, 3, 1)
    assert one.shape == (200, 3) and len(set(one[:, 0])) > 16 and (np.diff(np.sort(one, axis=1), axis=1) > 0).all()
    two = neighbours.buckets(unit, 0, 5, 2)
    assert two.shape == (200, 5) and (two[:, 0] // 32 == one[:, 0]).all()


@pytest.fixture(scope="module")
def odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(60)]
    rows += [(100 + i, [0.5, 0.5, 0.5]) for i in range(40)]  # copies: ties by identifier
    rows += [(0, [0.0, 1.0, 0.0])] * 2  # repeated rows
    rows += [(200, None), (201, []), (202, [0.0, 0.0, 0.0]), (203, [1.0, None, 2.0]), (204, [nan, 1.0, 1.0]), (205, [inf, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (206, [1.0, 2.0])]
    return spark.createDataFrame([(*r, 1, 2.0, 3) for r in rows], "vec_id long, embedding array<double>, bucket int, score double, rank int")


def test_ties_copies_and_unsound_vectors(odd):
    sound = [r for r in odd.collect() if r["vec_id"] is not None and (r["vec_id"] < 200)]
    table = {r["vec_id"]: r["embedding"] for r in sound}
    ids = np.array(sorted(table))
    want = brute(ids, np.array([table[i] for i in ids]), [0, 50, 100, 130], 10)
    got = {}
    for r in neighbours.nearest(odd, lambda v: v.isin(0, 50, 100, 130, 200, 202, 204, 206)).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == want


def test_empty_and_lonely(odd):
    assert neighbours.nearest(odd.where("false"), lambda v: v % 2 == 0).count() == 0
    assert neighbours.nearest(odd.where("vec_id = 1"), lambda v: v % 1 == 0).count() == 0


def test_hot_buckets_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(1, 8)) + 0.01 * rng.normal(size=(150, 8)), rng.normal(size=(50, 8))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(df, lambda v: v % 10 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {q: [a for a, _ in v] for q, v in brute(np.arange(200), x, range(0, 200, 10), 10).items()}


@pytest.mark.parametrize("dim", [64, 256])
def test_recall_with_the_probes_of_any_table(dim):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, dim))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    asked = unit[:60]
    near = np.argsort(asked @ unit.T, axis=1)[:, -11:-1]
    met = np.zeros((60, 1500), bool)
    for number in range(neighbours.TABLES):
        own, probed = neighbours.buckets(unit, number, 1, 1), neighbours.buckets(asked, number, neighbours.probes_of(dim), 1)
        met |= (own[None, :, :] == probed[:, None, :]).any(axis=2)
    assert np.take_along_axis(met, near, axis=1).mean() >= 0.9 and not met.all()


def test_distances_of_very_large_and_small_vectors(spark):
    rng = np.random.default_rng(4)
    for scale in (1e-200, 1e-160, 1.0, 1e160, 1e200, 1e305):
        x = rng.normal(size=(40, 8)) * scale
        df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
        rows = neighbours.nearest(df, lambda i: i % 20 == 0, k=5).orderBy("query_id", "rank").collect()
        for q in (0, 20):
            want = sorted((math.dist(x[q] / scale, x[j] / scale), j) for j in range(40) if j != q)[:5]
            own = [r for r in rows if r["query_id"] == q]
            assert [r["vec_id"] for r in own] == [j for _, j in want]
            assert np.allclose([r["score"] / scale for r in own], [d for d, _ in want], rtol=1e-12)
    assert neighbours.distances(np.array([[1.7e308], [1.0]]), np.array([-1.7e308])).tolist() == [math.inf, 1.7e308]
