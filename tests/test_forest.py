"""The forest against direct computations in NumPy."""

import functools
import operator

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterloom.operators import forest as forests


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=700), rng.integers(0, 2, 700), rng.normal(size=700).round(1), np.full(700, 3.0)])
    y = np.where(x[:, 0] > 0, 5.0, 1.0) + 2 * x[:, 1] + rng.normal(scale=0.2, size=700)
    rows = [(i, a, b) for i, (a, b) in enumerate(zip(x.tolist(), y.tolist()))]
    return x, y, spark.createDataFrame(rows, "sample_id long, x array<double>, label double").repartition(4)


def direct(bins, weight, y, node, depth, min_leaf):
    """Nodes of a tree by trying every cut of every feature: node -> (feature, bin, n)."""
    n, s = weight.sum(), (weight * y).sum()
    best = (1e-12 * s * s / n, None)
    if node.bit_length() - 1 < depth:
        for f in range(bins.shape[1]):
            for b in range(int(bins[:, f].max())):
                left = bins[:, f] <= b
                ln, ls = weight[left].sum(), (weight * y)[left].sum()
                if ln >= min_leaf and n - ln >= min_leaf:
                    gain = ls * ls / ln + (s - ls) ** 2 / (n - ln) - s * s / n
                    if gain > best[0]:
                        best = gain, (f, b)
    if best[1] is None:
        return {node: (-1, 0, n)}
    f, b = best[1]
    left = bins[:, f] <= b
    out = {node: (f, b, n)}
    for side, rows in ((0, left), (1, ~left)):
        out |= direct(bins[rows], weight[rows], y[rows], 2 * node + side, depth, min_leaf)
    return out


def test_subtrees_as_all_cuts_tried():
    rng = np.random.default_rng(1)
    for _ in range(20):
        bins = rng.integers(0, 5, (60, 3)).astype(np.uint8)
        weight, y = rng.integers(1, 4, 60).astype(float), rng.integers(-50, 50, 60).astype(float)
        first = np.array([0, 5, 10, 15])
        node, feature, cut, n, _, mean = forests.subtree(bins, weight, y, 1, 4, first, 2)
        want = direct(bins, weight, y, 1, 4, 2)
        assert set(node.tolist()) == set(want) and n.sum() == sum(w[2] for w in want.values())
        for i, f, c, m in zip(node.tolist(), feature.tolist(), cut.tolist(), n.tolist()):
            assert (f, m) == (want[i][0], want[i][2]) and (f < 0 or c == want[i][1])
        root = node.tolist().index(1)
        assert mean[root] == pytest.approx((weight * y).sum() / weight.sum())


@pytest.mark.parametrize("node_rows", [250, 40])
def test_the_same_forest_however_many_rows_a_task_may_hold(data, node_rows):
    """Upper levels by jobs over all rows, or whole trees in one task each: equal nodes."""
    _, _, df = data
    columns = ["tree", "node", "feature", "bin", "n", "prediction"]
    whole = forests.fit_forest(df, trees=6)
    split = forests.fit_forest(df, trees=6, node_rows=node_rows)
    assert split.nodes.where("upper").count() > 6 and whole.nodes.where("upper").count() == 0
    key = lambda f: sorted(map(tuple, f.nodes.select(*columns).collect()))
    assert key(whole) == key(split)
    score = lambda f: sorted((r.sample_id, r.members) for r in f.members(df).collect())
    assert score(whole) == score(split)


def test_members_follow_the_nodes(spark, data, tmp_path):
    x, _, df = data
    forest = forests.fit_forest(df, trees=4, depth=6)
    nodes = {(r.tree, r.node): r for r in forest.nodes.collect()}

    def value(row, tree):
        node = nodes[tree, 1]
        while node.feature >= 0:
            node = nodes[tree, 2 * node.node + (row[node.feature] > node.threshold)]
        return node.prediction

    got = {r.sample_id: r.members for r in forest.members(df).collect()}
    assert got == {i: [value(row, t) for t in range(4)] for i, row in enumerate(x)}
    forest.save(str(tmp_path))
    again = forests.Forest.load(spark, str(tmp_path))
    assert {r.sample_id: r.members for r in again.members(df).collect()} == got and again.size() == forest.size()


def test_it_learns_and_weighs_features(data):
    x, y, df = data
    forest = forests.fit_forest(df, trees=20)
    members = {r.sample_id: np.mean(r.members) for r in forest.members(df).collect()}
    error = np.array([members[i] - v for i, v in enumerate(y)])
    assert np.sqrt((error**2).mean()) < 0.2 * y.std()
    share = {r.feature: r.importance for r in forest.importances().collect()}
    assert sum(share.values()) == pytest.approx(1) and share[0] > share[1] > share.get(2, 0) and 3 not in share


def test_leaves_hold_their_least_rows_and_depth_is_kept(data):
    _, _, df = data
    forest = forests.fit_forest(df, trees=3, depth=3, min_leaf=20)
    assert forest.nodes.agg(F.min("n")).first()[0] >= 20 and forest.size()[0] <= 3


def test_draws_are_poisson_and_repeatable():
    rows = np.arange(200_000)
    w = forests.drawn(rows, 3, 42)
    assert (w == forests.drawn(rows, 3, 42)).all() and (w != forests.drawn(rows, 4, 42)).any()
    assert abs(w.mean() - 1) < 0.01 and abs((w == 0).mean() - np.exp(-1)) < 0.005 and abs(w.var() - 1) < 0.02


def test_constant_target_and_few_rows(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], 7.0) for i in range(5)], "sample_id long, x array<double>, label double")
    forest = forests.fit_forest(df, trees=3)
    assert [r.members for r in forest.members(df).collect()] == [[7.0] * 3] * 5 and forest.size() == (0, 3)
    lonely = spark.createDataFrame([(1, [1.0], 2.0), (2, [2.0], 4.0)], "sample_id long, x array<double>, label double")
    drawn = {t: forests.drawn(np.arange(2), t, 42).sum() for t in range(40)}
    assert 0 in drawn.values()  # with two rows some trees draw none
    members = forests.fit_forest(lonely.coalesce(1), trees=40).members(lonely).collect()
    assert all(len(r.members) == 40 and 2.0 <= min(r.members) and max(r.members) <= 4.0 for r in members)


def test_only_nodes_that_can_be_split_get_histograms(monkeypatch):
    """Most nodes of a deep tree are too small to be split; a histogram for each of them took most of the time."""
    rng, seen, found = np.random.default_rng(3), [], forests.best_splits
    bins = rng.integers(0, 32, (3000, 6)).astype(np.uint8)
    weight, y = rng.poisson(1, 3000) + 1.0, np.rint(rng.normal(0, 1e6, 3000))
    first = np.arange(7) * 32
    monkeypatch.setattr(forests, "best_splits", lambda n, *rest: (seen.append(n), found(n, *rest))[1])
    node, feature, _, n, _, _ = forests.subtree(bins, weight, y, 1, 30, first, 4)
    assert min(map(np.min, seen)) >= 8 and sum(map(len, seen)) == (n >= 8).sum()
    assert n[feature < 0].sum() == weight.sum() and n.min() >= 4
    assert set(node[1:] // 2) == set(node[feature >= 0])


def test_features_are_counted_one_at_a_time_and_only_in_nodes_that_can_be_split(monkeypatch):
    """Weights repeated for every feature, and rows carried into leaves, took most of a tree's time."""
    rng, counted, found = np.random.default_rng(4), [], np.bincount
    bins = rng.integers(0, 32, (3000, 6)).astype(np.uint8)
    weight, y = rng.poisson(1, 3000) + 1.0, np.rint(rng.normal(0, 1e6, 3000))
    monkeypatch.setattr(forests.np, "bincount", lambda index, *rest, **more: (counted.append(len(index)), found(index, *rest, **more))[1])
    node, feature, _, n, _, _ = forests.subtree(bins, weight, y, 1, 30, np.arange(7) * 32, 4)
    assert max(counted) <= 3000 and sum(counted) <= 13 * n[n >= 8].sum()
    assert n[feature < 0].sum() == weight.sum() and set(node[1:] // 2) == set(node[feature >= 0])


def test_a_subtree_is_one_row(data):
    """Scoring shuffled a row per node, tens of millions of a large forest."""
    _, _, df = data
    for node_rows in (200_000, 40):
        forest = forests.fit_forest(df, trees=5, node_rows=node_rows)
        nodes = forest.nodes
        assert forest.subtrees.count() == nodes.select("tree", "root").distinct().count() < nodes.count() / 10
        assert nodes.where("(feature >= 0) <> (threshold IS NOT NULL)").isEmpty()


def _rows_of_a_subtree(m=6000):
    rng = np.random.default_rng(11)
    wide = rng.integers(0, 32, (m, 4))
    kind = np.eye(6, dtype=np.int64)[rng.integers(0, 6, m)]  # one-hot columns
    y = np.rint((wide[:, 0] * 40 + wide[:, 1] * kind[:, 2] * 30 + rng.normal(0, 25, m)) * 1000)
    return np.hstack([wide, kind]).astype(np.uint8), rng.integers(1, 4, m).astype(float), y, np.cumsum([0, *[32] * 4, *[2] * 6])


def test_small_nodes_do_not_look_at_every_bin(monkeypatch):
    bins, weight, y, first = _rows_of_a_subtree()
    cells, dense = [], forests.best_splits
    monkeypatch.setattr(forests, "best_splits", lambda n, s, left_n, *rest: (cells.append(left_n.size), dense(n, s, left_n, *rest))[1])
    node, feature, *_ = forests.subtree(bins, weight, y, 1, 30, first, 2)
    assert (feature >= 0).sum() > 1000 and sum(cells) < (feature >= 0).sum() * first[-1] / 2


def test_all_ways_to_look_at_nodes_give_the_same_tree(monkeypatch):
    bins, weight, y, first = _rows_of_a_subtree()
    usual = forests.subtree(bins, weight, y, 1, 30, first, 2)
    for share, held in ((10**6, 0), (10**6, 10**9), (12, 0), (1, 0)):
        monkeypatch.setattr(forests, "FEW_SHARE", share)
        monkeypatch.setattr(forests, "HELD_CELLS", held)
        assert all(np.array_equal(a, b) for a, b in zip(usual, forests.subtree(bins, weight, y, 1, 30, first, 2)))


def test_packed_subtrees_keep_every_node():
    """A node took 37 bytes of disk, most of which follow from the others."""
    bins, weight, y, first = _rows_of_a_subtree()
    node, feature, cut, n, gain, s = forests.grown(bins, weight, y, 5, 30, first, 2)
    row = dict(zip(["tree", "root", "upper", "mean", "scale", *forests.UPPER, "s"], forests.packed(7, 5, 1.5, 8.0, 10, feature, cut, n, s)))
    assert sum(len(v) for v in row.values() if isinstance(v, bytes)) < 9 * len(node)
    got, want = forests.opened(row, 10), {"node": node, "feature": feature, "bin": cut, "n": n, "gain": gain / 64, "prediction": 1.5 + s / n / 8}
    assert set(got) == set(want) and all(np.array_equal(got[c], want[c]) for c in want)


@pytest.mark.parametrize("node_rows", [200_000, 60])
def test_summary_is_that_of_the_members(data, monkeypatch, node_rows):
    """Some trees at a time, in chunks of several batches, over subtrees that are repeated or not."""
    _, _, df = data
    forest = forests.fit_forest(df, trees=7, node_rows=node_rows)
    members = {r.sample_id: r.members for r in forest.members(df).collect()}
    monkeypatch.setattr(forests, "SENT_ROWS", 1400)
    monkeypatch.setattr(forests, "NODE_ROWS", 100)
    got = {r.sample_id: (r.member_mean, r.member_std) for r in forest.summary(df).collect()}
    assert len(got) == 700 and {i: m for i, (m, _) in got.items()} == {i: functools.reduce(operator.add, m, 0.0) / 7 for i, m in members.items()}
    assert [s for _, s in got.values()] == pytest.approx([np.std(members[i]) for i in got], abs=1e-9)
    assert {r.sample_id: r.members for r in forest.members(df).collect()} == members


def test_a_subtree_is_repeated_only_for_the_rows_that_arrive_there(spark, data, monkeypatch):
    """All subtrees were repeated for every NODE_ROWS rows of the table, so disk grew with its square."""
    _, _, df = data
    forest = forests.fit_forest(df, trees=5, node_rows=60)
    monkeypatch.setattr(forests, "NODE_ROWS", 60)
    coded, n = forest._coded(df, "sample_id", "x")
    shares = forest._shares(coded, spark.sparkContext.broadcast(forest.routes()))
    subtrees = forest.subtrees.where("NOT upper").count()
    assert n == 700 and len(shares) == subtrees > 40
    assert sum(shares.values()) <= subtrees + 5 * 700 / 60 < subtrees * 700 / 60 / 4


def test_rows_sent_to_subtrees_do_not_stay_on_disk(spark, data, monkeypatch):
    _, _, df = data
    wide = df.crossJoin(spark.range(20)).selectExpr("sample_id * 20 + id AS sample_id", "x", "label")

    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getPath(): files.apply(i).length() for i in range(files.length()) if files.apply(i).getName().endswith(".data")}

    before, trees = shuffled(), 40
    monkeypatch.setattr(forests, "SENT_ROWS", 10 * 14_000)
    forest = forests.fit_forest(wide, trees=trees)
    forest.summary(wide).count()
    left = sum(size for path, size in shuffled().items() if path not in before)
    assert left < trees * 14_000 / 10
