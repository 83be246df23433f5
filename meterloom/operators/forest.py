"""Random forest regression: level-wise histograms over distributed rows, small nodes finished in one task each.

Features are cut into at most ``bins`` bins at approximate quantiles of the train rows, once. A tree takes every row as
often as a Poisson(1) variable says that is derived from (seed, tree, row), so a task that runs again draws the same.

A node with more than ``node_rows`` rows is split by a job over all rows: tasks sum up (count, target) per feature and bin,
the sums of a node meet, and its best split goes to the driver, which keeps only these upper nodes. Once a node is small, its rows are
brought together and the whole subtree below it grows in that task, all its nodes of a level at a time. So the jobs per forest
grow with the logarithm of the rows, no task holds more than ``node_rows`` rows of a tree, and trees of any depth cost no
dense histograms for tiny nodes.

Targets are whole numbers (standardised and scaled to what doubles can add up exactly), so sums do not depend on the order
of rows, and the same rows give the same forest whatever the number of tasks.

The nodes are a table, a row per subtree with its nodes packed, level by level; ``Forest.nodes`` has them a row each. Scoring
sends rows down the upper nodes and lets them meet the subtree they arrive at; subtrees are never broadcast. Rows of one chunk
come together again with one value of each tree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.session import discard, joined, stored

# Forest size, least rows of a leaf, seed.
TREES, MIN_LEAF, SEED = 300, 2, 42
DEPTH, BINS = 30, 32
NODE_ROWS = 200_000
SENT_ROWS = 48_000_000  # rows of as many trees as this are sent to subtrees at a time, or those of one tree
FLUSH_CELLS = 8_000_000  # of histograms a task holds
LEVEL_CELLS = 100_000  # of histograms looked at together in a subtree: so few stay in a core's cache
FEW_SHARE, FEW_NODES = 12, 2000  # nodes with fewer rows than a 12th of all bins are looked at by rows, so many nodes together
HELD_CELLS = 1_000_000  # of histograms of a subtree's level that are held for the level below
CHUNK = 2000, 50_000  # least and most rows of a chunk while trees are grown or scored
SENT_BYTES = 8_000_000  # of a batch that a task sends
SLICE, LEVELS = 16_384, 4  # rows that go down a tree together, levels after which those that have arrived are left out

NODES = "tree int, node long, feature int, bin int, threshold double, n long, gain double, prediction double, upper boolean"
# A tree's upper nodes in one row with root 0, in ascending order. A subtree's nodes level by level: the feature of every node, -1
# at leaves, the bin of inner nodes, count and sum of targets (whole numbers, see ``scale``) of leaves; all else follows from these.
UPPER = {"node": "<i8", "feature": "<i4", "bin": "u1", "n": "<i8", "gain": "<f8", "prediction": "<f8"}
SUBTREES = "tree int, root long, upper boolean, mean double, scale double, " + ", ".join(f"{c} binary" for c in [*UPPER, "s"])


@dataclass(frozen=True)
class Bins:
    """Where each feature is cut: a value goes left of ``cuts[f][b]`` when it is not above it."""

    cuts: list[list[float]]

    @property
    def width(self) -> int:
        return len(self.cuts)

    def first(self) -> np.ndarray:
        """Place of each feature's first bin, and the number of all bins."""
        return np.cumsum([0, *[len(c) + 1 for c in self.cuts]])

    def of(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(self.cuts)], axis=1).astype(np.uint8)


def drawn(rows: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree takes each row: Poisson(1) from a hash of (seed, tree, row)."""
    h = rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((tree * 0xBF58476D1CE4E5B9 + seed * 0x94D049BB133111EB) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    u = (h ^ (h >> np.uint64(31))).astype(np.float64) / 2.0**64
    return np.searchsorted(POISSON, u, side="right")


POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


def best_splits(n: np.ndarray, s: np.ndarray, left_n: np.ndarray, left_s: np.ndarray, min_leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Best place of each node, the first of equal ones, and its gain; -inf where no place leaves enough rows on both sides.

    ``n`` and ``s`` are count and target of the nodes, ``left_n`` and ``left_s`` those left of every place.
    """
    right_n, score, right = n[:, None] - left_n, left_s * left_s, s[:, None] - left_s
    right *= right
    with np.errstate(divide="ignore", invalid="ignore"):
        score /= left_n
        right /= right_n
        score += right
    score[np.minimum(left_n, right_n) < min_leaf] = -np.inf
    place = score.argmax(axis=1)
    whole = s * s / n
    gain = score[np.arange(len(n)), place] - whole
    return place, np.where(gain > 1e-12 * whole, gain, -np.inf)


def left_sums(columns: np.ndarray, weights: tuple[np.ndarray, ...], at: np.ndarray, totals: tuple[np.ndarray, ...], first: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each of ``weights``, its sums up to and with every bin, a row per node; ``at`` is the node of each row.

    Of a feature with one cut only the rows above it are counted: of columns that come from categories these are few.
    """
    m, places = len(totals[0]), int(first[-1])
    out = tuple(np.empty((m, places)) for _ in weights)
    for column, low, high in zip(columns, first[:-1], first[1:]):
        if high - low > 2:
            index = at * (high - low) + column
            for left, v in zip(out, weights):
                np.cumsum(np.bincount(index, v, m * (high - low)).reshape(m, -1), axis=1, out=left[:, low:high])
            continue
        above = np.flatnonzero(column.view(np.bool_)) if high - low == 2 else None
        for left, v, total in zip(out, weights, totals):
            left[:, high - 1] = total
            if above is not None:
                left[:, low] = total - np.bincount(at[above], v[above], m)
    return out


def few_splits(columns: np.ndarray, weights: tuple[np.ndarray, ...], sizes: np.ndarray, totals: tuple[np.ndarray, ...], first: np.ndarray, min_leaf: int) -> tuple[np.ndarray, ...]:
    """``best_splits`` of nodes of few rows, and the sums left of their places: only bins that hold rows are looked at.

    Rows lie by node and are ordered by bin within it, a feature at a time; the best places of all features then compete. An
    empty bin leaves the same rows on both sides as the one before it.
    """
    m, width = len(sizes), len(columns)
    each, end = np.arange(m), np.cumsum(sizes)
    at = np.repeat(each, sizes)
    whole, before = (tuple(v[at] for v in some) for some in (totals, [np.cumsum(v) - v for v in totals]))
    place, left_n, left_s = np.zeros((m, width), np.int64), np.repeat(totals[0][:, None], width, axis=1), np.repeat(totals[1][:, None], width, axis=1)
    for f, (column, low, high) in enumerate(zip(columns, first[:-1], first[1:])):
        place[:, f] = low
        if high - low > 2:
            key = (at * (high - low) + column).astype(np.uint16 if m * (high - low) <= 1 << 16 else np.int64)
            order = np.argsort(key, kind="stable")
            key = key[order]
            ln, ls = (np.cumsum(v[order]) - b for v, b in zip(weights, before))
            rn, score, right = whole[0] - ln, ls * ls, whole[1] - ls
            right *= right
            with np.errstate(divide="ignore", invalid="ignore"):
                score /= ln
                right /= rn
                score += right
            none = np.minimum(ln, rn) < min_leaf
            none[:-1] |= key[1:] == key[:-1]
            score[none] = -np.inf
            highest = np.maximum.reduceat(score, end - sizes)
            top = np.flatnonzero(score == highest[at])[::-1]
            best = np.empty(m, np.int64)
            best[at[top]] = top  # the first of equal ones is written last
            place[:, f] += column[order[best]]
            some = np.isfinite(highest)  # elsewhere all rows stay left, which is no cut
            left_n[some, f], left_s[some, f] = ln[best[some]], ls[best[some]]
        elif high - low == 2:
            above = np.flatnonzero(column.view(np.bool_))
            for left, v in zip((left_n, left_s), weights):
                left[:, f] -= np.bincount(at[above], v[above], m)
    own, gain = best_splits(*totals, left_n, left_s, min_leaf)
    return place[each, own], gain, left_n[each, own], left_s[each, own]


def subtree(bins: np.ndarray, weight: np.ndarray, y: np.ndarray, root: int, depth: int, first: np.ndarray, min_leaf: int) -> tuple[np.ndarray, ...]:
    """Nodes of the tree below ``root``: (node, feature or -1, bin, n, gain, mean), level by level."""
    *out, n, gain, s = grown(bins, weight, y, root, depth, first, min_leaf)
    return *out, n, gain, s / n


def grown(bins: np.ndarray, weight: np.ndarray, y: np.ndarray, root: int, depth: int, first: np.ndarray, min_leaf: int) -> tuple[np.ndarray, ...]:
    """``subtree`` with the sum of targets in place of their mean.

    Rows lie by node, a feature's bins side by side, so each feature is counted without repeating weights. Rows of nodes that
    cannot be split are dropped, and a child's sums are those left or right of its parent's cut. While a level's sums may
    be held, only the smaller one of two children is counted; the larger one's are what the parent's leave. Nodes of few rows are
    looked at by rows instead of bins. Sums are whole numbers, so all ways give the same.
    """
    feature = np.repeat(np.arange(len(first) - 1), np.diff(first))
    places = int(first[-1])
    columns, weighted = np.ascontiguousarray(bins.T), weight * y
    ids, n, s = np.array([root], np.int64), np.array([weight.sum()]), np.array([weighted.sum()])
    # nodes that may be split, as their rows lie, and the rows of each; how many last ones have few; parent and sibling of those before them
    large = np.flatnonzero(n >= 2 * min_leaf)
    sizes, few, above, beside, held = np.full(len(large), len(weight)), 0, np.zeros(0, np.int64), np.zeros(0, np.int64), None
    out, level = [], root.bit_length() - 1
    step = max(1, LEVEL_CELLS // places)
    while k := len(ids):
        place, gain, left_n, left_s = np.zeros(k, np.int64), np.full(k, -np.inf), np.zeros(k), np.zeros(k)
        edge = np.concatenate([[0], np.cumsum(sizes)])
        dense, before = len(large) - few, held
        counted = dense - len(above)
        held = tuple(np.empty((dense, places)) for _ in "ns") if dense * places <= HELD_CELLS else None
        starts = [*range(0, counted, step), *range(counted, dense, step), *range(dense, len(large), FEW_NODES)] if level < depth else []
        for lo, hi in zip(starts, [*starts[1:], len(large)]):
            some, part = large[lo:hi], slice(edge[lo], edge[hi])
            if lo >= dense:
                place[some], gain[some], left_n[some], left_s[some] = few_splits(columns[:, part], (weight[part], weighted[part]), sizes[lo:hi], (n[some], s[some]), first, min_leaf)
                continue
            if lo < counted:
                at = np.repeat(np.arange(hi - lo), sizes[lo:hi])
                sums = left_sums(columns[:, part], (weight[part], weighted[part]), at, (n[some], s[some]), first)
            else:
                own = slice(lo - counted, hi - counted)
                sums = tuple(b[above[own]] - h[beside[own]] for b, h in zip(before, held))
            if held:
                for h, v in zip(held, sums):
                    h[lo:hi] = v
            place[some], gain[some] = best_splits(n[some], s[some], *sums, min_leaf)
            left_n[some], left_s[some] = (v[np.arange(hi - lo), place[some]] for v in sums)
        split = np.isfinite(gain)
        own = feature[place]
        cut = place - first[own]
        out.append((ids, np.where(split, own, -1), np.where(split, cut, 0), n, np.where(split, gain, 0.0), s))
        parent = np.repeat(large, sizes)
        down = np.flatnonzero(split[parent])
        parent = parent[down]
        child = 2 * (np.cumsum(split) - 1)[parent] + (columns[own[parent], down] > cut[parent])
        ids = (2 * ids[split][:, None] + np.arange(2)).ravel()
        n, s = (np.stack([left, whole - left], axis=1)[split].ravel() for left, whole in ((left_n, n), (left_s, s)))
        keep = n[child] >= 2 * min_leaf
        down, child = down[keep], child[keep]
        count = np.bincount(child, minlength=len(ids))
        kept = np.flatnonzero(split[large])
        lying = (np.cumsum(split) - 1)[large[kept]]  # the split nodes as their rows lie
        # nodes of few rows come last, before them those whose smaller sibling is counted
        sibling, small = np.arange(len(ids)) ^ 1, count * FEW_SHARE < places
        full, few = (count > 0) & ~small, np.count_nonzero((count > 0) & small)
        left_over = full & full[sibling] & ((count > count[sibling]) | ((count == count[sibling]) & (sibling < np.arange(len(ids)))))
        left_over &= held is not None and np.count_nonzero(full) * places <= HELD_CELLS
        large = np.concatenate([np.flatnonzero(full & ~left_over), rest := np.flatnonzero(left_over), np.flatnonzero((count > 0) & small)])
        sizes = count[large]
        where, start, holds = (np.zeros(len(ids), np.int64) for _ in range(3))
        where[large], start[large], holds[lying] = np.arange(len(large)), np.cumsum(sizes) - sizes, kept
        above, beside = holds[rest // 2], where[sibling[rest]]
        down = down[by_child(child, count, start, lying)]
        columns, weight, weighted = columns.take(down, axis=1), weight[down], weighted[down]
        level += 1
    return tuple(np.concatenate(c) for c in zip(*out))


def by_child(child: np.ndarray, count: np.ndarray, start: np.ndarray, lying: np.ndarray) -> np.ndarray:
    """Order that brings rows to lie by child, each child's from its ``start`` on; children of parent p are 2 p and 2 p + 1.

    ``count`` has the rows of each child; as they come, rows lie by parent, the parents in the order of ``lying``.
    """
    order = np.empty(len(child), np.int64)
    for side in (0, 1):
        rows, own = np.flatnonzero(child % 2 == side), count[2 * lying + side]
        order[np.arange(len(rows)) + np.repeat(start[2 * lying + side] - (np.cumsum(own) - own), own)] = rows
    return order


def descended(columns: np.ndarray, rows: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The place in a tree that each of ``rows`` arrives at; a feature's bins lie side by side in ``columns``.

    Of inner nodes ``left`` is the place of the left child, the right one follows it; leaves have feature -1.
    """
    flat, inner = columns.ravel(), feature >= 0
    # a leaf leads to itself, as nothing lies above its bin
    start, cut, left = np.where(inner, feature * columns.shape[1], 0), np.where(inner, cut, 255).astype(np.uint8), np.where(inner, left, np.arange(len(left)))
    place = np.zeros(len(rows), np.int64)
    for lo in range(0, len(rows) if inner[0] else 0, SLICE):
        at = rows[lo : lo + SLICE]
        live, now = np.arange(lo, lo + len(at)), np.zeros(len(at), np.int64)
        while len(live):
            for _ in range(LEVELS):
                now = left.take(now) + (flat.take(start.take(now) + at) > cut.take(now))
            place[live] = now
            on = np.flatnonzero(inner.take(now))
            live, now, at = live.take(on), now.take(on), at.take(on)
    return place


def route(upper: dict[int, tuple[int, int]]) -> tuple[np.ndarray, ...]:
    """A tree's upper nodes and the nodes below them as (node, feature or -1, bin, place of the left child), ascending."""
    node = np.array(sorted({1, *upper, *(2 * i + side for i in upper for side in (0, 1))}), np.int64)
    feature, cut = np.array([upper.get(i, (-1, 0)) for i in node.tolist()], np.int64).T
    return node, feature, cut, np.searchsorted(node, 2 * node)


def by_place(place: np.ndarray, places: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each place that rows arrive at, and these rows."""
    order = np.argsort(place.astype(np.min_scalar_type(places)), kind="stable")
    end = np.cumsum(np.bincount(place, minlength=places))
    for i, (lo, hi) in enumerate(zip([0, *end.tolist()], end.tolist())):
        if hi > lo:
            yield i, order[lo:hi]


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows, ``rows`` at a time."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - n)
            held, n, batch = [*held, part], n + part.num_rows, batch.slice(part.num_rows)
            if n == rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _chunk_rows(spark: SparkSession, rows: int) -> int:
    """A few chunks for each task."""
    low, high = CHUNK
    return min(high, max(low, rows // (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))))


def _sent(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of not too many bytes."""
    out, size = [], 0
    pack = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    for row in rows:
        out.append(row)
        size += 100 + sum(len(v) for v in row if isinstance(v, bytes))
        if size >= SENT_BYTES:
            yield pack()
            out, size = [], 0
    if out:
        yield pack()


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _tasks(spark: SparkSession, subtrees: int) -> int:
    """Tasks for as many subtrees as rows may ask for."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), subtrees)


def _at_once(rows: int, trees: int) -> list[range]:
    """Trees whose rows are sent together: what is sent lies on disk until they are done."""
    step = max(1, SENT_ROWS // max(1, rows))
    return [range(i, min(trees, i + step)) for i in range(0, trees, step)]


def fit_bins(rows: DataFrame, x: str = "x", bins: int = BINS) -> Bins:
    width = rows.select(F.max(F.size(x))).first()[0] or 0
    shares = [i / bins for i in range(1, bins + 1)]
    found = rows.agg(*[F.percentile_approx(F.get(x, F.lit(f)), shares, 1000).alias(f"c{f}") for f in range(width)]).first()
    return Bins([sorted(set(cuts or []))[:-1] for cuts in found])  # nothing lies above the largest


def _feature_kind(width: int) -> str:
    return "<i2" if width < 1 << 15 else "<i4"


def packed(tree: int, root: int, mean: float, scale: float, width: int, feature: np.ndarray, cut: np.ndarray, n: np.ndarray, s: np.ndarray) -> tuple:
    """A subtree by SUBTREES."""
    leaf = feature < 0
    count = n[leaf].astype(np.int64)
    count = count.astype(np.min_scalar_type(int(count.max())).newbyteorder("<"))
    return (tree, root, False, mean, scale, None, feature.astype(_feature_kind(width)).tobytes(), cut[~leaf].astype("u1").tobytes(), count.tobytes(), None, None, s[leaf].astype("<f8").tobytes())


def leaves(row, width: int) -> tuple[np.ndarray, ...]:
    """Of a packed subtree (feature, bin of inner nodes, count and sum of targets of leaves)."""
    feature, s = np.frombuffer(row["feature"], _feature_kind(width)), np.frombuffer(row["s"], "<f8")
    return feature, np.frombuffer(row["bin"], "u1"), np.frombuffer(row["n"], f"<u{len(row['n']) // len(s)}").astype(np.int64), s


def opened(row, width: int) -> dict[str, np.ndarray]:
    """The columns of UPPER for a packed row."""
    if row["upper"]:
        return {c: np.frombuffer(row[c], kind) for c, kind in UPPER.items()}
    feature, inner_cut, leaf_n, leaf_s = leaves(row, width)
    inner = feature >= 0
    cut, n, s, node, gain = np.zeros(len(feature), np.uint8), np.zeros(len(feature)), np.zeros(len(feature)), np.empty(len(feature), np.int64), np.zeros(len(feature))
    cut[inner], n[~inner], s[~inner] = inner_cut, leaf_n, leaf_s
    left = 2 * np.cumsum(inner) - 1
    levels, ids, start = [], np.array([row["root"]], np.int64), 0
    while len(ids):
        node[start : start + len(ids)] = ids
        levels.append(own := start + np.flatnonzero(inner[start : start + len(ids)]))
        start, ids = start + len(ids), (2 * node[own][:, None] + np.arange(2)).ravel()
    for own in levels[::-1]:
        low = left[own]
        n[own], s[own] = n[low] + n[low + 1], s[low] + s[low + 1]
        gain[own] = s[low] * s[low] / n[low] + s[low + 1] * s[low + 1] / n[low + 1] - s[own] * s[own] / n[own]
    return {"node": node, "feature": feature.astype(np.int32), "bin": cut, "n": n.astype(np.int64), "gain": gain / row["scale"] ** 2, "prediction": row["mean"] + s / n / row["scale"]}


@dataclass(frozen=True)
class Forest:
    """``subtrees`` by SUBTREES, with node numbers 1, 2 and 3 below it, and so on; a leaf has feature -1."""

    subtrees: DataFrame
    bins: Bins
    trees: int

    @property
    def nodes(self) -> DataFrame:
        """By NODES, a row per node, and the root of its subtree."""
        cuts, width = self.bins.cuts, self.bins.width

        def run(batches):
            for row in _rows(batches):
                out = opened(row, width)
                threshold = [cuts[f][b] if f >= 0 else None for f, b in zip(out["feature"].tolist(), out["bin"].tolist())]
                out = {"tree": row["tree"], **out, "threshold": threshold, "upper": row["upper"], "root": row["root"]}
                yield pa.RecordBatch.from_pandas(pd.DataFrame({c: out[c] for c in names}), pa.schema([(c, kinds[k]) for c, k in zip(names, types)]))

        names, types = zip(*[c.split() for c in (NODES + ", root long").split(", ")])
        kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
        return self.subtrees.mapInArrow(run, NODES + ", root long")

    def routes(self) -> dict[int, tuple[np.ndarray, ...]]:
        """Per tree the nodes above the subtrees, few and known since training, as ``route`` gives them."""
        upper: dict[int, dict[int, tuple[int, int]]] = {t: {} for t in range(self.trees)}
        for r in self.subtrees.where("upper").select("tree", "node", "feature", "bin").collect():
            node, feature, cut = (np.frombuffer(r[c], UPPER[c]).tolist() for c in ("node", "feature", "bin"))
            upper[r["tree"]] = dict(zip(node, zip(feature, cut)))
        return {t: route(u) for t, u in upper.items()}

    def _coded(self, rows: DataFrame, key: str, x: str, most: int | None = None) -> tuple[DataFrame, int]:
        """Stored chunks of rows (chunk, ids, bins), and the number of rows."""
        spark, bins, n = rows.sparkSession, self.bins, rows.count()
        most = most or _chunk_rows(spark, n)

        def code(batches):
            task = TaskContext.get().partitionId()
            for number, batch in enumerate(_chunks(batches, most)):
                b = bins.of(_matrix(batch.column(1), batch.num_rows))
                yield pa.RecordBatch.from_arrays([pa.array([(task << 32) + number]), pa.array([batch.column(0).to_numpy().astype("<i8").tobytes()], pa.binary()), pa.array([b.T.tobytes()], pa.binary())], ["chunk", "ids", "bins"])

        return stored(rows.select(F.col(key).cast("long"), x).mapInArrow(code, "chunk long, ids binary, bins binary"), tidy=True), n

    def _shares(self, coded: DataFrame, routes) -> dict[tuple[int, int], int]:
        """In how many shares the rows meet each subtree: a share has NODE_ROWS rows, or some more."""
        spark, width = coded.sparkSession, self.bins.width

        def count(batches):
            found: dict[tuple[int, int], int] = {}
            for batch in batches:
                for raw in batch.column(0).to_pylist():
                    columns = np.frombuffer(raw, np.uint8).reshape(width, -1)
                    rows = np.arange(columns.shape[1])
                    for tree, (node, *tests) in routes.value.items():
                        counts = np.bincount(descended(columns, rows, *tests), minlength=len(node))
                        for i in np.flatnonzero(counts).tolist():
                            found[tree, int(node[i])] = found.get((tree, int(node[i])), 0) + int(counts[i])
            keys = list(found)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int64()), pa.array([found[k] for k in keys], pa.int64())], ["tree", "node", "n"])

        # as many rows as the forest has subtrees
        counts = coded.select("bins").mapInArrow(count, "tree int, node long, n long").groupBy("tree", "node").agg(F.sum("n").alias("n")).collect()
        return {(r["tree"], r["node"]): -(-r["n"] // NODE_ROWS) for r in counts}

    def _values(self, coded: DataFrame, routes, shares, trees: range) -> DataFrame:
        """(chunk, tree, ats, values): what these trees say of the rows of a chunk, ``ats`` are their places in it.

        Rows go to the subtree they arrive at, and it is repeated only when very many rows arrive there.
        """
        spark, width = coded.sparkSession, self.bins.width

        def send(batches):
            def pieces():
                for batch in batches:
                    for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                        columns = np.frombuffer(raw, np.uint8).reshape(width, -1)
                        rows = np.arange(columns.shape[1])
                        for tree in trees:
                            node, *tests = routes.value[tree]
                            for place, own in by_place(descended(columns, rows, *tests), len(node)):
                                share = ((chunk >> 32) + chunk) % shares.value.get((tree, int(node[place])), 1)
                                # columns side by side: of categories they are alike, and cost next to nothing when compressed
                                yield tree, int(node[place]), share, chunk, own.astype("<u2").tobytes(), columns.take(own, axis=1).tobytes()

            yield from _sent(pieces(), pa.schema([("tree", pa.int32()), ("node", pa.int64()), ("share", pa.int32()), ("chunk", pa.int64()), ("ats", pa.binary()), ("bins", pa.binary())]))

        def lay(batches):
            def out():
                for row in _rows(batches):
                    feature, cut, n, s = leaves(row, width)
                    value = row["mean"] + s / n / row["scale"]
                    for share in range(shares.value.get((row["tree"], row["root"]), 1)):
                        yield row["tree"], row["root"], share, feature.tobytes(), cut.tobytes(), value.tobytes()

            yield from _sent(out(), pa.schema([("tree", pa.int32()), ("node", pa.int64()), ("share", pa.int32()), ("feature", pa.binary()), ("cut", pa.binary()), ("value", pa.binary())]))

        def score(wanted: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
            if not len(wanted) or not len(tree):
                return pd.DataFrame({"chunk": [], "tree": [], "ats": [], "values": []})
            feature = np.frombuffer(tree["feature"].iloc[0], _feature_kind(width)).astype(np.int64)
            inner = feature >= 0
            cut, value = np.zeros(len(feature), np.uint8), np.zeros(len(feature))
            cut[inner], value[~inner] = np.frombuffer(tree["cut"].iloc[0], "u1"), np.frombuffer(tree["value"].iloc[0], "<f8")
            sizes = [len(v) // 2 for v in wanted["ats"]]
            columns = np.concatenate([np.frombuffer(raw, np.uint8).reshape(width, -1) for raw in wanted["bins"]], axis=1)
            place = descended(columns, np.arange(columns.shape[1]), feature, cut, 2 * np.cumsum(inner) - 1)
            found = np.split(value[place], np.cumsum(sizes)[:-1])
            return pd.DataFrame({"chunk": wanted["chunk"], "tree": wanted["tree"], "ats": wanted["ats"], "values": [v.astype("<f8").tobytes() for v in found]})

        on = ["tree", "node", "share"]
        tasks = _tasks(spark, -(-sum(shares.value.get((t, int(node)), 0) for t in trees for node in routes.value[t][0]) // 4))
        sent = coded.select("chunk", "bins").mapInArrow(send, "tree int, node long, share int, chunk long, ats binary, bins binary")
        below = self.subtrees.where(~F.col("upper") & F.col("tree").between(trees[0], trees[-1])).mapInArrow(lay, "tree int, node long, share int, feature binary, cut binary, value binary")
        return sent.repartition(tasks, *on).groupBy(*on).cogroup(below.repartition(tasks, *on).groupBy(*on)).applyInPandas(score, "chunk long, tree int, ats binary, values binary")

    def members(self, rows: DataFrame, key: str = "sample_id", x: str = "x") -> DataFrame:
        """(key, members): the value of every tree, in order, for rows with a unique whole number as key."""
        spark, trees = rows.sparkSession, self.trees
        routes = spark.sparkContext.broadcast(self.routes())
        coded, _ = self._coded(rows, key, x, CHUNK[0])  # so few rows with all their values fit a task
        shares = spark.sparkContext.broadcast(self._shares(coded, routes))

        def together(chunk: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
            ids = np.frombuffer(chunk["ids"].iloc[0], "<i8")
            values = np.full((len(ids), trees), np.nan)
            for tree, at, v in zip(found["tree"], found["ats"], found["values"]):
                values[np.frombuffer(at, "<u2"), tree] = np.frombuffer(v, "<f8")
            none = np.isnan(values)  # of trees that drew no row at all, out of very few: the others' mean
            values[none] = np.broadcast_to(np.nansum(values, axis=1)[:, None] / np.maximum(1, (~none).sum(axis=1))[:, None], values.shape)[none]
            return pd.DataFrame({key: ids, "members": list(values)})

        values = self._values(coded, routes, shares, range(trees))
        return coded.select("chunk", "ids").groupBy("chunk").cogroup(values.groupBy("chunk")).applyInPandas(together, f"{key} long, members array<double>")

    def summary(self, rows: DataFrame, key: str = "sample_id", x: str = "x") -> DataFrame:
        """(key, member_mean, member_std): mean and population deviation of ``members``, without a row's values ever together.

        Some trees at a time add their values, in order, to sums per row, so disk holds the rows of some trees only. Squares are of
        distances from the first tree's value, so nothing cancels out.
        """
        spark, trees = rows.sparkSession, self.trees
        routes = spark.sparkContext.broadcast(self.routes())
        coded, n = self._coded(rows, key, x)
        shares = spark.sparkContext.broadcast(self._shares(coded, routes))
        names = ["first", "total", "apart", "squares"]
        schema = "chunk long, ids binary, trees int, " + ", ".join(f"{c} binary" for c in names)

        def add(held: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
            row = held.iloc[0]
            first, total, apart, squares = (np.zeros(len(row["ids"]) // 8) if row[c] is None else np.frombuffer(row[c], "<f8").copy() for c in names)
            seen = int(row["trees"])
            for _, own in found.groupby("tree"):
                value = np.empty(len(total))
                for at, v in zip(own["ats"], own["values"]):
                    value[np.frombuffer(at, "<u2")] = np.frombuffer(v, "<f8")
                first = first if seen else value
                seen += 1
                total += value
                value = value - first
                apart += value
                squares += value * value
            return pd.DataFrame([(row["chunk"], row["ids"], seen, *[v.astype("<f8").tobytes() for v in (first, total, apart, squares)])], columns=["chunk", "ids", "trees", *names])

        def out(batches):
            for row in _rows(batches):
                seen = max(1, row["trees"])
                total, apart, squares = (np.frombuffer(row[c], "<f8") for c in names[1:])
                # a tree that drew no row at all, out of very few, has the others' mean
                deviation = np.sqrt(np.maximum(0.0, squares - apart * apart / seen) / trees)
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(row["ids"], "<i8")), pa.array(total / seen), pa.array(deviation)], [key, "member_mean", "member_std"])

        sums = coded.select("chunk", "ids", F.lit(0).alias("trees"), *[F.lit(None).cast("binary").alias(c) for c in names])
        before = None
        for some in _at_once(n, trees):
            values = self._values(coded, routes, shares, some)
            sums = stored(sums.groupBy("chunk").cogroup(values.groupBy("chunk")).applyInPandas(add, schema), tidy=True)
            discard(*filter(None, [before]))
            before = sums
        discard(coded)
        return sums.mapInArrow(out, f"{key} long, member_mean double, member_std double")

    def importances(self) -> DataFrame:
        """(feature, importance): a feature's share of each tree's gain, averaged over trees."""
        width = self.bins.width

        def run(batches):
            for row in _rows(batches):
                nodes = opened(row, width)
                feature, gain = nodes["feature"], nodes["gain"]
                own = np.bincount(feature[feature >= 0], gain[feature >= 0])
                some = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), row["tree"]), pa.int32()), pa.array(some, pa.int32()), pa.array(own[some], pa.float64())], ["tree", "feature", "gain"])

        gains = self.subtrees.mapInArrow(run, "tree int, feature int, gain double").groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
        totals = gains.groupBy("tree").agg(F.sum("gain").alias("total"))
        return gains.join(totals, "tree").groupBy("feature").agg((F.sum(F.col("gain") / F.col("total")) / F.lit(float(self.trees))).alias("importance"))

    def size(self) -> tuple[int, int]:
        """Depth and number of nodes."""
        width = self.bins.width

        def run(batches):
            for row in _rows(batches):
                if row["upper"]:
                    node = np.frombuffer(row["node"], UPPER["node"])
                    deepest, n = int(node[-1]).bit_length(), len(node)
                else:
                    before = np.concatenate([[0], np.cumsum(np.frombuffer(row["feature"], _feature_kind(width)) >= 0)])
                    deepest, n, end = int(row["root"]).bit_length(), len(before) - 1, 1
                    while end < n:  # the nodes up to a level's end have so many children, and the root before them
                        deepest, end = deepest + 1, 1 + 2 * int(before[end])
                yield pa.RecordBatch.from_arrays([pa.array([deepest - 1], pa.int32()), pa.array([n], pa.int64())], ["depth", "n"])

        r = self.subtrees.mapInArrow(run, "depth int, n long").agg(F.max("depth").alias("depth"), F.sum("n").alias("n")).first()
        return r["depth"], r["n"]

    def save(self, path: str) -> None:
        spark = self.subtrees.sparkSession
        self.subtrees.write.mode("overwrite").parquet(f"{path}/subtrees")
        cuts = [(f, c) for f, c in enumerate(self.bins.cuts)]
        spark.createDataFrame(cuts, "feature int, cuts array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/bins")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forest:
        cuts = [list(r["cuts"]) for r in spark.read.parquet(f"{path}/bins").orderBy("feature").collect()]
        subtrees = spark.read.parquet(f"{path}/subtrees")
        return Forest(subtrees, Bins(cuts), subtrees.agg(F.max("tree")).first()[0] + 1)


def fit_forest(matrix: DataFrame, trees: int = TREES, depth: int = DEPTH, min_leaf: int = MIN_LEAF, seed: int = SEED, bins: int = BINS, node_rows: int = NODE_ROWS, x: str = "x", label: str = "label") -> Forest:
    spark = matrix.sparkSession
    rows = stored(matrix.select(x, F.col(label).cast("double").alias("label")).withColumn("row", F.monotonically_increasing_id()), tidy=True)
    cut = fit_bins(rows, x, bins)
    first, width = cut.first(), cut.width
    feature = np.repeat(np.arange(width), np.diff(first))
    places = int(first[-1])
    stats = rows.agg(F.count("label").alias("n"), F.avg("label").alias("mean"), F.max("label").alias("high"), F.min("label").alias("low")).first()
    mean, spread = stats["mean"], (stats["high"] - stats["low"]) or 1.0
    scale = 2.0 ** (50 - (2 * stats["n"]).bit_length()) / spread  # sums of all rows stay below 2**53
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stats["n"] // node_rows))
    most = _chunk_rows(spark, stats["n"])

    def coded(batches):
        for batch in _chunks(batches, most):
            b = cut.of(_matrix(batch.column(1), batch.num_rows))
            y = np.rint((batch.column(2).to_numpy() - mean) * scale)
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (batch.column(0).to_numpy().astype("<i8"), b.T, y.astype("<f8"))], ["row", "bins", "y"])

    train = stored(rows.select("row", x, "label").mapInArrow(coded, "row binary, bins binary, y binary").repartition(tasks), tidy=True)
    discard(rows)

    def parts(batches, routes, wanted):
        """Of each chunk and wanted tree (tree, bins by feature, targets, rows that the tree takes, how often, place they arrive at)."""
        for batch in batches:
            for raw_row, raw, raw_y in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                row, columns, y = np.frombuffer(raw_row, "<i8"), np.frombuffer(raw, np.uint8).reshape(width, -1), np.frombuffer(raw_y, "<f8")
                for tree in wanted:
                    w = drawn(row, tree, seed)
                    taken = np.flatnonzero(w)
                    yield tree, columns, y, taken, w[taken], descended(columns, taken, *routes[tree][1:])

    # upper nodes, a level of all trees at a time
    upper: dict[int, dict[int, tuple[int, int]]] = {t: {} for t in range(trees)}
    found: dict[int, list[tuple]] = {}
    large = {(t, 1) for t in range(trees)} if stats["n"] > node_rows else set()
    while large:
        known = spark.sparkContext.broadcast({t: route(u) for t, u in upper.items()})
        nodes_of: dict[int, list[int]] = {}
        for tree, node in sorted(large):
            nodes_of.setdefault(tree, []).append(node)
        wanted = spark.sparkContext.broadcast(nodes_of)

        def sums(batches):
            held: dict[int, np.ndarray] = {}
            schema = pa.schema([("tree", pa.int32()), ("node", pa.int64()), ("sums", pa.binary())])
            pack = lambda: _sent(((t, node, v[:, i].tobytes()) for t, both in held.items() for i, (node, v) in enumerate(zip(wanted.value[t], [both] * both.shape[1]))), schema)
            for tree, columns, y, taken, w, place in parts(batches, known.value, list(wanted.value)):
                own = np.array(wanted.value[tree])
                number = np.full(len(known.value[tree][0]), -1)
                number[np.searchsorted(known.value[tree][0], own)] = np.arange(len(own))
                at = number[place]
                some = np.flatnonzero(at >= 0)
                at, columns = at[some], columns.take(taken[some], axis=1)
                weight = w[some].astype(np.float64)
                weights = weight, weight * y[taken[some]]
                both = np.stack(left_sums(columns, weights, at, tuple(np.bincount(at, v, len(own)) for v in weights), first))
                held[tree] = held[tree] + both if tree in held else both
                if sum(v.size for v in held.values()) > 2 * FLUSH_CELLS:
                    yield from pack()
                    held.clear()
            yield from pack()

        def choose(pdf: pd.DataFrame) -> pd.DataFrame:
            ln, ls = sum(np.frombuffer(s).reshape(2, 1, places) for s in pdf["sums"])
            n, s = ln[:, first[1] - 1], ls[:, first[1] - 1]
            place, gain = best_splits(n, s, ln, ls, min_leaf)
            at = int(place[0])
            return pd.DataFrame({"tree": pdf["tree"].iloc[:1], "node": pdf["node"].iloc[:1], "place": at, "n": n, "s": s, "left": ln[0, at], "gain": gain})

        split = train.mapInArrow(sums, "tree int, node long, sums binary").groupBy("tree", "node").applyInPandas(choose, "tree int, node long, place int, n double, s double, left double, gain double")
        split = stored(split, tidy=True)
        large = set()
        for r in split.collect():  # an upper node stands for more than node_rows rows
            if math.isfinite(r["gain"]) and r["node"].bit_length() - 1 < depth:
                f = int(feature[r["place"]])
                b = r["place"] - int(first[f])
                upper[r["tree"]][r["node"]] = (f, b)
                found.setdefault(r["tree"], []).append((r["node"], f, b, r["n"], r["gain"] / scale**2, mean + r["s"] / r["n"] / scale))
                large |= {(r["tree"], 2 * r["node"] + side) for side, size in enumerate((r["left"], r["n"] - r["left"])) if size > node_rows}
        discard(split)

    # all other nodes, a subtree per task, some trees at a time
    known = spark.sparkContext.broadcast({t: route(u) for t, u in upper.items()})

    def spread_out(some):
        def run(batches):
            def pieces():
                for tree, columns, y, taken, w, place in parts(batches, known.value, some):
                    for at, own in by_place(place, len(known.value[tree][0])):
                        rows = taken[own]
                        yield tree, int(known.value[tree][0][at]), columns.take(rows, axis=1).tobytes(), w[own].astype(np.uint8).tobytes(), y[rows].tobytes()

            yield from _sent(pieces(), pa.schema([("tree", pa.int32()), ("node", pa.int64()), ("bins", pa.binary()), ("w", pa.binary()), ("y", pa.binary())]))

        return run

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree, root = int(pdf["tree"].iloc[0]), int(pdf["node"].iloc[0])
        columns = np.concatenate([np.frombuffer(b, np.uint8).reshape(width, -1) for b in pdf["bins"]], axis=1)
        w, y = np.frombuffer(b"".join(pdf["w"]), np.uint8).astype(np.float64), np.frombuffer(b"".join(pdf["y"]))
        _, f, at, n, _, s = grown(columns.T, w, y, root, depth, first, min_leaf)
        return pd.DataFrame([packed(tree, root, mean, scale, width, f, at, n, s)], columns=["tree", "root", "upper", "mean", "scale", *UPPER, "s"])

    done = []
    for some in _at_once(stats["n"], trees):
        sent = train.mapInArrow(spread_out(some), "tree int, node long, bins binary, w binary, y binary")
        subtrees = sum(len(upper[t]) + 1 for t in some)
        done.append(stored(sent.repartition(_tasks(spark, subtrees), "tree", "node").groupBy("tree", "node").applyInPandas(grow, SUBTREES), tidy=True))
    above = [(tree, 0, True, mean, scale, *[np.asarray(v).astype(kind).tobytes() for kind, v in zip(UPPER.values(), zip(*sorted(nodes)))], None) for tree, nodes in found.items()]
    if above:
        done.append(stored(spark.createDataFrame(above, SUBTREES)))
    discard(train)
    return Forest(joined(done), cut, trees)
