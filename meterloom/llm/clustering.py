"""Centroid clustering of integer vectors, each vector placed through a vantage-point tree over the centroids.

Every round builds the tree anew from the current centroids and broadcasts it; a task reads its vectors batch by batch.
For each vector the open node with the smallest lower bound is looked at next: its centroid's distance is exact, and the
triangle inequality, over the range of distances that each subtree keeps to its vantage point, bounds the subtree's
centroids from below. A node is left out only when its bound is beyond the best distance, never when it equals it, and of equal
distances the smaller number wins. All of a batch's vectors do their next step together, each at its own node.

Distances and bounds are integers: squared distances exactly, and roots rounded down, or up where that widens a bound, so no
rounding prunes a nearest centroid. Batches whose components could leave 64 bits are computed with Python's integers.

Every task adds up its vectors per cluster, so a cluster that holds most rows is one row per task before anything is shuffled;
the new centroid is the exact floor of sum / count. A cluster without vectors keeps its centroid.

Defined results: vectors that are null, of another length, or hold null or non-finite components take no part; repeated
rows each count and each get a result; the starting order is by hash, of equal identifiers by vector, rows without an
identifier last; with fewer vectors than centroids each vector is a start; a distance or sum beyond 64 bits is null; an empty
table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import stored, table

CENTROIDS, ROUNDS, DIM, SCALE, SEED = 16, 3, 64, 64, 1
SMALL = 1 << 27  # components below it leave squared distances of up to 64 of them within 63 bits
LONG = (1 << 63) - 1


def root(squares: np.ndarray) -> np.ndarray:
    """Square roots rounded down, exactly."""
    if squares.dtype == object:
        return np.array([math.isqrt(x) for x in squares], object)
    r = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    r -= r * r > squares
    return r + ((r + 1) * (r + 1) <= squares)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    diff = a - b
    return (diff * diff).sum(axis=-1) if diff.dtype == object else np.einsum("...i,...i->...", diff, diff)


class Tree(NamedTuple):
    """Nodes of a vantage-point tree: a centroid's number, two subtrees (-1: none) and how far their centroids are."""

    centroids: np.ndarray  # (centroids, dim), integers
    number: np.ndarray
    child: np.ndarray  # (nodes, 2)
    near: np.ndarray  # (nodes, 2): least distance of the subtree to the vantage point, rounded down
    far: np.ndarray  # greatest distance, rounded up


def tree_of(centroids: list[list[int]]) -> Tree:
    small = all(abs(x) < SMALL for c in centroids for x in c)
    points = np.array(centroids, np.int64 if small else object)
    nodes: list[tuple] = []

    def build(members: list[int]) -> int:
        """The member farthest from the first is the vantage point; the others are halved by distance to it."""
        if not members:
            return -1
        at = len(nodes)
        nodes.append(())
        away = squared(points[members], points[members[0]])
        top = members[int(np.argmax(away))]
        rest = [m for m in members if m != top]
        d = squared(points[rest], points[top]) if rest else np.zeros(0, points.dtype)
        order = np.argsort(d, kind="stable")
        halves = order[: (len(rest) + 1) // 2], order[(len(rest) + 1) // 2 :]
        least = [math.isqrt(int(d[h].min())) if len(h) else 0 for h in halves]
        most = [math.isqrt(int(d[h].max())) + 1 if len(h) else 0 for h in halves]
        nodes[at] = top, [build([rest[i] for i in h]) for h in halves], least, most
        return at

    build(list(range(len(centroids))))
    kind = np.int64 if small else object
    return Tree(points, np.array([n[0] for n in nodes]), np.array([n[1] for n in nodes]), np.array([n[2] for n in nodes], kind), np.array([n[3] for n in nodes], kind))


def nearest(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid of every vector, and how many distances were computed."""
    if tree.centroids.dtype == object:
        vectors = vectors.astype(object)
    n, nodes = len(vectors), len(tree.number)
    kind = vectors.dtype
    bound = np.zeros((n, nodes), kind)
    is_open = np.zeros((n, nodes), bool)
    is_open[:, 0] = True
    number = np.full(n, len(tree.centroids))
    best = np.zeros(n, kind)  # counts once a number is known
    live, computed = np.arange(n), 0
    while len(live):
        # the open node with the smallest bound, if that does not lie beyond the best distance
        at = bound[live]
        at[~is_open[live]] = at.max() + 1 if len(at) else 0
        node = at.argmin(axis=1).astype(np.intp)
        low = at[np.arange(len(live)), node]
        go = is_open[live, node] & ((number[live] == len(tree.centroids)) | (low * low <= best[live]).astype(bool))
        live, node, low = live[go], node[go], low[go]
        if not len(live):
            break
        is_open[live, node] = False
        own = tree.number[node]
        d = squared(vectors[live], tree.centroids[own])
        computed += len(live)
        better = ((number[live] == len(tree.centroids)) | (d < best[live]).astype(bool) | ((d == best[live]).astype(bool) & (own < number[live])))
        number[live[better]], best[live[better]] = own[better], d[better]
        down = root(d)
        up = down + 1
        for side in (0, 1):
            child = tree.child[node, side]
            there = child >= 0
            if there.any():
                limit = np.maximum(np.maximum(down - tree.far[node, side], tree.near[node, side] - up), low)[there]
                bound[live[there], child[there]] = limit
                is_open[live[there], child[there]] = True
    return number, best, computed


def scaled(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of doubles; ``scale`` is a power of two, so the product is exact."""
    if not len(values) or np.abs(values).max() < SMALL / scale:
        return np.floor(values * scale).astype(np.int64)
    whole = lambda x: int(x) * scale if abs(x) >= 2.0**60 else math.floor(x * scale)
    return np.array([[whole(x) for x in v] for v in values.tolist()], object).reshape(values.shape)


def sound(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors take part, and their components as doubles."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    fit = lengths == dim
    kept = column.filter(pa.array(fit))
    flat = kept.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)  # null becomes NaN
    ok = np.isfinite(values).all(axis=1)
    fit[fit] = ok
    return fit, values[ok]


def _blocks(batches: Iterator[pa.RecordBatch], dim: int, rows: int = 4096):
    """(identifiers, integer vectors) in blocks of bounded size."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            fit, values = sound(part.column(1), dim)
            if fit.any():
                yield part.column(0).filter(pa.array(fit)), scaled(values)


def _long(values) -> list:
    return [x if -LONG - 1 <= x <= LONG else None for x in map(int, values)]


def starts(vectors: DataFrame, centroids: int, dim: int, seed: int) -> list[list[int]]:
    """The vectors whose ``seed:identifier`` has the smallest hashes."""
    fit = F.coalesce((F.size("vector") == dim) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
    first = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = vectors.where(fit).orderBy(F.asc_nulls_last(first), "vector").select("vector").limit(centroids)
    return [scaled(np.array([r["vector"]], np.float64))[0].tolist() for r in chosen.collect()]


def moved(vectors: DataFrame, centroids: list[list[int]], dim: int) -> list[list[int]]:
    """The centroids after one round."""
    tree = vectors.sparkSession.sparkContext.broadcast(tree_of(centroids))  # as many vectors as centroids
    schema = "cluster int, n long, sums array<string>"

    def add(batches):
        count, total = [0] * len(centroids), [[0] * dim for _ in centroids]
        for _, x in _blocks(batches, dim):
            number = nearest(tree.value, x)[0]
            for c in np.unique(number).tolist():
                part = x[number == c]
                count[c] += len(part)
                total[c] = [a + b for a, b in zip(total[c], part.sum(axis=0).tolist())]
        used = [c for c, n in enumerate(count) if n]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([count[c] for c in used], pa.int64()), pa.array([list(map(str, total[c])) for c in used], pa.list_(pa.string()))], ["cluster", "n", "sums"])

    def together(pdf):
        sums = [sum(map(int, column)) for column in zip(*pdf["sums"])]
        return pdf.iloc[:1].assign(n=pdf["n"].sum(), sums=[list(map(str, sums))])

    out = list(centroids)
    for r in vectors.mapInArrow(add, schema).groupBy("cluster").applyInPandas(together, schema).collect():  # a row per centroid
        out[r["cluster"]] = [int(s) // r["n"] for s in r["sums"]]
    return out


def clusters(rows: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, dim: int = DIM, seed: int = SEED, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of every vector that takes part, stored, and the centroids."""
    vectors = rows.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    found = starts(vectors, centroids, dim, seed)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    if not found:
        return rows.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance long"), []
    for _ in range(rounds):
        found = moved(vectors, found, dim)
    tree = rows.sparkSession.sparkContext.broadcast(tree_of(found))

    def place(batches):
        for ids, x in _blocks(batches, dim):
            number, distance, _ = nearest(tree.value, x)
            yield pa.RecordBatch.from_arrays([ids, pa.array(number, pa.int32()), pa.array(_long(distance), pa.int64())], ["vec_id", "cluster", "distance"])

    return stored(vectors.mapInArrow(place, f"vec_id {kind}, cluster int, distance long"), "clusters"), found


def with_inertia(placed: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Add the distances' sums over the cluster and over all, and the centroid's SHA-256."""
    exact = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))  # null with a null distance
    sums = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(exact.alias("s")).collect()}  # a row per centroid
    whole = sum(map(int, sums.values())) if None not in sums.values() else None
    known = lambda s: None if s is None or int(s) > LONG else int(s)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    at = lambda values, kind: F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1) if values else F.lit(None).cast(kind)
    return placed.select(
        "*",
        at([known(sums.get(c)) for c in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(known(whole)).cast("long").alias("inertia"),
        at(digest, "string").alias("centroid_sha256"),
    )


def op13_clustering(spark, sf_dir: str) -> DataFrame:
    return with_inertia(*clusters(table(spark, sf_dir, "embeddings")))


def _oracle() -> str:
    ctes = [
        f"k AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings "
        f"WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = {DIM})",
        f"c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h, v) - 1)::INT AS cluster, v AS c FROM (SELECT sha256('{SEED}:' || vec_id) AS h, v FROM k ORDER BY h NULLS LAST, v LIMIT {CENTROIDS}))",
    ]
    for i in range(ROUNDS + 1):
        ctes.append(
            f"a{i} AS MATERIALIZED (SELECT rid, min(struct_pack(d := d, cluster := cluster)) AS best FROM (SELECT rid, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d "
            f"FROM k CROSS JOIN c{i}) GROUP BY rid)"
        )
        if i < ROUNDS:
            ctes.append(
                f"s{i} AS (SELECT best.cluster AS cluster, j, sum(v[j]) AS s, count(*) AS n FROM a{i} JOIN k USING (rid) CROSS JOIN range(1, {DIM + 1}) r(j) GROUP BY best.cluster, j)"
            )
            exact = "(CASE WHEN s >= 0 THEN s // n ELSE -((-s + n - 1) // n) END)::BIGINT"
            ctes.append(
                f"c{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(m, c) AS c FROM c{i} LEFT JOIN (SELECT cluster, list({exact} ORDER BY j) AS m FROM s{i} GROUP BY cluster) USING (cluster))"
            )
    return (
        "WITH " + ",\n".join(ctes) + f"\nSELECT vec_id, cluster, d AS distance, sum(d) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia, "
        f"sha256(array_to_string(c, ',')) AS centroid_sha256 FROM (SELECT rid, best.d AS d, best.cluster AS cluster FROM a{ROUNDS}) JOIN k USING (rid) JOIN c{ROUNDS} USING (cluster)"
    )


ORACLE = _oracle()
