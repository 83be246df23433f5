"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables and exact reranking.

A table turns a unit vector by three rounds of random signs and a fast Hadamard transform and names the signed axis
nearest to it; with several ``hashes`` a table's bucket is the tuple of their axes. Rows enter one bucket per table,
queries probe the ``probes`` buckets whose axes lie nearest to them. Rows and queries meet by bucket; a bucket with more
than BLOCK rows, or more than BLOCK queries, is split in blocks and every pair of its blocks meets, so no task holds a
whole hot bucket and nothing is left out. Within a block the distances of the original vectors decide.

Of equal vectors only the k + 1 with the smallest identifiers can be among anybody's k nearest, so only they are indexed.
How many buckets a query probes depends on the vectors' length only, not on the number of rows.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, and rows without an
identifier, take no part; vectors of different lengths do not meet; rows with equal identifier and vector count once;
ties go to the smaller identifier; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterloom.llm.common import stored, table

TABLES, PROBES, HASHES, SEED = 10, 12, 1, 20
SHARE = 1 / 8  # of a table's buckets that a query probes at least
BLOCK = 4096


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, step = x.shape[1], 1
    while step < n:
        pairs = x.reshape(len(x), -1, 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        step *= 2
    return x / math.sqrt(n)


def axes(unit: np.ndarray, number: int, hash_no: int, seed: int = SEED) -> np.ndarray:
    """Inner products of the turned vectors with all signed axes: first the positive, then the negative ones."""
    size = 1 << max(1, (unit.shape[1] - 1).bit_length())
    rng = np.random.default_rng([seed, number, hash_no, size])
    x = np.pad(unit, ((0, 0), (0, size - unit.shape[1])))
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], size))
    return np.concatenate([x, -x], axis=1)


def buckets(unit: np.ndarray, number: int, probes: int, hashes: int) -> np.ndarray:
    """The ``probes`` best buckets of one table for every row, best first."""
    codes, scores = np.zeros((len(unit), 1), np.int64), np.zeros((len(unit), 1))
    for h in range(hashes):
        value = axes(unit, number, h)
        keep = min(probes, value.shape[1])
        order = np.argsort(-value, axis=1, kind="stable")[:, :keep]
        new = (codes * value.shape[1])[:, :, None] + order[:, None, :]
        total = scores[:, :, None] + np.take_along_axis(value, order, axis=1)[:, None, :]
        codes, scores = new.reshape(len(unit), -1), total.reshape(len(unit), -1)
        best = np.argsort(-scores, axis=1, kind="stable")[:, : min(probes, scores.shape[1])]
        codes, scores = np.take_along_axis(codes, best, axis=1), np.take_along_axis(scores, best, axis=1)
    return codes


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances; where the squares leave the range of doubles, by differences over their largest."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        diff = x - q
        squares = (diff * diff).sum(axis=1)
        d = np.sqrt(squares)
        outside = ~((squares < 1e300) & (squares > 1e-290))
        if outside.any():
            most = np.abs(diff[outside]).max(axis=1)
            by = np.where((most > 0) & np.isfinite(most), most, 1.0)
            d[outside] = np.where(np.isfinite(most), by * np.sqrt(((diff[outside] / by[:, None]) ** 2).sum(axis=1)), np.inf)
    return d


def probes_of(dim: int, probes: int = PROBES, hashes: int = HASHES) -> int:
    """Buckets that a query of this length probes in each table."""
    every = (2 << max(1, (dim - 1).bit_length())) ** hashes
    return min(every, max(probes, math.ceil(every * SHARE)))


def _hashed(rows: DataFrame, number_of, tables: int, hashes: int) -> DataFrame:
    """(vec_id, vector) -> one row per table and probed bucket; vectors become bytes of doubles."""

    def run(frames):
        for pdf in frames:
            for dim, part in pdf.groupby(pdf["vector"].map(len)):
                x = np.stack(part["vector"].to_numpy()).astype(np.float64)
                scaled = x / np.abs(x).max(axis=1, keepdims=True)  # no square leaves the range of doubles
                unit = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
                raw = [v.tobytes() for v in x]
                for number in range(tables):
                    codes = buckets(unit, number, number_of(int(dim)), hashes)
                    n = codes.shape[1]
                    yield pd.DataFrame({"dim": int(dim), "number": number, "bucket": codes.ravel(), "vec_id": np.repeat(part["vec_id"].to_numpy(), n), "vector": [r for r in raw for _ in range(n)]})

    return rows.mapInPandas(run, "dim int, number int, bucket long, vec_id long, vector binary")


def nearest(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = TABLES, probes: int = PROBES, hashes: int = HASHES) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest rows found for every row for which ``is_query(id)`` holds."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    v = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.alias("vector"))
    inf = float("inf")
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != inf)) & F.exists("vector", lambda x: x != 0)
    v = v.where(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False))).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    copies = W.partitionBy("vector").orderBy("vec_id")
    rows = stored(v.dropDuplicates().withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy"), "vectors")
    queries = v.where(is_query(F.col("vec_id"))).dropDuplicates()
    index = stored(_hashed(rows, lambda dim: 1, tables, hashes), "index")
    asked = stored(_hashed(queries, lambda dim: probes_of(dim, probes, hashes), tables, hashes), "probes")

    key = ["dim", "number", "bucket"]
    blocks = lambda df, name: df.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
    sizes = stored(blocks(index, "row_blocks").join(blocks(asked, "query_blocks"), key), "sizes")  # buckets met by a query
    spread = lambda df, own, other: df.join(sizes, key).select(
        *key, F.pmod(F.xxhash64("vec_id"), F.col(f"{own}_blocks")).cast("int").alias(f"{own}_block"), F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block"), "vec_id", "vector"
    )
    meet = [*key, "row_block", "query_block"]

    def rerank(found: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(found) and len(wanted):
            ids = found["vec_id"].to_numpy()
            x = np.frombuffer(b"".join(found["vector"]), np.float64).reshape(len(ids), -1)
            for q, raw in zip(wanted["vec_id"].tolist(), wanted["vector"]):
                d = distances(x, np.frombuffer(raw, np.float64))
                d[ids == q] = np.inf
                near = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1]) if len(d) > k else np.arange(len(d))
                near = near[np.lexsort((ids[near], d[near]))][:k]
                near = near[ids[near] != q]
                out.append(pd.DataFrame({"query_id": q, "vec_id": ids[near], "score": d[near]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    left, right = spread(index, "row", "query"), spread(asked, "query", "row")
    pairs = left.groupBy(*meet).cogroup(right.groupBy(*meet)).applyInPandas(rerank, "query_id long, vec_id long, score double")
    pairs = pairs.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)
