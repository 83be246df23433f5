"""Sharding by minimax contiguous partition of ordered atomic groups, in DataFrame operations only.

Documents with equal texts are one group and stay together. Groups are ordered by the SHA-256 of their text, which mixes
sources and lengths. The smallest capacity is searched by bisection for which filling shards greedily in that order, each up
to the capacity, needs no more shards than there are; the order is cut where that filling ends a shard. A group larger than
the fair share of what is left would make that capacity its own size and leave other shards empty: such groups, the
largest first, get a shard each, and the others are partitioned among the remaining shards. A group has the order key of
its text, 60 bits of the hash; texts that meet there by chance only stay together as well.

Rows are narrow (no text) and sorted across tasks by (key, identifier, place in the input), so that rows of one frequent
text are dealt over tasks too; a slot is a row's place in its task plus the rows of its shard in earlier tasks. The driver
sees sums over cells of the key only: the filling at the resolution of the cells tells between which cells a shard
can end for any capacity that is still possible, and only those cells are split further, until a cut cannot fall inside one. The
number of cells read so is bounded by shards and ``SPLIT_BITS``, not by the groups; the result is exact.

Defined results: a null text is an empty one, with only the overhead as its size, and in the group of the empty text;
repeated rows each get a slot, in any order among themselves; with fewer groups than shards some shards stay empty; an empty
table gives no rows; only the named identifier and text columns are read.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterloom.llm.common import id_text, stored, table

SHARDS, OVERHEAD = 40, 16
KEY_BITS, FIRST_BITS, SPLIT_BITS = 60, 14, 5
IN_TASK = (1 << 33) - 1  # of monotonically_increasing_id


class Cell(NamedTuple):
    """Groups whose keys run from ``low`` to ``high``; a single group when both are equal."""

    low: int
    high: int
    size: int


def filled(cells: list[Cell], capacity: int, shards: int, inside: bool) -> tuple[list[int], bool]:
    """Where each shard ends when it takes all it can, in bytes of the order, and whether that reaches the end.

    ``inside`` lets a shard end anywhere within a cell of several groups, else only between cells.
    """
    ends = list(accumulate(c.size for c in cells))
    total, at, cuts = ends[-1] if ends else 0, 0, []
    for _ in range(shards):
        if at == total:
            break
        i = bisect_right(ends, at + capacity)
        if inside and i < len(cells) and cells[i].low < cells[i].high:
            at += capacity
        else:
            at = max(at, ends[i - 1] if i else 0)
        cuts.append(at)
    return cuts, at == total


def least_capacity(cells: list[Cell], shards: int, inside: bool) -> int:
    low, high = 0, sum(c.size for c in cells)
    while high - low > 1:
        middle = (low + high) // 2
        if filled(cells, middle, shards, inside)[1]:
            high = middle
        else:
            low = middle
    return high


def undecided(cells: list[Cell], shards: int) -> list[int]:
    """Cells of several groups in which a shard may end.

    The least capacity lies between those found with cuts inside cells and with none, so the n-th cut lies between the
    n-th of the smaller one with no cut inside and that of the larger one with cuts inside.
    """
    few = filled(cells, least_capacity(cells, shards, True), shards, False)[0]
    many = filled(cells, least_capacity(cells, shards, False), shards, True)[0]
    ends = list(accumulate(c.size for c in cells))
    found = set()
    for n, late in enumerate(many):
        early = few[min(n, len(few) - 1)]
        for i in range(bisect_right(ends, early), len(cells)):
            if ends[i] - cells[i].size >= late:
                break
            if cells[i].low < cells[i].high:
                found.add(i)
    return sorted(found)


def cut_keys(rows: DataFrame, own: list[int], shards: int) -> list[int]:
    """Last key of every shard but the last, for the groups of ``rows`` (key, size) other than ``own``."""
    others = rows.where(~F.col("key").isin(own)) if own else rows

    def summed(part: DataFrame, shift: int) -> list[Cell]:
        cells = part.groupBy(F.shiftright("key", shift).alias("cell")).agg(F.min("key").alias("low"), F.max("key").alias("high"), F.sum("size").alias("size"))
        return sorted(Cell(r["low"], r["high"], r["size"]) for r in cells.collect())

    shift = KEY_BITS - FIRST_BITS
    cells = summed(others, shift)
    while split := undecided(cells, shards):
        shift = max(0, shift - SPLIT_BITS)
        runs: list[list[int]] = []
        for i in split:
            if runs and runs[-1][1] == i - 1:
                runs[-1][1] = i
            else:
                runs.append([i, i])
        # a key lies in a run when an odd number of these bounds, two a run, lies below it; a condition per run nests too deep
        within = _place(F.col("key"), [bound for first, last in runs for bound in (cells[first].low - 1, cells[last].high)]) % 2 == 1
        again = set(split)
        # a run of neighbours holds single groups at most where its cells do not touch, so every cell read again is a split one
        cells = sorted([c for i, c in enumerate(cells) if i not in again] + summed(others.where(within), shift))
    ends = list(accumulate(c.size for c in cells))
    cuts = filled(cells, least_capacity(cells, shards, True), shards, True)[0]
    return [cells[bisect_right(ends, at) - 1].high for at in cuts if at < ends[-1]]


def _place(value, bounds: list[int]):
    """How many of the sorted ``bounds`` lie below ``value``, by binary search."""
    if not bounds:
        return F.lit(0)
    steps = F.lit([1 << i for i in reversed(range(len(bounds).bit_length()))])
    below = lambda at, step: (at + step <= len(bounds)) & (F.get(F.lit(bounds), at + step - 1) < value)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(below(at, step), at + step).otherwise(at))


def shards_by_bytes(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", overhead: int = OVERHEAD) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row; sizes of shards as near as whole groups allow."""
    text = F.coalesce("text", F.lit(""))
    narrow = id_text(docs, id_col, text_col).select(
        "doc_id",
        (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.conv(F.substring(F.sha2(text, 256), 1, KEY_BITS // 4), 16, 10).cast("long").alias("key"),
        F.monotonically_increasing_id().alias("at"),
    )
    order = ["key", "doc_id", "at"]
    in_order = stored(narrow, "sizes").repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(
        in_order.select("doc_id", "size", "text_crc32", "key", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().bitwiseAND(IN_TASK).alias("place")), "sorted-sizes"
    )

    left, rest = shards, rows.agg(F.sum("size")).first()[0] or 0
    own: list[int] = []
    largest = rows.groupBy("key").agg(F.sum("size").alias("size")).orderBy(F.desc("size"), "key").limit(shards)
    for r in largest.collect():
        if left == 1 or r["size"] * left <= rest:
            break
        own.append(r["key"])
        left, rest = left - 1, rest - r["size"]
    cuts = cut_keys(rows, own, left)

    # runs of keys that go to one shard: up to each bound, counted from the one before
    bounds = sorted({*cuts, *own, *[k - 1 for k in own]})
    shard_of = [own.index(b) if b in own else len(own) + sum(c < b for c in cuts) for b in bounds] + [len(own) + len(cuts)]
    rows = rows.withColumn("run", _place(F.col("key"), bounds))
    parts = rows.groupBy("task", "run").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    parts = parts.withColumn("shard", F.get(F.lit(shard_of), "run"))
    earlier = W.partitionBy("shard").orderBy("run", "task").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    slot = F.col("before") + F.col("place") - F.col("first")
    return rows.join(parts, ["task", "run"]).select("doc_id", "size", "text_crc32", "shard", slot.alias("slot"))


def op11_sharding(spark, sf_dir: str) -> DataFrame:
    dealt = shards_by_bytes(table(spark, sf_dir, "documents"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


ORACLE = f"""
WITH RECURSIVE polynomial AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS tab),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
u AS (SELECT DISTINCT t FROM d),
v AS (SELECT t, strlen(t) + {OVERHEAD} AS size, ('0x' || substr(sha256(t), 1, 15))::BIGINT AS key,
    xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: ('0x' || h)::BIGINT)),
        lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32 FROM u, polynomial),
r AS (SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, key FROM d JOIN v USING (t)),
g AS (SELECT key, sum(size)::BIGINT AS size FROM r GROUP BY key),
ranked AS (SELECT *, row_number() OVER (ORDER BY size DESC, key) AS i, coalesce(sum(size) OVER (ORDER BY size DESC, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above,
    sum(size) OVER () AS total FROM g),
large AS (SELECT *, bool_and(i < {SHARDS} AND size * ({SHARDS} - i + 1) > total - above) OVER (ORDER BY i) AS own FROM ranked),
others AS (SELECT key, sum(size) OVER (ORDER BY key)::BIGINT AS stop FROM large WHERE NOT own),
one AS (SELECT list(stop ORDER BY stop) AS stops, max(stop) AS total, {SHARDS} - (SELECT count(*) FROM large WHERE own) AS n FROM others),
bisect AS (
    SELECT 0::BIGINT AS low, total AS high, 0::BIGINT AS pos, 1 AS step FROM one
    UNION ALL
    SELECT CASE WHEN went < total AND (step = n OR went = pos) THEN middle ELSE low END, CASE WHEN went = total THEN middle ELSE high END,
        CASE WHEN went = total OR step = n OR went = pos THEN 0 ELSE went END, CASE WHEN went = total OR step = n OR went = pos THEN 1 ELSE step + 1 END
    FROM (SELECT *, coalesce(list_max(list_filter(stops, lambda s: s <= pos + middle)), 0)::BIGINT AS went FROM (SELECT *, (low + high) // 2 AS middle FROM bisect) b, one) s
    WHERE high - low > 1),
capacity AS (SELECT min(high) AS most FROM bisect),
cuts AS (
    SELECT 0::BIGINT AS pos, 0 AS step FROM one
    UNION ALL
    SELECT list_max(list_filter(stops, lambda s: s <= pos + most))::BIGINT, step + 1 FROM cuts, one, capacity WHERE pos < total AND step < n),
placed AS (
    SELECT key, (i - 1)::INT AS shard FROM large WHERE own
    UNION ALL
    SELECT key, ({SHARDS} - n + (SELECT count(*) FROM cuts WHERE step > 0 AND pos < stop))::INT FROM others, one)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY key, doc_id) - 1 AS slot, NULL::INT AS grown_shard
FROM r JOIN placed USING (key)"""
