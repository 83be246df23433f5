"""Exact order statistics without pulling a group into one task.

``Window.partitionBy(model).orderBy(x)`` puts all rows of a model into one task, however large. Two ways avoid that:

* positions (``exact_rank``): rows are range-partitioned by (group, value, ties) into as many tasks as their number asks
  for and stored; a position is a row's place in its task plus the rows of its group in earlier tasks. The ties make the order
  total, so a value that very many rows hold is dealt over tasks like any other.
* quantiles and runs: the value range of every group is cut at approximate quantiles into buckets, as many as the counted
  rows ask for, and the rows of each bucket are counted. The approximate quantiles only decide where the cuts lie: a
  quantile needs the values of just those buckets that contain its position (``quantiles``), and a label that is constant
  over runs of positions needs positions only where a run ends (``exact_parts``).

All results are exact. The input is read several times, so pass a stored table rather than a long chain.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterloom.operators.joins import attach
from meterloom.session import stored

ROWS_PER_TASK = 250_000


LEAST_BUCKETS = 256  # fewer would shuffle a larger share of a small table
IN_TASK = (1 << 33) - 1  # of monotonically_increasing_id


def bucket_count(rows: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """So many that a bucket holds about what one task should sort."""
    return max(LEAST_BUCKETS, -(-rows // rows_per_task))


def _cuts(value: Column, buckets: int) -> Column:
    fractions = [i / buckets for i in range(1, buckets)]
    return F.percentile_approx(value, fractions, max(10_000, 8 * buckets))


def _bucket_of(value: Column, cuts: str, buckets: int) -> Column:
    """How many cuts lie below ``value``, by binary search; a missing cut list gives 0.

    Never NULL, so that joins on it add no filter and both uses of an exchange stay identical.
    """
    steps = [1 << i for i in reversed(range(buckets.bit_length()))]
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(F.get(cuts, at + step - 1) < value, at + step).otherwise(at),
    )
    return F.coalesce(found, F.lit(0))


def _offsets(sizes: DataFrame, by: list[str], place: list[str]) -> DataFrame:
    """Add the rows in earlier buckets and in all. ``sizes`` has one row per bucket, so the windows are small."""
    group = W.partitionBy(*by)
    earlier = group.orderBy(*place).rowsBetween(W.unboundedPreceding, -1)
    return sizes.select(
        *by,
        *place,
        "_n",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_n").over(group).alias("n_total"),
    )


def _with_buckets(df: DataFrame, by: list[str], value: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    buckets = bucket_count(df.count(), rows_per_task)
    cuts = df.groupBy(*by).agg(_cuts(F.col(value), buckets).alias("_cuts"))
    return attach(df, cuts, by).withColumn("_bucket", _bucket_of(F.col(value), "_cuts", buckets)).drop("_cuts")


def cumulative_counts(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """One row per group and distinct value with ``n_at``, ``n_below`` and ``n_total``.

    Equal values collapse before the shuffle, so a value that fills half a group costs nothing extra.
    """
    rows = df.select(*by, value).where(F.col(value).isNotNull())
    key = [*by, "_bucket"]
    counts = _with_buckets(rows, by, value).groupBy(*key, value).agg(F.count(F.lit(1)).alias("n_at"))
    return _place_counts(counts, by, value, _offsets(counts.groupBy(*key).agg(F.sum("n_at").alias("_n")), by, ["_bucket"]))


def _place_counts(counts: DataFrame, by: list[str], value: str, offsets: DataFrame) -> DataFrame:
    key = [*by, "_bucket"]
    smaller = W.partitionBy(*key).orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    placed = counts.withColumn("_before", F.coalesce(F.sum("n_at").over(smaller), F.lit(0)))
    return (
        placed.join(offsets, key)
        .withColumn("n_below", F.col("_before") + F.col("_offset"))
        .drop("_bucket", "_before", "_offset", "_n")
    )


def quantiles(df: DataFrame, by: list[str], value: str, fractions: dict[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per entry of ``fractions``.

    After the bucket sizes are known, only rows of the buckets that contain a wanted position are shuffled.
    """
    rows = _with_buckets(df.select(*by, value).where(F.col(value).isNotNull()), by, value)
    key = [*by, "_bucket"]
    offsets = _offsets(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")), by, ["_bucket"])
    at = {name: F.lit(float(p)) * (F.col("n_total") - 1) for name, p in fractions.items()}
    index = {(n, s): f(a) for n, a in at.items() for s, f in (("lo", F.floor), ("hi", F.ceil))}
    inside = [(F.col("_offset") <= i) & (i < F.col("_offset") + F.col("_n")) for i in index.values()]
    wanted = offsets.where(F.exists(F.array(*inside), lambda hit: hit))
    counts = (
        attach(rows, wanted, key).groupBy(*key, "_offset", "n_total", value).agg(F.count(F.lit(1)).alias("n_at"))
    )
    smaller = W.partitionBy(*key).orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    below = F.col("_offset") + F.coalesce(F.sum("n_at").over(smaller), F.lit(0))
    placed = counts.withColumn("_below", below)
    holds = lambda i: (F.col("_below") <= i) & (i < F.col("_below") + F.col("n_at"))
    wide = placed.groupBy(*by).agg(
        *[F.max(F.when(holds(i), F.col(value))).alias(f"_{n}_{s}") for (n, s), i in index.items()],
        *[F.max(a - F.floor(a)).alias(f"_{n}_w") for n, a in at.items()],
    )
    value_at = lambda n: F.col(f"_{n}_lo") + F.col(f"_{n}_w") * (F.col(f"_{n}_hi") - F.col(f"_{n}_lo"))
    return wide.select(*by, *[value_at(n).alias(n) for n in fractions])


def _positions(df: DataFrame, by: list[str], order: list[str], rows_per_task: int) -> DataFrame:
    """Add ``_position`` (from 1, inside each group) and ``_rows`` (of the group); rows lie stored in order."""
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows_per_task))
    in_order = df.repartitionByRange(tasks, *by, *order).sortWithinPartitions(*by, *order)
    # places belong to this layout, so it is written before anything is derived from it
    rows = stored(in_order.withColumns({"_task": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(IN_TASK)}))
    pieces = rows.groupBy(*by, "_task").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))  # tasks + groups at most
    group = W.partitionBy(*by)
    earlier = group.orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.select(*by, "_task", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(group).alias("_rows"))
    return attach(rows, pieces, [*by, "_task"]).withColumn("_position", F.col("_place") + F.col("_shift") + 1).drop("_task", "_place", "_shift")


def exact_rank(
    df: DataFrame, by: list[str], value: str, ties: list[str], name: str = "rank", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Add ``name`` (1-based position by ``value`` then ``ties`` inside each group) and ``n_total``.

    ``ties`` must make the order total.
    """
    placed = _positions(df.where(F.col(value).isNotNull()), by, [value, *ties], rows_per_task)
    return placed.withColumnsRenamed({"_position": name, "_rows": "n_total"})


def exact_parts(
    df: DataFrame,
    by: list[str],
    value: str,
    ties: list[str],
    part: Callable[[Column, Column], Column],
    name: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``name`` = ``part(position, n_total)`` for a ``part`` that is constant over runs of positions.

    A bucket that lies within one run is labelled as a whole. Only rows of buckets in which a run ends are brought into
    order, a few per cent of the rows when there are few runs; a bucket of any size is dealt over tasks then.
    """
    key = [*by, "_bucket"]
    placed = _with_buckets(df.where(F.col(value).isNotNull()), by, value, rows_per_task)
    offsets = _offsets(placed.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")), by, ["_bucket"])
    total = F.col("n_total")
    ends = offsets.withColumns(
        {"_first": part(F.col("_offset") + 1, total), "_last": part(F.col("_offset") + F.col("_n"), total)}
    )
    labelled = attach(placed, ends, key).drop("_n")
    whole = labelled.where(F.col("_first") == F.col("_last")).withColumn(name, F.col("_first"))
    cut = _positions(labelled.where(F.col("_first") != F.col("_last")), key, [value, *ties], rows_per_task)
    cut = cut.withColumn(name, part(F.col("_offset") + F.col("_position"), total)).drop("_position", "_rows")
    return whole.unionByName(cut).drop("_bucket", "_first", "_last", "_offset")


def equal_parts(rank: Column, total: Column, parts: int) -> Column:
    """1-based part of a position when ``total`` rows are cut into ``parts`` runs, the longer runs first."""
    size, extra = F.floor(total / parts), total % parts
    long_part = extra * (size + 1)
    return F.when(rank <= long_part, F.ceil(rank / (size + 1))).otherwise(
        extra + F.ceil(F.try_divide(rank - long_part, size))
    )
