"""Joining a table with a result that is expected, but not guaranteed, to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.session import checkpointed

BROADCAST_BYTES = 8 << 20
PROBE_ROWS = 1000


def settle(small: DataFrame, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Measure ``small``; within ``limit`` bytes return it as a local table, else stored, so that it is made once.

    A first read of few rows tells how wide they are; beyond it, rows are counted before any more are read. So a
    result that turns out large never reaches the driver.
    """
    rows = small.limit(PROBE_ROWS + 1).toArrow()
    if rows.num_rows > PROBE_ROWS:
        small = checkpointed(small)
        if small.count() * rows.nbytes > limit * rows.num_rows:
            return small, False
        rows = small.toArrow()
    if rows.nbytes > limit:
        return checkpointed(small), False
    return small.sparkSession.createDataFrame(rows, schema=small.schema), True


def attach(df: DataFrame, small: DataFrame, on: list[str], how: str = "inner", limit: int = BROADCAST_BYTES) -> DataFrame:
    """Add the columns of ``small`` to ``df``.

    With keys: a broadcast join when the measured size allows, otherwise a shuffled join whose skewed keys AQE
    splits. Without keys ``small`` is a single row of a global aggregate, and its values become literals.
    """
    if not on:
        row = small.first()
        return df.withColumns({f.name: F.lit(row[f.name]).cast(f.dataType) for f in small.schema.fields})
    table, fits = settle(small, limit)
    return df.join(F.broadcast(table) if fits else table, on, how)
