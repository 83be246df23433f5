"""Fixed-size arrays that every task fills and a tree of small groups merges."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS, FAN_IN = 16, 64


def merged(df: DataFrame, fill, size: int, dtype: str, combine) -> np.ndarray:
    """``fill(frames, array)`` per task; the arrays combined elementwise. ``size`` bounds what reaches the driver."""

    def run(frames):
        array = np.zeros(size, dtype)
        fill(frames, array)
        task = TaskContext.get().partitionId()
        for i, part in enumerate(np.array_split(array, PARTS)):
            if part.any():
                yield pd.DataFrame({"part": [i], "team": [task], "data": pd.Series([zlib.compress(part.tobytes(), 1)], dtype=object)})

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        total = None
        for data in pdf["data"]:
            one = np.frombuffer(zlib.decompress(data), dtype)
            total = one.copy() if total is None else combine(total, one)
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "team": pdf["team"].iloc[:1], "data": pd.Series([zlib.compress(total.tobytes(), 1)], dtype=object).set_axis(pdf.index[:1])})

    schema = "part int, team long, data binary"
    rows, tasks = df.mapInPandas(run, schema), max(1, df.rdd.getNumPartitions())
    while True:
        rows = rows.withColumn("team", F.floor(F.col("team") / FAN_IN).cast("long")).groupBy("part", "team").applyInPandas(join, schema)
        tasks = -(-tasks // FAN_IN)
        if tasks == 1:
            break
    out = np.zeros(size, dtype)
    bounds = np.cumsum([0, *map(len, np.array_split(out, PARTS))])
    for r in rows.collect():
        out[bounds[r["part"]] : bounds[r["part"] + 1]] = np.frombuffer(zlib.decompress(bytes(r["data"])), dtype)
    return out


MOST_BITS = 1 << 30  # of a filter


class Filter:
    """Which 64-bit values are among given ones: never misses one, lets others through by chance. Bounded in size."""

    def __init__(self, df: DataFrame, column: str):
        bits = self.bits = 1 << min(MOST_BITS.bit_length() - 1, max(13, (8 * df.count()).bit_length()))

        def mark(frames, array):
            for pdf in frames:
                at = pdf[column].to_numpy(np.int64).view(np.uint64) & np.uint64(bits - 1)
                np.bitwise_or.at(array, (at >> np.uint64(3)).astype(np.intp), np.left_shift(1, (at & np.uint64(7)).astype(np.uint8), dtype=np.uint8))

        self.shared = df.sparkSession.sparkContext.broadcast(merged(df.select(column), mark, bits // 8, "u1", np.bitwise_or))

    def __call__(self, values: pd.Series) -> np.ndarray:
        at = values.to_numpy(np.int64).view(np.uint64) & np.uint64(self.bits - 1)
        return (self.shared.value[(at >> np.uint64(3)).astype(np.intp)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
