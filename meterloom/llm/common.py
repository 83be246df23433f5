"""Shared by the operators of this subpackage: reading, storing and word splitting.

Every operator selects its identifier and text column by name as its first step, so further columns, whatever their
names, neither reach it nor clash with its own.
"""

from __future__ import annotations

import os
import uuid
import weakref
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.session import checkpoint_dir


#: Rows and bytes of a batch that Python workers get: texts are long, and a worker holds one batch at a time.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder. Python workers get short batches, and find this package wherever the session was started."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), ROOT]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back: work done once, lineage cut."""
    path = f"{checkpoint_dir(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _folders[out] = path
    return out


_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def discard(*tables: DataFrame) -> None:
    """Delete what ``stored`` wrote for these tables. Only for tables that no table still to be computed is made from."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(_folders.pop(t))
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def fresh(name: str, *tables: DataFrame) -> str:
    """``name``, lengthened until none of the tables has such a column."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def utf8(text) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def words(text) -> list[bytes]:
    """Runs of bytes other than blank and \\x09-\\x0D, which is exactly what ``bytes.split`` cuts at."""
    return utf8(text).split()


class Recent(dict):
    """A bounded memo: when full, what is in use is carried over from the generation before."""

    def __init__(self, make, most: int = 150_000):
        super().__init__()
        self.make, self.most, self.before = make, most, {}

    def __missing__(self, key):
        got = self.before.get(key)
        if got is None:
            got = self.make(key)
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        self[key] = got
        return got


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_LONG = 64  # bytes, above which words are hashed one by one


def _stirred(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, as ``bytes.split`` cuts them, of all texts, and the number of words of each text.

    All words at once, eight bytes at a time: nothing is remembered between calls, however many words differ.
    """
    data = b" " + b" ".join(texts) + b" " * 9
    blank = _BLANK[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    start, size = edges[0::2], edges[1::2] - edges[0::2]
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    part = lambda at, left: eight[at] & _LOW[np.minimum(left, 8)]
    h = _stirred(_stirred((size.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) ^ part(start, size))
    long, rest, done = np.flatnonzero(size > _LONG), np.flatnonzero((size > 8) & (size <= _LONG)), 8
    while len(rest):
        h[rest] = _stirred(h[rest] ^ part(start[rest] + done, size[rest] - done))
        done += 8
        rest = rest[size[rest] > done]
    for i in long.tolist():
        h[i] = xxhash.xxh64_intdigest(data[start[i] : start[i] + size[i]])
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return h, np.diff(np.searchsorted(start, ends), prepend=0)


_MIX = np.uint64(0x9E3779B97F4A7C15)


def rolled(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive elements."""
    n = len(h) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out ^= out >> np.uint64(31)
        out *= _MIX
        out += h[j : n + j]
    out ^= out >> np.uint64(29)
    out *= _MIX
    out ^= out >> np.uint64(32)
    return out
