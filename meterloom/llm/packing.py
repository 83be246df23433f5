"""Packing of documents into fixed-length training sequences: bounded-space online best fit.

Each task keeps a fixed number of open windows. What is left of a document after its full windows is placed whole into
the open window with the smallest gap that holds it. When none does and no slot is free, the fullest window is emitted:
the document first fills its gap, so that no position is wasted. The windows still open when a task ends, at most
``open_windows`` each, go with their ids to a second job that merges those of 16 tasks at a time into full sequences; of
the last one a group cannot fill, sequences of power-of-two length are made, which need no padding.

Pieces are written to the shared folder before leftovers are picked from them, so that a task that runs again after a
lost executor cannot change what others have read.

Defined results: a null or empty text is the end-of-document id alone; rows with equal identifiers are packed as
separate documents; texts are tokenized whole, whatever their length; an empty table gives no pieces; only the named
identifier and text columns are read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.bpe import byte_symbols
from meterloom.llm.common import id_text, stored, table

SIZE, OPEN_WINDOWS, MERGED_TASKS, END_ID = 1024, 32, 16, 0
MERGED = 1 << 62  # sequence ids from here on were made from leftovers

# Fixed value: the word pattern of byte-level vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LONG_BLANK = re.compile(r"\s{1000}")  # would be searched back step by step


class Ids:
    """Token ids of a text as little-endian bytes, by a byte-level tokenizers file.

    Texts are encoded by tiktoken, built from the vocabulary of that file, whose ids are the ranks of its merges; it
    gives the same ids in a fifth of the time. Texts that hold a special token's string go to the tokenizers library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.exact.no_padding()
        self.exact.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = {c: b for b, c in enumerate(byte_symbols())}
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        pairs = ["".join(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        ids = [spec["model"]["vocab"][p] for p in pairs]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.same = ids == sorted(ids) and spec["normalizer"] is None and spec["pre_tokenizer"]["type"] == "ByteLevel" and not spec["pre_tokenizer"]["add_prefix_space"]
        self.fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}) if self.same else None

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.same or any(s in text for s in self.special) or _LONG_BLANK.search(text):
            return array("I", self.exact.encode(text, add_special_tokens=False).ids).tobytes()
        return array("I", self.fast.encode_ordinary(text)).tobytes()


@lru_cache(2)
def ids_by(path: str) -> Ids:
    return Ids(path)


class Window:
    """Pieces placed so far, as (document, start, ids, ids of the document), and their ids together."""

    __slots__ = ("pieces", "used")

    def __init__(self):
        self.pieces, self.used = [], 0

    def add(self, doc, start: int, ids: bytes, total: int) -> None:
        self.pieces.append((doc, start, ids, total))
        self.used += len(ids) // 4


class Packer:
    """Best fit over a fixed number of open windows."""

    def __init__(self, size: int, slots: int):
        self.size, self.slots = size, slots
        self.open: list[tuple[int, int]] = []  # (gap, window number), ascending
        self.windows: dict[int, Window] = {}
        self.made = 0

    def place(self, doc, ids: bytes):
        """Yield the windows that a document fills."""
        total = len(ids) // 4
        start = 0
        while total - start >= self.size:
            w = Window()
            w.add(doc, start, ids[4 * start : 4 * (start + self.size)], total)
            start += self.size
            yield w
        while start < total:
            rest = total - start
            k = bisect_left(self.open, (rest, -1))
            if k < len(self.open):
                gap, n = self.open.pop(k)
            elif len(self.open) < self.slots:
                gap, n = self.size, self.made
                self.windows[n] = Window()
                self.made += 1
            else:
                gap, n = self.open.pop(0)  # none fits: the fullest is filled up and goes
            take = min(gap, rest)
            w = self.windows[n]
            w.add(doc, start, ids[4 * start : 4 * (start + take)], total)
            start += take
            if take == gap:
                yield self.windows.pop(n)
            else:
                insort(self.open, (gap - take, n))


def fill(pieces, size: int):
    """Yield full windows from (document, start, ids, total) cut freely, then windows of power-of-two length."""
    pieces = [list(p) for p in pieces]
    left = sum(len(p[2]) for p in pieces) // 4
    w, room = Window(), 0
    for doc, start, ids, total in pieces:
        while ids:
            if room == 0:
                if w.used:
                    yield w
                w, room = Window(), size if left >= size else 1 << (left.bit_length() - 1)
            take = min(room, len(ids) // 4)
            w.add(doc, start, ids[: 4 * take], total)
            ids, start, room, left = ids[4 * take :], start + take, room - take, left - take
    if w.used:
        yield w


COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")


def _rows(window: Window, sequence_id: int, keep_ids: bool):
    offset = 0
    for doc, start, ids, total in window.pieces:
        n = len(ids) // 4
        yield doc, start, n, zlib.crc32(ids), total, sequence_id, offset, ids if keep_ids else None
        offset += n


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, open_windows: int = OPEN_WINDOWS, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (little-endian 32-bit).

    ``size`` must be a power of two. ``keep_ids=False`` leaves the ids null.
    """
    docs = id_text(docs, id_col, text_col)
    kind = docs.schema["doc_id"]
    schema = f"doc_id {kind.dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long, ids binary"
    types = [pa.int64()] * 6 + [pa.binary()]

    def batch_of(rows, id_type, task: int | None):
        columns = list(zip(*rows))
        arrays = [pa.array(columns[0], id_type), *[pa.array(c, t) for c, t in zip(columns[1:], types)]]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([task] * len(rows), pa.int64())], [*COLUMNS, "task"])

    def first(batches):
        task, to_ids, packer = TaskContext.get().partitionId(), ids_by(path), Packer(size, open_windows)
        end, sequence, id_type = end_id.to_bytes(4, "little"), task << 32, pa.int64()
        for batch in batches:
            id_type, rows = batch.column(0).type, []
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for window in packer.place(doc, to_ids(text) + end):
                        rows += _rows(window, sequence, keep_ids)
                        sequence += 1
            if rows:
                yield batch_of(rows, id_type, None)
        rows = [r for w in packer.windows.values() for r in _rows(w, 0, True)]
        if rows:
            yield batch_of(rows, id_type, task)

    pieces = stored(docs.mapInArrow(first, schema + ", task long"), "pieces")
    closed = pieces.where(F.col("task").isNull()).drop("task")
    left = pieces.where(F.col("task").isNotNull()).withColumn("team", F.col("task") / F.lit(MERGED_TASKS))
    left = left.withColumn("team", F.floor("team").cast("long")).select("team", "doc_id", "start", "doc_tokens", "ids", "length")

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start"], ascending=[False, True, True])
        given = zip(pdf.doc_id.tolist(), pdf.start.tolist(), pdf.ids.tolist(), pdf.doc_tokens.tolist())
        first_id = MERGED + (int(key[0]) << 32)
        rows = [r for n, w in enumerate(fill(given, size)) for r in _rows(w, first_id + n, keep_ids)]
        return pd.DataFrame(rows, columns=COLUMNS)

    return closed.unionByName(left.groupBy("team").applyInPandas(merge, schema))


def op5_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False).drop("ids")
