"""Cross-tokenizer alignment by interval coalescing.

Tokenizer A (a byte-level file) encodes a blank and the text, tokenizer B (a sentencepiece model) the text, to which it adds
the blank itself. Every token covers an interval of bytes. All intervals of a batch of texts, A's and B's, are sorted by
start; a group breaks where a start reaches the running maximum of the ends before it, and intervals that overlap stay in one group. Texts
lie one after another on one axis, so a group never spans two of them.

The last A token and the last B token of a group end together: that pair is a link. Its two tokens end with the same bytes, so one
is a suffix of the other, and the pairs that can be linked are known from the vocabularies alone: ``linkable`` lists them, fewer than there are
bytes in both vocabularies, whatever the corpus. Links are therefore kept as places in that list; each task counts its own and
Spark adds the counts up. The counts, one number per linkable pair, are a broadcast of that proven size.

Tokenizing and grouping happen once: figures and links of every text are stored, and the second pass reads them back.

Defined results: a null or empty text, and one whose joined token bytes differ from blank and text (such as one that holds
U+2581), has no tokens, zeros and an empty digest; strings of special tokens are plain text; repeated rows each get their result and their
links count each time; an empty table gives no rows; only the named identifier and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from meterloom.llm.bpe import byte_symbols
from meterloom.llm.common import id_text, stored, table
from meterloom.llm.packing import _LONG_BLANK, ids_by

BATCH_BYTES = 4_000_000
BLANK_MARK = "▁"


class Vocabulary(NamedTuple):
    """Bytes of every token, and their number of bytes."""

    tokens: list[bytes]
    lengths: np.ndarray


def _vocabulary(tokens: Iterable[bytes]) -> Vocabulary:
    tokens = list(tokens)
    return Vocabulary(tokens, np.array(list(map(len, tokens)), np.int64))


class ByteLevel:
    """A byte-level tokenizers file; special tokens' strings are plain text.

    tiktoken, built from the vocabulary of the file, gives the same ids in less time where the file allows that; very long runs
    of blanks, which its pattern searches back step by step, go to the tokenizers library.
    """

    def __init__(self, path: str):
        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = True
        self.exact.no_padding()
        self.exact.no_truncation()
        byte = {c: b for b, c in enumerate(byte_symbols())}
        special = {i for i, t in self.exact.get_added_tokens_decoder().items() if t.special}
        by_id = {i: t for t, i in self.exact.get_vocab().items()}
        spelled = lambda i: by_id[i].encode() if i in special else bytes(byte[c] for c in by_id[i])
        self.vocabulary = _vocabulary(spelled(i) if i in by_id else b"" for i in range(max(by_id) + 1))
        self.fast = ids_by(path).fast

    def __call__(self, text: str) -> list[int]:
        if self.fast is None or _LONG_BLANK.search(text):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class Pieces:
    """A sentencepiece model."""

    def __init__(self, path: str):
        self.model = SentencePieceProcessor(model_file=path)

        def spelled(i: int) -> bytes:
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                return bytes([int(piece[1:-1], 16)])
            return b"" if self.model.is_control(i) else piece.replace(BLANK_MARK, " ").encode()

        self.vocabulary = _vocabulary(map(spelled, range(self.model.get_piece_size())))

    def __call__(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


@lru_cache(2)
def tokenizers_of(a_path: str, b_path: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(a_path), Pieces(b_path)


@lru_cache(2)
def linkable(a_path: str, b_path: str) -> np.ndarray:
    """Sorted keys ``a * size_of_b + b`` of all pairs of tokens of which one is a suffix of the other."""
    a, b = (t.vocabulary.tokens for t in tokenizers_of(a_path, b_path))

    def suffixes_in(tokens: list[bytes], others: list[bytes]):
        ids: dict[bytes, list[int]] = {}
        for i, t in enumerate(others):
            ids.setdefault(t, []).append(i)
        for i, t in enumerate(tokens):
            for at in range(len(t)):
                for j in ids.get(t[at:], ()):
                    yield i, j

    pairs = {i * len(b) + j for i, j in suffixes_in(a, b)} | {i * len(b) + j for j, i in suffixes_in(b, a)}
    return np.array(sorted(pairs), np.int64)


def coalesced(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the group, from 0 and ascending, of every A and every B interval."""
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    order = np.lexsort((end, start))
    reached = np.maximum.accumulate(end[order])
    new = np.ones(len(order), bool)
    new[1:] = start[order][1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return group[: len(a_start)], group[len(a_start) :]


class Aligned(NamedTuple):
    """Ids and groups of the tokens of several texts, text by text."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    a_first: np.ndarray  # place of each text's first token, and the number of all at the end
    b_first: np.ndarray


def align(texts: list[str | None], a: ByteLevel, b: Pieces) -> Aligned:
    a_parts, b_parts, a_first, b_first = [], [], [0], [0]
    join_a, join_b = a.vocabulary.tokens.__getitem__, b.vocabulary.tokens.__getitem__
    for text in texts:
        ids: tuple[list[int], list[int]] = ([], [])
        if text:
            whole = " " + text
            ids = a(whole), b(text)
            raw = whole.encode()
            if b"".join(map(join_a, ids[0])) != raw or b"".join(map(join_b, ids[1])) != raw:
                ids = [], []
        a_parts.append(ids[0])
        b_parts.append(ids[1])
        a_first.append(a_first[-1] + len(ids[0]))
        b_first.append(b_first[-1] + len(ids[1]))
    flat = lambda parts: np.fromiter((i for p in parts for i in p), np.int64)
    a_ids, b_ids = flat(a_parts), flat(b_parts)
    a_end, b_end = np.cumsum(a.vocabulary.lengths[a_ids]), np.cumsum(b.vocabulary.lengths[b_ids])
    groups = coalesced(a_end - a.vocabulary.lengths[a_ids], a_end, b_end - b.vocabulary.lengths[b_ids], b_end)
    return Aligned(a_ids, b_ids, *groups, np.array(a_first), np.array(b_first))


def _last(group: np.ndarray) -> np.ndarray:
    """Which elements are the last of their group."""
    out = np.ones(len(group), bool)
    out[:-1] = group[1:] != group[:-1]
    return out


def group_texts(al: Aligned, a_size: int, spelled: list[str]) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of every text. ``spelled`` has, for A's and then B's ids, the id and what follows it: first
    within a side, then at its end."""
    in_group = np.concatenate([al.a_group, al.b_group])
    side = np.repeat([0, 1], [len(al.a_ids), len(al.b_ids)])
    order = np.lexsort((side, in_group))  # stable: tokens of a side stay in order
    word = np.concatenate([2 * al.a_ids + _last(al.a_group), 2 * (a_size + al.b_ids) + _last(al.b_group)])[order]
    edges = al.a_first + al.b_first
    words = word.tolist()
    return ["".join(map(spelled.__getitem__, words[i:j]))[:-1] for i, j in zip(edges[:-1].tolist(), edges[1:].tolist())]


@lru_cache(2)
def _spelled(a_size: int, b_size: int) -> list[str]:
    return [f"{i}{end}" for i in range(a_size) for end in ",|"] + [f"{i}{end}" for i in range(b_size) for end in ",;"]


def _blocks(batches: Iterator[pa.RecordBatch], most: int = BATCH_BYTES):
    """(identifiers, texts) with at most ``most`` characters, or a single text."""
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        first, size = 0, 0
        for i in range(batch.num_rows):
            length = len(texts[i].as_py() or "")
            if size and size + length > most:
                yield ids.slice(first, i - first), texts.slice(first, i - first).to_pylist()
                first, size = i, 0
            size += length
        if first < batch.num_rows:
            yield ids.slice(first), texts.slice(first).to_pylist()


def token_groups(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = True) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups, groups_sha256, links) for every row; links are places in ``linkable``, as
    little-endian 32-bit numbers. ``keep_groups=False`` leaves the groups' text null."""
    docs = id_text(docs, id_col, text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        a, b = tokenizers_of(a_path, b_path)
        pairs, a_size, b_size = linkable(a_path, b_path), len(a.vocabulary.tokens), len(b.vocabulary.tokens)
        for ids, texts in _blocks(batches):
            al = align(texts, a, b)
            ends_a, ends_b = _last(al.a_group), _last(al.b_group)
            links = np.searchsorted(pairs, al.a_ids[ends_a] * b_size + al.b_ids[ends_b]).astype("<u4")
            n_groups = np.diff(np.concatenate([[0], np.cumsum(ends_a)])[al.a_first])
            edge = np.concatenate([[0], np.cumsum(n_groups)])
            groups = group_texts(al, a_size, _spelled(a_size, b_size))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.diff(al.a_first)),
                    pa.array(np.diff(al.b_first)),
                    pa.array(n_groups),
                    pa.array(groups if keep_groups else [None] * len(groups), pa.string()),
                    pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups], pa.string()),
                    pa.array([links[i:j].tobytes() for i, j in zip(edge[:-1], edge[1:])], pa.binary()),
                ],
                ["doc_id", "n_a", "n_b", "n_groups", "groups", "groups_sha256", "links"],
            )

    return docs.mapInArrow(run, f"doc_id {kind}, n_a long, n_b long, n_groups long, groups string, groups_sha256 string, links binary")


def link_counts(rows: DataFrame, size: int) -> DataFrame:
    """(pair, n): how often each linkable pair is linked. Every task adds its own links up first."""

    def count(batches):
        n = np.zeros(size, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                links = np.frombuffer(b"".join(batch.column(0).slice(at, 256).to_pylist()), "<u4")
                n += np.bincount(links, minlength=size)
        found = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n[found])], ["pair", "n"])

    return rows.select("links").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = True) -> DataFrame:
    """``token_groups`` with, instead of the links, n_links, n_best (links whose pair is the most frequent, ties included, of
    its B token) and count_sum (the links' pairs' counts added up)."""
    rows = stored(token_groups(docs, a_path, b_path, id_col, text_col, keep_groups), "token-groups")
    pairs, b_size = linkable(a_path, b_path), len(tokenizers_of(a_path, b_path)[1].vocabulary.tokens)
    n = np.zeros(len(pairs), np.int64)
    for r in link_counts(rows, len(pairs)).toLocalIterator():  # a row per linkable pair at most
        n[r["pair"]] = r["n"]
    of_b = pairs % b_size
    highest = np.zeros(b_size, np.int64)
    np.maximum.at(highest, of_b, n)
    figures = docs.sparkSession.sparkContext.broadcast((n, (n == highest[of_b]).astype(np.int64)))

    def run(batches):
        count, best = figures.value
        for batch in batches:
            links = [np.frombuffer(x, "<u4") for x in batch.column("links").to_pylist()]
            sums = [pa.array([f(x) for x in links], pa.int64()) for f in (len, lambda x: best[x].sum(), lambda x: count[x].sum())]
            keep = [batch.column(c) for c in KEPT]
            yield pa.RecordBatch.from_arrays([*keep, *sums], [*KEPT, "n_links", "n_best", "count_sum"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_a long, n_b long, n_groups long, groups string, groups_sha256 string, n_links long, n_best long, count_sum long")


KEPT = ("doc_id", "n_a", "n_b", "n_groups", "groups", "groups_sha256")


def op12_alignment(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return aligned(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), keep_groups=False).drop("groups")
