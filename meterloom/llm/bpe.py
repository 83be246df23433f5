"""Byte-pair encoding and decoding by a tokenization automaton.

The merges of a vocabulary are compiled, in rank order, into a deterministic automaton whose arcs are tokens and whose
paths are exactly the segmentations that byte-pair merging yields. It starts as one state with a loop for every base
symbol. The gadget of merge (a, b) splits the state ``t`` that a-arcs enter: the a-arcs are led to a copy of ``t``
without its b-arc, so "a, b" can no longer be read, and every state with an a-arc gets an arc ``ab`` to where b led.

All arcs of one label enter the same state, so a state is kept as (state it copies, label it lacks, merge that made it)
and a label as (its left part, merge that made it); ``has_arc`` reads the transition table off these arrays. A word is
encoded by walking the arcs whose labels spell it, longest first; exactly one walk reaches the end. Decoding emits the
arc labels.

Defined results: a null or empty text has no ids and decodes to the empty text; repeated rows each get their result;
texts are encoded whole, whatever their length; only the named identifier and text columns are read.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import Recent, id_text, table

#: A quarter of the table look-ups a worker keeps.
CACHE = 150_000
END = 0xF0000  # shifts the last symbol of a word into a private plane, where it stands for "symbol + word end"


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones themselves, the rest from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Automaton:
    """Token automaton of one list of merges. ``symbols``: internal strings, a word end shifted by END."""

    def __init__(self, symbols: dict[str, int], merges: list[tuple[str, str]]):
        merged = {a + b for a, b in merges}
        self.names = [s for s in symbols if s not in merged]
        self.number = {s: i for i, s in enumerate(self.names)}
        self.left, self.born = [-1] * len(self.names), [-1] * len(self.names)
        self.parent, self.lacks, self.made = [0], [-1], [-1]
        self.enters = [0] * len(self.names)
        for rank, (a, b) in enumerate(merges):
            self._gadget(rank, a, b)
        self.ids = [symbols[s] for s in self.names]
        self.size = [len(s) for s in self.names]
        self.trie: dict = {}
        for label, name in enumerate(self.names):
            node = self.trie
            for symbol in name:
                node = node.setdefault(symbol, {})
            node[None] = label
        self._known: dict[int, bool] = {}

    def _gadget(self, rank: int, a: str, b: str) -> None:
        x, y = self.number.get(a), self.number.get(b)
        if x is None or y is None or a + b in self.number or not self._reads(self.enters[x], y):
            return
        self.number[a + b] = len(self.names)
        self.names.append(a + b)
        self.left.append(x)
        self.born.append(rank)
        self.enters.append(self.enters[y])
        self.parent.append(self.enters[x])
        self.lacks.append(y)
        self.made.append(rank)
        self.enters[x] = len(self.parent) - 1

    def _reads(self, state: int, label: int) -> bool:
        left, born, parent, lacks, made = self.left, self.born, self.parent, self.lacks, self.made
        while True:
            if born[label] >= made[state]:  # added after the state: where its left part had an arc
                if left[label] < 0:
                    return True
                label = left[label]
            elif lacks[state] == label:
                return False
            else:
                state = parent[state]

    def has_arc(self, state: int, label: int) -> bool:
        key = state << 20 | label
        known = self._known.get(key)
        if known is None:
            if len(self._known) >= 4 * CACHE:
                self._known.clear()
            known = self._known[key] = self._reads(state, label)
        return known

    def _arcs(self, word: str, at: int) -> list[int]:
        """Labels that spell a piece of ``word`` from ``at`` on, shortest first."""
        node, out = self.trie, []
        for symbol in word[at:]:
            node = node.get(symbol)
            if node is None:
                break
            if None in node:
                out.append(node[None])
        return out

    def walk(self, word: str) -> list[int]:
        """Labels of the one path that spells ``word``."""
        enters, has_arc, size = self.enters, self.has_arc, self.size
        out: list[int] = []
        open_arcs: list[list[int]] = []  # still to be tried, at each step taken
        dead: set[tuple[int, int]] = set()
        at, state, n = 0, 0, len(word)
        arcs = self._arcs(word, 0)
        while at < n:
            while arcs:
                label = arcs.pop()
                if has_arc(state, label) and (at + size[label], label) not in dead:
                    out.append(label)
                    open_arcs.append(arcs)
                    at, state = at + size[label], enters[label]
                    arcs = self._arcs(word, at)
                    break
            else:  # no arc leads on: take the last step back
                if not out:
                    raise ValueError(f"no path for {word!r}")
                last = out.pop()
                dead.add((at, last))
                at, arcs = at - size[last], open_arcs.pop()
                state = enters[out[-1]] if out else 0
        return out


class WordBpe:
    """Reads a tokenizers JSON of the kind: NFC, white space to blanks, lower case, split by pattern, byte level, word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        special = set(self.special)
        self.automaton = Automaton({self._inner(s): i for s, i in model["vocab"].items() if s not in special}, [(self._inner(a), self._inner(b)) for a, b in merges])
        self.symbols = byte_symbols()
        self.labels = {i: s for s, i in model["vocab"].items()} | {i: s for s, i in self.special.items()}
        self._words = Recent(self._word)
        self._chunks = Recent(self._chunk)

    def _inner(self, token: str) -> str:
        stem = token.removesuffix(self.suffix)
        return stem if stem == token or not stem else stem[:-1] + chr(END + ord(stem[-1]))

    def _word(self, word: str) -> bytes:
        s = "".join([self.symbols[b] for b in word.encode("utf-8", "surrogatepass")])
        ids = self.automaton.ids
        return np.array([ids[x] for x in self.automaton.walk(s[:-1] + chr(END + ord(s[-1])))], "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        text = text if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ")  # a capital sigma is lowered by itself, not by its place
        found = self.word.findall(text.lower())
        return b"".join([self._words[w] if len(w) <= 64 else self._word(w) for w in found])

    def _chunk(self, chunk: str) -> bytes:
        parts = self.special_cut.split(chunk) if "<" in chunk and self.special_cut else [chunk]
        return b"".join([np.array([self.special[p]], "<u4").tobytes() if p in self.special else self._plain(p) for p in parts])

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text. Blanks and line ends separate words in any case, so chunks between them stand alone."""
        known = self._chunks
        return np.frombuffer(b"".join([known[c] if len(c) <= 200 else self._chunk(c) for c in (text or "").replace("\n", " ").split(" ")]), "<u4")

    def decode(self, ids) -> str:
        return " ".join(map(self.labels.__getitem__, ids))


@lru_cache(2)
def tokenizer(path: str) -> WordBpe:
    return WordBpe(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) for every row: the ids of the whole text, and the text that these ids decode to."""
    docs = id_text(docs, id_col, text_col)

    def run(batches):
        t = tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [t.encode(x) for x in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)])
                flat = np.concatenate(ids) if ids else np.zeros(0)
                lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat.astype(np.int32))).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array([t.decode(x.tolist()) for x in ids], pa.string())], ["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
