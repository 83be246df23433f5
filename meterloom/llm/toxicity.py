"""Toxicity by a learned lexicon: a Levenshtein automaton run against the lexicon's trie, and context windows.

The lexicon holds words, and beginnings of words, that labelled toxic texts use in several contexts and clean ones hardly
ever. Its trie and the edit-distance automaton are intersected state by state: a state is the set of (trie node, edits so
far) that the letters read allow; states and transitions are made when first met and kept. A word is accepted exactly, by
its beginning, or with up to two edits, fewer for short terms. What stands around a hit, quotation marks on both sides or
a word of reporting just before it, separates quotation from use; both have weights of their own.

A text's score is the logistic of its prior and the log likelihood ratios of all its different hits.

The lexicon and its weights are learned from a bounded sample of labelled rows: about TOXIC toxic and CLEAN clean ones,
drawn by identifier, whatever the size of the input. Scoring covers all texts, whole. Copies in the sample count once:
a term's support is its number of different neighbourhoods (previous and next word), counted in 64-bit maps.

Defined results: null and empty texts have no hits and get the score of texts without hits; without labels that score
is 0; rows with a null identifier are never learned from and count as not held out; repeated rows each get their
result; only the named columns are read.
"""

from __future__ import annotations

import math
import pickle
import zlib
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import Recent, stored, table
from meterloom.llm.language import held_out

TOXIC, CLEAN, SEED = 2000, 12000, 3
PREFIXES = (4, 5, 6, 7)
LEAST, PURE = 5, 0.95  # neighbourhoods of a term, and its share of them in toxic texts
LEANING = 0.6  # the same share for the beginning of several words
FAMILY = 4  # letters by which terms are pooled to judge misspellings
REACH = 6  # words on each side of a hit
FLAG = 0.7
NEAR_PRIOR, QUOTED_PRIOR = 3.0, 0.5  # toxic uses assumed of misspelt and of quoted terms before any are seen

MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”‘’„…¡¿"
OPENING, CLOSING = tuple("\"'“„‘«"), tuple("\"'”“’»")
# Words that report speech or speak about words.
REPORTING = frozenset("said says say quote quoted quoting wrote writes called word words term terms phrase means sagte schrieb zitat wort dit écrit mot citation dijo escribió palabra cita".split())
EXACT, BEGINNING, NEAR, FAR = range(4)


class Lexicon:
    """Trie of terms and beginnings, intersected with the edit automaton."""

    def __init__(self, terms, beginnings):
        self.children: list[dict[str, int]] = [{}]
        self.term, self.beginning = [""], [""]
        for word in terms:
            self.term[self._node(word)] = word
        for word in beginnings:
            self.beginning[self._node(word)] = word
        self.allowed = [0] * len(self.children)  # edits of the most tolerant term at or below a node
        self._allow(0)
        self.states: dict[frozenset, int] = {}
        self.items: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state({(0, 0)})
        self.memo = Recent(self._match)

    def _node(self, word: str) -> int:
        node = 0
        for c in word:
            if c not in self.children[node]:
                self.children[node][c] = len(self.children)
                self.children.append({})
                self.term.append("")
                self.beginning.append("")
            node = self.children[node][c]
        return node

    @staticmethod
    def edits(term: str) -> int:
        return 0 if len(term) < 5 else 1 if len(term) < 10 else 2

    def _allow(self, node: int) -> int:
        below = [self._allow(n) for n in self.children[node].values()]
        self.allowed[node] = max([*below, self.edits(self.term[node]) if self.term[node] else 0])
        return self.allowed[node]

    def _state(self, items) -> int:
        """Number of the state with these items and all that skipping letters of terms adds."""
        best: dict[int, int] = {}
        queue = list(items)
        while queue:
            node, edits = queue.pop()
            if edits <= self.allowed[node] and edits < best.get(node, 9):
                best[node] = edits
                queue += [(n, edits + 1) for n in self.children[node].values()]
        key = frozenset(best.items())
        if key not in self.states:
            self.states[key] = len(self.items)
            self.items.append(key)
            self.moves.append({})
        return self.states[key]

    def _step(self, state: int, letter: str) -> int:
        after = set()
        for node, edits in self.items[state]:
            after.add((node, edits + 1))
            for c, n in self.children[node].items():
                after.add((n, edits + (c != letter)))
        self.moves[state][letter] = new = self._state(after)
        return new

    def _match(self, token: str):
        """(word, evidence, kind) of the best hit of one word, or None. Misspellings are judged by families of terms."""
        word = token.strip(MARKS)
        node, begun = 0, ""
        for c in word:  # as written: a term, or the beginning of one
            node = self.children[node].get(c)
            if node is None:
                break
            begun = self.beginning[node] or begun
        if node and self.term[node]:
            return word, word, EXACT
        if begun:
            return word, begun + "*", BEGINNING
        if len(self.items) > 100_000:
            self.states, self.items, self.moves = {}, [], []
            self.start = self._state({(0, 0)})
        state = self.start
        for c in word:
            state = self.moves[state].get(c, -1) if c in self.moves[state] else self._step(state, c)
            if not self.items[state]:
                return None
        found = [(e, self.term[n]) for n, e in self.items[state] if self.term[n] and 0 < e <= self.edits(self.term[n])]
        if not found:
            return None
        edits, term = min(found)
        return word, term[:FAMILY] + "~", NEAR if edits == 1 else FAR

    def hits(self, text: str | None):
        """(word, evidence, kind, quoted, neighbourhood) of every hit."""
        tokens = (text or "").lower().split()
        found = list(map(self.memo.__getitem__, tokens))
        for i, hit in enumerate(found):
            if hit is not None:
                before, after = tokens[max(0, i - REACH) : i + 1], tokens[i : i + REACH + 1]
                quoted = any(t.startswith(OPENING) for t in before) and any(t.rstrip(".,;:!?").endswith(CLOSING) for t in after)
                quoted = quoted or any(t.strip(MARKS) in REPORTING for t in before[-4:-1])
                yield *hit, quoted, _place(tokens, i)


def _place(tokens, i: int) -> int:
    """Bit of the neighbourhood of a word, as a signed 64-bit map."""
    near = (tokens[i - 1] if i else "") + " " + (tokens[i + 1] if i + 1 < len(tokens) else "")
    bit = 1 << (zlib.crc32(near.encode("utf-8", "surrogatepass")) % 64)
    return bit - (1 << 64) if bit >> 63 else bit


def _distinct(bits):
    """Linear counting over a 64-bit map."""
    return -64.0 * F.log(F.greatest(64 - F.bit_count(bits), F.lit(0.5)) / 64.0)


class Model(NamedTuple):
    terms: tuple[str, ...]
    beginnings: tuple[str, ...]
    weights: dict[tuple[str, int, bool], float]
    default: dict[tuple[int, bool], float]
    prior: float
    nothing: float  # log odds of a text without hits


def sample_of(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[DataFrame, int, int]:
    """Stored (toxic, text) sample, and how many rows of each class it was drawn from."""
    known = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("toxic")).where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & learn(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 20))
    share = lambda most, k: int((1 << 20) * min(1.0, most / n.get(k, 1))) + 1
    drawn = known.where(draw < F.when(F.col("toxic") == 1, share(TOXIC, 1)).otherwise(share(CLEAN, 0)))
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = texts.join(F.broadcast(drawn), "doc_id")  # about TOXIC + CLEAN identifiers at most
    return stored(rows.select("toxic", "text"), "labelled"), n.get(1, 0), n.get(0, 0)


def _keys(token: str):
    """A word and its beginnings, as lexicon candidates."""
    word = token.strip(MARKS)
    if len(word) >= 3:
        yield word
        for n in PREFIXES:
            if len(word) > n:
                yield word[:n] + "*"


def learn(sample: DataFrame, n_toxic: int, n_clean: int) -> Model | None:
    """Lexicon and weights from a stored (toxic, text) sample of classes of the given sizes."""
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return None

    def neighbourhoods(frames):
        found: dict[str, int] = {}
        size = 0
        for pdf in frames:
            for text in pdf["text"]:
                tokens = (text or "").lower().split()
                size += len(tokens)
                for i, t in enumerate(tokens):
                    at = _place(tokens, i)
                    for key in _keys(t):
                        found[key] = found.get(key, 0) | at
        yield pd.DataFrame({"key": pd.Series(list(found), dtype=object), "places": pd.Series(list(found.values()), dtype="int64")})

    support = sample.where("toxic = 1").mapInPandas(neighbourhoods, "key string, places long").groupBy("key").agg(F.expr("bit_or(places)").alias("places"))
    support = {r["key"]: r["n"] for r in support.select("key", _distinct(F.col("places")).alias("n")).where(F.col("n") >= LEAST - 0.5).collect()}  # bounded by the sample
    candidates = frozenset(support)

    def uses(frames):
        count: dict[str, int] = {}
        for pdf in frames:
            for text in pdf["text"]:
                for t in (text or "").lower().split():
                    for key in _keys(t):
                        if key in candidates:
                            count[key] = count.get(key, 0) + 1
        yield pd.DataFrame({"key": pd.Series(list(count), dtype=object), "uses": pd.Series(list(count.values()), dtype="int64")})

    in_clean = {r["key"]: r["n"] for r in sample.where("toxic = 0").mapInPandas(uses, "key string, uses long").groupBy("key").agg(F.sum("uses").alias("n")).collect()}
    # by chance alone, a key met only in toxic texts has its n neighbourhoods there with probability share ** n
    share = toxic / (toxic + clean)
    hypotheses = max(2, len(candidates)) / share  # keys that all texts together use as often
    needed = max(LEAST, (math.log(hypotheses) + 4) / -math.log(share))
    purity = {k: n / (n + in_clean.get(k, 0)) for k, n in support.items()}
    words = [w for w in candidates if not w.endswith("*")]
    beginnings: list[str] = []
    for key in sorted((k for k in candidates if k.endswith("*")), key=lambda k: (in_clean.get(k, 0) - support[k], k)):
        b = key[:-1]
        nested = any(b.startswith(x) or x.startswith(b) for x in beginnings)
        if not nested and support[key] >= 2 * needed and purity[key] >= LEANING and sum(w.startswith(b) for w in words) >= 3:
            beginnings.append(b)
    terms = sorted(w for w in words if support[w] >= needed and purity[w] >= PURE)
    blob = pickle.dumps((tuple(terms), tuple(beginnings)))

    def calibrate(frames):
        lexicon = _lexicon(blob)
        found: dict[tuple, list[int]] = {}
        for pdf in frames:
            for y, text in zip(pdf["toxic"].tolist(), pdf["text"]):
                seen = set()
                for _, term, kind, quoted, at in lexicon.hits(text):
                    row = found.setdefault((term, kind, quoted, y), [0, 0, 0])
                    row[0] |= at
                    row[1] += 1
                    row[2] += (term, kind, quoted) not in seen
                    seen.add((term, kind, quoted))
                if not seen:
                    found.setdefault(("", -1, False, y), [0, 0, 0])[2] += 1
        columns = ["term", "kind", "quoted", "toxic", "places", "uses", "texts"]
        yield pd.DataFrame([(*k, *v) for k, v in found.items()], columns=columns).astype({"term": object})

    rows = sample.mapInPandas(calibrate, "term string, kind int, quoted boolean, toxic int, places long, uses long, texts long")
    rows = rows.groupBy("term", "kind", "quoted", "toxic").agg(F.expr("bit_or(places)").alias("places"), F.sum("uses").alias("uses"), F.sum("texts").alias("texts"))
    # a term by its neighbourhoods; what pools many words, and meets a text more than once, by texts
    count = F.when(F.col("kind") == EXACT, F.when(F.col("toxic") == 1, _distinct(F.col("places"))).otherwise(F.col("uses"))).otherwise(F.col("texts"))
    got = {(r["term"], r["kind"], r["quoted"], r["toxic"]): r["n"] for r in rows.withColumn("n", count.cast("double")).collect()}

    def ratio(t: float, c: float, kind: int, quoted: bool) -> float:
        assumed = QUOTED_PRIOR if quoted else NEAR_PRIOR if kind in (NEAR, FAR) else 0.5
        return math.log(((t + assumed) / toxic) / ((c + 0.5) / clean))

    weights = {}
    for term, kind, quoted, _ in got:
        if kind >= 0:
            weights[term, kind, quoted] = ratio(got.get((term, kind, quoted, 1), 0), got.get((term, kind, quoted, 0), 0), kind, quoted)
    default = {(kind, quoted): ratio(0, 0, kind, quoted) for kind in range(4) for quoted in (False, True)}
    prior = math.log((n_toxic + 0.5) / (n_clean + 0.5))
    nothing = math.log((got.get(("", -1, False, 1), 0) + 0.5) / toxic) - math.log((got.get(("", -1, False, 0), 0) + 0.5) / clean) + prior
    return Model(tuple(terms), tuple(beginnings), weights, default, prior, nothing)


@lru_cache(4)
def _lexicon(blob: bytes) -> Lexicon:
    return Lexicon(*pickle.loads(blob))


@lru_cache(2)
def _model(blob: bytes) -> tuple[Model, Lexicon]:
    model = pickle.loads(blob)
    return model, Lexicon(model.terms, model.beginnings)


def score_text(text, model: Model, lexicon: Lexicon) -> float:
    """Each different word counts once, by its strongest hit."""
    best: dict[str, float] = {}
    for word, term, kind, quoted, _ in lexicon.hits(text):
        w = model.weights.get((term, kind, quoted), model.default[kind, quoted])
        best[word] = max(w, best.get(word, -99.0))
    odds = model.prior + math.fsum(best.values()) if best else model.nothing
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    blob = pickle.dumps(model)

    @F.pandas_udf("double")
    def run(text: pd.Series) -> pd.Series:
        own, lexicon = _model(blob)
        return pd.Series([score_text(t, own, lexicon) for t in text], dtype="float64")

    return rows.select("doc_id", run("text").alias("score"))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(*sample_of(docs, table(spark, sf_dir, "labels"), lambda doc_id: ~held_out(doc_id)))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= FLAG).cast("int").alias("predicted"))
