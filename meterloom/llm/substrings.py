"""Removal of repeated word sequences by relative Lempel-Ziv parsing.

A word is removed when a window of SPAN words covers it whose word sequence also starts in a document with a smaller
identifier. The reference of a document is all documents before it, cut in blocks that overlap by more than a window.

Every window has a seed: of its KMER-word sequences the one with the smallest hash, so equal windows have equal seeds.
Sequences that a fixed-size sketch of the corpus counts often, such as common lines, come after all others, so that they
are the seed only of windows made of nothing else.
Seeds that two documents hold are found in one exchange; the first document to hold one is its reference, and the block
around it is brought to all later holders. Each document is parsed greedily against the blocks it was brought: from its
next seed, the longest match with any block is a factor, and the parse goes on behind it. A factor of SPAN words or more
is a duplicate span. What the parse cannot decide are windows that no single factor holds: across factor boundaries, or
equal to a later holder only. Those, and only those, are checked one by one: their hashes are joined with the hashes of
the undecided windows of all documents. The first document with a window never has it inside a factor, so none is missed.

Words, seeds and windows are compared by 64-bit hashes (two different ones of a billion agree with odds of about one in
forty). Documents with equal word sequences are parsed once: the later ones are removed whole.

Defined results: null and empty texts have no words; texts of fewer than SPAN words lose nothing; rows with equal
identifiers are one document's parts and do not remove each other; a row with a null identifier neither loses words nor
makes others lose them; only the named columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterloom.llm.common import discard, fresh, hashes, id_text, rolled, stored, table, utf8, words
from meterloom.llm.sketches import Filter, merged

SPAN, KMER = 13, 7
BLOCK, MARGIN = 256, 64  # words of a reference block, and how far it reaches over either end
APART = 0x9E3779B1  # parts the marks of one document's blocks
SKETCH = 1 << 20
COMMON = 30  # count, above the sketch's noise, from which a sequence is a seed only where there is no other
SHORT = 300  # documents, above the sketch's noise, up to which a seed is tested in one task

def seeds(h: np.ndarray, span: int = SPAN, common=None) -> tuple[np.ndarray, np.ndarray]:
    """Seed hash of every window, and its position; ``common`` tells of hashes whether they come after all others."""
    if len(h) < span:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = rolled(h, KMER)
    order = grams if common is None else (grams >> np.uint64(1)) | (common(grams).astype(np.uint64) << np.uint64(63))
    n = len(h) - span + 1
    least, at = order[:n].copy(), np.arange(n)
    for j in range(1, span - KMER + 1):
        less = np.flatnonzero(order[j : j + n] < least)
        least[less], at[less] = order[less + j], less + j
    return grams[at], at


class Counts:
    """The sketch of how often sequences are seeds, shared with all tasks."""

    def __init__(self, spark, sketch: np.ndarray):
        noise = float(np.median(sketch))
        self.shared, self.common_from, self.often_from = spark.sparkContext.broadcast(sketch), noise + COMMON, noise + SHORT

    def of(self, grams: np.ndarray) -> np.ndarray:
        return self.shared.value[(grams & np.uint64(SKETCH - 1)).astype(np.intp)]

    def common(self, grams: np.ndarray) -> np.ndarray:
        return self.of(grams) > self.common_from

    def often(self, grams: np.ndarray) -> np.ndarray:
        return self.of(grams) > self.often_from


def seeds_of(h: np.ndarray, sizes: np.ndarray, span: int, common=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the document, seed, its place there) for several documents at once; neighbours' common seeds once."""
    seed, at = seeds(h, span, common)
    doc, ends = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes)
    start = np.arange(len(seed))
    start = start[start + span <= ends[doc[: len(seed)]]]  # windows within one document
    start = start[np.diff(at[start], prepend=-1) != 0]
    own = doc[start]
    return own, seed[start], at[start] - (ends - sizes)[own]


def groups(pdf: pd.DataFrame, most: int = 1 << 19):
    """Identifiers, word hashes and numbers of words of a batch's documents, about ``most`` bytes of text at a time."""
    ids, own, size = [], [], 0
    for doc, text in zip(pdf["doc_id"], pdf["text"]):
        ids.append(doc)
        own.append(utf8(text))
        size += len(own[-1])
        if size >= most:
            yield ids, *hashes(own)
            ids, own, size = [], [], 0
    if own:
        yield ids, *hashes(own)


def common_length(x: np.ndarray, y: np.ndarray) -> int:
    n = min(len(x), len(y))
    differ = x[:n] != y[:n]
    k = int(differ.argmax()) if n else 0
    return k if n and differ[k] else n


def parse(h: np.ndarray, shared: np.ndarray, blocks: list[np.ndarray], span: int = SPAN) -> list[tuple[int, int]]:
    """Greedy factors of ``span`` words or more: (start, end), by the longest match of each next shared seed."""
    grams = rolled(h, KMER)
    every, ends = np.concatenate(blocks), np.cumsum(list(map(len, blocks)))
    own = rolled(every, KMER)
    index: dict[int, list[tuple[np.ndarray, int]]] = {}
    places = np.flatnonzero(np.isin(own, shared))
    number = np.searchsorted(ends, places, side="right")
    for q, k in zip(places.tolist(), number.tolist()):
        if q + KMER <= ends[k]:
            index.setdefault(int(own[q]), []).append((blocks[k], q - int(ends[k]) + len(blocks[k])))
    out, done = [], 0
    for p in np.flatnonzero(np.isin(grams, shared)).tolist():
        if p + KMER <= done:
            continue
        best = (0, 0)
        for block, q in index.get(int(grams[p]), ()):
            right = common_length(h[p:], block[q:])
            left = common_length(h[:p][::-1], block[:q][::-1])
            best = max(best, (left + right, right))
        length, right = best
        if length >= span:
            out.append((p + right - length, p + right))
            done = p + right
    return out


def undecided(seed: np.ndarray, shared: np.ndarray, factors: list[tuple[int, int]], span: int = SPAN) -> np.ndarray:
    """Starts of windows with a shared seed that no single factor holds."""
    start = np.flatnonzero(np.isin(seed, shared))
    inside = np.zeros(len(seed) + 1, bool)
    for a, b in factors:
        inside[a : b - span + 1] = True
    return start[~inside[start]]


def merged_spans(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def content(docs: DataFrame) -> DataFrame:
    """Stored (doc_id, n_words, node) for every row; node is the SHA-256 of the words joined by one space."""

    def run(frames):
        for pdf in frames:
            size, node = [], []
            for text in pdf["text"]:
                own = words(text)
                size.append(len(own))
                node.append(hashlib.sha256(b" ".join(own)).hexdigest())
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_words": pd.Series(size, dtype="int64", index=pdf.index), "node": pd.Series(node, dtype=object, index=pdf.index)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(docs.mapInPandas(run, f"doc_id {kind}, n_words long, node string"), "content")


def shared_seeds(docs: DataFrame, kind: str, span: int, among: Filter) -> tuple[DataFrame, Counts]:
    """Stored (seed, doc_id, first_id, first_at) for the seeds of two documents or more: who holds one first, and where.

    ``docs`` has a column ``mark``; only documents that ``among`` lets through take part.
    """

    def count(frames, array):
        for pdf in frames:
            for _, h, sizes in groups(pdf[among(pdf["mark"])]):
                np.add.at(array, (seeds_of(h, sizes, span)[1] & np.uint64(SKETCH - 1)).astype(np.intp), 1)

    sketch = merged(docs, count, SKETCH, "<i4", np.add)
    counts = Counts(docs.sparkSession, sketch)

    def those(often: bool) -> DataFrame:
        def run(frames):
            for pdf in frames:
                for ids, h, sizes in groups(pdf[among(pdf["mark"])]):
                    number, seed, place = seeds_of(h, sizes, span, counts.common)
                    own = counts.often(seed) == often
                    yield pd.DataFrame({"seed": seed[own].view(np.int64), "doc_id": pd.Series(ids).to_numpy()[number[own]], "at": place[own].astype(np.int32)})

        return docs.mapInPandas(run, f"seed long, doc_id {kind}, at int")

    keep = ["seed", "doc_id", F.col("first.doc_id").alias("first_id"), F.col("first.at").alias("first_at")]
    two = F.col("first.doc_id") != F.col("last")
    each = W.partitionBy("seed")
    rare = those(False).withColumn("first", F.min(F.struct("doc_id", "at")).over(each)).withColumn("last", F.max("doc_id").over(each)).where(two).select(*keep).distinct()
    often = stored(those(True), "often")
    firsts = often.groupBy("seed").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.max("doc_id").alias("last")).where(two)
    held = stored(rare.unionByName(often.join(firsts, "seed").select(*keep).distinct()), "seeds")
    discard(often)
    return held, counts


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``docs`` joined with ``wanted`` by doc_id; only texts that a filter of fixed size lets through are shuffled."""
    through = _passes(Filter(wanted.select(F.xxhash64("doc_id").alias("mark")), "mark"))
    return docs.where(through(F.xxhash64("doc_id"))).select("doc_id", "text").join(wanted.hint("merge"), "doc_id")


def _passes(through: Filter):
    @F.pandas_udf("boolean")
    def run(mark: pd.Series) -> pd.Series:
        return pd.Series(through(mark), dtype=bool)

    return run


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """(doc_id, n_words, node, copied, spans) for every row: word spans that earlier documents hold.

    ``copied`` rows equal an earlier document word for word; all their words are repeated if they have ``span`` of them.
    """
    docs = id_text(docs, id_col, text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = content(docs)
    firsts = stored(rows.where("doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("first")), "firsts")
    known = docs.where("doc_id is not null")
    one = Filter(firsts.select(F.xxhash64("first").alias("mark")), "mark")  # copies that pass by chance are parsed like others

    held, counts = shared_seeds(known.withColumn("mark", F.xxhash64("doc_id")), kind, span, one)

    block = F.floor(F.col("first_at") / BLOCK).cast("int")
    wants = stored(held.where("first_id < doc_id").select("doc_id", "first_id", block.alias("block")).distinct(), "wants")
    asked = Filter(wants.select(F.xxhash64("first_id").bitwiseXOR(F.col("block") * F.lit(APART)).alias("mark")), "mark")

    def cut(frames):
        for pdf in frames:
            texts = [utf8(t) for t in pdf["text"]]
            most = np.fromiter(map(len, texts), np.int64, len(texts)) // (2 * BLOCK) + 1  # blocks a text can have
            own = np.repeat(np.arange(len(texts)), most)
            number = np.arange(len(own)) - np.repeat(np.cumsum(most) - most, most)
            hit = asked(pd.Series(pdf["mark"].to_numpy(np.int64)[own] ^ (number * APART)))
            own, number = own[hit], number[hit]
            parts, last, split = [], -1, []
            for i, b in zip(own.tolist(), number.tolist()):
                if i != last:
                    last, split = i, texts[i].split()
                parts.append(b" ".join(split[max(0, b * BLOCK - MARGIN) : (b + 1) * BLOCK + MARGIN]))
            yield pd.DataFrame({"first_id": pdf["doc_id"].to_numpy()[own], "block": number.astype(np.int32), "words": pd.Series(parts, dtype=object)})

    blocks = known.withColumn("mark", F.xxhash64("doc_id")).mapInPandas(cut, f"first_id {kind}, block int, words binary")
    brought = wants.join(blocks, ["first_id", "block"]).groupBy("doc_id").agg(F.collect_list("words").alias("blocks"))
    lists = held.groupBy("doc_id").agg(F.collect_list("seed").alias("seeds"), F.collect_list(F.when(F.col("first_id") < F.col("doc_id"), F.col("seed"))).alias("later"))
    holders = texts_of(known, lists)

    def factor(frames):
        for pdf in frames:
            out = []
            for doc, text, mine, later, given in zip(pdf["doc_id"], pdf["text"], pdf["seeds"], pdf["later"], pdf["blocks"]):
                own = words(text)
                given = [] if given is None else [bytes(b) for b in given]
                h, sizes = hashes([utf8(text), *given])
                h, *given = np.split(h, np.cumsum(sizes)[:-1])
                all_seeds, later = (np.asarray(x, np.int64).view(np.uint64) for x in (mine, later))
                spans = parse(h, later, given, span) if given else []
                window_seeds, _ = seeds(h, span, counts.common)
                open_at = undecided(window_seeds, all_seeds, spans, span)
                key = rolled(h, span)[open_at].view(np.int64)
                asks = np.isin(window_seeds[open_at], later)
                out.append((doc, hashlib.sha256(b" ".join(own)).hexdigest(), [{"start": a, "end": b} for a, b in spans], open_at.tolist(), key.tolist(), asks.tolist()))
            yield pd.DataFrame(out, columns=["doc_id", "node", "spans", "at", "window", "asks"])

    pairs = "array<struct<start:int,end:int>>"
    parsed = holders.join(brought, "doc_id", "left").mapInPandas(factor, f"doc_id {kind}, node string, spans {pairs}, at array<int>, window array<long>, asks array<boolean>")
    parsed = stored(parsed, "parsed")
    discard(wants, held)

    windows = parsed.select("doc_id", "node", F.explode(F.arrays_zip("at", "window", "asks")).alias("w")).select("doc_id", "node", "w.at", "w.window", "w.asks")
    earlier = windows.groupBy("window").agg(F.min("doc_id").alias("earliest"))
    found = windows.where("asks").join(earlier, "window").where("earliest < doc_id").select("doc_id", "node", F.struct(F.col("at").alias("start"), (F.col("at") + span).alias("end")).alias("one"))
    whole = parsed.select("doc_id", "node", F.explode("spans").alias("one"))
    spans = whole.unionByName(found).groupBy("doc_id", "node").agg(F.collect_list("one").alias("spans"))

    join_up = F.udf(lambda s: [{"start": a, "end": b} for a, b in merged_spans([(x["start"], x["end"]) for x in s])], pairs)
    spans = stored(spans.select("doc_id", "node", join_up("spans").alias("spans")), "spans")
    discard(parsed)

    every = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    none = F.array().cast(pairs)
    copied = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    out = rows.join(firsts, "node", "left").join(spans, ["doc_id", "node"], "left").withColumn("copied", copied)
    cut_out = F.when(F.col("copied"), F.when(F.col("n_words") >= span, every).otherwise(none)).otherwise(F.coalesce("spans", none))
    return out.select("doc_id", "n_words", "node", "copied", cut_out.alias("spans"))


def kept(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, node, n_removed, kept) for the rows that lose some words but are no copies; kept words joined by one space."""
    docs = id_text(docs, id_col, text_col).where("doc_id is not null")
    kind = docs.schema["doc_id"].dataType.simpleString()
    wanted = found.where(~F.col("copied") & (F.size("spans") > 0)).select("doc_id", "node", "spans").dropDuplicates(["doc_id", "node"])

    def cut(frames):
        for pdf in frames:
            out = []
            for doc, text, node, spans in zip(pdf["doc_id"], pdf["text"], pdf["node"], pdf["spans"]):
                own = words(text)
                if hashlib.sha256(b" ".join(own)).hexdigest() == node:
                    gone = np.zeros(len(own), bool)
                    for s in spans:
                        gone[s["start"] : s["end"]] = True
                    out.append((doc, node, int(gone.sum()), b" ".join([w for w, g in zip(own, gone) if not g]).decode("utf-8", "surrogatepass")))
            yield pd.DataFrame(out, columns=["doc_id", "node", "n_removed", "kept"])

    return texts_of(docs, wanted).mapInPandas(cut, f"doc_id {kind}, node string, n_removed long, kept string")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """The rows of ``docs`` with their columns; repeated spans are cut from the text, rows that lose all words go.

    Texts that lose nothing stay as they are; of the others the kept words are joined by one space.
    """
    found = stored(repeated(docs, id_col, text_col, span), "repeated")
    gone = found.where(F.col("copied") & (F.size("spans") > 0)).select("doc_id", "node", F.lit("").alias("kept"))
    new = stored(kept(docs, found, id_col, text_col).select("doc_id", "node", "kept").unionByName(gone).dropDuplicates(["doc_id", "node"]), "cut")
    changed = Filter(new.select(F.xxhash64("doc_id").alias("mark")), "mark")
    text, mark = F.col(f"`{text_col}`").cast("string"), _passes(changed)(F.xxhash64(F.col(f"`{id_col}`")))
    node = F.udf(lambda t: hashlib.sha256(b" ".join(words(t))).hexdigest(), "string", useArrow=True)
    new_id, new_node, new_text, own_node = (fresh(c, docs) for c in ("new_id", "new_node", "new_text", "own_node"))
    new = new.select(F.col("doc_id").alias(new_id), F.col("node").alias(new_node), F.col("kept").alias(new_text))
    rows = docs.where(mark).withColumn(own_node, node(text))
    rows = rows.join(new, (F.col(f"`{id_col}`") == F.col(new_id)) & (F.col(own_node) == F.col(new_node)), "left")
    rows = rows.where(F.col(new_text).isNull() | (F.col(new_text) != "")).withColumn(text_col, F.coalesce(new_text, text)).select(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.where(~mark).withColumn(text_col, text).unionByName(rows)


def op4_substrings(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = stored(repeated(docs), "repeated")
    cut = kept(docs, found).select("doc_id", "node", F.col("n_removed").alias("cut"), F.sha2("kept", 256).alias("cut_sha256")).dropDuplicates(["doc_id", "node"])
    gone = F.col("copied") & (F.size("spans") > 0)
    removed = F.when(gone, F.col("n_words")).otherwise(F.coalesce("cut", F.lit(0)))
    digest = F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha256", "node"))
    return found.join(cut, ["doc_id", "node"], "left").select("doc_id", "n_words", removed.cast("long").alias("n_removed"), digest.alias("kept_sha256"))


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT r, doc_id, unnest(generate_series(1, len(ws) - {SPAN - 1})) AS i, ws FROM d WHERE len(ws) >= {SPAN}),
k AS (SELECT r, doc_id, i, array_to_string(ws[i:i + {SPAN - 1}], ' ') AS g FROM p),
f AS (SELECT g, min(doc_id) AS first_id FROM k GROUP BY g),
c AS (SELECT DISTINCT r, unnest(generate_series(i, i + {SPAN - 1})) AS i FROM k JOIN f USING (g) WHERE first_id < doc_id),
g AS (SELECT r, list(i) AS gone FROM c GROUP BY r),
o AS (SELECT doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed,
  CASE WHEN gone IS NULL THEN ws ELSE list_transform(list_filter(generate_series(1, len(ws)), lambda x: NOT list_contains(gone, x)), lambda x: ws[x]) END AS rest FROM d LEFT JOIN g USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(array_to_string(rest, ' ')) AS kept_sha256 FROM o"""
