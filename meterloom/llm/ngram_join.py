"""Exact n-gram Jaccard join by adaptive multi-match prefixes, with connected components.

A text's tokens are its distinct word n-grams, as 64-bit hashes (two different ones of a billion texts agree with odds of
about one in forty). All texts order their tokens alike: by an estimate of how many texts hold them, from a fixed-size
counting sketch over the whole corpus, then by value. Two texts with n tokens that share the o = ceil(t n) a link needs
share ``l`` of the first n - o + l tokens. A longer prefix costs longer lists to meet in but needs more shared tokens
before a pair is verified; each text takes the ``l`` whose estimated lists and candidates cost least. A pair is verified,
on its whole token sets, when its prefixes share as many tokens as the smaller ``l`` of the two.

Texts with equal sets are one node. Within long lists, verifying all pairs of a large group of near copies would grow with
its square, and the links among texts already known to be connected change no component. So the members of long lists are
first compared with one member each, the most central one; afterwards pairs whose ends are already connected are left out,
and all other pairs of all lists are candidates as above. No link between components can be lost.

In long lists a pair must also pass a bound on what its sets do not share: every token flips one of 512 bits of its text's
mark, so two marks differ in no more bits than the sets in tokens. That parts members of a large group which share most of
their tokens, hence their prefixes, and yet not enough of them.

``links`` leaves nothing out: it verifies the candidates within components too and gives every link between different
sets, with the rows that hold each set. Its work and its rows grow with the number of links.

Defined results: texts without words, or null, have no tokens and link with nothing; a text with fewer words than n has
its whole sequence as only token; rows with equal identifiers and texts are copies like any others; a row with a null
identifier is part of its group but never names it; only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterloom.llm.common import discard, fresh, hashes, id_text, rolled, stored, table, utf8
from meterloom.llm.graphs import components
from meterloom.llm.sketches import Filter, merged

COUNTERS, LEAST, MOST = 10, 1 << 20, 1 << 24  # of the sketch: for each row, least and most of all
MARK = 8  # words of 64 bits
LONGEST = 16  # shared prefix tokens asked for at most
LONG_LIST = 8  # members above which a list is first met through its centre
SHORT = 300  # texts, above the sketch's noise, up to which a list is tested in one task
ROUNDS = 4

def tokens(text, size: int) -> np.ndarray:
    """Sorted distinct n-gram hashes. Only A-Z are lowered, as ``bytes.lower`` does."""
    h, _ = hashes([utf8(text).lower()])
    return np.unique(rolled(h, min(size, len(h)))) if len(h) else h


def node_of(own: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(own.tobytes()) - (1 << 63)


def mark_of(own: np.ndarray) -> np.ndarray:
    """Of each bit, whether an odd number of tokens falls on it."""
    odd = np.bincount((own >> np.uint64(64 - 9)).astype(np.intp), minlength=64 * MARK) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def prefix_of(own: np.ndarray, sketch: np.ndarray, noise: float, num: int, den: int):
    """Prefix tokens, which of them are often met, shared tokens asked for, mean estimate (how central the text is)."""
    n = len(own)
    needed = -(-num * n // den)
    counted = sketch[(own & np.uint64(len(sketch) - 1)).astype(np.intp)]
    estimate = np.maximum(counted - noise, 1.0)
    order = np.lexsort((own, estimate))
    base = n - needed + 1
    most = min(LONGEST, needed, n - base + 1)
    lists = np.cumsum(estimate[order[: base + most - 1]])[base - 1 :]
    asked = np.arange(1, most + 1)
    best = int(np.argmin(lists + n * lists / asked**2)) + 1  # meeting, and verifying what shares enough
    first = order[: base + best - 1]
    return own[first], counted[first] > noise + SHORT, best, float(estimate.mean())


def prefixes(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Stored (doc_id, node, n, asked, centre, prefix, often, mark) for every row; ``often`` tells the tokens of long lists."""
    texts = id_text(docs)
    counters = min(MOST, max(LEAST, 1 << (COUNTERS * texts.count()).bit_length()))  # else noise would grow with the rows

    def count(frames, array):
        for pdf in frames:
            for text in pdf["text"]:
                own = tokens(text, size)
                np.add.at(array, (own & np.uint64(counters - 1)).astype(np.intp), 1)

    sketch = merged(texts.select("text"), count, counters, "<i4", np.add)
    noise, shared = float(np.median(sketch)), docs.sparkSession.sparkContext.broadcast(sketch)

    def run(frames):
        for pdf in frames:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                own = tokens(text, size)
                if len(own):
                    prefix, often, asked, centre = prefix_of(own, shared.value, noise, num, den)
                    rows.append((doc, node_of(own), len(own), asked, centre, prefix.view(np.int64), often, mark_of(own)))
                else:
                    rows.append((doc, 0, 0, 0, 0.0, own.view(np.int64), np.zeros(0, bool), mark_of(own)))
            out = pd.DataFrame(rows, columns=["doc_id", "node", "n", "asked", "centre", "prefix", "often", "mark"])
            out["doc_id"] = pdf["doc_id"].to_numpy()
            yield out

    kind = texts.schema["doc_id"].dataType.simpleString()
    return stored(texts.mapInPandas(run, f"doc_id {kind}, node long, n int, asked int, centre double, prefix array<long>, often array<boolean>, mark array<long>"), "prefixes")


def token_sets(docs: DataFrame, signed: DataFrame, nodes: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Stored (node, pick, tokens), and (node, pick): the text whose identifier hashes to ``pick`` stands for its node.

    The scan emits the texts whose identifier is in a filter of fixed size; the others it lets through by chance are
    left out by the join on both columns.
    """
    picks = signed.where("n > 0").join(nodes, "node", "left_semi").groupBy("node").agg(F.min(F.xxhash64("doc_id")).alias("pick"))
    picks = stored(picks, "picks")
    wanted = Filter(picks, "pick")

    def run(frames):
        for pdf in frames:
            hit = wanted(pdf["pick"])
            rows = [(pick, tokens(text, size)) for pick, text in zip(pdf["pick"][hit], pdf["text"][hit])]
            rows = [(node_of(own), pick, own.tobytes()) for pick, own in rows if len(own)]
            yield pd.DataFrame({"node": pd.Series([r[0] for r in rows], dtype="int64"), "pick": pd.Series([r[1] for r in rows], dtype="int64"), "tokens": pd.Series([r[2] for r in rows], dtype=object)})

    found = id_text(docs).select(F.xxhash64("doc_id").alias("pick"), "text").mapInPandas(run, "node long, pick long, tokens binary")
    return stored(found, "sets"), picks


def linked(pairs: DataFrame, sets: DataFrame, picks: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose token sets reach the threshold."""

    def run(frames):
        for pdf in frames:
            keep = []
            for x, y in zip(pdf["x"], pdf["y"]):
                both = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                keep.append(den * both >= num * (len(x) // 8 + len(y) // 8 - both))
            yield pdf.loc[np.array(keep, bool), ["a", "b"]]

    side = lambda end, name: sets.select(F.col("node").alias(end), F.col("pick").alias(f"pick_{end}"), F.col("tokens").alias(name))
    pick = lambda end: picks.select(F.col("node").alias(end), F.col("pick").alias(f"pick_{end}"))
    known = pairs.join(pick("a"), "a").join(pick("b"), "b")
    both = known.join(side("a", "x"), ["a", "pick_a"]).join(side("b", "y"), ["b", "pick_b"])
    return both.select("a", "b", "x", "y").mapInPandas(run, "a long, b long")


def _fits(x: str, y: str, num: int, den: int):
    """Whether a token that two nodes meet in counts, and the pair can still share what it must.

    Sets of n and m tokens at the threshold share o = ceil(num (n + m) / (num + den)), so they share ``l`` of the first
    n - o + l and m - o + l tokens, ``l`` being what the less demanding one asks for. The token must stand there, and so
    must ``l`` tokens that each node shares with anybody: no more than n - o others may stand before the l-th of them.
    ``others`` tells that for every second one, so the bound is taken at ``l`` or one before.
    """
    c = lambda side, name: F.col(f"{side}{name}")
    total, asked = c(x, "n") + c(y, "n"), F.least(c(x, "asked"), c(y, "asked"))
    needed = F.ceil(num * total / F.lit(float(num + den)) - F.lit(1e-9))
    half = F.floor(asked / 2).cast("int")
    before = lambda side: F.when(half == 0, F.lit(0)).otherwise(F.call_function("shiftright", c(side, "others"), 8 * (half - 1)).bitwiseAND(F.lit(255)))
    sides = [(c(side, "at") < c(side, "n") - needed + asked) & (before(side) <= c(side, "n") - needed) for side in (x, y)]
    return sides[0] & sides[1]


def shared_lists(signed: DataFrame) -> DataFrame:
    """Stored (token, at, node, n, asked, centre, others) for the prefix tokens of two nodes or more, each node once.

    Tokens whose estimate, which is never too low, is small are tested list by list in one exchange. The others need no
    test; they go on as they are, so that no list without a bound meets in a task. A node all whose lists ask for more
    tokens than it shares links with nothing and goes. ``others`` packs, for the second, fourth, ... shared token of a
    node, how many unshared ones stand before it, a byte each.
    """
    pair = F.posexplode(F.arrays_zip("prefix", "often")).alias("at", "p")
    rows = signed.where("n > 0").select(pair, "node", "n", "asked", "centre").select(F.col("p.prefix").alias("token"), "at", "node", "n", "asked", "centre", F.col("p.often").alias("often"))
    each = W.partitionBy("token")
    rare = rows.where(~F.col("often")).withColumn("first", F.min("node").over(each)).withColumn("last", F.max("node").over(each))
    rare = rare.withColumn("least", F.min("asked").over(each)).where("first <> last").drop("first", "last", "often").dropDuplicates(["token", "node"])
    often = rows.where("often").drop("often").withColumn("least", F.lit(1)).dropDuplicates(["token", "node"])
    whole = stored(rare.unionByName(often), "lists")

    nodes = whole.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("at", "token"))).alias("own"), F.min("least").alias("least"), *[F.first(x).alias(x) for x in ("n", "asked", "centre")])
    place = lambda r: F.least(F.lit(255), F.coalesce(F.get("own", F.lit(r))["at"] - r, F.lit(255))).cast("long")
    others = F.lit(0).cast("long")
    for k in range(LONGEST // 2):
        others = others.bitwiseOR(F.shiftleft(place(2 * k + 1), 8 * k))
    nodes = nodes.where(F.size("own") >= F.col("least")).withColumn("others", others)
    lists = nodes.select(F.explode("own").alias("p"), "node", "n", "asked", "centre", "others").select("p.token", "p.at", "node", "n", "asked", "centre", "others")
    packed = stored(lists, "lists")
    discard(whole)
    shared = packed.groupBy("token").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first <> last").select("token")
    out = stored(packed.join(shared, "token", "left_semi"), "lists")
    discard(packed)
    return out


def long_lists(lists: DataFrame) -> DataFrame:
    return lists.groupBy("token").agg(F.count("*").alias("size")).where(F.col("size") > LONG_LIST).select("token")


def marked(rows: DataFrame, long: DataFrame, signed: DataFrame) -> DataFrame:
    """``rows`` with the mark of their node where their token has a long list, null elsewhere."""
    marks = signed.where("n > 0").select("node", "mark").dropDuplicates(["node"]).withColumn("long", F.lit(True))
    return rows.join(long.withColumn("long", F.lit(True)), "token", "left").join(marks, ["node", "long"], "left").drop("long")


def _near(x: str, y: str, num: int, den: int):
    """Whether two sets may differ in few enough tokens: of n + m, a link leaves (den - num) / (den + num) unshared."""
    word = lambda side, i: F.get(F.col(f"{side}mark"), F.lit(i))
    differ = sum((F.bit_count(word(x, i).bitwiseXOR(word(y, i))) for i in range(1, MARK)), F.bit_count(word(x, 0).bitwiseXOR(word(y, 0))))
    total = (F.col(f"{x}n") + F.col(f"{y}n")).cast("long")
    return F.coalesce((num + den) * differ <= (den - num) * total, F.lit(True))


def verified(docs: DataFrame, signed: DataFrame, left: DataFrame, right: DataFrame, which, size: int, num: int, den: int) -> DataFrame:
    """Stored links (a, b), a > b, among the pairs of ``left`` (x) and ``right`` (y), both marked, that meet in a token and fulfil ``which``."""
    pairs = left.alias("x").join(right.alias("y"), (F.col("x.token") == F.col("y.token")) & which & _fits("x.", "y.", num, den) & _near("x.", "y.", num, den))
    pairs = pairs.select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b"), F.least("x.asked", "y.asked").alias("asked"))
    pairs = stored(pairs.groupBy("a", "b").agg(F.count("*").alias("shared"), F.first("asked").alias("asked")).where("shared >= asked").select("a", "b"), "pairs")
    if pairs.isEmpty():
        return pairs
    sets, picks = token_sets(docs, signed, pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct(), size)
    out = stored(linked(pairs, sets, picks, num, den), "found")
    discard(pairs, sets, picks)
    return out


def links(docs: DataFrame, size: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every link, as (doc_id, n, node) for every row and (a, b), a > b, for every two linked nodes.

    Rows with equal token sets have one node and are linked with each other; rows without tokens have none.
    """
    docs = id_text(docs, id_col, text_col)
    signed = prefixes(docs, size, num, den)
    lists = shared_lists(signed)
    rows = stored(marked(lists, long_lists(lists), signed), "rows")
    discard(lists)
    members = signed.select("doc_id", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"))
    return members, verified(docs, signed, rows, rows, F.col("x.node") < F.col("y.node"), size, num, den)


def link_counts(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, n_links) for every row: how many other rows it is linked with."""
    copies = members.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("copies"))
    both = pairs.select(F.col("a").alias("own"), F.col("b").alias("node")).union(pairs.select(F.col("b").alias("own"), F.col("a").alias("node")))
    near = both.join(copies, "node").groupBy(F.col("own").alias("node")).agg(F.sum("copies").alias("near"))
    per = copies.join(near, "node", "left").select("node", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))
    return members.join(per, "node", "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def link(docs: DataFrame, size: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row: texts are linked when ``den * shared >= num * union``."""
    docs = id_text(docs, id_col, text_col)
    signed = prefixes(docs, size, num, den)
    lists = shared_lists(signed)
    roots = None  # (node, root) of what is known to be connected
    found = None  # links verified so far

    def with_roots(rows: DataFrame) -> DataFrame:
        if roots is None:
            return rows.withColumn("root", F.col("node"))
        return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    def open_lists(rows: DataFrame, least: int) -> DataFrame:
        """Lists with nodes of several components: their size, their centre and its component."""
        best = F.max_by(F.struct("node", "n", "asked", "at", "others", "root"), F.struct("centre", "node"))
        per = rows.groupBy("token").agg(F.count("*").alias("size"), F.min("root").alias("first"), F.max("root").alias("last"), best.alias("hub"))
        return per.where((F.col("first") != F.col("last")) & (F.col("size") > least)).select("token", "hub")

    def with_links(more: DataFrame) -> None:
        nonlocal roots, found
        found = more if found is None else found.unionByName(more)
        before, roots = roots, stored(components(found), "roots")
        if before is not None:
            discard(before)

    long = long_lists(lists)
    members = stored(lists.join(long, "token", "left_semi"), "long-lists")
    if not members.isEmpty():
        sets, picks = token_sets(docs, signed, members.select("node").distinct(), size)
        tried = None
        for _ in range(ROUNDS):
            rows = with_roots(members)
            star = rows.join(open_lists(rows, LONG_LIST), "token").where((F.col("root") != F.col("hub.root")) & _fits("", "hub.", num, den))
            pairs = star.groupBy(F.col("node").alias("a"), F.col("hub.node").alias("b")).agg(F.count("*").alias("shared"), F.first(F.least("asked", "hub.asked")).alias("asked"))
            pairs = pairs.where("shared >= asked").select("a", "b")
            if tried is not None:
                pairs = pairs.join(tried, ["a", "b"], "left_anti")
            pairs = stored(pairs, "stars")
            tried = pairs if tried is None else tried.unionByName(pairs)
            more = stored(linked(pairs, sets, picks, num, den), "found")
            if more.isEmpty():
                break
            with_links(more)
        discard(sets, picks)
    discard(members)

    rows = stored(marked(with_roots(lists), long, signed), "rows")
    discard(lists)
    main = rows.groupBy("token", "root").agg(F.count("*").alias("size")).groupBy("token").agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.count("*").alias("several")).where("several > 1")
    left = rows.join(main.select("token", "main"), "token")
    once = (F.col("y.root") == F.col("x.main")) | (F.col("x.node") < F.col("y.node"))
    more = verified(docs, signed, left.where("root <> main"), rows, (F.col("x.root") != F.col("y.root")) & once, size, num, den)
    if not more.isEmpty():
        with_links(more)
    discard(rows)

    names = signed.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("name"))
    if roots is not None:
        joined = names.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        names = joined.join(joined.groupBy("root").agg(F.min("name").alias("least")), "root").select("node", F.col("least").alias("name"))
    own = signed.select("doc_id", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"))
    return own.join(names, "node", "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that name their group of linked texts, of equal rows one, with their columns.

    Texts without words stay, and so do rows with a null identifier.
    """
    kept = fresh("kept_id", docs)
    ids = link(docs, size, num, den, id_col, text_col).where("doc_id = component_id").select(F.col("doc_id").alias(kept)).distinct()
    known = docs.where(F.col(f"`{id_col}`").isNotNull())
    once = known.join(ids, F.col(f"`{id_col}`") == F.col(kept), "left_semi").dropDuplicates([id_col, text_col])
    return once.unionByName(docs.where(F.col(f"`{id_col}`").isNull()))


def op1_jaccard(spark, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents"), size=3, num=90, den=100)


def op1_links(spark, sf_dir: str) -> DataFrame:
    return link_counts(*links(table(spark, sf_dir, "documents"), size=3, num=90, den=100))


ORACLE = """
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT r, doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(generate_series(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS g FROM w),
n AS (SELECT r, doc_id, count(*) AS n FROM s GROUP BY r, doc_id),
e AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
l AS (SELECT x, y FROM e JOIN n p ON p.r = x JOIN n q ON q.r = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
c(x, y) AS (SELECT r, r FROM n UNION SELECT c.x, l.y FROM c JOIN l ON l.x = c.y),
m AS (SELECT c.x AS r, min(n.doc_id) AS component_id FROM c JOIN n ON n.r = c.y GROUP BY c.x)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.component_id, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (r) LEFT JOIN m USING (r)"""

LINKS_ORACLE = """
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT r, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(generate_series(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS g FROM w),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
e AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
l AS (SELECT x AS r, count(*) AS n_links FROM e JOIN n p ON p.r = x JOIN n q ON q.r = y WHERE 100 * c >= 90 * (p.n + q.n - c) GROUP BY x)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(l.n_links, 0)::BIGINT AS n_links
FROM w LEFT JOIN n USING (r) LEFT JOIN l USING (r)"""
