"""Secret scans through an incremental blob ledger, in DataFrame operations only.

Every version of every path is addressed by the SHA-256 of its text. The ledger holds one row per (blob, rule version)
with all spans found. A run scans each distinct blob that the ledger lacks for this rule version, once, appends it, and
joins the findings back to all paths holding the blob; a blob that a third of all paths share is scanned once.

Positions come from the text between matches: ``split`` gives the gaps, ``regexp_extract_all`` the matches, and a
running sum over (gap, match) gives the starts, in code points.

Defined results: a null text is an empty text; empty texts and empty tables have no findings; repeated rows each get
the findings of their text; only the named identifier and text columns are read.
"""

from __future__ import annotations

import hashlib
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterloom.llm.common import fresh, id_text, stored, table
from meterloom.session import checkpoint_dir


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int  # whose length must reach ``least``
    least: int


# The three base kinds.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),  # maximal runs: the shorter ones fail and are dropped in any case
)
#: Further kinds; patterns for well-known public token formats.
RULES = (
    *BASE_RULES,
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 29),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 27),
)

LEDGER = "blob string, rule_version string, spans array<struct<start:int,kind_no:int,end:int,prev_end:int>>"


def rule_version(rules=RULES) -> str:
    return hashlib.sha256(repr([tuple(r) for r in rules]).encode()).hexdigest()[:16]


def _hits(text, kind_no: int, rule: Rule):
    """Matches of one rule as (kind_no, gap before it, its length, length of the judged group)."""
    p = F.lit(rule.pattern)
    lengths = lambda a: F.transform(a, lambda s: F.length(s))
    gaps, found = lengths(F.split(text, rule.pattern, -1)), lengths(F.regexp_extract_all(text, p, F.lit(0)))
    judged = lengths(F.regexp_extract_all(text, p, F.lit(rule.group))) if rule.group else found
    rows = F.arrays_zip(gaps.alias("gap"), found.alias("len"), judged.alias("val"))
    rows = F.filter(rows, lambda x: x["len"].isNotNull())  # the text after the last match
    rows = F.transform(rows, lambda x: F.struct(F.lit(kind_no).alias("kind_no"), x["gap"].alias("gap"), x["len"].alias("len"), x["val"].alias("val")))
    return F.when(text.rlike(rule.pattern), rows).otherwise(rows_none())


def rows_none():
    return F.array().cast("array<struct<kind_no:int,gap:int,len:int,val:int>>")


def scan_blobs(blobs: DataFrame, rules=RULES) -> DataFrame:
    """(blob, text) -> (blob, spans); spans sorted by start, then kind. One row per blob, also without findings."""
    text = F.coalesce(F.col("text"), F.lit(""))
    raw = stored(blobs.select("blob", F.concat(*[_hits(text, k, r) for k, r in enumerate(rules)]).alias("hits")), "scan")
    least = F.element_at(F.array(*[F.lit(r.least) for r in rules]), F.col("h.kind_no") + 1)
    in_order = W.partitionBy("blob", "kind_no").orderBy("pos")
    hits = raw.select("blob", F.posexplode("hits").alias("pos", "h")).select(
        "blob", "pos", F.col("h.kind_no").alias("kind_no"), F.col("h.gap").alias("gap"), F.col("h.len").alias("len"), (F.col("h.val") >= least).alias("ok")
    )
    end = F.sum(F.col("gap") + F.col("len")).over(in_order.rowsBetween(W.unboundedPreceding, 0)).cast("int")
    hits = hits.withColumn("end", end).withColumn("start", F.col("end") - F.col("len")).where("ok")
    before = W.partitionBy("blob").orderBy("start", "kind_no").rowsBetween(W.unboundedPreceding, -1)
    hits = hits.withColumn("prev_end", F.coalesce(F.max("end").over(before), F.lit(0)))
    spans = hits.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "kind_no", "end", "prev_end"))).alias("spans"))
    none = F.array().cast("array<struct<start:int,kind_no:int,end:int,prev_end:int>>")
    return raw.select("blob").join(spans, "blob", "left").select("blob", F.coalesce("spans", none).alias("spans"))


def scan_versions(versions: DataFrame, id_col: str = "doc_id", text_col: str = "text", ledger: str | None = None, rules=RULES) -> DataFrame:
    """(doc_id, blob, spans) for every version; ``ledger`` names a Parquet folder kept between runs, None one of this call.

    Only blobs without a row for this rule version are scanned, their rows are appended to the ledger, and the findings are
    read back from it. Two runs at once, or one again after a failed commit, may append a blob twice; it counts once.
    """
    spark, version = versions.sparkSession, rule_version(rules)
    ledger = ledger or f"{checkpoint_dir(spark)}/ledger-{uuid.uuid4().hex}"
    recorded = lambda: spark.read.schema(LEDGER).parquet(ledger).where(F.col("rule_version") == version).select("blob", "spans")
    paths = id_text(versions, id_col, text_col).select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    unseen = paths.groupBy("blob").agg(F.first("text").alias("text"))
    spark.createDataFrame([], LEDGER).write.mode("append").partitionBy("rule_version").parquet(ledger)  # the folder exists from now on
    unseen = unseen.join(recorded().select("blob"), "blob", "left_anti")
    scan_blobs(unseen, rules).withColumn("rule_version", F.lit(version)).write.mode("append").partitionBy("rule_version").parquet(ledger)
    found = recorded().where(F.size("spans") > 0).dropDuplicates(["blob"])
    none = F.array().cast("array<struct<start:int,kind_no:int,end:int,prev_end:int>>")
    return paths.select("doc_id", "blob").join(found, "blob", "left").select("doc_id", "blob", F.coalesce("spans", none).alias("spans"))


def span_text(spans, rules=RULES):
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat(F.element_at(kinds, s["kind_no"] + 1), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]", ledger: str | None = None) -> DataFrame:
    """(blob, redacted) for the blobs with findings: every span, overlapping ones once, replaced by ``mark``."""
    found = scan_versions(docs, id_col, text_col, ledger).where(F.size("spans") > 0).select("blob", "spans").dropDuplicates(["blob"])
    texts = id_text(docs, id_col, text_col).select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob"), "text")
    texts = texts.join(found.select("blob"), "blob", "left_semi").groupBy("blob").agg(F.first("text").alias("text"))
    text = F.col("text")
    keep = lambda s: F.concat(text.substr(s["prev_end"] + 1, F.greatest(F.lit(0), s["start"] - s["prev_end"])), F.when(s["start"] >= s["prev_end"], F.lit(mark)).otherwise(F.lit("")))
    last = F.array_max(F.transform("spans", lambda s: s["end"]))
    return texts.join(found, "blob").select("blob", F.concat(F.array_join(F.transform("spans", keep), ""), text.substr(last + 1, F.length(text))).alias("redacted"))


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]", ledger: str | None = None) -> DataFrame:
    """The rows of ``docs`` with their columns, all findings replaced by ``mark``. Only rows some rule matches are joined."""
    text = F.col(f"`{text_col}`").cast("string")
    suspect = F.lit(False)
    for rule in RULES:
        suspect = suspect | text.rlike(rule.pattern)
    suspect = F.coalesce(suspect, F.lit(False))
    own, changed = fresh("own_blob", docs), fresh("new_text", docs)
    new = redact(docs, id_col, text_col, mark, ledger).select(F.col("blob").alias(own), F.col("redacted").alias(changed))
    rows = docs.where(suspect).withColumn(own, F.sha2(text, 256)).join(new, own, "left")
    rows = rows.withColumn(text_col, F.coalesce(changed, text)).select(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.where(~suspect).withColumn(text_col, text).unionByName(rows)


def op9_secrets(spark, sf_dir: str) -> DataFrame:
    found = scan_versions(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind_no"] < len(BASE_RULES))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind_no"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE_RULES)],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def _oracle() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    one = [
        f"SELECT doc_id, {k} AS kind_no, {quoted(r.kind)} AS kind, {r.least} AS least, string_split_regex(t, {quoted(r.pattern)}) AS gaps, "
        f"regexp_extract_all(t, {quoted(r.pattern)}, 0) AS found, regexp_extract_all(t, {quoted(r.pattern)}, {r.group}) AS vals FROM docs"
        for k, r in enumerate(RULES)
    ]
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({' UNION ALL '.join(one)}),
e AS (SELECT doc_id, kind_no, kind, least, unnest(generate_series(1, len(found))) AS i, gaps, found, vals FROM m WHERE len(found) > 0),
p AS (SELECT doc_id, kind_no, kind, least, i, length(gaps[i]) + length(found[i]) AS step, length(found[i]) AS n, length(vals[i]) AS v FROM e),
s AS (SELECT *, sum(step) OVER (PARTITION BY doc_id, kind_no ORDER BY i) AS stop FROM p),
k AS (SELECT doc_id, kind_no, stop - n AS start, kind || ':' || (stop - n)::BIGINT || ':' || stop::BIGINT AS span FROM s WHERE v >= least),
g AS (SELECT doc_id,
    sum((kind_no = 0)::INT)::BIGINT AS n_assign, sum((kind_no = 1)::INT)::BIGINT AS n_access, sum((kind_no = 2)::INT)::BIGINT AS n_hex,
    coalesce(string_agg(span, ',' ORDER BY start, kind_no) FILTER (kind_no < {len(BASE_RULES)}), '') AS base,
    string_agg(span, ',' ORDER BY start, kind_no) AS spans FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN g USING (doc_id)"""


ORACLE = _oracle()
