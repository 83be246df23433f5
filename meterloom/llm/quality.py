"""Quality rules: a linear-chain conditional random field labels lines, their share of content decides.

Each line has a few features (length, symbols, capitals, digits, repetition, ending). The field has two labels, content
and boilerplate; Viterbi decoding gives a text's most likely labels, and a text is kept when at least SHARE of its words
stand on content lines and no base rule fails: fewer than 20 words, or over 30 % of its words in 8-word windows that the
text repeats.

The field is fitted, by gradient ascent on the conditional likelihood, on a bounded sample of labelled texts: about SAMPLE
of each quality, all their lines, in chains of LINES lines at most; a text's quality stands for the labels of its lines. All else covers
every text, whole.

Defined results: a null text has no words and no lines, fails the base rule and is not kept; without labels every line is
content; repeated rows each get their result; only the named columns are read.
"""

from __future__ import annotations

import pickle
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import id_text, table, utf8

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
SHARE, LEAST_WORDS, REPEATED_PERCENT, REACH = 0.5, 20, 30, 8
SAMPLE, LINES, STEPS, RATE, PENALTY, SEED = 700, 64, 150, 0.1, 1e-3, 11
FEATURES = 11


class Field(NamedTuple):
    """Scores of the label content (1) over boilerplate (0): by feature, at the start, and by pair of labels."""

    weights: np.ndarray
    start: np.ndarray
    pairs: np.ndarray


def line_features(text) -> tuple[np.ndarray, np.ndarray]:
    """(lines, FEATURES) and the words of each line; a line equal to an earlier one with a word is marked."""
    lines = (text or "").split("\n") if text else []
    out, sizes, seen = np.zeros((len(lines), FEATURES)), np.zeros(len(lines)), set()
    for i, line in enumerate(lines):
        words = line.split()
        n = len(words)
        sizes[i] = n
        if not n:
            out[i, 0] = out[i, 10] = 1
            continue
        out[i] = (
            1,
            min(1.0, n / 20),
            sum(map(line.count, SYMBOLS)) / len(line),
            sum([not w[-1].isalnum() for w in words]) / n,
            sum([not w[0].isalnum() for w in words]) / n,
            sum(map(str.isupper, words)) / n,
            sum(map(str.isdigit, words)) / n,
            sum(map(str.__eq__, words, words[1:])) / n,
            line in seen,
            words[-1][-1] in ".!?:;\"'”»…",
            n <= 2,
        )
        seen.add(line)
    return out, sizes


def viterbi(field: Field, features: np.ndarray) -> np.ndarray:
    """Most likely labels of a chain; of equal ones, those that end in content."""
    n = len(features)
    if not n:
        return np.zeros(0, bool)
    emit = (features @ field.weights).tolist()
    (aa, ab), (ba, bb) = field.pairs.tolist()
    a, b = field.start[0], field.start[1] + emit[0]
    back = [(0, 1)]
    for e in emit[1:]:
        to_a, to_b = int(b + ba >= a + aa), int(b + bb >= a + ab)
        a, b = max(a + aa, b + ba), max(a + ab, b + bb) + e
        back.append((to_a, to_b))
    label = int(b >= a)
    out = [label]
    for step in back[:0:-1]:
        label = step[label]
        out.append(label)
    return np.array(out[::-1], bool)


def fit_field(chains: list[np.ndarray], labels: list[int], steps: int = STEPS) -> Field:
    """Adam on the mean conditional log likelihood of chains whose lines all carry their text's label."""
    longest = max(map(len, chains))
    x = np.zeros((len(chains), longest, FEATURES))
    on = np.zeros((len(chains), longest))
    for i, c in enumerate(chains):
        x[i, : len(c)], on[i, : len(c)] = c, 1
    y = np.array(labels, float)
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    flat = np.zeros(FEATURES + 6)
    moment, square = np.zeros_like(flat), np.zeros_like(flat)
    logsum = lambda z, axis: (m := z.max(axis=axis)) + np.log(np.exp(z - np.expand_dims(m, axis)).sum(axis=axis))
    for step in range(1, steps + 1):
        w, start, pairs = flat[:FEATURES], flat[FEATURES : FEATURES + 2], flat[FEATURES + 2 :].reshape(2, 2)
        emit = np.stack([np.zeros(on.shape), x @ w], axis=2)
        ahead = np.zeros_like(emit)
        ahead[:, 0] = start + emit[:, 0]
        for t in range(1, longest):
            new = logsum(ahead[:, t - 1, :, None] + pairs, 1) + emit[:, t]
            ahead[:, t] = np.where(on[:, t, None] > 0, new, ahead[:, t - 1])
        total = logsum(ahead[:, -1], 1)
        behind = np.zeros_like(emit)
        grad_pairs = np.zeros((2, 2))
        for t in range(longest - 2, -1, -1):
            live = on[:, t + 1]
            right = pairs + (emit[:, t + 1] + behind[:, t + 1])[:, None, :]
            expected = np.exp(ahead[:, t, :, None] + right - total[:, None, None])
            grad_pairs -= (expected * (live * weight)[:, None, None]).sum(axis=0)
            behind[:, t] = np.where(live[:, None] > 0, logsum(right, 2), 0)
        for k in (0, 1):
            grad_pairs[k, k] += (on[:, 1:].sum(axis=1) * (y == k) * weight).sum()
        marginal = np.exp(ahead + behind - total[:, None, None])
        grad_w = ((y[:, None] - marginal[:, :, 1]) * on * weight[:, None])[:, :, None] * x
        grad_start = np.array([((y == k) * weight).sum() - (marginal[:, 0, k] * weight).sum() for k in (0, 1)])
        grad = np.concatenate([grad_w.sum(axis=(0, 1)), grad_start, grad_pairs.ravel()]) - PENALTY * flat
        moment += 0.1 * (grad - moment)
        square += 0.01 * (grad * grad - square)
        flat = flat + RATE * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Field(flat[:FEATURES], flat[FEATURES : FEATURES + 2], flat[FEATURES + 2 :].reshape(2, 2))


def blocks(x: np.ndarray) -> list[np.ndarray]:
    """All lines of a text, cut into chains of LINES lines at most."""
    return [x[i : i + LINES] for i in range(0, len(x), LINES)]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Field | None:
    """Field from about ``sample`` texts of each quality, drawn by identifier."""
    known = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("quality")).where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return None
    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 20))
    share = lambda k: int((1 << 20) * min(1.0, sample / n[k])) + 1
    drawn = known.where(draw < F.when(F.col("quality") == 1, share(1)).otherwise(share(0)))

    def features(frames):
        for pdf in frames:
            rows = [(q, part.tobytes()) for q, t in zip(pdf["quality"], pdf["text"]) for part in blocks(line_features(t)[0])]
            yield pd.DataFrame({"quality": pd.Series([r[0] for r in rows], dtype="int32"), "x": pd.Series([r[1] for r in rows], dtype=object)})

    texts = id_text(docs, id_col, text_col).join(F.broadcast(drawn), "doc_id").select("quality", "text")  # 2 * sample identifiers, about
    got = texts.mapInPandas(features, "quality int, x binary").toPandas()
    got = got[got["x"].map(len) > 0].sort_values(["quality", "x"], kind="stable")  # the fit does not depend on the order of arrival
    if got["quality"].nunique() < 2:
        return None
    return fit_field([np.frombuffer(b).reshape(-1, FEATURES) for b in got["x"]], got["quality"].tolist())


def repeated_words(words: list[bytes], reach: int = REACH) -> int:
    """Words covered by windows of ``reach`` words that occur twice or more in the text."""
    n = len(words) - reach + 1
    if n < 2:
        return 0
    x = np.array(list(map(hash, words)), np.int64).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(reach):
        key = key * np.uint64(0x9E3779B97F4A7C15) + (x[j : n + j] ^ (x[j : n + j] >> np.uint64(29)))
    order = np.sort(key)
    if not (order[1:] == order[:-1]).any():
        return 0
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    edge = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(count[place] > 1)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + reach, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_rules(text) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    if text is None:
        return 0, 0, 0, 0, 0, True
    words = utf8(text).split()
    n, seen, again = len(words), set(), 0
    for line in text.split("\n"):
        if line in seen:
            again += 1
        elif line and line.strip(SPACES):
            seen.add(line)
    repeated = repeated_words(words)
    return n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), again, repeated, n < LEAST_WORDS or 100 * repeated > REPEATED_PERCENT * n


@lru_cache(2)
def _field(blob: bytes) -> Field:
    return pickle.loads(blob)


RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean"
LINES_TOO = RESULT + ", content array<boolean>"


def verdict(field: Field | None, lines: bool = False):
    """Column function from a text: the base rules' figures, the share of content, the verdict; with ``lines`` also the
    label of every line."""
    blob, result = pickle.dumps(field), LINES_TOO if lines else RESULT

    @F.pandas_udf(result)
    def run(text: pd.Series) -> pd.DataFrame:
        own, rows = _field(blob), []
        for t in text:
            base = base_rules(t)
            x, sizes = line_features(t)
            content = np.ones(len(x), bool) if own is None else viterbi(own, x)
            total = sizes.sum()
            share = float(sizes[content].sum() / total) if total else 0.0
            rows.append((*base, share, not base[-1] and share >= SHARE, *([content.tolist()] if lines else [])))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in result.split(", ")])

    return run


def judge(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text", lines: bool = False) -> DataFrame:
    """(doc_id, r) for every row, ``r`` by ``verdict``."""
    return id_text(docs, id_col, text_col).select("doc_id", verdict(field, lines)("text").alias("r"))


def retained(docs: DataFrame, field: Field | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    blob = pickle.dumps(field)

    @F.pandas_udf("boolean")
    def keep(text: pd.Series) -> pd.Series:
        own, out = _field(blob), []
        for t in text:
            kept = not base_rules(t)[-1]
            if kept and own is not None:
                x, sizes = line_features(t)
                kept = bool(sizes[viterbi(own, x)].sum() / sizes.sum() >= SHARE)
            out.append(kept)
        return pd.Series(out, dtype=bool)

    return docs.where(keep(F.col(f"`{text_col}`").cast("string")))


def op7_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = judge(docs, fit(docs, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", *[f"r.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share")])
