"""Language identification by a convolutional network over bytes, trained here in numpy.

Bytes are folded to classes (capitals to small letters, digits to one class, white space and controls to one class) and
cut in windows of WINDOW classes. Filters of widths 2, 3 and 4 slide over a window; each filter's largest response,
rectified, feeds a softmax over the languages. A text's probabilities are the mean over all its windows.

As a filter's response is a sum of one weight per covered byte, the applied network reads the responses of byte pairs from
tables, which gives the same sums.

The network is fitted on all windows of a bounded sample of labelled texts, about SAMPLE per language whatever the size of
the input, in about STEPS steps and at least one pass. Everything else covers all texts, whole.

Defined results: a null text or one without a letter is ``und`` with score 0, and so is every text when nothing could be
learned; rows with a null identifier are never learned from and count as not held out; repeated rows each get their
result; only the named columns are read.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import table, utf8

WINDOW, WIDTHS, FILTERS = 256, (2, 3, 4), 16
SAMPLE, STEPS, BATCH, RATE, SEED = 600, 900, 64, 0.01, 7
UNKNOWN = "und"


def _fold() -> tuple[bytes, int]:
    """Class of every byte, and the number of classes; class 0 is white space and what pads a window."""
    classes = [0] * 256
    for b in range(33, 256):
        c = chr(b).lower() if b < 128 else chr(b)
        classes[b] = 1 if c.isdigit() and b < 128 else ord(c)
    used = {c: i for i, c in enumerate(sorted(set(classes)))}
    return bytes(used[c] for c in classes), len(used)


FOLD, CLASSES = _fold()


class Network(NamedTuple):
    languages: tuple[str, ...]
    filters: tuple[np.ndarray, ...]  # per width: (width, CLASSES, FILTERS)
    bias: tuple[np.ndarray, ...]
    weights: np.ndarray
    offset: np.ndarray


def windows(text) -> np.ndarray:
    """(number, WINDOW) classes; the last window is filled with class 0. Empty texts have none."""
    x = np.frombuffer(utf8(text).translate(FOLD), np.uint8)
    if not len(x):
        return np.zeros((0, WINDOW), np.uint8)
    return np.pad(x, (0, -len(x) % WINDOW)).reshape(-1, WINDOW)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, languages, steps: int = STEPS, seed: int = SEED) -> Network:
    """Adam on the cross entropy. Only the position of the largest response passes a gradient back."""
    rng = np.random.default_rng(seed)
    kinds = len(languages)
    p = [rng.normal(0, 0.1, (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS]
    b = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    out = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), kinds)).astype(np.float32)
    off = np.zeros(kinds, np.float32)
    params = [*p, *b, out, off]
    moment, square, step = [np.zeros_like(a) for a in params], [np.zeros_like(a) for a in params], 0
    weight = (len(y) / kinds / np.maximum(1, np.bincount(y, minlength=kinds))).astype(np.float32)
    cells = np.arange(FILTERS)
    for _ in range(max(1, round(steps * BATCH / len(y)))):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            pick = order[at : at + BATCH]
            xs, ys = x[pick], y[pick]
            pooled, where = [], []
            for f, bias, w in zip(p, b, WIDTHS):
                n = WINDOW - w + 1
                r = sum(f[k][xs[:, k : k + n]] for k in range(w))
                best = r.argmax(axis=1)
                where.append(best)
                pooled.append(np.take_along_axis(r, best[:, None, :], axis=1)[:, 0] + bias)
            h = np.concatenate(pooled, axis=1)
            active = np.maximum(h, 0)
            g = softmax(active @ out + off)
            g[np.arange(len(ys)), ys] -= 1
            g *= weight[ys][:, None] / len(ys)
            back = (g @ out.T) * (h > 0)
            grads = []
            for i, (f, w) in enumerate(zip(p, WIDTHS)):
                gf, part = np.zeros_like(f), back[:, i * FILTERS : (i + 1) * FILTERS]
                for k in range(w):
                    np.add.at(gf[k], (np.take_along_axis(xs, where[i] + k, axis=1), cells[None, :]), part)
                grads.append(gf)
            grads += [back[:, i * FILTERS : (i + 1) * FILTERS].sum(axis=0) for i in range(len(WIDTHS))]
            grads += [active.T @ g, g.sum(axis=0)]
            step += 1
            for a, m, s, d in zip(params, moment, square, grads):
                m += 0.1 * (d - m)
                s += 0.001 * (d * d - s)
                a -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Network(tuple(languages), tuple(p), tuple(b), out, off)


class Applied:
    """A network as tables of byte-pair responses."""

    def __init__(self, net: Network):
        pair = lambda first, second: (first[:, None, :] + second[None, :, :]).reshape(-1, FILTERS)
        two, three, four = net.filters
        self.net = net
        self.two, self.three, self.last = pair(two[0], two[1]), pair(three[0], three[1]), three[2]
        self.four, self.four_end = pair(four[0], four[1]), pair(four[2], four[3])

    def probabilities(self, x: np.ndarray, chunk: int = 128) -> np.ndarray:
        """(windows, languages) in slices small enough for the processor's cache."""
        out = np.zeros((len(x), len(self.net.languages)), np.float32)
        for at in range(0, len(x), chunk):
            c = x[at : at + chunk].astype(np.intp)
            p = c[:, :-1] * CLASSES + c[:, 1:]
            pooled = [
                self.two.take(p, axis=0).max(axis=1),
                (self.three.take(p[:, :-1], axis=0) + self.last.take(c[:, 2:], axis=0)).max(axis=1),
                (self.four.take(p[:, :-2], axis=0) + self.four_end.take(p[:, 2:], axis=0)).max(axis=1),
            ]
            h = np.concatenate([r + b for r, b in zip(pooled, self.net.bias)], axis=1)
            out[at : at + chunk] = softmax(np.maximum(h, 0) @ self.net.weights + self.net.offset)
        return out

    def __call__(self, texts) -> tuple[list[str], np.ndarray]:
        rows = [windows(t) for t in texts]
        counts = np.array([len(r) for r in rows])
        names, score = [UNKNOWN] * len(rows), np.zeros(len(rows))
        if counts.sum():
            prob = self.probabilities(np.concatenate(rows))
            some = np.flatnonzero(counts)
            starts = np.cumsum(counts)[some] - counts[some]
            mean = np.add.reduceat(prob.astype(np.float64), starts, axis=0) / counts[some][:, None]
            best = mean.argmax(axis=1)
            score[some] = np.minimum(1.0, mean[np.arange(len(some)), best])
            for i, k in zip(some, best):
                names[i] = self.net.languages[k]
        return names, score


def held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", sample: int = SAMPLE) -> Network | None:
    """Network from a sample of the rows for which ``learn`` holds, about ``sample`` of each label, drawn by identifier."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{label_col}`").cast("string").alias("lang"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & learn(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 20))
    within = F.element_at(F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(int((1 << 20) * min(1.0, sample / n)) + 1))]), F.col("lang"))
    number = {k: i for i, k in enumerate(languages)}

    def cut(frames):
        for pdf in frames:
            out = []
            for text, lang in zip(pdf["text"], pdf["lang"]):
                x = windows(text)
                if text and any(map(str.isalpha, text)):
                    out += [(number[lang], codes.tobytes()) for codes in x]
            yield pd.DataFrame(out, columns=["label", "codes"])

    drawn = rows.where(draw < within).mapInPandas(cut, "label int, codes binary").toPandas()
    if not len(drawn):
        return None
    drawn = drawn.sort_values(["label", "codes"], kind="stable")  # the fit does not depend on the order of arrival
    x = np.frombuffer(b"".join(drawn["codes"]), np.uint8).reshape(-1, WINDOW)
    return train(x, drawn["label"].to_numpy(), languages)


@lru_cache(2)
def _applied(blob: bytes) -> Applied:
    import pickle

    return Applied(pickle.loads(blob))


def predict(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row."""
    import pickle

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    if net is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    blob = pickle.dumps(net)

    @F.pandas_udf("lang string, score double")
    def run(text: pd.Series) -> pd.DataFrame:
        applied, names, scores = _applied(blob), [], []
        for at in range(0, len(text), 200):
            n, s = applied(text.iloc[at : at + 200])
            names += n
            scores.append(s)
        return pd.DataFrame({"lang": pd.Series(names, dtype=object), "score": np.concatenate(scores) if scores else np.zeros(0)})

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    got = rows.select("doc_id", letter.alias("letter"), run("text").alias("p"))
    return got.select("doc_id", F.when(F.col("letter"), F.col("p.lang")).otherwise(F.lit(UNKNOWN)).alias("lang_pred"), F.when(F.col("letter"), F.col("p.score")).otherwise(F.lit(0.0)).alias("score"))


def op10_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = fit(docs, lambda doc_id: ~held_out(doc_id))
    return predict(docs, net).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
