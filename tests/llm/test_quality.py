import itertools
import random
import re
from collections import Counter

import numpy as np

from meterloom.llm import common, quality
from tests.conftest import SF


def base(text):
    if text is None:
        return 0, 0, 0, 0, 0, True
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), len(words) < 20 or 100 * len(covered) > 30 * len(words)


def test_base_rules_as_brute_force():
    rng = random.Random(3)
    for _ in range(500):
        text = "".join(rng.choices(["a", "b ", " ", "\n", "#", "x y z a b c d e f ", "é", " ", "\t", "<"], k=rng.randint(0, 60)))
        assert quality.base_rules(text) == base(text)


def test_viterbi_finds_the_best_labels():
    rng = np.random.default_rng(5)
    for _ in range(30):
        field = quality.Field(rng.normal(size=quality.FEATURES), rng.normal(size=2), rng.normal(size=(2, 2)))
        x = rng.normal(size=(6, quality.FEATURES))

        def score(labels):
            return field.start[labels[0]] + sum(x[i] @ field.weights * y for i, y in enumerate(labels)) + sum(field.pairs[a, b] for a, b in itertools.pairwise(labels))

        best = max(itertools.product((0, 1), repeat=6), key=score)
        assert tuple(quality.viterbi(field, x).astype(int)) == best


def test_fitted_field_tells_junk_from_prose(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    field = quality.fit(docs, labels)
    judged = quality.judge(docs, field).select("doc_id", "r.*").toPandas().merge(labels.toPandas(), on="doc_id")
    judged = judged[~judged.base_failed]
    assert judged[judged.quality == 1].kept.mean() > 0.97
    if (judged.quality == 0).any():
        assert judged[judged.quality == 0].kept.mean() < 0.2


def test_edge_rows(spark, edge_docs, no_docs):
    labels = common.table(spark, SF, "labels")
    assert quality.fit(edge_docs, labels.where("false")) is None
    rows = quality.judge(edge_docs, None).select("doc_id", "r.*").collect()
    got = sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"], r["kept"]) for r in rows)
    assert got == sorted((str(r["doc_id"]), *base(r["text"]), not base(r["text"])[-1]) for r in edge_docs.collect())
    assert quality.retained(edge_docs, None).columns == edge_docs.columns
    assert quality.judge(no_docs, None).count() == 0


def test_fit_learns_from_all_lines(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit_field", lambda chains, labels: seen.append((chains, labels)))
    text = "\n".join(f"line number {i} of the text" for i in range(200))
    docs = spark.createDataFrame([(1, text), (2, "a b c"), (3, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    quality.fit(docs, labels)
    (chains, got), = seen
    assert sum(len(c) for c, y in zip(chains, got) if y == 1) == len(quality.line_features(text)[0]) == 200


def test_retained_rows_are_those_kept(spark, edge_docs):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    field = quality.fit(docs, labels)
    for given, by in ((docs, field), (docs, None), (edge_docs, field)):
        kept = quality.judge(given, by).where("r.kept").select("doc_id").collect()
        assert sorted(map(str, kept)) == sorted(map(str, quality.retained(given, by).select("doc_id").collect()))


def test_labels_of_lines_on_request(spark, edge_docs):
    rows = quality.judge(edge_docs, None, lines=True).select("r.content", "r.n_words").collect()
    assert all(r["content"] == [True] * len(r["content"]) for r in rows) and "content" not in quality.judge(edge_docs, None).select("r.*").columns
