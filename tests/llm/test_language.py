import numpy as np
import pytest

from meterloom.llm import common, language
from tests.conftest import SF


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    docs = common.table(spark, sf, "documents")
    rows = language.op10_language(spark, sf).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert len(rows) == docs.count() and rows.score.between(0, 1).all()
    held = rows[rows.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.95


@pytest.fixture(scope="module")
def network():
    rng = np.random.default_rng(1)
    make = lambda letters: " ".join("".join(rng.choice(list(letters), 5)) for _ in range(200))
    texts = [make("abcdef") for _ in range(30)] + [make("uvwxyz") for _ in range(30)]
    x = np.concatenate([language.windows(t) for t in texts])
    y = np.repeat([0, 1], len(x) // 2)
    return language.train(x, y, ("one", "two"))


def test_tables_give_the_network_s_responses(network):
    x = language.windows("abc uvw " * 70)
    pooled = [np.maximum(sum(f[k][x[:, k : k + language.WINDOW - w + 1]] for k in range(w)).max(axis=1) + b, 0) for f, b, w in zip(network.filters, network.bias, language.WIDTHS)]
    want = language.softmax(np.concatenate(pooled, axis=1) @ network.weights + network.offset)
    assert np.allclose(language.Applied(network).probabilities(x), want, atol=1e-5)


def test_edge_rows(spark, network, edge_docs, no_docs):
    rows = spark.createDataFrame([(1, "abc fed"), (2, "zyx vuw " * 50_000), (3, None), (4, ""), (5, "12 34!"), (6, " "), (1, "abc fed")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["lang_pred"]) for r in language.predict(rows, network).collect())
    assert got == [(1, "one"), (1, "one"), (2, "two"), (3, "und"), (4, "und"), (5, "und"), (6, "und")]
    assert language.predict(edge_docs, network).count() == edge_docs.count()
    assert language.predict(no_docs, network).count() == 0
    assert {r["lang_pred"] for r in language.predict(rows, None).collect()} == {"und"}
    assert language.fit(no_docs, lambda i: i.isNotNull()) is None
