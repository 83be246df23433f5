import hashlib
import random

import pytest

from meterloom.llm import substrings


def brute(rows, span=13):
    """Per row: (doc_id, n_words, n_removed, digest of the kept words)."""
    first = {}
    words = [(t or "").encode().split() for _, t in rows]
    for (doc, _), w in zip(rows, words):
        for i in range(len(w) - span + 1) if doc is not None else ():
            key = tuple(w[i : i + span])
            first[key] = min(doc, first.get(key, doc))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - span + 1) if doc is not None else ():
            if first[tuple(w[i : i + span])] < doc:
                gone.update(range(i, i + span))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(spark, df):
    found = substrings.stored(substrings.repeated(df), "test")
    kept = {(r["doc_id"], r["node"]): (r["n_removed"], r["kept"]) for r in substrings.kept(df, found).collect()}
    out = []
    for r in found.collect():
        n, text = kept.get((r["doc_id"], r["node"]), (0, None))
        if r["copied"] and len(r["spans"]):
            n, text = r["n_words"], ""
        out.append((r["doc_id"], r["n_words"], n, r["node"] if text is None else hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def shared():
    """Passages that cross factor and block borders, repeat inside a text, overlap, and hold few different words."""
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(4000)]
    long = rng.choices(vocabulary, k=1500)
    passages = [rng.choices(vocabulary, k=k) for k in (12, 13, 14, 20, 60, 300)]
    few = rng.choices(["a", "b"], k=60)
    texts = [long, passages[4] + passages[5], few]
    for _ in range(60):
        own = []
        for _ in range(rng.randint(1, 5)):
            own += rng.choices(vocabulary, k=rng.randint(0, 30))
            kind = rng.random()
            if kind < 0.3:
                at = rng.randrange(1400)
                own += long[at : at + rng.randint(5, 100)]
            elif kind < 0.7:
                own += rng.choice(passages)
            elif kind < 0.8:
                own += rng.choices(["a", "b"], k=30)
        texts.append(own)
    half = passages[4][:30]
    texts += [half + passages[3], passages[4][20:] + passages[3], half + passages[4][30:], list(long), list(long[:700]) + ["x"] + long[700:]]
    rng.shuffle(texts)
    return [(i * 3 + 1, " ".join(t)) for i, t in enumerate(texts)]


def test_as_brute_force(spark, shared):
    df = spark.createDataFrame(shared, "doc_id long, text string").repartition(5)
    assert result(spark, df) == brute(shared)


def test_often_met_seeds_take_another_way(spark, shared, monkeypatch):
    monkeypatch.setattr(substrings, "SHORT", -(10**6))
    monkeypatch.setattr(substrings, "COMMON", 3)
    monkeypatch.setattr(substrings, "BLOCK", 40)
    monkeypatch.setattr(substrings, "MARGIN", 20)
    assert result(spark, spark.createDataFrame(shared, "doc_id long, text string")) == brute(shared)


def test_edge_rows(spark, edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert result(spark, edge_docs) == brute(rows)
    assert substrings.repeated(no_docs).count() == 0
    left = substrings.without_repeats(edge_docs)
    assert left.columns == edge_docs.columns
    assert sorted((r["doc_id"] or 0) for r in left.collect()) == [0, 1, 2, 3, 4, 5, 7, 8]
    assert substrings.without_repeats(no_docs).count() == 0


def test_hashes_of_words_as_split_cuts_them():
    rng = random.Random(3)
    texts = [b"", b" \t", b"a", b"ab" * 40 + b" " + b"ab" * 40, b"\x00 \x00\x00 a\x00 a", "é é \x0b\x0c\r\nx".encode()]
    texts += [b"".join(rng.choices([b"a", b"b", b" ", b"\n", b"abcdefgh", b"x" * 63], k=rng.randint(0, 40))) for _ in range(300)]
    h, sizes = substrings.hashes(texts)
    assert sizes.tolist() == [len(t.split()) for t in texts]
    words = [w for t in texts for w in t.split()]
    assert len(h) == len(words) and len(set(h.tolist())) == len(set(words)) == len(set(zip(words, h.tolist())))
    assert [substrings.hashes([w])[0][0] for w in words[:200]] == h[:200].tolist()


def test_texts_are_not_stored(spark, shared, monkeypatch):
    columns = set()
    stored = substrings.stored
    monkeypatch.setattr(substrings, "stored", lambda df, what: columns.update(df.columns) or stored(df, what))
    substrings.repeated(spark.createDataFrame(shared, "doc_id long, text string")).count()
    assert "seed" in columns and "text" not in columns
