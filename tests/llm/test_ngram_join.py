import random
import re

import pytest

from meterloom.llm import graphs, ngram_join


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) or frozenset([tuple(words)])


def brute(rows, size=3, num=90, den=100):
    """Per row: (doc_id, set size, smallest doc_id reachable)."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(group) if sets[i] and group else doc))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def copies():
    """A large star of near copies, a chain of drifting copies, pairs, short texts, common passages."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=30)
    texts = []
    base = rng.choices(vocabulary, k=120)
    texts += [" ".join(base)] + [" ".join(edited(rng, base, 3)) for _ in range(40)] + [" ".join(base)] * 3
    link = rng.choices(vocabulary, k=150)
    for _ in range(15):
        texts.append(" ".join(link))
        link = edited(rng, link, 2)
    for _ in range(25):
        own = rng.choices(vocabulary, k=rng.randint(1, 60))
        texts += [" ".join(own), " ".join(edited(rng, own, rng.randint(0, 2))), " ".join(own + passage)]
    texts += ["a b", "A  b", "a", "a b c", "a b c d", "", "x y z " * 50]
    rng.shuffle(texts)
    return [(i + 1, t) for i, t in enumerate(texts)]


def test_components_as_brute_force(spark, copies):
    df = spark.createDataFrame(copies, "doc_id long, text string").repartition(7)
    assert result(ngram_join.link(df)) == brute(copies)
    assert result(ngram_join.link(df, 5, 80, 100)) == brute(copies, 5, 80, 100)


def test_same_result_without_stars(spark, copies, monkeypatch):
    monkeypatch.setattr(ngram_join, "LONG_LIST", 10**6)
    monkeypatch.setattr(ngram_join, "SHORT", -(10**6))  # every list takes the way of the often met ones
    assert result(ngram_join.link(spark.createDataFrame(copies, "doc_id long, text string"))) == brute(copies)


def test_edge_rows(spark, edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert result(ngram_join.link(edge_docs)) == brute(rows)
    assert ngram_join.link(no_docs).count() == 0
    kept = ngram_join.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 8]
    assert ngram_join.one_of_each(no_docs).count() == 0


def test_components_of_long_chains_and_hubs(spark):
    rng = random.Random(4)
    names = list(range(300))
    rng.shuffle(names)
    links = [(names[i], names[i + 1]) for i in range(99)] + [(names[100], names[i]) for i in range(101, 200)] + [(names[200], names[200])]
    got = {r["node"]: r["root"] for r in graphs.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: min(g) for g in (names[:100], names[100:200]) for n in g}
    assert graphs.components(spark.createDataFrame([], "a long, b long")).count() == 0


def all_links(rows, size=3, num=90, den=100):
    """Pairs of linked rows, by position."""
    sets = [shingles(t, size) for _, t in rows]
    return {(j, i) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a and b and den * len(a & b) >= num * len(a | b)}


def test_every_link_is_returned(spark, copies):
    df = spark.createDataFrame(copies, "doc_id long, text string").repartition(7)
    want = {(copies[j][0], copies[i][0]) for j, i in all_links(copies)}
    members, pairs = ngram_join.links(df)
    node = {r["doc_id"]: r["node"] for r in members.collect()}
    linked = {(r["a"], r["b"]) for r in pairs.collect()}
    assert pairs.count() == len(linked) and all(a > b for a, b in linked)
    ids = sorted(d for d in node if node[d] is not None)
    got = {(c, d) for d in ids for c in ids if c < d and (node[c] == node[d] or (max(node[c], node[d]), min(node[c], node[d])) in linked)}
    assert got == want
    counts = {r["doc_id"]: r["n_links"] for r in ngram_join.link_counts(members, pairs).collect()}
    assert counts == {d: sum(d in pair for pair in want) for d, _ in copies}


def test_links_of_edge_rows(spark, edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    linked = all_links(rows)
    want = sorted(((d, len(shingles(t, 3)), sum(i in pair for pair in linked)) for i, (d, t) in enumerate(rows)), key=str)
    assert result(ngram_join.link_counts(*ngram_join.links(edge_docs))) == want
    assert ngram_join.link_counts(*ngram_join.links(no_docs)).count() == 0


def test_marks_differ_in_no_more_bits_than_sets_in_tokens():
    rng = random.Random(3)
    base = rng.choices([f"w{i}" for i in range(500)], k=300)
    for edits in range(1, 60, 3):
        a, b = (ngram_join.tokens(" ".join(words), 3) for words in (base, edited(rng, base, edits)))
        bits = sum((int(x) ^ int(y)).bit_count() for x, y in zip(*(ngram_join.mark_of(t).view("u8") for t in (a, b))))
        unshared = len(set(a.tolist()) ^ set(b.tolist()))
        assert bits <= unshared and bits % 2 == unshared % 2 and bits > 0.6 * min(unshared, 200)


def test_members_of_a_large_group_that_are_not_linked_are_no_pairs(spark, monkeypatch):
    """All share most of their tokens, hence their prefixes, but two words of each are its own."""
    rng = random.Random(12)
    base = rng.choices([f"w{i}" for i in range(3000)], k=140)
    rows = [(i, " ".join(edited(rng, base, 2))) for i in range(60)]
    made, kept = [], ngram_join.stored
    monkeypatch.setattr(ngram_join, "stored", lambda df, what: (out := kept(df, what), made.append(out.count()) if what == "pairs" else None)[0])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(ngram_join.link(docs)) == brute(rows)
    members, pairs = ngram_join.links(docs)
    sets = [shingles(t, 3) for _, t in rows]
    near = sum(100 * len(a & b) >= 90 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    assert pairs.count() == near and max(made) <= near + 60
