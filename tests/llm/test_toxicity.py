import random

from meterloom.llm import common, toxicity
from tests.conftest import SF


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_automaton_as_edit_distance():
    terms = ["scum", "idiot", "moron", "pathetic", "disgusting", "worthless"]
    lexicon = toxicity.Lexicon(terms, ["lowei"])
    rng = random.Random(1)
    for _ in range(3000):
        word = rng.choice([*terms, "idol", "loweichen", "rest"])
        for _ in range(rng.randint(0, 4)):
            i = rng.randint(0, len(word))
            word = word[:i] + rng.choice("abdimost") * rng.randint(0, 1) + word[i + rng.randint(0, 1) :]
        near = min(((distance(word, t), t) for t in terms if distance(word, t) <= toxicity.Lexicon.edits(t)), default=None)
        got = lexicon._match(word)
        if word in terms:
            assert got == (word, word, toxicity.EXACT)
        elif word.startswith("lowei"):
            assert got == (word, "lowei*", toxicity.BEGINNING)
        elif near is None:
            assert got is None
        else:
            assert got == (word, near[1][:4] + "~", toxicity.NEAR if near[0] == 1 else toxicity.FAR)


def test_quotation_is_told_from_use():
    lexicon = toxicity.Lexicon(["idiot"], [])
    assert [h[3] for h in lexicon.hits('you are an idiot and he said idiot and wrote "an idiot" there')] == [False, True, True]
    assert list(lexicon.hits(None)) == [] and list(lexicon.hits("")) == []


def test_held_out_rows(spark):
    sf = SF.replace("0.001", "0.1")
    rows = toxicity.op3_toxicity(spark, sf).toPandas()
    assert rows.score.between(0, 1).all() and len(rows) == common.table(spark, sf, "documents").count()
    rows = rows.merge(common.table(spark, sf, "labels").toPandas(), on="doc_id")
    held = rows[rows.held_out]
    assert held[held.toxic == 1].predicted.mean() > 0.85 and held[held.toxic == 0].predicted.mean() < 0.03


def test_misspelt_terms_and_clean_texts(spark):
    rng = random.Random(2)
    words = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "te") for b in ("ra", "nu", "so") for c in ("va", "do", "pe")]
    text = lambda extra: " ".join(w if rng.random() > 0.08 or not extra else rng.choice(extra) for w in rng.choices(words, k=60))
    bad = ["grumblehead", "nastyface"]
    rows = [(i, text(bad if i % 8 == 0 else []), int(i % 8 == 0)) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.learn(*toxicity.sample_of(df, df, lambda i: i.isNotNull()))
    assert set(model.terms) == set(bad)
    new = [(1, text([]) + " you grumblehead"), (2, text([]) + " you nastyfase"), (3, text([])), (4, None), (5, ""), (6, text([]) * 500)]
    score = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(new, "doc_id long, text string"), model).collect()}
    assert score[1] >= 0.7 and score[2] >= 0.7 and max(score[i] for i in (3, 4, 5, 6)) < 0.3


def test_edge_rows(spark, edge_docs, no_docs):
    labels = common.table(spark, SF, "labels")
    assert toxicity.learn(*toxicity.sample_of(edge_docs, labels.where("false"), lambda i: i.isNotNull())) is None
    assert {r["score"] for r in toxicity.score(edge_docs, None).collect()} == {0.0}
    model = toxicity.Model(("quick",), (), {}, {(k, q): 3.0 for k in range(4) for q in (False, True)}, -2.0, -4.0)
    assert toxicity.score(edge_docs, model).count() == edge_docs.count()
    assert toxicity.score(no_docs, model).count() == 0


def test_every_different_hit_counts():
    weights = {(f"term{c}", toxicity.EXACT, False): 0.7 for c in "abcdefgh"}
    model = toxicity.Model(tuple(t for t, *_ in weights), (), weights, {(k, q): 0.0 for k in range(4) for q in (False, True)}, -3.0, -4.0)
    lexicon = toxicity.Lexicon(model.terms, model.beginnings)
    scores = [toxicity.score_text(" and then ".join(model.terms[:n]), model, lexicon) for n in range(9)]
    assert scores == sorted(scores) and len(set(scores)) == 9 and scores[3] < 0.5 < scores[5]
    assert toxicity.score_text(" and then ".join(model.terms[:2] * 9), model, lexicon) == scores[2]
