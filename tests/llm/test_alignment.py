import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from meterloom.llm import alignment, common
from tests.conftest import SF

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
library = Tokenizer.from_file(A)
library.encode_special_tokens = True
model = SentencePieceProcessor(model_file=B)


def byte_level():
    """Character of every byte in byte-level vocabularies, by the published rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


BYTE, NAME = byte_level(), {i: t for t, i in library.get_vocab().items()}


def a_bytes(i):
    return b"<|endoftext|>" if i == 50256 else bytes(BYTE[c] for c in NAME[i])


def b_bytes(i):
    piece = model.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()


def tokens(text):
    """(ids, ends) of both sides by the libraries themselves."""
    if not text:
        return [], [], [], []
    a, b = library.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
    spelled = [a_bytes(i) for i in a], [b_bytes(i) for i in b]
    if any(b"".join(s) != (" " + text).encode() for s in spelled):
        return [], [], [], []
    return a, np.cumsum([len(x) for x in spelled[0]]).tolist(), b, np.cumsum([len(x) for x in spelled[1]]).tolist()


def brute(texts):
    rows, counts = [], Counter()
    for text in texts:
        a, a_end, b, b_end = tokens(text)
        cuts = sorted(set(a_end) & set(b_end))
        groups, left_a, left_b = [], list(zip(a_end, a))[::-1], list(zip(b_end, b))[::-1]

        def side(left, cut):
            out = []
            while left and left[-1][0] <= cut:
                out.append(str(left.pop()[1]))
            return ",".join(out)

        for cut in cuts:
            groups.append(f"{side(left_a, cut)}|{side(left_b, cut)}")
        at_a, at_b = dict(zip(a_end, a)), dict(zip(b_end, b))
        links = [(at_a[c], at_b[c]) for c in cuts]
        counts.update(links)
        rows.append((len(a), len(b), len(cuts), ";".join(groups), links))
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [(a, b, n, g, hashlib.sha256(g.encode()).hexdigest() if g else "", len(l), sum(counts[p] == highest[p[1]] for p in l), sum(counts[p] for p in l)) for a, b, n, g, l in rows]


COLUMNS = ["n_a", "n_b", "n_groups", "groups", "groups_sha256", "n_links", "n_best", "count_sum"]
HARD = [
    None, "", " ", "\n\n\t", "  two  blanks  ", "<|endoftext|> <s></s> <unk> <0x41>", "▁ mark", "été ñandú Straße", "漢字かな 한국어", "😀👩‍👩‍👧 ‍", "a\x00b", "x" * 3000,
    " " * 3000, "tab\tand\r\nline", "1234567890 3.14e-10", "don't we'll I'm", "ﬁ ligature ｆｕｌｌ", "é combining", "﻿bom", "العربية עברית",
]


def test_against_brute_force(spark):
    rng = random.Random(6)
    texts = HARD + ["".join(rng.choice("ab cé漢😀\n.1▂") for _ in range(rng.randint(1, 60))) for _ in range(300)] + ["the same text again"] * 50
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.aligned(docs, A, B).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_table_against_brute_force(spark):
    docs = common.table(spark, SF, "documents")
    rows = sorted(docs.select("doc_id", "text").collect())
    got = sorted(map(tuple, alignment.op12_alignment(spark, SF).select("doc_id", *[c for c in COLUMNS if c != "groups"]).collect()))
    assert got == [(r["doc_id"], *(x for i, x in enumerate(b) if i != 3)) for r, b in zip(rows, brute([r["text"] for r in rows]))]


def test_ids_as_the_library():
    a, b = alignment.tokenizers_of(A, B)
    assert a.fast is not None
    for t in [t for t in HARD if t]:
        assert a(t) == library.encode(t, add_special_tokens=False).ids and b(t) == model.encode(t)
    assert [a.vocabulary.tokens[i] for i in range(50257)] == [a_bytes(i) for i in range(50257)]
    assert [b.vocabulary.tokens[i] for i in range(3, 32000)] == [b_bytes(i) for i in range(3, 32000)]


def test_linkable_pairs_are_the_suffixes():
    """Bounded by the bytes of both vocabularies, and complete: a sample of tokens against all others."""
    a, b = (t.vocabulary for t in alignment.tokenizers_of(A, B))
    pairs = alignment.linkable(A, B)
    assert (np.diff(pairs) > 0).all() and len(pairs) <= a.lengths.sum() + b.lengths.sum()
    rng = random.Random(1)
    by_a = {}
    for p in pairs.tolist():
        by_a.setdefault(p // 32000, set()).add(p % 32000)
    for i in rng.sample(range(50257), 60):
        x = a.tokens[i]
        assert by_a.get(i, set()) == {j for j, y in enumerate(b.tokens) if y and (x.endswith(y) or y.endswith(x))}


def test_coalesced_intervals_against_shared_ends():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randint(1, 40)
        ends = [sorted({n, *(rng.randint(1, n) for _ in range(rng.randint(0, 30)))}) for _ in "ab"]
        starts = [[0, *e[:-1]] for e in ends]
        got = alignment.coalesced(*(np.array(x) for s, e in zip(starts, ends) for x in (s, e)))
        cuts = sorted(set(ends[0]) & set(ends[1]))
        for e, g in zip(ends, got):
            assert g.tolist() == [sum(c < x for c in cuts) for x in e]


def test_edges(spark, edge_docs, no_docs):
    rows = edge_docs.select("doc_id", "text").collect()
    got = alignment.aligned(edge_docs, A, B).select("doc_id", *COLUMNS).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((r["doc_id"], *b)) for r, b in zip(rows, brute([r["text"] for r in rows])))
    assert alignment.aligned(no_docs, A, B).collect() == []
    clash = spark.createDataFrame([(1, "a b", 2, "x", "y")], "`the.id` long, text string, doc_id long, links string, groups string")
    assert [r["n_a"] for r in alignment.aligned(clash, A, B, id_col="the.id").collect()] == [2]


def test_blocks_are_bounded_and_whole():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(["a" * 5, None, "b" * 9, "", "c" * 30, "d", "e"])], ["doc_id", "text"])
    blocks = [(ids.to_pylist(), texts) for ids, texts in alignment._blocks([batch], 10)]
    assert [i for ids, _ in blocks for i in ids] == list(range(7)) and [t for _, texts in blocks for t in texts] == batch.column(1).to_pylist()
    assert all(len(texts) == 1 or sum(len(t or "") for t in texts) <= 10 for _, texts in blocks)
