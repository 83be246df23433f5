import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from meterloom.llm import common, packing
from tests.conftest import SF

PATH = public_tokenizers.path("byte_bpe_50k.json")
library = Tokenizer.from_file(PATH)


def check(rows, texts, size=1024):
    """Each id in one piece, pieces as said, sequences gapless; returns the padding."""
    left = defaultdict(int)
    for t in texts:
        left[tuple(library.encode(t or "", add_special_tokens=False).ids + [0])] += 1
    total = sum(len(ids) * n for ids, n in left.items())
    assert sum(r["length"] for r in rows) == total
    of = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] > 0 and zlib.crc32(r["ids"]) == r["ids_crc32"] and r["start"] + r["length"] <= r["doc_tokens"]
        of[r["sequence_id"]].append(r)
    padding = 0
    for pieces in of.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding


def test_ids_as_the_library(edge_docs):
    ids = packing.ids_by(PATH)
    assert ids.same
    for t in [r["text"] for r in edge_docs.select("text").collect()] + ["a" + " " * 5000 + "b", "x" * 5000, "a\n\n\n b", "<|endoftext|><|endoftext|>"]:
        assert np.frombuffer(ids(t), "<u4").tolist() == library.encode(t or "", add_special_tokens=False).ids


def test_documents_come_back_whole(spark):
    docs = common.table(spark, SF, "documents")
    rows = packing.pack(docs.repartition(5), PATH).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert check(rows, texts.values()) == 0
    back = defaultdict(list)
    for r in rows:
        back[r["doc_id"]].append((r["start"], r["ids"]))
    for doc, text in texts.items():
        assert np.frombuffer(b"".join(x for _, x in sorted(back[doc])), "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids + [0]


def test_best_fit_over_few_windows():
    packer = packing.Packer(8, 2)
    ids = lambda n: bytes(4 * n)
    out = [w for n, doc in enumerate([5, 6, 3, 2]) for w in packer.place(n, ids(doc))]
    assert [[(p[0], len(p[2]) // 4) for p in w.pieces] for w in out] == [[(0, 5), (2, 3)], [(1, 6), (3, 2)]]
    assert not packer.windows
    full = [w for n, doc in enumerate([5, 6, 4]) for w in packer.place(n, ids(doc))]
    assert [[(p[0], len(p[2]) // 4) for p in w.pieces] for w in full] == [[(1, 6), (2, 2)]]  # none fits: the fullest goes


@pytest.mark.parametrize("left", [0, 1, 7, 1024, 1025, 2047, 3000])
def test_leftovers_need_no_padding(left):
    sizes = [w.used for w in packing.fill([(1, 0, bytes(4 * left), left)] if left else [], 1024)]
    assert sum(sizes) == left and all(s & (s - 1) == 0 for s in sizes)


def test_edge_rows(spark, edge_docs, no_docs):
    rows = packing.pack(edge_docs, PATH).collect()
    assert check(rows, [r["text"] for r in edge_docs.select("text").collect()]) == 0
    assert packing.pack(edge_docs, PATH, keep_ids=False).where("ids is not null").count() == 0
    assert packing.pack(no_docs, PATH).count() == 0
