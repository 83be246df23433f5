import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from meterloom.llm import bpe
from tests.llm.conftest import TEXTS

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = ["a", "b", "E", "é", "é", "Σ", "ς", " ", "\n", "\t", "\x1c", "\x85", "　", "1", "²", "'s", "'", "!", "..", "<|endoftext|>", "<|start", "漢字", "😀", "İ", "the", "ing", "__", "ß", "ǅ", "\x00"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


def test_same_ids_and_text_as_the_library(library):
    own = bpe.tokenizer(PATH)
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choices(PIECES, k=rng.randint(0, 16)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_automaton_holds_exactly_the_merge_results():
    merges = [("a", "b"), ("b", "c"), ("ab", "c"), ("a", "a"), ("aa", "b"), ("c", "a")]
    symbols = {s: i for i, s in enumerate(["a", "b", "c", "ab", "bc", "abc", "aa", "aab", "ca"])}
    automaton = bpe.Automaton(symbols, merges)

    def merge(word):
        parts = list(word)
        while True:
            found = [(merges.index(p), -i) for i, p in enumerate(zip(parts, parts[1:])) if p in merges]
            if not found:
                return parts
            rank, at = min(found, key=lambda x: (x[0], -x[1]))
            parts[-at : -at + 2] = ["".join(parts[-at : -at + 2])]

    rng = random.Random(2)
    for _ in range(2000):
        word = "".join(rng.choices("abc", k=rng.randint(1, 9)))
        assert [automaton.names[x] for x in automaton.walk(word)] == merge(word)


def test_recent_forgets_only_what_is_out_of_use():
    made = []
    memo = bpe.Recent(lambda k: made.append(k) or k, 2)
    for k in "abacadab":
        assert memo[k] == k
    assert made.count("a") == 1 and len(memo) <= 2


def test_edge_rows(spark, edge_docs, no_docs, library):
    rows = bpe.encode(edge_docs, PATH).collect()
    assert len(rows) == len(TEXTS)
    want = sorted((str(i), library.encode(t or "", add_special_tokens=False).ids) for i, t in TEXTS)
    assert sorted((str(r["doc_id"]), list(r["ids"])) for r in rows) == want
    assert all(r["decoded"] == library.decode(list(r["ids"]), skip_special_tokens=False) for r in rows)
    assert bpe.encode(no_docs, PATH).count() == 0
