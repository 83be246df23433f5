import pytest

LONG = " ".join(f"word{i % 7919} in{i % 13}" for i in range(30_000))

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog while password: hunter2secret stays here, isn't it so?\nSecond line of the same text follows."),
    (2, None),
    (3, ""),
    (4, " \t\n"),
    (5, LONG),
    (6, "The quick brown fox jumps over the lazy dog while password: hunter2secret stays here, isn't it so?\nSecond line of the same text follows."),
    (6, "The quick brown fox jumps over the lazy dog while password: hunter2secret stays here, isn't it so?\nSecond line of the same text follows."),
    (7, "été Σ ñandú 漢字 😀 <|endoftext|> x"),
    (None, "The quick brown fox jumps over the lazy dog while nobody watches the other lazy dog sleep in the long warm afternoon sun."),
    (8, "one two"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, start int, spans string, prefix int, seed long, token long, root long, blob string, kept string, mark long, pick long"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and long texts, repeated rows and columns named like those the operators make."""
    rows = [(i, t, "en", "src", None if t is None else len(t), "x", 1, "s", 2, 3, 4, 5, "b", "k", 6, 7) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
