"""The training-data pipeline: stages over documents, each stored and reread as the next one's input.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given. All but the last return the columns of
``documents``, with ``n_chars`` following the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.llm import common, ngram_join, packing, quality, secret_scan, substrings


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines are mostly content and that no base rule rejects."""
    return quality.retained(docs, quality.fit(docs, common.table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest identifier, of each group linked by five-word shingles at 0.8."""
    return ngram_join.one_of_each(docs, size=5, num=80, den=100)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows of 13 that an earlier document holds are cut; documents left without words go."""
    return _counted(substrings.without_repeats(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return _counted(secret_scan.redacted(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, with their token ids, in sequences of 1024."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_substrings", repeated_substrings),
    ("secrets", secrets),
    ("packing", packed),
]

#: The first and the last stage use a fitted model and a tokenizer, which SQL cannot express; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
