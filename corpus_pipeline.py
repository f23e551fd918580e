"""A training-corpus pipeline: each stage calls one operator and writes its result.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return the
columns of ``documents``. Each stage passes on columns that it does not know, keeps
repeated rows unless it says otherwise, and gives an empty table for an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import near_copies, packing, pii, quality, toxicity
from millrace.llm.common import read_table, scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects; a null or empty text is too short and goes."""
    return quality.keep_good(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; a null text counts as empty. Without labels of both kinds nothing goes."""
    return toxicity.keep_clean(docs, read_table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): that of the smallest doc_id.

    Repeated rows are copies; texts without a word are one group; a row without a
    doc_id stays only where its group has no other.
    """
    return near_copies.first_of_similar(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by its kind; ``n_chars`` follows, a null text stays null."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens; a null text is its end mark alone."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_rules),
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: SQL has neither the trees, the fingerprints nor the tokenizer; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
