"""The corpus pipeline: five stages over documents, each on all that the one before kept.

Each function takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read back as the next
one's docs. All but the last return the columns of documents, also columns that documents has not, whatever their names.
No stage can be said in SQL as a whole (a trained classifier comes first), so ORACLE_SQL is None; tests hold every stage
against a brute-force version.

For every stage: an empty table gives an empty one; texts of any length are taken whole; no row of a null doc_id is
taken for another one's.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from loomlake.llm import budget_mix, byte_bpe, cotrain, jaccard_links, line_dedup, simhash_cover
from loomlake.llm._shared import documents, remove, shared_path, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go.

    Null and empty texts, null languages and sources are scored like any; of labels that repeat the highest counts, null
    labels count nothing; without labels of both classes nothing goes. Repeated rows stay or go together.
    """
    return cotrain.accepted(docs, cotrain.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in 10 documents or more lose all their occurrences; every document stays, with n_chars set anew.

    A null text stays null, and an empty line is never dropped; rows that repeat an id are one document.
    """
    return line_dedup.apply(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest id.

    First SimHash links fingerprints of 3 bits or fewer; then, as that misses most pairs of similarity 0.8 or more of
    5-word shingles, those are linked by min-hash keys and compared as whole sets. Null, empty and blank texts are copies
    of each other for SimHash; of repeated rows one stays; rows whose whole group has no id stay, as nothing names one.
    """
    return jaccard_links.keep_one(stored(simhash_cover.keep_one(docs)))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that fill the budgets of the weight tree in one seeded epoch.

    Null language or source is a leaf "null"; texts without words cost nothing; of repeated rows as many stay as were
    taken; the document at a budget's edge stays whole.
    """
    return budget_mix.mixed(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids instead of text, checked by decoding them; null text has no tokens, repeated rows repeat."""
    return byte_bpe.encoded(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("byte-level BPE encoding and decoding", encoding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written to the shared folder and read back; only the last of them stays
    there, as the result is read from it."""
    docs, place = documents(spark, sf_dir), f"{shared_path(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{number}")
        docs = spark.read.parquet(f"{place}/{number}")
        if number:
            remove(spark, f"{place}/{number - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
