"""From raw documents to packed training sequences, in five stages.

Every stage works on all that the one before kept; between stages the documents are
written and read again. All but the last return the columns of ``documents``.

Cases without a rule of their own follow the operators: a null or empty text is not
toxic, linked with nothing, clean and unchanged, and is packed as an end id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickstrata.llm import decontamination, jaccard, pattern_packing, pii, toxicity
from clickstrata.llm.common import small_batches, store, table

# Near copies: 0.8 of the shingles of five words in common.
NEAR = jaccard.Rule(shingle=5, top=8, base=10)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger scores below one half."""
    small_batches(spark)
    field = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.clean(docs, field)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    small_batches(spark)
    return jaccard.representatives(docs, NEAR)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    small_batches(spark)
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return pii.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in packed sequences."""
    small_batches(spark)
    return pattern_packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_test_items),
    ("personal_data", redact),
    ("packing", pack),
]

# The stages are models, searches and a fitted plan: not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
