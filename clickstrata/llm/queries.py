"""The registered queries of this subpackage: thin digests over the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickstrata.llm import (
    collocations,
    decontamination,
    html_text,
    jaccard,
    merkle,
    mixing,
    pattern_packing,
    pii,
    quality,
    sharding,
    substrings,
    token_output,
    toxicity,
)
from clickstrata.llm.common import table

SHARDS = 40


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, field).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "spans",
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.contaminated(docs, items)


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removed(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "intervals"
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard(table(spark, sf_dir, "documents"), SHARDS)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.pack(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.assess(table(spark, sf_dir, "documents"))
    return judged.drop("cleaned")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = html_text.extracted(pages, html_text.train(pages))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *(count(at).alias(f"n_{kind}") for at, kind in enumerate(pii.KINDS)),
        F.sha2(pii.as_text("base"), 256).alias("base_sha256"),
        pii.as_text("spans").alias("spans"),
    )


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_packing.pack(table(spark, sf_dir, "documents"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_decontamination": op2_decontamination,
    "op3_substrings": op3_substrings,
    "op4_sharding": op4_sharding,
    "op5_token_output": op5_token_output,
    "op6_quality": op6_quality,
    "op7_html_text": op7_html_text,
    "op8_pii": op8_pii,
    "op9_jaccard": op9_jaccard,
    "op10_packing": op10_packing,
    "op11_manifest": op11_manifest,
    "op12_collocations": op12_collocations,
    "op13_mixing": op13_mixing,
}

ORACLE_SQL: dict[str, str] = {
    "op11_manifest": merkle.SQL,
    "op12_collocations": collocations.SQL,
    "op13_mixing": mixing.SQL,
}
