"""Corpus pipeline: quality rules, near duplicates, decontamination, secrets, mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of `documents`, with `n_chars` counted anew where a text changed.
The last returns the mixture: doc_id, domain, lang, source, text, tokens and epoch, a row per document and epoch.
Null texts count as empty: the quality rules reject them. Nulls in other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from metricloom.llm import decontaminate, line_rules, mixture, secret_scan, simhash_blocks
from metricloom.llm.common import table, text_of
from metricloom.plans.workspace import materialize


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without boilerplate lines."""
    return _counted(line_rules.apply_line_rules(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each component; rows that share it and rows without one all stay."""
    found = simhash_blocks.simhash_components(docs)
    first = found.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("first")).distinct()
    known = docs.filter(F.col("doc_id").isNotNull())
    return known.join(first, F.col("doc_id") == F.col("first"), "left_semi").unionByName(docs.filter(F.col("doc_id").isNull()))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    found = decontaminate.contained_items(docs, table(spark, sf_dir, "benchmark"))
    bad = found.select("doc_id").distinct()
    return docs.join(bad, docs["doc_id"] == bad["doc_id"], "left_anti")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced."""
    return _counted(secret_scan.redact(docs))


def weighted_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture, a row per epoch."""
    chosen = mixture.mix_rows(docs).distinct()
    texts = docs.select(F.col("doc_id").alias("id"), "text", F.xxhash64(text_of("text")).alias("hash"))
    return chosen.join(texts, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("twin") == F.col("hash"))).select(
        "doc_id", "domain", "lang", "source", "text", "tokens", "epoch"
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixture", weighted_mixture),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# SimHash needs XXH64 and components, the scan trained models: DuckDB has neither, so tests compare with brute force.
ORACLE_SQL = None
