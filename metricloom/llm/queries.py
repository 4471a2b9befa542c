"""Registered queries of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from metricloom.llm import (
    chat_format, decontaminate, heap_centroids, jaccard_regions, line_rules, mixture, page_extract, periodic_runs, rule_ensemble,
    secret_scan, sentence_spans, simhash_blocks, substring_dedup,
)
from metricloom.llm.common import table, text_of, words_of


def line_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.rule_verdicts(table(spark, folder, "documents"))


def simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_blocks.simhash_components(table(spark, folder, "documents"))


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secret_spans(table(spark, folder, "documents"))


def weights(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.mix(table(spark, folder, "documents"))


def chat(spark: SparkSession, folder: str) -> DataFrame:
    turn = lambda role: F.struct(F.lit(role).alias("role"), F.lit("</s>[INST] ok [/INST]").alias("content"))
    escaped = spark.range(1).select(F.lit(-7).cast("long").alias("id"), F.array(turn("user"), turn("assistant")).alias("messages"))
    turns = chat_format.canonical_turns(table(spark, folder, "conversations")).unionByName(chat_format.canonical_turns(escaped))
    return chat_format.digests(chat_format.read_back(chat_format.format_chat(turns)))


def sentences(spark: SparkSession, folder: str) -> DataFrame:
    return sentence_spans.remove_spans(table(spark, folder, "documents"))


def quality(spark: SparkSession, folder: str) -> DataFrame:
    return rule_ensemble.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def page_texts(spark: SparkSession, folder: str) -> DataFrame:
    found = page_extract.extract(table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def substrings(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def repeated_tails(docs: DataFrame) -> DataFrame:
    """`documents` with periods written into the texts whose crc32 of the doc_id is a multiple of ten."""
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, words_of(text_of("text"))))
    n = F.size("w").cast("long")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    tail = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))


def runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.periodic_runs(repeated_tails(table(spark, folder, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumns({"best": longest, "n_runs": F.size("runs").cast("long")})
    start, length, period = -F.col("best.back"), F.col("best.length"), -F.col("best.short")
    return found.select(
        "doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_regions.jaccard_components(table(spark, folder, "documents"))


def centroids(spark: SparkSession, folder: str) -> DataFrame:
    found, final = heap_centroids.heap_clusters(table(spark, folder, "embeddings"))
    return heap_centroids.with_inertia(found, final)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline  # it imports the operators, so it can't be imported before them

    return corpus_pipeline.run(spark, folder)


QUERIES = {
    "pipeline": pipeline,
    "op1_chat": chat,
    "op2_sentence_spans": sentences,
    "op3_containment": decontamination,
    "op4_line_frequency": line_frequency,
    "op5_simhash": simhash,
    "op6_secrets": secrets,
    "op7_rule_ensemble": quality,
    "op8_mixture": weights,
    "op9_substrings": substrings,
    "op10_main_text": page_texts,
    "op11_periodic_runs": runs,
    "op12_jaccard_regions": jaccard,
    "op13_heap_centroids": centroids,
}
