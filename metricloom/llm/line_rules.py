"""Quality rules with cross-document line frequency.

Lines are normalised (lower case, digit runs to 0, white space to one space) and hashed. A line is boilerplate on a
host if it stands in more than `percent` % of the host's distinct texts; the share decides, and a line needs only the
few texts (`min_texts`) without which a share says nothing. Boilerplate lines are removed; a document that keeps less than `keep_percent` % of its word characters is
depleted and rejected. Exact copies of a text count once, so that copies of a clean article do not make its lines
boilerplate.

Scale: only (host, line hash, text hash) is shuffled, and no key of that exchange can be hot, because it holds the
text. What survives is at most 100 / `percent` times the mean lines of a text per host; it travels as one array per
host, so the documents themselves are never shuffled.

Defined results: a null text is an empty one (no words, rejected), a null host is a host of its own, blank lines are
never boilerplate, a repeated row is judged like its twin, other columns of the input are ignored by `rule_verdicts`
and kept by `apply_line_rules`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from metricloom.llm.common import BLANK_CHARS, BLANKS, text_of, window_hashes, without, words_of
from metricloom.plans.attach import attach
from metricloom.plans.workspace import materialize

MIN_TEXTS, PERCENT, KEEP_PERCENT = 3, 5, 30
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = "#*$%&|<>"


def line_hash(line: Column) -> Column:
    """Hash of the normalised line; that of the empty text for a line without a word."""
    return F.xxhash64(F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "0"), BLANKS, " ")))


def common_lines(
    docs: DataFrame, text: str, host: str, min_texts: int = MIN_TEXTS, percent: int = PERCENT
) -> DataFrame:
    """One row per host: `_common`, the hashes of its boilerplate lines, and `_texts`, its distinct texts."""
    lines = docs.select(
        F.col(host).alias("_host"),
        F.xxhash64(text_of(text)).alias("_text"),
        F.explode(
            # the line null is added to every text: it counts the host's texts
            F.concat(
                F.array(F.lit(None).cast("long")),
                F.array_remove(
                    F.array_distinct(F.transform(F.split(text_of(text), "\n", -1), line_hash)), F.xxhash64(F.lit(""))
                ),
            )
        ).alias("_line"),
    )
    per_line = (
        lines.distinct()
        .groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("_n"))
    )
    per_line = materialize(per_line.filter(F.col("_line").isNull() | (F.col("_n") >= min_texts)), "lines")
    hosts = per_line.filter("_line IS NULL").select(F.col("_host").alias("_of"), F.col("_n").alias("_texts"))
    above = F.col("_n") * 100 > F.col("_texts") * percent
    return (
        per_line.join(hosts, F.col("_host").eqNullSafe(F.col("_of")))
        .groupBy("_host")
        .agg(
            F.sort_array(F.collect_list(F.when(F.col("_line").isNotNull() & above, F.col("_line")))).alias("_common"),
            F.max("_texts").alias("_texts"),
        )
    )


def _with_rules(docs: DataFrame, text: str, host: str, min_texts: int, percent: int, keep_percent: int) -> DataFrame:
    """The input's rows as the struct `_row`, with the base figures, `_clean` (text without boilerplate) and `_kept`."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        text_of(text).alias("_t"), F.col(host).alias("_host"),
    )
    rows = attach(rows, common_lines(docs, text, host, min_texts, percent), ["_host"], weight="_texts",
                  spread=F.col("_t"))
    rows = rows.withColumn("_words", words_of(F.col("_t"))).withColumn("_lines", F.split("_t", "\n", -1))
    rows = rows.withColumn("_w3", window_hashes(F.col("_words"), 3))
    rows = rows.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_w3")) < F.size("_w3"),
            F.sort_array(F.transform("_w3", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    s = F.col("_sorted")
    repeated = F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]))
    inside = F.array_distinct(F.flatten(F.transform(repeated, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    worded = F.filter("_lines", lambda line: without(line, BLANK_CHARS) != "")
    kept_lines = F.filter("_lines", lambda line: ~F.coalesce(F.array_contains("_common", line_hash(line)), F.lit(False)))
    rows = rows.withColumns({
        "_worded": worded,
        "_clean": F.when(F.size("_common") > 0, F.array_join(kept_lines, "\n")).otherwise(F.col("_t")),
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(without(F.col("_t"), BLANK_CHARS)).cast("long"),
        "n_symbols": (F.length("_t") - F.length(without(F.col("_t"), SYMBOLS))).cast("long"),
        "n_repeat_words": F.when(s.isNull(), F.lit(0)).otherwise(F.size(inside)).cast("long"),
    })
    rows = rows.withColumns({
        "n_dup_lines": (F.size("_worded") - F.size(F.array_distinct("_worded"))).cast("long"),
        "kept_chars": F.length(without(F.col("_clean"), BLANK_CHARS)).cast("long"),
        "base_failed": (F.col("n_words") < MIN_WORDS)
        | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT),
    })
    depleted = F.col("kept_chars") * 100 < F.col("word_chars") * keep_percent
    return rows.withColumn("_kept", ~F.col("base_failed") & ~depleted)


def rule_verdicts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
    min_texts: int = MIN_TEXTS, percent: int = PERCENT, keep_percent: int = KEEP_PERCENT,
) -> DataFrame:
    """One row per document: the base figures, `kept_chars` after line removal and `kept`."""
    return _with_rules(docs, text, host, min_texts, percent, keep_percent).select(
        F.col(f"_row.{doc_id}").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "kept_chars", "base_failed", F.col("_kept").alias("kept"),
    )


def apply_line_rules(
    docs: DataFrame, text: str = "text", host: str = "source",
    min_texts: int = MIN_TEXTS, percent: int = PERCENT, keep_percent: int = KEEP_PERCENT,
) -> DataFrame:
    """The kept documents with all their columns, boilerplate lines taken out of the text."""
    rows = _with_rules(docs, text, host, min_texts, percent, keep_percent)
    # exploding an array of one or no row filters without pushing the verdict's expressions below their columns
    kept = rows.select(F.explode(F.when(F.col("_kept"), F.array(F.struct("_row", "_clean")))).alias("k"))
    return kept.select(
        *[(F.col("k._clean") if c == text else F.col(f"k._row.`{c}`")).alias(c) for c in docs.columns]
    )
