"""Column expressions and helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from metricloom.plans.attach import join_side

BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space."""
    return F.array_remove(F.split(text, BLANKS, -1), "")


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def window_hashes(words: Column, size: int) -> Column:
    """One hash per run of `size` consecutive words; empty where there are fewer words.

    `words` must be a plain column: it is read once per element.
    """
    return F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, size)])),
        1,
        F.greatest(F.size(words) - (size - 1), F.lit(0)),
    )


def bounded_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting rows and measuring bytes; beyond the bounds the join is shuffled.

    `df` should be a written table, so that the count reads no text twice.
    """
    return join_side(df, most)[0]
