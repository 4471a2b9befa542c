"""Scalar cleanup and flag expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

EPSILON = 1e-8


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(c: str | Column) -> Column:
    """Two decimals, half to even on the scaled binary value, as array libraries round."""
    return F.rint(_col(c) * 100) / 100


def clip(c: str | Column, low: float, high: float) -> Column:
    """Bound to [low, high]; null stays null."""
    c = _col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def nan_to_null(c: str | Column) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def finite(c: str | Column) -> Column:
    """The value where it is a finite number, else null."""
    c = _col(c)
    return F.when(F.abs(c) < math.inf, c)


def clean_number(c: str | Column) -> Column:
    """Infinity, NaN and null become 0."""
    return F.coalesce(finite(_col(c).cast("double")), F.lit(0.0))


def clean_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: clean_number(c) for c in columns})


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def missing(df: DataFrame, column: str) -> Column:
    """Whether the cell is null or NaN."""
    c = F.col(f"`{column}`")
    return c.isNull() | F.isnan(c) if dict(df.dtypes)[column] in ("float", "double") else c.isNull()


def threshold_flags(value: str, high: float = 80, very_high: float = 90, low: float = 10) -> dict[str, Column]:
    v = nan_to_null(value)
    return {
        "is_high_usage": flag(v > high),
        "is_very_high_usage": flag(v > very_high),
        "is_low_usage": flag(v < low),
    }


def out_of_range(value: str, low: float = 0, high: float = 100) -> Column:
    """Whether the value lies outside; a missing one does not."""
    v = nan_to_null(value)
    return F.coalesce((v < low) | (v > high), F.lit(False))


def normalize_label(label: str | Column, anomaly_value: int = 1) -> Column:
    """Label with 1 for an anomaly, whichever value the input uses for it."""
    label = _col(label)
    return F.when(label.isNotNull(), (label == F.lit(anomaly_value)).cast("int"))


def label_filter(df: DataFrame, **wanted: str) -> DataFrame:
    """Rows whose labels equal the wanted ones: own columns, or entries of a `labels` map."""
    for name, value in wanted.items():
        has = F.col(name) if name in df.columns else F.try_element_at("labels", F.lit(name))
        df = df.filter(has == F.lit(value))
    return df


def position(df: DataFrame, ts: str, tie: tuple[str, ...] | list[str] = ()) -> Column:
    """A value that orders rows by time and tie, nulls first.

    With a timestamp and at most one whole-number tie it is one decimal: 18 digits for the microseconds from year 1
    to 9999, 20 for the tie. Aggregates keep that in a hash table, while they sort all rows to compare structs.
    """
    kinds = dict(df.dtypes)
    whole = len(tie) <= 1 and all(kinds[t] in ("tinyint", "smallint", "int", "bigint") for t in tie)
    if not whole or kinds[ts] not in ("timestamp", "timestamp_ntz"):
        return F.struct(ts, *tie)
    micros = F.unix_micros(F.col(ts).cast("timestamp")) + 62_135_596_800_000_000
    place = F.coalesce(micros, F.lit(0)).cast("decimal(18,0)") * F.lit("100000000000000000000").cast("decimal(21,0)")
    if tie:
        last = F.col(tie[0]).cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(20,0)")
        place = place + F.coalesce(last, F.lit(0).cast("decimal(20,0)"))
    return place.cast("decimal(38,0)")
