"""Exact train/test splits and folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from metricloom.plans.ordered import IDX, PART, RN, ROWS, Ordered, lay_out, order_series
from metricloom.series import Series


def shuffle_key(ids: list[str], seed: int) -> Column:
    """A reproducible random order: md5 of the row's id and the seed."""
    return F.md5(F.concat_ws("-", *[F.col(c).cast("string") for c in ids], F.lit(str(seed))))


def _by_class(df: DataFrame, ids: list[str], label: str, seed: int, parts: int | None) -> Ordered:
    """Rows of each class in random order; a class may hold nearly all rows, so it is laid out."""
    return lay_out(df.withColumn("_hash", shuffle_key(ids, seed)), [label], ["_hash", *ids], parts)


def stratified_split(
    df: DataFrame,
    ids: list[str],
    label: str = "is_anomaly",
    test: float = 0.2,
    seed: int = 42,
    parts: int | None = None,
) -> DataFrame:
    """Add `split`: the first round(test * n) rows of each class by hash are 'test'."""
    numbered = _by_class(df, ids, label, seed, parts).numbered()
    is_test = F.col(RN) < F.round(F.lit(test) * F.col(ROWS))
    return numbered.select(*df.columns, F.when(is_test, "test").otherwise("train").alias("split"))


def stratified_folds(
    df: DataFrame,
    ids: list[str],
    label: str = "is_anomaly",
    folds: int = 3,
    seed: int = 42,
    parts: int | None = None,
) -> DataFrame:
    """Add `fold` in 0..folds-1, dealt round robin inside each class."""
    numbered = _by_class(df, ids, label, seed, parts).numbered()
    return numbered.select(*df.columns, F.pmod(F.col(RN), F.lit(folds)).cast("int").alias("fold"))


def deal(
    df: DataFrame, ids: list[str], label: str = "is_anomaly", test: float = 0.2, folds: int = 3, seed: int = 42,
    parts: int | None = None,
) -> DataFrame:
    """Add `_split` and `_fold`: a stratified split, and folds of its training rows, from one layout.

    Both go by the same order, in which the test rows of a class come first; they have no fold.
    """
    numbered = _by_class(df, ids, label, seed, parts).numbered()
    held = F.round(F.lit(test) * F.col(ROWS)).cast("long")
    is_test = F.col(RN) < held
    return numbered.select(
        *df.columns,
        F.when(is_test, "test").otherwise("train").alias("_split"),
        F.when(~is_test, F.pmod(F.col(RN) - held, F.lit(folds)).cast("int")).alias("_fold"),
    )


def chronological_split(
    src: DataFrame | Ordered, train: float = 0.8, spec: Series = Series(), parts: int | None = None
) -> DataFrame:
    """Add `split`: the first floor(train * n) rows of each series by time are 'train'."""
    ordered = order_series(src, spec, parts)
    payload = [c for c in ordered.rows.columns if c not in (PART, IDX)]
    is_train = F.col(RN) < F.floor(F.lit(train) * F.col(ROWS))
    return ordered.numbered().select(*payload, F.when(is_train, "train").otherwise("test").alias("split"))
