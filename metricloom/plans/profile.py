"""Value profiles: every series reduced to its distinct values and their counts.

Ranks, quantiles and the scalar detectors depend on values only, so they run on the profile and
never on raw rows. The profile is laid out in order too: it may be as long as the data.

Histograms of batches add up, so a stored one serves all batches so far: `stored_histogram` is a table that batches are
added to, and profiles, statistics, ranks and quantiles follow from it exactly, as from all rows at once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from metricloom.functions.scalar import finite
from metricloom.plans.log_table import LogTable
from metricloom.plans.ordered import Ordered, lay_out
from metricloom.plans.workspace import materialize


@dataclass(frozen=True)
class ValueProfile:
    """Rows (keys, value, n, cum, total): copies, copies up to here, copies in the series."""

    ordered: Ordered
    keys: tuple[str, ...]
    value: str

    @property
    def rows(self) -> DataFrame:
        return self.ordered.rows

    @property
    def table(self) -> DataFrame:
        return self.rows.select(*self.keys, self.value, "n", "cum", "total")


def value_profile(
    df: DataFrame, keys, value: str, weight: str | None = None, parts: int | None = None, write: bool = True
) -> ValueProfile:
    """Profile of the finite values; `weight` sums an existing count column.

    Written by default, for several readers; `write=False` suits a single one.
    """
    keys = tuple(keys)
    copies = F.sum(weight) if weight else F.count(F.lit(1))
    histogram = df.filter(finite(value).isNotNull()).groupBy(*keys, value).agg(copies.alias("n"))
    ordered = lay_out(histogram, keys, [value], parts)
    running = ordered.running({"cum": ("sum", F.col("n"))}, totals=True)
    running = running.withColumnRenamed("cum_total", "total")
    return ValueProfile(ordered.with_rows(materialize(running, "profile") if write else running), keys, value)


def histogram(df: DataFrame, keys, value: str) -> DataFrame:
    """(keys, value, n): copies of every finite value, and under null the rows without one."""
    return df.groupBy(*keys, finite(value).alias(value)).agg(F.count(F.lit(1)).alias("n"))


def stored_histogram(spark: SparkSession, path: str, keys, value: str) -> LogTable:
    """A histogram under `path` to which `add(histogram(batch, ...), batch_id)` adds batches; `read()` has the sums."""

    def summed(versions: DataFrame) -> DataFrame:
        return versions.groupBy(*keys, value).agg(F.sum("n").alias("n"), F.max("batch_id").alias("batch_id"))

    return LogTable(spark, path, summed, F.lit("all"))


def average_rank(profile: ValueProfile) -> Column:
    """Rank divided by n, ties at their average rank."""
    return (F.col("cum") - F.col("n") / 2 + 0.5) / F.col("total")


def quantiles(profile: ValueProfile, wanted: dict[str, float]) -> DataFrame:
    """Exact quantiles per series with linear interpolation, one row per series."""
    value, start = F.col(profile.value), F.col("cum") - F.col("n")
    picks = []
    for name, q in wanted.items():
        position = F.lit(float(q)) * (F.col("total") - 1)
        for side, at in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            inside = (start <= at) & (at < F.col("cum"))
            picks.append(F.max(F.when(inside, value)).alias(f"_{name}_{side}"))
    grouped = profile.rows.groupBy(*profile.keys).agg(F.max("total").alias("_n"), *picks)
    out = []
    for name, q in wanted.items():
        position = F.lit(float(q)) * (F.col("_n") - 1)
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return grouped.select(*profile.keys, *out)
