"""Whole-series and per-group statistics, put back on rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from metricloom.functions.scalar import EPSILON, finite, nan_to_null
from metricloom.plans.attach import attach, null_safe_join
from metricloom.plans.profile import average_rank, quantiles, value_profile
from metricloom.series import Series


def series_stats(df: DataFrame, spec: Series = Series()) -> DataFrame:
    """One row per series: rows, values, min, max, mean, sample std; NaN and infinities are missing values."""
    v = finite(spec.value)
    return df.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(v).alias("n_values"),
        F.min(v).alias("v_min"),
        F.max(v).alias("v_max"),
        F.avg(v).alias("v_mean"),
        F.stddev_samp(v).alias("v_std"),
    )


def histogram_stats(table: DataFrame, spec: Series = Series(), parts: int | None = None) -> DataFrame:
    """What `fit_stats` gives for the rows that a histogram (keys, value, n) stands for, from the histogram alone."""
    keys, v = list(spec.keys), F.col(spec.value)
    present = F.when(v.isNotNull(), F.col("n"))
    sums = table.groupBy(*keys).agg(
        F.sum("n").alias("n_rows"), F.coalesce(F.sum(present), F.lit(0)).alias("n_values"), F.min(v).alias("v_min"), F.max(v).alias("v_max"),
        F.try_divide(F.sum(v * F.col("n")), F.sum(present)).alias("v_mean"), F.count(v).alias("n_distinct"), F.count(F.lit(1)).alias("_rows"),
    )
    centred = attach(table, sums, keys, weight="_rows")
    squares = centred.groupBy(*keys).agg(F.sum(F.col("n") * F.pow(v - F.col("v_mean"), 2)).alias("_squares"))
    quartiles = quantiles(value_profile(table, keys, spec.value, weight="n", parts=parts), {"q1": 0.25, "median": 0.5, "q3": 0.75})
    joined = null_safe_join(null_safe_join(sums, squares, keys), quartiles, keys)
    spread = F.sqrt(F.try_divide(F.col("_squares"), F.col("n_values") - 1))
    return joined.withColumn("v_std", spread).select(
        *keys, "n_rows", "n_values", "v_min", "v_max", "v_mean", "v_std", "q1", "median", "q3", "n_distinct"
    )


def histogram_ranks(df: DataFrame, table: DataFrame, spec: Series = Series(), parts: int | None = None) -> DataFrame:
    """Add `cpu_rank` of each value among the rows of a histogram (keys, value, n); none for values it lacks."""
    profile = value_profile(table, spec.keys, spec.value, weight="n", parts=parts)
    ranks = profile.rows.select(*spec.keys, spec.value, "n", average_rank(profile).alias("cpu_rank"))
    return attach(df, ranks, [*spec.keys, spec.value], weight="n").drop("n")


def normalized(value: Column) -> Column:
    """Min-max scaling; a constant series has no scale and gives null."""
    value = nan_to_null(value)
    return F.try_divide(value - F.col("v_min"), F.col("v_max") - F.col("v_min"))


def deviation(value: Column) -> Column:
    return (nan_to_null(value) - F.col("v_mean")) / (F.col("v_std") + EPSILON)


def min_max_normalize(df: DataFrame, spec: Series = Series()) -> DataFrame:
    joined = attach(df, series_stats(df, spec), list(spec.keys), weight="n_rows")
    return joined.select(
        *df.columns, F.coalesce(normalized(F.col(spec.value)), F.lit(0.0)).alias("cpu_normalized")
    )


def zscore(df: DataFrame, spec: Series = Series()) -> DataFrame:
    """Add `z_score` and its twin `cpu_deviation_from_mean`, computed once."""
    joined = attach(df, series_stats(df, spec), list(spec.keys), weight="n_rows")
    z = deviation(F.col(spec.value))
    return joined.select(*df.columns, z.alias("z_score"), z.alias("cpu_deviation_from_mean"))


def group_deviation(df: DataFrame, group: Column, name: str, spec: Series = Series()) -> DataFrame:
    """Add `name` = value minus the mean of its (series, group)."""
    keyed = df.withColumn("_group", group)
    means = keyed.groupBy(*spec.keys, "_group").agg(
        F.avg(finite(spec.value)).alias("_group_mean"), F.count(F.lit(1)).alias("_group_rows")
    )
    joined = attach(keyed, means, [*spec.keys, "_group"], weight="_group_rows")
    return joined.select(*df.columns, (nan_to_null(spec.value) - F.col("_group_mean")).alias(name))


def hourly_deviation(df: DataFrame, spec: Series = Series()) -> DataFrame:
    """Value minus the series mean at the same hour of day."""
    return group_deviation(df, F.hour(spec.ts), "cpu_deviation_hourly", spec)


def daily_deviation(df: DataFrame, spec: Series = Series()) -> DataFrame:
    """Value minus the series mean on the same date."""
    return group_deviation(df, F.to_date(spec.ts), "cpu_deviation_daily", spec)


def percent_rank(df: DataFrame, spec: Series = Series(), parts: int | None = None) -> DataFrame:
    """Add `cpu_rank`: rank over n with ties at their average; null values have none."""
    profile = value_profile(df, spec.keys, spec.value, parts=parts)
    ranks = profile.rows.select(*spec.keys, spec.value, "n", average_rank(profile).alias("cpu_rank"))
    return attach(df, ranks, [*spec.keys, spec.value], weight="n").drop("n")


def series_quantiles(
    df: DataFrame, wanted: dict[str, float], spec: Series = Series(), parts: int | None = None
) -> DataFrame:
    return quantiles(value_profile(df, spec.keys, spec.value, parts=parts), wanted)


def approximate_quantiles(
    df: DataFrame, wanted: dict[str, float], accuracy: int = 10_000, spec: Series = Series()
) -> DataFrame:
    """One-pass sketch quantiles, each a value of the series, for a first look at very long ones."""
    return df.groupBy(*spec.keys).agg(
        *[F.percentile_approx(finite(spec.value), q, accuracy).alias(n) for n, q in wanted.items()]
    )


def describe(df: DataFrame, spec: Series = Series(), parts: int | None = None) -> DataFrame:
    """count, mean, std, min, exact quartiles and max per series."""
    quartiles = series_quantiles(df, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, spec, parts)
    joined = attach(series_stats(df, spec), quartiles, list(spec.keys))
    return joined.select(
        *spec.keys,
        F.col("n_values").alias("count"),
        F.col("v_mean").alias("mean"),
        F.col("v_std").alias("std"),
        F.col("v_min").alias("min"),
        "p25",
        "p50",
        "p75",
        F.col("v_max").alias("max"),
    )
