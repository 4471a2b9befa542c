"""The 64 features of a sample, as one plan per batch."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from metricloom.functions.calendar import calendar_columns
from metricloom.functions.scalar import finite, flag, threshold_flags
from metricloom.operators.detectors import (
    consensus, flag_lowest, isolation_forest_flag, isolation_scores, iqr_flag, lof_flag, lof_scores, outside_fences,
    zscore_flag,
)
from metricloom.operators.frame_arrays import framed
from metricloom.operators.rolling import (
    STATS, STREAKS, WINDOWS, Track, add_rolling, anomaly_counts, coefficient_of_variation, high_usage_counts,
    rolling_stats,
)
from metricloom.operators.runs import fill_chain
from metricloom.operators.stats import (
    daily_deviation, deviation, hourly_deviation, min_max_normalize, normalized, percent_rank, series_stats, zscore,
)
from metricloom.plans.attach import attach, null_safe_join
from metricloom.plans.ordered import CHUNK, CHUNK_ROWS, HOME, IDX, PART, Ordered, order_series
from metricloom.plans.profile import ValueProfile, average_rank, quantiles, value_profile
from metricloom.plans.workspace import materialize
from metricloom.series import Series

# The feature names.
BASIC = [
    "cpu_normalized", "cpu_rank", "cpu_deviation_from_mean", "cpu_deviation_hourly", "cpu_deviation_daily",
    "is_high_usage", "is_very_high_usage", "is_low_usage",
]
CALENDAR = ["hour", "weekday", "minute", "is_weekend", "is_business_hour", "is_peak_hour"]
DETECTOR = [
    "iso_forest_anomaly", "lof_anomaly", "z_score", "z_score_anomaly", "iqr_anomaly", "algorithm_consensus",
    "algorithm_agreement",
]


def feature_names(windows=WINDOWS) -> list[str]:
    """Feature columns in model order; 64 with the default windows."""
    return [
        *BASIC,
        *[f"{w}min_{s}" for w in windows for s in STATS],
        *CALENDAR,
        *DETECTOR,
        "iso_x_deviation",
        "lof_x_zscore",
        *[f"high_usage_streak_{n}" for n in STREAKS],
        *[f"anomaly_streak_{n}" for n in STREAKS],
        *[f"{w}min_cv" for w in windows if w >= 15],
    ]


def fit_stats(
    df: DataFrame, spec: Series = Series(), parts: int | None = None, profile: ValueProfile | None = None
) -> DataFrame:
    """Per-series statistics that scoring can reuse: sizes, min, max, mean, std, quartiles."""
    profile = profile or value_profile(df, spec.keys, spec.value, parts=parts)
    quartiles = quantiles(profile, {"q1": 0.25, "q3": 0.75})
    distinct = profile.rows.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("n_distinct"))
    stats = null_safe_join(series_stats(df, spec), quartiles, list(spec.keys))
    return materialize(null_safe_join(stats, distinct, list(spec.keys)), "stats")


def value_features(
    profile: ValueProfile,
    stats: DataFrame,
    spec: Series = Series(),
    contamination: float = 0.1,
    neighbours: int = 20,
    seed: int = 42,
    parts: int | None = None,
) -> DataFrame:
    """All that follows from a sample's value alone: one written row per (series, value)."""
    keys, name = list(spec.keys), spec.value
    scored = {
        "lof_anomaly": lof_scores(profile, neighbours),
        "iso_forest_anomaly": isolation_scores(profile, seed=seed, parts=parts),
    }
    tagged = reduce(DataFrame.unionByName, [s.withColumn("_detector", F.lit(d)) for d, s in scored.items()])
    flagged = flag_lowest(tagged, [*keys, "_detector"], name, "_flag", contamination, parts)
    votes = flagged.groupBy(*keys, name).agg(
        *[F.max(F.when(F.col("_detector") == d, F.col("_flag"))).alias(d) for d in scored]
    )
    table = profile.rows.select(*keys, name, "n", average_rank(profile).alias("cpu_rank"))
    table = null_safe_join(table, votes, [*keys, name])
    table = attach(table, stats, keys, weight="n_distinct", written=True)
    value = F.col(name)
    z = deviation(value)
    table = table.select(
        *keys,
        name,
        "n",
        "cpu_rank",
        F.coalesce(normalized(value), F.lit(0.0)).alias("cpu_normalized"),
        F.coalesce(z, F.lit(0.0)).alias("cpu_deviation_from_mean"),
        F.coalesce(z, F.lit(0.0)).alias("z_score"),
        flag(F.abs(z) > 3).alias("z_score_anomaly"),
        outside_fences(value).alias("iqr_anomaly"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("iso_forest_anomaly", "lof_anomaly")],
    )
    table = consensus(table).withColumns(
        {
            "iso_x_deviation": F.col("iso_forest_anomaly") * F.col("cpu_deviation_from_mean"),
            "lof_x_zscore": F.col("lof_anomaly") * F.col("z_score"),
        }
    )
    return materialize(table, "value_features")


def _calendar_means(rows: DataFrame, spec: Series) -> tuple[DataFrame, DataFrame, bool]:
    """Mean per (series, hour of day) and per (series, date), and whether labels are missing, from one pass over the rows."""
    keys, v = list(spec.keys), finite(spec.value)
    label = spec.label if spec.label in rows.columns else F.lit(1)
    cells = materialize(
        rows.groupBy(*keys, F.to_date(spec.ts).alias("_date"), F.hour(spec.ts).alias("_hour")).agg(
            F.sum(v).alias("_sum"), F.count(v).alias("_n"), F.count(F.lit(1)).alias("_rows"),
            F.count(label).alias("_labels"),
        ),
        "cells",
    )

    def fold(group: str, name: str) -> DataFrame:
        mean = F.try_divide(F.sum("_sum"), F.sum("_n"))
        return cells.groupBy(*keys, group).agg(mean.alias(name), F.sum("_rows").alias(f"{name}_rows"))

    return fold("_hour", "_hour_mean"), fold("_date", "_date_mean"), not cells.filter("_labels < _rows").isEmpty()


def all_features(
    src: DataFrame | Ordered,
    windows=WINDOWS,
    spec: Series = Series(),
    rows_per_minute: int = 1,
    stats: DataFrame | None = None,
    contamination: float = 0.1,
    neighbours: int = 20,
    seed: int = 42,
    parts: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Input columns plus every feature of `feature_names(windows)`.

    `stats` (from `fit_stats`) replaces the batch's own statistics, to score against a training
    set. The rows are laid out by time once; value features and calendar means are attached, and
    all windows share one shuffle and one sort.
    """
    keys, v = list(spec.keys), F.col(spec.value)
    ordered = order_series(src, spec, parts)
    rows = ordered.rows
    payload = [c for c in rows.columns if c not in (PART, IDX)]
    profile = value_profile(rows, keys, spec.value, parts=parts)
    own = fit_stats(rows, spec, parts, profile)
    by_value = value_features(
        profile, own if stats is None else stats, spec, contamination, neighbours, seed, parts
    )
    by_hour, by_date, unlabelled = _calendar_means(rows, spec)

    enriched = attach(rows, by_value, [*keys, spec.value], weight="n", written=True).drop("n")
    enriched = enriched.withColumns(
        {**calendar_columns(spec.ts), "_hour": F.hour(spec.ts), "_date": F.to_date(spec.ts), **threshold_flags(spec.value)}
    )
    enriched = attach(enriched, by_hour, [*keys, "_hour"], weight="_hour_mean_rows", written=True)
    enriched = attach(enriched, by_date, [*keys, "_date"], weight="_date_mean_rows", written=True)
    enriched = enriched.withColumns(
        {
            "cpu_deviation_hourly": v - F.col("_hour_mean"),
            "cpu_deviation_daily": v - F.col("_date_mean"),
            **{c: F.coalesce(c, F.lit(0)) for c in DETECTOR if c != "z_score"},
        }
    ).drop("_hour", "_date", "_hour_mean", "_date_mean", "_hour_mean_rows", "_date_mean_rows")

    frames, features = {w: w * rows_per_minute for w in windows}, feature_names(windows)
    reach = max(*frames.values(), *STREAKS) - 1
    dealt = ordered.with_rows(enriched).chunked(reach, chunk_rows=chunk_rows)
    holes = [spec.value, *features] if not own.filter("n_values < n_rows").isEmpty() else []
    holes += [spec.label] if unlabelled else []
    flags = {"high_usage_streak": "is_high_usage", "anomaly_streak": "algorithm_agreement"}
    if dict(dealt.dtypes)[spec.value] == "double":
        dealt = framed(dealt, keys, spec.value, frames, {name: (source, STREAKS) for name, source in flags.items()}, STATS)
    else:
        streaks = {name: Track(F.col(source).cast("long"), STREAKS) for name, source in flags.items()}
        dealt = add_rolling(dealt, keys, spec.value, frames, STATS, streaks)
        dealt = dealt.withColumnsRenamed({f"_{name}_w{n}": f"{name}_{n}" for name in flags for n in STREAKS})
        dealt = dealt.filter(F.col(HOME) == F.col(CHUNK))
    dealt = coefficient_of_variation(dealt, windows)

    if not holes:
        return dealt.select(*payload, *features)
    holed = materialize(dealt.select(*payload, PART, IDX, *features), "features")
    return fill_chain(ordered.with_rows(holed), holes, spec)


Feature = Callable[..., DataFrame]

REGISTRY: dict[str, Feature] = {
    "min_max_normalize": min_max_normalize,
    "zscore": zscore,
    "percent_rank": percent_rank,
    "hourly_deviation": hourly_deviation,
    "daily_deviation": daily_deviation,
    "rolling_stats": rolling_stats,
    "high_usage_counts": high_usage_counts,
    "anomaly_counts": anomaly_counts,
    "isolation_forest_flag": isolation_forest_flag,
    "lof_flag": lof_flag,
    "zscore_flag": zscore_flag,
    "iqr_flag": iqr_flag,
    "fill_chain": fill_chain,
    "all_features": all_features,
}


def register_feature(name: str, feature: Feature) -> None:
    """Add a feature: a function of a DataFrame and keyword parameters that returns a DataFrame."""
    if name in REGISTRY:
        raise ValueError(f"feature {name!r} exists")
    REGISTRY[name] = feature


def apply_features(df: DataFrame, wanted: dict[str, dict]) -> DataFrame:
    """Apply registered features in the order given, each with its own parameters."""
    for name, parameters in wanted.items():
        df = REGISTRY[name](df, **parameters)
    return df
