"""Fills, anomaly runs and latest rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from metricloom.functions.scalar import nan_to_null, position
from metricloom.operators.quality import trailing_range
from metricloom.plans.attach import attach, row_hash
from metricloom.plans.ordered import IDX, PART, RN, Ordered, order_series
from metricloom.series import Series


def fill_chain(
    src: DataFrame | Ordered, columns: list[str], spec: Series = Series(), parts: int | None = None
) -> DataFrame:
    """Forward fill, then backward fill, then 0, per series in time order; null and NaN are filled."""
    ordered = order_series(src, spec, parts)
    payload = [c for c in ordered.rows.columns if c not in (PART, IDX)]
    kinds = dict(ordered.rows.dtypes)
    present = {c: nan_to_null(c) if kinds[c] in ("float", "double") else F.col(c) for c in columns}
    filled = ordered.running(
        {f"_ff_{c}": ("last", v) for c, v in present.items()} | {f"_bf_{c}": ("next", v) for c, v in present.items()}
    )
    values = {c: F.coalesce(F.col(f"_ff_{c}"), F.col(f"_bf_{c}"), F.lit(0).cast(kinds[c])) for c in columns}
    return filled.select(*[values[c].alias(c) if c in values else F.col(c) for c in payload])


def run_length(src: DataFrame | Ordered, spec: Series = Series(), parts: int | None = None) -> DataFrame:
    """Add `run_length`: consecutive anomalies up to and including each row, 0 on normal rows."""
    ordered = order_series(src, spec, parts)
    payload = [c for c in ordered.rows.columns if c not in (PART, IDX)]
    numbered = ordered.with_rows(ordered.numbered())
    normal = F.when(~_anomalous(spec), F.col(RN))
    running = numbered.running({"_last_normal": ("max", normal)})
    length = F.col(RN) - F.coalesce(F.col("_last_normal"), F.lit(-1))
    return running.select(
        *payload, F.when(_anomalous(spec), length).otherwise(F.lit(0)).cast("long").alias("run_length")
    )


def _anomalous(spec: Series) -> Column:
    return F.coalesce(F.col(spec.label) == 1, F.lit(False))


def latest_row(df: DataFrame, spec: Series = Series()) -> DataFrame:
    """The newest row of each series; one of them if several rows share time and tie.

    A hash aggregate finds the newest place of each series; of the rows that stand there, the one with the largest hash
    of all its columns stays.
    """
    keys = list(spec.keys)
    marked = df.withColumn("_at", position(df, spec.ts, spec.tie))
    newest = marked.groupBy(*keys).agg(F.max("_at").alias("_newest"), F.count(F.lit(1)).alias("_n"))
    found = attach(marked, newest, keys, weight="_n").filter(F.col("_at") == F.col("_newest")).select(*df.columns)
    largest = Window.partitionBy(*keys).orderBy(F.desc("_hash"))  # one row per series and task crosses the exchange
    ranked = found.withColumn("_hash", row_hash(found)).withColumn("_nth", F.row_number().over(largest))
    return ranked.filter("_nth = 1").select(*[F.col(f"`{c}`") for c in df.columns])


def current_run(df: DataFrame, spec: Series = Series()) -> DataFrame:
    """Per series: is the newest row anomalous, since when without a break, for how many minutes.

    Two hash aggregates: the newest normal row, then the oldest row after it.
    """
    keys = list(spec.keys)
    rows = df.select(*keys, position(df, spec.ts, spec.tie).alias("_at"), spec.ts, _anomalous(spec).alias("_anomalous"))
    ends = rows.groupBy(*keys).agg(
        F.max(F.when(~F.col("_anomalous"), F.col("_at"))).alias("_newest_normal"), F.count(F.lit(1)).alias("_n")
    )
    joined = attach(rows, ends, keys, weight="_n")
    after = F.col("_newest_normal").isNull() | (F.col("_at") > F.col("_newest_normal"))
    runs = joined.groupBy(*keys).agg(
        F.max(spec.ts).alias("latest_ts"),
        F.min(F.when(after, F.col(spec.ts))).alias("run_start"),
        F.sum(after.cast("int")).alias("run_rows"),
    )
    minutes = (
        F.unix_micros(F.col("latest_ts").cast("timestamp")) - F.unix_micros(F.col("run_start").cast("timestamp"))
    ) / 6e7
    return runs.select(
        *keys,
        "latest_ts",
        (F.col("run_rows") > 0).cast("int").alias("is_anomalous"),
        "run_start",
        "run_rows",
        F.coalesce(minutes, F.lit(0.0)).alias("run_minutes"),
    )


def union_labels(
    series: DataFrame | Ordered,
    marks: list[DataFrame],
    spread: int = 0,
    spec: Series = Series(),
    parts: int | None = None,
) -> DataFrame:
    """Add `is_marked`: some label source marks the row, or one within `spread` rows of it.

    Each source holds the key and order columns of the rows it marks.
    """
    ordered = order_series(series, spec, parts)
    payload = [c for c in ordered.rows.columns if c not in (PART, IDX)]
    on = [*spec.keys, *spec.order]
    union = reduce(DataFrame.unionByName, [m.select(*on) for m in marks]).distinct()
    marked = attach(ordered.rows, union.withColumn("_mark", F.lit(1)), on)
    dealt = ordered.with_rows(marked).chunked(back=spread, ahead=spread)
    near = F.max("_mark").over(ordered.chunk_window().rowsBetween(-spread, spread))
    return (
        dealt.withColumn("is_marked", F.coalesce(near, F.lit(0)).cast("int"))
        .filter("_home = _chunk")
        .select(*payload, "is_marked")
    )


def recent_status(
    df: DataFrame, minutes: int = 15, spec: Series = Series()
) -> DataFrame:
    """The last minutes of all series with the value split into one column per status."""
    recent = trailing_range(df, minutes / 60, spec.ts)
    v, status = F.col(spec.value), F.col(spec.label)
    return recent.select(
        *spec.keys,
        *spec.order,
        F.when(status == 0, v).alias("status_0"),
        F.when(status == 1, v).alias("status_1"),
    )
