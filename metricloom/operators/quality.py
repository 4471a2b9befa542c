"""Data-quality metrics and reports, one row per series.

NaN counts as missing; means, extremes and deviations leave infinities out too, which range checks count as invalid.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from metricloom.functions.scalar import finite, missing, out_of_range
from metricloom.plans.ordered import lay_out
from metricloom.series import Series


def require_columns(df: DataFrame, columns, check_empty: bool = False) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    if check_empty and df.isEmpty():
        raise ValueError("input is empty")
    return df


def completeness(df: DataFrame, spec: Series = Series()) -> DataFrame:
    """Percent complete: missing cells over rows (may go below 0), and over cells."""
    cells = [c for c in df.columns if c not in spec.keys]
    nulls, rows = F.sum(_missing_cells(df, cells)), F.count(F.lit(1))
    return df.groupBy(*spec.keys).agg(
        ((1 - nulls / rows) * 100).alias("completeness"),
        ((1 - nulls / (rows * len(cells))) * 100).alias("completeness_by_cell"),
    )


def _missing_cells(df: DataFrame, cells: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [missing(df, c).cast("int") for c in cells])


def _gap(spec: Series) -> Column:
    """Mean minutes between anomalies: consecutive gaps add up to last minus first."""
    at = F.when(F.col(spec.label) == 1, F.unix_micros(F.col(spec.ts).cast("timestamp")))
    return F.coalesce(
        F.try_divide(F.max(at) - F.min(at), (F.count(at) - 1) * F.lit(60_000_000)), F.lit(-1.0)
    )


def anomaly_gap(df: DataFrame, spec: Series = Series()) -> DataFrame:
    """Mean minutes between consecutive anomalies, -1 with fewer than two."""
    return df.groupBy(*spec.keys).agg(_gap(spec).alias("avg_anomaly_gap_min"))


def validity(df: DataFrame, spec: Series = Series()) -> DataFrame:
    return df.groupBy(*spec.keys).agg(
        (F.avg((~out_of_range(spec.value)).cast("int")) * 100).alias("validity")
    )


def invalid_rows(df: DataFrame, spec: Series = Series()) -> DataFrame:
    """Rows whose value lies outside 0-100."""
    return df.filter(out_of_range(spec.value))


def anomaly_ratio(df: DataFrame, spec: Series = Series()) -> DataFrame:
    ratio = F.avg(spec.label)
    return df.groupBy(*spec.keys).agg(
        (ratio * 100).alias("anomaly_ratio"), ratio.between(0.05, 0.15).cast("int").alias("anomaly_ratio_ok")
    )


def _workday_difference(spec: Series) -> Column:
    weekend = F.weekday(spec.ts) >= 5
    return F.avg(F.when(~weekend, finite(spec.value))) - F.avg(F.when(weekend, finite(spec.value)))


def workday_difference(df: DataFrame, spec: Series = Series()) -> DataFrame:
    """Mean on Monday-Friday minus mean on Saturday-Sunday; null when one side is empty."""
    return df.groupBy(*spec.keys).agg(_workday_difference(spec).alias("workday_difference"))


def daily_variation(df: DataFrame, spec: Series = Series()) -> DataFrame:
    """Largest minus smallest hour-of-day mean."""
    hourly = df.groupBy(*spec.keys, F.hour(spec.ts).alias("_hour")).agg(F.avg(finite(spec.value)).alias("_mean"))
    return (
        hourly.filter(F.col("_hour").isNotNull())
        .groupBy(*spec.keys)
        .agg((F.max("_mean") - F.min("_mean")).alias("daily_variation"))
    )


def time_continuity(df: DataFrame, spec: Series = Series()) -> DataFrame:
    """1 where the sorted time axis is non-decreasing, which only a missing time can break."""
    return df.groupBy(*spec.keys).agg(
        (F.count(spec.ts) == F.count(F.lit(1))).cast("int").alias("time_continuity")
    )


def row_gaps(df: DataFrame, spec: Series = Series(), parts: int | None = None) -> DataFrame:
    """Add `gap_seconds` to the previous row of the series (null on the first)."""
    ordered = lay_out(df, spec.keys, spec.order, parts)
    micros = F.unix_micros(F.col(spec.ts).cast("timestamp"))
    return _previous(ordered, micros, "_before").select(
        *df.columns, ((micros - F.col("_before")) / 1e6).alias("gap_seconds")
    )


def out_of_order(df: DataFrame, arrival: list[str], spec: Series = Series(), parts: int | None = None) -> DataFrame:
    """Rows per series that arrived with a time before the one that arrived just ahead."""
    ordered = lay_out(df, spec.keys, arrival, parts)
    late = F.col(spec.ts) < F.col("_before")
    return _previous(ordered, F.col(spec.ts), "_before").groupBy(*spec.keys).agg(
        F.sum(F.coalesce(late, F.lit(False)).cast("int")).alias("n_out_of_order")
    )


def _previous(ordered, expr: Column, name: str) -> DataFrame:
    """Value of `expr` on the previous row, across part borders."""
    dealt = ordered.chunked(back=1)
    return dealt.withColumn(name, F.lag(expr).over(ordered.chunk_window())).filter("_home = _chunk")


def quality_report(df: DataFrame, spec: Series = Series()) -> DataFrame:
    """Nine metrics and six pass flags per series, in one pass over the rows.

    Rows are reduced to (series, hour of day) first; the daily variation needs those means and
    everything else folds up from sums and extremes, so a hot series is already small by then.
    """
    require_columns(df, [*spec.keys, spec.ts, spec.value, spec.label])
    v, label = finite(spec.value), F.col(spec.label)
    weekend = F.weekday(spec.ts) >= 5
    at = F.when(label == 1, F.unix_micros(F.col(spec.ts).cast("timestamp")))
    cells = [c for c in df.columns if c not in spec.keys]
    nulls = _missing_cells(df, cells)
    hourly = df.groupBy(*spec.keys, F.hour(spec.ts).alias("_hour")).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(nulls).alias("_nulls"),
        F.sum(out_of_range(spec.value).cast("int")).alias("_invalid"),
        F.sum(label).alias("_label_sum"),
        F.count(label).alias("_labels"),
        F.avg(v).alias("_mean"),
        F.sum(F.when(~weekend, v)).alias("_work_sum"),
        F.count(F.when(~weekend, v)).alias("_work_n"),
        F.sum(F.when(weekend, v)).alias("_rest_sum"),
        F.count(F.when(weekend, v)).alias("_rest_n"),
        F.min(at).alias("_first"),
        F.max(at).alias("_last"),
        F.count(at).alias("_marked"),
        F.sum((label == 1).cast("int")).alias("_anomalies"),
        F.count(spec.ts).alias("_timed"),
    )
    rows = F.sum("_rows")
    ratio = F.try_divide(F.sum("_label_sum"), F.sum("_labels"))
    known_hour = F.when(F.col("_hour").isNotNull(), F.col("_mean"))
    report = hourly.groupBy(*spec.keys).agg(
        ((1 - F.sum("_nulls") / rows) * 100).alias("completeness"),
        ((1 - F.sum("_nulls") / (rows * len(cells))) * 100).alias("completeness_by_cell"),
        ((rows - F.sum("_invalid")) / rows * 100).alias("validity"),
        (ratio * 100).alias("anomaly_ratio"),
        (
            F.try_divide(F.sum("_work_sum"), F.sum("_work_n")) - F.try_divide(F.sum("_rest_sum"), F.sum("_rest_n"))
        ).alias("workday_difference"),
        (F.max(known_hour) - F.min(known_hour)).alias("daily_variation"),
        F.coalesce(
            F.try_divide(F.max("_last") - F.min("_first"), (F.sum("_marked") - 1) * F.lit(60_000_000)),
            F.lit(-1.0),
        ).alias("avg_anomaly_gap_min"),
        F.coalesce(F.sum("_anomalies"), F.lit(0)).alias("n_anomalies"),
        rows.alias("n_total"),
        (F.sum("_timed") == rows).cast("int").alias("time_continuity"),
    )

    def ok(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("int")

    return report.withColumns(
        {
            "continuity_ok": ok(F.col("time_continuity") == 1),
            "validity_ok": ok(F.col("validity") == 100),
            "anomaly_ratio_ok": ok(F.col("anomaly_ratio").between(5, 15)),
            "workday_ok": ok(F.col("workday_difference") > 5),
            "daily_variation_ok": ok(F.col("daily_variation") > 20),
            "anomaly_gap_ok": ok(F.col("avg_anomaly_gap_min") > 60),
        }
    )


def dataset_report(df: DataFrame, spec: Series = Series()) -> DataFrame:
    """Rows, time span, class counts and ratios, mean, min, max, population std per series."""
    anomalies = F.sum((F.col(spec.label) == 1).cast("int"))
    rows, v = F.count(F.lit(1)), finite(spec.value)
    return df.groupBy(*spec.keys).agg(
        rows.alias("n_total"),
        F.min(spec.ts).alias("first_ts"),
        F.max(spec.ts).alias("last_ts"),
        (rows - anomalies).alias("n_normal"),
        anomalies.alias("n_anomaly"),
        ((rows - anomalies) / rows).alias("normal_ratio"),
        (anomalies / rows).alias("anomaly_ratio"),
        F.avg(v).alias("mean"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.stddev_pop(v).alias("std_pop"),
    )


def preview(df: DataFrame, n: int = 10, spec: Series = Series()) -> DataFrame:
    """The n earliest rows over all series."""
    return df.orderBy(spec.ts, *spec.tie).limit(n)


def trailing_range(df: DataFrame, hours: float, ts: str = "ts") -> DataFrame:
    """Rows of the last `hours`, by a literal bound so that partitions and files can be pruned."""
    # As text in the session time zone: a Python datetime would pass through the host's zone.
    latest = df.agg(F.max(ts).cast("string")).first()[0]
    if latest is None:
        return df.limit(0)
    bound = F.lit(latest).cast(dict(df.dtypes)[ts]) - F.make_dt_interval(secs=F.lit(hours * 3600.0))
    return df.filter(F.col(ts) >= bound)


def label_summary(df: DataFrame, columns: list[str], spec: Series = Series(), by: list[str] | None = None) -> DataFrame:
    """Rows, missing values over `columns` and label mean, by split when `by` names one."""
    cells = _missing_cells(df, columns)
    return df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(cells).alias("n_missing"),
        F.avg(spec.label).alias("label_mean"),
    )
