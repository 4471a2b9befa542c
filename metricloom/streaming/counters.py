"""Utilisation from counters, and evaluation on a fixed step.

A step evaluation looks back: the value at step t is that of the newest sample at or before t, unless it is older than
the lookback; a rate at t is that of the samples in the range before t. Nothing is joined for it: a sample knows from
its neighbours at which steps it is the newest or the oldest one of a range, and is unfolded to those steps alone. So
the cost is linear in samples and steps, and no series has to fit a task.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

from metricloom.functions.scalar import nan_to_null, position
from metricloom.plans.ordered import CHUNK, HOME, RN, Ordered, lay_out
from metricloom.plans.workspace import materialize

_MICROS = 1_000_000
STALE_SECONDS = 300


def counter_rate_utilization(
    samples: DataFrame,
    labels: list[str],
    cpu: str = "cpu",
    ts: str = "ts",
    counter: str = "seconds_total",
    width: str = "1 minute",
    tie: list[str] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """(labels, window_start, utilization): 100 * (1 - mean over cpus of the idle-seconds rate).

    A counter that went down was reset: its new value is the increase since then.
    """
    ordered = lay_out(samples, [*labels, cpu], [ts, *(tie or [])], parts)
    dealt = ordered.chunked(back=1)
    series = ordered.chunk_window()
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    before, before_at = F.lag(counter).over(series), F.lag(micros).over(series)
    steps = (
        dealt.withColumns({"_before": before, "_dt": (micros - before_at) / 1e6})
        .filter((F.col(HOME) == F.col(CHUNK)) & F.col("_before").isNotNull())
        .withColumn(
            "_up",
            F.when(F.col(counter) < F.col("_before"), F.col(counter)).otherwise(F.col(counter) - F.col("_before")),
        )
    )
    window = F.window(F.col(ts).cast("timestamp"), width)
    rates = steps.groupBy(*labels, cpu, window.alias("_w")).agg(
        F.try_divide(F.sum("_up"), F.sum("_dt")).alias("_rate")
    )
    return rates.groupBy(*labels, F.col("_w.start").alias("window_start")).agg(
        ((1 - F.avg("_rate")) * 100).alias("utilization")
    )


def range_grid(
    df: DataFrame,
    keys: list[str],
    ts: str = "ts",
    value: str = "cpu_utilization",
    tie: list[str] | None = None,
    step_seconds: int = 30,
    fill_gaps: bool = False,
) -> DataFrame:
    """(keys, step_start, value): the newest sample of every step, and null steps for gaps if asked."""
    at = F.unix_timestamp(F.col(ts).cast("timestamp"))
    slot = F.floor(at / step_seconds).alias("_slot")
    points = df.groupBy(*keys, slot).agg(F.max_by(value, position(df, ts, tie or [])).alias(value))
    if fill_gaps:
        points = _all_slots(points, keys, value)
    return points.select(
        *keys, F.timestamp_seconds(F.col("_slot") * step_seconds).alias("step_start"), value
    )


def _micros(at: datetime | float) -> int:
    """Epoch microseconds of a moment: seconds, or a datetime, read as UTC if it has no zone."""
    if isinstance(at, datetime):
        at = (at if at.tzinfo else at.replace(tzinfo=timezone.utc)).timestamp()
    return round(at * _MICROS)


def _bounds(df: DataFrame, ts: str, start, end) -> tuple[int, int] | None:
    """The first and the last moment to evaluate; those of the samples where none is given."""
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    low, high = (None, None) if start is not None and end is not None else df.agg(F.min(at), F.max(at)).first()
    low, high = low if start is None else _micros(start), high if end is None else _micros(end)
    return None if low is None or high is None else (low, high)


def _steps(first: Column, beyond: Column, step: int, low: int, high: int) -> Column:
    """The numbers of the steps from `first` up to, not including, `beyond`; none is an empty array."""
    one = F.greatest(F.ceil(first / step), F.lit(-(-low // step)).cast("long"))
    last = F.least(F.ceil(beyond / step) - 1, F.lit(high // step).cast("long"))
    return F.when(one <= last, F.sequence(one, last)).otherwise(F.expr("cast(array() as array<bigint>)"))


def _with_neighbours(ordered: Ordered, at: Column) -> DataFrame:
    """Rows with `_at` and that of the rows before and behind, across the borders of parts."""
    window = ordered.chunk_window()
    dealt = ordered.chunked(back=1, ahead=1).withColumn("_at", at)
    return dealt.withColumns({"_last": F.lag("_at").over(window), "_next": F.lead("_at").over(window)}).filter(F.col(HOME) == F.col(CHUNK))


def range_at_steps(
    df: DataFrame,
    keys: list[str],
    ts: str = "ts",
    value: str = "cpu_utilization",
    tie: list[str] | None = None,
    step_seconds: int = 30,
    lookback_seconds: int = STALE_SECONDS,
    start: datetime | float | None = None,
    end: datetime | float | None = None,
    parts: int | None = None,
) -> DataFrame:
    """(keys, step_at, value, age_seconds): the newest sample at or before each step and younger than the lookback.

    Steps are multiples of `step_seconds` between `start` and `end`, by default the oldest and the newest sample of all
    series. A series has no row at a step that no sample reaches. Of samples at one instant the last by tie counts;
    rows without a time or a value are no samples.
    """
    step, kept = step_seconds * _MICROS, lookback_seconds * _MICROS
    samples = df.filter(F.col(ts).isNotNull() & nan_to_null(value).isNotNull())
    bounds = _bounds(samples, ts, start, end)
    if bounds is None:
        return samples.limit(0).select(*keys, F.col(ts).cast("timestamp").alias("step_at"), value, F.lit(0.0).alias("age_seconds"))
    ordered = lay_out(samples, keys, [ts, *(tie or [])], parts)
    rows = _with_neighbours(ordered, F.unix_micros(F.col(ts).cast("timestamp")))
    at, beyond = F.col("_at"), F.col("_at") + kept
    unfolded = rows.withColumn("_step", F.explode(_steps(at, F.least(beyond, F.col("_next")), step, *bounds)))
    moment = F.col("_step") * step
    return unfolded.select(*keys, F.timestamp_micros(moment).alias("step_at"), value, ((moment - at) / _MICROS).alias("age_seconds"))


def counter_rate_at_steps(
    samples: DataFrame,
    labels: list[str],
    cpu: str = "cpu",
    ts: str = "ts",
    counter: str = "seconds_total",
    step_seconds: int = 30,
    range_seconds: int = 60,
    start: datetime | float | None = None,
    end: datetime | float | None = None,
    tie: list[str] | None = None,
    extrapolate: bool = True,
    parts: int | None = None,
) -> DataFrame:
    """(labels, step_at, utilization): 100 * (1 - mean over cpus of the rate in the range that ends at each step).

    A range holds the samples later than `range_seconds` before the step, up to the step, and needs two of them. A
    counter that went down was reset: its new value is the increase since then. With `extrapolate` the increase is
    carried to the ends of the range, by half a sample distance at most where the next sample is further away than 1.1
    distances, and never back beyond the zero of the counter; without, it is divided by the time between the samples.
    """
    step, reach = step_seconds * _MICROS, range_seconds * _MICROS
    present = samples.filter(F.col(ts).isNotNull() & nan_to_null(counter).isNotNull())
    bounds = _bounds(present, ts, start, end)
    if bounds is None:
        return present.limit(0).select(*labels, F.col(ts).cast("timestamp").alias("step_at"), F.lit(0.0).alias("utilization"))
    series = [*labels, cpu]
    ordered = lay_out(present, series, [ts, *(tie or [])], parts)
    window, c = ordered.chunk_window(), F.col(counter).cast("double")
    dealt = ordered.chunked(back=1).withColumns({"_c": c, "_was": F.lag(c).over(window)}).filter(F.col(HOME) == F.col(CHUNK))
    gained = F.when(F.col("_was").isNull(), 0.0).when(F.col("_c") < F.col("_was"), F.col("_c")).otherwise(F.col("_c") - F.col("_was"))
    risen = ordered.with_rows(materialize(dealt.withColumn("_up", gained).select(*ordered.rows.columns, "_up", RN), "risen"))
    risen = risen.with_rows(risen.running({"_total": ("sum", F.col("_up"))}).drop("_up").withColumnRenamed(RN, "_number"))
    rows = _with_neighbours(risen, F.unix_micros(F.col(ts).cast("timestamp")))
    at, gone = F.col("_at"), F.col("_at") + reach  # a sample leaves the range at the step that lies `reach` behind it
    newest = _steps(at, F.least(gone, F.coalesce(F.col("_next"), gone)), step, *bounds)
    oldest = _steps(F.greatest(at, F.coalesce(F.col("_last") + reach, at)), gone, step, *bounds)
    sample = F.struct(F.col("_number").alias("n"), at.alias("at"), F.col("_total").alias("total"), F.col(counter).cast("double").alias("c"))
    side = lambda steps, newer: F.transform(steps, lambda s: F.struct(s.alias("step"), F.lit(newer).alias("newer")))
    ends = rows.select(*series, sample.alias("s"), F.explode(F.concat(side(newest, True), side(oldest, False))).alias("e"))
    ranges = ends.groupBy(*series, F.col("e.step").alias("_step")).agg(
        F.max(F.when(~F.col("e.newer"), F.col("s"))).alias("a"), F.max(F.when(F.col("e.newer"), F.col("s"))).alias("b")
    )
    # samples of one instant: the range starts with the first of them, which its number tells
    ranges = ranges.filter(F.col("b.n") > F.col("a.n"))
    increase, between = F.col("b.total") - F.col("a.total"), (F.col("b.at") - F.col("a.at")) / _MICROS
    if extrapolate:
        moment = F.col("_step") * step
        each = between / (F.col("b.n") - F.col("a.n"))
        left, right = (F.col("a.at") - (moment - reach)) / _MICROS, (moment - F.col("b.at")) / _MICROS
        left, right = (F.when(d >= each * 1.1, each / 2).otherwise(d) for d in (left, right))
        zero = F.when((increase > 0) & (F.col("a.c") >= 0), between * F.col("a.c") / increase)
        rate = F.try_divide(increase * (between + F.least(left, zero) + right), between * range_seconds)
    else:
        rate = F.try_divide(increase, between)
    rates = ranges.select(*series, "_step", rate.alias("_rate"))
    return rates.groupBy(*labels, F.timestamp_micros(F.col("_step") * step).alias("step_at")).agg(
        ((1 - F.avg("_rate")) * 100).alias("utilization")
    )


_RUN = 10_000


def _all_slots(points: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Every slot from a series' first to its last, unfolded in two steps to spread long series."""
    ends = points.groupBy(*keys).agg(F.min("_slot").alias("_lo"), F.max("_slot").alias("_hi"))
    runs = ends.withColumn(
        "_run", F.explode(F.sequence(F.floor(F.col("_lo") / _RUN), F.floor(F.col("_hi") / _RUN)))
    ).repartition(*keys, "_run")
    first = F.greatest("_lo", F.col("_run") * _RUN)
    last = F.least("_hi", F.col("_run") * _RUN + (_RUN - 1))
    empty = runs.select(*keys, F.explode(F.sequence(first, last)).alias("_slot"), F.lit(None).alias(value))
    # A slot has at most one point, so the non-null one wins: one aggregate instead of a join.
    return points.unionByName(empty).groupBy(*keys, "_slot").agg(F.max(value).alias(value))
