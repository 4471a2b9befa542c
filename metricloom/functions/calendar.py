"""Time parsing and calendar features, all in the session time zone (UTC)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from metricloom.plans.attach import attach

from metricloom.functions.scalar import flag

MILLIS_FROM = 1e10


def epoch_to_ts(c: str | Column) -> Column:
    return F.timestamp_seconds(c)


def ts_to_epoch(c: str | Column) -> Column:
    return F.unix_timestamp(F.col(c).cast("timestamp") if isinstance(c, str) else c.cast("timestamp"))


def calendar_columns(ts: str) -> dict[str, Column]:
    hour, weekday = F.hour(ts), F.weekday(ts)
    return {
        "hour": hour,
        "weekday": weekday,
        "minute": F.minute(ts),
        "is_weekend": flag(weekday >= 5),
        "is_business_hour": flag(hour.between(9, 17)),
        "is_peak_hour": flag(hour.between(10, 16)),
    }


def calendar_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    """hour, weekday (Monday 0), minute, weekend, business hour 9-17, peak hour 10-16, date."""
    return df.withColumns({**calendar_columns(ts), "date": F.to_date(ts)})


def cyclic_hour(hour: str | Column = "hour") -> dict[str, Column]:
    turn = (F.col(hour) if isinstance(hour, str) else hour) * F.lit(2 * math.pi / 24)
    return {"hour_sin": F.sin(turn), "hour_cos": F.cos(turn)}


POINT_FEATURES = ["cpu_usage", "hour", "weekday", "is_weekend", "hour_sin", "hour_cos"]


def point_features(df: DataFrame, epoch: str, value: str) -> DataFrame:
    """Six features of a point, from its epoch seconds and its value."""
    ts = epoch_to_ts(epoch)
    hour, weekday = F.hour(ts), F.weekday(ts)
    return df.withColumns(
        {
            "cpu_usage": F.col(value),
            "hour": hour,
            "weekday": weekday,
            "is_weekend": flag(weekday >= 5),
            **cyclic_hour(hour),
        }
    )


def to_time_index(df: DataFrame, keys: tuple[str, ...] = (), unit: str | None = None) -> DataFrame:
    """Add `datetime` as a timestamp, from `datetime` or from epoch `timestamp`.

    `unit` ("s" or "ms") says what the epochs are. Without it they are read as milliseconds when the
    largest one exceeds 1e10, decided per series if `keys` name one, so that a series does not move
    with the epochs of another. Unreadable epochs and texts become null; the caller's windows and
    sinks do the ordering.
    """
    if "datetime" in df.columns:
        kind = dict(df.dtypes)["datetime"]
        text = F.expr("try_cast(datetime AS timestamp)") if kind == "string" else F.col("datetime").cast("timestamp")
        return df.withColumn("datetime", text)
    if "timestamp" not in df.columns:
        raise ValueError("need a 'datetime' or a 'timestamp' column")
    epoch = F.expr("try_cast(`timestamp` AS double)")
    if unit not in (None, "s", "ms"):
        raise ValueError("unit is 's', 'ms' or None")
    marked = df
    if unit is None and keys:
        largest = df.groupBy(*keys).agg(F.max(epoch).alias("_largest"), F.count(F.lit(1)).alias("_n"))
        marked = attach(df, largest, list(keys), weight="_n")
        scale = F.when(F.col("_largest") > MILLIS_FROM, 1e3).otherwise(1e6)
    else:
        if unit is None:
            most = df.agg(F.max(epoch)).first()[0]
            unit = "ms" if most is not None and most > MILLIS_FROM else "s"
        scale = F.lit(1e3 if unit == "ms" else 1e6)
    micros = (epoch * scale).cast("long")
    timed = marked.withColumn("datetime", F.timestamp_micros(micros)).withColumn("timestamp", epoch.cast("long"))
    return timed.select(*df.columns, "datetime")
