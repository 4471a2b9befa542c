"""How a table is read as a set of metric series."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from metricloom.functions.scalar import round2


@dataclass(frozen=True)
class Series:
    """Column roles. `tie` makes the order within one instant total."""

    keys: tuple[str, ...] = ("series_key",)
    ts: str = "ts"
    tie: tuple[str, ...] = ("event_id",)
    value: str = "cpu_utilization"
    label: str = "is_anomaly"

    @property
    def order(self) -> list[str]:
        return [self.ts, *self.tie]


def series_view(events: DataFrame) -> DataFrame:
    """An events table (event_id, ts, event_type, value) as utilisation series in 0-100."""
    return events.select(
        F.col("event_type").alias("series_key"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        # NaN is a missing sample
        F.when(~F.isnan("value"), F.least(round2("value"), F.lit(100.0))).alias("cpu_utilization"),
        (F.col("value") > 120).cast("int").alias("is_anomaly"),
    )
