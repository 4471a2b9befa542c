"""Time the headline queries: one JSON line, seconds per query after one warm-up run of the session."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession, functions as F  # noqa: E402

from metricloom import series_view  # noqa: E402
from metricloom.catalog.queries import QUERIES, _live_scorer  # noqa: E402
from metricloom.operators.rolling import rolling_by_time  # noqa: E402
from metricloom.plans.workspace import drop_workspace, fresh_path  # noqa: E402
from metricloom.session import local_session  # noqa: E402
from metricloom.streaming import live  # noqa: E402

HEADLINE = [
    "rolling_stats_5", "rolling_stats_60", "rolling_trend", "rolling_long_frames", "rolling_time_range_60",
    "usage_streak", "calendar_features", "zscore", "hourly_deviation", "pct_rank", "describe", "quality_report",
    "dataset_report", "fill_chain", "run_length", "current_run", "latest_row", "iqr_flags", "lof_flags",
    "isolation_flags", "all_features", "stratified_split", "scaled", "rf_scores", "confusion", "roc_auc", "pr_auc",
    "csv_roundtrip", "counter_rate", "range_grid", "tumbling_stats", "stream_live_score",
]


def frame_seconds(spark: SparkSession, folder: str, minutes: int) -> float:
    """Time frames over one series with the events' values at one sample per second."""
    rows = series_view(spark.read.parquet(f"{folder}/events.parquet")).withColumns(
        {"series_key": F.lit("all"), "ts": F.timestamp_seconds("event_id")}
    )
    start = time.perf_counter()
    rolling_by_time(rows, minutes).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def poll_seconds(spark: SparkSession, folder: str) -> float:
    """A poll of 100 new rows of a live query that has seen all rows before them."""
    rows = series_view(spark.read.parquet(f"{folder}/events.parquet"))
    source, state = fresh_path(spark, "arrivals"), fresh_path(spark, "live")
    newest = rows.orderBy(F.desc("ts")).limit(100)

    def poll() -> float:
        start = time.perf_counter()
        stream = spark.readStream.schema(rows.schema).parquet(source)
        live.live_score(stream, _live_scorer, state, hours=1, poll=None).awaitTermination()
        return time.perf_counter() - start

    rows.join(newest.select("event_id"), "event_id", "left_anti").select(rows.columns).write.parquet(source)
    poll()
    newest.coalesce(1).write.mode("append").parquet(source)
    return poll()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="bench")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in ("rolling_stats_5", "lof_flags"):
        run(name)
    seconds = {name: round(run(name), 3) for name in HEADLINE}
    seconds |= {f"time_frame_{m}": round(frame_seconds(spark, folder, m), 3) for m in (5, 240)}
    seconds["live_poll_100"] = round(poll_seconds(spark, folder), 3)
    drop_workspace(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
