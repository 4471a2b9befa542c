"""Continuous scoring and summaries. Micro-batches are written per batch id, so replays overwrite."""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from metricloom.functions.scalar import finite, out_of_range, position
from metricloom.plans.attach import attach, null_safe_join
from metricloom.plans.log_table import MERGE_EVERY, LogTable
from metricloom.plans.workspace import delete_folder, publish_file, scratch, subfolders
from metricloom.series import Series
from metricloom.sources.exchange import exposition_lines

POLL = "30 seconds"
LATENESS = "1 hour"
KEPT_BATCHES = 3


def _start(stream: DataFrame, each, checkpoint: str, poll: str | None, mode: str = "append") -> StreamingQuery:
    spark = stream.sparkSession

    def batch_in_scratch(batch: DataFrame, batch_id: int) -> None:
        with scratch(spark):
            each(batch, batch_id)

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(batch_in_scratch)
    writer = writer.trigger(processingTime=poll) if poll else writer.trigger(availableNow=True)
    return writer.start()


def _expire(spark: SparkSession, folder: str, batch_id: int) -> None:
    """Delete states that no replay needs: a replay of this batch reads the one before."""
    for name in subfolders(spark, folder):
        if name.startswith("batch_id=") and int(name[9:]) <= batch_id - KEPT_BATCHES:
            delete_folder(spark, f"{folder}/{name}")


def live_score(
    stream: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    path: str,
    hours: float = 1,
    spec: Series = Series(),
    poll: str | None = POLL,
    exposition: bool = False,
) -> StreamingQuery:
    """Score the trailing hours on every poll and keep the newest row per series.

    The rows in reach of each micro-batch are added to a history partitioned by date and hour, of which only the hours in
    reach are listed and read; the batch code `scorer` runs over its trailing range, so a sample up to `hours` late still counts. Dates out
    of reach are deleted. `poll=None` drains what is there and stops.

    `<path>/latest/batch_id=N` holds the newest scored row of every series seen so far, `<path>/newest` the newest time,
    so a restarted query goes on where it ended; the last `KEPT_BATCHES` of both are kept. `<path>/scored/batch_id=N`
    holds the series that batch N scored, `<path>/lines/batch_id=N` their lines. A poll writes the history, the scored
    rows and the states, and nothing else.
    """
    spark = stream.sparkSession
    history = f"{path}/history"

    def each(batch: DataFrame, batch_id: int) -> None:
        hour = F.floor(F.unix_timestamp(F.col(spec.ts).cast("timestamp")) / 3600)
        dated = batch.withColumns({"_date": F.to_date(spec.ts), "_hour": hour, "batch_id": F.lit(batch_id).cast("long")})
        newest = _newest_time(batch, spec, _state_of(spark, f"{path}/newest", batch_id - 1))
        if newest["hour"] is not None:  # older rows are out of reach for good
            dated.filter(F.col("_hour") >= newest["hour"] - math.ceil(hours)).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("_date", "_hour", "batch_id").parquet(history)
        delete_folder(spark, f"{path}/newest/batch_id={batch_id}")
        publish_file(spark, f"{path}/newest/batch_id={batch_id}/newest.json", json.dumps(newest))
        if newest["hour"] is not None:
            reach = range(newest["hour"] - math.ceil(hours), newest["hour"] + 1)
            reader = spark.read.schema(dated.schema).option("basePath", history)
            recent = reader.parquet(f"{history}/_date=*/_hour={{{','.join(map(str, reach))}}}").filter(F.col("batch_id") <= batch_id)
            bound = F.lit(newest["text"]).cast(dict(batch.dtypes)[spec.ts]) - F.make_dt_interval(secs=F.lit(hours * 3600.0))
            trailing = recent.filter(F.col(spec.ts) >= bound).drop("_date", "_hour", "batch_id")
            rows = scorer(trailing.dropDuplicates([*spec.keys, *spec.order]))
            rest = [c for c in rows.columns if c not in spec.keys]
            # one sort of the trailing rows, in the job that writes the result
            last = rows.groupBy(*spec.keys).agg(F.max_by(F.struct(*rest), F.struct(*spec.order)).alias("_row"))
            scored = last.select(*spec.keys, "_row.*").select(*rows.columns)
            scored.write.mode("overwrite").parquet(f"{path}/scored/batch_id={batch_id}")
            scored = spark.read.schema(scored.schema).parquet(f"{path}/scored/batch_id={batch_id}")
            latest = scored
            if batch_id > 0 and f"batch_id={batch_id - 1}" in subfolders(spark, f"{path}/latest"):
                older = spark.read.schema(scored.schema).parquet(f"{path}/latest/batch_id={batch_id - 1}")
                # a row that was scored again replaces its older score
                older = null_safe_join(older, scored.select(*spec.keys), list(spec.keys), "left_anti")
                latest = scored.unionByName(older)
            latest.write.mode("overwrite").parquet(f"{path}/latest/batch_id={batch_id}")
            if exposition:
                lines = exposition_lines(scored, spec.ts, spec.value, labels=spec.keys)
                lines.write.mode("overwrite").text(f"{path}/lines/batch_id={batch_id}")
            for name in subfolders(spark, history):
                if name.startswith("_date=") and name[6:] < newest["oldest_date"]:
                    delete_folder(spark, f"{history}/{name}")
        for folder in ("newest", "scored", "latest"):
            _expire(spark, f"{path}/{folder}", batch_id)

    def _newest_time(batch: DataFrame, spec: Series, before: dict | None) -> dict:
        """The newest time so far: as text in the session's zone, its hour, and the oldest date in reach."""
        at = F.max(spec.ts)
        hour = F.floor(F.unix_timestamp(at.cast("timestamp")) / 3600)
        oldest = F.to_date(at) - F.make_dt_interval(days=F.lit(int(hours // 24) + 1))
        row = batch.agg(at.cast("string").alias("text"), F.unix_micros(at.cast("timestamp")).alias("micros"), hour.alias("hour"),
                        oldest.cast("date").cast("string").alias("oldest_date")).first().asDict()
        return before if before and before["micros"] is not None and (row["micros"] is None or before["micros"] >= row["micros"]) else row

    return _start(stream, each, f"{path}/checkpoint", poll)


def _state_of(spark: SparkSession, folder: str, batch_id: int) -> dict | None:
    """The state that a batch published; none before the first one."""
    if f"batch_id={batch_id}" not in subfolders(spark, folder):
        return None
    return json.loads(spark.read.text(f"{folder}/batch_id={batch_id}/newest.json", wholetext=True).first()[0])


def current_status(spark, path: str, schema, spec: Series = Series()) -> DataFrame:
    """The newest scored row per series of a live query: each batch writes all series."""
    return _last_state(spark, f"{path}/latest", schema)


def _last_state(spark: SparkSession, folder: str, schema=None) -> DataFrame:
    last = max(int(name[9:]) for name in subfolders(spark, folder) if name.startswith("batch_id="))
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{folder}/batch_id={last}")


def tumbling_columns(spec: Series) -> list:
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(finite(spec.value)).alias("mean"),
        (F.avg((~out_of_range(spec.value)).cast("int")) * 100).alias("validity"),
        F.avg(spec.label).alias("anomaly_ratio"),
    ]


def tumbling_stats(
    df: DataFrame, width: str = "1 hour", spec: Series = Series(), lateness: str = LATENESS
) -> DataFrame:
    """Rows, mean, validity and label share per series and window; batch or streaming input.

    A stream forgets windows and repeated rows older than `lateness` before the newest row seen; rows
    that come later than that are left out, so set it to the longest delay of the source.
    """
    if df.isStreaming:
        df = df.withWatermark(spec.ts, lateness).dropDuplicatesWithinWatermark([*spec.keys, *spec.order])
    window = F.window(spec.ts, width)
    grouped = df.groupBy(*spec.keys, window.alias("_w")).agg(*tumbling_columns(spec))
    return grouped.select(*spec.keys, F.col("_w.start").alias("window_start"), "n_rows", "mean", "validity", "anomaly_ratio")


def stream_tumbling(
    stream: DataFrame, path: str, width: str = "1 hour", spec: Series = Series(), poll: str | None = POLL,
    lateness: str = LATENESS, merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """Windows that changed, per micro-batch, in a table that merges its batches by date; `read_tumbling` reads it.

    A batch touches the dates within the lateness, so a merge writes few dates anew and a day leaves one folder.
    """
    table = window_table(stream.sparkSession, path, spec)

    def each(batch: DataFrame, batch_id: int) -> None:
        table.add(batch, batch_id, merge_every)

    return _start(tumbling_stats(stream, width, spec, lateness), each, f"{path}/checkpoint", poll, "update")


def window_table(spark: SparkSession, path: str, spec: Series = Series()) -> LogTable:
    """Windows in sections by date; the newest version of a window counts."""

    def newest(versions: DataFrame) -> DataFrame:
        rest = [c for c in versions.columns if c not in (*spec.keys, "window_start", "batch_id")]
        found = versions.groupBy(*spec.keys, "window_start").agg(
            F.max_by(F.struct(*rest), "batch_id").alias("_row"), F.max("batch_id").alias("batch_id")
        )
        return found.select(*spec.keys, "window_start", "_row.*", "batch_id")

    return LogTable(spark, path, newest, F.to_date("window_start").cast("string"))


def read_tumbling(spark, path: str, spec: Series = Series()) -> DataFrame:
    """The newest version of every window."""
    return window_table(spark, path, spec).read()


def track_runs(
    stream: DataFrame, path: str, spec: Series = Series(), poll: str | None = POLL, lateness: str = LATENESS
) -> StreamingQuery:
    """Running anomaly duration per series, as state of one row per series.

    The state is a table: a batch's rows are folded into it by aggregates with map-side partial
    results, so a hot series never passes through one task. Rows within `lateness` of a series' newest
    row stay beside the state, so rows may come in any order inside it; a row later than that is left out,
    and so is one without a time. After batch N, `<path>/runs/batch_id=N` holds the state of all rows,
    `<path>/settled` that of the rows beyond the lateness and `<path>/recent` the others.
    """
    spark = stream.sparkSession

    def each(batch: DataFrame, batch_id: int) -> None:
        def written(df: DataFrame, name: str) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
            return spark.read.schema(df.schema).parquet(f"{path}/{name}/batch_id={batch_id}")

        settled = recent = None
        if batch_id > 0:
            settled, recent = (
                spark.read.parquet(f"{path}/{name}/batch_id={batch_id - 1}") for name in ("settled", "recent")
            )
        pool = written(timely_rows(batch, settled, recent, spec, lateness), "pool")
        settled = written(settle(pool, settled, spec), "settled")
        recent = written(pool.filter(~F.col("_old")).drop("_old", "_edge"), "recent")
        written(_fold(recent, settled.drop("_edge"), spec), "runs")
        for name in ("pool", "settled", "recent", "runs"):
            _expire(spark, f"{path}/{name}", batch_id)

    return _start(stream, each, f"{path}/checkpoint", poll)


def read_runs(spark, path: str) -> DataFrame:
    """The newest state of a run tracker: each batch writes the whole state."""
    return _last_state(spark, f"{path}/runs")


def timely_rows(
    batch: DataFrame, settled: DataFrame | None, recent: DataFrame | None, spec: Series = Series(), lateness: str = LATENESS
) -> DataFrame:
    """Rows that may still change a run: the recent ones and the batch's, but for late ones.

    `_edge` is the newest time of the series less the lateness, `_old` says that the row is not after it.
    """
    keys = list(spec.keys)
    rows = batch.select(*keys, *spec.order, spec.label).filter(F.col(spec.ts).isNotNull())
    if settled is not None:
        sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        edges = null_safe_join(sizes, settled.select(*keys, F.col("_edge").alias("_before")), keys)
        rows = attach(rows, edges, keys, weight="_n").drop("_n")
        rows = rows.filter(F.col("_before").isNull() | (F.col(spec.ts) > F.col("_before"))).drop("_before")
        rows = rows.unionByName(recent.select(*rows.columns))
    newest = rows.groupBy(*keys).agg(F.max(spec.ts).alias("_top"), F.count(F.lit(1)).alias("_n"))
    newest = newest.withColumn("_edge", F.col("_top") - F.expr(f"interval {lateness}"))
    rows = attach(rows, newest.drop("_top"), keys, weight="_n").drop("_n")
    return rows.withColumn("_old", F.col(spec.ts) <= F.col("_edge"))


def settle(pool: DataFrame, settled: DataFrame | None, spec: Series = Series()) -> DataFrame:
    """The settled state and its `_edge` after the old rows of the pool; series without old rows have no state yet."""
    keys = list(spec.keys)
    edges = pool.groupBy(*keys).agg(F.max("_edge").alias("_edge"))
    if settled is not None:
        edges = edges.unionByName(settled.select(*keys, "_edge")).groupBy(*keys).agg(F.max("_edge").alias("_edge"))
    state = _fold(pool.filter("_old").drop("_old", "_edge"), settled.drop("_edge") if settled is not None else None, spec)
    return null_safe_join(edges, state, keys)


def fold_runs(batch: DataFrame, before: DataFrame | None, spec: Series = Series()) -> DataFrame:
    """State (keys, newest, newest_ts, newest_normal, run_start, run_rows, run_minutes) after the rows newer than `before`."""
    keys = list(spec.keys)
    if before is not None:
        seen = null_safe_join(
            batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")),
            before.select(*keys, F.col("newest").alias("_seen")),
            keys,
        )
        at = position(batch, spec.ts, spec.tie)
        batch = attach(batch, seen, keys, weight="_n").drop("_n")
        batch = batch.filter(F.col("_seen").isNull() | (at > F.col("_seen"))).drop("_seen")
    return _fold(batch, before, spec)


def _fold(batch: DataFrame, before: DataFrame | None, spec: Series) -> DataFrame:
    """As `fold_runs`, where all rows of the batch are newer than the state."""
    keys = list(spec.keys)
    normal = ~F.coalesce(F.col(spec.label) == 1, F.lit(False))
    rows = batch.select(*keys, position(batch, spec.ts, spec.tie).alias("_at"), spec.ts, normal.alias("_normal"))
    ends = rows.groupBy(*keys).agg(
        F.max("_at").alias("_newest"),
        F.max(F.when(F.col("_normal"), F.col("_at"))).alias("_last_normal"),
        F.count(F.lit(1)).alias("_n"),
    )
    joined = attach(rows, ends, keys, weight="_n")
    after = F.col("_last_normal").isNull() | (F.col("_at") > F.col("_last_normal"))
    fresh = joined.groupBy(*keys).agg(
        F.max("_newest").alias("newest"),
        F.max(spec.ts).alias("newest_ts"),
        F.max("_last_normal").alias("newest_normal"),
        F.min(F.when(after, F.col(spec.ts))).alias("run_start"),
        F.sum(after.cast("long")).alias("run_rows"),
    )
    if before is not None:
        state = ["newest", "newest_ts", "newest_normal", "run_start", "run_rows"]
        both = fresh.withColumn("_new", F.lit(1)).unionByName(before.select(*keys, *state).withColumn("_new", F.lit(0)))
        broken = F.max(F.when(F.col("_new") == 1, F.col("newest_normal"))).isNotNull()
        old_start = F.max(F.when(F.col("_new") == 0, F.col("run_start")))
        old_rows = F.coalesce(F.max(F.when(F.col("_new") == 0, F.col("run_rows"))), F.lit(0))
        new_start = F.max(F.when(F.col("_new") == 1, F.col("run_start")))
        new_rows = F.coalesce(F.max(F.when(F.col("_new") == 1, F.col("run_rows"))), F.lit(0))
        fresh = both.groupBy(*keys).agg(
            F.max("newest").alias("newest"),
            F.max("newest_ts").alias("newest_ts"),
            F.max("newest_normal").alias("newest_normal"),
            F.when(broken, new_start).otherwise(F.coalesce(old_start, new_start)).alias("run_start"),
            F.when(broken, new_rows).otherwise(old_rows + new_rows).alias("run_rows"),
        )
    latest = F.unix_micros(F.col("newest_ts").cast("timestamp"))
    minutes = (latest - F.unix_micros(F.col("run_start").cast("timestamp"))) / 6e7
    return fresh.withColumn("run_minutes", F.coalesce(minutes, F.lit(0.0)))
