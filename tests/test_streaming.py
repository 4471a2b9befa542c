"""Streams over several micro-batches end where the batch twins do."""

import pytest
from pyspark.sql import functions as F

from helpers import same
from metricloom.operators import rolling, runs
from metricloom.operators.quality import trailing_range
from metricloom.streaming import counters, live


@pytest.fixture
def arrivals(spark, skewed, tmp_path):
    """The skewed series in three files by time, and a stream that takes one file per micro-batch."""
    ordered = skewed.withColumn("third", F.floor((F.unix_timestamp("ts") - 1_704_067_200) / 28_801))
    for third in range(3):
        folder = tmp_path / "in"
        ordered.filter(F.col("third") == third).drop("third").coalesce(1).write.mode("append").parquet(str(folder))

    def stream():
        return (
            spark.readStream.schema(skewed.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        )

    return stream, str(tmp_path)


def scorer(df):
    out = rolling.rolling_stats(df, (5,), stats=("mean",))
    return out.withColumn("prediction", (F.col("5min_mean") > 60).cast("int"))


def test_live_score_ends_like_batch(spark, skewed, arrivals):
    stream, path = arrivals
    live.live_score(stream(), scorer, f"{path}/live", poll=None, exposition=True).awaitTermination()
    wanted = runs.latest_row(scorer(trailing_range(skewed, 1)))
    status = live.current_status(spark, f"{path}/live", wanted.schema)
    newest = wanted.select("series_key")
    same(status.join(newest, "series_key", "left_semi"), wanted)
    assert spark.read.text(f"{path}/live/lines").filter("value like 'cpu_usage{status=%'").count() >= wanted.count()
    batches = spark.read.parquet(f"{path}/live/latest").select("batch_id").distinct().count()
    assert batches == 3


def test_replayed_batch_overwrites(skewed, tmp_path):
    first = live.fold_runs(skewed, None)
    again = live.fold_runs(skewed, first)
    same(first.drop("newest", "newest_normal"), again.drop("newest", "newest_normal"))


def test_runs_over_batches_end_like_batch(spark, skewed, arrivals):
    stream, path = arrivals
    live.track_runs(stream(), f"{path}/state", poll=None).awaitTermination()
    state = live.read_runs(spark, f"{path}/state").select("series_key", "run_start", "run_rows", "run_minutes")
    wanted = runs.current_run(skewed).select("series_key", "run_start", "run_rows", "run_minutes")
    same(state, wanted)


def test_tumbling_ends_like_batch(spark, skewed, arrivals):
    stream, path = arrivals
    live.stream_tumbling(stream(), f"{path}/windows", "1 hour", poll=None).awaitTermination()
    same(live.read_tumbling(spark, f"{path}/windows"), live.tumbling_stats(skewed, "1 hour"))


def test_counter_reset_gives_no_negative_rate(spark):
    rows = [("h", "0", t, c) for t, c in ((0, 10.0), (30, 25.0), (60, 3.0), (90, 18.0))]
    df = spark.createDataFrame(rows, "host string, cpu string, s long, seconds_total double")
    out = counters.counter_rate_utilization(df.withColumn("ts", F.timestamp_seconds("s")), ["host"])
    got = {int(r["window_start"].timestamp()): r["utilization"] for r in out.collect()}
    assert got == {0: pytest.approx(50.0), 60: pytest.approx((1 - 18 / 60) * 100)}


def test_grid_fills_gaps(spark):
    rows = [("a", 0, 1.0), ("a", 10, 2.0), ("a", 95, 3.0)]
    df = spark.createDataFrame(rows, "k string, s long, cpu_utilization double").withColumn("ts", F.timestamp_seconds("s"))
    out = counters.range_grid(df, ["k"], fill_gaps=True).orderBy("step_start")
    assert [r["cpu_utilization"] for r in out.collect()] == [2.0, None, None, 3.0]


def test_late_rows_count_within_the_lateness(spark, tmp_path):
    """Anomalies at 0 s and 120 s, then a normal row of 60 s, then one that is too late."""
    folder, path = str(tmp_path / "in"), str(tmp_path / "state")
    schema = "series_key string, ts timestamp, event_id long, cpu_utilization double, is_anomaly int"
    seen = []
    for batch in ([(0, 1), (120, 1)], [(60, 0)], [(7200, 1)], [(30, 0), (3700, 1)]):
        rows = [("a", s, s, 1.0, y) for s, y in batch]
        df = spark.createDataFrame(rows, "series_key string, s long, event_id long, cpu_utilization double, is_anomaly int")
        df.select("series_key", F.timestamp_seconds("s").alias("ts"), "event_id", "cpu_utilization", "is_anomaly").write.mode("append").parquet(folder)
        live.track_runs(spark.readStream.schema(schema).parquet(folder), path, poll=None).awaitTermination()
        state = live.read_runs(spark, path).first()
        seen.append((state["run_rows"], state["run_minutes"]))
    assert seen == [(2, 2.0), (1, 0.0), (2, 118.0), (3, 118.0)]
    assert len(list((tmp_path / "state" / "runs").iterdir())) <= live.KEPT_BATCHES


def test_late_batch_after_a_restart_does_not_rewind(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "live")
    schema = "series_key string, ts timestamp, event_id long, cpu_utilization double"
    day = 86_400
    for seconds in ([3 * day, 3 * day + 60], [60, 120], [3 * day + 30]):
        rows = [("a", s, s, 1.0) for s in seconds]
        df = spark.createDataFrame(rows, "series_key string, s long, event_id long, cpu_utilization double")
        df.select("series_key", F.timestamp_seconds("s").alias("ts"), "event_id", "cpu_utilization").write.mode("append").parquet(folder)
        score = lambda df: df.withColumn("prediction", F.lit(0))
        live.live_score(spark.readStream.schema(schema).parquet(folder), score, path, poll=None).awaitTermination()
        status = live.current_status(spark, path, schema + ", prediction int").collect()
        assert [(r["series_key"], r["event_id"]) for r in status] == [("a", 3 * day + 60)]
    dates = sorted(p.name for p in (tmp_path / "live" / "history").iterdir() if p.name.startswith("_date"))
    assert dates == ["_date=1970-01-04"]
