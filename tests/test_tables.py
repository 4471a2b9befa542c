"""Tables that grow by versions, joins by measured bytes, and layouts that move rows once."""

import math

import pytest
from helpers import exchanges, same
from metricloom.operators import models, quality, rolling, runs
from metricloom.plans import attach, workspace
from metricloom.plans.ordered import lay_out
from metricloom.sources import exchange, files
from metricloom.streaming import counters, live
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F


def test_rows_of_many_series_move_once(spark):
    rows = spark.range(600_000).select(
        (F.col("id") % 300_000).cast("string").alias("series_key"), F.timestamp_seconds("id").alias("ts"), F.col("id").alias("event_id"),
        (F.col("id") % 7).cast("double").alias("cpu_utilization"), F.lit(0).alias("is_anomaly"),
    )
    out = rolling.rolling_stats(rows, (5,), stats=("mean",))
    assert exchanges(out) == ["hashpartitioning"]
    assert out.agg(F.count("5min_mean"), F.sum("cpu_utilization")).first() == (600_000, rows.agg(F.sum("cpu_utilization")).first()[0])
    filled = runs.fill_chain(rows, ["cpu_utilization"])
    assert exchanges(filled) == ["hashpartitioning"] and filled.count() == 600_000


def test_short_and_spanning_series_alike(spark, skewed):
    """Frames, fills and totals do not depend on how the layout cuts the series."""
    one = rolling.rolling_stats(skewed, (15,), stats=("mean", "std", "max"), parts=1)
    for parts, size in ((7, 100), (40, 1_000_000), (1, 50)):
        same(rolling.rolling_stats(skewed, (15,), stats=("mean", "std", "max"), parts=parts, chunk_rows=size), one)
    sums = lambda parts: lay_out(skewed, ["series_key"], ["ts", "event_id"], parts).running(
        {"s": ("sum", F.col("is_anomaly")), "m": ("max", F.col("cpu_utilization"))}, totals=True
    ).select("event_id", "s", "m", "s_total")
    same(sums(9), sums(1))


def test_wide_tables_are_not_broadcast(spark):
    wide = workspace.materialize(spark.range(1_000).select(F.col("id").alias("series_key"), F.expr("repeat('x', 1000000)").alias("t")), "wide")
    rows = spark.range(3_000).select((F.col("id") % 1_000).alias("series_key"), "id")
    n, held = attach.measured(wide)
    assert n == 1_000 and 1_000_000_000 < held < 1_100_000_000
    joined = attach.attach(rows, wide, ["series_key"], written=True)
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.agg(F.sum(F.length("t"))).first()[0] == 3_000_000_000
    small = attach.attach(rows, wide.limit(5), ["series_key"])
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    nested = spark.createDataFrame([(1, {"k": "v" * 100}, [("a" * 50, 1)])], "a long, m map<string,string>, l array<struct<s:string,n:int>>")
    assert 200 < attach.measured(nested)[1] < 400


@pytest.fixture
def bundle(spark):
    def make(factor):
        model = PipelineModel(stages=[SQLTransformer(statement=f"SELECT *, v * {factor} AS scaled FROM __THIS__")])
        return models.Bundle(model, ["v"], spark.createDataFrame([(factor,)], "factor int"), {"threshold": factor / 10})

    return make


def test_a_broken_save_leaves_the_version_before(spark, bundle, tmp_path, monkeypatch):
    path = str(tmp_path / "model")
    models.save_model(bundle(2), path)
    broken = bundle(3)
    broken.stats = broken.stats.withColumn("x", F.raise_error(F.lit("the power went")).cast("int"))
    with pytest.raises(Exception, match="the power went"):
        models.save_model(broken, path)
    loaded = models.load_model(spark, path)
    assert loaded.stats.first().factor == 2 and loaded.settings == {"threshold": 0.2} and loaded.history is None
    with monkeypatch.context() as m:
        m.setattr(models, "publish_file", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            models.save_model(bundle(4), path)
    assert models.load_model(spark, path).model.transform(spark.range(1).select(F.lit(5).alias("v"))).first().scaled == 10
    for factor in range(5, 10):
        models.save_model(bundle(factor), path)
    assert models.load_model(spark, path).stats.first().factor == 9
    assert len(list((tmp_path / "model" / "manifests").glob("manifest-*"))) == models.KEPT_VERSIONS
    complete = [v for v in (tmp_path / "model").glob("version-*") if (v / "stats" / "_SUCCESS").exists()]
    assert len(complete) == models.KEPT_VERSIONS + 1  # and the one whose manifest never appeared


def test_files_are_published_once(spark, tmp_path):
    assert workspace.publish_file(spark, f"{tmp_path}/m/a.json", "one") and not workspace.publish_file(spark, f"{tmp_path}/m/a.json", "two")
    assert (tmp_path / "m" / "a.json").read_text() == "one" and workspace.file_names(spark, f"{tmp_path}/m") == ["a.json"] or set(
        workspace.file_names(spark, f"{tmp_path}/m")) == {"a.json", ".a.json.crc"}


def test_unreadable_cells_are_kept_and_counted(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("timestamp,cpu_utilization,is_anomaly,host\n1,12.5,1,a\nsoon,n/a,0,b\n3,4.5\n4,,1,d\n5,NaN,0,e\n6,7,1,f,extra\n")
    df = files.read_metric_csv(spark, str(path), rescue="rescued")
    got = [(r.timestamp, r.cpu_utilization, r.rescued) for r in df.collect()]
    assert got == [
        (1, 12.5, None), (None, None, {"timestamp": "soon", "cpu_utilization": "n/a"}), (3, 4.5, {"_line": "3,4.5"}), (4, None, None), (5, None, None),
        (6, 7.0, {"_line": "6,7,1,f,extra"}),
    ]
    assert {tuple(r) for r in files.rescue_report(df).collect()} == {
        (None, 3, 6, 3), ("timestamp", 1, 6, 3), ("cpu_utilization", 1, 6, 3), ("_line", 2, 6, 3)}
    assert {tuple(r) for r in files.rescue_report(df.filter("rescued IS NULL")).collect()} == {(None, 0, 3, 0)}
    two = files.read_two_column_csv(spark, str(path), rescue="rescued")
    assert two.columns == ["timestamp", "cpu_utilization", "rescued"] and two.filter("rescued IS NOT NULL").count() == 3
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        assert files.read_two_column_csv(spark, str(path)).count() == 6 and len(files.read_two_column_csv(spark, str(path)).collect()) == 6
    spark.conf.unset("spark.sql.ansi.enabled")


def test_unreadable_points_are_kept(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text('{"status": "success", "data": {"resultType": "matrix", "result": [{"metric": {"h": "a"}, "values": [[1, "2.5"], ["x", "NaN"], [3, "y"], [4]]}]}}')
    df = exchange.read_range_response(spark, str(path), rescue="rescued")
    assert [(r.timestamp, r.rescued) for r in df.collect()] == [(1, None), (None, {"timestamp": "x"}), (3, {"cpu_utilization": "y"}), (4, {"cpu_utilization": ""})]


def test_window_table_stays_small(spark, skewed, tmp_path):
    """Twenty batches over several days leave few folders and the windows of the batch, also after a replay."""
    folder, path = tmp_path / "in", str(tmp_path / "windows")
    spread = skewed.withColumn("ts", F.col("ts") + F.make_dt_interval(days=F.col("event_id") % 3))
    placed = spread.withColumn("part", F.floor((F.unix_timestamp("ts") - 1_704_067_200) / 12_961))
    for part in range(20):
        placed.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(str(folder))

    def run():
        stream = spark.readStream.schema(skewed.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
        live.stream_tumbling(stream, path, poll=None, merge_every=4).awaitTermination()

    run()
    want = live.tumbling_stats(spread)
    same(live.read_tumbling(spark, path), want)
    table = tmp_path / "windows"
    folders = lambda: (len(list((table / "batches").iterdir())), len(list((table / "merged").glob("*/_section*"))))
    assert len(list((table / "checkpoint" / "commits").glob("[0-9]*"))) >= 20 and folders()[0] <= 9 and folders()[1] <= 6
    assert len(list((table / "manifests").glob("manifest-*"))) == 2
    last = max((table / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    (last.parent / f".{last.name}.crc").unlink()
    last.unlink()  # the batch was written but not committed
    run()
    same(live.read_tumbling(spark, path), want)
    assert folders()[0] <= 9 and folders()[1] <= 6


def steps_by_hand(samples, step, lookback, low, high):
    out = set()
    for key in {k for k, _, _ in samples}:
        for t in range(-(-low // step) * step, high + 1, step):
            seen = [(s, i, v) for i, (k, s, v) in enumerate(samples) if k == key and s <= t and s > t - lookback and not math.isnan(v)]
            if seen:
                s, _, v = max(seen)
                out.add((key, t, v, float(t - s)))
    return out


def test_steps_look_back(spark):
    import random

    rng = random.Random(3)
    samples = [(rng.choice("ab"), rng.randint(0, 900), float(rng.randint(0, 9))) for _ in range(60)] + [("a", 300, math.nan), ("c", 500, 1.0)]
    df = spark.createDataFrame([(k, s, i, v) for i, (k, s, v) in enumerate(samples)], "k string, s long, tie long, cpu_utilization double")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    for parts in (1, 5):
        out = counters.range_at_steps(df, ["k"], tie=["tie"], lookback_seconds=70, parts=parts)
        got = {(r.k, int(r.step_at.timestamp()), r.cpu_utilization, r.age_seconds) for r in out.collect()}
        low, high = min(s for _, s, _ in samples), max(s for _, s, _ in samples)
        assert got == steps_by_hand(samples, 30, 70, low, high)
    later = counters.range_at_steps(df, ["k"], tie=["tie"], start=840, end=1_500, lookback_seconds=300)
    assert {int(r.step_at.timestamp()) for r in later.collect()} <= set(range(840, 1_501, 30)) and not later.isEmpty()
    assert counters.range_at_steps(df.limit(0), ["k"]).count() == 0


def test_rates_look_back_over_a_range(spark):
    rows = [("h", "0", t, c) for t, c in ((0, 10.0), (15, 20.0), (30, 5.0), (45, 12.5), (60, 20.0), (200, 25.0))]
    df = spark.createDataFrame(rows, "host string, cpu string, s long, seconds_total double").withColumn("ts", F.timestamp_seconds("s"))
    out = counters.counter_rate_at_steps(df, ["host"], extrapolate=False)
    got = {int(r.step_at.timestamp()): round(r.utilization, 6) for r in out.collect()}
    # of (-30, 30]: 10 and 5 after the reset in 30 s; of (0, 60]: 5, 7.5 and 7.5 in 45 s; of (30, 90]: 7.5 in 15 s
    assert got == {30: 50.0, 60: round((1 - 20 / 45) * 100, 6), 90: 50.0}
    whole = {int(r.step_at.timestamp()): r.utilization for r in counters.counter_rate_at_steps(df, ["host"]).collect()}
    assert whole[60] == pytest.approx((1 - 20 * (45 + 15) / 45 / 60) * 100) and set(whole) == set(got)


def test_missing_values_in_reports(spark, table):
    df = table([10.0, math.nan, 30.0, math.inf], [0, 1, 0, 1])
    report = quality.dataset_report(df).first()
    assert (report.mean, report.min, report.max) == (20.0, 10.0, 30.0)
    checked = quality.quality_report(df).first()
    assert checked.completeness == 75.0 and checked.validity == 75.0 and not math.isnan(checked.daily_variation)
    assert [r.cpu_utilization for r in runs.fill_chain(df, ["cpu_utilization"]).orderBy("event_id").collect()] == [10.0, 10.0, 30.0, math.inf]
