"""One query per operator, each over a whole table of the folder it is given.

Computed doubles are rounded to six decimals; times leave as epoch numbers.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from metricloom import Series, series_view
from metricloom.functions import calendar, scalar
from metricloom.operators import detectors, evaluate, features, models, quality, rolling, runs, splits, stats
from metricloom.plans.ordered import lay_out
from metricloom.plans.profile import histogram, stored_histogram
from metricloom.plans.workspace import fresh_path, materialize
from metricloom.sources import exchange, files
from metricloom.streaming import counters, live

ID = ["series_key", "event_id"]
SPEC = Series()
VALUE = "cpu_utilization"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def r6(c, name: str | None = None):
    """Six decimals, no negative zero; the offset keeps exact halves from falling either way."""
    col = F.col(c) if isinstance(c, str) else c
    return (F.round(col + F.lit(1e-9), 6) + F.lit(0.0)).alias(name or c)


def events(spark: SparkSession, sf: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/events.parquet")


def series(spark: SparkSession, sf: str) -> DataFrame:
    return series_view(events(spark, sf))


def scores(spark: SparkSession, sf: str) -> DataFrame:
    """A fixed score for the evaluation queries: utilisation over 100, flagged from 0.8."""
    scored = series(spark, sf).withColumn("probability", F.col(VALUE) / 100)
    return models.flag_by_threshold(scored, 0.8)


def columns(df: DataFrame, exact=(), rounded=()) -> DataFrame:
    return df.select(*exact, *[r6(c) for c in rounded])


# --- rolling windows -----------------------------------------------------------------------------


def _rolling(window: int):
    def build(spark, sf):
        wanted = ("mean", "std", "max", "min", "range", "change", "pct_change")
        out = rolling.rolling_stats(series(spark, sf), (window,), stats=wanted)
        return columns(out, ID, [f"{window}min_{s}" for s in wanted])

    build.__name__ = f"rolling_stats_{window}"
    return build


for _window in rolling.WINDOWS:
    query(_rolling(_window))


@query
def rolling_flagged(spark, sf):
    out = rolling.rolling_stats(series(spark, sf), (5,), stats=("mean", "std")).withColumns(
        scalar.threshold_flags(VALUE)
    )
    return columns(out, [*ID, "is_high_usage"], ["5min_mean", "5min_std"])


@query
def rolling_trend(spark, sf):
    out = rolling.rolling_stats(series(spark, sf), stats=("trend",))
    return columns(out, ID, [f"{w}min_trend" for w in rolling.WINDOWS])


@query
def rolling_long_frames(spark, sf):
    """300-row frames over many small parts and chunks."""
    out = rolling.rolling_stats(
        series(spark, sf), (5,), rows_per_minute=60, stats=("mean", "std", "max", "min", "trend"), parts=6, chunk_rows=701
    )
    return columns(out, ID, [f"5min_{s}" for s in ("mean", "std", "max", "min", "trend")])


def _time_range(minutes: int):
    def build(spark, sf):
        out = rolling.rolling_by_time(series(spark, sf), minutes)
        names = [f"{minutes}min_{s}" for s in ("mean", "std", "max", "min", "range", "change", "pct_change")]
        return columns(out, [*ID, f"{minutes}min_count"], names)

    build.__name__ = f"rolling_time_range_{minutes}"
    return build


for _minutes in (15, 60):
    query(_time_range(_minutes))


def with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """The series with NaN in every 97th event, and infinity in every 211th and in the first one of each series."""
    rows = series(spark, sf)
    first = rows.groupBy("series_key").agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("first"))
    endless = (F.pmod("event_id", F.lit(211)) == 0) | (F.col("event_id") == F.col("first"))
    gap = F.when(F.pmod("event_id", F.lit(97)) == 0, math.nan).when(endless, math.inf)
    return rows.join(first, "series_key").withColumn(VALUE, gap.otherwise(F.col(VALUE))).select(rows.columns)


@query
def rolling_stats_nan(spark, sf):
    out = rolling.rolling_stats(with_gaps(spark, sf), (15,), stats=("mean", "std", "max", "min", "change", "trend"))
    out = out.withColumn("is_endless", F.coalesce(F.col("15min_max") == math.inf, F.lit(False)).cast("int"))
    return columns(out, [*ID, "is_endless"], [f"15min_{s}" for s in ("mean", "std", "min", "change", "trend")])


@query
def rolling_time_range_nan(spark, sf):
    out = rolling.rolling_by_time(with_gaps(spark, sf), 240)
    return columns(out, [*ID, "240min_count"], [f"240min_{s}" for s in ("mean", "std", "min", "change")])


@query
def rolling_offset(spark, sf):
    """The later half of the events lies higher by a billion."""
    rows = series(spark, sf)
    last = rows.agg(F.max("event_id").alias("last"))
    rows = rows.join(F.broadcast(last)).withColumn(VALUE, F.col(VALUE) + F.when(F.col("event_id") * 2 > F.col("last"), 1e9).otherwise(0.0))
    out = rolling.rolling_stats(rows.drop("last"), (5, 60), stats=("mean", "std"))
    return out.select(*ID, *[F.round(F.col(f"{w}min_{s}") + 1e-5, 2).alias(f"{w}min_{s}") for w in (5, 60) for s in ("mean", "std")])


def _merged_histogram(spark, sf) -> DataFrame:
    """Seven batches added to a stored histogram, one of them twice, merged every three."""
    table = stored_histogram(spark, fresh_path(spark, "histogram"), ["series_key"], VALUE)
    rows = with_gaps(spark, sf)
    for batch in (0, 1, 2, 3, 4, 4, 5, 6):
        some = rows.filter(F.pmod("event_id", F.lit(7)) == batch)
        table.add(histogram(some, ["series_key"], VALUE), batch, merge_every=3)
    return table.read()


@query
def merged_stats(spark, sf):
    out = stats.histogram_stats(_merged_histogram(spark, sf))
    return columns(out, ["series_key", "n_rows", "n_values", "n_distinct"], ["v_min", "v_max", "v_mean", "v_std", "q1", "median", "q3"])


@query
def merged_ranks(spark, sf):
    return columns(stats.histogram_ranks(with_gaps(spark, sf), _merged_histogram(spark, sf)), ID, ["cpu_rank"])


@query
def zscore_nan(spark, sf):
    out = stats.zscore(with_gaps(spark, sf)).withColumn("z_score", scalar.finite("z_score"))
    return columns(out, ID, ["z_score"])


@query
def describe_nan(spark, sf):
    return columns(stats.describe(with_gaps(spark, sf)), ["series_key", "count"], ["mean", "std", "min", "p25", "p50", "p75", "max"])


@query
def usage_streak(spark, sf):
    out = rolling.high_usage_counts(series(spark, sf))
    return out.select(*ID, *[f"high_usage_streak_{n}" for n in rolling.STREAKS])


@query
def anomaly_streak(spark, sf):
    out = rolling.anomaly_counts(series(spark, sf), agreement="is_anomaly")
    return out.select(*ID, *[F.col(f"anomaly_streak_{n}").cast("long").alias(f"anomaly_streak_{n}") for n in rolling.STREAKS])


@query
def coefficient_of_variation(spark, sf):
    out = rolling.rolling_stats(series(spark, sf), (15, 30, 60), stats=("mean", "std"))
    return columns(rolling.coefficient_of_variation(out), ID, ["15min_cv", "30min_cv", "60min_cv"])


@query
def row_index(spark, sf):
    return rolling.row_index(series(spark, sf), parts=5).select(*ID, "row_index")


# --- scalars -------------------------------------------------------------------------------------


@query
def threshold_flags(spark, sf):
    return series(spark, sf).select(*ID, *[c.alias(n) for n, c in scalar.threshold_flags(VALUE).items()])


@query
def calendar_features(spark, sf):
    names = ["hour", "weekday", "minute", "is_weekend", "is_business_hour", "is_peak_hour"]
    out = calendar.calendar_features(series(spark, sf))
    return out.select(*ID, *names, F.date_format("date", "yyyy-MM-dd").alias("date"))


@query
def cyclic_hour(spark, sf):
    out = series(spark, sf).withColumn("hour", F.hour("ts")).withColumns(calendar.cyclic_hour())
    return columns(out, ID, ["hour_sin", "hour_cos"])


@query
def clean_numeric(spark, sf):
    raw = events(spark, sf)
    v = F.col("value")
    holed = raw.withColumn(
        "x",
        F.when(v > 300, F.lit(math.inf)).when(v > 200, F.lit(-math.inf)).when(v < 1, F.lit(math.nan))
        .when(v < 2, F.lit(None)).otherwise(v),
    )
    return scalar.clean_numeric(holed, ["x"]).select("event_id", "x")


@query
def round2(spark, sf):
    return events(spark, sf).select("event_id", scalar.round2(F.col("value") / 8).alias("x"))


@query
def clip(spark, sf):
    return events(spark, sf).select("event_id", scalar.clip("value", 5, 95).alias("x"))


@query
def validity_filter(spark, sf):
    raw = events(spark, sf)
    return quality.invalid_rows(raw, Series(value="value")).select("event_id", "value")


@query
def normalize_label(spark, sf):
    flipped = series(spark, sf).withColumn("is_normal", 1 - F.col("is_anomaly"))
    return flipped.select(*ID, scalar.normalize_label("is_normal", anomaly_value=0).alias("is_anomaly"))


@query
def label_filter(spark, sf):
    raw = events(spark, sf).withColumn("labels", F.create_map(F.lit("state"), "event_type"))
    return scalar.label_filter(raw, state="error").select("event_id", "event_type", "value")


@query
def epoch_conversion(spark, sf):
    epoch = series(spark, sf).select(*ID, calendar.ts_to_epoch("ts").alias("epoch"))
    back = epoch.withColumn("back", calendar.epoch_to_ts("epoch"))
    return back.select(*ID, "epoch", F.date_format("back", "yyyy-MM-dd HH:mm:ss").alias("back"))


@query
def time_index(spark, sf):
    """Millisecond epochs, some unreadable, found out to be milliseconds by their size."""
    epoch = (calendar.ts_to_epoch("ts") * 1000).cast("string")
    text = series(spark, sf).withColumn("timestamp", F.when(F.col("is_anomaly") == 1, "bad").otherwise(epoch))
    out = calendar.to_time_index(text)
    return out.select(*ID, calendar.ts_to_epoch("datetime").cast("double").alias("epoch"))


@query
def time_index_mixed(spark, sf):
    """One series in milliseconds beside others in seconds."""
    scale = F.when(F.col("series_key") == "view", 1000).otherwise(1)
    mixed = series(spark, sf).withColumn("timestamp", calendar.ts_to_epoch("ts") * scale)
    out = calendar.to_time_index(mixed, ("series_key",))
    return out.select(*ID, calendar.ts_to_epoch("datetime").cast("double").alias("epoch"))


@query
def point_features(spark, sf):
    rows = series(spark, sf).withColumn("epoch", calendar.ts_to_epoch("ts"))
    out = calendar.point_features(rows, "epoch", VALUE)
    return columns(out, [*ID, "cpu_usage", "hour", "weekday", "is_weekend"], ["hour_sin", "hour_cos"])


@query
def select_features(spark, sf):
    out = models.select_features(series(spark, sf), [VALUE, "absent"])
    return out.select(*ID, VALUE, "absent", "n_missing_features")


# --- whole-series statistics ---------------------------------------------------------------------


@query
def min_max_normalize(spark, sf):
    return columns(stats.min_max_normalize(series(spark, sf)), ID, ["cpu_normalized"])


@query
def zscore(spark, sf):
    return columns(stats.zscore(series(spark, sf)), ID, ["z_score", "cpu_deviation_from_mean"])


@query
def hourly_deviation(spark, sf):
    return columns(stats.hourly_deviation(series(spark, sf)), ID, ["cpu_deviation_hourly"])


@query
def daily_deviation(spark, sf):
    return columns(stats.daily_deviation(series(spark, sf)), ID, ["cpu_deviation_daily"])


@query
def pct_rank(spark, sf):
    return columns(stats.percent_rank(series(spark, sf), parts=5), ID, ["cpu_rank"])


@query
def quantiles(spark, sf):
    wanted = {"p1": 0.01, "p25": 0.25, "p75": 0.75, "p99": 0.99}
    return columns(stats.series_quantiles(series(spark, sf), wanted, parts=5), ["series_key"], list(wanted))


@query
def approx_quantiles(spark, sf):
    wanted = {"p10": 0.1, "p50": 0.5, "p90": 0.9}
    return columns(stats.approximate_quantiles(series(spark, sf), wanted), ["series_key"], list(wanted))


@query
def describe(spark, sf):
    out = stats.describe(series(spark, sf))
    return columns(out, ["series_key", "count"], ["mean", "std", "min", "p25", "p50", "p75", "max"])


# --- quality -------------------------------------------------------------------------------------

_METRICS = [
    "completeness", "completeness_by_cell", "validity", "anomaly_ratio", "workday_difference", "daily_variation",
    "avg_anomaly_gap_min",
]
_COUNTS = ["n_anomalies", "n_total", "time_continuity"]
_CHECKS = [
    "continuity_ok", "validity_ok", "anomaly_ratio_ok", "workday_ok", "daily_variation_ok", "anomaly_gap_ok",
]


@query
def quality_report(spark, sf):
    return columns(quality.quality_report(series(spark, sf)), ["series_key", *_COUNTS, *_CHECKS], _METRICS)


@query
def quality_report_nan(spark, sf):
    return columns(quality.quality_report(with_gaps(spark, sf)), ["series_key", *_COUNTS, *_CHECKS], _METRICS)


def _holed(spark, sf) -> DataFrame:
    """Series whose middling values are missing."""
    v = F.col(VALUE)
    return series(spark, sf).withColumn(VALUE, F.when((v < 20) | (v > 60), v))


@query
def completeness(spark, sf):
    out = quality.completeness(_holed(spark, sf))
    return columns(out, ["series_key"], ["completeness", "completeness_by_cell"])


@query
def validity(spark, sf):
    raw = events(spark, sf).withColumnRenamed("event_type", "series_key")
    return columns(quality.validity(raw, Series(value="value")), ["series_key"], ["validity"])


@query
def anomaly_ratio(spark, sf):
    return columns(quality.anomaly_ratio(series(spark, sf)), ["series_key", "anomaly_ratio_ok"], ["anomaly_ratio"])


@query
def workday_difference(spark, sf):
    return columns(quality.workday_difference(series(spark, sf)), ["series_key"], ["workday_difference"])


@query
def daily_variation(spark, sf):
    return columns(quality.daily_variation(series(spark, sf)), ["series_key"], ["daily_variation"])


@query
def anomaly_gap(spark, sf):
    return columns(quality.anomaly_gap(series(spark, sf)), ["series_key"], ["avg_anomaly_gap_min"])


@query
def time_continuity(spark, sf):
    return quality.time_continuity(series(spark, sf))


@query
def out_of_order(spark, sf):
    """Arrival in a scrambled order, so that many rows come after a later one."""
    raw = series(spark, sf).withColumn("arrival", F.md5(F.col("event_id").cast("string")))
    return quality.out_of_order(raw, ["arrival"], parts=4)


@query
def dataset_report(spark, sf):
    out = quality.dataset_report(series(spark, sf))
    out = out.withColumns({c: F.unix_micros(c) for c in ("first_ts", "last_ts")})
    exact = ["series_key", "n_total", "first_ts", "last_ts", "n_normal", "n_anomaly"]
    return columns(out, exact, ["normal_ratio", "anomaly_ratio", "mean", "min", "max", "std_pop"])


@query
def dataset_report_nan(spark, sf):
    return columns(quality.dataset_report(with_gaps(spark, sf)), ["series_key", "n_total"], ["mean", "min", "max", "std_pop"])


@query
def preview(spark, sf):
    return quality.preview(series(spark, sf), 10).select(*ID, VALUE)


@query
def trailing_range(spark, sf):
    return quality.trailing_range(series(spark, sf), 24).select(*ID, VALUE)


@query
def row_gaps(spark, sf):
    return columns(quality.row_gaps(series(spark, sf), parts=4), ID, ["gap_seconds"])


@query
def label_summary(spark, sf):
    split = splits.chronological_split(_holed(spark, sf))
    return columns(quality.label_summary(split, [VALUE], by=["split"]), ["split", "n_rows", "n_missing"], ["label_mean"])


# --- fills, runs, latest -------------------------------------------------------------------------


@query
def fill_chain(spark, sf):
    return runs.fill_chain(_holed(spark, sf), [VALUE], parts=6).select(*ID, VALUE)


@query
def fill_chain_nan(spark, sf):
    return runs.fill_chain(with_gaps(spark, sf), [VALUE], parts=6).select(*ID, VALUE)


@query
def run_length(spark, sf):
    return runs.run_length(series(spark, sf), parts=6).select(*ID, "run_length")


@query
def current_run(spark, sf):
    out = runs.current_run(series(spark, sf).withColumn("is_anomaly", (F.col(VALUE) > 15).cast("int")))
    out = out.withColumns({c: F.unix_micros(c).cast("double") for c in ("latest_ts", "run_start")})
    return columns(out, ["series_key", "latest_ts", "is_anomalous", "run_start", "run_rows"], ["run_minutes"])


@query
def latest_row(spark, sf):
    return runs.latest_row(series(spark, sf)).select(*ID, VALUE, "is_anomaly")


@query
def recent_status(spark, sf):
    out = runs.recent_status(series(spark, sf), minutes=360)
    return out.select(*ID, "status_0", "status_1")


@query
def union_labels(spark, sf):
    rows = series(spark, sf)
    marks = [rows.filter(F.col(VALUE) >= 100), rows.filter(F.col(VALUE) < 1)]
    return runs.union_labels(rows, marks, spread=2, parts=4).select(*ID, "is_marked")


# --- detectors -----------------------------------------------------------------------------------


@query
def zscore_flags(spark, sf):
    return columns(detectors.zscore_flag(series(spark, sf), limit=1.5), [*ID, "z_score_anomaly"], ["z_score"])


@query
def iqr_flags(spark, sf):
    raw = events(spark, sf).withColumnRenamed("event_type", "series_key")
    return detectors.iqr_flag(raw, Series(value="value"), parts=4).select("event_id", "iqr_anomaly")


@query
def lof_flags(spark, sf):
    return detectors.lof_flag(series(spark, sf), parts=4, chunk_rows=400).select(*ID, "lof_anomaly")


@query
def isolation_flags(spark, sf):
    return detectors.isolation_forest_flag(series(spark, sf)).select(*ID, "iso_forest_anomaly")


@query
def consensus(spark, sf):
    rows = series(spark, sf).withColumns(scalar.threshold_flags(VALUE))
    flags = ("is_anomaly", "is_high_usage", "is_very_high_usage", "is_low_usage")
    return detectors.consensus(rows, flags).select(*ID, "algorithm_consensus", "algorithm_agreement")


@query
def interaction_products(spark, sf):
    z = detectors.zscore_flag(detectors.lof_flag(series(spark, sf)))
    out = z.withColumn("lof_x_zscore", F.col("lof_anomaly") * F.col("z_score"))
    return columns(out, ID, ["lof_x_zscore"])


@query
def all_features(spark, sf):
    return columns(features.all_features(series(spark, sf)), ID, features.feature_names())


@query
def all_features_exact(spark, sf):
    """All features over several parts and chunks."""
    out = features.all_features(series(spark, sf), parts=5, chunk_rows=900)
    return columns(out, ID, features.feature_names())


# --- splits and models ---------------------------------------------------------------------------

SPLIT_IDS = ["series_key", "event_id"]


@query
def stratified_split(spark, sf):
    return splits.stratified_split(series(spark, sf), SPLIT_IDS, parts=4).select(*ID, "is_anomaly", "split")


@query
def chrono_split(spark, sf):
    return splits.chronological_split(series(spark, sf), parts=4).select(*ID, "split")


@query
def folds(spark, sf):
    return splits.stratified_folds(series(spark, sf), SPLIT_IDS).select(*ID, "fold")


@query
def class_weights(spark, sf):
    return columns(evaluate.class_weights(series(spark, sf)), ["is_anomaly", "n"], ["weight"])


@query
def scaled(spark, sf):
    rows = series(spark, sf).withColumn("hour", F.hour("ts").cast("double")).withColumn("constant", F.lit(3.0))
    names = [VALUE, "hour", "constant"]
    return columns(models.fit_scaler(rows, names).transform(rows), ID, names)


POINT = calendar.POINT_FEATURES


def _points(spark, sf) -> DataFrame:
    """Six features per sample, weighted and dealt to folds."""
    rows = series(spark, sf).withColumn("epoch", calendar.ts_to_epoch("ts"))
    rows = calendar.point_features(rows, "epoch", VALUE)
    ready = models.assemble(models.with_class_weights(rows), POINT)
    return materialize(splits.stratified_folds(ready, SPLIT_IDS), "points")


@query
def rf_scores(spark, sf):
    points = _points(spark, sf)
    model = models.train_random_forest(points, numTrees=20, maxDepth=7)
    return columns(models.predict(model, points.drop("weight", "fold"), 0.75).select(*ID, "probability", "prediction"),
                   [*ID, "prediction"], ["probability"])


@query
def rf_importance(spark, sf):
    model = models.train_random_forest(_points(spark, sf), numTrees=20, maxDepth=7)
    return models.top_features(models.feature_importance(spark, model, POINT), 5)


@query
def grid_search(spark, sf):
    grid = {"numTrees": [10, 20], "maxDepth": [3, 6], "minInstancesPerNode": [2]}
    return models.grid_search(_points(spark, sf), grid)[1]


@query
def cv_f1(spark, sf):
    return evaluate.cv_summary(models.cross_val_f1(_points(spark, sf), numTrees=10, maxDepth=5))


@query
def logreg_scores(spark, sf):
    rows = series(spark, sf)
    model = models.train_logistic(rows, [VALUE])
    return columns(models.predict(model, rows), [*ID, "prediction"], ["probability"])


@query
def threshold_predictions(spark, sf):
    return scores(spark, sf).select(*ID, "prediction")


@query
def training_history(spark, sf):
    """A training on all features with the whole grid: every field of its history, and the number of features."""
    bundle, _ = models.train(series(spark, sf))
    return bundle.history.select(
        "train_size", "test_size", "anomaly_ratio", "cv_f1_mean", "cv_f1_std", "test_roc_auc", "test_pr_auc",
        F.size("feature_importance").alias("n_features"), "best_params", "best_cv_score", "class_weights",
        "feature_importance", "confusion_matrix",
    )


@query
def score_rows(spark, sf):
    """Train on the first 80 % of each series, store and load the model, score the rest."""
    split = materialize(splits.chronological_split(series(spark, sf)), "split")
    bundle, _ = models.train(split.filter("split = 'train'").drop("split"), grid={"numTrees": [20], "maxDepth": [6]})
    path = fresh_path(spark, "bundle")
    models.save_model(bundle, path)
    unlabelled = split.filter("split = 'test'").drop("split", "is_anomaly")
    out = models.score(unlabelled, models.load_model(spark, path), threshold=0.75)
    return out.select(*ID, VALUE, "probability", "prediction", "n_missing_features")


# One tree on all rows and features decides nothing at random, so its scores follow in SQL.
_TREE = {"bootstrap": False, "featureSubsetStrategy": "all"}
_TREE_FEATURES = ["band", "last_digit", "hour", "weekday"]
_TRAIN_FEATURES = ["hour", "weekday", "is_high_usage", "high_usage_streak_3", "high_usage_streak_10"]


def _tree_points(spark, sf) -> DataFrame:
    """Four features of few values per sample, weighted and dealt to folds."""
    whole = F.floor(VALUE)
    rows = series(spark, sf).withColumns({
        "band": F.least(F.floor(F.col(VALUE) / 40), F.lit(2)), "last_digit": F.pmod(whole, F.lit(10)),
        "hour": F.hour("ts"), "weekday": F.weekday("ts"),
    })
    ready = models.assemble(models.with_class_weights(rows), _TREE_FEATURES)
    return materialize(splits.stratified_folds(ready, SPLIT_IDS), "points")


@query
def tree_scores(spark, sf):
    points = _tree_points(spark, sf)
    model = models.train_random_forest(points, numTrees=1, maxDepth=2, **_TREE)
    out = models.predict(model, points.drop("weight", "fold"), 0.75)
    return columns(out, [*ID, "prediction"], ["probability"])


@query
def tree_importance(spark, sf):
    model = models.train_random_forest(_tree_points(spark, sf), numTrees=1, maxDepth=2, **_TREE)
    found = models.feature_importance(spark, model, _TREE_FEATURES)
    return columns(models.top_features(found, 2), ["feature"], ["importance"])


@query
def tree_cv_f1(spark, sf):
    return columns(models.cross_val_f1(_tree_points(spark, sf), numTrees=1, maxDepth=2, **_TREE), ["fold"], ["f1"])


@query
def tree_cv_summary(spark, sf):
    found = models.cross_val_f1(_tree_points(spark, sf), numTrees=1, maxDepth=2, **_TREE)
    return columns(evaluate.cv_summary(found), [], ["cv_mean", "cv_spread"])


@query
def tree_search(spark, sf):
    grid = {"maxDepth": [1, 2], "minInstancesPerNode": [2]}
    found = models.grid_search(_tree_points(spark, sf), grid, estimator=models.random_forest(numTrees=1, **_TREE))[1]
    return columns(found, [F.col(c).cast("int").alias(c) for c in grid], ["f1_mean", "f1_std"])


@query
def tree_history(spark, sf):
    grid = {"numTrees": [1], "maxDepth": [1, 2], "minInstancesPerNode": [2]}
    bundle, _ = models.train(series(spark, sf), features=_TRAIN_FEATURES, grid=grid, forest=_TREE)
    cell = lambda i, j: F.col("confusion_matrix")[i][j]
    weight = lambda y: F.get_json_object("class_weights", f"$.{y}").cast("double")
    top = F.array_sort(F.transform("feature_importance", lambda x: F.struct(-x["importance"], x["feature"])))[0]
    out = bundle.history.withColumns({
        "tn": cell(0, 0), "fp": cell(0, 1), "fn": cell(1, 0), "tp": cell(1, 1), "weight_0": weight(0),
        "weight_1": weight(1), "top_feature": top["feature"],
        "best_depth": F.get_json_object("best_params", "$.maxDepth").cast("int"),
    })
    return columns(
        out, ["train_size", "test_size", "tn", "fp", "fn", "tp", "top_feature", "best_depth"],
        ["anomaly_ratio", "weight_0", "weight_1", "best_cv_score", "cv_f1_std", "test_roc_auc", "test_pr_auc"],
    )


@query
def tree_reload(spark, sf):
    """Train on the first 80 % of each series, store and load the model, score the rest."""
    split = materialize(splits.chronological_split(series(spark, sf)), "split")
    known = split.filter("split = 'train'").drop("split")
    grid = {"numTrees": [1], "maxDepth": [2]}
    bundle, _ = models.train(known, features=_TRAIN_FEATURES, grid=grid, forest=_TREE)
    path = fresh_path(spark, "bundle")
    models.save_model(bundle, path)
    unlabelled = split.filter("split = 'test'").drop("split", "is_anomaly")
    out = models.score(unlabelled, models.load_model(spark, path), threshold=0.75)
    return columns(out, [*ID, "prediction", "n_missing_features"], ["probability"])


@query
def logistic_levels(spark, sf):
    """Fitted probability per length of the high-usage streak, of a regression run to convergence."""
    rows = materialize(rolling.high_usage_counts(series(spark, sf)), "streaks")
    model = models.train_logistic(rows, ["high_usage_streak_10"], tol=1e-12, maxIter=500)
    out = models.predict(model, rows).groupBy("high_usage_streak_10", "prediction")
    return columns(out.agg(F.count(F.lit(1)).alias("n"), F.max("probability").alias("probability")),
                   ["high_usage_streak_10", "prediction", "n"], ["probability"])


# --- evaluation ----------------------------------------------------------------------------------


@query
def confusion(spark, sf):
    return evaluate.confusion_matrix(scores(spark, sf))


@query
def class_report(spark, sf):
    out = evaluate.classification_report(scores(spark, sf))
    return columns(out, ["class", "support"], ["precision", "recall", "f1"])


@query
def accuracy(spark, sf):
    return columns(evaluate.accuracy(scores(spark, sf)), [], ["accuracy"])


@query
def roc_curve(spark, sf):
    out = evaluate.roc_curve(scores(spark, sf), parts=4).filter(F.col("threshold") < math.inf)
    return columns(out, [], ["threshold", "fpr", "tpr"])


@query
def roc_auc(spark, sf):
    return columns(evaluate.roc_auc(scores(spark, sf), parts=4), [], ["roc_auc"])


@query
def pr_curve(spark, sf):
    out = evaluate.pr_curve(scores(spark, sf), parts=4).filter(F.col("threshold") < math.inf)
    return columns(out, [], ["threshold", "precision", "recall"])


@query
def pr_auc(spark, sf):
    return columns(evaluate.pr_auc(scores(spark, sf), parts=4), [], ["pr_auc"])


@query
def prediction_summary(spark, sf):
    return columns(evaluate.prediction_summary(scores(spark, sf)), ["anomaly_count", "total_count"], ["anomaly_ratio"])


@query
def probability_range(spark, sf):
    out = evaluate.probability_range(scores(spark, sf), 0.8)
    return columns(out, ["n_below_threshold"], ["min_probability", "max_probability"])


# --- files and exchange formats ------------------------------------------------------------------


@query
def csv_roundtrip(spark, sf):
    path = fresh_path(spark, "csv")
    files.write_scored_csv(series(spark, sf), path, status="is_anomaly", keys=("series_key",))
    return files.read_metric_csv(spark, path)


def _damaged_csv(spark, sf) -> str:
    """A CSV with quotes and blanks in its header, and cells and lines that do not fit it."""
    path = fresh_path(spark, "csv")
    rest = lambda n: F.pmod("event_id", F.lit(n)) == 0
    when = F.when(rest(53), F.lit("soon")).otherwise(calendar.ts_to_epoch("ts").cast("string"))
    value = F.when(rest(97), F.lit("n/a")).when(rest(89), F.lit("")).otherwise(F.col(VALUE).cast("string"))
    label = F.when(rest(211), F.lit("maybe")).otherwise(F.col("is_anomaly").cast("string"))
    line = F.when(rest(307), F.concat_ws(",", F.col("event_id").cast("string"), when)).otherwise(
        F.concat_ws(",", F.col("event_id").cast("string"), when, value, label)
    )
    head = spark.createDataFrame([("' event_id',\"timestamp\" , cpu_utilization ,is_anomaly'",)], "value string")
    lines = series(spark, sf).select(line.alias("value"))
    head.union(lines).coalesce(1).write.text(path)
    return path


@query
def dirty_header(spark, sf):
    out = quality.require_columns(files.read_metric_csv(spark, _damaged_csv(spark, sf)), ["event_id", "timestamp", VALUE, "is_anomaly"], check_empty=True)
    known = [F.coalesce(c, F.lit(-1)).alias(c) for c in ("timestamp", "is_anomaly")]
    return out.select(F.col("event_id").cast("long").alias("event_id"), VALUE, *known)


@query
def csv_rescued(spark, sf):
    """The cells and lines that could not be read."""
    rows = files.read_metric_csv(spark, _damaged_csv(spark, sf), rescue="rescued").filter("rescued IS NOT NULL")
    cells = {f"{c}_text": F.try_element_at("rescued", F.lit(c)) for c in ("timestamp", VALUE, "is_anomaly", "_line")}
    return rows.select(F.col("event_id").cast("long").alias("event_id"), *[c.alias(n) for n, c in cells.items()])


@query
def csv_rescue_report(spark, sf):
    return files.rescue_report(files.read_metric_csv(spark, _damaged_csv(spark, sf), rescue="rescued"))


@query
def two_column_csv(spark, sf):
    path = fresh_path(spark, "csv")
    files.scored_rows(series(spark, sf), status="is_anomaly").write.option("header", True).csv(path)
    return files.read_two_column_csv(spark, path)


@query
def range_json(spark, sf):
    """Responses of at most 512 points each, written as JSON lines and read back."""
    point = F.array(calendar.ts_to_epoch("ts").cast("string"), F.col(VALUE).cast("string"))
    grouped = (
        series(spark, sf)
        .groupBy("series_key", F.floor(F.col("event_id") / 512).alias("block"))
        .agg(F.collect_list(point).alias("values"))
    )
    result = F.array(F.struct(F.create_map(F.lit("host_name"), "series_key").alias("metric"), "values"))
    path = fresh_path(spark, "responses")
    grouped.select(
        F.lit("success").alias("status"),
        F.struct(F.lit("matrix").alias("resultType"), result.alias("result")).alias("data"),
    ).write.json(path)
    return exchange.read_range_response(spark, path, multi_line=False).select("series_key", "timestamp", VALUE)


@query
def exposition_lines(spark, sf):
    path = fresh_path(spark, "lines")
    exchange.write_exposition(series(spark, sf), path, status="is_anomaly", labels=("series_key",))
    return spark.read.text(path)


# --- streams -------------------------------------------------------------------------------------


def stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = events(spark, sf).schema
    return series_view(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf))


def _live_scorer(df: DataFrame) -> DataFrame:
    out = rolling.rolling_stats(df, (5,), stats=("mean",)).withColumn("probability", F.col("5min_mean") / 100)
    return models.flag_by_threshold(out, 0.4)


def _run_live(spark, sf, **options) -> str:
    path = fresh_path(spark, "live")
    live.live_score(stream(spark, sf), _live_scorer, path, hours=12, poll=None, **options).awaitTermination()
    return path


@query
def stream_live_score(spark, sf):
    path = _run_live(spark, sf)
    schema = (
        "series_key string, ts timestamp, event_id long, cpu_utilization double, is_anomaly int, "
        "5min_mean double, probability double, prediction int"
    )
    return columns(live.current_status(spark, path, schema), [*ID, VALUE, "prediction"], ["probability"])


@query
def status_write_back(spark, sf):
    path = _run_live(spark, sf, exposition=True)
    return spark.read.text(f"{path}/lines").select("value")


def _counter_samples(spark, sf) -> DataFrame:
    """Two processors per host, with a counter that restarts whenever it has gained 50 seconds."""
    raw = events(spark, sf).select(
        F.col("event_type").alias("host_name"), F.pmod("user_id", F.lit(2)).alias("cpu"), "ts", "event_id", "value"
    )
    laid = lay_out(raw, ["host_name", "cpu"], ["ts", "event_id"])
    total = F.round("seconds_total", 4)
    return laid.running({"seconds_total": ("sum", F.col("value") / 100)}).withColumn("seconds_total", total % 50)


@query
def counter_rate(spark, sf):
    samples = _counter_samples(spark, sf)
    out = counters.counter_rate_utilization(samples, ["host_name"], tie=["event_id"], width="1 hour")
    return columns(out.withColumn("window_start", F.unix_timestamp("window_start")), ["host_name", "window_start"], ["utilization"])


@query
def counter_rate_stepped(spark, sf):
    """The rate of the last two hours every half hour."""
    samples = _counter_samples(spark, sf)
    out = counters.counter_rate_at_steps(samples, ["host_name"], step_seconds=1800, range_seconds=7200, tie=["event_id"])
    return columns(out.withColumn("step_at", F.unix_timestamp("step_at")), ["host_name", "step_at"], ["utilization"])


@query
def counter_rate_between(spark, sf):
    """As above, between the samples only."""
    samples = _counter_samples(spark, sf)
    out = counters.counter_rate_at_steps(samples, ["host_name"], step_seconds=1800, range_seconds=7200, tie=["event_id"], extrapolate=False)
    return columns(out.withColumn("step_at", F.unix_timestamp("step_at")), ["host_name", "step_at"], ["utilization"])


@query
def range_grid_lookback(spark, sf):
    """The newest sample of the five minutes before each half minute."""
    out = counters.range_at_steps(series(spark, sf), ["series_key"], tie=["event_id"])
    return columns(out.withColumn("step_at", F.unix_timestamp("step_at")), ["series_key", "step_at"], [VALUE, "age_seconds"])


@query
def range_grid_week(spark, sf):
    """Every hour of the week from 2024-01-08, samples up to six hours old; gaps and NaN are no samples."""
    begin = datetime(2024, 1, 8, tzinfo=timezone.utc)
    out = counters.range_at_steps(
        with_gaps(spark, sf), ["series_key"], tie=["event_id"], step_seconds=3600, lookback_seconds=21600, start=begin,
        end=begin + timedelta(days=7),
    )
    return columns(out.withColumn("step_at", F.unix_timestamp("step_at")), ["series_key", "step_at"], [VALUE, "age_seconds"])


@query
def range_grid(spark, sf):
    out = counters.range_grid(series(spark, sf), ["series_key"], tie=["event_id"])
    return out.select("series_key", F.unix_timestamp("step_start").alias("step_start"), VALUE)


@query
def range_grid_gaps(spark, sf):
    out = counters.range_grid(series(spark, sf), ["series_key"], tie=["event_id"], step_seconds=300, fill_gaps=True)
    return out.select("series_key", F.unix_timestamp("step_start").alias("step_start"), VALUE)


@query
def tumbling_stats(spark, sf):
    path = fresh_path(spark, "tumbling")
    live.stream_tumbling(stream(spark, sf), path, poll=None).awaitTermination()
    out = live.read_tumbling(spark, path).withColumn("window_start", F.unix_timestamp("window_start"))
    return columns(out, ["series_key", "window_start", "n_rows"], ["mean", "validity", "anomaly_ratio"])


@query
def tumbling_stats_nan(spark, sf):
    out = live.tumbling_stats(with_gaps(spark, sf)).withColumn("window_start", F.unix_timestamp("window_start"))
    return columns(out, ["series_key", "window_start", "n_rows"], ["mean", "validity", "anomaly_ratio"])


@query
def run_tracker(spark, sf):
    """Four restarts, each after a quarter of the time; a third of the rows arrive up to an hour late."""
    path, folder = fresh_path(spark, "runs"), fresh_path(spark, "arrivals")
    rows = series(spark, sf).withColumn("is_anomaly", (F.col(VALUE) > 15).cast("int"))
    delay = F.when(F.pmod("event_id", F.lit(3)) == 0, F.pmod(F.col("event_id") * 37, F.lit(3600))).otherwise(0)
    arrivals = rows.withColumn("_at", F.unix_timestamp("ts") + delay)
    first, last = arrivals.agg(F.min("_at"), F.max("_at")).first()
    for quarter in range(4):
        part = F.least(F.floor((F.col("_at") - first) * 4 / max(last - first, 1)), F.lit(3))
        arrivals.filter(part == quarter).drop("_at").write.mode("append").parquet(folder)
        live.track_runs(spark.readStream.schema(rows.schema).parquet(folder), path, poll=None).awaitTermination()
    state = live.read_runs(spark, path).withColumn("run_start", F.unix_micros("run_start").cast("double"))
    return columns(state, ["series_key", "run_start", "run_rows"], ["run_minutes"])
