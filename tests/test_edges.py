"""Edge cases: tiny, constant, missing, tied and odd inputs."""

import math

import pytest
from pyspark.sql import functions as F

from helpers import by_event, same
from metricloom import Series
from metricloom.functions import calendar, scalar
from metricloom.operators import detectors, evaluate, features, models, quality, rolling, runs, stats
from metricloom.plans.profile import value_profile


def test_one_row_and_constant_series(table):
    both = features.all_features(table([50.0]).union(table([7.0] * 30, key="flat"))).cache()
    row = both.filter("series_key = 'a'").first()
    assert (row["5min_std"], row["5min_trend"], row["cpu_rank"], row["cpu_normalized"]) == (0, 0, 1, 0)
    assert (row["iso_forest_anomaly"], row["lof_anomaly"], row["z_score"]) == (0, 0, 0)
    assert quality.anomaly_gap(table([50.0], [1])).first()[1] == -1

    out = both.filter("series_key = 'flat'")
    row = out.agg(*[F.max(c).alias(c) for c in ("cpu_normalized", "z_score", "iqr_anomaly", "60min_std", "5min_trend")])
    assert list(row.first()) == [0, 0, 0, 0, 0]
    scaled = models.fit_scaler(out, ["cpu_utilization"]).transform(out)
    assert scaled.agg(F.max(F.abs("cpu_utilization"))).first()[0] == 0


@pytest.mark.parametrize(
    "values, filled",
    [
        ([None, 2.0, 3.0], [2, 2, 3]),
        ([1.0, None, 3.0], [1, 1, 3]),
        ([1.0, 2.0, None], [1, 2, 2]),
        ([None, None, None], [0, 0, 0]),
    ],
)
def test_fill_chain(table, values, filled):
    for parts in (None, 3):
        assert by_event(runs.fill_chain(table(values), ["cpu_utilization"], parts=parts), "cpu_utilization") == filled


def test_missing_values_in_features(table):
    values = [None, 10.0, None, 40.0, 30.0, None]
    out = features.all_features(table(values), parts=2, chunk_rows=2)
    assert by_event(out, "cpu_utilization") == [10, 10, 10, 40, 30, 30]
    assert by_event(out, "cpu_deviation_daily") == pytest.approx([-50 / 3, -50 / 3, -50 / 3, 40 / 3, 10 / 3, 10 / 3])
    assert by_event(out, "5min_mean") == pytest.approx([10, 10, 10, 25, 80 / 3, 80 / 3])
    assert by_event(out, "5min_trend")[-1] == pytest.approx(55 / 7)
    assert out.select(*[F.sum(F.col(c).isNull().cast("int")) for c in features.feature_names()]).first() == tuple([0] * 64)


def test_input_order_does_not_matter(skewed):
    shuffled = skewed.orderBy(F.rand(1)).repartition(7)
    same(features.all_features(skewed), features.all_features(shuffled))


def test_strict_value_bounds_and_inclusive_hours(spark):
    df = spark.createDataFrame([(v,) for v in (10.0, 80.0, 90.0, 9.99, 80.01, 90.01)], "v double")
    flags = df.select(*[c.alias(n) for n, c in scalar.threshold_flags("v").items()])
    assert [tuple(r) for r in flags.collect()] == [(0, 0, 0), (0, 0, 0), (1, 0, 0), (0, 0, 1), (1, 0, 0), (1, 1, 0)]
    hours = spark.createDataFrame([(h * 3600,) for h in (8, 9, 10, 16, 17, 18)], "e long")
    hours = calendar.calendar_features(hours.withColumn("ts", F.timestamp_seconds("e")))
    assert [r["is_business_hour"] for r in hours.orderBy("e").collect()] == [0, 1, 1, 1, 1, 0]
    assert [r["is_peak_hour"] for r in hours.orderBy("e").collect()] == [0, 0, 1, 1, 0, 0]


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (1.005,)], "v double").select(scalar.round2("v"))
    assert [r[0] for r in df.collect()] == [0.12, 0.38, 1.0]


def test_infinite_features_become_zero(spark):
    df = spark.createDataFrame([(math.inf,), (-math.inf,), (math.nan,), (None,), (2.0,)], "v double")
    assert [r[0] for r in scalar.clean_numeric(df, ["v"]).collect()] == [0, 0, 0, 0, 2]


def test_seconds_and_milliseconds_agree(spark):
    seconds = spark.createDataFrame([("1704477540",), ("bad",)], "timestamp string")
    millis = spark.createDataFrame([("1704477540000",), ("bad",)], "timestamp string")
    a, b = (calendar.to_time_index(d).select("datetime").collect() for d in (seconds, millis))
    assert a == b and a[1][0] is None
    text = spark.createDataFrame([("2024-01-05 17:59:00",), ("no time",)], "datetime string")
    assert [r[0] is None for r in calendar.to_time_index(text).collect()] == [False, True]
    with pytest.raises(ValueError):
        calendar.to_time_index(spark.range(1))


def test_missing_time_breaks_continuity(table):
    holed = table([1.0, 2.0]).withColumn("ts", F.when(F.col("event_id") == 0, F.col("ts")))
    assert quality.quality_report(holed).first()["time_continuity"] == 0


def test_no_anomaly_and_one_anomaly_have_no_gap(table):
    for labels in ([0, 0], [0, 1]):
        assert quality.quality_report(table([1.0, 2.0], labels)).first()["avg_anomaly_gap_min"] == -1


def test_run_back_to_the_first_row(table):
    run = runs.current_run(table([1.0] * 4, [1] * 4)).first()
    assert (run["run_rows"], run["run_minutes"]) == (4, 3.0)
    calm = runs.current_run(table([1.0] * 4, [1, 1, 1, 0])).first()
    assert (calm["is_anomalous"], calm["run_rows"], calm["run_start"]) == (0, 0, None)


def test_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(0.75,), (0.7499,)], "probability double")
    assert [r["prediction"] for r in models.flag_by_threshold(df, 0.75).collect()] == [1, 0]


def test_many_copies_are_no_outliers(table):
    profile = value_profile(table([5.0] * 40 + [9.0]), ("series_key",), "cpu_utilization")
    scores = {r["cpu_utilization"]: r["score"] for r in detectors.lof_scores(profile).collect()}
    assert scores[5.0] == pytest.approx(-1.0)
    assert scores[9.0] < -1e6


def test_empty_predictions(spark):
    empty = spark.createDataFrame([], "is_anomaly int, prediction int, probability double")
    assert tuple(evaluate.prediction_summary(empty).first()) == (0, 0, 0.0)
    assert evaluate.roc_auc(empty).first()[0] is None


def test_null_series_key_is_a_series(table):
    keyless = table([1.0, 2.0, 3.0], key=None)
    assert by_event(rolling.rolling_stats(keyless, (5,)), "5min_mean") == [1, 1.5, 2]
    assert by_event(stats.percent_rank(keyless), "cpu_rank") == pytest.approx([1 / 3, 2 / 3, 1])


def test_required_columns(table):
    with pytest.raises(ValueError, match="nope"):
        quality.require_columns(table([1.0]), ["nope"])
    with pytest.raises(ValueError, match="empty"):
        quality.require_columns(table([1.0]).limit(0), ["ts"], check_empty=True)


def test_registry(micro):
    features.register_feature("double_value", lambda df: df.withColumn("twice", F.col("cpu_utilization") * 2))
    out = features.apply_features(micro, {"double_value": {}, "zscore": {"spec": Series()}})
    assert {"twice", "z_score"} <= set(out.columns)
    with pytest.raises(ValueError):
        features.register_feature("zscore", features.zscore)


def test_fitted_statistics_score_new_rows(table):
    fitted = features.fit_stats(table([0.0, 100.0]))
    out = features.all_features(table([50.0, 60.0]), stats=fitted)
    assert by_event(out, "cpu_normalized") == [0.5, 0.6]


def test_epoch_unit_is_decided_per_series(spark):
    from metricloom.functions.calendar import to_time_index

    rows = spark.createDataFrame([("a", 1_704_067_200), ("c", 1_704_067_200_000)], "series_key string, timestamp long")
    years = {r.series_key: r.datetime.year for r in to_time_index(rows, keys=("series_key",)).collect()}
    assert years == {"a": 2024, "c": 2024}
    assert {r.datetime.year for r in to_time_index(rows.filter("series_key = 'a'"), unit="ms").collect()} == {1970}


def test_null_labels_and_nan_values_are_missing(spark, table):
    from metricloom.operators import evaluate, stats

    labels = spark.createDataFrame([(0,), (0,), (0,), (1,), (None,)], "is_anomaly int")
    assert sorted(round(r.weight, 3) for r in evaluate.class_weights(labels).collect()) == [0.667, 2.0]
    row = stats.series_stats(table([1.0, 3.0, float("nan")])).first()
    assert (row.n_rows, row.n_values, row.v_mean, row.v_max) == (3, 2, 2.0, 3.0)


def test_forest_takes_any_parameter():
    from metricloom.operators.models import random_forest

    assert random_forest(featureSubsetStrategy="all", maxBins=64).getMaxBins() == 64
