"""Numbers that were worked out by hand or with plain dataframe arithmetic."""

import pytest
from pyspark.sql import functions as F

from helpers import by_event
from metricloom.operators import evaluate, features, quality, rolling, runs, stats

GOLDEN = {
    "cpu_normalized": [0.055556, 0.166667, 0.166667, 1, 0.888889, 0.972222, 0, 0.844444],
    "cpu_rank": [0.25, 0.4375, 0.4375, 1, 0.75, 0.875, 0.125, 0.625],
    "cpu_deviation_from_mean": [-1.016038, -0.768601, -0.768601, 1.087177, 0.83974, 1.025317, -1.139757, 0.740765],
    "cpu_deviation_hourly": [0, -36.928571, -36.928571, 38.071429, 28.071429, 35.571429, -51.928571, 24.071429],
    "5min_mean": [10, 15, 16.666667, 36.25, 46, 62.5, 59.5, 71.7],
    "5min_std": [0, 7.071068, 5.773503, 39.449335, 40.527768, 38.971143, 43.387786, 37.708752],
    "5min_trend": [0, 10, 5, 25.5, 22.5, 21, -3.25, -10.8],
    "5min_pct_change": [0, 0.333333, 0.2, 1.62069, 0.847826, 0.48, -0.915966, 0.129707],
    "high_usage_streak_3": [0, 0, 0, 1, 2, 3, 2, 2],
}


@pytest.fixture(scope="module")
def featured(spark):
    from conftest import LABELS, SCHEMA, START, VALUES
    from datetime import timedelta

    rows = [("a", START + timedelta(minutes=i), i, v, y) for i, (v, y) in enumerate(zip(VALUES, LABELS))]
    return features.all_features(spark.createDataFrame(rows, SCHEMA)).cache()


def test_there_are_64_features(featured):
    assert len(features.feature_names()) == 64
    assert len(set(features.feature_names())) == 64
    assert set(features.feature_names()) <= set(featured.columns)


@pytest.mark.parametrize("column", GOLDEN)
def test_golden_feature(featured, column):
    assert by_event(featured, column) == pytest.approx(GOLDEN[column], abs=1e-5)


def test_calendar_of_a_friday_evening(featured):
    first = featured.orderBy("event_id").first()
    assert (first["hour"], first["weekday"], first["minute"]) == (17, 4, 59)
    assert (first["is_weekend"], first["is_business_hour"], first["is_peak_hour"]) == (0, 1, 0)


def test_quality_of_the_micro_series(micro):
    report = quality.quality_report(micro).first()
    assert report["avg_anomaly_gap_min"] == pytest.approx(4 / 3)
    assert report["daily_variation"] == pytest.approx(46.928571, abs=1e-5)
    assert report["anomaly_ratio"] == 50
    assert report["workday_difference"] is None
    assert (report["n_total"], report["n_anomalies"], report["time_continuity"]) == (8, 4, 1)


def test_describe_and_quartiles(micro):
    row = stats.describe(micro).first()
    assert (row["count"], row["mean"], row["p25"], row["p75"]) == (8, 51.0625, 17.5, 86.875)
    assert row["std"] == pytest.approx(40.414316, abs=1e-5)


def test_balanced_weights(micro):
    assert [r["weight"] for r in evaluate.class_weights(micro).collect()] == [1.0, 1.0]


def test_current_run_of_one_row_lasts_no_time(micro):
    run = runs.current_run(micro).first()
    assert (run["is_anomalous"], run["run_rows"], run["run_minutes"]) == (1, 1, 0.0)


def test_run_length(micro):
    assert by_event(runs.run_length(micro, parts=3), "run_length") == [0, 0, 0, 1, 2, 3, 0, 1]


def test_interpolated_pr_and_roc(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.6)]
    df = spark.createDataFrame(rows, "is_anomaly int, probability double")
    assert evaluate.roc_auc(df).first()[0] == pytest.approx(0.75)
    assert evaluate.pr_auc(df).first()[0] == pytest.approx(0.5 * 1 + 0.5 * (0.5 + 2 / 3) / 2)


def test_time_frames_follow_time_not_rows(spark):
    rows = [("a", t, t, float(t), 0) for t in (0, 59, 60, 61, 300)]
    df = spark.createDataFrame(rows, "series_key string, s long, event_id long, cpu_utilization double, is_anomaly int")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    out = rolling.rolling_by_time(df, 1)
    assert by_event(out, "1min_count") == [1, 2, 2, 3, 1]
