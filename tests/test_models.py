"""Training, selection, storage and scoring."""

import itertools
import json

import pytest
from pyspark.sql import functions as F

from helpers import same
from metricloom.catalog.queries import QUERIES
from metricloom.functions import calendar
from metricloom.operators import evaluate, models, splits
from metricloom.plans import ordered, workspace
from metricloom.sources import files

SMALL = {"numTrees": [10], "maxDepth": [5], "minInstancesPerNode": [2]}
FEATURES = ["cpu_utilization", "hour", "5min_mean", "5min_std", "z_score", "is_high_usage"]


@pytest.fixture(scope="module")
def separable(spark):
    """Anomalies are the values above 80, with a little noise in the labels."""
    u = F.pmod(F.xxhash64("id"), F.lit(10_000)) / 100
    noise = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(100)) < 2
    return spark.range(1_500).select(
        F.concat(F.lit("s"), F.pmod("id", F.lit(3))).alias("series_key"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 20).alias("ts"),
        F.col("id").alias("event_id"),
        F.round(u, 2).alias("cpu_utilization"),
        F.when(noise, 0).otherwise((u > 80).cast("int")).alias("is_anomaly"),
    ).cache()


@pytest.fixture(scope="module")
def trained(separable):
    return models.train(separable, features=FEATURES, grid=SMALL)


def test_training_beats_the_majority(trained):
    bundle, scored = trained
    row = bundle.history.first()
    assert row["train_size"] + row["test_size"] == 1_500 and row["test_size"] == 300
    assert row["cv_f1_mean"] > 0.85 and row["test_roc_auc"] > 0.9 and row["test_pr_auc"] > 0.8
    assert len(row["feature_importance"]) == len(FEATURES)
    tn, fp, fn, tp = evaluate.confusion_matrix(scored).first()
    assert row["confusion_matrix"] == [[tn, fp], [fn, tp]]


def test_stored_model_scores_alike(spark, separable, trained, tmp_path):
    path = str(tmp_path / "bundle")
    models.save_model(trained[0], path)
    loaded = models.load_model(spark, path)
    assert loaded.features == FEATURES and loaded.history.count() == 1
    unlabelled = separable.drop("is_anomaly")
    first, second = models.score(unlabelled, trained[0]), models.score(unlabelled, loaded)
    same(first, second)
    assert first.agg(F.avg(((F.col("cpu_utilization") > 80).cast("int") == F.col("prediction")).cast("int"))).first()[0] > 0.95
    fitted = models.score(unlabelled, loaded, threshold=0.9, stats_scope="fitted")
    assert fitted.count() == 1_500 and fitted.filter("prediction = 1 and probability < 0.9").isEmpty()


def test_missing_part_raises(spark, tmp_path):
    with pytest.raises(Exception):
        models.load_model(spark, str(tmp_path / "nothing"))


def test_search_keeps_one_row_per_candidate(separable):
    rows = models.assemble(models.with_class_weights(separable), ["cpu_utilization"])
    ready = splits.stratified_folds(rows, ["event_id"]).cache()
    search, table = models.grid_search(ready, {"numTrees": [3], "maxDepth": [1, 4]})
    assert table.count() == 2 and search.bestModel.getOrDefault("maxDepth") in (1, 4)
    importance = models.feature_importance(separable.sparkSession, search.bestModel, ["cpu_utilization"])
    assert models.top_features(importance, 1).first()["importance"] == pytest.approx(1.0)
    folds = models.cross_val_f1(ready, numTrees=3, maxDepth=3)
    assert folds.count() == 3 and evaluate.cv_summary(folds).first()["cv_mean"] > 0.85


def test_full_grid_size():
    size = 1
    for values in models.GRID.values():
        size *= len(values)
    assert size == 12


def test_logistic_on_one_feature(separable):
    model = models.train_logistic(separable, ["cpu_utilization"])
    scored = models.predict(model, separable)
    assert evaluate.roc_auc(scored).first()[0] > 0.9
    assert evaluate.accuracy(scored).first()[0] > 0.9


def test_absent_features_are_zero_and_counted(micro):
    row = models.select_features(micro, ["cpu_utilization", "other"]).first()
    assert (row["other"], row["n_missing_features"]) == (0.0, 1)


def test_six_point_features(spark):
    df = spark.createDataFrame([(1704477540, 50.0)], "timestamp long, cpu double")
    row = calendar.point_features(df, "timestamp", "cpu").first()
    assert [row[c] for c in calendar.POINT_FEATURES[:4]] == [50.0, 17, 4, 0]
    assert row["hour_sin"] == pytest.approx(-0.9659258) and row["hour_cos"] == pytest.approx(-0.2588190)


def test_pipeline_from_file_to_stored_model(spark, skewed, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "model")
    rows = skewed.limit(600).withColumn("is_anomaly", (F.col("cpu_utilization") > 80).cast("int"))
    files.write_scored_csv(rows, source, status="is_anomaly", keys=("series_key",))
    run = models.train_pipeline(spark, source, target, features=["cpu_utilization", "hour"], grid={"numTrees": [3], "maxDepth": [3]})
    assert run.report.count() == 5 and run.passed is False
    loaded = models.load_model(spark, target)
    assert loaded.features == ["cpu_utilization", "hour"] and loaded.history.first()["cv_f1_mean"] > 0.9


def test_rows_with_features_are_made_once_and_stay(separable, monkeypatch):
    written = []

    def spy(df, label):
        limit = df.sparkSession.conf.get("spark.sql.codegen.hugeMethodLimit")
        written.append((label, set(df.columns), limit))
        return workspace.materialize(df, label)

    monkeypatch.setattr(models, "materialize", spy)
    monkeypatch.setattr(ordered, "materialize", spy)
    before = separable.sparkSession.conf.get("spark.sql.codegen.hugeMethodLimit")
    models.train(separable, features=FEATURES, grid=SMALL)
    assert not [label for label, columns, _ in written if label == "layout" and columns & {"5min_mean", models.VECTOR}]
    assert {label: limit for label, _, limit in written if label in ("features", "train")} == {"features": "8000", "train": "8000"}
    assert separable.sparkSession.conf.get("spark.sql.codegen.hugeMethodLimit") == before


def test_dealt_like_split_and_folds(separable):
    ids = ["series_key", "ts", "event_id"]
    dealt = splits.deal(separable, ids, parts=5).select("event_id", F.col("_split").alias("split"), F.col("_fold").alias("fold"))
    split = splits.stratified_split(separable, ids)
    fold = splits.stratified_folds(split.filter("split = 'train'").drop("split"), ids).select("event_id", "fold")
    same(dealt, split.select("event_id", "split").join(fold, "event_id", "left"))


def test_scaler_of_many_columns(spark):
    names = [f"c{i}" for i in range(19)]
    rows = spark.range(50).select(*[F.when(F.col("id") % 7 != i % 7, F.col("id") * (i % 5)).cast("double").alias(c) for i, c in enumerate(names)])
    found = models.fit_scaler(rows, names)
    plain = rows.agg(*[f(c).alias(f"{f.__name__}{c}") for c in names for f in (F.avg, F.stddev_pop)]).first()
    assert found.columns == tuple(names)
    assert found.means == pytest.approx([plain[f"avg{c}"] for c in names])
    assert found.scales == pytest.approx([plain[f"stddev_pop{c}"] or 1.0 for c in names])


def test_null_labels_are_filled_before_the_split(separable):
    rows = separable.withColumn("is_anomaly", F.when(F.col("event_id") % 50 != 7, F.col("is_anomaly")))
    bundle, scored = models.train(rows, features=FEATURES, grid=SMALL)
    row = bundle.history.first()
    assert (row["train_size"], row["test_size"]) == (1_200, 300) and scored.filter("is_anomaly is null").isEmpty()


def test_training_history_searches_the_whole_grid(spark, tmp_path, monkeypatch):
    """The search is told every candidate of the definition; here one small forest stands in for their fits."""
    rows = spark.range(400).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 600).alias("ts"),
        F.concat(F.lit("s"), F.pmod("id", F.lit(2))).alias("event_type"),
        (F.pmod(F.xxhash64("id"), F.lit(15_000)) / 100).alias("value"),
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    asked, search = [], models.CrossValidator

    def spy(**settings):
        asked.extend(({p.name: v for p, v in c.items()}, settings["numFolds"]) for c in settings["estimatorParamMaps"])
        return search(**{**settings, "estimatorParamMaps": [{p: 2 for p in settings["estimatorParamMaps"][0]}]})

    monkeypatch.setattr(models, "CrossValidator", spy)
    row = QUERIES["training_history"](spark, str(tmp_path)).first()
    wanted = itertools.product((100, 200), (10, 15, 30), (2, 5))
    assert asked == [({"numTrees": n, "maxDepth": d, "minInstancesPerNode": leaf}, 3) for n, d, leaf in wanted]
    assert json.loads(row["best_params"]) == {"numTrees": 2, "maxDepth": 2, "minInstancesPerNode": 2}
    (tn, fp), (fn, tp) = row["confusion_matrix"]
    positives = rows.filter("value > 120").count()
    assert tn + fp + fn + tp == row["test_size"] == 400 - row["train_size"] and fn + tp == round(0.2 * positives)
    assert list(json.loads(row["class_weights"])) == ["0", "1"]
    assert len(row["feature_importance"]) == row["n_features"] == 64


def test_nodes_kept_beside_rows_grow_the_same_forest(separable, trained):
    kept = models.train(separable, features=FEATURES, grid=SMALL, forest={"cacheNodeIds": True})[0]
    trees = lambda bundle: bundle.model.stages[-1].toDebugString.split("\n", 1)[1]
    assert kept.model.stages[-1].getOrDefault("cacheNodeIds") and trees(kept) == trees(trained[0])
    same(kept.history.drop("feature_importance", "confusion_matrix"), trained[0].history.drop("feature_importance", "confusion_matrix"))
