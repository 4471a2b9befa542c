"""Training, selection, scoring and storage of classifiers on Spark ML."""

from __future__ import annotations

import itertools
import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from metricloom.functions.calendar import to_time_index
from metricloom.functions.scalar import clean_numeric
from metricloom.operators import evaluate
from metricloom.operators.features import all_features, feature_names, fit_stats
from metricloom.operators.quality import quality_report
from metricloom.operators.runs import fill_chain
from metricloom.operators.splits import deal
from metricloom.plans.attach import attach, row_hash
from metricloom.plans.ordered import lay_out, order_series
from metricloom.plans.workspace import compiled, delete_folder, file_names, materialize, publish_file
from metricloom.series import Series
from metricloom.sources.files import read_metric_csv

VECTOR = "features"
SEED = 42
# The search grid. Unlimited depth is Spark's maximum of 30.
GRID = {"numTrees": [100, 200], "maxDepth": [10, 15, 30], "minInstancesPerNode": [2, 5]}


@dataclass(frozen=True)
class Scaler:
    """Zero mean and unit population variance; a constant column is only centred."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: (F.col(c) - F.lit(m)) / F.lit(s) for c, m, s in zip(self.columns, self.means, self.scales)}
        )

    def stage(self) -> SQLTransformer:
        """The same arithmetic as a storable ML stage writing `_scaled_*` columns."""
        scaled = ", ".join(
            f"(`{c}` - ({m!r}D)) / {s!r}D AS `_scaled_{c}`"
            for c, m, s in zip(self.columns, self.means, self.scales)
        )
        return SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")


SCALED_AT_ONCE = 8


def fit_scaler(df: DataFrame, columns: list[str]) -> Scaler:
    """Aggregates of a few columns each, in one job; two numbers per column come back.

    Each reads its own columns only. One aggregate of all columns is a method too long for the JIT compiler.
    """
    cuts = range(0, len(columns), SCALED_AT_ONCE)
    parts = [
        df.agg(F.array(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")) for c in columns[i : i + SCALED_AT_ONCE]]).alias("_of"))
        .withColumn("_from", F.lit(i))
        for i in cuts
    ]
    rows = sorted(reduce(DataFrame.unionByName, parts).collect(), key=lambda r: r["_from"]) if parts else []
    found = [cell for r in rows for cell in r["_of"]]
    return Scaler(tuple(columns), tuple(float(c["m"] or 0.0) for c in found), tuple(float(c["s"] or 1.0) for c in found))


def select_features(df: DataFrame, features: list[str]) -> DataFrame:
    """Add absent features as 0 and count them in `n_missing_features`; clean the rest."""
    missing = [f for f in features if f not in df.columns]
    df = df.withColumns({f: F.lit(0.0) for f in missing})
    return clean_numeric(df, features).withColumn("n_missing_features", F.lit(len(missing)))


def with_class_weights(df: DataFrame, label: str = "is_anomaly") -> DataFrame:
    weights = evaluate.class_weights(df, label).select(label, "n", "weight")
    return attach(df, weights, [label], weight="n").drop("n")


def assemble(df: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=VECTOR).transform(df)


def random_forest(label: str = "is_anomaly", weight: str | None = "weight", **params) -> RandomForestClassifier:
    """Any parameter of Spark's forest; `maxBins` (32) bounds the split points tried per feature."""
    settings = {"featureSubsetStrategy": "sqrt", "seed": SEED, "maxBins": 32, **params}
    forest = RandomForestClassifier(featuresCol=VECTOR, labelCol=label, **settings)
    return forest.setWeightCol(weight) if weight else forest


def train_random_forest(df: DataFrame, label: str = "is_anomaly", weight: str | None = "weight", **params):
    """Class-weighted random forest on the `features` vector."""
    return random_forest(label, weight, **params).fit(df)


def train_logistic(df: DataFrame, columns: list[str], label: str = "is_anomaly", **params) -> PipelineModel:
    """Logistic regression with the usual unit L2 penalty on the summed loss; `params` are Spark's, such as `tol`."""
    assembler = VectorAssembler(inputCols=columns, outputCol=VECTOR)
    rows = df.count()
    settings = {"regParam": 1.0 / max(rows, 1), "elasticNetParam": 0.0, "standardization": False, **params}
    logistic = LogisticRegression(featuresCol=VECTOR, labelCol=label, **settings)
    return PipelineModel(stages=[assembler, logistic.fit(assembler.transform(df))])


def f1_evaluator(label: str = "is_anomaly") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol="prediction", metricName="fMeasureByLabel", metricLabel=1.0
    )


def grid_search(
    df: DataFrame,
    grid: dict[str, list] | None = None,
    label: str = "is_anomaly",
    estimator: Estimator | None = None,
    folds: int = 3,
    parallelism: int = 4,
) -> tuple[CrossValidatorModel, DataFrame]:
    """Cross-validated search by F1 of the anomaly class; rows carry `fold`.

    Returns the fitted search and one row per candidate.
    """
    grid = grid or GRID
    forest = estimator or random_forest(label)
    names = list(grid)
    candidates = [
        {forest.getParam(n): v for n, v in zip(names, values)} for values in itertools.product(*grid.values())
    ]
    search = CrossValidator(
        estimator=forest,
        estimatorParamMaps=candidates,
        evaluator=f1_evaluator(label),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    ).fit(df)
    table = [
        (*[c[forest.getParam(n)] for n in names], float(mean), float(std))
        for c, mean, std in zip(candidates, search.avgMetrics, search.stdMetrics)
    ]
    return search, df.sparkSession.createDataFrame(table, [*names, "f1_mean", "f1_std"])


def cross_val_f1(df: DataFrame, label: str = "is_anomaly", folds: int = 3, **params) -> DataFrame:
    """F1 of the anomaly class on each fold for one setting: (fold, f1)."""
    scores = []
    for fold in range(folds):
        model = train_random_forest(df.filter(F.col("fold") != fold), label, **params)
        scores.append((fold, float(f1_evaluator(label).evaluate(model.transform(df.filter(F.col("fold") == fold))))))
    return df.sparkSession.createDataFrame(scores, "fold int, f1 double")


def feature_importance(spark: SparkSession, model, features: list[str]) -> DataFrame:
    values = model.featureImportances.toArray()
    return spark.createDataFrame(
        [(f, float(v)) for f, v in zip(features, values)], "feature string, importance double"
    )


def top_features(importance: DataFrame, k: int = 5) -> DataFrame:
    return importance.orderBy(F.col("importance").desc(), "feature").limit(k)


def flag_by_threshold(df: DataFrame, threshold: float = 0.5, probability: str = "probability") -> DataFrame:
    """Add `prediction`: 1 where the probability reaches the threshold."""
    return df.withColumn("prediction", (F.col(probability) >= F.lit(threshold)).cast("int"))


def predict(model, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows with the anomaly probability and the thresholded prediction; keys travel with the row."""
    scored = model.transform(df)
    kept = [F.col(c) for c in df.columns if c not in ("probability", "prediction", "rawPrediction", VECTOR)]
    probability = vector_to_array("probability").getItem(1).alias("probability")
    return flag_by_threshold(scored.select(*kept, probability), threshold)


@dataclass
class Bundle:
    """What scoring needs: the fitted stages, the feature order, the training statistics."""

    model: PipelineModel
    features: list[str]
    stats: DataFrame
    settings: dict = field(default_factory=dict)
    history: DataFrame | None = None


KEPT_VERSIONS = 3


def _manifests(spark: SparkSession, path: str) -> list[str]:
    return sorted(name for name in file_names(spark, f"{path}/manifests") if name.startswith("manifest-"))


def save_model(bundle: Bundle, path: str) -> None:
    """Store a bundle under `path` as a new version.

    All parts go to a folder of their own; the manifest that names the folder appears last, whole or not at all. So a
    reader sees the version before or the new one, never parts of both, and a save that breaks off changes nothing.
    Manifests are numbered; the newest `KEPT_VERSIONS` and their folders stay.
    """
    spark = bundle.stats.sparkSession
    version = f"version-{uuid.uuid4().hex}"
    folder = f"{path}/{version}"
    bundle.model.write().save(f"{folder}/model")
    bundle.stats.write.parquet(f"{folder}/stats")
    if bundle.history is not None:
        bundle.history.coalesce(1).write.json(f"{folder}/history")
    manifest = {"version": version, "features": bundle.features, "history": bundle.history is not None, "settings": bundle.settings}
    while True:
        known = _manifests(spark, path)
        number = int(known[-1].removeprefix("manifest-").removesuffix(".json")) + 1 if known else 0
        if publish_file(spark, f"{path}/manifests/manifest-{number:08d}.json", json.dumps(manifest)):
            break
    for name in known[: -(KEPT_VERSIONS - 1)]:
        delete_folder(spark, f"{path}/{_manifest(spark, path, name)['version']}")
        delete_folder(spark, f"{path}/manifests/{name}")


def _manifest(spark: SparkSession, path: str, name: str) -> dict:
    return json.loads(spark.read.text(f"{path}/manifests/{name}", wholetext=True).first()[0])


def load_model(spark: SparkSession, path: str) -> Bundle:
    """Restore the newest complete bundle; a missing part raises, but a bundle may have been saved without history."""
    known = _manifests(spark, path)
    if not known:
        raise FileNotFoundError(f"no stored model in {path}")
    manifest = _manifest(spark, path, known[-1])
    folder = f"{path}/{manifest['version']}"
    return Bundle(
        model=PipelineModel.load(f"{folder}/model"),
        features=manifest["features"],
        stats=spark.read.parquet(f"{folder}/stats"),
        settings=manifest["settings"],
        history=spark.read.json(f"{folder}/history") if manifest["history"] else None,
    )


def train(
    df: DataFrame,
    spec: Series = Series(),
    features: list[str] | None = None,
    grid: dict[str, list] | None = None,
    test: float = 0.2,
    threshold: float = 0.5,
    rows_per_minute: int = 1,
    parallelism: int = 4,
    forest: dict | None = None,
    **feature_options,
) -> tuple[Bundle, DataFrame]:
    """Split, features, scaling, weighting, grid search, refit and test scores.

    Rows are dealt to the test set and the folds while they are narrow, and carry that through the features: rows with
    all features are made once, written once, and never move.
    `forest` holds settings of the forest that the grid does not vary. Returns the bundle with its one-row history, and the scored test rows.
    """
    spark, label = df.sparkSession, spec.label
    names = features or feature_names()
    ids, parts = [*spec.keys, *spec.order], feature_options.get("parts")
    rows = df
    if not df.filter(F.col(label).isNull()).isEmpty():
        rows = fill_chain(order_series(df, spec, parts), [label], spec)  # rows are split by the label they are trained with
    dealt = materialize(deal(rows, ids, label, test, 3, SEED, parts), "dealt")
    ordered = lay_out(dealt, spec.keys, spec.order, parts, riders=("_split", "_fold"))
    table = all_features(ordered, spec=spec, rows_per_minute=rows_per_minute, **feature_options)
    kept = [F.col(c) for c in dict.fromkeys([*ids, spec.value, label, *names])]
    with compiled(spark):
        table = materialize(clean_numeric(table, names).select(*kept, "_split", "_fold"), "features")
    training, held_out = table.filter("_split = 'train'"), table.filter("_split = 'test'")

    scaler = fit_scaler(training, names)
    assembler = VectorAssembler(inputCols=[f"_scaled_{c}" for c in names], outputCol=VECTOR)
    prepare = PipelineModel(stages=[scaler.stage(), assembler])
    weights = {r[label]: r["weight"] for r in evaluate.class_weights(training, label).collect()}
    ready = prepare.transform(with_class_weights(training, label))
    with compiled(spark):
        ready = materialize(ready.select(label, "weight", VECTOR, F.col("_fold").alias("fold")), "train")

    # The same trees, but a pass finds a row's nodes beside it and does not walk there from the root. Its passes make
    # one chain, which only checkpoints cut.
    grown = {"cacheNodeIds": spark.sparkContext.getCheckpointDir() is not None, **(forest or {})}
    search, _ = grid_search(ready, grid, label, random_forest(label, **grown), parallelism=parallelism)
    best = {n: search.bestModel.getOrDefault(n) for n in (grid or GRID)}
    top = max(range(len(search.avgMetrics)), key=search.avgMetrics.__getitem__)  # the first best, as the search picks
    cv = search.avgMetrics[top], search.stdMetrics[top]
    model = PipelineModel(stages=[scaler.stage(), assembler, search.bestModel])

    with compiled(spark):
        scored = predict(model, held_out, threshold).select(*ids, spec.value, label, "probability", "prediction")
        scored = materialize(scored, "scored")
    history = _history(spark, table, scored, cv, best, weights, search.bestModel, names, label)
    settings = {"rows_per_minute": rows_per_minute, "threshold": threshold}
    return Bundle(model, names, fit_stats(df, spec), settings, history), scored


def _history(spark, table, scored, cv, best, weights, forest, names, label) -> DataFrame:
    sizes = {r["_split"]: r["n"] for r in table.groupBy("_split").agg(F.count(F.lit(1)).alias("n")).collect()}
    cells = evaluate.confusion_matrix(scored, label).first()
    importance = feature_importance(spark, forest, names).collect()
    row = {
        "train_size": sizes.get("train", 0),
        "test_size": sizes.get("test", 0),
        "anomaly_ratio": table.agg(F.avg(label)).first()[0],
        "best_params": json.dumps(best),
        "best_cv_score": float(cv[0]),
        "class_weights": json.dumps({str(k): v for k, v in sorted(weights.items())}),
        "cv_f1_mean": float(cv[0]),
        "cv_f1_std": float(cv[1]),
        "feature_importance": [(r["feature"], r["importance"]) for r in importance],
        "test_roc_auc": evaluate.roc_auc(scored, label).first()[0],
        "test_pr_auc": evaluate.pr_auc(scored, label).first()[0],
        "confusion_matrix": [[cells["tn"], cells["fp"]], [cells["fn"], cells["tp"]]],
    }
    schema = (
        "train_size long, test_size long, anomaly_ratio double, best_params string, best_cv_score double, "
        "class_weights string, cv_f1_mean double, cv_f1_std double, "
        "feature_importance array<struct<feature:string,importance:double>>, "
        "test_roc_auc double, test_pr_auc double, confusion_matrix array<array<long>>"
    )
    return spark.createDataFrame([tuple(row.values())], schema)


@dataclass
class TrainingRun:
    """A stored bundle, the scored test rows, the quality report and whether every series passed it."""

    bundle: Bundle
    scored: DataFrame
    report: DataFrame
    passed: bool


def train_pipeline(spark: SparkSession, source: str, target: str, unit: str | None = None, **options) -> TrainingRun:
    """Read a metric CSV, check its quality, train on it and store the model.

    The file has `timestamp`, `cpu_utilization`, `is_anomaly` and, for several series, `series_key`. A failed quality
    check does not stop training: it is reported. Rows of one instant are ordered by the hash of their columns.
    """
    rows = read_metric_csv(spark, source)
    key = F.col("series_key") if "series_key" in rows.columns else F.lit("series")
    timed = to_time_index(rows.withColumn("series_key", key), ("series_key",), unit)
    spec = Series()
    df = materialize(timed.select(
        "series_key", F.col("datetime").alias(spec.ts), row_hash(rows).alias("event_id"), spec.value, spec.label), "samples")
    report = materialize(quality_report(df, spec), "report")
    checks = [c for c in report.columns if c.endswith("_ok")]
    passed = report.filter(sum(F.col(c) for c in checks) < len(checks)).isEmpty()
    bundle, scored = train(df, spec, **options)
    save_model(bundle, target)
    return TrainingRun(bundle, scored, report, passed)


def score(
    df: DataFrame,
    bundle: Bundle,
    threshold: float | None = None,
    spec: Series = Series(),
    stats_scope: str = "batch",
    **feature_options,
) -> DataFrame:
    """Score rows with a trained bundle; a label column is not needed.

    `stats_scope` 'batch' takes whole-series statistics from the rows scored, 'fitted' from training.
    """
    options = {"rows_per_minute": bundle.settings.get("rows_per_minute", 1), **feature_options}
    stats = bundle.stats if stats_scope == "fitted" else None
    table = select_features(all_features(df, spec=spec, stats=stats, **options), bundle.features)
    limit = bundle.settings.get("threshold", 0.5) if threshold is None else threshold
    scored = predict(bundle.model, table, limit)
    kept = [*spec.keys, *spec.order, spec.value]
    return scored.select(*kept, "probability", "prediction", "n_missing_features")
