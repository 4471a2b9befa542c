"""Intermediate tables in the shared folder named by `spark.checkpoint.dir`.

A written table cuts lineage, survives lost executors, keeps column pruning and gives
Catalyst exact sizes, so it picks broadcast joins from measured bytes and not from guesses.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_root: dict[str, str] = {}
_scope = threading.local()


def workspace(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables."""
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return f"{root.rstrip('/')}/metricloom-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="metricloom-")
    return _local_root[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    scope = getattr(_scope, "name", None)
    folder = f"{workspace(spark)}/{scope}" if scope else workspace(spark)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and continue from the written table."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


JIT_LIMIT = "8000"  # bytes of bytecode beyond which the JVM interprets a method for ever


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Inside the block, a stage whose generated method is too long to be compiled runs operator by operator instead.

    For wide rows: one method for all their columns is several times slower.
    """
    setting = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(setting)
    spark.conf.set(setting, JIT_LIMIT)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of the tables that `df` reads, by the plan's own statistics; None where one of them is unknown."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(sizes) if all(s < 2**60 for s in sizes) else None


def drop_workspace(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; results read from them must be saved first."""
    delete_folder(spark, workspace(spark))


def _store(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def delete_folder(spark: SparkSession, folder: str) -> None:
    store, path = _store(spark, folder)
    store.delete(path, True)


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in `folder`; none if it does not exist."""
    store, path = _store(spark, folder)
    return [f.getPath().getName() for f in store.listStatus(path) if f.isDirectory()] if store.exists(path) else []


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in `folder`; none if it does not exist."""
    store, path = _store(spark, folder)
    return [f.getPath().getName() for f in store.listStatus(path) if f.isFile()] if store.exists(path) else []


def publish_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that readers see whole or not at all; False if one of that name is there already."""
    store, target = _store(spark, path)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rsplit('/', 1)[0]}/.draft-{uuid.uuid4().hex}")
    out = store.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    done = not store.exists(target) and store.rename(draft, target)
    if not done:
        store.delete(draft, False)
    return done


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that this thread materializes inside the block, when it ends.

    For work that repeats for ever, such as a micro-batch; its result must be saved inside the block.
    """
    before = getattr(_scope, "name", None)
    _scope.name = f"scratch-{uuid.uuid4().hex}"
    folder = f"{workspace(spark)}/{_scope.name}"
    try:
        yield
    finally:
        _scope.name = before
        delete_folder(spark, folder)
