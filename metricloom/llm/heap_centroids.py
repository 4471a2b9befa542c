"""Centroid clustering with heap-ordered bounds.

Rounds assign every vector to its nearest centroid and move each centroid to the floor of its vectors' mean, all in
whole numbers. A vector that was compared with all centroids is filed under its cluster with the gap between its second
nearest and its nearest centroid. A gap shrinks by the drift of its cluster at most: the way of the own centroid plus
the longest way of any other. Gaps are filed with the drift accumulated so far added, so they never have to be touched:
a vector keeps its cluster until the accumulated drift reaches its key. Then it is popped, compared with all centroids
again and filed anew.

The heap of a cluster is a set of written runs, one per round, each ordered by (cluster, key) and never changed. As
accumulated drift only grows, the rows that a round pops are one range of keys in every run, from the drift of the round
before to that of this one, which the reader skips to by the runs' own minima and maxima; and the rows above the last
drift are the vectors' present clusters. Sums of clusters change by the vectors that moved alone.

Scale: vectors are dealt into buckets by a row number and written once; rounds join the popped rows with the buckets,
so only popped (row, cluster) pairs are exchanged. A vector's row is its own key, so no hot vector or id gathers in a
task. Tasks send one row of sums per cluster; clusters x components numbers reach the driver.

Defined results: only vectors with `dims` components, none null or infinite or NaN, take part; other rows are left out.
Repeated rows and ids are vectors of their own; a null vec_id is kept, and seeds come from it last. With fewer vectors
than clusters each is a seed; no vectors give no rows. Equal seeds tie for the smaller number, which leaves the others
empty. Components beyond 2^27 after scaling raise an error, as distances would not fit a long.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from metricloom.plans.workspace import fresh_path, input_bytes, materialize

CLUSTERS, ROUNDS, DIMS, SCALE, SEED = 40, 5, 64, 256, 2
BUCKET_BYTES = 128 << 20
MOST = 1 << 27
_SLACK = 1e-9  # keys fall short of the true gap by more than what doubles round
_CHANGES = "rid long, cluster int, key double, n long, sums array<long>"


def kept_vectors(rows: DataFrame, vec_id: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(rid, vec_id, v): the vectors that take part, as whole numbers."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    fit = F.coalesce(
        (F.size("v") == dims) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf)), F.lit(False)
    )
    whole = F.transform("v", lambda x: F.floor(x * scale))
    checked = F.when(F.exists("v", lambda x: F.abs(x * scale) >= MOST), F.raise_error(F.lit("vector components are too large")).cast("array<long>"))
    return (
        rows.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).filter(fit)
        .select(F.monotonically_increasing_id().alias("rid"), "vec_id", checked.otherwise(whole).alias("v"))
    )


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    """`rows` written in buckets of rid, so that joins on it exchange the other side only.

    Buckets need a catalog entry to be read as such; it goes once the plan knows the table, its files stay.
    """
    spark, name = rows.sparkSession, f"vectors_{uuid.uuid4().hex}"
    writer = rows.repartition(buckets, "rid").write.bucketBy(buckets, "rid").sortBy("rid")
    writer.option("path", fresh_path(spark, "vectors")).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def nearest_two(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid (ties: the first) and the gap from it to the second nearest, as distances."""
    most = int(max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)))
    kind = np.float64 if vectors.shape[1] * 4 * most**2 < 2**53 else np.int64  # doubles are exact below 2^53
    v, c = vectors.astype(kind), centroids.astype(kind)
    squared = (v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)[None]
    first = squared.argmin(1)
    if len(centroids) == 1:
        return first, np.full(len(first), math.inf)
    two = np.sqrt(np.partition(squared, 1, axis=1)[:, :2].astype(np.float64))
    return first, two[:, 1] * (1 - _SLACK) - two[:, 0] * (1 + _SLACK)


def _scan(popped: DataFrame, centroids: np.ndarray, drift: np.ndarray) -> DataFrame:
    """Files every vector of `popped` (rid, old, v) anew; rows without rid carry what sums and counts change by."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            v, old = _matrix(batch.column(2), dims), batch.column(1).to_numpy(zero_copy_only=False)
            new, gap = nearest_two(v, centroids)
            moved = new != old
            np.add.at(sums, new[moved], v[moved])
            np.add.at(counts, new[moved], 1)
            left = moved & (old >= 0)
            np.subtract.at(sums, old[left], v[left])
            np.subtract.at(counts, old[left], 1)
            nothing = pa.nulls(len(new), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(new.astype(np.int32)), pa.array(gap + drift[new]), nothing, pa.nulls(len(new), pa.list_(pa.int64()))],
                ["rid", "cluster", "key", "n", "sums"],
            )
        used = np.flatnonzero((counts != 0) | (sums != 0).any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(used), pa.int64()), pa.array(used.astype(np.int32)), pa.nulls(len(used), pa.float64()), pa.array(counts[used]),
             pa.array(sums[used].tolist(), pa.list_(pa.int64()))], ["rid", "cluster", "key", "n", "sums"],
        )

    return popped.select("rid", "old", "v").mapInArrow(run, _CHANGES)


def _in_range(low: np.ndarray | None, high: np.ndarray | None) -> Column:
    """Whether a filed row's key lies above its cluster's `low` and not above its `high`."""
    terms = []
    for c in range(len(low if low is not None else high)):
        term = F.col("cluster") == c
        if low is not None:
            term = term & (F.col("key") > float(low[c]))
        if high is not None:
            term = term & (F.col("key") <= float(high[c]))
        terms.append(term)
    return reduce(lambda a, b: a | b, terms)


class Heaps:
    """Runs of filed rows by round, and the drift of every cluster at the end of each round."""

    def __init__(self, clusters: int):
        self.runs: list[DataFrame] = []
        self.drifts = [np.zeros(clusters)]

    def file(self, changes: DataFrame) -> None:
        self.runs.append(changes.filter("rid IS NOT NULL").select("rid", "cluster", "key"))

    def drifted(self, ways: np.ndarray) -> None:
        """Adds each centroid's way and the longest way of any other."""
        order = np.argsort(ways)
        longest = np.full(len(ways), ways[order[-1]])
        longest[order[-1]] = ways[order[-2]] if len(ways) > 1 else 0.0
        self.drifts.append(self.drifts[-1] + (ways + longest) * (1 + _SLACK))

    def popped(self) -> DataFrame:
        """Rows whose keys the last drift has reached; those reached earlier were popped then."""
        parts = [run.filter(_in_range(self.drifts[-2] if run is not self.runs[-1] else None, self.drifts[-1])) for run in self.runs]
        return reduce(DataFrame.union, parts).select("rid", F.col("cluster").alias("old"))

    def live(self) -> DataFrame:
        """The present cluster of every vector."""
        parts = [run.filter(_in_range(self.drifts[-1], None)) for run in self.runs[:-1]]
        return reduce(DataFrame.union, [*parts, self.runs[-1]]).select("rid", "cluster")


def _seeds(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(order.asc_nulls_last(), "v").limit(clusters).select("v").collect()
    return np.array([r.v for r in rows], np.int64)


def _totals(changes: DataFrame) -> list[tuple[int, int, int, int]]:
    """(cluster, component, count, sum); component -1 has the counts. Whole numbers of any size."""
    rows = changes.filter("rid IS NULL").select("cluster", "n", F.posexplode("sums").alias("at", "x"))
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    return [(r.cluster, r["at"], int(r.n), int(r.x)) for r in rows.groupBy("cluster", "at").agg(whole("n").alias("n"), whole("x").alias("x")).collect()]


def heap_clusters(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS,
    dims: int = DIMS, scale: int = SCALE, seed: int = SEED, scanned: list[int] | None = None,
) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) per vector, the final centroids); `scanned` receives the rows each round popped."""
    spark = rows.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(input_bytes(rows) or 0) // BUCKET_BYTES))
    vectors = _bucketed(kept_vectors(rows, vec_id, vector, dims, scale), buckets)
    centroids = _seeds(vectors, clusters, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    heaps = Heaps(len(centroids))
    sums, counts = [[0] * dims for _ in centroids], [0] * len(centroids)
    popped = vectors.select("rid", F.lit(-1).alias("old"), "v")
    for _ in range(rounds + 1):
        changes = _scan(popped, centroids, heaps.drifts[-1]).sortWithinPartitions("cluster", "key")
        changes = materialize(changes, "heap")
        heaps.file(changes)
        if scanned is not None:
            scanned.append(changes.filter("rid IS NOT NULL").count())
        if len(heaps.runs) > rounds:
            break
        for cluster, at, n, x in _totals(changes):
            sums[cluster][at] += x
            counts[cluster] += n if at == 0 else 0
        moved = np.array([[x // n for x in s] if n else old.tolist() for s, n, old in zip(sums, counts, centroids)], np.int64)
        heaps.drifted(np.sqrt(((moved - centroids).astype(np.float64) ** 2).sum(1)))
        centroids = moved
        popped = vectors.join(heaps.popped(), "rid").select("rid", "old", "v")
    return _distances(vectors.join(heaps.live(), "rid"), centroids), centroids


def _distances(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away = _matrix(batch.column(2), dims) - centroids[batch.column(1).to_numpy(zero_copy_only=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((away * away).sum(1))], ["vec_id", "cluster", "distance"])

    return rows.select("vec_id", "cluster", "v").mapInArrow(run, "vec_id long, cluster int, distance long")


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds the summed distance of each row's cluster and of all rows, and the digest of its centroid."""
    spark: SparkSession = found.sparkSession
    found = materialize(found, "clustered")
    names = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())]
    each = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    total = found.agg(F.sum(F.col("distance").cast("decimal(38,0)")).cast("long").alias("inertia"))
    each = each.join(F.broadcast(total)).join(F.broadcast(spark.createDataFrame(names, "c int, centroid_sha256 string")), F.col("cluster") == F.col("c"))
    each = each.select(F.col("cluster").alias("of"), F.col("s").cast("long").alias("cluster_inertia"), "inertia", "centroid_sha256")
    return found.join(F.broadcast(each), F.col("cluster") == F.col("of")).drop("of")  # as many rows as clusters
