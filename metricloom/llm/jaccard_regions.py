"""Exact Jaccard join of shingle sets by Voronoi regions about pivots.

Jaccard distance is a metric, and documents link at distances up to r = 1 - percent / 100. Pivots are documents of a
region; each of its documents belongs to the cell of its nearest pivot. Two linked documents x and y with nearest
pivots p and q have d(x, q) <= d(y, q) + r <= d(y, p) + r <= d(x, p) + 2r, so x is also sent to every cell whose pivot
lies in that window, and each link is found inside a cell. Cells are regions of the next round. Documents within r of
their pivot hang together through it; they go on only where another document of the cell lies beyond r, but so near
that the triangle inequality admits a link. A region small enough for one task is joined there, pivot by pivot: the
distances to earlier pivots leave only documents whose distances differ by r at most. Regions that pivots cannot split
(most distances alike) are cut into tiles, and each pair of tiles is joined by a task of its own. No step drops or
caps anything.

A corpus as a whole is such a region: unrelated documents all lie at distance one from every pivot, and windows of one
would send each to every cell. So the regions of the first round come from signatures. Sets of linked documents differ
in at most `size of the smaller x (100 - percent) / percent` shingles; shingles are dealt into that many classes by
hash, and SPARE classes more, so that the contents of SPARE + 1 classes are equal. Documents that share the content of
a class that is not empty are candidates; one with more than SPARE empty classes shares these too. Sizes are taken in
bands, a document near the lower end of one belongs to the band below as well. The components of the candidates are
the first regions: no link leaves one.

Scale: equal sets are one node before anything is compared. Keys are as many as a ninth to a fifth of the shingles, and
cross one exchange. A batch of documents sends each key once, for the first document that has it, and names that one as
the lead of the others, as later each key's rows name the least of them; so hot keys make stars, not pairs, and come as
one row per batch. Sets are computed again for candidates only, and a region's documents meet by tiles of
`region_bytes` and REGION_DOCS documents; nothing is collected.

Defined results: null and blank texts have an empty set and component of their own doc_id; texts with fewer words than
a shingle have one shingle, the whole sequence; repeated rows repeat; rows that share a doc_id share a component; a
null doc_id takes the component of the documents whose set it equals, and none otherwise; other columns are ignored.
Shingles are compared by 64-bit hashes, sets by 128 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from metricloom.llm.common import bounded_broadcast, text_of
from metricloom.llm.components import components
from metricloom.llm.word_codes import encode, strips
from metricloom.plans.attach import attach
from metricloom.plans.workspace import materialize

SHINGLE_WORDS, PERCENT = 3, 90
SPARE, BAND = 2, 1.5
REGION_BYTES, REGION_DOCS = 8 << 20, 1_024
PIVOTS = 16
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = (x ^ np.uint64(salt)) * _ODD[3]
    x ^= x >> np.uint64(32)
    x *= _ODD[0]
    return x ^ x >> np.uint64(29)


def shingle_sets(texts: pa.Array, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """For each text its distinct shingle hashes, sorted."""
    codes, bounds, words = encode(texts, lower=True)
    digest = np.fromiter((xxhash.xxh64_intdigest(w.as_buffer()) for w in words), np.uint64, len(words))
    word = digest[codes] if len(codes) else np.zeros(0, np.uint64)

    def joined(part: np.ndarray, n: int) -> np.ndarray:
        total = np.full(max(len(part) - n + 1, 0), n, np.uint64)
        for k in range(n):
            total = _mixed(total ^ part[k : len(part) - n + 1 + k])
        return total

    whole, out = joined(word, size), []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= size:
            out.append(np.unique(whole[a : b - size + 1]))
        else:
            out.append(joined(word[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64))
    return out


def _difference(smaller: int, percent: int) -> int:
    """In how many shingles two linked sets may differ."""
    return smaller * (100 - percent) // percent


@lru_cache(maxsize=1024)
def _bands(size: int, percent: int) -> tuple[tuple[int, int], ...]:
    """(lowest size, classes) of the bands in which sets of this size may be the smaller or the larger one of a link."""
    low, found = 1, []
    while low <= size:
        high = max(low + 1, int(low * BAND))
        differ = _difference(high - 1, percent)
        if differ and (high - 1) * 100 >= size * percent:  # sets that differ in nothing are equal
            found.append((low, differ + 1 + SPARE))
        low = high
    return tuple(found)


@lru_cache(maxsize=64)
def _cuts(classes: int) -> np.ndarray:
    return np.array([-(-(j << 64) // classes) for j in range(1, classes)], np.uint64)


def signature_keys(shingles: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Hashes that linked sets share at least one of."""
    keys = []
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mixed(shingles, 0x5851F42D4C957F2D), dtype=np.uint64)))
    for low, classes in _bands(len(shingles), percent):
        at = np.concatenate(([0], np.searchsorted(shingles, _cuts(classes)), [len(shingles)]))
        content = total[at[1:]] - total[at[:-1]]
        empty = at[1:] == at[:-1]
        salted = _mixed(content ^ _mixed(np.arange(classes, dtype=np.uint64) * _ODD[1] + np.uint64(low)))
        keys.append(salted if empty.sum() > SPARE else salted[~empty])
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def _identity(shingles: np.ndarray) -> tuple[int, int]:
    return tuple(int(_mixed(shingles, salt).sum(dtype=np.uint64).view(np.int64)) for salt in (0x2545F491, 0x8CB92BA7))


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate([np.zeros(0, np.uint64), *arrays]).view(np.int64)
    return pa.ListArray.from_arrays(np.cumsum([0, *map(len, arrays)], dtype=np.int32), pa.array(flat))


def _stars(docs: np.ndarray, made: list[np.ndarray], names: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each document of a batch the keys that it is the first to have, and the first ones that it shares others with."""
    n = len(docs)
    _, first = np.unique(names, axis=0, return_index=True)
    lone = np.isin(np.arange(n), first)
    made = [keys if own else keys[:0] for keys, own in zip(made, lone)]
    flat, row = np.concatenate([np.zeros(0, np.uint64), *made]), np.repeat(np.arange(n), [len(k) for k in made])
    _, lead_at, where = np.unique(flat, return_index=True, return_inverse=True)
    lead = row[lead_at[where]]
    mine = lead == row
    pairs = np.unique(np.stack((row[~mine], lead[~mine])), axis=1)
    held = np.searchsorted(row[mine], np.arange(n + 1))
    with_first = np.searchsorted(pairs[0], np.arange(n + 1))
    own, first_ones = flat[mine], docs[pairs[1]]
    keys = [own[a:b] for a, b in zip(held[:-1], held[1:])]
    leads = [first_ones[a:b] for a, b in zip(with_first[:-1], with_first[1:])]
    _, of = np.unique(names, axis=0, return_inverse=True)
    for i in np.flatnonzero(~lone):
        leads[i] = docs[[first[of.ravel()[i]]]]
    return keys, leads


def _described(docs: DataFrame, doc_id: str, text: str, size: int, percent: int) -> DataFrame:
    """(doc_id, n, a, b, keys, leads) per document; a and b stand for its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, named, made = [], [], []
            for strip in strips(batch.column(1)):  # sets of one strip of texts at a time, keys are far fewer
                for s in shingle_sets(strip, size):
                    sizes.append(len(s)), named.append(_identity(s)), made.append(signature_keys(s, percent))
            names = np.array(named, np.int64).reshape(-1, 2)
            keys = [np.zeros(0, np.uint64)] * len(sizes)
            leads = list(keys)
            known = np.flatnonzero(batch.column(0).is_valid().to_numpy(zero_copy_only=False) & (np.array(sizes) > 0))
            if len(known):
                ids = batch.column(0).take(pa.array(known)).to_numpy()
                for i, k, f in zip(known, *_stars(ids, [made[i] for i in known], names[known])):
                    keys[i], leads[i] = k, f.view(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(names[:, 0]), pa.array(names[:, 1]), _lists(keys), _lists(leads)],
                ["doc_id", "n", "a", "b", "keys", "leads"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("t"))
    return rows.mapInArrow(run, "doc_id long, n long, a long, b long, keys array<long>, leads array<long>")


def candidate_regions(sets: DataFrame) -> DataFrame:
    """(node, region) for the documents that share a key with another one; `sets` has doc_id, keys and leads."""
    rows = sets.select(F.col("doc_id").alias("node"), F.explode("keys").alias("key"))
    stars = rows.withColumn("lead", F.min("node").over(Window.partitionBy("key"))).filter("node > lead").select("node", "lead")
    linked = stars.union(sets.select("doc_id", F.explode("leads"))).toDF("node", "lead").filter("node <> lead")
    roots = components(linked.select(F.greatest("node", "lead").alias("a"), F.least("node", "lead").alias("b")))
    roots = materialize(roots, "regions")
    return roots.select("node", F.col("root").alias("region")).union(roots.select("root", "root").distinct())


def _member_sets(docs: DataFrame, members: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """(region, node, shingles) of the members (node, a, b, region): the sorted hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for strip in strips(batch.column(4)):
                sets, rows = shingle_sets(strip, size), batch.slice(done, len(strip))
                done += len(strip)
                wanted = zip(rows.column(2).to_pylist(), rows.column(3).to_pylist())
                same = [i for i, (s, name) in enumerate(zip(sets, wanted)) if _identity(s) == name]
                at = pa.array(same, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(at), rows.column(1).take(at), pa.array([sets[i].tobytes() for i in same], pa.binary())],
                    ["region", "node", "shingles"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), text_of(text).alias("_text"))
    rows = rows.join(bounded_broadcast(members), F.col("_id") == F.col("node")).select("region", "node", "a", "b", "_text")
    return rows.mapInArrow(run, "region long, node long, shingles binary")


class Sets:
    """Several shingle sets with an index from a shingle to the sets that have it."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.sizes = sets, np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate([np.zeros(0, np.uint64), *sets])
        order = np.argsort(flat, kind="stable")
        self.values, self.owners = flat[order], np.repeat(np.arange(len(sets)), self.sizes)[order]

    def shared(self, shingles: np.ndarray) -> np.ndarray:
        """How many shingles each set shares with another one."""
        low, high = np.searchsorted(self.values, shingles), np.searchsorted(self.values, shingles, "right")
        counts = high - low
        ends = counts.cumsum()
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - counts), counts)
        return np.bincount(self.owners[at], minlength=len(self.sets))


def star_links(sets: list[np.ndarray], percent: int = PERCENT, kept: int = 8) -> list[tuple[int, int]]:
    """Links between positions that give all sets within the distance the right components."""
    radius = (100 - percent) / 100 + 1e-9
    index, links = Sets(sets), []
    part = np.arange(len(sets))
    known = np.zeros((len(sets), 0))
    waiting = np.ones(len(sets), bool)
    for i in np.argsort(index.sizes, kind="stable"):
        waiting[i] = False
        possible = waiting & (part != part[i]) & (index.sizes[i] * 100 >= index.sizes * percent)
        if known.shape[1] and possible.any():
            possible &= (np.abs(known - known[i]) <= radius).all(axis=1)
        if not possible.any():
            continue
        shared = index.shared(sets[i])
        union = index.sizes + index.sizes[i] - shared
        for j in np.flatnonzero(possible & (shared * 100 >= union * percent)):
            if part[j] != part[i]:
                links.append((int(i), int(j)))
                part[part == part[j]] = part[i]
        known = np.column_stack((known, 1 - shared / union))[:, -kept:]
    return links


def _sets_of(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint64) if len(x.as_buffer()) else np.zeros(0, np.uint64) for x in column]


def _by_group(keys: list[str], work: Callable[[pa.Table], pa.RecordBatch | None]) -> Callable:
    """A mapInArrow function that hands `work` one group of neighbouring rows after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
            cut = np.zeros(batch.num_rows, bool)
            for c in columns:
                cut[1:] |= c[1:] != c[:-1]
            if held:
                last = held[-1]
                cut[0] = any(last[k][-1].as_py() != c[0] for k, c in zip(keys, columns))
            edges = [0, *np.flatnonzero(cut), batch.num_rows] if not cut[0] else [*np.flatnonzero(cut), batch.num_rows]
            if cut[0] and held:
                yield from (x for x in [work(pa.concat_tables(held))] if x is not None)
                held = []
            for a, b in zip(edges[:-1], edges[1:]):
                if a and cut[a] and held:
                    yield from (x for x in [work(pa.concat_tables(held))] if x is not None)
                    held = []
                held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
        if held:
            yield from (x for x in [work(pa.concat_tables(held))] if x is not None)

    return run


def join_regions(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b), a > b, inside the groups (region, low, high) of `rows`, which also has node and shingles."""

    def work(group: pa.Table) -> pa.RecordBatch | None:
        if group.num_rows < 2:
            return None
        node = group["node"].to_numpy()
        links = star_links(_sets_of(group["shingles"].combine_chunks()), percent)
        pairs = np.array([(node[i], node[j]) for i, j in links if node[i] != node[j]], np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs.max(axis=1, initial=-(2**63))), pa.array(pairs.min(axis=1, initial=2**63 - 1))], ["a", "b"])

    placed = rows.select("region", "low", "high", "node", "shingles").repartition("region", "low", "high")
    return placed.sortWithinPartitions("region", "low", "high", "node").mapInArrow(_by_group(["region", "low", "high"], work), "a long, b long")


def split_regions(rows: DataFrame, sizes: DataFrame, tries: int, percent: int, region_bytes: int) -> DataFrame:
    """The documents of large regions in the cells of their pivots.

    `sizes` has region, documents and bytes. Returns region, cell, node, shingles, the distance to the cell's pivot, and
    `linked`, the pivot's node where that is within the radius.
    """
    radius = (100 - percent) / 100 + 1e-9

    def work(group: pa.Table) -> pa.RecordBatch | None:
        chosen = group["chosen"].to_numpy(zero_copy_only=False).astype(bool)
        sets, node = _sets_of(group["shingles"].combine_chunks()), group["node"].to_numpy()
        pivots = Sets([sets[i] for i in np.flatnonzero(chosen)])
        names, members = node[chosen], np.flatnonzero(~chosen)
        cells, at, distances = [], [], []
        for i in members:
            if not len(names):
                cells.append([0]), at.append([i]), distances.append([1.0])
                continue
            shared = pivots.shared(sets[i])
            d = 1 - shared / (pivots.sizes + len(sets[i]) - shared)
            near = np.flatnonzero(d <= d.min() + 2 * radius)
            cells.append(near), at.append(np.full(len(near), i)), distances.append(d[near])
        if not cells:
            return None
        cell, at, distance = np.concatenate(cells).astype(np.int64), np.concatenate(at), np.concatenate(distances)
        linked = pa.array(names[cell], mask=distance > radius) if len(names) else pa.nulls(len(at), pa.int64())
        taken = group.take(pa.array(at))
        return pa.RecordBatch.from_arrays(
            [taken["region"].combine_chunks(), pa.array(cell), taken["node"].combine_chunks(), taken["shingles"].combine_chunks(),
             pa.array(distance), linked], ["region", "cell", "node", "shingles", "distance", "linked"],
        )

    tiles = F.greatest(F.ceil(F.col("bytes") / region_bytes), F.ceil(F.col("documents") / REGION_DOCS)).cast("int")
    sized = rows.join(bounded_broadcast(sizes), "region")
    drawn = sized.filter(F.pmod(F.xxhash64("node", F.lit(tries)), F.col("documents")) < PIVOTS).dropDuplicates(["region", "shingles"])
    both = sized.select("region", F.pmod(F.xxhash64("node", "shingles"), tiles).cast("int").alias("tile"), F.lit(0).alias("chosen"), "node", "shingles").union(
        drawn.select("region", F.explode(F.sequence(F.lit(0), tiles - 1)).alias("tile"), F.lit(1).alias("chosen"), "node", "shingles")
    )
    placed = both.repartition("region", "tile").sortWithinPartitions("region", "tile", F.desc("chosen"), "node", "shingles")
    return placed.mapInArrow(
        _by_group(["region", "tile"], work), "region long, cell long, node long, shingles binary, distance double, linked long"
    )


def tile_pairs(rows: DataFrame, sizes: DataFrame, region_bytes: int) -> DataFrame:
    """Rows of the regions in `sizes` once per pair of tiles they belong to: any two documents meet."""
    sized = rows.join(bounded_broadcast(sizes), "region").withColumn(
        "tiles", F.greatest(F.ceil(F.col("bytes") * 2 / region_bytes), F.ceil(F.col("documents") * 2 / REGION_DOCS)).cast("int")
    )
    sized = sized.withColumn("tile", F.pmod(F.xxhash64("node", "shingles"), F.col("tiles")).cast("int"))
    others = F.when(F.col("tiles") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: t != F.col("tile"))
    )
    return sized.withColumn("other", F.explode(others)).select(
        "region", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "node", "shingles"
    )


def _sizes(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("documents"), F.sum(F.length("shingles")).alias("bytes"))


def region_links(rows: DataFrame, percent: int = PERCENT, region_bytes: int = REGION_BYTES) -> DataFrame:
    """Links (a, b) of `rows` (region, node, shingles) that join everything within the distance."""
    radius = (100 - percent) / 100 + 1e-9
    found, tries = [], 0
    while True:
        large = materialize(_sizes(rows, "region").filter((F.col("bytes") > region_bytes) | (F.col("documents") > REGION_DOCS)), "large")
        whole = rows.join(bounded_broadcast(large.select("region")), "region", "left_anti")
        found.append(materialize(join_regions(whole.withColumns({"low": F.lit(0), "high": F.lit(0)}), percent), "links"))
        if large.isEmpty():
            return _union(found)
        tries += 1
        cells = materialize(split_regions(rows, large, tries, percent, region_bytes), "cells")
        # beyond the radius of the cell's pivot, the nearest document decides which ones inside it may link
        ring = F.min(F.when(F.col("linked").isNull(), F.col("distance")))
        rings = materialize(cells.groupBy("region", "cell").agg(ring.alias("ring"), F.count(F.lit(1)).alias("n")), "rings")
        alive = attach(cells, rings, ["region", "cell"], weight="n", written=True).filter(
            F.col("linked").isNull() | (F.col("distance") >= F.col("ring") - radius)
        )
        alive = materialize(alive.select("region", "cell", "node", "shingles"), "alive")
        inner = materialize(_sizes(alive, "region", "cell").groupBy("region").agg(F.sum("bytes").alias("all"), F.max("bytes").alias("most")), "inner")
        stuck = materialize(
            large.join(inner, "region").filter((F.col("most") > F.col("bytes") * 0.7) | (F.col("all") > F.col("bytes") * 4)).select(large.columns), "stuck"
        )
        stars = cells.filter("linked IS NOT NULL AND linked <> node")
        found.append(materialize(stars.select(F.greatest("linked", "node").alias("a"), F.least("linked", "node").alias("b")), "links"))
        found.append(materialize(join_regions(tile_pairs(rows, stuck, region_bytes), percent), "links"))
        split = alive.join(bounded_broadcast(stuck.select("region")), "region", "left_anti")
        rows = materialize(split.select(F.xxhash64("region", "cell", F.lit(tries)).alias("region"), "node", "shingles"), "regions")


def _union(tables: list[DataFrame]) -> DataFrame:
    total = tables[0]
    for t in tables[1:]:
        total = total.union(t)
    return total


def jaccard_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, percent: int = PERCENT,
    region_bytes: int = REGION_BYTES,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) per document; the component is the smallest doc_id reachable by links."""
    sets = materialize(_described(docs, doc_id, text, size, percent), "sets")
    copies = F.count(F.lit(1)).alias("copies")
    nodes = materialize(sets.filter("n > 0").groupBy("a", "b").agg(F.min("doc_id").alias("node"), copies), "nodes")
    members = materialize(nodes.select("node", "a", "b").join(candidate_regions(sets), "node"), "members")
    several = materialize(members.groupBy("region").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most"), "several")
    members = materialize(members.join(bounded_broadcast(several.select("region")), "region", "left_semi"), "members")
    rows = materialize(_member_sets(docs, members, doc_id, text, size), "rows")
    roots = components(region_links(rows, percent, region_bytes))
    nodes = nodes.select("a", "b", F.col("node").alias("n_"), "copies").join(roots, F.col("n_") == F.col("node"), "left").select(
        "a", "b", "copies", F.coalesce("root", "n_").alias("component_id")
    )
    joined = attach(sets.select("doc_id", "n", "a", "b"), nodes, ["a", "b"], weight="copies")
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )
