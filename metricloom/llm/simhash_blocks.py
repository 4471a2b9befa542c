"""SimHash near-duplicates with bit-sliced comparison.

A fingerprint has 64 bits; a bit is set if it is set in over half of the XXH64 hashes of the text's word shingles.
Two fingerprints within `radius` bits agree on at least `pieces - radius` of `pieces` pieces of their bits, so rows
are blocked by every choice of that many pieces. Inside a block, bit planes are stored vertically: word k of plane j
holds bit j of 64 neighbouring rows. XOR with the planes shifted by d rows gives the differing bits of 64 pairs at once;
carry-save counters add them up, and words whose pairs all exceed the radius are abandoned.

Scale: equal fingerprints are one row before blocking. A block above `tile_rows` is cut into tiles, and each pair of
tiles goes to a task of its own, so no block is collected whole; blocks are counted by partial sums, and the large ones
are known before any row moves. A block emits a star per local component and never
its pairs. Components follow by rounds of joins. The pieces set the cost, never the result: 15 rows per fingerprint and
21-bit blocks for 6 pieces, 35 and 27 bits for 7, 70 and 32 bits for 8. They are chosen from the counted fingerprints, so
that blocks of unrelated ones stay at some BLOCK_ROWS rows whatever the corpus.

Defined results: null and blank texts have fingerprint zero and link like any other; rows repeat with their fingerprint;
a null doc_id takes the component of the documents it equals; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from metricloom.llm.common import bounded_broadcast, text_of
from metricloom.llm.components import components
from metricloom.plans.workspace import materialize

SHINGLE_WORDS, RADIUS, TILE_ROWS, SEED = 4, 4, 4096, 42
BLOCK_ROWS, MOST_SPARE_PIECES = 64, 4
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_CHUNK = 65_536


def fingerprint(text: bytes, size: int = SHINGLE_WORDS) -> int:
    """SimHash of UTF-8 text; zero without words."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    plain = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    last = ends[size - 1 :] or ends[-1:]
    n, votes = len(last), np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (digest(plain[a : b - 1], SEED) for a, b in zip(starts[at : at + _CHUNK], last[at : at + _CHUNK])), np.uint64
        )
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_buffer().to_pybytes(), size) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).cast("binary").alias("t"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def pieces_for(fingerprints: int, radius: int = RADIUS) -> int:
    """The fewest pieces whose blocks hold BLOCK_ROWS unrelated fingerprints at most; a block has pieces - radius of them."""
    for spare in range(2, MOST_SPARE_PIECES):
        if fingerprints <= BLOCK_ROWS << 64 * spare // (radius + spare):
            return radius + spare
    return radius + MOST_SPARE_PIECES


def _piece_keys(fp: Column, radius: int, pieces: int) -> Column:
    """One key per choice of `pieces - radius` pieces, the choice's number in front."""
    cuts = [64 * k // pieces for k in range(pieces + 1)]
    piece = [F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in zip(cuts, cuts[1:])]
    return F.array(*[
        F.struct(F.lit(k).alias("choice"), F.concat_ws("-", *[piece[i] for i in chosen]).alias("bits"))
        if pieces - radius > 2
        else F.struct(F.lit(k).alias("choice"), sum((F.shiftleft(piece[i], 32 * p) for p, i in enumerate(chosen)),
                                                    F.lit(0)).alias("bits"))
        for k, chosen in enumerate(combinations(range(pieces), pieces - radius))
    ])


def bit_planes(fp: np.ndarray) -> np.ndarray:
    """(64, words + 2): bit i of word k in plane j is bit j of fingerprint 64 k + i."""
    n = len(fp)
    bits = np.zeros((64, (n // 64 + 3) * 64), np.uint8)
    bits[:, :n] = np.unpackbits(fp.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").T
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def close_rows(fp: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, i + d), by distance d, of rows of one group whose fingerprints differ in `radius` bits at most.

    Rows of a group must be neighbours.
    """
    planes, width = bit_planes(fp), (radius + 1).bit_length()
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    start = (1 << width) - 1 - radius  # a counter that starts here overflows beyond the radius
    for d in range(1, len(fp)):
        same = np.zeros(planes.shape[1] * 64, bool)
        same[: len(fp) - d] = group[:-d] == group[d:]
        wanted = np.packbits(same, bitorder="little").view(np.uint64)
        at = np.flatnonzero(wanted)
        if not len(at):
            return
        alive = wanted[at]
        skip, shift = divmod(d, 64)
        shift, back = np.uint64(shift), np.uint64(64 - shift)
        counters = [np.full(len(at), full if start >> k & 1 else 0, np.uint64) for k in range(width)]
        last = planes.shape[1] - 1

        def differing(j: int) -> np.ndarray:
            low, high = np.minimum(at + skip, last), np.minimum(at + skip + 1, last)
            moved = planes[j][low] >> shift
            if shift:
                moved = moved | planes[j][high] << back
            return planes[j][at] ^ moved

        for j in range(0, 64, 2):
            x, y = differing(j), differing(j + 1)
            half = counters[0] ^ x
            carry = (counters[0] & x) | (half & y)
            counters[0] = half ^ y
            for k in range(1, width):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            alive = alive & ~carry
            if j % 8 == 6:
                some = alive != 0
                if not some.any():
                    break
                if some.mean() < 0.75:
                    at, alive, counters = at[some], alive[some], [c[some] for c in counters]
        word, bit = np.nonzero(np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        if len(word):
            i = at[word] * 64 + bit
            yield i, i + d


def local_roots(fp: np.ndarray, group: np.ndarray, radius: int) -> np.ndarray:
    """For each row the first row of its component inside its group."""
    parent = np.arange(len(fp))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for left, right in close_rows(fp, group, radius):
        apart = parent[left] != parent[right]
        for i, j in zip(left[apart], right[apart]):
            a, b = find(i), find(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
        while (up := parent[parent]).tolist() != parent.tolist():
            parent[:] = up
    return parent


def near_links(prints: DataFrame, radius: int = RADIUS, pieces: int | None = None, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links a > b that join all of `prints` (node, fp; one row per fingerprint) within `radius` bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []

        def star(held: pa.Table, group: np.ndarray) -> pa.RecordBatch:
            node = held["node"].to_numpy()
            root = node[local_roots(held["fp"].to_numpy().view(np.uint64), group, radius)]
            far = node != root
            return pa.RecordBatch.from_arrays([pa.array(node[far]), pa.array(root[far])], ["a", "b"])

        def groups(held: pa.Table) -> np.ndarray:
            new = np.zeros(held.num_rows, bool)
            for c in ("block", "low", "high"):
                v = held[c].to_numpy()
                new[1:] |= v[1:] != v[:-1]
            return new.cumsum()

        for batch in batches:
            rest.append(batch)
            if sum(b.num_rows for b in rest) < 8192:
                continue
            held = pa.Table.from_batches(rest)
            group = groups(held)
            cut = int(np.searchsorted(group, group[-1]))  # the last group may go on
            if cut:
                yield star(held.slice(0, cut), group[:cut])
            rest = held.slice(cut).combine_chunks().to_batches()
        if rest:
            held = pa.Table.from_batches(rest)
            yield star(held, groups(held))

    pieces = pieces_for(prints.count(), radius) if pieces is None else pieces
    keys = prints.select("node", "fp", F.explode(_piece_keys(F.col("fp"), radius, pieces)).alias("k"))
    rows = keys.select("node", "fp", F.xxhash64("k.choice", "k.bits").alias("block"))
    hot = materialize(rows.groupBy("block").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tile_rows), "hot")
    hot = bounded_broadcast(hot.select(F.col("block").alias("hot"), F.ceil(F.col("n") * 2 / tile_rows).cast("int").alias("cut")))
    sized = rows.join(hot, F.col("block") == F.col("hot"), "left").withColumn("tiles", F.coalesce("cut", F.lit(1)))
    sized = sized.withColumn("tile", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("tiles")).cast("int"))
    others = F.when(F.col("tiles") == 1, F.array(F.lit(0))).otherwise(
        F.array_remove(F.sequence(F.lit(0), F.col("tiles") - 1), F.col("tile"))
    )
    paired = sized.withColumn("other", F.explode(others)).select(
        "block", F.when(F.col("tiles") == 1, 0).otherwise(F.least("tile", "other")).alias("low"),
        F.when(F.col("tiles") == 1, 0).otherwise(F.greatest("tile", "other")).alias("high"), "node", "fp",
    )
    placed = paired.repartition("block", "low", "high").sortWithinPartitions("block", "low", "high", "node")
    return placed.mapInArrow(run, "a long, b long")


def simhash_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS,
    radius: int = RADIUS, pieces: int | None = None, tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) per document; the component is the smallest doc_id reachable by links."""
    prints = materialize(fingerprints(docs, doc_id, text, size), "prints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    roots = components(near_links(nodes.filter("node IS NOT NULL"), radius, pieces, tile_rows))
    named = nodes.withColumnRenamed("node", "n").join(roots, F.col("n") == F.col("node"), "left").select(
        F.col("fp").alias("fp_"), F.coalesce("root", "n").alias("component_id")
    )
    return prints.join(named, F.col("fp") == F.col("fp_"), "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
