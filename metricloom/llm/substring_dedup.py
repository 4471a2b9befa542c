"""Exact substring removal with suffix arrays over shards.

A byte goes if it lies in a string of `length` bytes that also starts in a document with a smaller doc_id. Strings are
judged on the input. To find equal strings wherever they are, each string of `length` bytes belongs to the shard of its
minimizer, the `GRAM` bytes inside it with the least hash; neighbouring strings mostly have one minimizer and travel as
one run of bytes. Equal strings therefore meet in one shard, whatever documents they come from. There

* runs whose surroundings of the minimizer (31 bytes to either side; each string holds one of the two) stand in one
  document only are set aside: none of their strings can be repeated;
* the rest, each different run once, for its least document, are joined to one text whose suffix array is induced;
  strings of `length` bytes that are equal are neighbours in it, with permuted common prefixes of `length` or more, and
  those not of the least document are covered. Equal runs of later documents are covered whole.

Scale: one shuffle of runs, packed per shard and compressed, and one of covered ranges. Runs that repeat inside a task
are sent for the least document of the task only (the others are covered already), so a passage in a third of all rows
sends one run per task for its inside. The runs over its edges hold bytes of their own documents and all differ: a
minimizer with more run bytes than `hot_bytes` is hot, and its runs are cut into their single strings, which go to
shards by a hash of the whole string, so equal ones still meet. Hot minimizers are found first, by partial sums over the
minimizers of sampled blocks of text, so few that a hot one still has some thousand strings among them; which ones are
taken for hot moves strings between shards and never changes the result. What a task holds of this is bounded by its
own text, and the hot ones are a sorted list of at most 4 / 3 of the text's bytes over `hot_bytes`.

A shard is a task's work: about `SHARD_BYTES` of text in `PARTS` parts, each sorted by itself. Each chunk of text packs
one blob per shard; the exchange has as many partitions as there are shards, MOST_TASKS at most, where a task works
shard after shard. From some terabytes on, a chunk has fewer runs than there are shards, and a blob holds one run. A
document of any length is cut into segments that overlap by `length - 1` bytes. The ranges of a document are bounded by
its length.

Defined results: null texts are empty; texts shorter than `length` stay; rows with one doc_id count as one document, are
never repeats of each other, and what one of them loses by its ranges is taken from its own bytes; rows with a null
doc_id are kept whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from metricloom.llm.common import text_of
from metricloom.llm.suffix_array import permuted_common_prefixes, shard_text, suffix_array

LENGTH, GRAM, SHARD_BYTES, SEGMENT, CHUNK, PACK_LEVEL = 50, 12, 8 << 20, 1 << 20, 4 << 20, 6
PARTS, LEAST_TASKS, MOST_TASKS = 2, 16, 20_000
BLOCK, SAMPLED_STRINGS = 16 << 10, 1_024
_POS_BITS = np.uint64(24)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _word_hashes(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of the pieces data[at : at + size], read eight bytes at a time; pieces have eight bytes or more."""
    words = np.ndarray((len(data) - 7,), np.uint64, data, 0, (1,))
    out = size.astype(np.uint64) * _ODD
    rows = np.arange(len(at))
    for step in range(0, int(size.max(initial=0)), 8):
        rows = rows[size[rows] > step]
        x = (out[rows] ^ words[at[rows] + np.minimum(step, size[rows] - 8)]) * _ODD
        out[rows] = x ^ (x >> np.uint64(31))
    return out


def minimizer_runs(data: np.ndarray, segment: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(first string, strings, offset of the minimizer, its hash) of runs of strings that share a minimizer.

    `segment` numbers the segment of each byte; strings lie in one segment.
    """
    n, width = len(data) - length + 1, length - gram + 1
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    key = np.ndarray((len(data) - gram + 1,), np.uint64, padded, gram - 8, (1,)) * np.uint64(0xC2B2AE3D27D4EB4F)
    key ^= key >> np.uint64(29)
    key += np.ndarray((len(data) - gram + 1,), np.uint64, padded, 0, (1,))
    key *= _ODD
    key ^= key >> np.uint64(32)
    key <<= _POS_BITS
    key |= np.arange(len(key), dtype=np.uint64)
    reach = 1
    while reach * 2 <= width:
        np.minimum(key[:-reach], key[reach:], out=key[:-reach])  # reads ahead of what it writes
        key = key[:-reach]
        reach *= 2
    if width > reach:
        key = np.minimum(key[: n], key[width - reach : width - reach + n])
    key = key[:n]
    inside = segment[:n] == segment[length - 1 :]
    fresh = np.ones(n, bool)
    fresh[1:] = (key[1:] != key[:-1]) | (segment[1:n] != segment[: n - 1])
    first = np.flatnonzero(fresh & inside)
    edges = np.append(np.flatnonzero(fresh | ~inside), n)
    count = edges[np.searchsorted(edges, first, side="right")] - first
    best = key[first]
    return first, count, (best & np.uint64((1 << 24) - 1)).astype(np.int64) - first, best >> _POS_BITS


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    words = np.ndarray((len(data) - 7,), np.uint64, data, 0, (1,))
    same = np.ones(len(a), bool)
    for at in range(0, int(size.max(initial=0)), 8):
        last = np.minimum(at, size - 8)
        same &= words[a + last] == words[b + last]
    return same


def _later_copies(data: np.ndarray, first: np.ndarray, size: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Rows whose bytes are those of a row with a smaller document."""
    content = _word_hashes(data, first, size)
    by = np.lexsort((doc, content))
    ordered = content[by]
    lead = np.ones(len(by), bool)
    lead[1:] = ordered[1:] != ordered[:-1]
    leader = np.empty(len(by), np.int64)
    leader[by] = by[np.maximum.accumulate(np.where(lead, np.arange(len(by)), 0))]
    later = np.flatnonzero(doc > doc[leader])
    later = later[size[later] == size[leader[later]]]
    return later[_same_bytes(data, first[later], first[leader[later]], size[later])]


def _pack(
    doc: np.ndarray, at: np.ndarray, count: np.ndarray, offset: np.ndarray, data: np.ndarray, first: np.ndarray, length: int, part: np.ndarray
) -> bytes:
    """Runs as bytes; `part` ascends."""
    size = count + length - 1
    taken = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
    steps = [np.diff(x.astype(np.int64), prepend=0) for x in (doc, at)]  # small numbers compress better
    ends = np.searchsorted(part, np.arange(PARTS), side="right")
    parts = [np.array([len(doc), *ends], np.int64), *steps, count.astype(np.uint8), offset.astype(np.uint8), data[taken]]
    return zstandard.ZstdCompressor(level=PACK_LEVEL).compress(b"".join(p.tobytes() for p in parts))


def _unpack(blob: bytes, length: int = LENGTH, part: int | None = None) -> tuple[np.ndarray, ...]:
    """(document, place, strings, offset, bytes) of the runs of one part, or of all."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    head = 8 + 8 * PARTS
    n, *ends = (int(x) for x in np.frombuffer(raw, np.int64, 1 + PARTS))
    doc, at = np.frombuffer(raw, np.int64, n, head).cumsum(), np.frombuffer(raw, np.int64, n, head + 8 * n).cumsum()
    count, offset = (np.frombuffer(raw, np.uint8, n, head + k * n).astype(np.int64) for k in (16, 17))
    data = np.frombuffer(raw, np.uint8, -1, head + 18 * n)
    if part is None:
        return doc, at, count, offset, data
    a, b = ends[part - 1] if part else 0, ends[part]
    low, high = (int((count[:k] + length - 1).sum()) for k in (a, b))
    return doc[a:b], at[a:b], count[a:b], offset[a:b], data[low:high].copy()  # a copy lets the rest go


def _ranges(doc: np.ndarray, start: np.ndarray, stop: np.ndarray, shard: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(shard.astype(np.int32)), pa.array(doc), pa.array(start), pa.array(stop), pa.nulls(len(doc), pa.binary())],
        ["shard", "doc_id", "start", "stop", "blob"],
    )


def _runs(texts: list[tuple[int, int, bytes]], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(bytes, document, place, first string, strings, offset and hash of the minimizer) of the runs of some segments."""
    sizes = np.array([len(t) for _, _, t in texts])
    data = np.frombuffer(b"".join(t for _, _, t in texts) + bytes(8), np.uint8)
    segment = np.repeat(np.arange(len(texts)), sizes)
    first, count, offset, best = minimizer_runs(data[:-8], segment, length, gram)
    doc = np.array([d for d, _, _ in texts])[segment[first]]
    at = first - (np.cumsum(sizes) - sizes)[segment[first]] + np.array([p for _, p, _ in texts])[segment[first]]
    return data, doc, at, first, count, offset, best


def _minimizer_bytes(texts: list[tuple[int, int, bytes]], length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(minimizer, bytes of its runs that `_chunk` would send) for the minimizers of some segments."""
    data, doc, _, first, count, _, best = _runs(texts, length, gram)
    size = count + length - 1
    weight = size.astype(float)
    weight[_later_copies(data, first, size, doc)] = 0
    return _summed(best, weight)


def _summed(minimizer: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    told, where = np.unique(minimizer, return_inverse=True)
    return told, np.bincount(where, weight, len(told))


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Whether each value stands in a sorted list."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _chunk(texts: list[tuple[int, int, bytes]], shards: int, length: int, gram: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Runs of some segments (doc_id, place in the document, bytes), packed per shard, and what is covered already.

    The runs of the minimizers in `hot` are cut into single strings.
    """
    data, doc, at, first, count, offset, best = _runs(texts, length, gram)
    size = count + length - 1
    covered = _later_copies(data, first, size, doc)
    place = best % np.uint64(shards * PARTS)
    sent = np.ones(len(first), bool)
    sent[covered] = False
    if len(covered):
        yield _ranges(doc[covered], at[covered], at[covered] + size[covered], doc[covered] % shards)
    cut = np.flatnonzero(sent & _among(best, hot))
    if len(cut):
        sent[cut] = False
        step = np.arange(count[cut].sum()) - np.repeat(np.cumsum(count[cut]) - count[cut], count[cut])
        row = np.repeat(cut, count[cut])
        single = doc[row], at[row] + step, first[row] + step, np.ones(len(row), np.int64), offset[row] - step
        size = np.full(len(row), length)
        covered = _later_copies(data, single[2], size, single[0])
        if len(covered):
            yield _ranges(single[0][covered], single[1][covered], single[1][covered] + length, single[0][covered] % shards)
        to_place = _word_hashes(data, single[2], size) % np.uint64(shards * PARTS)
        sent, stay = np.append(sent, np.ones(len(row), bool)), len(sent)
        sent[stay + covered] = False
        doc, at, first, count, offset = (np.append(x, y) for x, y in zip((doc, at, first, count, offset), single))
        place = np.append(place, to_place)
    place = place.astype(np.int64)
    shard, part = place // PARTS, place % PARTS
    to = np.flatnonzero(sent)
    to = to[np.argsort(place[to], kind="stable")]
    cuts = np.flatnonzero(np.diff(shard[to], prepend=-1))
    blobs, where = [], []
    for a, b in zip(cuts, np.append(cuts[1:], len(to))):
        rows = to[a:b]
        blobs.append(_pack(doc[rows], at[rows], count[rows], offset[rows], data, first[rows], length, part[rows]))
        where.append(shard[rows[0]])
    none = pa.nulls(len(blobs), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(where, pa.int32()), none, none, none, pa.array(blobs, pa.binary())],
                                     ["shard", "doc_id", "start", "stop", "blob"])


def _in_two_documents(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    by = np.argsort(hashes)
    if not len(by):
        return np.zeros(0, bool)
    begin = np.flatnonzero(np.append(True, hashes[by][1:] != hashes[by][:-1]))
    held = doc[by]
    several = np.minimum.reduceat(held, begin) != np.maximum.reduceat(held, begin)
    out = np.empty(len(by), bool)
    out[by] = np.repeat(several, np.diff(np.append(begin, len(by))))
    return out


def shard_ranges(blobs: list[bytes], length: int, gram: int, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_id, start, stop) of the covered ranges of one part of a shard."""
    parts = [_unpack(b, length, part) for b in blobs]
    doc, at, count, offset, data = (np.concatenate([p[i] for p in parts]) for i in range(5))
    del parts
    if not len(doc):
        return doc, at, at
    size = count + length - 1
    begin = np.cumsum(size) - size
    side = (length - gram) // 2  # each string reaches this far to the left of its minimizer, or to the right
    repeated = np.zeros(len(doc), bool)
    for reach, fits in ((0, offset + gram + side <= size), (side, offset >= side)):
        rows = np.flatnonzero(fits)
        hashes = _word_hashes(data, begin[rows] + offset[rows] - reach, np.full(len(rows), gram + side))
        repeated[rows] |= _in_two_documents(hashes, doc[rows])
    rows = np.flatnonzero(repeated)
    copies = rows[_later_copies(data, begin[rows], size[rows], doc[rows])]
    whole_runs = doc[copies], at[copies], at[copies] + size[copies]
    repeated[copies] = False  # equal runs are one string of the text, that of their least document
    rows = np.flatnonzero(repeated)
    if not len(rows):
        return whole_runs
    text, places = shard_text(data, begin[rows], size[rows])
    order = suffix_array(text)
    owner = np.repeat(np.arange(len(rows)), size[rows] + 1)
    owner = np.append(owner, 0)
    whole = np.zeros(len(text), bool)  # positions where a string of `length` bytes starts
    inside = np.arange(len(text) - 1) - places[owner[:-1]]
    whole[:-1] = inside < count[rows][owner[:-1]]
    order = order[whole[order]]  # a shorter suffix shares no `length` bytes, so it parts no equal strings
    common = permuted_common_prefixes(text, order, length)
    holder = doc[rows][owner[order]]
    begins = np.flatnonzero(np.append(True, common[order[1:]] < length))
    least = np.repeat(np.minimum.reduceat(holder, begins), np.diff(np.append(begins, len(order))))
    hit = np.sort(order[holder > least])
    if not len(hit):
        return whole_runs
    new = np.append(True, (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]]))
    lo, hi = hit[new], hit[np.append(np.flatnonzero(new)[1:] - 1, len(hit) - 1)]
    run = rows[owner[lo]]
    found = doc[run], at[run] + lo - places[owner[lo]], at[run] + hi - places[owner[lo]] + length
    return tuple(np.concatenate(x) for x in zip(whole_runs, found))


def sampling(hot_bytes: int, length: int) -> int:
    """One block in how many is looked at, so that SAMPLED_STRINGS strings of a hot minimizer are expected there."""
    return max(1, hot_bytes // (length * SAMPLED_STRINGS))


def hot_minimizers(rows: DataFrame, hot_bytes: int, length: int, gram: int, sample: int) -> np.ndarray:
    """The minimizers whose runs hold about `hot_bytes` or more, in order, from one of `sample` blocks of text."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, found, held, size = np.zeros(0, np.uint64), np.zeros(0), [], 0

        def with_held() -> tuple[np.ndarray, np.ndarray]:
            new, weight = _minimizer_bytes(held, length, gram)
            return _summed(np.append(told, new), np.append(found, weight))

        for batch in batches:
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = t.as_buffer()
                for place in range(0, len(raw) - length + 1, BLOCK):
                    if sample > 1 and xxhash.xxh64_intdigest(f"{d}:{place}") % sample:
                        continue
                    held.append((d, place, raw[place : place + BLOCK + length - 1].to_pybytes()))
                    size += len(held[-1][2])
                    if size >= CHUNK:
                        told, found = with_held()
                        held, size = [], 0
        if held:
            told, found = with_held()
        yield pa.RecordBatch.from_arrays([pa.array(told.view(np.int64)), pa.array(found * sample)], ["minimizer", "bytes"])

    sums = rows.mapInArrow(counted, "minimizer long, bytes double").groupBy("minimizer").agg(F.sum("bytes").alias("bytes"))
    hot = sums.filter(F.col("bytes") >= hot_bytes * 0.75).select("minimizer").collect()
    return np.sort(np.array([r.minimizer for r in hot], np.int64).view(np.uint64))


def shards_of(total: int, shard_bytes: int) -> int:
    return max(LEAST_TASKS, -(-total // shard_bytes))


def packed_runs(
    docs: DataFrame, doc_id: str, text: str, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES,
    hot_bytes: int | None = None, sample: int | None = None,
) -> DataFrame:
    """(shard, doc_id, start, stop, blob): runs packed for their shard, or ranges that are covered already."""
    rows = docs.filter(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc_id"), text_of(text).cast("binary").alias("t")
    ).filter(F.octet_length("t") >= length)
    total = rows.agg(F.sum(F.octet_length("t").cast("long"))).first()[0] or 0
    shards = shards_of(total, shard_bytes)
    hot_bytes = shard_bytes if hot_bytes is None else hot_bytes
    hot = np.zeros(0, np.uint64)
    if total * length > hot_bytes:  # a run of one string holds `length` bytes, so others have no hot minimizer
        hot = hot_minimizers(rows, hot_bytes, length, gram, sampling(hot_bytes, length) if sample is None else sample)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = t.as_buffer().to_pybytes()
                for place in range(0, len(raw) - length + 1, SEGMENT):
                    held.append((d, place, raw[place : place + SEGMENT + length - 1]))
                    size += len(held[-1][2])
                    if size >= CHUNK:
                        yield from _chunk(held, shards, length, gram, hot)
                        held, size = [], 0
        if held:
            yield from _chunk(held, shards, length, gram, hot)

    packed = rows.mapInArrow(cut, "shard int, doc_id long, start long, stop long, blob binary")
    return packed.repartitionById(min(shards, MOST_TASKS), "shard")


def covered_ranges(
    docs: DataFrame, doc_id: str, text: str, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES,
    hot_bytes: int | None = None, sample: int | None = None,
) -> DataFrame:
    """(doc_id, start, stop) in bytes, overlapping; every byte to remove lies in one of them."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = ["doc_id", "start", "stop"]
        shard, blobs = None, []

        def solved() -> Iterator[pa.RecordBatch]:
            for part in range(PARTS if blobs else 0):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in shard_ranges(blobs, length, gram, part)], schema)

        for batch in batches:
            ready = batch.filter(batch.column(4).is_null())
            if ready.num_rows:
                yield pa.RecordBatch.from_arrays([ready.column(k) for k in (1, 2, 3)], schema)
            for s, b in zip(batch.column(0).to_pylist(), batch.column(4).to_pylist()):
                if b is None:
                    continue
                if s != shard:
                    yield from solved()
                    shard, blobs = s, []
                blobs.append(b)
        yield from solved()

    packed = packed_runs(docs, doc_id, text, length, gram, shard_bytes, hot_bytes, sample)
    return packed.sortWithinPartitions("shard").mapInArrow(find, "doc_id long, start long, stop long")


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES,
    hot_bytes: int | None = None, sample: int | None = None,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): `kept` holds the remaining bytes, `n_spans` counts removed runs."""
    ranges = covered_ranges(docs, doc_id, text, length, gram, shard_bytes, hot_bytes, sample)
    per_doc = ranges.groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("ranges")).withColumnRenamed("doc_id", "d")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).cast("binary").alias("t"))

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [packer.compress(t.as_buffer()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["doc_id", "t"])

    rows = rows.mapInArrow(squeeze, "doc_id long, t binary")  # texts cross the shuffle by doc_id
    joined = rows.join(per_doc, F.col("doc_id") == F.col("d"), "left").select("doc_id", "t", "ranges.start", "ranges.stop")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
            for t, lo, hi in zip(batch.column(1), batch.column(2), batch.column(3)):
                raw = unpacker.decompress(t.as_buffer())
                gone = spans = 0
                if lo.is_valid:
                    a, b = lo.values.to_numpy(), hi.values.to_numpy()
                    by = np.argsort(a)
                    a, b = a[by], np.minimum(np.maximum.accumulate(b[by]), len(raw))
                    edge = np.append(True, a[1:] > b[:-1])
                    a, b = a[edge], b[np.append(np.flatnonzero(edge)[1:] - 1, len(b) - 1)]
                    gone, spans = int((b - a).sum()), len(a)
                    raw_kept = b"".join(raw[x:y] for x, y in zip(np.append(0, b), np.append(a, len(raw))))
                else:
                    raw_kept = raw
                for k, v in zip(out, (len(raw), gone, spans, raw_kept)):
                    out[k].append(v)
            arrays = [batch.column(0), *[pa.array(out[k], pa.int64()) for k in ("n_bytes", "n_removed", "n_spans")], pa.array(out["kept"], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *out])

    return joined.mapInArrow(take, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
