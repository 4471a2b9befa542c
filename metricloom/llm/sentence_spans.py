"""Sliding sentence spans: removal of sentences inside runs that stood earlier in the corpus.

Texts are cut after sentence marks and line ends; the pieces keep their white space, so they join to the same text.
Each run of `span` consecutive sentences (the whole text if it has fewer) with at least `min_words` words is hashed
after lower-casing and joining white space. The first place of a run, by doc_id and then position, keeps its
sentences; a sentence that any other place covers is removed.

With `extend`, the default, runs of short sentences are hashed too: from each sentence on, and back from each sentence, a run takes
as many further sentences as it needs for `min_words`. Both kinds depend on the run's own words only, so each sentence
of a repeated passage that has `span` sentences and `min_words` words lies in a run that is found, wherever the passage
stands. A text under `min_words` words is one run, which only equal whole texts repeat. Without `extend`, runs under
`min_words` words are left out. What the ten words cost: a pair of sentences with fewer, repeated between other sentences,
stays. Eight words instead would touch 3,613 of the 10,000 texts at sf0.1 in place of 2,164, most by one or two
sentences that plain prose repeats by chance.

Scale: a batch of documents sends each hash once, for the first place in the batch; later places in the batch are
covered already. So a passage in a third of all rows is a row per batch in the exchange by hash, some million rows of
40 bytes at 100 TB, and no task holds all its places. Positions of a document are bounded by its sentences, two runs for each at most, and a run by `min_words`
sentences or `span`, if that is more, and a blank one. 64-bit hashes: among 10^9 different runs a clash of
any two has a probability of 3 %, and among those of one clean document below 10^-8.

Defined results: null and blank texts have no run and stay as they are; rows that share a doc_id are one document, whose
runs at one position are one place; rows without doc_id are kept whole; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from metricloom.llm.common import text_of

SPAN, MIN_WORDS = 2, 10
_END = re.compile(r"[.!?]+\s+|\n\s*")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def sentences(text: str) -> list[str]:
    cuts = [0, *(m.end() for m in _END.finditer(text)), len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:]) if b > a]


def run_places(words: np.ndarray, span: int, min_words: int, extend: bool) -> tuple[np.ndarray, np.ndarray]:
    """(position, sentences) of every run with enough words; `words` counts those of each sentence."""
    n, size = len(words), min(span, len(words))
    so_far = np.append(0, np.cumsum(words))
    if not extend:
        at = np.flatnonzero(so_far[size:] - so_far[: n - size + 1] >= min_words)
        return at, np.full(len(at), size)
    if so_far[-1] < min_words:  # a text of blanks has no run
        return np.zeros(int(so_far[-1] > 0), np.int64), np.full(int(so_far[-1] > 0), n)
    at = np.arange(n - size + 1)
    stop = np.maximum(at + size, np.searchsorted(so_far, so_far[at] + min_words))
    end = np.arange(size, n + 1)
    start = np.minimum(end - size, np.searchsorted(so_far, so_far[end] - min_words, side="right") - 1)
    back = (start >= 0) & (stop[start] != end)  # others are runs from their first sentence on already
    fits = stop <= n
    return np.append(at[fits], start[back]), np.append((stop - at)[fits], (end - start)[back])


def run_hashes(text: str, span: int, min_words: int, extend: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, sentences, hash) of every run with enough words."""
    plain = [p.lower().split() for p in sentences(text)]
    if not plain:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    each = np.array([xxhash.xxh64_intdigest(" ".join(p)) for p in plain], np.uint64)
    words = np.array([len(p) for p in plain])
    at, size = run_places(words, span, min_words, extend)
    mixed = size.astype(np.uint64)
    for k in range(int(size.max(initial=0))):
        rows = np.flatnonzero(size > k)
        x = (mixed[rows] ^ each[at[rows] + k]) * _MIX
        mixed[rows] = x ^ (x >> np.uint64(29))
    return at, size, mixed


def remove_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, min_words: int = MIN_WORDS, extend: bool = True
) -> DataFrame:
    """(doc_id, n_sentences, n_removed, text): `text` holds the remaining sentences."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, places, sizes, hashes = [], [], [], []
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at, size, h = run_hashes(t, span, min_words, extend)
                ids.append(np.full(len(at), d, np.int64)), places.append(at), sizes.append(size), hashes.append(h)
            if not ids:
                continue
            doc, at, size, h = (np.concatenate(x) for x in (ids, places, sizes, hashes))
            by = np.lexsort((at, doc, h))
            doc, at, size, h = doc[by], at[by], size[by], h[by]
            first = np.ones(len(h), bool)
            first[1:] = h[1:] != h[:-1]
            lead = np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))
            covered = (doc != doc[lead]) | (at != at[lead])
            # a covered place needs no other: its own number keeps it away from the hash of its run
            key = np.where(covered, (doc.astype(np.uint64) * _MIX) ^ at.astype(np.uint64), h)
            arrays = [pa.array(key.view(np.int64)), pa.array(covered), pa.array(doc), pa.array(at), pa.array(size.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, ["h", "covered", "doc", "at", "size"])

    rows = docs.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("t"))
    runs = rows.mapInArrow(hashed, "h long, covered boolean, doc long, at long, size int")
    place = F.struct("doc", "at")
    first = F.min(F.when(~F.col("covered"), place)).over(Window.partitionBy("h"))
    hits = runs.select("doc", "at", "size", (F.col("covered") | (place != first)).alias("hit")).filter("hit")
    per_doc = hits.groupBy("doc").agg(F.collect_list(F.struct("at", "size")).alias("hits"))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("t"))
    joined = texts.join(per_doc, F.col("doc_id") == F.col("doc"), "left").select("doc_id", "t", "hits.at", "hits.size")

    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, gone, kept = [], [], []
            for t, starts, sizes in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                pieces = sentences(t)
                stay = np.ones(len(pieces), bool)
                if starts.is_valid:
                    at, size = starts.values.to_numpy(), sizes.values.to_numpy()
                    at, size = at[at < len(pieces)], size[at < len(pieces)]
                    for k in range(int(size.max(initial=0))):
                        stay[np.minimum(at + k, len(pieces) - 1)[size > k]] = False
                counts.append(len(pieces)), gone.append(int((~stay).sum()))
                kept.append(t if stay.all() else "".join(p for p, s in zip(pieces, stay) if s))
            arrays = [batch.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_sentences", "n_removed", "text"])

    return joined.mapInArrow(rebuilt, "doc_id long, n_sentences long, n_removed long, text string")
