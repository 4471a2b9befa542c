"""Words of Arrow texts as numbers, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


STRIP_BYTES = 4 << 20


def strips(texts: pa.Array, most: int = STRIP_BYTES) -> Iterator[pa.Array]:
    """Parts of about `most` bytes of text, a longer text alone."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    first, base = 0, 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield texts.take(pa.array(np.arange(first, last)))
        first, base = last, int(ends[last - 1])


def encode(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(codes, bounds, words): the words of text i are `words[codes[bounds[i]:bounds[i + 1]]]`.

    Words are runs of characters other than ASCII white space; `lower` turns A-Z, and no other letters, to lower case.
    """
    if texts.offset:  # casts and string functions read a slice from the wrong place
        texts = texts.take(pa.array(np.arange(len(texts))))
    texts = texts.cast(pa.large_string())
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat = split.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    seen = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False))))
    offsets = split.offsets.to_numpy()
    coded = flat.filter(full).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), seen[offsets - offsets[0]], coded.dictionary
