"""Suffix arrays of one shard by induced sorting, with numpy in place of character loops.

Suffixes are S (smaller than the next one) or L. The leftmost S of each run (LMS) cuts the text into substrings;
sorting those and naming them gives a shorter text whose suffix order is found first. From the order of the LMS
suffixes one pass to the right induces the L suffixes and one pass to the left the S suffixes. A pass goes bucket by
bucket (one per character); all suffixes that a bucket holds at that moment are induced in one vector step, and a step
repeats only for runs of one character.
"""

from __future__ import annotations

import numpy as np

END, GAP, SHIFT = 0, 1, 2  # symbols: end of the shard, gap between strings, and bytes from here on
SIGMA = 256 + SHIFT


def shard_text(parts: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The strings `parts[start : start + length]` joined with gaps, and each string's place in the joined text."""
    places = np.cumsum(lengths + 1) - lengths - 1
    text = np.full(int(lengths.sum()) + len(lengths) + 1, GAP, np.uint16)
    inside = np.repeat(places - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    source = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    text[inside] = parts[source].astype(np.uint16) + SHIFT
    text[-1] = END
    return text, places


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """True for S suffixes; the end counts as S."""
    ends = np.append(np.flatnonzero(text[:-1] != text[1:]), len(text) - 1)
    rises = np.append(text[ends[:-1]] < text[ends[:-1] + 1], True)
    return np.repeat(rises, np.diff(ends, prepend=-1))


def _induce(text: np.ndarray, is_s: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The order of all suffixes from LMS suffixes that are sorted (at least by their first character)."""
    ends = np.cumsum(sizes)
    begins = ends - sizes
    order = np.full(len(text), -1, np.int64)
    seeds = np.bincount(text[lms], minlength=len(sizes))
    order[np.repeat(ends - np.cumsum(seeds), seeds) + np.arange(len(lms))] = lms
    used = np.flatnonzero(sizes)
    head, tail = begins.copy(), ends.copy()

    def push(block: np.ndarray, s: bool) -> None:
        before = block[block > 0] - 1
        before = before[is_s[before] == s]
        if not len(before):
            return
        symbol = text[before]
        by = np.argsort(symbol, kind="stable")
        counts = np.bincount(symbol, minlength=len(sizes))
        rank = np.arange(len(before)) - np.repeat(np.cumsum(counts) - counts, counts)
        symbol = symbol[by]
        if s:
            order[tail[symbol] - 1 - rank] = before[by]
            tail[:] -= counts
        else:
            order[head[symbol] + rank] = before[by]
            head[:] += counts

    for c in used:
        at = begins[c]
        while at < head[c]:
            at, block = head[c], order[at : head[c]]
            push(block, False)
        push(order[ends[c] - seeds[c] : ends[c]], False)
    for c in used[::-1]:
        if c == END:
            break
        at = ends[c]
        while tail[c] < at:
            at, block = tail[c], order[tail[c] : at][::-1]
            push(block, True)
        push(order[begins[c] : head[c]][::-1], True)
    return order


def _words(text: np.ndarray) -> np.ndarray:
    """Four symbols from each position on as one number; the text must be padded by three symbols."""
    return np.ndarray((len(text) - 3,), np.uint64, text, 0, (text.itemsize,))


def _names(text: np.ndarray, sorted_lms: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Ranks of the LMS substrings in text order; equal substrings share one, gaps and the end have one each."""
    padded = np.concatenate([text, np.zeros(8, np.uint16)])
    words = _words(padded)
    following = np.zeros(len(text) + 1, np.int64)
    following[lms] = np.append(lms[1:], lms[-1]) - lms + 1  # length with the first character of the next one
    a, b = sorted_lms[:-1], sorted_lms[1:]
    left = following[a]
    differs = (left != following[b]) | (text[a] <= GAP)
    open_ = np.flatnonzero(~differs)
    at = 0
    while len(open_):
        rest = left[open_] - at
        x = words[a[open_] + at] ^ words[b[open_] + at]
        short = rest < 4
        x[short] &= (np.uint64(1) << (rest[short].astype(np.uint64) * np.uint64(16))) - np.uint64(1)
        wrong = x != 0
        differs[open_[wrong]] = True
        open_ = open_[~wrong & (rest > 4)]
        at += 4
    names = np.zeros(len(text), np.int64)
    names[sorted_lms] = np.concatenate([[0], np.cumsum(differs)])
    return names[lms]


def _rank_order(names: np.ndarray) -> np.ndarray:
    """Suffix order of the named text. Its alphabet is too large for a step per bucket, so the recursion ends here with
    ranks of doubling length; gaps are unique, which bounds the rounds by the logarithm of the longest string."""
    rank, step, n = names.astype(np.int64), 1, len(names)
    while True:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key)
        ordered = key[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if new[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2
        if step >= n:
            return order


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a text from `shard_text`; gaps count as different characters."""
    is_s = smaller_than_next(text)
    sizes = np.bincount(text, minlength=SIGMA)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    if len(lms) < 2:
        return _induce(text, is_s, lms, sizes)
    rough = _induce(text, is_s, lms[np.argsort(text[lms], kind="stable")], sizes)
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    names = _names(text, rough[is_lms[rough]], lms)
    return _induce(text, is_s, lms[_rank_order(names)], sizes)


def permuted_common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each position, in text order, the symbols it shares with the suffix before it in `order`, `most` at most."""
    previous = np.full(len(text), -1, np.int64)
    previous[order[1:]] = order[:-1]
    padded = np.concatenate([text, np.zeros(most + 8, np.uint16)])
    words = _words(padded)
    shared = np.zeros(len(text), np.int64)
    here = np.flatnonzero(previous >= 0)
    there = previous[here]
    for at in range(0, most, 4):
        x = words[here + at] ^ words[there + at]
        same = x == 0
        low = x[~same]
        low &= ~low + np.uint64(1)  # lowest bit that differs
        shared[here[~same]] = at + (np.log2(low.astype(np.float64)).astype(np.int64) >> 4)
        here, there = here[same], there[same]
        shared[here] = at + 4
        if not len(here):
            break
    return np.minimum(shared, most)
