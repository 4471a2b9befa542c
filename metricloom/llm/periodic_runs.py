"""Periodic runs by dyadic square catching.

A run is a stretch of words with smallest period q, at least two periods long, that no neighbouring word extends. A
square of half-length p, 2B <= p < 4B for a power of two B, holds a whole aligned block of B words in the first half,
and that block stands again p words on. So each completed block of each size B has a catcher: of every word appended
later, at distances from 2B up to 4B behind the block, the window of B words that it completes is compared with the
block. A block that is met again opens a stretch of period p; stretches of neighbouring blocks with one period are one.
Its suffix comparison goes on to the left of the first block and, with every further word, to the right of the last;
once it has matched p words it reports squares, and all squares of a stretch merge into one run. Windows are compared
by 64-bit names, each made from the names of its two halves; every word has two catchers per block size, so n words
cost O(n log n) comparisons and, in texts made of repetitions, sorts of as many numbers. Runs are compared word by word
before they are returned, and found anew under other names if two windows ever shared one by accident.

`Catchers.append` takes any number of words at once and does what one word after the other would do, a block size at a
time. Texts of a batch are appended together, kept apart by words of their own.

Scale: documents are independent, so the input is read once and nothing is shuffled; a task holds one Arrow batch and
eight bytes per word and block size of one strip of texts.

Defined results: null and blank texts have no words and no runs; repeated rows repeat; a null doc_id stays null; other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from metricloom.llm.common import text_of
from metricloom.llm.word_codes import encode

MIN_LENGTH = 12
STRIP_WORDS = 1 << 17
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return x


class Catchers:
    """Words come by `append`; `runs()` are the runs of the words so far."""

    def __init__(self, longest: int | None = None, seed: int = 0):
        """`longest`: the largest period to look for; all if None."""
        self.longest, self.seed = longest, seed
        self.words = np.zeros(0, np.int64)
        self.names: list[np.ndarray] = []  # by level k: names of the windows of 2^k words, by start
        self.open: list[np.ndarray] = []  # by level: (period, first block, last block) of stretches that may go on
        self.closed: list[np.ndarray] = []  # (start, end, period)

    def append(self, words: np.ndarray) -> None:
        self.words = np.concatenate((self.words, words))
        most = len(self.words) // 2 if self.longest is None else min(self.longest, len(self.words) // 2)
        k = 0
        while k == 0 or (2 << k) <= most:
            if k == len(self.names):
                self.names.append(np.zeros(0, np.uint64))
                self.open.append(np.zeros((3, 0), np.int64))
            done = len(self.names[k])
            self._name(k, done)
            stretches = self._merged(np.concatenate((self.open[k], self._caught(k, done)), axis=1))
            goes_on = ((stretches[2] + 1) << k) + stretches[0] >= len(self.names[k])
            self.open[k] = stretches[:, goes_on]
            self.closed.append(self._runs(k, stretches[:, ~goes_on]))
            k += 1

    def _name(self, k: int, done: int) -> None:
        if k == 0:
            new = _mixed((self.words[done:].astype(np.uint64) + np.uint64(self.seed + 1)) * np.uint64(0xD1342543DE82EF95))
        else:
            half, below = 1 << (k - 1), self.names[k - 1]
            new = _mixed(below[done : len(below) - half] * np.uint64(0xBF58476D1CE4E5B9 + 2 * (self.seed + k)) + below[done + half :])
        self.names[k] = np.concatenate((self.names[k], new)) if done else new

    def _caught(self, k: int, done: int) -> np.ndarray:
        """(period, block, block) of every block met again by a window that starts at `done` or later."""
        names, size = self.names[k], 1 << k
        blocks, caught = names[::size], []
        for shift in (1, 2, 3) if k == 0 else (2, 3):
            first = max(done >> k, shift)
            if first << k >= len(names):
                continue
            later = names[first << k :]
            met = later == np.repeat(blocks[first - shift : len(blocks) - shift], size)[: len(later)]
            at = np.flatnonzero(met) + (first << k)
            at = at[at >= done]
            block = (at >> k) - shift
            caught.append(np.stack((at - (block << k), block, block)))
        return np.concatenate(caught, axis=1) if caught else np.zeros((3, 0), np.int64)

    @staticmethod
    def _merged(stretches: np.ndarray) -> np.ndarray:
        """Stretches of one period whose blocks are neighbours become one."""
        if stretches.shape[1] < 2:
            return stretches
        period, first, last = stretches[:, np.lexsort((stretches[1], stretches[0]))]
        new = np.concatenate(([True], (period[1:] != period[:-1]) | (first[1:] != last[:-1] + 1)))
        ends = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(new) - 1]))
        return np.stack((period[new], first[new], last[ends]))

    def _runs(self, k: int, stretches: np.ndarray) -> np.ndarray:
        """(start, end, period) of the stretches that match at least one period of words."""
        period, first, last = stretches
        long = (last - first + 3) << k > period
        period, first, last = period[long], first[long], last[long]
        left, right = first << k, (last + 1) << k
        for j in range(k - 1, -1, -1):  # both sides match fewer than 2^k further words
            names, step = self.names[j], 1 << j
            fits = left >= step
            x = np.where(fits, left - step, 0)
            left = np.where(fits & (names[x] == names[x + period]), x, left)
            fits = right + period + step <= len(self.words)
            x = np.where(fits, right, 0)
            right = np.where(fits & (names[x] == names[np.where(fits, x + period, 0)]), right + step, right)
        square = right - left >= period
        return np.stack((left, right + period, period))[:, square]

    def runs(self) -> np.ndarray:
        """(start, end, smallest period) of every run, in order."""
        found = [*self.closed, *(self._runs(k, s) for k, s in enumerate(self.open))]
        start, end, period = np.concatenate([np.zeros((3, 0), np.int64), *found], axis=1)
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        # a stretch with a multiple of its smallest period has the same bounds
        new = np.ones(len(start), bool)
        new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        return np.stack((start[new], end[new], period[new]))


def runs_of(words: np.ndarray, longest: int | None = None) -> np.ndarray:
    """(start, end, period) of the runs of a sequence of numbers from zero up."""
    seed = 0
    while True:
        catchers = Catchers(longest, seed)
        catchers.append(words)
        runs = catchers.runs()
        if all((words[a + p : b] == words[a : b - p]).all() for a, b, p in runs.T):
            return runs
        seed += 1


def _strips(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about STRIP_WORDS words, a longer text alone."""
    first = 0
    for i in range(1, len(bounds)):
        if i == len(bounds) - 1 or bounds[i + 1] - bounds[first] > STRIP_WORDS:
            yield first, i
            first = i


def text_runs(codes: np.ndarray, bounds: np.ndarray, least: int) -> np.ndarray:
    """(text, start, length, period) of the runs of at least `least` words, by text and start, then period."""
    found = [np.zeros((4, 0), np.int64)]
    for first, last in _strips(bounds):
        sizes = np.diff(bounds[first : last + 1])
        part = codes[bounds[first] : bounds[last]]
        starts = bounds[first:last] - bounds[first] + np.arange(last - first)  # with a word of its own behind each text
        apart = np.arange(last - first) + (int(part.max()) + 1 if len(part) else 0)
        a, b, p = runs_of(np.insert(part, np.cumsum(sizes), apart), int(sizes.max(initial=0)) // 2)
        text = np.searchsorted(starts, a, "right") - 1
        found.append(np.stack((text + first, a - starts[text], b - a, p))[:, b - a >= least])
    runs = np.concatenate(found, axis=1)
    return runs[:, np.lexsort((runs[3], runs[1], runs[0]))]


def _kept(codes: np.ndarray, bounds: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Whether a word stays: no run covers it after its first period."""
    text, start, length, period = runs
    depth = np.zeros(len(codes) + 1, np.int64)
    np.add.at(depth, bounds[text] + start + period, 1)
    np.add.at(depth, bounds[text] + start + length, -1)
    return depth[:-1].cumsum() == 0


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): `collapsed` is the text's words without repetitions inside runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, bounds, words = encode(batch.column(1))
            runs = text_runs(codes, bounds, least)
            kept = _kept(codes, bounds, runs)
            at = np.concatenate(([0], kept.cumsum()))[bounds]
            lists = pa.LargeListArray.from_arrays(at, words.take(pa.array(codes[kept])))
            structs = pa.StructArray.from_arrays([pa.array(x) for x in runs[1:]], ["start", "length", "period"])
            ends = np.searchsorted(runs[0], np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(bounds)), pa.ListArray.from_arrays(ends, structs),
                 pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("t")).mapInArrow(run, SCHEMA)
