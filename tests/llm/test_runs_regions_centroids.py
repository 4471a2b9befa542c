"""Periodic runs, the Jaccard join and centroid clustering beside brute force."""

import hashlib
import math
import os
import random
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from metricloom.llm import common, heap_centroids, jaccard_regions, periodic_runs  # noqa: E402
from metricloom.llm.queries import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least):
    """(start, length, smallest period) of all runs, by trying every period."""
    n, best = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i >= p:
                best.setdefault((i, j + p - i), p)
            i = max(j, i + 1)
    return sorted((a, m, p) for (a, m), p in best.items() if m >= least)


def run_row(doc_id, text):
    words = WORDS.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words, 12)
    gone = set().union(*[range(a + p, a + m) for a, m, p in runs])
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *head, sha("".join(f"{a},{m},{p}\n" for a, m, p in runs)), sha(kept))


def test_runs_of_small_sequences_equal_brute_force():
    rng = random.Random(1)
    for _ in range(600):
        n, k = rng.randint(0, 60), rng.choice([1, 2, 3, 5])
        words = [rng.randrange(k) for _ in range(n)]
        if n > 10 and rng.random() < 0.5:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 2))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        want = [(a, a + m, p) for a, m, p in plain_runs(words, 0)]
        assert list(map(tuple, periodic_runs.runs_of(np.array(words, np.int64)).T.tolist())) == want
        catchers, at = periodic_runs.Catchers(), 0
        while at < n:  # the same by parts, down to one word at a time
            step = rng.randint(1, 5)
            catchers.append(np.array(words[at : at + step], np.int64))
            at += step
            assert list(map(tuple, catchers.runs().T.tolist())) == [(a, a + m, p) for a, m, p in plain_runs(words[:at], 0)]


def test_shared_names_are_found_out(monkeypatch):
    """Windows that share a name by accident are told apart under other names."""
    true = periodic_runs._mixed
    first = []

    def poor(x):
        first.append(1)
        return true(x) & np.uint64(1) if len(first) <= 6 else true(x)

    monkeypatch.setattr(periodic_runs, "_mixed", poor)
    words = np.random.default_rng(3).integers(0, 4, 80)
    assert list(map(tuple, periodic_runs.runs_of(words).T.tolist())) == [(a, a + m, p) for a, m, p in plain_runs(words.tolist(), 0)]


def test_run_query_equals_brute_force(spark, tmp_path):
    rows = [(r.doc_id, r.text) for r in common.table(spark, FOLDER, "documents").collect()]
    assert {tuple(r) for r in QUERIES["op11_periodic_runs"](spark, FOLDER).collect()} == {run_row(d, t) for d, t in rows}
    rng = random.Random(2)
    rows = [(d, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 90)))) for d in range(150)]
    rows += [(200, None), (201, ""), (202, " \n\x0b "), (203, "x y " * 40), (204, "a b c d e f " * 2), (204, "a b c d e f " * 2)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(str, QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()))
    assert [g.split("(", 1)[1] for g in got] == sorted(
        ", ".join(f"{k}={v!r}" for k, v in zip(["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"], run_row(*r))) + ")"
        for r in rows)


def test_long_runs(spark):
    text = "one two three " * 100_000 + " ".join(str(i) for i in range(50_000))
    docs = spark.createDataFrame([(1, text, 5, "x"), (None, text, 6, "y")], "doc_id long, text string, runs int, n_words string")
    for r in periodic_runs.periodic_runs(docs).collect():
        assert [tuple(x) for x in r.runs] == [(0, 300_000, 3)] and r.n_words == 350_000 and r.collapsed.startswith("one two three 0 1 2")
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def shingle_set(text):
    w = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))) if w else frozenset()


def jaccard_rows(rows):
    sets = [shingle_set(t) for _, t in rows]
    linked = lambda i, j: bool(sets[i]) and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])
    return {(d, len(s), c) for (d, _), s, c in zip(rows, sets, brute.components([d for d, _ in rows], linked))}


@pytest.fixture(scope="module")
def copies(spark):
    rng = random.Random(5)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(40))

    def edited(words, times):
        words = list(words)
        for _ in range(times):
            k, how = rng.randrange(len(words)), rng.random()
            if how < 0.4:
                words[k] = word()
            elif how < 0.7:
                words.insert(k, word())
            elif len(words) > 1:
                del words[k]
        return " ".join(words)

    rows = []
    for _ in range(50):
        base = [word() for _ in range(rng.choice([1, 2, 3, 8, 11, 12, 30, 60, 150, 400]))]
        rows += [(len(rows) + i, edited(base, rng.randint(0, max(1, len(base) // 25)))) for i in range(rng.randint(1, 8))]
    base = [word() for _ in range(120)]
    rows += [(1_000 + i, edited(base, rng.randint(0, 4))) for i in range(150)]
    rows += [(2_000, ""), (2_001, " \t"), (2_002, None), (2_003, rows[3][1].upper())]
    return rows, jaccard_rows(rows)


@pytest.mark.parametrize("region_bytes, documents", [(jaccard_regions.REGION_BYTES, 1_024), (20_000, 1_024), (6_000, 1_024), (1 << 20, 20)])
def test_jaccard_join_equals_brute_force(spark, copies, monkeypatch, region_bytes, documents):
    """Regions joined whole, split about pivots, and cut into tiles."""
    rows, want = copies
    monkeypatch.setattr(jaccard_regions, "REGION_DOCS", documents)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {tuple(r) for r in jaccard_regions.jaccard_components(docs, region_bytes=region_bytes).collect()} == want


def test_words_of_strips_and_slices():
    from metricloom.llm.word_codes import encode, strips

    rng = random.Random(2)
    texts = [" ".join(rng.choice(["Ä", "b", "Word", "\x1c", "x\x0by"]) for _ in range(rng.randint(0, 30))) for _ in range(500)]
    column = pa.array(texts)
    want = [shingle_set(t) for t in texts]
    for part in ([column], list(strips(column, 700)), [column.slice(0, 77), column.slice(77)], [column.cast(pa.large_string()).slice(3, 100)]):
        codes = [encode(p, lower=True) for p in part]
        words = [[w[c].as_py() for c in ids[a:b]] for ids, bounds, w in codes for a, b in zip(bounds[:-1], bounds[1:])]
        first = 3 if len(words) == 100 else 0
        assert [shingle_set(" ".join(w)) for w in words] == want[first : first + len(words)]
        assert [len(s) for p in part for s in jaccard_regions.shingle_sets(p)] == [len(s) for s in want[first : first + len(words)]]
    assert len(list(strips(column, 700))) > 20 and [len(p) for p in strips(pa.array([], pa.string()))] == []


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(7)
    for n in [*range(1, 60), 100, 333, 1000]:
        base = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for _ in range(6):
            gone = rng.permutation(n)[: rng.integers(0, n // 9 + 1)]
            other = np.unique(np.concatenate((np.delete(base, gone), rng.integers(0, 2**63, rng.integers(0, n // 18 + 1)).astype(np.uint64))))
            both = len(np.intersect1d(base, other))
            if 100 * both >= 90 * (len(base) + len(other) - both) and both < max(len(base), len(other)):
                assert len(np.intersect1d(jaccard_regions.signature_keys(base), jaccard_regions.signature_keys(other)))


def test_jaccard_edges(spark):
    text = " ".join(f"w{i}" for i in range(60))
    long = " ".join(f"w{i}" for i in range(150_000))
    rows = [(1, text), (1, text), (2, text + " tail"), (3, None), (4, ""), (None, text), (None, "own words here"), (5, long), (6, long + " end"), (7, "two words")]
    docs = spark.createDataFrame([(*r, 1, "n") for r in rows], "doc_id long, text string, node long, keys string")
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_regions.jaccard_components(docs).collect()]
    want = [(1, 58, 1), (1, 58, 1), (2, 59, 1), (3, 0, 3), (4, 0, 4), (None, 58, 1), (None, 1, None), (5, 149_998, 5), (6, 149_999, 5), (7, 1, 7)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert jaccard_regions.jaccard_components(docs.limit(0)).count() == 0


def plain_clusters(rows, k=40, rounds=5, dims=64):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centres, vectors = [v for _, v in order[:k]], np.array([v for _, v in kept], np.int64)
    for last in [False] * rounds + [True]:
        far = ((vectors[:, None] - np.array(centres)[None]) ** 2).sum(2)
        found = far.argmin(1)
        if not last:
            centres = [[int(s) // int((found == c).sum()) for s in vectors[found == c].sum(0)] if (found == c).any() else old for c, old in enumerate(centres)]
    return sorted((str(i), int(c), int(d)) for (i, _), c, d in zip(kept, found, far.min(1))), centres


@pytest.mark.parametrize("clusters", [1, 3, 40])
def test_centroids_equal_brute_force(spark, clusters):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 3, (6, 64))
    rows = [(i, (centres[rng.integers(6)] + rng.normal(0, 0.3, 64)).tolist()) for i in range(400)]
    rows += [(7, rows[7][1])] * 150 + [(8, rows[9][1]), (None, rows[1][1]), (1_000, None), (1_001, [1.0] * 63), (1_002, [math.nan] * 64), (1_003, [math.inf] * 64),
                                      (1_004, [None] + [1.0] * 63), (1_005, [])]
    docs = spark.createDataFrame([(*r, 1, 1) for r in rows], "vec_id long, embedding array<double>, rid int, cluster int").repartition(3)
    scanned = []
    found, final = heap_centroids.heap_clusters(docs, clusters=clusters, scanned=scanned)
    want, centres = plain_clusters(rows, clusters)
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in found.collect()) == want and final.tolist() == centres
    assert scanned[0] == 552 and scanned[-1] < 552 // 2  # clusters stand far apart: settled vectors stay in the heaps


def test_centroids_of_few_vectors(spark):
    docs = spark.createDataFrame([(1, [0.5] * 64), (1, [0.5] * 64), (2, [-0.1] * 64)], "vec_id long, embedding array<float>")
    rows = heap_centroids.with_inertia(*heap_centroids.heap_clusters(docs)).collect()
    assert sorted((r.vec_id, r.distance, r.inertia) for r in rows) == [(1, 0, 0), (1, 0, 0), (2, 0, 0)] and len({r.cluster for r in rows}) == 2
    assert heap_centroids.with_inertia(*heap_centroids.heap_clusters(docs.limit(0))).count() == 0
