"""Cases where an operator once did less than its whole job."""

import random

import brute
import numpy as np
from metricloom.llm import common, sentence_spans, substring_dedup
from metricloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def extended_rows(rows, span, min_words):
    """{doc_id: (sentences, removed, kept sentences)} by all minimal runs, for unique ids."""
    plain = {d: [" ".join(p.lower().split()) for p in sentence_spans.sentences(t)] for d, t in rows}
    seen, gone = {}, {d: set() for d, _ in rows}
    for d, _ in sorted(rows):
        p, enough = plain[d], lambda a, b: b - a >= span and sum(len(x.split()) for x in plain[d][a:b]) >= min_words
        total = sum(len(x.split()) for x in p)
        runs = [(a, b) for a in range(len(p)) for b in range(a + 1, min(len(p), a + max(span, min_words) + 1) + 1)
                if enough(a, b) and not (enough(a + 1, b) and enough(a, b - 1))]
        if total < min_words or len(p) < span:
            runs = [(0, len(p))] if total else []
        for a, b in runs:
            run = (total < min_words, *p[a:b])
            if run in seen and seen[run] != (d, a):
                gone[d] |= set(range(a, b))
            seen.setdefault(run, (d, a))
    return {d: (len(p), len(gone[d]), [x for i, x in enumerate(p) if i not in gone[d]]) for d, p in plain.items()}


def test_runs_of_short_sentences_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in common.table(spark, FOLDER, "documents").collect()]
    rng = random.Random(3)
    line = lambda: " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4)))
    rows += [(10_000 + i, "\n".join(line() for _ in range(rng.randint(0, 12)))) for i in range(200)]
    out = sentence_spans.remove_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), extend=True).collect()
    want = extended_rows(rows, sentence_spans.SPAN, sentence_spans.MIN_WORDS)
    assert {r.doc_id: (r.n_sentences, r.n_removed) for r in out} == {d: v[:2] for d, v in want.items()}
    assert {r.doc_id: " ".join(r.text.lower().split()) for r in out} == {d: " ".join(v[2]).strip() for d, v in want.items()}


def test_copies_of_short_lines_go(spark, tmp_path):
    lines = [f"Item {k}." for k in range(60)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(lines)), (3, "Own words.\n" + "\n".join(lines[20:40]) + "\nOther words."), (4, "Click here."),
            (5, "Click here."), (6, "Click here.\nNothing else."), (7, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_removed, r.text) for r in QUERIES["op2_sentence_spans"](spark, str(tmp_path)).collect()}
    assert got == {1: (0, rows[0][1]), 2: (60, ""), 3: (20, "Own words.\nOther words."), 4: (0, "Click here."), 5: (1, ""), 6: (0, rows[5][1]), 7: (0, "")}


def test_runs_over_the_edges_of_a_common_passage_are_dealt_out(spark):
    rng = random.Random(11)
    own = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(60))
    passage = "Permission is hereby granted to any person who obtains a copy."
    rows = [(d, own() + passage + own()) for d in range(800)] + [(d, own()) for d in range(800, 900)]
    rows += [(1_000, rows[5][1][30:150]), (1_001, rows[7][1][:100]), (1_002, "x" * 120), (1_003, "x" * 130)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)

    def largest(hot_bytes):
        held = {}
        packed = substring_dedup.packed_runs(docs, "doc_id", "text", shard_bytes=4096, hot_bytes=hot_bytes, sample=1)
        for r in packed.filter("blob IS NOT NULL").collect():
            held[r.shard] = held.get(r.shard, 0) + len(substring_dedup._unpack(r.blob)[4])
        return max(held.values()) / np.mean(list(held.values()))

    assert largest(1 << 40) > 4 > 2 > largest(None)
    out = substring_dedup.remove_repeats(docs, shard_bytes=4096, sample=1).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in out} == {d: v[:3] for d, v in brute.substrings(rows).items()}
