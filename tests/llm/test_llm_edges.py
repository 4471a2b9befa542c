"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest

import corpus_pipeline
from metricloom.llm import (
    chat_format, common, decontaminate, line_rules, mixture, page_extract, rule_ensemble, secret_scan, sentence_spans, simhash_blocks,
    substring_dedup,
)

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, d long, t string, h long, node long, fp long, "
    "component_id long, _row string, _t string, _first long, w string, budget long, start long, score double, id long"
)
LONG = "".join(f"Wort{i} steht hier, Satz {i % 97}. " for i in range(30_000))


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "t", 1, 1, 1, 1, "r", "t", 1, "w", 1, 1, 1.0, 1) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    text = " ".join(f"word{i}" for i in range(60)) + "."
    return rows_of(spark, [
        (1, text, "en", "a", 9), (1, text, "en", "a", 9), (2, text, None, None, None), (3, None, "de", "a", 0), (4, "", "de", None, 0),
        (None, text, None, "a", 1), (5, " \n\t ", "de", "a", 4), (6, LONG, "de", "src0", 7), (7, "token=abcdef12 one two", "en", "src1", 3),
    ])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(
        [(1, " ".join(f"word{i}" for i in range(20))), (2, None), (3, ""), (4, "too short"), (None, LONG[:300])], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (6, 0, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")


def test_line_rules(odd, none):
    out = {(r.doc_id, r.n_words): r for r in line_rules.rule_verdicts(odd).collect()}
    assert out[(3, 0)].base_failed and out[(4, 0)].base_failed and not out[(3, 0)].kept
    assert out[(1, 60)].kept and out[(None, 60)].kept and out[(6, 150_000)].n_repeat_words == 120_000  # all but "Wort..."
    kept = line_rules.apply_line_rules(odd)
    assert kept.columns == odd.columns and kept.count() == 4
    assert line_rules.rule_verdicts(none).count() == line_rules.apply_line_rules(none).count() == 0


def test_boilerplate_lines_go_and_depleted_documents_are_rejected(spark):
    line = "All rights reserved by the house number 7 and nobody else at all, as always."
    name = lambda n: "".join(chr(97 + int(c)) for c in str(n))  # noqa: E731  digits are all one after normalising
    body = lambda i: " ".join(f"w{name(i)}x{name(k)}" for k in range(60))
    rows = [(i, f"{body(i)}\n{line.upper() if i % 2 else line}", "en", "a", 1) for i in range(30)]
    rows += [(100, f"{line}\n" * 8, "en", "a", 1), (101, f"{body(101)}\n{line}", "en", "b", 1)]
    out = {r.doc_id: r for r in line_rules.apply_line_rules(rows_of(spark, rows), min_texts=20).collect()}
    assert 100 not in out and out[0].text == body(0) and out[101].text.endswith(line) and len(out) == 31


def test_simhash(odd, none):
    out = simhash_blocks.simhash_components(odd).collect()
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in out}
    assert len(out) == 9 and got[2][1] == got[None][1] == 1 and got[3] == got[4] == got[5] == ("0" * 16, 3)
    assert simhash_blocks.simhash_components(none).count() == 0


def test_decontamination(spark, odd, none, bench):
    out = {tuple(r) for r in decontaminate.contained_items(odd, bench).collect()}
    assert out == {(1, 1, 16, 16), (2, 1, 16, 16)}
    assert decontaminate.contained_items(none, bench).count() == 0
    assert decontaminate.contained_items(odd, bench.limit(0)).count() == 0


def test_secrets(odd, none):
    out = {r.doc_id: r for r in secret_scan.secret_spans(odd).collect()}
    assert out[7].spans == "assign:0:14" and out[3].spans == "" and out[6].spans == ""
    clean = {r.doc_id: r for r in secret_scan.redact(odd).collect()}
    assert clean[7].text == "[SECRET] one two" and clean[3].text is None and clean[7]._row == "r"
    assert secret_scan.secret_spans(none).count() == secret_scan.redact(none).count() == 0


def test_mixture(odd, none):
    out = mixture.mix(odd, percent=100).collect()
    tokens = sum(r.tokens for r in out)
    total = sum(len((r.text or "").split()) for r in odd.collect())
    assert 0 < tokens <= total and {r.source for r in out} <= {"a", "none", "src0", "src1"}
    assert mixture.mix(none).count() == 0


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame(
        [("x", "en", "a", 100), ("x", "en", "b", 1000), ("x", "de", "c", 1000), ("y", "en", "d", 5000)], "domain string, lang string, source string, tokens long")
    got = {r._source: r.budget for r in mixture.budgets(leaves, percent=20, epochs=1, weights={}).collect()}
    # 1420 in all: 710 each domain, 355 each language of x; a is short of 177 by 77, which b takes
    assert got == {"a": 100, "b": 255, "c": 355, "d": 710}


def test_substrings(odd, none):
    out = sorted(substring_dedup.remove_repeats(odd).collect(), key=lambda r: (r.doc_id or -1, r.n_bytes))
    got = {r.doc_id: r for r in out}
    assert got[1].n_removed == 0 and got[2].n_removed == got[2].n_bytes and got[None].n_removed == 0
    assert got[3].n_bytes == 0 and got[6].n_removed == 0 and len(out) == 9
    assert substring_dedup.remove_repeats(none).count() == 0


def test_sentences(odd, none):
    got = {r.doc_id: r for r in sentence_spans.remove_spans(odd).collect()}
    assert got[1].n_removed == 0 and got[2].text == "" and got[None].n_removed == 0 and got[3].text == "" and got[6].text == LONG
    assert sentence_spans.remove_spans(none).count() == 0


def test_quality(odd, none, labels):
    out = rule_ensemble.scores(odd, labels).collect()
    assert len(out) == 9 and all(0 <= r.score <= 1 for r in out)
    assert rule_ensemble.scores(none, labels).count() == 0
    assert {r.score for r in rule_ensemble.scores(odd, labels.limit(0)).collect()} == {0.5}


def test_pages(spark):
    pages = spark.createDataFrame([(1, None, None, 1), (2, "u", "", 2), (2, "u", "<p>x" * 30_000, 3), (None, "u", "<div" * 9, 4)], "page_id long, url string, html string, text int")
    got = {(r.page_id, len(r.text)) for r in page_extract.extract(pages).collect()}
    assert got == {(1, 0), (2, 0), (2, 59_999), (None, 0)}
    assert page_extract.extract(pages.limit(0)).count() == 0


def test_chats(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "b", 1), (1, 0, "user", "a", 1), (1, 0, "user", "a", 1), (2, None, None, None, 1), (None, 1, "assistant", LONG, 1)],
        "conv_id long, turn long, role string, text string, turns int")
    read = chat_format.read_back(chat_format.format_chat(chat_format.canonical_turns(turns)))
    got = {r.conv_id: r for r in read.collect()}
    assert [t.text for t in got[1].turns] == ["a", "a", "b"] and [tuple(t) for t in got[2].turns] == [("", "")]
    assert got[None].loss_text == LONG
    assert chat_format.digests(read.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, None), (2, [])], "id long, messages array<struct<role:string,content:string>>")
    assert {r.n_turns for r in chat_format.digests(chat_format.read_back(chat_format.format_chat(chat_format.canonical_turns(empty)))).collect()} == {0}


def test_stages(spark, odd, none):
    folder = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0, name
        out = stage(spark, odd, folder)
        assert stage is corpus_pipeline.weighted_mixture or out.columns == odd.columns, name
        out.collect()
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, odd, folder).collect()} == {1, 3, 6, 7, None}


def test_pipeline_equals_its_parts(spark):
    """Each stage beside DuckDB or brute force over what the stage before it kept."""
    import os
    import sys

    import duckdb

    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    import brute
    from metricloom.llm.oracle import SQL

    folder = "/root/testdata/sf0.001"
    docs, con = common.table(spark, folder, "documents"), duckdb.connect()
    con.execute(f"CREATE VIEW benchmark AS FROM read_parquet('{folder}/benchmark.parquet')")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.toPandas()
        con.register("documents", before)
        docs = spark.createDataFrame(stage(spark, docs, folder).toPandas())
        ids = sorted(r.doc_id for r in docs.collect())
        if name == "quality_rules":
            want = con.sql(f"SELECT doc_id FROM ({SQL['op4_line_frequency']}) WHERE kept").df().doc_id
        elif name == "simhash":
            want = [d for d, _, root in brute.simhash_rows(list(zip(before.doc_id, before.text))) if d == root]
        elif name == "decontamination":
            want = con.sql(f"SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM ({SQL['op3_containment']}))").df().doc_id
        elif name == "secrets":
            want = before.doc_id
            assert all(brute.secrets(r.text)[0] == (0, 0, 0) for r in docs.collect())
        else:
            want = con.sql(f"SELECT doc_id FROM ({SQL['op8_mixture']})").df().doc_id
        assert ids == sorted(want), name
    whole = corpus_pipeline.run(spark, folder)
    assert sorted((r.doc_id, r.epoch) for r in whole.collect()) == sorted((r.doc_id, r.epoch) for r in docs.collect())
