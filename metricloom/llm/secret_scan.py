"""Secret scans: patterns for known forms, and character Markov models for the rest.

Two first-order models over printable ASCII are trained from labelled samples: the values that the patterns matched in
the whole corpus are random strings, and the words and numbers of `MIN_TOKEN` characters or more in texts that no pattern
touches are ordinary identifiers. A pair that follows a rare character falls back on the frequency of its second character, and
that on a uniform one, so the random model is uniform where no pattern matched. A token is secret if its mean log-likelihood
ratio per pair exceeds `threshold` bits, or `lone` bits where it has no digit or no letter and so tells less.

Everything is built from column expressions. Positions come from the pieces between matches: `split` and
`regexp_extract_all` with one pattern give text, match, text, match, ... and running lengths give code-point offsets.

Scale: training counts pairs of characters per task before the shuffle (9,216 pairs and two labels at most), so the
table that reaches the driver has a fixed bound; scanning is one pass without a shuffle.

Defined results: a null text is an empty one without spans; a repeated row repeats its spans; other columns are ignored
by `secret_spans` and kept by `redact`.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from metricloom.llm.common import text_of

# The forms to find, by kind in the order of ties.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
MIN_VALUE = 6
TOKEN = r"[A-Za-z0-9+/_-]{16,}"
TOKEN_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
MIN_TOKEN, THRESHOLD_BITS, LONE_BITS, PRIOR = 8, 0.5, 1.0, 20
BLOCK = 64  # elements per step of a running value
_FIRST, _SYMBOLS = 32, 96


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _cut(values: Column, block: int = BLOCK) -> Column:
    """The array as arrays of `block` elements."""
    last = F.floor((F.greatest(F.size(values), F.lit(1)) - 1) / block).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(values, c * block + 1, block))


def before(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each int of an array the merged ints before it, 0 for the first; `merge` is associative.

    An aggregate that appends to an array copies it at every step, so blocks are merged by themselves and moved by what
    lies before them: the cost stays near linear.
    """
    start = lambda: F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out"))
    walk = lambda some, at: F.aggregate(
        some, start(), lambda s, x: F.struct(merge(s["at"], at(x)).cast("int").alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))
    )
    blocks = lambda v: F.transform(_cut(v), lambda some: walk(some, lambda x: x))
    moved = lambda done: F.flatten(
        F.zip_with(done, walk(done, lambda d: d["at"])["out"], lambda d, first: F.transform(d["out"], lambda x: merge(first, x).cast("int")))
    )
    return _with(values, lambda v: _with(blocks(v), moved))


def located(text: Column, pattern: str) -> Column:
    """Matches in order as structs (start, end, value), offsets in code points."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")

    def placed(x: Column) -> Column:
        gaps = F.transform(F.slice(x["between"], 1, F.size(x["found"])), lambda g: F.length(g))
        sizes = F.zip_with(gaps, x["found"], lambda g, hit: g + F.length(hit))
        rows = F.arrays_zip(gaps.alias("gap"), x["found"].alias("hit"), before(sizes, lambda a, b: a + b).alias("at"))
        return F.transform(rows, lambda r: F.struct(
            (r["at"] + r["gap"]).alias("start"), (r["at"] + r["gap"] + F.length(r["hit"])).alias("end"), r["hit"].alias("value")
        ))

    spans = _with(F.struct(between.alias("between"), found.alias("found")), placed)
    return F.when(text.rlike(pattern), spans).otherwise(empty)


def _base(rows: DataFrame) -> DataFrame:
    """Adds the arrays `_assign`, `_access` and `_hex` for the text in `_t`."""
    t = F.col("_t")
    empty = F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")
    value = lambda x: F.regexp_extract(x["value"], ASSIGN, 2)
    rows = rows.withColumns({
        "_assign": F.when(t.rlike(ASSIGN), located(t, ASSIGN)).otherwise(empty),
        "_access": F.when(t.contains("AKIA"), located(t, ACCESS)).otherwise(empty),
        "_hex": F.when(t.rlike(HEX), located(t, HEX)).otherwise(empty),
    })
    return rows.withColumn("_assign", F.filter("_assign", lambda x: F.length(value(x)) >= MIN_VALUE))


def _codes(token: Column) -> Column:
    """Printable ASCII characters as numbers from 0."""
    return F.transform(F.split(token, ""), lambda c: F.ascii(c) - _FIRST)


def train_models(docs: DataFrame, text: str = "text") -> list[float]:
    """Log2 ratios of pair probabilities, random over ordinary, as a flat table of 96 x 96."""
    rows = _base(docs.select(text_of(text).alias("_t")))
    values = F.concat(
        F.transform("_assign", lambda x: F.regexp_extract(x["value"], ASSIGN, 2)),
        F.transform("_access", lambda x: x["value"]), F.transform("_hex", lambda x: x["value"]),
    )
    marked = F.size("_assign") + F.size("_access") + F.size("_hex") > 0
    words = F.filter(
        F.regexp_extract_all(F.col("_t"), F.lit(r"[A-Za-z0-9+/_-]{%d,}" % MIN_TOKEN), F.lit(0)),
        lambda w: ~w.rlike("[0-9]") | ~w.rlike("[A-Za-z]"),
    )
    samples = rows.select(
        F.explode(
            F.concat(
                F.transform(F.when(marked, values).otherwise(F.array()), lambda v: F.struct(F.lit(1).alias("y"), v.alias("v"))),
                F.transform(F.when(~marked, words).otherwise(F.array()), lambda v: F.struct(F.lit(0).alias("y"), v.alias("v"))),
            )
        ).alias("s")
    ).groupBy("s.y", "s.v").agg(F.count(F.lit(1)).alias("n"))
    pairs = samples.withColumn("c", _codes(F.col("v"))).select(
        "y", "n", F.explode(F.transform(F.slice("c", 1, F.size("c") - 1), lambda a, i: a * _SYMBOLS + F.get("c", i + 1))).alias("p")
    )
    size = _SYMBOLS * _SYMBOLS
    counts = {0: [0.0] * size, 1: [0.0] * size}
    for y, p, n in pairs.filter(F.col("p").between(0, size - 1)).groupBy("y", "p").agg(F.sum("n")).collect():
        counts[y][p] += n
    ordinary, random = _smoothed(counts[0], range(_SYMBOLS)), _smoothed(counts[1], [ord(c) - _FIRST for c in TOKEN_CHARS])
    return [round(math.log2(r / o), 4) for r, o in zip(random, ordinary)]


def _smoothed(counts: list[float], alphabet) -> list[float]:
    """Pair probabilities; rare first characters fall back on the frequency of the second, that on `alphabet`."""
    second = [sum(counts[b::_SYMBOLS]) + (PRIOR if b in set(alphabet) else 1) for b in range(_SYMBOLS)]
    out = []
    for a in range(_SYMBOLS):
        row = counts[a * _SYMBOLS : (a + 1) * _SYMBOLS]
        out += [(n + PRIOR * s / sum(second)) / (sum(row) + PRIOR) for n, s in zip(row, second)]
    return out


def token_score(token: Column, table: Column) -> Column:
    """Mean log-likelihood ratio per pair of characters, in bits."""
    codes = _codes(token)
    total = F.aggregate(
        codes,
        F.struct(F.lit(0.0).alias("sum"), F.lit(-1).alias("last")),
        lambda s, c: F.struct(
            (s["sum"] + F.when(s["last"] < 0, 0.0).otherwise(F.get(table, s["last"] * _SYMBOLS + c))).alias("sum"), c.alias("last")
        ),
    )["sum"]
    return total / (F.length(token) - 1)


def scan(
    docs: DataFrame, ratios: list[float], text: str = "text", threshold: float = THRESHOLD_BITS, lone: float = LONE_BITS
) -> DataFrame:
    """The input's rows as the struct `_row`, the text `_t` and `_spans` (start, kind number, end) in order."""
    rows = _base(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), text_of(text).alias("_t")))
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")  # folded to one constant
    tokens = F.filter(
        located(F.col("_t"), TOKEN),
        lambda x: token_score(x["value"], table)
        > F.when(x["value"].rlike("[0-9]") & x["value"].rlike("[A-Za-z]"), F.lit(threshold)).otherwise(F.lit(lone)),
    )
    rows = rows.withColumn("_markov", tokens)
    span = lambda k: lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("kind"), x["end"].alias("end"))
    return rows.withColumn(
        "_spans", F.sort_array(F.concat(*[F.transform(f"_{kind}", span(k)) for k, kind in enumerate(KINDS)]))
    )


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD_BITS) -> DataFrame:
    """One row per document: counts of the base kinds, a digest of their spans, and all spans."""
    found = scan(docs, train_models(docs, text), text, threshold)
    count = lambda k: F.size(f"_{k}").cast("long").alias(f"n_{k}")
    return found.select(
        F.col(f"_row.`{doc_id}`").alias("doc_id"), count("assign"), count("access"), count("hex"), count("markov"),
        F.sha2(_listed(F.filter("_spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"), _listed(F.col("_spans")).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD_BITS, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span, overlapping ones merged, replaced by `mark`; a null text stays null."""
    found = scan(docs, train_models(docs, text), text, threshold)
    t = F.col("_t")
    ends = F.transform("_spans", lambda x: x["end"])
    found = found.withColumn("_covered", before(ends, lambda a, b: F.greatest(a, b)))  # text up to here is dealt with
    spans = F.zip_with("_spans", "_covered", lambda x, c: F.struct(c.alias("from"), x["start"].alias("start"), x["end"].alias("end")))
    found = found.withColumn("_blocks", _cut(spans))

    def pieces(block: Column) -> Column:
        """The text before each span and its mark; cut from the block's part of the text, as cutting counts from its start."""
        first = F.get(block, F.lit(0))["from"]
        last = F.array_max(F.transform(block, lambda x: x["start"]))
        return _with(F.substring(t, first + 1, F.greatest(last - first, F.lit(0))), lambda part: F.array_join(F.transform(
            block, lambda x: F.when(x["start"] >= x["from"], F.concat(F.substring(part, x["from"] - first + 1, x["start"] - x["from"]), F.lit(mark))).otherwise("")
        ), ""))

    rest = F.array_max(F.transform("_spans", lambda x: x["end"]))
    clean = F.concat(F.array_join(F.transform("_blocks", pieces), ""), F.substring(t, rest + 1, F.length(t)))
    changed = F.when(F.size("_spans") > 0, clean).otherwise(F.col(f"_row.`{text}`"))
    return found.select(*[(changed if c == text else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
