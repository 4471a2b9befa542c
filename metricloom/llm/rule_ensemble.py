"""Quality classifier: a sparse ensemble of rules.

Statistics of the text are column expressions. A small random forest on labelled rows gives paths; every path from a
root to a node is a conjunction of bounds on statistics, a rule. A logistic regression with an L1 penalty weighs the
rules and drops most of them. The remaining ones are compiled to one column expression, so scoring is a map over all
texts inside the JVM.

Scale: one pass over the texts writes their statistics (a narrow table); labels join that table. The model is fitted on
at most `MAX_ROWS` labelled rows, the ones with the least hash of their doc_id.

Defined results: null and blank texts have all statistics zero and a score like any other; null doc_ids are scored, are
not held out and teach nothing; labels that contradict each other count as 1; with fewer than two classes among the
labels the score is the share of ones (one half without labels); repeated rows give repeated rows; other columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from metricloom.llm.common import BLANK_CHARS, text_of, without, words_of
from metricloom.plans.workspace import materialize

MAX_ROWS, TREES, DEPTH, PENALTY, CUT, SEED = 20_000, 20, 3, 0.002, 0.3, 5
STATISTICS = (
    "words", "word_length", "symbols", "digits", "capitals", "stops", "letters", "distinct_words", "repeated_lines", "line_words",
)
Rule = tuple[tuple[str, float, float], ...]  # (statistic, above, up to)


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, statistics): counts and shares between 0 and 1, zero for a text without words."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("t"))
    rows = rows.withColumn("w", words_of(F.col("t"))).withColumn("l", F.split("t", "\n", -1))
    n, chars = F.size("w"), F.length(without(F.col("t"), BLANK_CHARS))
    count = lambda kind: chars - F.length(without(F.col("t"), BLANK_CHARS + kind))
    share = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    values = (
        F.log1p(n.cast("double")), share(chars, n), share(count("#*$%&|<>{}[]\\^~@_="), chars), share(count("0123456789"), chars),
        share(count("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), chars), share(count(".!?;:,"), chars),
        share(count("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"), chars), share(F.size(F.array_distinct("w")), n),
        share(F.size("l") - F.size(F.array_distinct("l")), F.size("l")), share(n, F.size("l")),
    )
    return rows.select("doc_id", *[v.cast("double").alias(s) for s, v in zip(STATISTICS, values)])


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _paths(node, names: tuple[str, ...], bounds: dict[str, tuple[float, float]]) -> list[Rule]:
    """Rules of all nodes below, from a fitted tree."""
    found = [tuple((s, *b) for s, b in sorted(bounds.items()))] if bounds else []
    if node.getClass().getSimpleName() == "InternalNode":
        name, at = names[node.split().featureIndex()], node.split().threshold()
        low, high = bounds.get(name, (float("-inf"), float("inf")))
        found += _paths(node.leftChild(), names, bounds | {name: (low, min(high, at))})
        found += _paths(node.rightChild(), names, bounds | {name: (max(low, at), high)})
    return found


def rule_column(rule: Rule) -> Column:
    tests = [F.col(s) > low for s, low, _ in rule if low > float("-inf")] + [F.col(s) <= high for s, _, high in rule if high < float("inf")]
    whole = tests[0]
    for t in tests[1:]:
        whole = whole & t
    return whole.cast("double")


def fit(sample: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> tuple[float, list[tuple[Rule, float]]]:
    """(constant, weighted rules) from rows with statistics and `y`, 0 or 1."""
    seen = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    if len(seen) < 2:
        return (0.0 if not seen else 20.0 if 1.0 in seen else -20.0), []
    rows = sample.select("y", array_to_vector(F.array(*STATISTICS)).alias("x"))
    forest = RandomForestClassifier(labelCol="y", featuresCol="x", numTrees=trees, maxDepth=depth, seed=SEED).fit(rows)
    rules = sorted({r for t in forest.trees for r in _paths(t._java_obj.rootNode(), STATISTICS, {})})
    if not rules:
        share = seen.get(1.0, 0) / sum(seen.values())
        return math.log(share / (1 - share)), []
    marked = sample.select("y", array_to_vector(F.array(*[rule_column(r) for r in rules])).alias("x"))
    lasso = LogisticRegression(labelCol="y", featuresCol="x", elasticNetParam=1.0, regParam=penalty, maxIter=100).fit(marked)
    return float(lasso.intercept), [(r, float(w)) for r, w in zip(rules, lasso.coefficients) if abs(w) > 1e-9]


def score_column(constant: float, rules: list[tuple[Rule, float]]) -> Column:
    total = F.lit(constant)
    for rule, weight in rules:
        total = total + rule_column(rule) * F.lit(weight)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def learn(stats: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> tuple[float, list[tuple[Rule, float]]]:
    """(constant, weighted rules) from the statistics of labelled rows that are not held out."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("d")).agg(F.max(label).cast("double").alias("y"))
    teach = stats.filter(~held_out()).join(known, F.col("doc_id") == F.col("d")).orderBy(F.xxhash64("doc_id"), "doc_id", *STATISTICS)
    return fit(materialize(teach.select("y", *STATISTICS).limit(max_rows), "sample"))


def scores(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    max_rows: int = MAX_ROWS, cut: float = CUT,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) per document; learned from labelled rows that are not held out."""
    stats = materialize(statistics(docs, doc_id, text), "statistics")
    score = score_column(*learn(stats, labels, label, max_rows))
    return stats.select("doc_id", held_out().alias("held_out"), score.alias("score")).withColumn("predicted", (F.col("score") >= cut).cast("int"))
