"""Mixing sources to target weights: hierarchical budgets over a domain, language and source tree.

A leaf can give at most `epochs` times its tokens, and a node what its leaves can give. From the root down, a node's
budget is shared among its children in proportion to their weights; a child that cannot fill its share gives all it has,
and its shortage goes to its siblings first. Only what a whole subtree cannot give reaches the siblings of its
ancestor. A leaf takes whole epochs of its documents and then the token prefix of one more, in an order seeded by epoch:
documents ascend by MD5 of seed, epoch and doc_id, and are taken while their running sum fits.

Scale: budgets work on one row per leaf. The running sum of a leaf is never one task: documents fall into 4,096 buckets
by the head of their MD5, bucket sums give the bucket in which the budget ends, and only that bucket is sorted.
So a leaf that holds a third of all rows is spread over its buckets. Siblings are shared out by a window over their
parent, a row each: thousands of sources per domain and language, not one per web host.

Defined results: null domains, languages and sources are the name 'none'; null and blank texts have no tokens and come
along with the document before them in order; a leaf without tokens gives nothing; the order of repeated rows with one
doc_id is theirs by text hash; exact twins come in any order, which changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from metricloom.llm.common import bounded_broadcast, text_of, words_of
from metricloom.plans.workspace import materialize

LEVELS = ("domain", "lang", "source")
EPOCHS, SEED, BUDGET_PERCENT, BUCKET_DIGITS = 2, 17, 60, 3
# Fixed values of the production mixture: a name that is not listed weighs 1.
WEIGHTS = {"domain": {"crawl": 2, "curated": 3}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}, "source": {"src1": 2, "src2": 2}}
DOMAINS = {"crawl": ("src0", "src1", "src2", "src3", "src4", "src5", "src6", "src7")}
OTHER_DOMAIN = "curated"


def domain_of(source: Column, domains: dict[str, tuple[str, ...]] = DOMAINS, other: str = OTHER_DOMAIN) -> Column:
    """The first domain that lists the source; `other` for sources that none lists."""
    return F.coalesce(*[F.when(source.isin(*names), name) for name, names in domains.items()], F.lit(other))


def weight_of(level: str, weights: dict[str, dict[str, int]]) -> Column:
    pairs = [F.when(F.col(level) == name, w) for name, w in weights.get(level, {}).items()]
    return F.coalesce(*pairs, F.lit(1)).cast("long")


def share_out(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Adds `budget` to sibling nodes (capacity, weight, given) that split `given`; nodes of one parent share it.

    In the order of capacity per weight, what is left per weight that is left rises from child to child while children
    fall short of it and falls from the first one that does not: its maximum is the level up to which all are filled.
    """
    order = Window.partitionBy(*parent).orderBy((F.col("capacity") / F.col("weight")), "capacity", "weight", "name")
    before, from_here = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("given") - F.coalesce(F.sum("capacity").over(before), F.lit(0))) / F.sum("weight").over(from_here)
    return nodes.withColumn("_level", level).withColumn(
        "budget",
        F.least(F.col("capacity"), F.floor(F.max("_level").over(Window.partitionBy(*parent)) * F.col("weight"))).cast("long"),
    ).drop("_level")


def budgets(leaves: DataFrame, percent: int = BUDGET_PERCENT, epochs: int = EPOCHS, weights: dict = WEIGHTS) -> DataFrame:
    """Leaf rows (levels, tokens) with their `budget`."""
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    given = F.lit(total * percent // 100).cast("long")
    path: list[str] = []
    for level in LEVELS:
        here = leaves.groupBy(*path, level).agg((F.sum("tokens") * epochs).alias("capacity"))
        here = here.withColumn("weight", weight_of(level, weights)).withColumn("name", F.col(level))
        if path:
            above = given.select(*[F.col(c).alias(f"_{c}") for c in path], "given")
            here = here.join(above, [F.col(c) == F.col(f"_{c}") for c in path]).drop(*[f"_{c}" for c in path])
        else:
            here = here.withColumn("given", given)
        shared = share_out(here, path)
        path.append(level)
        given = shared.select(*path, F.col("budget").alias("given"))
    return given.select(*[F.col(c).alias(f"_{c}") for c in LEVELS], F.col("given").alias("budget"))


def epoch_key(epoch: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.col("doc_id").cast("string")).cast("binary"))


def mix_rows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
    percent: int = BUDGET_PERCENT, epochs: int = EPOCHS, weights: dict = WEIGHTS, seed: int = SEED,
    domains: dict[str, tuple[str, ...]] = DOMAINS, other: str = OTHER_DOMAIN,
) -> DataFrame:
    """(doc_id, domain, lang, source, tokens, epoch, twin) per document in the mixture and epoch; `twin` hashes the text."""
    name = lambda c: F.coalesce(F.col(c), F.lit("none"))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), domain_of(name(source), domains, other).alias("domain"), name(lang).alias("lang"),
        name(source).alias("source"), F.size(words_of(text_of(text))).cast("long").alias("tokens"), F.xxhash64(text_of(text)).alias("twin"),
    )
    rows = materialize(rows, "tokens")
    leaves = materialize(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")).filter("tokens > 0"), "leaves")
    plan = leaves.join(budgets(leaves, percent, epochs, weights), [F.col(c) == F.col(f"_{c}") for c in LEVELS])
    plan = plan.select(
        *[F.col(c).alias(f"_{c}") for c in LEVELS],
        F.floor(F.col("budget") / F.col("tokens")).cast("long").alias("whole"),
        (F.col("budget") % F.col("tokens")).alias("rest"),
    )
    plan = materialize(plan.filter("whole > 0 OR rest > 0"), "budgets")
    planned = rows.join(bounded_broadcast(plan), [F.col(c) == F.col(f"_{c}") for c in LEVELS]).drop(*[f"_{c}" for c in LEVELS])
    planned = planned.withColumn("key", epoch_key(F.col("whole") + 1, seed)).withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    columns = ["doc_id", *LEVELS, "tokens", "twin"]
    full = planned.filter("whole > 0").select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("whole"))).alias("epoch"))
    sums = planned.groupBy(*LEVELS, "bucket").agg(F.sum("tokens").alias("t"), F.first("rest").alias("rest_"))
    running = Window.partitionBy(*LEVELS).orderBy("bucket")
    ends = sums.select(
        *[F.col(c).alias(f"_{c}") for c in LEVELS], F.col("bucket").alias("bucket_"),
        F.coalesce(F.sum("t").over(running.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), "t", "rest_",
    ).filter("before <= rest_ AND rest_ > 0")
    part = planned.join(ends, [*[F.col(c) == F.col(f"_{c}") for c in LEVELS], F.col("bucket") == F.col("bucket_")])
    part = part.withColumn("epoch", F.col("whole") + 1)
    inside = part.filter("before + t <= rest_").select(*columns, "epoch")
    so_far = F.sum("tokens").over(Window.partitionBy(*LEVELS, "bucket").orderBy("key", "twin").rowsBetween(Window.unboundedPreceding, 0))
    last = part.filter("before + t > rest_").withColumn("so_far", F.col("before") + so_far).filter("so_far <= rest_").select(*columns, "epoch")
    return full.unionByName(inside).unionByName(last)


def mix(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, domain, lang, source, tokens, epoch) of every document in the mixture, once per epoch."""
    return mix_rows(docs, **options).drop("twin")
