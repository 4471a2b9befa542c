"""Benchmark decontamination: MinHash containment search for short items inside long documents.

Texts become sets of five-word shingles (lower case, runs of letters and digits); an item of one to four words has one
shingle, all its words, and is asked of the documents' windows of that length. An item of m shingles is contained in
a document if at least `threshold` of them stand there. Items are partitioned by size into classes of one power of two.
Each class keeps the s smallest MinHash values of an item, where s is one more than the number of shingles that the
largest item of the class may lack; so at least one of them stands in every document that contains the item, however
long the document is, and no containing document is missed. (Min-wise values of the long documents would be lost among
their thousands of shingles, so the search asks for the item's values instead of comparing signatures of both sides.)
Candidates are then verified by exact containment of the shingles themselves.

Scale: the documents' shingle hashes stream past the distinct sketch values without a shuffle; only hits move, and the
items that have a value join the hits afterwards. Sketch values are broadcast only after their rows were counted and
bytes measured, else the hashes are shuffled. A value that stands in very many documents is one row of the sketch, so
it makes no hot task under the broadcast. Windows of fewer than five words are hashed only for lengths that items have.

Defined results: null and blank texts hold no shingle, and such items are never found; rows with a null doc_id or item_id are not searched; repeated rows give one result row with the larger containment; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from metricloom.llm.common import bounded_broadcast, text_of, window_hashes
from metricloom.plans.workspace import materialize

SHINGLE_WORDS, THRESHOLD_PERCENT = 5, 80
NOT_WORD = r"[^\p{L}\p{N}]+"


def plain_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), NOT_WORD, -1), "")


def shingle_texts(words: Column, size: int) -> Column:
    """Distinct shingles as text; `words` must be a plain column."""
    return F.array_distinct(
        F.transform(
            F.sequence(F.lit(0), F.size(words) - size),
            lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(size)]),
        )
    )


def _by_length(words: Column, size: int, made) -> Column:
    """`made(words, length)` for shingles of `size` words, or of all words where there are fewer."""
    picked = F.when(F.size(words) >= size, made(words, size))
    for k in range(1, size):
        picked = picked.when(F.size(words) == k, made(words, k))
    return picked


def sketch_items(items: DataFrame, item_id: str, text: str, size: int, percent: int) -> DataFrame:
    """(item_id, length, shingles, m, sketch) of the items that have a word; `length` is the words of a shingle."""
    rows = items.select(F.col(item_id).cast("long").alias("item_id"), plain_words(text_of(text)).alias("w"))
    rows = rows.filter(F.col("item_id").isNotNull() & (F.size("w") > 0))
    w = F.col("w")
    rows = rows.select(
        "item_id", F.least(F.size(w), F.lit(size)).alias("length"), _by_length(w, size, shingle_texts).alias("shingles"),
        _by_length(w, size, window_hashes).alias("h"),
    )
    rows = rows.withColumn("m", F.size("shingles"))
    largest = F.pow(F.lit(2), F.ceil(F.log2("m"))).cast("int")  # of the item's size class
    depth = F.expr("upper") - F.ceil(F.col("upper") * percent / 100).cast("int") + 1
    order = F.sort_array(F.transform(F.array_distinct("h"), lambda h: F.struct(F.xxhash64(h).alias("v"), h.alias("h"))))
    return rows.withColumn("upper", largest).withColumn("order", order).select(
        "item_id", "length", "shingles", "m", F.transform(F.slice("order", 1, depth), lambda x: x["h"]).alias("sketch")
    )


def contained_items(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", size: int = SHINGLE_WORDS, percent: int = THRESHOLD_PERCENT,
) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared) for every item contained in a document."""
    sketched = materialize(sketch_items(items, item_id, item_text, size, percent), "sketch")
    values = materialize(sketched.select("item_id", F.explode("sketch").alias("v")).distinct(), "values")
    wanted = materialize(values.select("v").distinct(), "wanted")
    lengths = [r.length for r in sketched.select("length").distinct().collect()] or [size]  # `size` numbers at most
    rows = docs.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("t"))
    hashes = rows.withColumn("w", plain_words(F.col("t"))).select(
        "doc_id", F.explode(F.concat(*[window_hashes(F.col("w"), k) for k in lengths])).alias("h")
    )
    hits = hashes.join(bounded_broadcast(wanted), F.col("h") == F.col("v")).select("doc_id", "h").distinct()
    pairs = hits.join(bounded_broadcast(values), F.col("h") == F.col("v")).select(F.col("doc_id").alias("d"), "item_id").distinct()
    found = materialize(pairs.groupBy("d").agg(F.collect_list("item_id").alias("found")), "candidates")
    texts = rows.join(bounded_broadcast(found), F.col("doc_id") == F.col("d")).withColumn("w", plain_words(F.col("t")))
    has = F.concat(*[F.when(F.size("w") >= k, shingle_texts(F.col("w"), k)).otherwise(F.array()) for k in lengths])
    texts = texts.select("doc_id", "found", has.alias("has"))
    items_of = bounded_broadcast(sketched.select(F.col("item_id").alias("item"), "shingles", "m"))
    pairs = texts.select("doc_id", "has", F.explode("found").alias("item_id")).join(items_of, F.col("item_id") == F.col("item"))
    shared = pairs.select("doc_id", "item_id", F.col("m").cast("long").alias("n_shingles"),
                          F.size(F.array_intersect("shingles", "has")).cast("long").alias("n_shared"))
    return shared.filter(F.col("n_shared") * 100 >= F.col("n_shingles") * percent).groupBy("doc_id", "item_id").agg(
        F.max("n_shingles").alias("n_shingles"), F.max("n_shared").alias("n_shared")
    )
