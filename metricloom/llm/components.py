"""Connected components of a link table, by rounds of joins; no links or labels reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from metricloom.plans.workspace import materialize


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root): for every node with a smaller node in its component, the smallest one.

    `links` has the long columns a > b. Each round hangs the smaller neighbours of a node under the smallest of them
    and then moves every link from its end to that end's own smallest neighbour. Both keep components as they are; the
    rounds end when nothing moves, after about the logarithm of the longest path.
    """
    links = materialize(links.select("a", "b").distinct(), "links")
    seen = _signature(links)
    while True:
        least = F.min("b").over(Window.partitionBy("a"))
        stars = links.select("a", "b", least.alias("m")).select(
            F.explode(
                F.array(
                    F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                )
            ).alias("l")
        ).select("l.a", "l.b").filter("a > b").distinct()
        parents = stars.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("p"))
        moved = stars.join(parents, F.col("b") == F.col("n"), "left")
        links = materialize(moved.select("a", F.coalesce("p", "b").alias("b")).distinct(), "links")
        now = _signature(links)
        if now == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
