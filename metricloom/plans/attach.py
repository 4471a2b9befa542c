"""Joins that put a per-group table back on rows without a hot join key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

from metricloom.plans.workspace import materialize

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
HOT_GROUPS = 10_000
SPREAD = 4_096


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi-join where null matches null; the right copies of the join columns are dropped."""
    renamed = right.select(
        *[F.col(c).alias(f"_on_{c}") for c in on], *[c for c in right.columns if c not in on]
    )
    match = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on]
    )
    return left.join(renamed, match, how).drop(*[f"_on_{c}" for c in on])


def row_hash(rows: DataFrame) -> Column:
    """Hash of all columns of a row (maps, which have no hash, left out)."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in rows.schema.fields if "map<" not in f.dataType.simpleString()])


def _held_bytes(c: Column, kind: DataType) -> Column:
    """Bytes that a value takes in memory: its content and eight for itself."""
    own = F.lit(8)
    if isinstance(kind, (StringType, BinaryType)):
        content = F.octet_length(c)
    elif isinstance(kind, ArrayType):
        content = F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + _held_bytes(x, kind.elementType))
    elif isinstance(kind, MapType):
        content = _held_bytes(F.map_entries(c), ArrayType(StructType().add("key", kind.keyType).add("value", kind.valueType)))
    elif isinstance(kind, StructType):
        content = reduce(lambda a, b: a + b, [_held_bytes(c[f.name], f.dataType) for f in kind.fields], F.lit(0))
    else:
        return own.cast("long")
    return (own + F.coalesce(content, F.lit(0))).cast("long")


def measured(table: DataFrame) -> tuple[int, int]:
    """Rows of a written table and the bytes they take in memory, in one pass over it."""
    width = reduce(lambda a, b: a + b, [_held_bytes(F.col(f"`{f.name}`"), f.dataType) for f in table.schema.fields], F.lit(16))
    return tuple(table.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first())


def join_side(table: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """The table with a broadcast hint if it has at most `rows` rows and `size` bytes, and whether it has.

    Spark judges a written table by its compressed files, so one beyond `size` is hinted to be sorted and merged.
    """
    n, held = measured(table)
    if n <= rows and held <= size:
        return F.broadcast(table), True
    return (table.hint("merge") if held > size else table), False


def attach(
    rows: DataFrame,
    table: DataFrame,
    on: list[str],
    weight: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    written: bool = False,
    spread: Column | None = None,
) -> DataFrame:
    """Left-join `table` (unique on `on`) to `rows`.

    Up to `broadcast_rows` counted rows and BROADCAST_BYTES measured bytes, the table is broadcast. Beyond that, `weight` (rows per
    group) singles out the groups holding more than 1/HOT_GROUPS of all rows: there can be at most
    HOT_GROUPS of them, and they are broadcast while their bytes fit; only the other groups are shuffled by `on`.
    Rows that found a hot group get a salt, which spreads them over all join tasks; they match
    nothing there and pass through. The salt hashes the row's own columns (or `spread`), so a task
    that runs again sends its rows to the same places.
    """
    if not written:
        table = materialize(table, "attach")
    side, small = join_side(table, broadcast_rows)
    if small or weight is None:
        return null_safe_join(rows, side, on)

    added = [c for c in table.columns if c not in on]
    total = table.agg(F.sum(weight)).first()[0]
    hot_from = max(total // HOT_GROUPS, 1)
    is_hot = F.coalesce(F.col(weight) > hot_from, F.lit(False))
    hot = table.filter(is_hot).select(
        *on, F.struct(*added).alias("_hot"), F.lit(1).alias("_in_hot")
    )
    cold = table.filter(~is_hot).select(
        *on, F.struct(*added).alias("_cold"), F.lit(0).alias("_salt")
    )
    hot, small = join_side(hot, HOT_GROUPS)
    if not small:
        return null_safe_join(rows, side, on)  # wide rows: the skew join of adaptive execution spreads hot groups
    marked = null_safe_join(rows, hot, on)
    salt = F.xxhash64(spread) if spread is not None else row_hash(rows)
    marked = marked.withColumn(
        "_salt",
        F.when(F.col("_in_hot") == 1, 1 + F.pmod(salt, F.lit(SPREAD)))
        .otherwise(0).cast("int"),
    )
    joined = null_safe_join(marked, cold, [*on, "_salt"])
    return joined.select(
        *rows.columns,
        *[
            F.when(F.col("_in_hot") == 1, F.col(f"_hot.{c}")).otherwise(F.col(f"_cold.{c}")).alias(c)
            for c in added
        ],
    )
