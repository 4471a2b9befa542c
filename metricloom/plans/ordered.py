"""Series laid out in order over many tasks.

A plain window partitioned by series puts a whole series in one task. Here Spark's range
partitioner splits the sorted rows of all series into even parts, whatever the size of one series
or one instant, and the parts are written once. Three things follow from the written table:

* row numbers per series, from one small row per (series, part);
* running sums, extremes and last values: a window inside each part plus a carry per part;
* bounded frames: rows are dealt into chunks by row number, with the halo each frame needs.

Only series that span parts, or more than one chunk, need anything from other parts. A part has at most two series that
it shares with its neighbours, so what they need is a table of a few rows per part. Up to FEW_PARTS parts it is
broadcast as it is, beyond that after it was written and measured. Rows of all other series keep their place in the part
as position. Rows therefore move once, for the window, however many series there are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window, functions as F

from metricloom.plans.attach import join_side, null_safe_join, row_hash
from metricloom.plans.workspace import input_bytes, materialize

PART, IDX, RN, ROWS, CHUNK, HOME = "_part", "_idx", "_rn", "_rows", "_chunk", "_home"
CHUNK_ROWS = 16_384
FEW_PARTS = 10_000
_PART_BITS = 33


@dataclass(frozen=True)
class Ordered:
    """`rows` carry `_part` and `_idx`; (part, idx) ascends in (keys, order)."""

    rows: DataFrame
    keys: tuple[str, ...]
    base: "Ordered | None" = None

    @cached_property
    def n_parts(self) -> int:
        """Parts at most: a part is one file at least."""
        return self.base.n_parts if self.base is not None else len(self.rows.inputFiles())

    def _side(self, few: DataFrame, label: str) -> DataFrame:
        """A table of a few rows per part as the side of a join."""
        return F.broadcast(few) if self.n_parts <= FEW_PARTS else join_side(materialize(few, label))[0]

    @cached_property
    def index(self) -> DataFrame:
        """One written row per (series, part): first position, rows before this part, rows in all."""
        return self.base.index if self.base is not None else materialize(self._index(), "index")

    def _index(self) -> DataFrame:
        if self.base is not None:
            return self.base._index()
        per_part = self.rows.groupBy(*self.keys, PART).agg(
            F.count(F.lit(1)).alias("_here"), F.min(IDX).alias("_first")
        )
        series = Window.partitionBy(*self.keys)
        before = series.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
        return (
            per_part.withColumn("_before", F.coalesce(F.sum("_here").over(before), F.lit(0)))
            .withColumn(ROWS, F.sum("_here").over(series))
            .withColumn("_parts", F.count(F.lit(1)).over(series))
        )

    def with_rows(self, rows: DataFrame) -> "Ordered":
        """The same rows with more columns; positions and index stay valid."""
        return Ordered(rows, self.keys, self)

    def numbered(self) -> DataFrame:
        """Rows plus `_rn` (0-based position in the series) and `_rows` (length of the series)."""
        joined = null_safe_join(self.rows, self.index, [*self.keys, PART], "inner")
        return joined.withColumn(RN, F.col("_before") + F.col(IDX) - F.col("_first")).drop(
            "_here", "_first", "_before", "_parts"
        )

    def chunked(self, back: int, ahead: int = 0, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
        """Rows dealt to `_chunk`, copied into each chunk whose frames reach them.

        Frames reach `back` rows behind and `ahead` rows past the current one. Windows over
        (keys, _chunk) ordered by `_rn` are then exact on rows where `_home = _chunk`. `_rn` rises by one from row to
        row of a series; a series in one part and one chunk does not start at zero.
        """
        rn, size = F.col(RN), F.lit(chunk_rows)
        first = F.greatest(rn - ahead, F.lit(0))
        last = F.least(rn + back, F.col(ROWS) - 1)
        long = self._index().filter((F.col("_parts") > 1) | (F.col(ROWS) > chunk_rows)).drop("_here", "_parts")
        joined = null_safe_join(self.rows, self._side(long, "index"), [*self.keys, PART])
        one = F.array(F.lit(0).cast("bigint"))
        chunks = F.when(F.col(ROWS).isNull(), one).otherwise(F.sequence(F.floor(first / size), F.floor(last / size)))
        return (
            joined.withColumn(RN, F.coalesce(F.col("_before") + F.col(IDX) - F.col("_first"), F.col(IDX)))
            .withColumn(HOME, F.when(F.col(ROWS).isNull(), F.lit(0).cast("bigint")).otherwise(F.floor(rn / size)))
            .withColumn(CHUNK, F.explode(chunks))
            .drop("_first", "_before", ROWS)
        )

    def chunk_window(self):
        return Window.partitionBy(*self.keys, CHUNK).orderBy(RN)

    def running(self, specs: dict[str, tuple[str, Column]], totals: bool = False) -> DataFrame:
        """Rows plus running values per series up to and including each row.

        A spec is (kind, expression): sum, max, min, last (latest non-null) or next (earliest
        non-null from here on). With `totals`, whole-series sums are added as `<name>_total`.
        """
        summary = self.rows.groupBy(*self.keys, PART).agg(
            *[_part_value(kind, expr).alias(f"_p_{n}") for n, (kind, expr) in specs.items()]
        )
        series = Window.partitionBy(*self.keys)
        carried = [
            _over(kind, F.col(f"_p_{n}"), _so_far(series, PART, kind, -1)).alias(f"_c_{n}")
            for n, (kind, _) in specs.items()
        ]
        if totals:
            carried += [
                F.sum(f"_p_{n}").over(series).alias(f"{n}_total")
                for n, (kind, _) in specs.items()
                if kind == "sum"
            ]
        spanning = summary.select(*self.keys, PART, F.count(F.lit(1)).over(series).alias("_parts"), *carried).filter("_parts > 1")
        carry = self._side(spanning.drop("_parts"), "carry")
        part = Window.partitionBy(*self.keys, PART)
        local = self.rows.select(
            "*",
            *[
                _over(kind, expr, _so_far(part, IDX, kind, 0)).alias(f"_l_{n}")
                for n, (kind, expr) in specs.items()
            ],
            *[F.sum(expr).over(part).alias(f"_t_{n}") for n, (kind, expr) in specs.items() if totals and kind == "sum"],
        )
        joined = null_safe_join(local, carry, [*self.keys, PART])
        values = {n: _combine(kind, F.col(f"_c_{n}"), F.col(f"_l_{n}")) for n, (kind, _) in specs.items()}
        if totals:
            whole = [n for n, (kind, _) in specs.items() if kind == "sum"]
            joined = joined.withColumns({f"{n}_total": F.coalesce(f"{n}_total", f"_t_{n}") for n in whole}).drop(*[f"_t_{n}" for n in whole])
        return joined.withColumns(values).drop(*[f"_{side}_{n}" for n in specs for side in "cl"])


def _so_far(window, position: str, kind: str, last: int):
    """Frame from the start of the order; `next` reads the order backwards."""
    order = F.col(position).desc() if kind == "next" else F.col(position).asc()
    return window.orderBy(order).rowsBetween(Window.unboundedPreceding, last)


def _over(kind: str, expr: Column, window) -> Column:
    if kind in ("last", "next"):
        return F.last(expr, ignorenulls=True).over(window)
    return {"sum": F.sum, "max": F.max, "min": F.min}[kind](expr).over(window)


def _part_value(kind: str, expr: Column) -> Column:
    if kind in ("last", "next"):
        pick = F.max_by if kind == "last" else F.min_by
        return pick(expr, F.when(expr.isNotNull(), F.col(IDX)))
    return {"sum": F.sum, "max": F.max, "min": F.min}[kind](expr)


def _combine(kind: str, carry: Column, local: Column) -> Column:
    if kind == "sum":
        zero = F.lit(0)
        return F.coalesce(carry, zero) + F.coalesce(local, zero)
    if kind in ("last", "next"):
        return F.coalesce(local, carry)
    return (F.greatest if kind == "max" else F.least)(carry, local)


def lay_out(
    df: DataFrame, keys: list[str] | tuple[str, ...], order: list, parts: int | None = None, riders: tuple[str, ...] = ()
) -> Ordered:
    """Range-partition `df` by (keys, order), sort inside the parts and write the result.

    Without `parts`, there are as many as the input has advisory sizes, or `spark.sql.shuffle.partitions` where
    that is more; then adaptive execution merges small ones. Rows that tie on (keys, order) are placed by the hash of all their columns, so a task that runs again places them
    alike; only exact copies, which are interchangeable, are told apart by their input position. Columns in `riders` have no
    say in that.
    """
    df = df.drop(PART, IDX)
    by = [F.col(k).asc() for k in keys]
    by += [F.col(c).asc() if isinstance(c, str) else c for c in order]
    by += [F.col("_row_hash").asc(), F.col("_seq").asc()]
    spread = df.withColumn("_row_hash", row_hash(df.drop(*riders))).withColumn("_seq", F.monotonically_increasing_id())
    parts = parts or _parts_of(df)
    spread = spread.repartitionByRange(parts, *by) if parts else spread.repartitionByRange(*by)
    placed = spread.sortWithinPartitions(*by).drop("_row_hash", "_seq")
    placed = placed.withColumn("_mid", F.monotonically_increasing_id())
    written = materialize(placed, "layout")
    mid = F.col("_mid")
    rows = written.select(
        *df.columns,
        F.shiftright(mid, _PART_BITS).alias(PART),
        mid.bitwiseAND(F.lit((1 << _PART_BITS) - 1)).alias(IDX),
    )
    return Ordered(rows, tuple(keys))


UNPACKED = 4  # columnar files hold rows in about a quarter of their size in an exchange


def _parts_of(df: DataFrame) -> int | None:
    """The number of parts if it exceeds the session's shuffle partitions, which adaptive execution can only merge."""
    spark, size = df.sparkSession, input_bytes(df)
    if size is None:
        return None
    advisory = spark._jsparkSession.sessionState().conf().getConf(
        spark._jvm.org.apache.spark.sql.internal.SQLConf.ADVISORY_PARTITION_SIZE_IN_BYTES()
    )
    wanted = -(-size * UNPACKED // int(advisory))
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def order_series(df: DataFrame | Ordered, spec, parts: int | None = None) -> Ordered:
    """Lay series out by time; a layout that exists already is used as it is."""
    return df if isinstance(df, Ordered) else lay_out(df, spec.keys, spec.order, parts)
