"""Metric CSV files in and scored CSV files out.

Cells that do not fit their type become null. With `rescue`, the readers add a column of that name: for such rows a map
from column to the text that was there, with the whole line under `_line` where its cells do not match the header; null
for rows that were read whole. `rescue_report` counts them.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from metricloom.functions.calendar import ts_to_epoch
from metricloom.functions.scalar import nan_to_null, round2
from metricloom.operators.quality import require_columns

METRIC_COLUMNS = ["timestamp", "cpu_utilization", "is_anomaly"]
DEMO_COLUMNS = ["timestamp", "cpu_usage", "is_normal"]
_LINE = "_line"
_TYPES = {
    "timestamp": "bigint", "cpu_utilization": "double", "cpu_usage": "double", "is_anomaly": "int", "is_normal": "int",
}


def clean_column_names(df: DataFrame) -> DataFrame:
    """Strip quotes and blanks from both ends of every column name."""
    edge = re.compile(r"^[\s'\"﻿]+|[\s'\"]+$")
    return df.toDF(*[edge.sub("", c) for c in df.columns])


def _read_text_columns(spark: SparkSession, path: str, with_lines: bool = False) -> DataFrame:
    """All columns as text; `with_lines` adds `_line`, the whole line where it has more or fewer cells than the header."""
    reader = spark.read.option("header", True).option("inferSchema", False)
    try:
        df = reader.csv(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(path) from error
        raise
    if not with_lines:
        return df
    schema = StructType([*df.schema.fields, StructField(_LINE, StringType())])
    # whether a line matches the header must not depend on the columns that a query reads
    reader = reader.schema(schema).option("columnNameOfCorruptRecord", _LINE).option("columnPruning", False)
    return reader.option("enforceSchema", True).csv(path)


def _typed(c: Column, kind: str) -> Column:
    return nan_to_null(c.try_cast(kind)) if kind == "double" else c.try_cast(kind)


def _rescued(kinds: dict[str, str], names: dict[str, str]) -> Column:
    """The texts of cells that hold something but not what their type asks for, by the names of their columns."""
    lost = [
        F.when((F.trim(c) != "") & F.col(c).try_cast(kind).isNull(), F.struct(F.lit(names[c]).alias("key"), F.col(c).alias("value")))
        for c, kind in kinds.items()
    ]
    line = F.when(F.col(_LINE).isNotNull(), F.struct(F.lit(_LINE).alias("key"), F.col(_LINE).alias("value")))
    found = F.filter(F.array(*lost, line), lambda x: x.isNotNull())
    return F.when(F.size(found) > 0, F.map_from_entries(found))


def read_metric_csv(spark: SparkSession, path: str, required=METRIC_COLUMNS, rescue: str | None = None) -> DataFrame:
    """CSV with a header; known columns get fixed types, others stay text."""
    df = require_columns(clean_column_names(_read_text_columns(spark, path, rescue is not None)), required)
    known = {c: _TYPES[c] for c in df.columns if c in _TYPES}
    cells = [_typed(F.col(c), known[c]).alias(c) if c in known else F.col(c) for c in df.columns if c != _LINE or rescue is None]
    return df.select(*cells, *([_rescued(known, {c: c for c in known}).alias(rescue)] if rescue else []))


def read_two_column_csv(spark: SparkSession, path: str, rescue: str | None = None) -> DataFrame:
    """The first two columns by position as (timestamp, cpu_utilization), two decimals."""
    df = _read_text_columns(spark, path, rescue is not None)
    columns = [c for c in df.columns if c != _LINE or rescue is None]
    if len(columns) < 2:
        raise ValueError(f"need two columns, have {columns}")
    first, second, *rest = [f"_{i}" for i in range(len(columns))]
    df = df.toDF(first, second, *rest, *([_LINE] if rescue else []))
    kinds, names = {first: "bigint", second: "double"}, {first: "timestamp", second: "cpu_utilization"}
    return df.select(
        _typed(F.col(first), "bigint").alias("timestamp"), round2(_typed(F.col(second), "double")).alias("cpu_utilization"),
        *([_rescued(kinds, names).alias(rescue)] if rescue else []),
    )


def rescue_report(df: DataFrame, rescue: str = "rescued") -> DataFrame:
    """(column, n_cells, n_rows, n_rescued): unreadable cells per column beside the rows read and the rows with any.

    A row with the column null, always there, has the rows that were rescued as its cells.
    """
    cells = df.select(F.explode(F.array_append(F.map_keys(F.coalesce(rescue, F.create_map())), F.lit(None).cast("string"))).alias("column"), rescue)
    counted = cells.groupBy("column").agg(
        F.count(rescue).alias("n_cells"), F.count(F.when(F.col("column").isNull(), 1)).alias("_rows")
    )
    whole = counted.filter("column IS NULL").select(F.col("_rows").alias("n_rows"), F.col("n_cells").alias("n_rescued"))
    return counted.drop("_rows").join(F.broadcast(whole))  # one row




def scored_rows(
    df: DataFrame, ts: str = "ts", value: str = "cpu_utilization", status: str = "prediction", keys=()
) -> DataFrame:
    """(`keys`, timestamp in epoch seconds, cpu_utilization as text with two decimals, is_anomaly).

    Without `keys` the rows of all series look alike: for tables of one series.
    """
    epoch = F.col(ts).cast("bigint") if dict(df.dtypes)[ts] in ("bigint", "int") else ts_to_epoch(ts)
    return df.select(
        *keys,
        epoch.alias("timestamp"),
        F.format_string("%.2f", round2(value)).alias("cpu_utilization"),
        F.col(status).cast("int").alias("is_anomaly"),
    )


def write_scored_csv(df: DataFrame, path: str, mode: str = "error", **columns) -> None:
    scored_rows(df, **columns).write.mode(mode).option("header", True).csv(path)
