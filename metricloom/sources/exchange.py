"""The metrics-store formats: range-query responses in, exposition lines out."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from metricloom.functions.calendar import ts_to_epoch
from metricloom.functions.scalar import nan_to_null, round2

RANGE_RESPONSE = (
    "status string, error string, data struct<resultType:string,"
    "result:array<struct<metric:map<string,string>,values:array<array<string>>>>>"
)


def read_range_response(spark: SparkSession, path: str, multi_line: bool = True, rescue: str | None = None) -> DataFrame:
    """All series of the JSON responses under `path`: (labels, series_key, timestamp, cpu_utilization).

    Times and values that are no numbers become null; `rescue` names a column that keeps such a point as text, as the
    CSV readers do.

    A file holds one response, or one per line with `multi_line=False`.
    `multi_line=True` makes each file one record, which suits polls; write large exports as lines.
    Fails when no series came back, and when a response that is read reports an error.
    """
    responses = spark.read.schema(RANGE_RESPONSE).option("multiLine", multi_line).json(path)
    reported = F.concat(F.lit("the metrics store reported an error: "), F.coalesce("error", F.lit("unknown")))
    result = F.when(F.col("status").eqNullSafe("success"), F.col("data.result")).otherwise(F.raise_error(reported))
    try:
        none = responses.filter(F.size(result) > 0).isEmpty()
    except PySparkException as error:
        if "USER_RAISED_EXCEPTION" not in str(error):
            raise
        raise ValueError(str(error)) from error
    if none:
        raise ValueError("the range query returned no series")
    series = responses.select(F.explode(result).alias("r")).select(
        F.col("r.metric").alias("labels"), F.explode("r.values").alias("point")
    )
    return series.select(
        "labels",
        series_key("labels").alias("series_key"),
        F.expr("try_cast(try_cast(get(point, 0) AS double) AS bigint)").alias("timestamp"),
        round2(nan_to_null(F.expr("try_cast(get(point, 1) AS double)"))).alias("cpu_utilization"),
        *([_lost_point().alias(rescue)] if rescue else []),
    )


def _lost_point() -> Column:
    at, value = (F.expr(f"get(point, {k})") for k in (0, 1))
    lost = [
        F.when(F.coalesce(c, F.lit("")).try_cast("double").isNull(), F.struct(F.lit(n).alias("key"), F.coalesce(c, F.lit("")).alias("value")))
        for n, c in (("timestamp", at), ("cpu_utilization", value))
    ]
    found = F.filter(F.array(*lost), lambda x: x.isNotNull())
    return F.when(F.size(found) > 0, F.map_from_entries(found))


def series_key(labels: str):
    """One text per label set, labels in name order."""
    pairs = F.transform(
        F.array_sort(F.map_entries(labels)), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return F.array_join(pairs, ",")


def exposition_lines(
    df: DataFrame, ts: str = "ts", value: str = "cpu_utilization", status: str = "prediction", metric: str = "cpu_usage",
    labels=(),
) -> DataFrame:
    """One line per row: `metric{status="s",label="x"} value epoch_millis`, `labels` being the columns that name the series.

    Backslashes, quotes and line ends in label values are escaped; a null is the empty label.
    """
    epoch = F.col(ts).cast("bigint") if dict(df.dtypes)[ts] in ("bigint", "int") else ts_to_epoch(ts)
    pairs = [F.concat(F.lit(f',{name}="'), _label_text(name), F.lit('"')) for name in labels]
    return df.select(
        F.format_string(
            '%s{status="%d"%s} %s %d',
            F.lit(metric),
            F.col(status).cast("int"),
            F.concat(*pairs) if pairs else F.lit(""),
            F.col(value).cast("string"),
            epoch * 1000,
        ).alias("value")
    )


def _label_text(column: str) -> Column:
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    for raw, safe in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def write_exposition(df: DataFrame, path: str, mode: str = "error", **columns) -> None:
    exposition_lines(df, **columns).write.mode(mode).text(path)
