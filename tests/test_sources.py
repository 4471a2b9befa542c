"""Files and exchange formats."""

import json

import pytest
from pyspark.sql import functions as F

from metricloom.functions import scalar
from metricloom.sources import exchange, files


def write(tmp_path, name, text, encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_csv_header_with_bom_quotes_and_blanks(spark, tmp_path):
    text = "﻿'timestamp' , cpu_utilization,\"is_anomaly\",host\n1704477540,12.5,1,a\n1704477600,bad,0,b\n"
    df = files.read_metric_csv(spark, write(tmp_path, "m.csv", text))
    assert df.columns == ["timestamp", "cpu_utilization", "is_anomaly", "host"]
    assert [tuple(r) for r in df.collect()] == [(1704477540, 12.5, 1, "a"), (1704477600, None, 0, "b")]


def test_csv_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_metric_csv(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(ValueError, match="is_anomaly"):
        files.read_metric_csv(spark, write(tmp_path, "m.csv", "timestamp,cpu_utilization\n1,2\n"))
    assert files.read_metric_csv(
        spark, write(tmp_path, "d.csv", "timestamp,cpu_usage,is_normal\n1,2,0\n"), files.DEMO_COLUMNS
    ).first() == (1, 2.0, 0)


def test_first_two_columns_by_position(spark, tmp_path):
    df = files.read_two_column_csv(spark, write(tmp_path, "t.csv", "when,load,more\n1704477540,0.125,x\n"))
    assert df.first() == (1704477540, 0.12)


def test_scored_csv(micro, tmp_path):
    path = str(tmp_path / "out")
    files.write_scored_csv(micro, path, status="is_anomaly")
    lines = sorted(r[0] for r in micro.sparkSession.read.text(path).distinct().collect())
    assert lines[0] == "1704477540,10.00,0" and lines[-1] == "timestamp,cpu_utilization,is_anomaly"


def response(status="success", result=(), error=None):
    return json.dumps({"status": status, "error": error, "data": {"resultType": "matrix", "result": list(result)}}, indent=1)


def test_range_response_keeps_all_series(spark, tmp_path):
    two = [
        {"metric": {"host_name": h, "project": "p"}, "values": [[1704477540, "12.345"], [1704477570.0, "NaN"]]}
        for h in ("a", "b")
    ]
    df = exchange.read_range_response(spark, write(tmp_path, "r.json", response(result=two)))
    rows = sorted((r["series_key"], r["timestamp"], r["cpu_utilization"]) for r in df.filter("cpu_utilization is not null").collect())
    assert rows == [(f"host_name={h},project=p", 1704477540, 12.34) for h in ("a", "b")] or rows == [
        (f"host_name={h},project=p", 1704477540, 12.35) for h in ("a", "b")
    ]
    assert df.count() == 4
    assert scalar.label_filter(df, host_name="a").count() == 2


def test_range_response_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="no series"):
        exchange.read_range_response(spark, write(tmp_path, "e.json", response()))
    with pytest.raises(ValueError, match="too many"):
        exchange.read_range_response(spark, write(tmp_path, "x.json", response("error", error="too many")))


def test_exposition_lines(micro, tmp_path):
    path = str(tmp_path / "lines")
    exchange.write_exposition(micro, path, status="is_anomaly")
    lines = sorted(r[0] for r in micro.sparkSession.read.text(path).collect())
    assert 'cpu_usage{status="0"} 10.0 1704477540000' in lines and len(lines) == 8


def test_labels_become_one_key(spark):
    df = spark.range(1).select(F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1")).alias("labels"))
    assert df.select(exchange.series_key("labels")).first()[0] == "a=1,b=2"


def test_series_keep_their_labels_in_lines(spark):
    df = spark.createDataFrame([('a"\\', 0, 1.0, 0), ("b\n", 0, 2.0, 0), (None, 0, 3.0, 1)], "k string, ts long, v double, s int")
    lines = [r[0] for r in exchange.exposition_lines(df, "ts", "v", "s", labels=("k",)).collect()]
    assert lines == [
        'cpu_usage{status="0",k="a\\"\\\\"} 1.0 0', 'cpu_usage{status="0",k="b\\n"} 2.0 0', 'cpu_usage{status="1",k=""} 3.0 0'
    ]
