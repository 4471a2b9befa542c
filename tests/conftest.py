import os
import sys
from datetime import datetime, timedelta, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from metricloom.session import local_session  # noqa: E402

START = datetime(2024, 1, 5, 17, 59, tzinfo=timezone.utc)
VALUES = [10.0, 20.0, 20.0, 95.0, 85.0, 92.5, 5.0, 81.0]
LABELS = [0, 0, 0, 1, 1, 1, 0, 1]
SCHEMA = "series_key string, ts timestamp, event_id long, cpu_utilization double, is_anomaly int"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="8g", app="tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session


@pytest.fixture
def table(spark):
    """Build series rows one minute apart from values and labels."""

    def build(values, labels=None, key="a", first_id=0):
        labels = labels or [0] * len(values)
        rows = [
            (key, START + timedelta(minutes=i), first_id + i, v, y) for i, (v, y) in enumerate(zip(values, labels))
        ]
        return spark.createDataFrame(rows, SCHEMA)

    return build


@pytest.fixture
def micro(table):
    return table(VALUES, LABELS)


@pytest.fixture
def skewed(spark):
    """3 000 rows: series 'hot' holds a third, a third of those share one instant, a third of values are 100."""
    from pyspark.sql import functions as F

    def u(salt):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(10_000)) / 10_000

    second = F.when(u(2) < 0.33, 0).otherwise((u(2) * 86_400).cast("long"))
    return spark.range(3_000).select(
        F.when(u(1) < 0.34, "hot").otherwise(F.concat(F.lit("s"), (u(1) * 5).cast("int"))).alias("series_key"),
        F.timestamp_seconds(F.lit(1_704_067_200) + second).alias("ts"),
        F.col("id").alias("event_id"),
        F.when(u(3) < 0.33, 100.0).otherwise(F.round(u(3) * 100, 1)).alias("cpu_utilization"),
        (u(4) > 0.6).cast("int").alias("is_anomaly"),
    )
