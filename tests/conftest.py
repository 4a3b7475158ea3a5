from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("fleetgauge-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="fleetgauge-warehouse-"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="fleetgauge-scratch-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture
def frame(spark):
    """Small frame from a DDL schema and rows."""
    return lambda schema, rows: spark.createDataFrame(rows, schema)


def values(df, *columns):
    """Sorted rows as tuples."""
    rows = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(rows, key=lambda row: tuple((v is not None, str(v)) for v in row))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
