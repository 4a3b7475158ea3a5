"""Declared table schemas and the column check every job starts with."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructType,
    TimestampType,
)

STRING, INT, BIGINT, DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()
DATE, TIMESTAMP = DateType(), TimestampType()


def table(**columns: DataType) -> StructType:
    """Schema of nullable columns. Needs no session, unlike a DDL string."""
    schema = StructType()
    for name, data_type in columns.items():
        schema.add(name, data_type)
    return schema


TELEMETRY = table(
    vin=STRING, speed=INT, rpm=INT, lat=DOUBLE, lon=DOUBLE, event_timestamp=BIGINT,
)

ASSET_HISTORY = table(
    vin=STRING, driver_id=STRING, start_date=DATE, end_date=DATE, daily_rate=DOUBLE,
    region=STRING, status=STRING, record_start_ts=TIMESTAMP, record_end_ts=TIMESTAMP,
    is_current=INT, change_type=STRING, created_ts=TIMESTAMP,
)

DRIVER_RISK_STATE = table(
    driver_id=STRING, total_strike_score=BIGINT, risk_category=STRING, suspension_status=STRING,
    suspension_reason=STRING, cooldown_until=TIMESTAMP, warning_count=INT, suspension_count=INT,
    reinstatement_eligible=INT, strike_decay_score=BIGINT, total_overspeed_events=BIGINT,
    total_restricted_zone_events=BIGINT, last_event_ts=TIMESTAMP, updated_ts=TIMESTAMP,
)

SUSPENSION_EVENT_HISTORY = table(
    driver_id=STRING, event_type=STRING, previous_status=STRING, new_status=STRING,
    strike_score=BIGINT, event_reason=STRING,
)

# Totals of an open window of a driver, with what the last micro-batch added.
WINDOW_TOTALS = table(
    window_start=TIMESTAMP, window_end=TIMESTAMP, total_strike_score=BIGINT,
    overspeed_events=BIGINT, restricted_zone_events=BIGINT, last_event_time=TIMESTAMP,
    added_strike_score=BIGINT, added_overspeed_events=BIGINT,
    added_restricted_zone_events=BIGINT, touched_batch=BIGINT,
)
# What a run said of a driver, as far as the audit log needs it.
FINDING = table(
    event_type=STRING, previous_status=STRING, new_status=STRING, strike_score=BIGINT,
    event_reason=STRING,
)
# The state of a driver as it is stored: with open windows, the last run of each source that
# touched it, and what the last of all said.
STORED_STATE = table(
    **{f.name: f.dataType for f in DRIVER_RISK_STATE},
    windows=ArrayType(WINDOW_TOTALS),
    applied=MapType(STRING, table(run=BIGINT, at=TIMESTAMP)),
    findings=ArrayType(FINDING),
)

# The columns each raw table must have, and those the versioned
# assignment table must have before it is written.
RAW_COLUMNS = {
    "vehicle_registry": ("vin", "model", "mfg_year", "fuel_type"),
    "vehicle_assignment": ("vin", "driver_id", "start_timestamp", "end_timestamp",
                           "daily_rate", "region"),
    "fuel_transactions": ("transaction_id", "vin", "timestamp", "fuel_liters",
                          "odometer_reading"),
    "maintenance_logs": ("vin", "service_date", "service_type"),
}
ASSET_HISTORY_REQUIRED = ("vin", "driver_id", "start_date", "daily_rate", "region", "status",
                          "is_current")


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, in a form that the optimizer knows to be empty and prunes joins with."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(1).select(*columns).filter(F.lit(False))


class MissingColumns(ValueError):
    """A table lacks columns that the operator needs."""


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Return ``df``, or raise if a column is missing. Starts no job."""
    have = set(df.columns)
    missing = [n for n in names if n not in have]
    if missing:
        raise MissingColumns(f"missing columns {missing}; the table has {df.columns}")
    return df
