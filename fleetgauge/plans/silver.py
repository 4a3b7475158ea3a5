"""Raw text tables to typed, gated, de-duplicated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions.conversion import (
    epoch_to_time,
    to_day,
    to_double,
    to_time,
    to_whole_number,
)
from fleetgauge.operators.dedup import keep_one
from fleetgauge.schemas import RAW_COLUMNS, require_columns


def vehicle_registry(raw: DataFrame) -> DataFrame:
    """One row per vin. There is no NULL gate: rows without a vin leave one row."""
    require_columns(raw, RAW_COLUMNS["vehicle_registry"])
    typed = raw.select("vin", "model", to_whole_number(F.col("mfg_year"), "int").alias("mfg_year"),
                       "fuel_type")
    return keep_one(typed, ["vin"])


def vehicle_assignment(raw: DataFrame) -> DataFrame:
    """One row per vin and start; keeps the raw columns next to the typed ones."""
    require_columns(raw, RAW_COLUMNS["vehicle_assignment"])
    typed = raw.filter(F.col("vin").isNotNull()).withColumns({
        "start_date": epoch_to_time(to_whole_number(F.col("start_timestamp"))),
        "end_date": epoch_to_time(to_whole_number(F.col("end_timestamp"))),
        "daily_rate": to_double(F.col("daily_rate")),
    })
    return keep_one(typed, ["vin", "start_date"])


def fuel_transactions(raw: DataFrame) -> DataFrame:
    """One row per transaction with usable vin, litres and odometer."""
    require_columns(raw, RAW_COLUMNS["fuel_transactions"])
    typed = raw.withColumns({
        "event_time": to_time(F.col("timestamp")),
        "fuel_liters": to_double(F.col("fuel_liters")),
        "odometer_reading": to_double(F.col("odometer_reading")),
        "date": to_day(F.col("timestamp")),
    })
    usable = typed.filter(F.col("vin").isNotNull() & F.col("fuel_liters").isNotNull()
                          & F.col("odometer_reading").isNotNull())
    return keep_one(usable, ["transaction_id"])


def maintenance_logs(raw: DataFrame) -> DataFrame:
    """One row per vin and service day."""
    require_columns(raw, RAW_COLUMNS["maintenance_logs"])
    typed = (raw.filter(F.col("vin").isNotNull())
             .withColumn("service_date", to_day(F.col("service_date"))))
    return keep_one(typed, ["vin", "service_date"])
