import os

import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from fleetgauge.operators.dedup import keep_first, keep_one
from fleetgauge.plans import silver
from fleetgauge.schemas import ASSET_HISTORY, RAW_COLUMNS, MissingColumns
from fleetgauge.sources.files import read_or_empty, read_raw


def test_csv_columns_bind_by_name_and_stay_text(spark, folder):
    with open(os.path.join(folder, "a.csv"), "w") as out:
        out.write("fuel_liters,vin,transaction_id,timestamp,odometer_reading,station\n"
                  "40,V1,1,2024-01-01 10:00:00,100,North\n"
                  "n/a,V1,2,2024-01-02 10:00:00,200,North\n"
                  "41,,3,2024-01-02 10:00:00,200,North\n"
                  "42,V1,4,never,300,South\n")
    raw = read_raw(spark, folder, RAW_COLUMNS["fuel_transactions"])
    assert {t for _, t in raw.dtypes} == {"string"}
    clean = silver.fuel_transactions(raw)
    assert values(clean, "transaction_id", "vin", "fuel_liters", "odometer_reading", "station") == [
        ("1", "V1", 40.0, 100.0, "North"), ("4", "V1", 42.0, 300.0, "South")]
    assert values(clean.filter("transaction_id = '4'"), "event_time", "date") == [(None, None)]


def test_missing_column_is_named(frame):
    with pytest.raises(MissingColumns, match="service_type"):
        silver.maintenance_logs(frame("vin STRING, service_date STRING", [("V1", "2024-01-01")]))


def test_null_keys_collapse_into_one_row(frame):
    raw = frame("transaction_id STRING, vin STRING, timestamp STRING, fuel_liters STRING, "
                "odometer_reading STRING",
                [(None, "V2", "2024-01-01", "1", "1"), (None, "V1", "2024-01-01", "1", "1"),
                 ("7", "V3", "2024-01-01", "1", "1")])
    assert values(silver.fuel_transactions(raw), "transaction_id", "vin") == [
        (None, "V1"), ("7", "V3")]


def test_registry_keeps_rows_without_vin(frame):
    raw = frame("vin STRING, model STRING, mfg_year STRING, fuel_type STRING, owner STRING",
                [(None, "A", "2001", "P", "x"), ("V1", "B", "old", "D", "y"),
                 ("V1", "A", "2003", "D", "z")])
    assert values(silver.vehicle_registry(raw)) == [
        (None, "A", 2001, "P"), ("V1", "A", 2003, "D")]


def test_assignment_times_and_gate(frame):
    raw = frame("vin STRING, driver_id STRING, start_timestamp STRING, end_timestamp STRING, "
                "daily_rate STRING, region STRING",
                [("V1", "D1", "1704067200", None, "10.5", "N"),
                 ("V1", "D2", "1704067200", None, "10.5", "N"),
                 ("V1", "D1", "soon", None, "ten", "N"), (None, "D1", "0", None, "1", "N")])
    got = silver.vehicle_assignment(raw)
    assert values(got.selectExpr("driver_id", "CAST(start_date AS STRING)", "daily_rate")) == [
        ("D1", None, None), ("D1", "2024-01-01 00:00:00", 10.5)]


def test_maintenance_is_one_row_per_day(frame):
    raw = frame("vin STRING, service_date STRING, service_type STRING",
                [("V1", "2024-01-01", "oil"), ("V1", "2024-01-01 08:00:00", "brakes"),
                 ("V1", "x", "oil"), (None, "2024-01-01", "oil")])
    assert values(silver.maintenance_logs(raw).selectExpr("CAST(service_date AS STRING) d", "service_type")) == [
        (None, "oil"), ("2024-01-01", "brakes")]


def test_survivor_does_not_depend_on_the_order_of_rows(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "CAST(id * 37 % 1000 AS STRING) AS a", "id AS b")
    first = values(keep_one(df.repartition(5), ["k"]))
    assert first == values(keep_one(df.orderBy("b"), ["k"]))
    assert len(first) == 7


def test_survivor_of_numbers_is_a_whole_row_too(spark):
    df = spark.range(2000).selectExpr("id % 7 AS k", "CASE WHEN id % 3 > 0 THEN id * 37 % 11 END AS a",
                                      "CASE WHEN id % 5 > 0 THEN CAST(id AS DOUBLE) END AS b", "id AS c")
    kept = keep_one(df.repartition(5, "c"), ["k"])
    rows = values(kept)
    assert rows == values(keep_one(df.orderBy(F.desc("c")), ["k"]))
    assert len(rows) == 7 and set(rows) <= set(values(df))
    assert "HashAggregate" in plan_of(kept) and "SortAggregate" not in plan_of(kept)


def test_hot_keys_shrink_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS a", "CAST(id AS STRING) AS b")
    below_exchange = plan_of(keep_one(df, ["k"])).split("Exchange", 1)[1]
    assert "partial_min" in below_exchange
    below_exchange = plan_of(keep_first(df, ["k"], ["a", "b"])).split("Exchange", 1)[1]
    assert "WindowGroupLimit" in below_exchange


def test_absent_table_is_empty_and_broken_one_is_an_error(spark, folder):
    assert read_or_empty(spark, f"{folder}/none", ASSET_HISTORY).count() == 0
    bad = os.path.join(folder, "bad")
    os.mkdir(bad)
    with open(os.path.join(bad, "x.parquet"), "w") as out:
        out.write("this is not parquet")
    with pytest.raises(Exception):
        read_or_empty(spark, bad, ASSET_HISTORY).count()
