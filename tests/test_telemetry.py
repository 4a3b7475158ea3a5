import json
from dataclasses import replace

import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from fleetgauge.operators.geo import flag_zones
from fleetgauge.plans import telemetry as tm
from fleetgauge.settings import RiskSettings, ZoneBox

EVENT = "vin STRING, speed INT, rpm INT, lat DOUBLE, lon DOUBLE, event_timestamp BIGINT"
DIMENSION = "vin STRING, driver_id STRING, daily_rate DOUBLE, region STRING"
T0 = 1704067200


def event(vin="V1", speed=100, lat=12.0, lon=77.0, at=T0, rpm=2000):
    return (vin, speed, rpm, lat, lon, at)


def good(**changes):
    return json.dumps({"vin": "V1", "speed": 100, "rpm": 2000, "lat": 12.0, "lon": 77.0,
                       "event_timestamp": T0, **changes})


@pytest.mark.parametrize("text, kept", [
    (good(), "V1"), (good(extra=1), "V1"), (good(vin=1), "1"),
    ("not json", None), ("", None), (None, None), ("[1, 2]", None), ("{}", None),
    (good(speed=None), None), (good(speed=100.5), None), (good(speed="100"), None),
    (good(rpm=99999999999), None), (good(lat=None), None), (good(vin=None), None),
    (good(event_timestamp=None), None),
])
def test_json_messages(spark, text, kept):
    messages = spark.createDataFrame([(None if text is None else bytearray(text, "utf-8"),)],
                                     "value BINARY").withColumn("timestamp", F.current_timestamp())
    clean = tm.clean_telemetry(tm.parse_telemetry(messages))
    assert [r.vin for r in clean.collect()] == ([kept] if kept else [])


def test_message_is_parsed_once(spark):
    messages = spark.createDataFrame([(good(),)], "value STRING").withColumn(
        "timestamp", F.current_timestamp())
    assert plan_of(tm.clean_telemetry(tm.parse_telemetry(messages))).split("Initial Plan")[-1].count("from_json") == 1


def test_copies_and_impossible_times(frame):
    clean = tm.clean_telemetry(frame(EVENT, [event(), event(), event(speed=90), event("V2"),
                                             event(at=T0 + 1), event(at=10**16)]))
    assert values(clean.selectExpr("vin", "speed", "CAST(event_time AS STRING) AS t")) == [
        ("V1", 100, None), ("V1", 100, "2024-01-01 00:00:01"), ("V1", 90, "2024-01-01 00:00:00"),
        ("V2", 100, "2024-01-01 00:00:00")]


def scored(frame, events, settings=RiskSettings()):
    clean = tm.clean_telemetry(frame(EVENT, events))
    return tm.driver_safety_status(clean, frame(DIMENSION, [("V1", "D1", 100.0, "N")]), settings)


@pytest.mark.parametrize("speed, flag", [(110, 0), (111, 1)])
def test_overspeed_is_strict(frame, speed, flag):
    assert values(scored(frame, [event(speed=speed)]), "overspeed_flag") == [(flag,)]


@pytest.mark.parametrize("lat, lon, flag", [
    (12.5, 77.2, 1), (12.8, 77.5, 1), (12.65, 77.3, 1), (12.4999, 77.3, 0), (12.8001, 77.3, 0),
    (12.6, 77.1999, 0), (12.6, 77.5001, 0)])
def test_zone_borders_are_inside(frame, lat, lon, flag):
    assert values(scored(frame, [event(lat=lat, lon=lon)]), "restricted_zone_flag") == [(flag,)]


def test_score_rate_and_category(frame):
    both = scored(frame, [event(speed=120, lat=12.6, lon=77.3)])
    assert both.columns == list(tm.SAFETY_COLUMNS)
    assert values(both, "strike_score", "risk_category", "adjusted_daily_rate", "hour") == [
        (3, "MEDIUM_RISK", 85.0, 0)]
    eager = replace(RiskSettings(), high_risk_score=3, overspeed_limit=119)
    assert values(scored(frame, [event(speed=120, lat=12.6, lon=77.3)], eager), "risk_category") == [
        ("HIGH_RISK",)]


def test_vehicle_without_assignment_stays(frame):
    assert values(scored(frame, [event("V9", speed=120)]), "driver_id", "adjusted_daily_rate",
                  "strike_score", "risk_category") == [(None, None, 1, "LOW_RISK")]


def test_zone_table_in_place_of_the_box(frame):
    zones = frame("min_lat DOUBLE, max_lat DOUBLE, min_lon DOUBLE, max_lon DOUBLE",
                  [(11.0, 12.0, 76.0, 77.0)])
    events = flag_zones(tm.clean_telemetry(frame(EVENT, [event(), event("V2", lat=12.6, lon=77.3)])), zones)
    assert values(tm.score_events(events.withColumn("daily_rate", F.lit(1.0))), "vin", "strike_score") == [
        ("V1", 2), ("V2", 0)]
    moved = replace(RiskSettings(), zone=ZoneBox(11.0, 12.0, 76.0, 77.0))
    assert values(scored(frame, [event()], moved), "restricted_zone_flag") == [(1,)]


def test_windows(frame):
    events = [event(at=T0), event(at=T0 + 1799, speed=120), event(at=T0 + 1800), event("V9", at=T0)]
    got = tm.flatten_window(tm.driver_risk_aggregates(scored(frame, events)))
    rows = values(got.selectExpr("CAST(window_start AS STRING)", "CAST(window_end AS STRING)", "driver_id", "total_events",
                                 "overspeed_events", "total_strike_score", "avg_speed", "max_speed"))
    assert rows == [
        ("2024-01-01 00:00:00", "2024-01-01 00:30:00", None, 1, 0, 0, 100.0, 100),
        ("2024-01-01 00:00:00", "2024-01-01 00:30:00", "D1", 2, 1, 1, 110.0, 120),
        ("2024-01-01 00:30:00", "2024-01-01 01:00:00", "D1", 1, 0, 0, 100.0, 100)]
