"""Summaries give the same from events and from facts that were rolled up before."""

import pytest
from conftest import values
from pyspark.sql import functions as F

from fleetgauge.plans import reports
from fleetgauge.plans import telemetry as tm

EVENT = "vin STRING, speed INT, rpm INT, lat DOUBLE, lon DOUBLE, event_timestamp BIGINT"
DIMENSION = "vin STRING, driver_id STRING, daily_rate DOUBLE, region STRING"
SUMMARIES = [r for r in reports.REPORTS if r.target not in
             ("active_vehicle_snapshot", "asset_history_report", "driver_safety_status")]


@pytest.fixture
def events(frame):
    rows = [(f"V{i % 7}", 60 + i * 37 % 81, 2000, 12.0 + i % 10 / 10, 77.0 + i % 9 / 10, 1704067200 + 997 * i)
            for i in range(300)]
    dimension = frame(DIMENSION, [(f"V{i}", f"D{i % 3}", 1.0, "N" if i % 2 else None) for i in range(6)])
    return tm.driver_safety_status(tm.clean_telemetry(frame(EVENT, rows)), dimension)


@pytest.mark.parametrize("report", SUMMARIES, ids=lambda r: r.target)
def test_rollup_changes_nothing(events, report):
    facts = reports.event_facts(events)
    plain = report.build(reports.FleetTables(None, facts, None, None))
    rolled = report.build(reports.FleetTables(None, reports.rolled_up(facts), None, None))
    assert plain.schema == rolled.schema
    assert values(plain) == values(rolled)


def test_driver_totals(events):
    got = reports.driver_risk_score(reports.FleetTables(None, reports.event_facts(events), None, None))
    expected = events.groupBy("driver_id").agg(
        F.count("*").alias("n"), F.sum("overspeed_flag"), F.sum("restricted_zone_flag"), F.sum("strike_score"))
    assert values(got.drop("risk_category")) == values(expected)


def test_names(spark):
    assert len(reports.REPORTS) == len({r.view for r in reports.REPORTS}) == len({r.target for r in reports.REPORTS}) == 9
