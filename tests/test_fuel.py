import random
from datetime import datetime, timedelta

import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from fleetgauge.operators.sequence import with_previous
from fleetgauge.plans.fuel import audited_refuels, fuel_efficiency
from fleetgauge.settings import RiskSettings

FUEL = "transaction_id STRING, vin STRING, event_time TIMESTAMP, fuel_liters DOUBLE, odometer_reading DOUBLE"


def day(text):
    return datetime.fromisoformat(text)


@pytest.fixture
def tables(frame):
    def build(fuel, registry=(("V1", "M"),), maintenance=()):
        return (frame(FUEL, fuel), frame("vin STRING, model STRING", list(registry)),
                frame("vin STRING, service_date DATE", list(maintenance)))

    return build


# 2024-01-01 is a Monday, the 6th and 7th are a weekend.
def test_excluded_refuels_still_are_previous_readings(tables):
    fuel, registry, maintenance = tables(
        [("1", "V1", day("2024-01-04"), 10.0, 100.0), ("2", "V1", day("2024-01-05"), 10.0, 200.0),
         ("3", "V1", day("2024-01-06"), 10.0, 350.0), ("4", "V1", day("2024-01-08"), 10.0, 400.0),
         ("5", "V1", day("2024-01-09"), 10.0, 500.0)],
        maintenance=[("V1", day("2024-01-08").date())])
    assert values(audited_refuels(fuel, maintenance), "kmpl") == [(10.0,), (10.0,)]


def test_status_edges(tables):
    fuel, registry, maintenance = tables([
        ("1", "V1", day("2024-01-01"), 1.0, 0.0),
        ("2", "V1", day("2024-01-02"), 1.0, 88.0),   # exactly 0.88 of the baseline: OK
        ("3", "V1", day("2024-01-03"), 1.0, 200.0),  # 112
        ("4", "V1", day("2024-01-04"), 0.0, 250.0),  # no litres: no kmpl, OK
    ])
    got = fuel_efficiency(fuel, registry, maintenance)
    assert values(got, "kmpl", "baseline_kmpl", "status") == [
        (None, 100.0, "OK"), (112.0, 100.0, "OK"), (88.0, 100.0, "OK")]


def test_rollback_counts_and_unknown_vehicles_drop_out(tables):
    fuel, registry, maintenance = tables(
        [("1", "V1", day("2024-01-01"), 1.0, 100.0), ("2", "V1", day("2024-01-02"), 1.0, 90.0),
         ("3", "V2", day("2024-01-01"), 1.0, 1.0), ("4", "V2", day("2024-01-02"), 1.0, 2.0),
         ("5", "V3", day("2024-01-01"), 1.0, 1.0), ("6", "V3", day("2024-01-02"), 1.0, 2.0)],
        registry=[("V1", "M"), ("V3", None)])
    got = fuel_efficiency(fuel, registry, maintenance)
    # the threshold of a negative baseline lies above it: -10 < -8.8
    assert values(got, "vin", "kmpl", "status") == [("V1", -10.0, "FLAGGED")]


def test_baseline_is_per_model_over_vehicles(tables):
    fuel, registry, maintenance = tables(
        [("1", "V1", day("2024-01-01"), 1.0, 0.0), ("2", "V1", day("2024-01-02"), 1.0, 10.0),
         ("3", "V2", day("2024-01-01"), 1.0, 0.0), ("4", "V2", day("2024-01-02"), 1.0, 30.0),
         ("5", "V2", day("2024-01-03"), 1.0, 80.0), ("6", "V9", day("2024-01-01"), 1.0, 0.0),
         ("7", "V9", day("2024-01-02"), 1.0, 7.0)],
        registry=[("V1", "M"), ("V2", "M"), ("V9", "N")])
    got = fuel_efficiency(fuel, registry, maintenance)
    assert values(got, "vin", "kmpl", "baseline_kmpl", "status") == [
        ("V1", 10.0, 30.0, "FLAGGED"), ("V2", 30.0, 30.0, "OK"), ("V2", 50.0, 30.0, "OK"),
        ("V9", 7.0, 7.0, "OK")]


def previous_by_hand(rows):
    """(key, time, id, value) -> expected output rows."""
    result, last = [], {}
    early = datetime.min
    for key, time, tie, value in sorted(rows, key=lambda r: (r[0], r[1] or early, r[2])):
        if time is not None:
            result.append((key, tie, last.get(key)))
        last[key] = value
    return sorted(result, key=str)


@pytest.mark.parametrize("piece", ["YEAR", "DAY", "HOUR", "MINUTE"])
@pytest.mark.parametrize("moments", [300, 1])
def test_pieces_of_time_change_nothing(frame, piece, moments):
    rng = random.Random(7)
    start = day("2024-01-01")
    rows = []
    for tie in range(600):
        key = rng.choice(["hot", "hot", "hot", "warm", "warm", f"cold{tie % 90}"])
        time = None if rng.random() < 0.1 else start + timedelta(minutes=10 * rng.randrange(moments))
        rows.append((key, time, tie, rng.choice([None, float(tie)])))
    df = frame("k STRING, t TIMESTAMP, i INT, v DOUBLE", rows + [(None, start, 1000, 1.0)])
    got = with_previous(df, "k", "t", "v", ["i"], "p", piece)
    assert values(got, "k", "i", "p") == sorted(
        previous_by_hand(rows), key=lambda row: tuple((v is not None, str(v)) for v in row))


def test_equal_rows_at_a_border_follow_each_other(frame):
    early, late = day("2024-01-01T00:59:00"), day("2024-01-01T01:00:00")
    rows = [("k", early, 1, 5.0), ("k", late, 1, 7.0), ("k", late, 1, 7.0)]
    got = with_previous(frame("k STRING, t TIMESTAMP, i INT, v DOUBLE", rows), "k", "t", "v", ["i"], "p")
    assert values(got, "p") == [(None,), (5.0,), (7.0,)]


def test_no_job_runs_before_the_audit_is_read_and_a_vin_is_cut(tables):
    rows = [(str(i), "V1", day("2024-01-01") + timedelta(hours=i), 1.0, float(i)) for i in range(50)]
    fuel, registry, maintenance = tables(rows)
    audit = audited_refuels(fuel, maintenance)
    assert "hashpartitioning(vin#" in plan_of(audit) and "_piece" in plan_of(audit)
    assert values(audit) == values(audited_refuels(fuel, maintenance, RiskSettings(sequence_piece="YEAR")))


@pytest.mark.parametrize("most", [1, 4, 1000])
def test_full_pieces_are_cut_finer(frame, most):
    """All rows of a vin in one hour, some at the same second, against a plain walk."""
    rng = random.Random(most)
    rows = [("hot", day("2024-01-01") + timedelta(seconds=rng.randrange(900)), i, float(i)) for i in range(400)]
    rows += [(f"k{i % 7}", day("2024-01-01") + timedelta(minutes=i), i, float(i)) for i in range(400, 450)]
    rows += [("hot", None, i, float(i)) for i in range(450, 460)]
    df = frame("k STRING, t TIMESTAMP, i INT, v DOUBLE", rows)
    got = with_previous(df, "k", "t", "v", ["i"], "p", most=most)
    assert values(got, "k", "i", "p") == sorted(
        previous_by_hand(rows), key=lambda row: tuple((v is not None, str(v)) for v in row))


def test_hot_vin_within_an_hour_is_spread(spark, frame):
    """No task of the window holds a large part of the rows."""
    df = spark.range(20_000).selectExpr(
        "'hot' AS k", "timestamp_seconds(1704067200 + id % 3600) AS t", "id AS i", "id * 1.0 AS v")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = with_previous(df, "k", "t", "v", ["i"], "p", most=100)
        sizes = [r[0] for r in got.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 20_000 and max(sizes) < 0.6 * sum(sizes)
