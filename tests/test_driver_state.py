import glob
import os
import random
import shutil
from datetime import datetime, timedelta

import pytest
from conftest import values
from pyspark.sql import functions as F

from fleetgauge.plans import driver_state as ds
from fleetgauge.plans.stores import DriverStateStore
from fleetgauge.schemas import DRIVER_RISK_STATE
from fleetgauge.settings import StreamSettings

WINDOW = ("window_start TIMESTAMP, driver_id STRING, total_strike_score BIGINT, "
          "overspeed_events BIGINT, restricted_zone_events BIGINT")
T1, T2, T3 = "2024-02-01 08:00:00", "2024-02-02 08:00:00", "2024-02-03 08:00:00"


def at(text):
    return datetime.fromisoformat(text)


@pytest.fixture
def evaluate(frame):
    def build(*rows, **options):
        rows = [(at(start), driver, score, 1, 2) for start, driver, score in rows]
        return ds.evaluate_windows(frame(WINDOW, rows), **options)

    return build


@pytest.fixture
def empty(frame):
    return frame(DRIVER_RISK_STATE, [])


@pytest.mark.parametrize("score, expected", [
    (0, ("LOW_RISK", "ACTIVE", None, 0, 0, 1, 0)), (7, ("LOW_RISK", "ACTIVE", None, 0, 0, 1, 5)),
    (8, ("MEDIUM_RISK", "WARNING", "Moderate risk behavior", 1, 0, 0, 6)),
    (14, ("MEDIUM_RISK", "WARNING", "Moderate risk behavior", 1, 0, 0, 12)),
    (15, ("HIGH_RISK", "SUSPENDED_24H", "High strike threshold exceeded", 0, 1, 0, 13)),
    (24, ("HIGH_RISK", "SUSPENDED_24H", "High strike threshold exceeded", 0, 1, 0, 22)),
    (25, ("CRITICAL_RISK", "SUSPENDED_7D", "Critical repeat offender", 0, 3, 0, 23)),
])
def test_tiers(evaluate, score, expected):
    assert values(evaluate(("2024-01-01", "D1", score)), *ds.TIER_COLUMNS, "strike_decay_score") == [expected]


def test_upsert(evaluate, empty):
    once = ds.merge_state(empty, evaluate(("2024-01-01", "D1", 25), ("2024-01-01", "D2", 1)), T1)
    assert [(f.name, f.dataType) for f in once.schema] == [(f.name, f.dataType) for f in DRIVER_RISK_STATE]
    twice = ds.merge_state(once, evaluate(("2024-01-01 00:30:00", "D1", 9), ("2024-01-01", "D3", 0)), T2)
    assert values(twice, "driver_id", "total_strike_score", "risk_category", "cooldown_until",
                  "suspension_count", "total_overspeed_events", "last_event_ts", "updated_ts") == [
        ("D1", 34, "MEDIUM_RISK", at(T3), 0, 2, at(T1), at(T2)),
        ("D2", 1, "LOW_RISK", at(T2), 0, 1, at(T1), at(T1)),
        ("D3", 0, "LOW_RISK", at(T3), 0, 1, at(T2), at(T2))]


def test_latest_window_of_a_batch_decides(evaluate, empty):
    rows = [("2024-01-01 00:30:00", "D1", 3), ("2024-01-01 00:00:00", "D1", 30)]
    state = ds.merge_state(empty, evaluate(*rows), T1)
    assert values(state, "total_strike_score", "risk_category", "total_restricted_zone_events") == [
        (33, "LOW_RISK", 4)]
    assert ds.evaluation_audit(evaluate(*rows)).count() == 2


def test_cooldown_by_tier(evaluate, empty):
    rows = evaluate(("2024-01-01", "D1", 25), ("2024-01-01", "D2", 15))
    state = ds.merge_state(empty, rows, T1, cooldown_by_tier=True)
    assert values(state, "driver_id", "cooldown_until") == [
        ("D1", at("2024-02-08 08:00:00")), ("D2", at(T2))]


def test_null_driver(evaluate, empty):
    rows = [("2024-01-01", None, 5), ("2024-01-01", "D1", 5)]
    assert values(ds.merge_state(empty, evaluate(*rows), T1), "driver_id") == [("D1",)]
    kept = ds.merge_state(empty, evaluate(*rows, keep_null_driver=True), T1)
    kept = ds.merge_state(kept, evaluate(*rows, keep_null_driver=True), T2)
    assert values(kept, "driver_id", "total_strike_score") == [(None, 10), ("D1", 10)]


def test_audit_previous_status(evaluate, empty):
    state = ds.merge_state(empty, evaluate(("2024-01-01", "D1", 16)), T1)
    batch = evaluate(("2024-01-01 00:30:00", "D1", 8), ("2024-01-01 00:30:00", "D2", 1))
    assert values(ds.evaluation_audit(batch)) == [
        ("D1", "RISK_EVALUATION", "ACTIVE", "WARNING", 8, "Moderate risk behavior"),
        ("D2", "RISK_EVALUATION", "ACTIVE", "ACTIVE", 1, None)]
    assert values(ds.evaluation_audit(batch, state), "driver_id", "previous_status") == [
        ("D1", "SUSPENDED_24H"), ("D2", "ACTIVE")]


def test_decay_stops_at_zero(evaluate, empty):
    state = ds.merge_state(empty, evaluate(("2024-01-01", "D1", 9), ("2024-01-01", "D2", 0)), T1)
    decayed = ds.decay_strikes(state, T2)
    assert values(decayed, "driver_id", "total_strike_score", "strike_decay_score", "updated_ts") == [
        ("D1", 8, 6, at(T2)), ("D2", 0, 0, at(T2))]
    assert values(ds.decay_audit(decayed)) == [
        ("D1", "STRIKE_DECAY", "WARNING", "WARNING", 8, "Automated strike decay applied"),
        ("D2", "STRIKE_DECAY", "ACTIVE", "ACTIVE", 0, "Automated strike decay applied")]


def test_reinstatement(evaluate, empty):
    state = ds.merge_state(empty, evaluate(("2024-01-01", "D1", 16), ("2024-01-01", "D2", 0)), T1)
    state = ds.merge_state(state, evaluate(("2024-01-01", "D3", 25)), T2)
    state = state.unionByName(state.filter("driver_id = 'D3'").withColumns(
        {"driver_id": F.lit("D4"), "cooldown_until": F.lit(None).cast("timestamp")}))
    after = ds.reinstate(state, T2)
    assert values(after, "driver_id", "suspension_status", "suspension_reason", "risk_category",
                  "total_strike_score", "reinstatement_eligible", "updated_ts") == [
        ("D1", "ACTIVE", None, "HIGH_RISK", 16, 1, at(T2)),
        ("D2", "ACTIVE", None, "LOW_RISK", 0, 1, at(T1)),
        ("D3", "SUSPENDED_7D", "Critical repeat offender", "CRITICAL_RISK", 25, 0, at(T2)),
        ("D4", "SUSPENDED_7D", "Critical repeat offender", "CRITICAL_RISK", 25, 0, at(T2))]
    assert values(ds.reinstatement_audit(after), "driver_id", "previous_status", "new_status") == [
        ("D1", "ACTIVE", "ACTIVE"), ("D2", "ACTIVE", "ACTIVE")]
    assert values(ds.reinstatement_changes_audit(state, T2), "driver_id", "previous_status") == [
        ("D1", "SUSPENDED_24H")]


# --- store

SCORED = ("event_time TIMESTAMP, driver_id STRING, speed INT, overspeed_flag INT, "
          "restricted_zone_flag INT, strike_score INT")


def events(frame, driver, times, score=3):
    return frame(SCORED, [(at(t), driver, 120, 1, 1, score) for t in times])


def test_window_that_fills_over_batches_counts_once(spark, folder, frame):
    store = DriverStateStore(spark, folder)
    minutes = [f"2024-01-01 00:{m:02d}:00" for m in range(9)]
    for batch in range(3):
        store.apply_events(events(frame, "D1", minutes[3 * batch:3 * batch + 3]), batch, T1)
    state = values(store.read_state(), "driver_id", "total_strike_score", "risk_category",
                   "total_overspeed_events")
    # rated by the total of the window so far
    assert state == [("D1", 27, "CRITICAL_RISK", 9)]
    assert values(store.read_audit(), "strike_score", "new_status") == [
        (18, "SUSPENDED_24H"), (27, "SUSPENDED_7D"), (9, "WARNING")]
    assert values(store.read_ledger(), "total_strike_score", "added_strike_score", "touched_batch") == [
        (27, 9, 2)]


def test_adding_totals_as_emitted_counts_again(spark, folder, frame):
    store = DriverStateStore(spark, folder)
    for batch, total in enumerate((120, 240, 360)):
        rows = frame(WINDOW, [(at("2024-01-01"), "D1", total, 0, 0)])
        store.apply_window_totals(rows, batch, T1)
    assert values(store.read_state(), "total_strike_score") == [(720,)]


def test_batch_applied_twice_changes_nothing(spark, folder, frame):
    store = DriverStateStore(spark, folder)
    batch = events(frame, "D1", ["2024-01-01 00:00:00"])
    store.apply_events(batch, 0, T1)
    store.apply_events(batch, 0, T2)
    store.apply_window_totals(frame(WINDOW, [(at("2024-01-01"), "D1", 5, 0, 0)]), 0, T2)
    assert values(store.read_state(), "total_strike_score", "updated_ts") == [(3, at(T1))]
    assert store.read_audit().count() == 1


def test_closed_windows_leave_the_ledger(spark, folder, frame):
    store = DriverStateStore(spark, folder)
    for batch, hour in enumerate(range(0, 5)):
        store.apply_events(events(frame, "D1", [f"2024-01-01 {hour:02d}:00:00"]), batch, T1)
    # the newest event known two batches ago was 02:00, so windows to 01:50 are closed
    starts = values(store.read_ledger().selectExpr("CAST(window_start AS STRING) AS s"))
    assert starts == [("2024-01-01 02:00:00",), ("2024-01-01 03:00:00",), ("2024-01-01 04:00:00",)]
    assert values(store.read_state(), "total_strike_score") == [(15,)]


def test_upkeep_between_batches(spark, folder, frame):
    store = DriverStateStore(spark, folder)
    store.apply_events(events(frame, "D1", [f"2024-01-01 00:00:{s:02d}" for s in range(6)]), 0, T1)
    store.reinstate(T2)
    store.decay(T2)
    assert values(store.read_state(), "total_strike_score", "suspension_status") == [(17, "ACTIVE")]
    store.apply_events(events(frame, "D1", ["2024-01-01 00:01:00"]), 1, T3)
    assert values(store.read_state(), "total_strike_score", "suspension_status") == [
        (20, "SUSPENDED_24H")]
    assert values(store.read_audit(), "event_type", "previous_status", "strike_score") == [
        ("AUTO_REINSTATEMENT", "ACTIVE", 18), ("RISK_EVALUATION", "ACTIVE", 18),
        ("RISK_EVALUATION", "ACTIVE", 21), ("STRIKE_DECAY", "ACTIVE", 17)]


def test_reinstatement_audit_of_changes_only(spark, folder, frame):
    store = DriverStateStore(spark, folder)
    store.apply_events(events(frame, "D1", [f"2024-01-01 00:00:{s:02d}" for s in range(6)]), 0, T1)
    store.apply_events(events(frame, "D2", ["2024-01-01 00:00:00"]), 1, T1)
    store.reinstate(T2, only_changed=True)
    got = store.read_audit().filter("event_type = 'AUTO_REINSTATEMENT'")
    assert values(got, "driver_id", "previous_status") == [("D1", "SUSPENDED_24H")]


def written(store):
    """Folders of the state: bucket and version of each."""
    return sorted((b, v) for b, versions in store._versions().items() for v, *_ in versions)


def test_only_touched_buckets_are_written(spark, folder, frame):
    """What a batch writes is in proportion to its drivers, not to all there are."""
    store = DriverStateStore(spark, folder, stream=StreamSettings(state_buckets=32))
    everyone = [(at("2024-01-01"), f"D{n}", 120, 1, 1, 3) for n in range(500)]
    store.apply_events(frame(SCORED, everyone), 0, T1)
    first = written(store)
    assert len(first) == 32
    store.apply_events(events(frame, "D7", ["2024-01-01 00:01:00"]), 1, T2)
    added = set(written(store)) - set(first)
    assert len(added) == 1 and {v for _, v in added} == {2}
    size = lambda b, v: sum(
        os.path.getsize(p) for p in glob.glob(f"{folder}/state/of=32/bucket={b}/version={v}/*.parquet"))
    assert sum(size(*p) for p in added) < 0.1 * sum(size(*p) for p in first)
    state = {r.driver_id: r.total_strike_score for r in store.read_state().collect()}
    assert state == {f"D{n}": 6 if n == 7 else 3 for n in range(500)}


def test_batch_that_died_half_way_is_completed(spark, folder, frame, monkeypatch):
    """Some buckets have the batch, others and the audit do not: each driver gets it once."""
    rows = [(at("2024-01-01"), f"D{n}", 120, 1, 1, 3) for n in range(50)]
    whole, broken = DriverStateStore(spark, f"{folder}/a"), DriverStateStore(spark, f"{folder}/b")
    for store in (whole, broken):
        store.apply_events(frame(SCORED, rows), 0, T1)
    whole.apply_events(frame(SCORED, rows), 1, T2)
    monkeypatch.setattr(DriverStateStore, "_write_audit", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        broken.apply_events(frame(SCORED, rows), 1, T2)
    monkeypatch.undo()
    for path, _ in [versions[-1][1:] for b, versions in broken._versions().items() if b % 2]:
        shutil.rmtree(path.removeprefix("file:"))  # these buckets were not reached
    assert len(set(values(broken.read_state(), "total_strike_score"))) == 2
    broken.apply_events(frame(SCORED, rows), 1, T2)
    assert values(broken.read_state()) == values(whole.read_state())
    assert values(broken.read_audit()) == values(whole.read_audit())


def test_repeated_upkeep_run_counts_once(spark, folder, frame):
    store = DriverStateStore(spark, folder)
    store.apply_events(events(frame, "D1", [f"2024-01-01 00:00:{s:02d}" for s in range(6)]), 0, T1)
    for run in (20240202, 20240202, 20240203):
        store.decay(T2, run=run)
    assert values(store.read_state(), "total_strike_score") == [(16,)]
    assert values(store.read_audit().filter("event_type = 'STRIKE_DECAY'"), "strike_score") == [(16,), (17,)]
    store.reinstate(T2, only_changed=True, run=1)
    files = written(store)
    store.reinstate(T3, only_changed=True, run=2)  # nobody is waiting: nothing is written
    assert written(store) == files


def test_state_equals_merge_of_all_batches(spark, folder, frame):
    """Random batches through the store, and window by window by the plain functions."""
    rng = random.Random(4)
    store, totals, state = DriverStateStore(spark, folder), {}, frame(DRIVER_RISK_STATE, [])
    for batch in range(6):
        rows = [(at("2024-01-01") + timedelta(minutes=20 * batch + rng.randrange(60)), f"D{rng.randrange(6)}",
                 120, rng.randrange(2), 0, rng.randrange(9)) for _ in range(25)]
        store.apply_events(frame(SCORED, rows), batch, T1, cooldown_by_tier=True)
        touched = {}
        for when, driver, _, over, zone, score in rows:
            start = when - timedelta(minutes=when.minute % 30)
            old = totals.get((start, driver), (0, 0, 0))
            totals[start, driver] = tuple(a + b for a, b in zip(old, (score, over, zone)))
            new = touched.get((start, driver), (0, 0, 0))
            touched[start, driver] = tuple(a + b for a, b in zip(new, (score, over, zone)))
        windows = [(*key, *totals[key], *added) for key, added in touched.items()]
        evaluated = ds.evaluate_windows(frame(
            WINDOW + ", added_strike_score BIGINT, added_overspeed_events BIGINT, "
            "added_restricted_zone_events BIGINT", windows))
        state = spark.createDataFrame(
            ds.merge_state(state, evaluated, T1, cooldown_by_tier=True).collect(), DRIVER_RISK_STATE)
    assert values(store.read_state()) == values(state)


def test_silent_sources_are_forgotten(spark, folder, frame):
    store = DriverStateStore(spark, folder)
    store.apply_events(events(frame, "D1", ["2024-01-01 00:00:00"]), 0, "2024-01-01 00:00:00", "old")
    store.apply_events(events(frame, "D1", ["2024-03-01 00:00:00"]), 0, "2024-03-01 00:00:00", "new")
    assert store.read_stored().selectExpr("map_keys(applied) AS k").first().k == ["new"]


def test_batches_without_drivers(spark, folder, frame):
    store = DriverStateStore(spark, folder)
    assert store.read_state().count() == store.read_audit().count() == store.read_ledger().count() == 0
    store.apply_events(frame(SCORED, []), 0, T1)
    store.apply_events(frame(SCORED, [(at("2024-01-01"), None, 1, 1, 1, 3)]), 1, T1)
    assert store.read_state().count() == 0 and store.has_applied(1)
