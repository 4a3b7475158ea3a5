import random
from datetime import date, datetime

import pytest
from conftest import plan_of, values

from fleetgauge.plans import assets
from fleetgauge.plans.stores import AssetHistoryStore
from fleetgauge.schemas import ASSET_HISTORY

ASSIGNED = "vin STRING, driver_id STRING, start_date DATE, end_date DATE, daily_rate DOUBLE, region STRING"
T1, T2, T3 = "2024-02-01 08:00:00", "2024-02-02 08:00:00", "2024-02-03 08:00:00"
DAY = date(2024, 1, 1)


def row(vin, driver="D1", rate=10.0, region="N", start=DAY):
    return (vin, driver, start, None, rate, region)


@pytest.fixture
def empty(frame):
    return frame(ASSET_HISTORY, [])


@pytest.fixture
def snapshot(frame):
    return lambda *rows: frame(ASSIGNED, list(rows))


BRIEF = ("vin", "driver_id", "daily_rate", "status", "is_current", "change_type")


def test_first_run_inserts(empty, snapshot):
    merged = assets.merge_asset_history(empty, snapshot(row("V1"), row(None)), T1)
    assert merged.schema.names == ASSET_HISTORY.names
    assert [f.dataType for f in merged.schema] == [f.dataType for f in ASSET_HISTORY]
    got = merged.collect()
    assert len(got) == 1
    assert tuple(got[0]) == ("V1", "D1", DAY, None, 10.0, "N", "IN-TRANSIT",
                             datetime.fromisoformat(T1), None, 1, "INSERT",
                             datetime.fromisoformat(T1))


def test_change_archives_and_inserts(empty, snapshot):
    one = assets.merge_asset_history(empty, snapshot(row("V1"), row("V2"), row("V3")), T1)
    two = assets.merge_asset_history(
        one, snapshot(row("V1", "D2"), row("V2", start=date(2024, 1, 9)), row("V4")), T2)
    assert values(two, *BRIEF) == [
        ("V1", "D1", 10.0, "ARCHIVED", 0, "UPDATE"), ("V1", "D2", 10.0, "IN-TRANSIT", 1, "INSERT"),
        # a new start alone is no change, and an absent vehicle stays current
        ("V2", "D1", 10.0, "IN-TRANSIT", 1, "INSERT"), ("V3", "D1", 10.0, "IN-TRANSIT", 1, "INSERT"),
        ("V4", "D1", 10.0, "IN-TRANSIT", 1, "INSERT")]
    closed = two.filter("is_current = 0").first()
    assert (closed.end_date, closed.record_start_ts, closed.record_end_ts, closed.created_ts) == (
        date(2024, 2, 2), datetime.fromisoformat(T1), datetime.fromisoformat(T2),
        datetime.fromisoformat(T2))


def test_same_input_again_changes_nothing(empty, snapshot):
    rows = snapshot(row("V1"), row("V1", "D2", start=date(2024, 1, 5)), row("V2", rate=None))
    one = assets.merge_asset_history(empty, rows, T1)
    assert values(assets.merge_asset_history(one, rows, T2)) == values(one)


def test_latest_assignment_wins(snapshot):
    rows = snapshot(row("V1", "D1"), row("V1", "D2", start=date(2024, 1, 5)),
                    row("V1", "D3", 20.0, start=date(2024, 1, 5)),
                    row("V1", "D4", None, start=date(2024, 1, 5)), row("V1", "D5", start=None))
    assert values(assets.assignment_snapshot(rows), "driver_id") == [("D3",)]
    several = assets.assignment_snapshot(rows, one_current_per_vin=False)
    assert several.count() == 5


def test_highest_rate_per_assignment(snapshot):
    rows = snapshot(row("V1", rate=5.0), row("V1", rate=None), row("V1", rate=9.0))
    got = assets.assignment_snapshot(rows, one_current_per_vin=False)
    assert values(got, "daily_rate") == [(9.0,)]


def test_several_current_rows_replace_each_other(empty, snapshot):
    rows = snapshot(row("V1", "D1"), row("V1", "D2"))
    one = assets.merge_asset_history(empty, rows, T1, one_current_per_vin=False)
    two = assets.merge_asset_history(one, rows, T2, one_current_per_vin=False)
    assert (one.count(), two.count(), two.filter("is_current = 1").count()) == (2, 4, 2)


def test_null_changes(empty, snapshot):
    one = assets.merge_asset_history(empty, snapshot(row("V1", None), row("V2"), row("V3", None)), T1)
    later = snapshot(row("V1", "D1"), row("V2", None), row("V3", None))
    assert assets.merge_asset_history(one, later, T2).count() == 3
    safe = assets.merge_asset_history(one, later, T2, null_safe=True)
    assert values(safe.filter("is_current = 0"), "vin") == [("V1",), ("V2",)]


@pytest.mark.parametrize("null_safe", [False, True])
def test_change_detection_equals_pairwise_comparison(frame, null_safe):
    rng = random.Random(5)
    pick = lambda options: rng.choice(options)
    make = lambda: (f"V{rng.randrange(40)}", pick(["D1", "D2", None]), DAY, None,
                    pick([1.0, 2.0, None]), pick(["N", None]))
    new, old = [make() for _ in range(80)], [make() for _ in range(60)]

    def differ(a, b):
        if null_safe:
            return a != b
        return a is not None and b is not None and a != b

    expected = [n for n in new
                if not any(o[0] == n[0] for o in old)
                or any(o[0] == n[0] and any(differ(n[i], o[i]) for i in (1, 4, 5)) for o in old)]
    got = assets.changed_assignments(frame(ASSIGNED, new), frame(ASSIGNED, old), null_safe)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("one", [False, True])
def test_one_pass_merge_equals_row_by_row(frame, null_safe, one):
    rng = random.Random(6)
    pick = lambda options: rng.choice(options)
    make = lambda: (f"V{rng.randrange(25)}", pick(["D1", "D2", None]), pick([DAY, date(2024, 1, 9)]), None,
                    pick([1.0, 2.0, None]), pick(["N", None]))
    old = [make() for _ in range(50)]
    current = frame(ASSET_HISTORY, [r + ("IN-TRANSIT", datetime(2024, 1, 1), None, 1, "INSERT",
                                         datetime(2024, 1, 1)) for r in old])
    snapshot = assets.assignment_snapshot(frame(ASSIGNED, [make() for _ in range(60)]), one)
    changed = [tuple(r) for r in assets.changed_assignments(snapshot, current, null_safe).collect()]
    vins = {r[0] for r in changed}
    expected = ([r + ("IN-TRANSIT", 1) for r in changed]
                + [r[:3] + (date(2024, 2, 2),) + r[4:] + ("ARCHIVED", 0) if r[0] in vins
                   else r + ("IN-TRANSIT", 1) for r in old])
    got = assets.roll_forward(current, snapshot, T2, null_safe).select(
        *ASSET_HISTORY.names[:7], "is_current").collect()
    assert changed and sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_merge_moves_each_side_once(spark, folder, frame):
    frame(ASSIGNED, [row(f"V{i}") for i in range(50)]).write.parquet(f"{folder}/assigned")
    frame(ASSET_HISTORY, []).write.parquet(f"{folder}/history")
    rolled = assets.roll_forward(
        spark.read.parquet(f"{folder}/history"),
        assets.assignment_snapshot(spark.read.parquet(f"{folder}/assigned")), T1)
    plan = plan_of(rolled)
    assert plan.count("Exchange hashpartitioning(vin") == plan.count("Exchange") == 2
    assert plan.count("FileScan parquet") == 2 and "Join" not in plan


def test_history_invariants_over_many_merges(spark, folder, frame):
    rng = random.Random(11)
    store = AssetHistoryStore(spark, f"{folder}/history")
    pure, seen = frame(ASSET_HISTORY, []), set()
    for day, stamp in enumerate((T1, T2, T3)):
        rows = frame(ASSIGNED, [row(f"V{v}", f"D{rng.randrange(3)}", float(rng.randrange(2)))
                                for v in range(30) if rng.random() < 0.8])
        pure = assets.merge_asset_history(pure, rows, stamp)
        store.merge(rows, stamp)
        stored = values(store.read())
        assert stored == values(pure)
        current = [r for r in stored if r[9] == 1]
        assert len({r[0] for r in current}) == len(current)
        assert all(r[8] is not None and r[6] == "ARCHIVED" for r in stored if r[9] == 0)
        archived = {str(r) for r in stored if r[9] == 0}
        assert archived >= seen
        seen = archived
    assert store.merges.latest() == 3
    assert values(assets.current_assignments(store.read()), "vin") == values(store.read_current(), "vin")


def test_snapshot_counts_vehicles_once(frame):
    history = frame("vin STRING, region STRING, driver_id STRING, status STRING", [
        ("V1", "N", "D1", "IN-TRANSIT"), ("V1", "N", "D1", "IN-TRANSIT"), ("V2", "N", "D1", "IN-TRANSIT"),
        ("V3", "N", "D1", "ARCHIVED"), ("V4", None, None, "IN-TRANSIT")])
    assert values(assets.active_fleet_snapshot(history)) == [(None, None, 1), ("N", "D1", 2)]
