"""Properties of physical plans that must hold at any size."""

import re

import pytest
from conftest import plan_of

from fleetgauge.plans import assets, fuel, reports, silver
from fleetgauge.plans import telemetry as tm
from fleetgauge.plans.stores import AssetHistoryStore
from samples.queries import QUERIES
from samples.tables import FIRST_SNAPSHOT_END, FleetSample

FOLDER = "/root/testdata/sf0.001"
LAZY = sorted(q for q in QUERIES if q != "publish_reports" and not q.startswith("stream_"))


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_no_python_no_single_partition(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert not re.search("Cartesian|NestedLoop|EvalPython|InPandas|InArrow", plan)
    # a profile is one row, so its last step is one task
    if name != "quality_profile":
        assert "SinglePartition" not in plan


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("gold"))
    sample = FleetSample(spark, FOLDER)
    store = AssetHistoryStore(spark, f"{root}/history")
    store.merge(sample.assignment_snapshot(FIRST_SNAPSHOT_END), "2024-01-01 00:00:00")
    store.merge(sample.assignment_snapshot(), "2024-01-02 00:00:00")
    store.read().write.parquet(f"{root}/whole_history")
    events = tm.driver_safety_status(tm.clean_telemetry(sample.events()), sample.dimension())
    events.write.partitionBy("date", "hour").parquet(f"{root}/events")
    silver.fuel_transactions(sample.raw_fuel()).write.parquet(f"{root}/fuel")
    silver.maintenance_logs(sample.raw_maintenance()).write.parquet(f"{root}/maintenance")
    return root


def scan(df) -> str:
    return " ".join(re.findall(r"FileScan[^\n]*", df._jdf.queryExecution().executedPlan().toString()))


def test_filters_and_columns_reach_the_scan(spark, gold):
    history = spark.read.parquet(f"{gold}/whole_history")
    dimension = scan(assets.current_assignments(history))
    assert "EqualTo(is_current,1)" in dimension
    assert "ReadSchema: struct<vin:string,driver_id:string,daily_rate:double,region:string,is_current:int>" in dimension
    assert "EqualTo(status,IN-TRANSIT)" in scan(assets.active_fleet_snapshot(history))


def test_reports_read_their_columns_and_partitions(spark, gold):
    events = spark.read.parquet(f"{gold}/events").filter("date = DATE'2024-01-01' AND hour = 0")
    tables = reports.FleetTables(events, reports.event_facts(events), None, None)
    plan = scan(reports.overspeed_summary(tables))
    assert "PartitionFilters: [isnotnull(date" in plan and "EqualTo(overspeed_flag,1)" in plan
    assert "ReadSchema: struct<driver_id:string,vin:string,speed:int,overspeed_flag:int>" in plan


def test_merge_does_not_read_the_archive(spark, gold):
    store = AssetHistoryStore(spark, f"{gold}/history")
    assert store.read().count() > store.read_current().count()
    files = store.read_current().inputFiles()
    assert files and all("/run=2/is_current=1" in f for f in files)


def test_refuels_are_shuffled_once_for_baselines_and_audit(spark, gold):
    registry = silver.vehicle_registry(FleetSample(spark, FOLDER).raw_registry())
    audit = fuel.fuel_efficiency(spark.read.parquet(f"{gold}/fuel"), registry,
                                 spark.read.parquet(f"{gold}/maintenance"))
    audit.collect()
    final = plan_of(audit).split("== Initial Plan ==")[0]
    scans = re.findall(r"FileScan parquet \[transaction_id", final)
    assert len(scans) == 1 and "ReusedExchange" in final


def test_aggregates_combine_before_the_shuffle(spark):
    sample = FleetSample(spark, FOLDER)
    events = tm.driver_safety_status(tm.clean_telemetry(sample.events()), sample.dimension())
    plan = plan_of(tm.driver_risk_aggregates(events))
    below = plan.split("Exchange hashpartitioning(window", 1)[1]
    assert "partial_sum(overspeed_flag" in below.split("Exchange", 1)[0]
