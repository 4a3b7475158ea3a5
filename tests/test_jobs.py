"""From raw CSV to published reports in one folder."""

from conftest import values

from fleetgauge.plans import telemetry as tm
from fleetgauge.plans.assets import current_assignments
from fleetgauge.plans.jobs import FleetWarehouse
from fleetgauge.plans.publish import ParquetReports
from fleetgauge.sources.files import overwrite
from samples.queries import gold_fuel_efficiency
from samples.tables import FleetSample

FOLDER = "/root/testdata/sf0.001"


def test_daily_run(spark, folder):
    sample = FleetSample(spark, FOLDER)
    for table, raw in {"vehicle_registry": sample.raw_registry(), "vehicle_assignment": sample.raw_assignment(),
                       "fuel_transactions": sample.raw_fuel(), "maintenance_logs": sample.raw_maintenance()}.items():
        raw.write.option("header", True).csv(f"{folder}/raw/{table}")
    fleet = FleetWarehouse(spark, folder)
    fleet.run_registry()
    fleet.run_daily("2024-02-01 08:00:00")
    audit = fleet.gold("fuel_efficiency_audit").selectExpr(
        "vin", "model", "audit_date", "kmpl", "round(baseline_kmpl, 6) AS baseline_kmpl", "status")
    assert values(audit) == values(gold_fuel_efficiency(spark, FOLDER))
    history = values(fleet.asset_history.read())
    fleet.run_daily("2024-02-02 08:00:00")
    assert values(fleet.asset_history.read()) == history, "the same input again is no change"
    assert fleet.gold("active_fleet_snapshot").count() > 0

    dimension = current_assignments(fleet.asset_history.read_current())
    events = tm.driver_safety_status(tm.clean_telemetry(sample.events()), dimension)
    overwrite(events, f"{folder}/gold/driver_safety_status", ["date", "hour"])
    fleet.driver_state.apply_events(events, 0, "2024-02-02 08:00:00")
    fleet.run_driver_upkeep("2024-02-09 08:00:00")
    kinds = {r.event_type for r in fleet.driver_state.read_audit().select("event_type").distinct().collect()}
    assert kinds == {"RISK_EVALUATION", "AUTO_REINSTATEMENT", "STRIKE_DECAY"}
    assert values(fleet.driver_state.read_state().select("suspension_status").distinct()) == [("ACTIVE",)]

    log = fleet.publish(ParquetReports(spark, f"{folder}/published"))
    assert [r.status for r in log.collect()] == ["published"] * 9
