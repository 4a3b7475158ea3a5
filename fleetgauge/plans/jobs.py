"""Batch jobs over a folder of tables, in the order the data needs.

    raw/<table>/         CSV with header
    silver/<table>/      typed Parquet
    gold/<table>/        results; asset history and driver state are versioned
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from fleetgauge.plans import fuel, silver
from fleetgauge.plans.assets import active_fleet_snapshot
from fleetgauge.plans.publish import ReportSink, publish_reports
from fleetgauge.plans.reports import FleetTables, create_views, event_facts, rolled_up
from fleetgauge.plans.stores import AssetHistoryStore, DriverStateStore
from fleetgauge.schemas import RAW_COLUMNS
from fleetgauge.settings import PublishSettings, RiskSettings
from fleetgauge.sources.files import overwrite, read_raw, read_table
from fleetgauge.sources.scratch import staged

SILVER = {
    "vehicle_registry": silver.vehicle_registry,
    "vehicle_assignment": silver.vehicle_assignment,
    "fuel_transactions": silver.fuel_transactions,
    "maintenance_logs": silver.maintenance_logs,
}


class FleetWarehouse:
    def __init__(self, spark: SparkSession, root: str, settings: RiskSettings = RiskSettings()):
        self.spark, self.root, self.settings = spark, root.rstrip("/"), settings
        self.asset_history = AssetHistoryStore(spark, f"{self.root}/gold/asset_history_scd2")
        self.driver_state = DriverStateStore(spark, f"{self.root}/gold/driver_risk_state", settings)

    def silver(self, table: str) -> DataFrame:
        return read_table(self.spark, f"{self.root}/silver/{table}")

    def gold(self, table: str) -> DataFrame:
        return read_table(self.spark, f"{self.root}/gold/{table}")

    def refresh_silver(self, table: str) -> None:
        raw = read_raw(self.spark, f"{self.root}/raw/{table}", RAW_COLUMNS[table])
        overwrite(SILVER[table](raw), f"{self.root}/silver/{table}")

    def refresh_asset_history(self, as_of: datetime | str | None = None, **options) -> None:
        self.asset_history.merge(self.silver("vehicle_assignment"), as_of, **options)

    def refresh_fleet_snapshot(self) -> None:
        snapshot = active_fleet_snapshot(self.asset_history.read_current())
        overwrite(snapshot, f"{self.root}/gold/active_fleet_snapshot")

    def refresh_fuel_audit(self) -> None:
        """The refuels are staged, since both the baselines and the audit read them."""
        counted = fuel.audited_refuels(self.silver("fuel_transactions"),
                                       self.silver("maintenance_logs"), self.settings)
        with staged(counted, "refuels") as refuels:
            overwrite(fuel.flag_refuels(refuels, self.silver("vehicle_registry"), self.settings),
                      f"{self.root}/gold/fuel_efficiency_audit")

    def run_registry(self) -> None:
        """Yearly master data."""
        self.refresh_silver("vehicle_registry")

    def run_daily(self, as_of: datetime | str | None = None, **merge_options) -> None:
        """All silver tables, then what is built on them."""
        for table in ("vehicle_assignment", "fuel_transactions", "maintenance_logs"):
            self.refresh_silver(table)
        self.refresh_asset_history(as_of, **merge_options)
        self.refresh_fleet_snapshot()
        self.refresh_fuel_audit()

    def run_driver_upkeep(self, as_of: datetime | str | None = None) -> None:
        """Reinstatement, then decay."""
        self.driver_state.reinstate(as_of)
        self.driver_state.decay(as_of)

    def publish(self, sink: ReportSink, settings: PublishSettings = PublishSettings()) -> DataFrame:
        """The events are read once for the six summaries, and once to be passed through."""
        events = self.gold("driver_safety_status")
        with staged(rolled_up(event_facts(events)), "facts") as facts:
            create_views(FleetTables(events, facts, self.asset_history.read(),
                                     self.gold("active_fleet_snapshot")))
            return publish_reports(self.spark, sink, settings=settings)
