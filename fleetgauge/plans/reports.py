"""Summary reports over the event table, the asset history and the fleet snapshot."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions import rules
from fleetgauge.settings import RiskSettings


FACT_KEYS = ("driver_id", "vin", "region", "date", "hour", "overspeed_flag",
             "restricted_zone_flag", "risk_category")
FACTS = {"events": F.sum, "speed_sum": F.sum, "max_speed": F.max, "strike_sum": F.sum,
         "first_event_time": F.min, "last_event_time": F.max}


def event_facts(safety_status: DataFrame) -> DataFrame:
    """The event table as facts: keys and values that can be aggregated in steps."""
    speed, time = F.col("speed"), F.col("event_time")
    return safety_status.select(
        *FACT_KEYS, F.lit(1).cast("bigint").alias("events"),
        speed.cast("bigint").alias("speed_sum"), speed.alias("max_speed"),
        F.col("strike_score").cast("bigint").alias("strike_sum"),
        time.alias("first_event_time"), time.alias("last_event_time"),
    )


def rolled_up(facts: DataFrame) -> DataFrame:
    """Facts of one row per vehicle, hour and kind of event, for several reports to read."""
    return facts.groupBy(*FACT_KEYS).agg(*[f(name).alias(name) for name, f in FACTS.items()])


@dataclass(frozen=True)
class FleetTables:
    """What reports read. ``facts`` may be rolled up. Tables no report needs may be None."""

    safety_status: DataFrame | None
    facts: DataFrame | None
    asset_history: DataFrame | None
    fleet_snapshot: DataFrame | None


def active_vehicle_snapshot(tables: FleetTables) -> DataFrame:
    return tables.fleet_snapshot


def asset_history(tables: FleetTables) -> DataFrame:
    return tables.asset_history


def driver_safety(tables: FleetTables) -> DataFrame:
    # the event table also holds the stream and batch that wrote a row
    return tables.safety_status.drop("stream_id", "batch_id")


def _events() -> Column:
    return F.sum("events")


def _events_where(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("events")).otherwise(0))


def _avg_speed() -> Column:
    return F.try_divide(F.sum("speed_sum"), F.sum("events"))


def _strikes() -> Column:
    return F.sum("strike_sum")


def _overspeed() -> Column:
    return F.col("overspeed_flag") == 1


def _in_zone() -> Column:
    return F.col("restricted_zone_flag") == 1


def overspeed_summary(tables: FleetTables) -> DataFrame:
    return tables.facts.filter(_overspeed()).groupBy("driver_id", "vin").agg(
        _events().alias("overspeed_events"), F.max("max_speed").alias("max_speed"),
        _avg_speed().alias("avg_speed"))


def restricted_zone_summary(tables: FleetTables) -> DataFrame:
    return tables.facts.filter(_in_zone()).groupBy("driver_id", "vin").agg(
        _events().alias("zone_events"), F.min("first_event_time").alias("first_event_time"),
        F.max("last_event_time").alias("last_event_time"))


def driver_risk_score(tables: FleetTables, settings: RiskSettings = RiskSettings()) -> DataFrame:
    totals = tables.facts.groupBy("driver_id").agg(
        _events().alias("total_events"), _events_where(_overspeed()).alias("overspeed_events"),
        _events_where(_in_zone()).alias("restricted_zone_events"),
        _strikes().alias("total_strike_score"))
    tier = rules.by_tier(F.col("total_strike_score"), "risk_category", settings)
    return totals.withColumn("risk_category", tier)


def hourly_overspeed_trend(tables: FleetTables) -> DataFrame:
    return tables.facts.groupBy("date", "hour").agg(
        _events().alias("total_events"), _events_where(_overspeed()).alias("overspeed_events"))


def driver_behavior_trend(tables: FleetTables) -> DataFrame:
    return tables.facts.groupBy("driver_id", "date").agg(
        _avg_speed().alias("avg_speed"), F.max("max_speed").alias("max_speed"),
        _strikes().alias("total_strike_score"))


def fleet_risk_trend(tables: FleetTables) -> DataFrame:
    def in_category(category: str) -> Column:
        return _events_where(F.col("risk_category") == category)

    return tables.facts.groupBy("date", "region").agg(
        in_category("LOW_RISK").alias("low_risk_events"),
        in_category("MEDIUM_RISK").alias("medium_risk_events"),
        in_category("HIGH_RISK").alias("high_risk_events"),
        _strikes().alias("total_strike_score"))


@dataclass(frozen=True)
class Report:
    view: str
    target: str
    build: Callable[[FleetTables], DataFrame]


# View names and the names of the tables they are published to.
REPORTS = (
    Report("vw_active_vehicle_snapshot", "active_vehicle_snapshot", active_vehicle_snapshot),
    Report("vw_overspeed_summary", "overspeed_report", overspeed_summary),
    Report("vw_restricted_zone_summary", "restricted_zone_report", restricted_zone_summary),
    Report("vw_driver_risk_score", "driver_risk_report", driver_risk_score),
    Report("vw_hourly_overspeed_trend", "hourly_overspeed_trend", hourly_overspeed_trend),
    Report("vw_driver_behavior_trend", "driver_behavior_report", driver_behavior_trend),
    Report("vw_fleet_risk_trend", "fleet_risk_report", fleet_risk_trend),
    Report("vw_asset_history", "asset_history_report", asset_history),
    Report("vw_driver_safety", "driver_safety_status", driver_safety),
)


def create_views(tables: FleetTables) -> None:
    """Temporary views under the report names."""
    for report in REPORTS:
        report.build(tables).createOrReplaceTempView(report.view)
