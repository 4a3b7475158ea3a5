"""Fuel efficiency audit against per-model baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.operators.sequence import with_previous
from fleetgauge.settings import RiskSettings

SUNDAY, SATURDAY = 1, 7


def audited_refuels(fuel: DataFrame, maintenance: DataFrame,
                    settings: RiskSettings = RiskSettings()) -> DataFrame:
    """Kilometres per litre of every refuel that counts: vin, date, kmpl.

    The distance is taken before refuels are excluded, so a refuel at a weekend
    or on a maintenance day still is the previous reading of the next one.
    """
    readings = fuel.filter(F.col("vin").isNotNull()).select(
        "vin", "event_time", "transaction_id", "odometer_reading", "fuel_liters")
    stepped = with_previous(
        readings, key="vin", time="event_time", value="odometer_reading",
        ties=["transaction_id", "odometer_reading", "fuel_liters"], output="prev_odo",
        piece=settings.sequence_piece,
    )
    distance = F.col("odometer_reading") - F.col("prev_odo")
    service_days = maintenance.select("vin", F.to_date("service_date").alias("date"))
    return (
        stepped.withColumn("date", F.to_date("event_time"))
        .filter(distance.isNotNull() & ~F.dayofweek("date").isin(SUNDAY, SATURDAY))
        .select("vin", "date", F.try_divide(distance, F.col("fuel_liters")).alias("kmpl"))
        .join(service_days, ["vin", "date"], "left_anti")
    )


def vehicle_baselines(refuels: DataFrame, registry: DataFrame) -> DataFrame:
    """Mean kmpl of each vehicle's model: vin, model, baseline_kmpl.

    Refuels are summed per vin before they meet the registry, so only rows of
    registry size are ever shuffled by model, of which there may be few.
    """
    vehicles = registry.select("vin", "model").filter(F.col("model").isNotNull())
    per_vin = refuels.groupBy("vin").agg(F.sum("kmpl").alias("_sum"), F.count("kmpl").alias("_n"))
    per_model = (
        vehicles.join(per_vin, "vin").groupBy("model")
        .agg(F.try_divide(F.sum("_sum"), F.sum("_n")).alias("baseline_kmpl"))
    )
    return vehicles.join(per_model, "model").select("vin", "model", "baseline_kmpl")


def flag_refuels(refuels: DataFrame, registry: DataFrame,
                 settings: RiskSettings = RiskSettings()) -> DataFrame:
    """The audit table. Vehicles without a model have no baseline and drop out."""
    baselines = vehicle_baselines(refuels, registry)
    too_low = F.col("kmpl") < F.col("baseline_kmpl") * settings.fuel_threshold_factor
    return refuels.join(baselines, "vin").select(
        "vin", "model", F.col("date").alias("audit_date"), "kmpl", "baseline_kmpl",
        F.when(too_low, "FLAGGED").otherwise("OK").alias("status"),
    )


def fuel_efficiency(fuel: DataFrame, registry: DataFrame, maintenance: DataFrame,
                    settings: RiskSettings = RiskSettings()) -> DataFrame:
    return flag_refuels(audited_refuels(fuel, maintenance, settings), registry, settings)
