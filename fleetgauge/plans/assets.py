"""Versioned vehicle assignments (SCD type 2) and the active fleet snapshot."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.functions.conversion import moment
from fleetgauge.operators.dedup import keep_first
from fleetgauge.schemas import ASSET_HISTORY, ASSET_HISTORY_REQUIRED, require_columns

COMPARED = ("driver_id", "daily_rate", "region")
IN_TRANSIT = "IN-TRANSIT"
ARCHIVED = "ARCHIVED"


def assignment_snapshot(assignments: DataFrame, one_current_per_vin: bool = True) -> DataFrame:
    """The assignments that a merge compares with the current ones.

    By default the latest per vin (highest rate first on equal starts). With
    ``one_current_per_vin=False``, the highest rate per vin, driver and start:
    then a vin may have several current rows, which replace each other on
    every later merge.
    """
    typed = assignments.select(
        F.col("vin").cast("string").alias("vin"),
        F.col("driver_id").cast("string").alias("driver_id"),
        F.col("start_date").try_cast("date").alias("start_date"),
        F.col("end_date").try_cast("date").alias("end_date"),
        F.col("daily_rate").try_cast("double").alias("daily_rate"),
        F.col("region").cast("string").alias("region"),
    ).filter(F.col("vin").isNotNull())
    if one_current_per_vin:
        return keep_first(typed, ["vin"], [F.desc("start_date"), F.desc("daily_rate"),
                                           "driver_id", "end_date", "region"])
    return keep_first(typed, ["vin", "driver_id", "start_date"],
                      [F.desc("daily_rate"), "end_date", "region"])


def changed_assignments(snapshot: DataFrame, current: DataFrame,
                        null_safe: bool = False) -> DataFrame:
    """Snapshot rows whose vin is new or differs from any current row of the vin.

    Current rows are summed up per vin first (lowest and highest value of each
    compared column), so the join has one partner per row however many current
    rows a vin has. A change to or from NULL counts only if ``null_safe``.
    """
    facts = [F.count(F.lit(1)).alias("_rows")]
    for name in COMPARED:
        facts += [F.min(name).alias(f"_min_{name}"), F.max(name).alias(f"_max_{name}"),
                  F.count(name).alias(f"_known_{name}")]
    known = current.groupBy("vin").agg(*facts)
    joined = snapshot.join(known, "vin", "left")
    return joined.filter(F.col("_rows").isNull() | _differs(null_safe)).select(snapshot.columns)


def _differs(null_safe: bool) -> Column:
    """Whether a compared column has another value than some current row of the vin.

    Reads ``_rows`` and per column ``_min_``, ``_max_`` and ``_known_`` of the vin's current rows.
    """
    def one(name: str) -> Column:
        new, low, high = F.col(name), F.col(f"_min_{name}"), F.col(f"_max_{name}")
        other_value = (new != low) | (new != high)
        if not null_safe:
            return other_value
        held = F.col(f"_known_{name}")
        return F.when(new.isNull(), held > 0).otherwise((held < F.col("_rows")) | other_value)

    first, second, third = (one(name) for name in COMPARED)
    return first | second | third


def roll_forward(current: DataFrame, snapshot: DataFrame,
                 as_of: datetime | str | Column | None = None,
                 null_safe: bool = False) -> DataFrame:
    """Current rows (as they are, or archived if their vin changed) and new versions.

    A snapshot row is a new version if ``changed_assignments`` would return it. Both sides are read
    once and meet by vin in one pass: windows over the rows of a vin sum up its current rows,
    find the changed snapshot rows, and tell the current rows of it.
    """
    now = moment(as_of)
    archived = {
        "end_date": now.cast("date"), "status": F.lit(ARCHIVED), "record_end_ts": now,
        "is_current": F.lit(0), "change_type": F.lit("UPDATE"), "created_ts": now,
    }
    versions = snapshot.select(
        "vin", "driver_id", "start_date", "end_date", "daily_rate", "region",
        F.lit(IN_TRANSIT).alias("status"), now.alias("record_start_ts"),
        F.lit(None).cast("timestamp").alias("record_end_ts"), F.lit(1).alias("is_current"),
        F.lit("INSERT").alias("change_type"), now.alias("created_ts"),
        F.lit(True).alias("_new"))
    # partitioned as the snapshot is by its de-duplication, so that the union moves nothing again
    held = current.repartition("vin").select(*ASSET_HISTORY.names, F.lit(False).alias("_new"))
    of_vin, old = Window.partitionBy("vin"), ~F.col("_new")
    facts = {"_rows": F.count(F.when(old, 1)).over(of_vin)}
    for name in COMPARED:
        value = F.when(old, F.col(name))
        facts |= {f"_min_{name}": F.min(value).over(of_vin), f"_max_{name}": F.max(value).over(of_vin),
                  f"_known_{name}": F.count(value).over(of_vin)}
    changed = F.coalesce((F.col("_rows") == 0) | _differs(null_safe), F.lit(False))
    rows = (
        held.unionByName(versions).withColumns(facts)
        .withColumn("_changed", F.col("_new") & changed)
        .withColumn("_replaced", F.bool_or("_changed").over(of_vin))
        .filter(old | F.col("_changed"))
    )
    gone = old & F.col("_replaced")
    return rows.select(*[
        F.when(gone, archived[c]).otherwise(F.col(c)).alias(c) if c in archived else c
        for c in ASSET_HISTORY.names
    ])


def is_current() -> Column:
    return F.col("is_current") == 1


def merge_asset_history(history: DataFrame, assignments: DataFrame,
                        as_of: datetime | str | Column | None = None,
                        one_current_per_vin: bool = True, null_safe: bool = False,
                        drop_copies: bool = True) -> DataFrame:
    """The whole history after one more snapshot.

    Archived rows pass through without a join. ``drop_copies`` removes rows that
    are equal in every column, which needs a shuffle of the whole history; rows
    written by this function have none.
    """
    snapshot = assignment_snapshot(assignments, one_current_per_vin)
    current = history.filter(is_current())
    past = history.filter(~is_current() | F.col("is_current").isNull())
    rolled = roll_forward(current, snapshot, as_of, null_safe)
    merged = past.select(ASSET_HISTORY.names).unionByName(rolled)
    require_columns(merged, ASSET_HISTORY_REQUIRED)
    return merged.dropDuplicates() if drop_copies else merged


def current_assignments(history: DataFrame) -> DataFrame:
    """The dimension that telemetry is joined to."""
    return history.filter(is_current()).select("vin", "driver_id", "daily_rate", "region")


def active_fleet_snapshot(history: DataFrame) -> DataFrame:
    """Vehicles in transit per region and driver."""
    return (history.filter(F.col("status") == IN_TRANSIT).groupBy("region", "driver_id")
            .agg(F.count_distinct("vin").alias("active_vehicle_count")))
