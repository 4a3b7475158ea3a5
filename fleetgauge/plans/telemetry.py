"""Telemetry events: parse, clean, enrich, score, aggregate.

Every function takes batch and streaming frames.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions import rules
from fleetgauge.functions.conversion import epoch_to_time, moment
from fleetgauge.operators.dedup import keep_one
from fleetgauge.operators.joins import spread_join
from fleetgauge.schemas import TELEMETRY
from fleetgauge.settings import RiskSettings, StreamSettings

# The columns of the event table, in order.
SAFETY_COLUMNS = (
    "driver_id", "vin", "speed", "rpm", "lat", "lon", "event_timestamp", "event_time",
    "daily_rate", "region", "overspeed_flag", "restricted_zone_flag", "strike_score",
    "risk_category", "adjusted_daily_rate", "processing_ts", "date", "hour",
)


def parse_telemetry(messages: DataFrame) -> DataFrame:
    """JSON messages (``value``, ``timestamp``) to columns. Bad JSON gives NULLs.

    The document goes through ``inline``, which no filter is pushed through: as
    a plain struct it would be parsed once per column that is read or tested.
    """
    document = F.from_json(F.col("value").cast("string"), TELEMETRY)
    return messages.select(F.inline(F.array(document)),
                           F.col("timestamp").alias("kafka_ingestion_ts"))


def clean_telemetry(events: DataFrame, settings: StreamSettings = StreamSettings()) -> DataFrame:
    """Complete events, each (vin, event_time) once, with a watermark."""
    complete = reduce(and_, [F.col(c).isNotNull() for c in TELEMETRY.names])
    timed = events.filter(complete).withColumn("event_time", epoch_to_time(F.col("event_timestamp")))
    if timed.isStreaming:
        timed = timed.withWatermark("event_time", settings.watermark_delay)
    return keep_one(timed, ["vin", "event_time"])


def enrich(events: DataFrame, assignments: DataFrame, salts: int = 1) -> DataFrame:
    """Driver, rate and region of the vehicle; NULL if it has no assignment.

    With ``salts``, the events of a vehicle are spread over so many tasks and each
    assignment is copied to all of them: for streams, whose joins Spark does not split
    at run time.
    """
    return spread_join(events, assignments, "vin", "event_time", salts)


def score_events(events: DataFrame, settings: RiskSettings = RiskSettings(),
                 as_of: datetime | str | Column | None = None) -> DataFrame:
    """Flags, strike score, risk category, adjusted rate and partition columns.

    A frame that already has ``restricted_zone_flag`` (from a zone table, see
    ``operators.geo.flag_zones``) keeps it.
    """
    flags = {"overspeed_flag": rules.overspeed_flag(F.col("speed"), settings)}
    if "restricted_zone_flag" not in events.columns:
        flags["restricted_zone_flag"] = rules.zone_flag(F.col("lat"), F.col("lon"), settings)
    flagged = events.withColumns(flags)
    scored = flagged.withColumn("strike_score", rules.strike_score(
        F.col("overspeed_flag"), F.col("restricted_zone_flag"), settings))
    score = F.col("strike_score")
    return scored.withColumns({
        "risk_category": rules.event_risk(score, settings),
        "adjusted_daily_rate": rules.adjusted_rate(F.col("daily_rate"), score, settings),
        "processing_ts": moment(as_of),
        "date": F.to_date("event_time"),
        "hour": F.hour("event_time"),
    })


def driver_safety_status(events: DataFrame, assignments: DataFrame,
                         settings: RiskSettings = RiskSettings(),
                         as_of: datetime | str | Column | None = None, salts: int = 1) -> DataFrame:
    """The event table, from clean events and current assignments."""
    return score_events(enrich(events, assignments, salts), settings, as_of).select(*SAFETY_COLUMNS)


def driver_risk_aggregates(scored: DataFrame,
                           settings: StreamSettings = StreamSettings()) -> DataFrame:
    """Event-time windows per driver. Vehicles without one share a NULL driver."""
    return scored.groupBy(F.window("event_time", settings.window_length), "driver_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.sum("overspeed_flag").alias("overspeed_events"),
        F.sum("restricted_zone_flag").alias("restricted_zone_events"),
        F.sum("strike_score").alias("total_strike_score"),
        F.avg("speed").alias("avg_speed"),
        F.max("speed").alias("max_speed"),
        F.max("event_time").alias("last_event_time"),
    )


def flatten_window(aggregates: DataFrame) -> DataFrame:
    """Window bounds as plain columns, for reports and keyed state."""
    rest = [c for c in aggregates.columns if c != "window"]
    return aggregates.select(F.col("window.start").alias("window_start"),
                             F.col("window.end").alias("window_end"), *rest)
