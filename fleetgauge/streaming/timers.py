"""Driver state kept by Spark itself: a row per driver in the state store, cooldowns as timers.

Windows close by the watermark in the JVM; Python sees one row for each closed window of a
driver, and gives numbers for each change: times and texts are made of them in the JVM. There is
no ledger and no job over all drivers: a cooldown that ends wakes its driver. Times are those of the events: a window is rated at its end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from fleetgauge.operators.joins import stream_join_side
from fleetgauge.plans.telemetry import driver_risk_aggregates, enrich, score_events
from fleetgauge.schemas import (
    BIGINT,
    DRIVER_RISK_STATE,
    STRING,
    SUSPENSION_EVENT_HISTORY,
    TIMESTAMP,
    table,
)
from fleetgauge.settings import RiskSettings, StreamSettings
from fleetgauge.streaming.queries import clean_stream

#: The state of a driver after each change, and what changed it.
CHANGES: StructType = table(
    **{f.name: f.dataType for f in DRIVER_RISK_STATE}, event_type=STRING, previous_status=STRING,
    strike_score=BIGINT, changed_ts=TIMESTAMP, step=BIGINT)

#: What the workers know of a change; times in milliseconds, ``tier`` an index, highest first.
#: ``lifted`` is set by a cooldown that ended, ``active`` also by the lowest tier.
STEPS = ("driver_id string, total long, over long, zone long, tier int, active boolean, decay long, "
         "cooldown long, first long, changed long, step long, lifted boolean, score long")

# Event types and reasons of the audit log.
EVALUATION, REINSTATEMENT = "RISK_EVALUATION", "AUTO_REINSTATEMENT"


def driver_changes(windows: DataFrame, settings: RiskSettings = RiskSettings(),
                   cooldown_seconds: int | None = None) -> DataFrame:
    """A stream of ``CHANGES`` from a stream of closed windows (``ended``, watermarked, driver and totals).

    Each closed window adds its score and sets the tier of its driver, and starts a cooldown of
    ``cooldown_seconds``, or of the days of its tier. A cooldown that ends before the next
    window closes makes a driver active that is not. Windows of one driver that close in one
    micro-batch, and cooldowns that end between them, are taken in the order of their times.
    """
    # plain values, since workers need not have this library
    tiers = [asdict(t) for t in sorted(settings.tiers, key=lambda t: -t.floor)] + [
        asdict(settings.lowest_tier)]
    allowance = settings.decay_allowance
    held = ("total int, over int, zone int, tier int, active boolean, decay int, cooldown long, "
            "first long, changed long, step int").replace(" int", " long")
    change = Row(*[field.split()[0] for field in STEPS.split(", ")])

    class Drivers(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.state = handle.getValueState("driver", held)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            now = self.state.get()
            now = list(now) if now else None
            for row in sorted(rows, key=lambda r: r["end"]):
                end = row["end"]
                if now and not now[4] and now[6] <= end:
                    now = _active(now)
                    yield _change(key, now, True)
                score = row["total_strike_score"]
                tier = next((i for i, t in enumerate(tiers) if score >= t["floor"]), len(tiers) - 1)
                wait = cooldown_seconds if cooldown_seconds is not None else (
                    86400 * tiers[tier]["cooldown_days"])
                old = now or [0, 0, 0, 0, True, 0, 0, end, 0, 0]
                now = [old[0] + score, old[1] + row["overspeed_events"],
                       old[2] + row["restricted_zone_events"], tier,
                       tiers[tier]["suspension_status"] == "ACTIVE", max(score - allowance, 0),
                       end + 1000 * wait, old[7], end, old[9] + 1]
                yield _change(key, now, False, score)
            if now and not now[4]:
                if now[6] <= timerValues.getCurrentWatermarkInMs():
                    now = _active(now)
                    yield _change(key, now, True)
                else:
                    self.handle.registerTimer(now[6])
            self.state.update(tuple(now))

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            now = list(self.state.get())
            # a window that closed since has set another cooldown, with a timer of its own
            if not now[4] and now[6] == expiredTimerInfo.getExpiryTimeInMs():
                now = _active(now)
                self.state.update(tuple(now))
                yield _change(key, now, True)

        def close(self) -> None:
            pass

    def _active(now: list) -> list:
        return [*now[:4], True, now[5], now[6], now[7], now[6], now[9] + 1]

    def _change(key, now: list, lifted: bool, score: int | None = None) -> Row:
        return change(key[0], *now, lifted, now[0] if score is None else score)

    known = windows.filter(F.col("driver_id").isNotNull()).select(
        "ended", F.unix_millis("window_end").alias("end"), "driver_id", "total_strike_score",
        "overspeed_events", "restricted_zone_events")
    steps = known.groupBy("driver_id").transformWithState(
        statefulProcessor=Drivers(), outputStructType=STEPS, outputMode="append", timeMode="eventtime")
    return _changes_of(steps, tiers)


def _changes_of(steps: DataFrame, tiers: list[dict]) -> DataFrame:
    """``STEPS`` with the texts of the tiers, as ``CHANGES``."""
    rated = F.get(F.array(*[F.struct(*[F.lit(t[name]).alias(name) for name in (
        "risk_category", "suspension_status", "warning_count", "suspension_count",
        "reinstatement_eligible")], F.lit(t["suspension_reason"]).cast("string").alias("suspension_reason"))
        for t in tiers]), F.col("tier"))
    lifted, status = F.col("lifted"), rated["suspension_status"]
    active, changed = F.lit("ACTIVE"), F.timestamp_millis("changed")
    values = {
        "driver_id": F.col("driver_id"), "total_strike_score": F.col("total"),
        "risk_category": rated["risk_category"],
        "suspension_status": F.when(lifted, active).otherwise(status),
        "suspension_reason": F.when(~lifted, rated["suspension_reason"]),
        "cooldown_until": F.timestamp_millis("cooldown"), "warning_count": rated["warning_count"],
        "suspension_count": rated["suspension_count"],
        "reinstatement_eligible": F.when(lifted, 1).otherwise(rated["reinstatement_eligible"]),
        "strike_decay_score": F.col("decay"), "total_overspeed_events": F.col("over"),
        "total_restricted_zone_events": F.col("zone"), "last_event_ts": F.timestamp_millis("first"),
        "updated_ts": changed,
        "event_type": F.when(lifted, REINSTATEMENT).otherwise(EVALUATION),
        "previous_status": F.when(lifted, status).otherwise(active),
        "strike_score": F.col("score"), "changed_ts": changed, "step": F.col("step")}
    return steps.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in CHANGES])


def closed_windows(messages: DataFrame, assignments: DataFrame, settings: RiskSettings = RiskSettings(),
                   stream: StreamSettings = StreamSettings()) -> DataFrame:
    """The windows of each driver, each once, when the watermark has passed its end."""
    dimension, salts = stream_join_side(assignments, stream.broadcast_rows, stream.join_salts)
    scored = score_events(enrich(clean_stream(messages, stream), dimension, salts), settings)
    return driver_risk_aggregates(scored, stream).select(
        F.window_time("window").alias("ended"), F.col("window.end").alias("window_end"), "driver_id",
        "total_strike_score", "overspeed_events", "restricted_zone_events")


def start_driver_changes(messages: DataFrame, assignments: DataFrame, path: str, checkpoint: str,
                         settings: RiskSettings = RiskSettings(), stream: StreamSettings = StreamSettings(),
                         cooldown_seconds: int | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Every change of a driver's state to Parquet. Needs state in RocksDB (``use_rocksdb_state``)."""
    windows = closed_windows(messages, assignments, settings, stream)
    return (
        driver_changes(windows, settings, cooldown_seconds)
        .writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": stream.aggregate_trigger}))
        .queryName("driver_changes").start()
    )


def state_of(changes: DataFrame) -> DataFrame:
    """The present state: the last change of each driver."""
    last = changes.groupBy("driver_id").agg(
        F.max_by(F.struct(*DRIVER_RISK_STATE.names), "step").alias("s"))
    return last.select("s.*")


def audit_of(changes: DataFrame) -> DataFrame:
    """The changes as rows of the audit log."""
    reason = F.when(F.col("event_type") == REINSTATEMENT, "Cooldown expired").otherwise(
        F.col("suspension_reason"))
    return changes.withColumns({"new_status": F.col("suspension_status"), "event_reason": reason}).select(
        SUSPENSION_EVENT_HISTORY.names)
