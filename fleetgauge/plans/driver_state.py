"""Keyed driver risk state: evaluation, upsert, decay, reinstatement, audit rows.

Functions take the state as a frame and return a frame; ``plans.stores`` keeps it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions import rules
from fleetgauge.functions.conversion import moment
from fleetgauge.schemas import DRIVER_RISK_STATE, SUSPENSION_EVENT_HISTORY, WINDOW_TOTALS
from fleetgauge.settings import RiskSettings

Moment = datetime | str | Column | None
ACTIVE = "ACTIVE"

# What one evaluated window adds to the state, and under which state column.
ADDED = {
    "added_strike_score": "total_strike_score",
    "added_overspeed_events": "total_overspeed_events",
    "added_restricted_zone_events": "total_restricted_zone_events",
}
# What the latest evaluated window sets in the state.
TIER_COLUMNS = ("risk_category", "suspension_status", "suspension_reason", "warning_count",
                "suspension_count", "reinstatement_eligible")
REPLACED = (*TIER_COLUMNS, "strike_decay_score", "cooldown_days")


def evaluate_windows(windows: DataFrame, settings: RiskSettings = RiskSettings(),
                     keep_null_driver: bool = False) -> DataFrame:
    """Suspension tier of every (window, driver) row, by the score of that window.

    ``windows`` has window_start, driver_id, total_strike_score, overspeed_events,
    restricted_zone_events and, if only part of these totals is new to the state,
    the ``added_*`` columns with that part.
    """
    score = F.col("total_strike_score")
    totals = {"added_strike_score": score, "added_overspeed_events": F.col("overspeed_events"),
              "added_restricted_zone_events": F.col("restricted_zone_events")}
    rows = windows if keep_null_driver else windows.filter(F.col("driver_id").isNotNull())
    return rows.withColumns({
        **{name: total for name, total in totals.items() if name not in windows.columns},
        **{name: rules.by_tier(score, name, settings) for name in TIER_COLUMNS},
        "strike_decay_score": rules.lowered(score, settings.decay_allowance),
        "cooldown_days": rules.by_tier(score, "cooldown_days", settings),
    })


def merge_state(state: DataFrame, evaluations: DataFrame, as_of: Moment = None,
                cooldown_by_tier: bool = False) -> DataFrame:
    """Upsert: scores and event counts are added, everything else is replaced.

    Several windows of a driver in one batch are summed, and the latest window
    decides the replaced columns. ``last_event_ts`` is set at insert only. The
    cooldown is one day for every tier unless ``cooldown_by_tier``.
    """
    now = moment(as_of)
    held = state.select("driver_id", F.struct(*state.columns).alias("old"))
    found = evaluations.select(
        "driver_id", *ADDED, F.struct(*REPLACED).alias("set"),
        F.struct("window_start", *REPLACED).alias("order"))
    # One aggregation joins both sides: a driver has one old row at most.
    merged = held.unionByName(found, allowMissingColumns=True).groupBy("driver_id").agg(
        F.max("old").alias("old"), *[F.sum(added).alias(added) for added in ADDED],
        F.max_by("set", "order").alias("set"))

    touched = F.col("set").isNotNull()
    days = F.col("set.cooldown_days") if cooldown_by_tier else F.lit(1)
    replaced = {name: F.col(f"set.{name}") for name in (*TIER_COLUMNS, "strike_decay_score")}
    replaced["cooldown_until"] = now + F.make_interval(days=days)
    replaced["updated_ts"] = now

    columns = {"driver_id": F.col("driver_id")}
    for added, total in ADDED.items():
        columns[total] = (F.coalesce(F.col(f"old.{total}"), F.lit(0))
                          + F.coalesce(F.col(added), F.lit(0)))
    for name, value in replaced.items():
        columns[name] = F.when(touched, value).otherwise(F.col(f"old.{name}"))
    columns["last_event_ts"] = F.when(F.col("old").isNull(), now).otherwise(
        F.col("old.last_event_ts"))
    return merged.select(*[columns[c].alias(c) for c in DRIVER_RISK_STATE.names])


def evaluation_audit(evaluations: DataFrame, previous_state: DataFrame | None = None) -> DataFrame:
    """One audit row per evaluated window.

    The previous status is recorded as ACTIVE, or, given ``previous_state``, as
    the status the driver had before the batch.
    """
    previous = F.lit(ACTIVE)
    if previous_state is not None:
        held = previous_state.select("driver_id", F.col("suspension_status").alias("_held"))
        evaluations = evaluations.join(held, "driver_id", "left")
        previous = F.coalesce("_held", F.lit(ACTIVE))
    return _audit(evaluations, "RISK_EVALUATION", previous, F.col("suspension_status"),
                  F.col("suspension_reason"))


def decay_strikes(state: DataFrame, as_of: Moment = None,
                  settings: RiskSettings = RiskSettings()) -> DataFrame:
    """Lower both scores of every driver, not below zero."""
    return state.withColumns({
        "total_strike_score": rules.lowered(F.col("total_strike_score"), settings.decay_step),
        "strike_decay_score": rules.lowered(F.col("strike_decay_score"), settings.decay_step),
        "updated_ts": moment(as_of),
    })


def decay_audit(decayed: DataFrame) -> DataFrame:
    """One row per driver with the score after the decay."""
    status = F.col("suspension_status")
    return _audit(decayed, "STRIKE_DECAY", status, status,
                  F.lit("Automated strike decay applied"))


def cooldown_over(as_of: Moment = None) -> Column:
    return (F.col("cooldown_until") <= moment(as_of)) & (F.col("suspension_status") != ACTIVE)


def reinstate(state: DataFrame, as_of: Moment = None) -> DataFrame:
    """Make drivers active whose cooldown is over. Scores and category stay."""
    over = cooldown_over(as_of)
    changes = {"suspension_status": F.lit(ACTIVE), "suspension_reason": F.lit(None).cast("string"),
               "reinstatement_eligible": F.lit(1), "updated_ts": moment(as_of)}
    return state.select(*[
        F.when(over, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else c
        for c in state.columns
    ])


def reinstatement_audit(reinstated: DataFrame) -> DataFrame:
    """One row per eligible driver, with the status after the reinstatement as previous."""
    eligible = reinstated.filter(F.col("reinstatement_eligible") == 1)
    return _audit(eligible, "AUTO_REINSTATEMENT", F.col("suspension_status"), F.lit(ACTIVE),
                  F.lit("Cooldown expired"))


def reinstatement_changes_audit(before: DataFrame, as_of: Moment = None) -> DataFrame:
    """Only the drivers that the reinstatement changes, with their true previous status."""
    return _audit(before.filter(cooldown_over(as_of)), "AUTO_REINSTATEMENT",
                  F.col("suspension_status"), F.lit(ACTIVE), F.lit("Cooldown expired"))


def _audit(rows: DataFrame, event: str, previous: Column, new: Column, reason: Column) -> DataFrame:
    columns = {"driver_id": F.col("driver_id"), "event_type": F.lit(event),
               "previous_status": previous, "new_status": new,
               "strike_score": F.col("total_strike_score"), "event_reason": reason}
    return rows.select(*[columns[c].alias(c) for c in SUSPENSION_EVENT_HISTORY.names])


# The stored state: a row per driver with its open windows, so that a stream adds only what is new.

COUNTED = {"total_strike_score": "added_strike_score",
           "overspeed_events": "added_overspeed_events",
           "restricted_zone_events": "added_restricted_zone_events"}


def credit(held: DataFrame, fresh: DataFrame, source: str, run: int, as_of: Moment = None,
           closed: Column | None = None, settings: RiskSettings = RiskSettings(),
           by_window: bool = True, cooldown_by_tier: bool = False, true_previous: bool = False,
           kept_sources: str = "30 days") -> DataFrame:
    """Stored state after one run of a source: ``held`` rows and the window totals ``fresh``.

    With ``by_window``, ``fresh`` has the totals of new events alone; they are added to the open
    windows that the driver's row holds, and a window is rated by its total so far. Otherwise
    the totals are added and rated as they come. A driver that this run, or a later one of the
    source, has touched before stays as it is, so a run can be repeated. Untouched windows that
    end at or before ``closed`` are let go.

    One join of rows per driver; the windows of a driver are arrays, a few entries long.
    """
    now = moment(as_of)
    incoming = F.struct(*[(F.col(name) if name in fresh.columns else F.lit(None)).cast(kind).alias(name)
                          for name, kind in _window_types()[:6]])
    new = fresh.filter(F.col("driver_id").isNotNull()).groupBy("driver_id").agg(
        F.collect_list(incoming).alias("_new"))
    old = held.withColumn("_old", F.lit(True))
    empty = F.array().cast("array<struct<" + ",".join(f"{n}:{t}" for n, t in _window_types()) + ">>")
    windows = F.coalesce("windows", empty)
    seen = F.coalesce(F.col("applied")[source]["run"] >= run, F.lit(False))

    def total(window: Column) -> Column:
        same = F.get(F.filter(windows, lambda w: (w["window_start"] == window["window_start"]) & (
            w["window_end"] == window["window_end"])), F.lit(0))
        sums = {name: (F.coalesce(same[name], F.lit(0)) if by_window else 0) + window[name]
                for name in COUNTED}
        return F.struct(
            window["window_start"].alias("window_start"), window["window_end"].alias("window_end"),
            *[value.alias(name) for name, value in sums.items()],
            F.greatest(same["last_event_time"], window["last_event_time"]).alias("last_event_time"),
            *[window[name].alias(added) for name, added in COUNTED.items()],
            F.lit(run).cast("bigint").alias("touched_batch"))

    joined = old.join(new, "driver_id", "full").withColumn(
        "_rated", F.when(seen | F.col("_new").isNull(), empty).otherwise(F.transform("_new", total)))
    touched = F.size("_rated") > 0
    judged = F.transform("_rated", lambda w: F.struct(
        w["window_start"].alias("window_start"), w["total_strike_score"].alias("score"),
        rules.tier_of(w["total_strike_score"], settings).alias("tier")))
    previous = F.coalesce("suspension_status", F.lit(ACTIVE)) if true_previous else F.lit(ACTIVE)
    findings = F.transform("_judged", lambda j: finding(
        "RISK_EVALUATION", previous, j["tier"]["suspension_status"], j["score"],
        j["tier"]["suspension_reason"]))
    # windows that go on: those not rated now and still open, and those rated now
    rated = lambda w: F.exists("_rated", lambda r: (
        r["window_start"] == w["window_start"]) & (r["window_end"] == w["window_end"]))
    is_open = (lambda w: F.lit(True)) if closed is None else (lambda w: w["window_end"] > closed)
    going_on = F.concat(F.filter(windows, lambda w: ~rated(w) & is_open(w)), "_rated")

    days = F.col("_last.tier.cooldown_days") if cooldown_by_tier else F.lit(1)
    replaced = {name: F.col(f"_last.tier.{name}") for name in TIER_COLUMNS}
    replaced |= {"strike_decay_score": rules.lowered(F.col("_last.score"), settings.decay_allowance),
                 "cooldown_until": now + F.make_interval(days=days), "updated_ts": now}
    columns = {name: F.when(touched, value).otherwise(F.col(name)) for name, value in replaced.items()}
    for added, name in ADDED.items():
        gained = F.transform("_rated", lambda w: w[added])  # noqa: B023
        columns[name] = F.coalesce(F.col(name), F.lit(0)) + F.aggregate(
            gained, F.lit(0).cast("bigint"), lambda a, x: a + x)
    columns["last_event_ts"] = F.when(F.col("_old").isNull(), now).otherwise(F.col("last_event_ts"))
    columns["windows"] = going_on if by_window else windows
    columns["applied"] = F.when(touched, mark(source, run, now, kept_sources)).otherwise(F.col("applied"))
    columns["findings"] = F.when(touched, findings).otherwise(F.col("findings"))
    return joined.withColumn("_judged", judged).withColumn("_last", F.array_max("_judged")).select(
        *[columns.get(c, F.col(c)).alias(c) for c in held.columns])


def _window_types() -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in WINDOW_TOTALS]


def finding(event: str, previous: Column, new: Column, score: Column, reason: Column) -> Column:
    return F.struct(
        F.lit(event).alias("event_type"), previous.alias("previous_status"), new.alias("new_status"),
        score.alias("strike_score"), reason.alias("event_reason"))


def mark(source: str, run: int, now: Column, kept_sources: str) -> Column:
    """``applied`` with this run, and without sources that have been silent for long."""
    entry = F.create_map(F.lit(source), F.struct(F.lit(run).cast("bigint").alias("run"), now.alias("at")))
    others = F.map_filter(F.coalesce("applied", F.create_map().cast(
        "map<string,struct<run:bigint,at:timestamp>>")), lambda key, value: (key != source) & (
            value["at"] > now - F.expr(f"INTERVAL {kept_sources}")))
    return F.map_concat(others, entry)


def findings_of(stored: DataFrame, source: str, run: int) -> DataFrame:
    """Audit rows of the drivers whose last run was this one."""
    return stored.filter(F.col("applied")[source]["run"] == run).select(
        "driver_id", F.inline("findings")).select(*SUSPENSION_EVENT_HISTORY.names)
