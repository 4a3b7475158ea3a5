"""Every threshold of the library, in frozen dataclasses.

Change one with ``dataclasses.replace(RiskSettings(), overspeed_limit=90)``.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ZoneBox:
    """A latitude/longitude rectangle; all four sides belong to it."""

    min_lat: float
    max_lat: float
    min_lon: float
    max_lon: float


@dataclass(frozen=True)
class SuspensionTier:
    """What a window score of at least ``floor`` means for a driver."""

    floor: int
    risk_category: str
    suspension_status: str
    suspension_reason: str | None
    warning_count: int = 0
    suspension_count: int = 0
    reinstatement_eligible: int = 0
    cooldown_days: int = 1


# Tier floors, labels, counters and reason texts. ``cooldown_days``
# counts only when the cooldown is asked for by tier.
SUSPENSION_TIERS = (
    SuspensionTier(25, "CRITICAL_RISK", "SUSPENDED_7D", "Critical repeat offender",
                   suspension_count=3, cooldown_days=7),
    SuspensionTier(15, "HIGH_RISK", "SUSPENDED_24H", "High strike threshold exceeded",
                   suspension_count=1),
    SuspensionTier(8, "MEDIUM_RISK", "WARNING", "Moderate risk behavior", warning_count=1),
)
LOWEST_TIER = SuspensionTier(0, "LOW_RISK", "ACTIVE", None, reinstatement_eligible=1)


@dataclass(frozen=True)
class RiskSettings:
    # event rules
    overspeed_limit: int = 110
    zone: ZoneBox = ZoneBox(12.5, 12.8, 77.2, 77.5)
    overspeed_weight: int = 1
    zone_weight: int = 2
    medium_risk_score: int = 3
    high_risk_score: int = 5
    rate_deduction: float = 0.05
    # driver state, highest floor first
    tiers: tuple[SuspensionTier, ...] = SUSPENSION_TIERS
    lowest_tier: SuspensionTier = LOWEST_TIER
    decay_allowance: int = 2
    decay_step: int = 1
    # fuel audit
    fuel_threshold_factor: float = 0.88
    # unit of time that the readings of a vehicle are sequenced in, for date_trunc
    sequence_piece: str = "HOUR"


@dataclass(frozen=True)
class StreamSettings:
    watermark_delay: str = "10 minutes"
    window_length: str = "30 minutes"
    event_trigger: str = "1 minute"
    aggregate_trigger: str = "2 minutes"
    # upper bound of a micro-batch of the Kafka source; None for no bound
    max_offsets_per_trigger: int | None = None
    # a dimension with at most this many rows is broadcast to the stream
    broadcast_rows: int = 1_000_000
    # groups that the events of a vehicle are spread over to join a larger one in a stream
    join_salts: int = 16
    # Parquet buckets that drivers are hashed into; fixed when a state is first written
    state_buckets: int = 16
    # older files of a bucket that stay for readers, and for how long at least
    retained_versions: int = 10
    retained_seconds: float = 3600.0
    # a source that touched a driver so long ago is not read again
    retained_sources: str = "30 days"


@dataclass(frozen=True)
class PublishSettings:
    attempts: int = 3
    pause_seconds: float = 5.0
    insert_chunk: int = 1000
    # connections that load a database table at once
    connections: int = 8
    # a replaced report stays readable so long at least
    retained_seconds: float = 3600.0
    concurrent_reports: int = 4
