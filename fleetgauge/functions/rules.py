"""Driver risk rules as column expressions."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetgauge.settings import RiskSettings, SuspensionTier, ZoneBox


def overspeed_flag(speed: Column, settings: RiskSettings) -> Column:
    return F.when(speed > settings.overspeed_limit, 1).otherwise(0)


def inside(lat: Column, lon: Column, box: ZoneBox) -> Column:
    return lat.between(box.min_lat, box.max_lat) & lon.between(box.min_lon, box.max_lon)


def zone_flag(lat: Column, lon: Column, settings: RiskSettings) -> Column:
    return F.when(inside(lat, lon, settings.zone), 1).otherwise(0)


def strike_score(overspeed: Column, in_zone: Column, settings: RiskSettings) -> Column:
    return overspeed * settings.overspeed_weight + in_zone * settings.zone_weight


def event_risk(score: Column, settings: RiskSettings) -> Column:
    return (
        F.when(score >= settings.high_risk_score, "HIGH_RISK")
        .when(score >= settings.medium_risk_score, "MEDIUM_RISK")
        .otherwise("LOW_RISK")
    )


def adjusted_rate(rate: Column, score: Column, settings: RiskSettings) -> Column:
    return rate - rate * settings.rate_deduction * score


def by_tier(score: Column, attribute: str, settings: RiskSettings) -> Column:
    """``attribute`` of the suspension tier that ``score`` reaches."""

    def value(tier: SuspensionTier) -> Column:
        return F.lit(getattr(tier, attribute))

    highest, *others = sorted(settings.tiers, key=lambda t: -t.floor)
    chain = F.when(score >= highest.floor, value(highest))
    for tier in others:
        chain = chain.when(score >= tier.floor, value(tier))
    return chain.otherwise(value(settings.lowest_tier))


def tier_of(score: Column, settings: RiskSettings) -> Column:
    """The suspension tier that ``score`` reaches, as a struct of all its attributes."""

    def value(tier: SuspensionTier) -> Column:
        return F.struct(*[F.lit(v).cast("string" if name.endswith(("status", "reason", "category")) else "int")
                          .alias(name) for name, v in asdict(tier).items()])

    highest, *others = sorted(settings.tiers, key=lambda t: -t.floor)
    chain = F.when(score >= highest.floor, value(highest))
    for tier in others:
        chain = chain.when(score >= tier.floor, value(tier))
    return chain.otherwise(value(settings.lowest_tier))


def lowered(score: Column, by: int) -> Column:
    """``score`` less ``by``, never below zero."""
    return F.greatest(score - by, F.lit(0).cast("bigint"))
