"""URL filter: rules, then trust and distrust propagated over the links between hosts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.common import ascii_lower, stage


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Fixed values.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


@dataclass(frozen=True)
class TrustSettings:
    damping: float = 0.85
    iterations: int = 20
    #: A host is blocked if its distrust is above this many times its trust.
    ratio: float = 1.0
    #: Iterations between two writes of the scores, which end the lineage.
    stage_every: int = 5


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/``, ``?``, ``#`` or the end; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest fitting rule, null if none fits.

    Rules are configuration, tried from the longest to the shortest in one expression.
    """
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """``src, dst, weight``: pages of one host that link to another. Needs ``host`` and ``html``."""
    targets = F.regexp_extract_all(
        "html", F.lit(r"""(?i)href\s*=\s*["']?\s*[a-z][a-z0-9+.-]*://([^/?#"'\s<>]*)"""), 1)
    return (
        pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(
            F.transform(targets, ascii_lower))).alias("dst"))
        .filter("src <> '' AND dst <> '' AND src <> dst")
        .groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    )


def host_scores(pages: DataFrame, settings: TrustSettings = TrustSettings()) -> DataFrame:
    """``host, trust, distrust`` of every linked or seeded host.

    Seeds of trust are hosts with pages that rules allow and none that they block; seeds of
    distrust the reverse; a host with both is neither. Trust is a personalised PageRank from
    the seeds along the links, distrust one from its seeds against them (who links to blocked
    hosts is suspect). Every seed starts with 1, so both are on one scale; what reaches a host
    without links ends there. Needs ``host``, ``html`` and ``rule_verdict``.
    """
    allowed = F.max(F.coalesce(F.col("rule_verdict") == "allow", F.lit(False)).cast("int"))
    blocked = F.max(F.coalesce(F.col("rule_verdict") == "block", F.lit(False)).cast("int"))
    seeds = stage(
        pages.filter("host <> ''").groupBy("host").agg(allowed.alias("a"), blocked.alias("b"))
        .select("host", ((F.col("a") == 1) & (F.col("b") == 0)).cast("double").alias("good"),
                ((F.col("b") == 1) & (F.col("a") == 0)).cast("double").alias("bad"))
        .filter("good + bad > 0"), "seeds")
    start = 1 - settings.damping
    scores = seeds.select("host", (F.col("good") * start).alias("trust"),
                          (F.col("bad") * start).alias("distrust"))
    links = stage(host_links(pages), "links")
    if links.isEmpty():  # then every further iteration returns the same
        return scores
    out_of = links.groupBy("src").agg(F.sum("weight").alias("out"))
    into = links.groupBy("dst").agg(F.sum("weight").alias("into"))
    links = stage(
        links.join(out_of, "src").join(into, "dst")
        .select("src", "dst", (F.col("weight") / F.col("out")).alias("forward"),
                (F.col("weight") / F.col("into")).alias("back")), "steps")
    for i in range(1, settings.iterations + 1):
        along = links.join(scores.filter("trust > 0"), F.col("src") == F.col("host")).select(
            F.col("dst").alias("host"), (F.col("trust") * F.col("forward")).alias("trust"),
            F.lit(0.0).alias("distrust"))
        against = links.join(scores.filter("distrust > 0"), F.col("dst") == F.col("host")).select(
            F.col("src").alias("host"), F.lit(0.0).alias("trust"),
            (F.col("distrust") * F.col("back")).alias("distrust"))
        damped = along.union(against).select(
            "host", *[(F.col(c) * settings.damping).alias(c) for c in ("trust", "distrust")])
        scores = damped.union(seeds.select(
            "host", F.col("good") * start, F.col("bad") * start)).groupBy("host").agg(
            F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        if i % settings.stage_every == 0 or i == settings.iterations:
            scores = stage(scores, "scores")
    return scores


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES,
               settings: TrustSettings = TrustSettings()) -> DataFrame:
    """``pages`` with ``host, path, rule, trust, distrust, verdict``; every row stays.

    A rule decides, else the host: it is blocked if its distrust exceeds ``ratio`` times its
    trust. Null urls and urls without ``://`` have empty host and path, no rule, and are
    allowed, as are hosts that no seed reaches. Columns named like the new ones are replaced.
    """
    added = ("host", "path", "rule", "trust", "distrust", "verdict", "rule_verdict")
    named = pages.drop(*added).withColumns({"host": host_of(F.col("url")),
                                            "path": path_of(F.col("url"))})
    text, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    ruled = named.withColumns({"rule": text, "rule_verdict": verdict})
    scores = stage(host_scores(ruled, settings), "host-scores")
    known = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("trust", "distrust")}
    by_host = F.when(F.col("distrust") > settings.ratio * F.col("trust"), "block").otherwise("allow")
    return (
        ruled.join(scores, "host", "left").withColumns(known)
        .withColumn("verdict", F.coalesce("rule_verdict", by_host)).drop("rule_verdict")
    )
