"""Mixing sources to target weights: tokens per source, repetition rates, hash-seeded copies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.common import n_words_of, ranked, stage


@dataclass(frozen=True)
class MixSettings:
    #: Weights of the sources in code-point order, repeated; null is the last source.
    weights: tuple[int, ...] = (5, 2, 1)
    #: Words of the mix, in hundredths of the words of the corpus.
    percent: int = 150
    #: Most passes over a source.
    most: int = 2
    #: Seeds among which each source takes the one that comes nearest to its target.
    seeds: int = 64


def source_targets(docs: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """``source, source_size, weight, target``: one row per source.

    The mix is shared out by weight. A target above ``most`` times the source's size stops
    there, and the excess goes to the other sources by weight until none is above: each
    round is one small aggregation over the sources, and rounds end when no source stops.
    """
    spark = docs.sparkSession
    sizes = docs.groupBy("source").agg(F.sum("_size").alias("source_size"))
    order = [F.col("source").asc_nulls_last()]
    weight = F.element_at(F.array(*map(F.lit, settings.weights)),
                          (F.col("_rank") % len(settings.weights) + 1).cast("int"))
    sources = stage(ranked(sizes, order, "_rank").select(
        "source", "source_size", weight.alias("weight"),
        (F.col("source_size") * settings.most).alias("_most")), "sources")
    whole = sources.agg(F.sum("source_size")).first()[0] or 0
    total, stopped, share = whole * settings.percent / 100, F.lit(False), 0.0
    n_stopped = -1
    while True:
        row = sources.agg(
            F.sum(F.when(stopped, F.col("_most")).otherwise(0)).alias("taken"),
            F.sum(F.when(stopped, 0).otherwise(F.col("weight"))).alias("open"),
            F.sum(F.when(stopped, 1).otherwise(0)).alias("n")).first()
        if row["n"] == n_stopped or not row["open"]:
            break
        n_stopped, share = row["n"], (total - row["taken"]) / row["open"]
        stopped = F.col("_most") <= F.lit(share) * F.col("weight")
    target = F.least(F.col("_most").cast("double"), F.lit(float(share)) * F.col("weight"))
    return stage(sources.select("source", "source_size", "weight", target.alias("target")),
                 "targets")


#: A digest gives two whole numbers below this.
RANGE = 16 ** 12


def _with_digest(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_first`` and ``_step``, fixed by ``doc_id``, or by the text if that is null."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.sha2(F.coalesce("text", F.lit("")), 256))
    digits = lambda at: F.conv(F.substring("_digest", at, 12), 16, 10).cast("long")
    return (
        docs.withColumn("_digest", F.sha2(name, 256))
        .withColumns({"_first": digits(1), "_step": digits(13)}).drop("_digest")
    )


def _draw(seed: Column) -> Column:
    """A number in [0, 1) fixed by seed and digest: draws of two seeds are independent."""
    return F.pmod(F.col("_first") + seed.cast("long") * F.col("_step"), F.lit(RANGE)) / float(RANGE)


def _mixed(docs: DataFrame, settings: MixSettings) -> DataFrame:
    """``docs`` with ``_size, _source_size, _target, _copies``."""
    sized = _with_digest(docs.withColumn("_size", n_words_of(F.col("text"))))
    lean = stage(sized.select("source", "_size", "_first", "_step"), "sizes")
    targets = source_targets(lean, settings).select(
        F.col("source").alias("_source"), F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"))
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(0.0)
    fraction = F.col("_rate") - F.floor("_rate")
    joined = lean.join(targets, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_rate", rate)
    extra = [F.sum(F.when(_draw(F.lit(seed)) < fraction, F.col("_size")).otherwise(0))
             .alias(f"_extra{seed}") for seed in range(settings.seeds)]
    totals = joined.groupBy("_source", "_source_size", "_target", "_rate").agg(*extra)
    away = F.array_sort(F.array(*[F.struct(
        F.abs(F.floor("_rate") * F.col("_source_size") + F.col(f"_extra{seed}") - F.col("_target"))
        .alias("away"), F.lit(seed).alias("seed")) for seed in range(settings.seeds)]))
    chosen = stage(totals.select("_source", "_source_size", "_target", "_rate",
                                 away[0]["seed"].alias("_seed")), "seeds")
    copies = F.floor("_rate") + F.when(_draw(F.col("_seed")) < fraction, 1).otherwise(0)
    return (
        sized.join(chosen, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_copies", copies.cast("long"))
        .select(*docs.columns, "_size", "_source_size", "_target", "_copies")
    )


def mix_copies(docs: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies``: every row, none dropped or repeated.

    ``copies`` is ``floor(rate)`` and one more if the document's draw is below the fraction
    of the rate, with ``rate = target / source_size``. Draws are fixed by a digest of ``doc_id``
    (null: of the text) and a seed; of ``seeds`` fixed seeds each source takes the one whose
    words come nearest to its target, found by one aggregation, so reruns agree. Null texts
    have size 0, a source without words gets rate 0. Columns named like the new ones are
    replaced.
    """
    added = ("size", "source_size", "target", "copies")
    kept = [c for c in docs.columns if c not in added]
    return _mixed(docs.select(*kept), settings).select(
        *kept, *[F.col(f"_{c}").alias(c) for c in added])


def mix(docs: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """The mix itself: each document as often as it is taken, all columns as in ``docs``."""
    copy = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    return _mixed(docs, settings).filter("_copies > 0").withColumn("_copy", copy).select(*docs.columns)
