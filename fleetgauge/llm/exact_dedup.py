"""Exact duplicates, batch by batch: filters of immutable snapshots, then a check by bytes.

A batch that has been taken in becomes a snapshot that never changes: its different texts in
buckets by digest, and a binary-fuse filter per shard of its digests. The digests of the next
batch are screened by the filters; what none of them knows is new and needs no look at any
text. What one of them lets through is joined with the exact buckets and compared byte by byte.
Copies within a batch are grouped on their own, by bytes too.

Only digests move for most documents. Texts move for snapshots (once), and for the digests that
repeat or pass a filter.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.binary_fuse import BinaryFuse, build_filter
from fleetgauge.llm.common import broadcast_if_small, ship_package, stage


@dataclass(frozen=True)
class ExactSettings:
    #: Batches that a table is taken in by; rows are dealt by a hash of their id.
    batches: int = 2
    #: Digests of a shard, whose filter one task builds and another holds.
    shard: int = 1 << 17
    #: Groups larger than one in so many rows are hot: there are at most so many of them.
    hot: int = 10_000
    #: Hexadecimal digits of the SHA-256 that make the digest. Fewer only make more work.
    digits: int = 64


def normalised(text: Column) -> Column:
    """Runs of ASCII white space become one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _with_digest(docs: DataFrame, settings: ExactSettings) -> DataFrame:
    """``doc_id, _text, text_sha256, _digest, _batch`` of every row."""
    batch = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(settings.batches)).cast("int")
    return (
        docs.select("doc_id", normalised(F.col("text")).alias("_text"), batch.alias("_batch"))
        .withColumn("text_sha256", F.sha2("_text", 256))
        .withColumn("_digest", F.left("text_sha256", F.lit(settings.digits)))
    )


@dataclass(frozen=True)
class Snapshot:
    """``exact``: ``_bucket, _digest, _text`` of its texts; ``filters``: a filter per ``_bucket``."""

    exact: DataFrame
    filters: DataFrame
    buckets: int


FILTER = "_bucket int, seed int, width int, segments int, slots binary"


def _key() -> Column:
    return F.xxhash64("_digest")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), F.col("_digest")), F.lit(buckets)).cast("int")


def build_snapshot(texts: DataFrame, size: int, settings: ExactSettings) -> Snapshot:
    """A snapshot of ``texts (_digest, _text)``, one row for each of about ``size`` different texts."""
    buckets = max(1, -(-size // settings.shard))
    exact = stage(texts.withColumn("_bucket", _bucket(buckets)), "exact")

    def build(keys: pd.DataFrame) -> pd.DataFrame:
        made = build_filter(keys["key"].to_numpy(np.int64))
        return pd.DataFrame({
            "_bucket": keys["_bucket"].iloc[:1], "seed": made.seed, "width": made.width,
            "segments": made.segments, "slots": [made.table.tobytes()]})

    filters = exact.select("_bucket", _key().alias("key")).groupBy("_bucket").applyInPandas(build, FILTER)
    return Snapshot(exact, stage(filters, "filters"), buckets)


def screen(digests: DataFrame, snapshot: Snapshot, settings: ExactSettings) -> DataFrame:
    """Those of the different ``digests (_digest)`` that the snapshot may hold.

    A task gets one filter and about ``shard`` digests: where the batch is larger than the
    snapshot, filters are sent to several tasks.
    """
    parts = max(1, -(-digests.count() // (snapshot.buckets * settings.shard)))
    asked = digests.select("_digest", _key().alias("key"), _bucket(snapshot.buckets).alias("_bucket"),
                           F.pmod(F.xxhash64(F.lit(5), F.col("_digest")), F.lit(parts)).alias("part"))
    filters = snapshot.filters.withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    def probe(keys: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(held) or not len(keys):
            return keys[["_digest"]].iloc[:0]
        row = held.iloc[0]
        made = BinaryFuse(int(row.seed), int(row.width), int(row.segments),
                          np.frombuffer(row.slots, np.uint8))
        return keys.loc[made.contains(keys["key"].to_numpy(np.int64)), ["_digest"]]

    return (
        asked.groupBy("_bucket", "part").cogroup(filters.groupBy("_bucket", "part"))
        .applyInPandas(probe, "_digest string")
    )


def _texts_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``_digest, _text``, one row for each different text that has a wanted digest.

    Copies are brought together within each task first, so a text that a third of all rows
    hold moves once per task.
    """
    small = broadcast_if_small(wanted)
    texts = rows.select("_digest", "_text")
    if small is not wanted:
        return texts.join(small, "_digest", "left_semi").distinct()
    return texts.distinct().join(wanted, "_digest", "left_semi")


@dataclass(frozen=True)
class Taken:
    """What a batch adds: ``counted (_digest, n, first)``; the different ``texts`` of its digests that
    repeat or passed a filter (``wanted``); its digests that earlier snapshots hold (``known``), and
    digests that more than one text has (``collided``)."""

    counted: DataFrame
    wanted: DataFrame
    texts: DataFrame
    known: DataFrame
    collided: DataFrame


def take_in(rows: DataFrame, counted: DataFrame, snapshots: list[Snapshot],
            settings: ExactSettings) -> Taken:
    """Compares a batch with the snapshots and with itself. ``rows`` hold ``_digest, _text``."""
    positive = [screen(counted.select("_digest"), s, settings) for s in snapshots]
    wanted = stage(reduce(DataFrame.union, positive, counted.filter("n > 1").select("_digest"))
                   .distinct(), "wanted")
    texts = stage(_texts_of(rows, wanted), "batch-texts")
    collided = texts.groupBy("_digest").count().filter("count > 1").select("_digest")
    known = texts.select("_digest").limit(0)
    for snapshot in snapshots:
        met = stage(
            snapshot.exact.join(broadcast_if_small(wanted), "_digest", "left_semi")
            .select("_digest", F.col("_text").alias("_held"))
            .join(broadcast_if_small(texts), "_digest")
            .select("_digest", (F.col("_held") == F.col("_text")).alias("same")), "met")
        known = known.union(met.filter("same").select("_digest"))
        collided = collided.union(met.filter("NOT same").select("_digest"))
    return Taken(counted, wanted, texts, stage(known.distinct(), "known"),
                 stage(collided.distinct(), "collided"))


def _new_texts(rows: DataFrame, taken: Taken) -> DataFrame:
    """The different texts of a batch that no earlier snapshot holds. Digests that are not wanted
    have one row, which is written as it is."""
    once = rows.select("_digest", "_text").join(
        broadcast_if_small(taken.wanted), "_digest", "left_anti")
    return once.unionByName(taken.texts.join(
        broadcast_if_small(taken.known), "_digest", "left_anti"))


def _first() -> Column:
    """The row that stays."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("first")


def _decided(rows: DataFrame, groups: DataFrame, by: str, total: int,
             settings: ExactSettings) -> DataFrame:
    """``rows (_row, doc_id, ...)`` with what their group, known by the column ``by``, decides.

    Groups above one in ``hot`` rows, of which there are at most ``hot``, are broadcast; then no
    key of the join that is left has more rows than that.
    """
    joined = broadcast_if_small(groups)
    if joined is not groups:
        found = rows.join(joined, by, "left")
    else:
        often = F.broadcast(groups.filter(F.col("n") > total // settings.hot))
        rest = groups.filter(F.col("n") <= total // settings.hot)
        found = rows.join(often, by).unionByName(
            rows.join(often.select(by), by, "left_anti").join(rest, by, "left"),
            allowMissingColumns=True)
    alone = F.col("n").isNull()
    return found.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_row") == F.col("first._row"))).alias("kept"), "text_sha256")


def exact_duplicates(docs: DataFrame, settings: ExactSettings = ExactSettings()) -> DataFrame:
    """Per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``; no row is left out.

    Texts are equal if they are the same bytes after each run of ASCII white space became one
    space; a null text is empty, and all empty ones are equal. Of equal texts the row with the
    least ``doc_id`` stays, nulls last; of rows that share it, exactly one. ``text_sha256`` is
    that of the text so changed. Other columns are not read.

    The rows are taken in by ``batches``, as they would be if they came one after the other. A
    digest that two different texts have is settled by the texts themselves.
    """
    ship_package(docs.sparkSession)
    rows = _with_digest(docs, settings)
    lean = stage(rows.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text_sha256",
                             "_digest", "_batch"), "digests")
    total = lean.count()
    snapshots: list[Snapshot] = []
    taken: list[Taken] = []
    for batch in range(settings.batches):
        mine = F.col("_batch") == batch
        counted = stage(lean.filter(mine).groupBy("_digest").agg(
            F.count("*").alias("n"), _first()), "counted")
        taken.append(take_in(rows.filter(mine), counted, snapshots, settings))
        if batch < settings.batches - 1:  # the last one meets no later batch
            new = _new_texts(rows.filter(mine), taken[-1])
            snapshots.append(build_snapshot(new, counted.count(), settings))
    known = stage(reduce(DataFrame.union, [t.known for t in taken]).distinct()
                  .withColumn("_known", F.lit(True)), "known")
    collided = stage(reduce(DataFrame.union, [t.collided for t in taken]).distinct(), "collided")
    seen = reduce(DataFrame.union, [t.counted for t in taken])
    merged = (
        seen.join(broadcast_if_small(known), "_digest", "left").filter("n > 1 OR _known")
        .groupBy("_digest").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    )
    if collided.isEmpty():
        return _decided(lean, stage(merged, "groups"), "_digest", total, settings)
    plain = merged.join(broadcast_if_small(collided), "_digest", "left_anti")
    decided = _decided(lean.join(broadcast_if_small(collided), "_digest", "left_anti"),
                       stage(plain, "groups"), "_digest", total, settings)
    return decided.unionByName(_by_text(rows, collided, total, settings))


def _by_text(rows: DataFrame, collided: DataFrame, total: int, settings: ExactSettings) -> DataFrame:
    """What ``exact_duplicates`` returns, for rows whose digest tells nothing: grouped by text."""
    mixed = stage(
        rows.join(broadcast_if_small(collided), "_digest", "left_semi")
        .select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text_sha256", "_text"),
        "mixed")
    groups = stage(mixed.groupBy("_text").agg(F.count("*").alias("n"), _first()),
                   "mixed-groups")
    return _decided(mixed, groups, "_text", total, settings)
