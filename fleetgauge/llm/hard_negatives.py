"""Hard negatives by angular triangle filtering: rows of another label that score near a positive.

Every row stores its angles to a few reference directions. Two angles to the same direction bound
the angle between two rows: it is at least their difference and at most their sum. Times the
norms this bounds the score, the integer inner product. Rows are packed in blocks that are sorted
by label and by the angle to their nearest direction; an anchor looks at a block only if the
block's interval of scores overlaps the window it still needs, there only at the stretch of rows
whose own interval does, and scores those in whole numbers.

Anchors are a stated query set. Blocks of anchors meet blocks of rows, in groups of bounded size;
a group returns only the best rows of each anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.llm.common import broadcast_if_small, ship_package, stage

#: Scaled squared norms stay below this, so that a hundred times any score fits in 64 bits.
MOST = 2.0 ** 56
#: Angles are widened by this, and bounds of scores by this share of the norms: more than what
#: rounding does to an arc cosine and to an angle stored in 32 bits.
SLACK = 4e-6


@dataclass(frozen=True)
class MiningSettings:
    scale: int = 256
    positives: int = 5
    negatives: int = 10
    #: Bounds of a negative's score in hundredths of the positive's.
    least_percent: int = 30
    most_percent: int = 90
    #: Reference directions, and rows that they are chosen from. They only steer the filter.
    directions: int = 16
    sample: int = 2048
    #: Bytes of the vectors of a block, of rows and of anchors.
    block_bytes: int = 1 << 18
    anchor_bytes: int = 1 << 19
    #: Blocks of rows that one group compares with a block of anchors.
    group: int = 32


def scaled(rows: DataFrame, settings: MiningSettings = MiningSettings()) -> DataFrame:
    """``vec_id, label, x`` of the usable rows, ``x`` in whole numbers.

    Usable are rows with an id, a label and a vector of finite entries, of the most common length
    (the longest of those equally common), whose scaled norm keeps scores within 64 bits. Of
    several rows with one id the one with the least label, then vector, stays.
    """
    wide = rows.select("vec_id", "label", F.transform("embedding", lambda c: c.cast("double")).alias("v"))
    finite = F.forall("v", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)) & ~F.isnan(c))
    norm = F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)
    fit = wide.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & finite)
    fit = fit.filter(norm < MOST / 2 / settings.scale ** 2)
    common = fit.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    fit = fit.filter(F.size("v") == (common.d if common else 0)).select(
        "vec_id", "label", F.transform("v", lambda c: F.floor(c * settings.scale).cast("int")).alias("x"))
    fit = stage(fit, "scaled")
    twice = stage(fit.groupBy("vec_id").count().filter("count > 1").select("vec_id"), "twice")
    if twice.isEmpty():
        return fit
    one = fit.join(broadcast_if_small(twice), "vec_id", "left_semi").groupBy("vec_id").agg(
        F.min(F.struct("label", "x")).alias("r")).select("vec_id", "r.label", "r.x")
    return stage(fit.join(broadcast_if_small(twice), "vec_id", "left_anti").unionByName(one), "scaled")


def reference_directions(rows: DataFrame, settings: MiningSettings = MiningSettings()) -> np.ndarray:
    """Unit vectors, each a row of the sample that is far from those before it.

    The sample are the rows with the least hashes of their ids, so reruns agree.
    """
    taken = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(settings.sample).select("x").collect()
    x = np.array([r.x for r in taken if any(r.x)], float)
    if not len(x) or not settings.directions:
        return np.zeros((0, 0))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(settings.directions, len(unit)):
        far = int(np.argmin(nearest))
        if nearest[far] > 1 - 1e-9:
            break
        chosen.append(far)
        nearest = np.maximum(nearest, unit @ unit[far])
    return unit[chosen]


def angles_to(x: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angle of each row to each direction; a row of zeros is at a right angle to all."""
    if not len(directions):
        return np.zeros((len(x), 0))
    norms = np.linalg.norm(x.astype(float), axis=1)
    cosines = x.astype(float) @ directions.T / np.where(norms > 0, norms, 1.0)[:, None]
    return np.arccos(np.clip(cosines, -1.0, 1.0))


BLOCK = "ids binary, labels array<{}>, x binary, angles binary, rows int"


def blocks(rows: DataFrame, directions: np.ndarray, most: int, settings: MiningSettings) -> DataFrame:
    """Rows in blocks of at most ``most`` bytes of vectors, by label, nearest direction and angle."""
    kind = rows.schema["label"].dataType.simpleString()

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                angles = angles_to(np.stack(batch["x"]), directions)
                batch["cell"] = angles.argmin(axis=1).astype(np.int32) if angles.size else np.int32(0)
                batch["angle"] = angles.min(axis=1) if angles.size else 0.0
                yield batch

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack(batch["x"]).astype(np.int32)
            angles = angles_to(x, directions).astype(np.float32)
            size = max(1, most // (4 * x.shape[1]))
            for start in range(0, len(x), size):
                part = batch.iloc[start:start + size]
                yield pd.DataFrame({
                    "ids": [part["vec_id"].to_numpy(np.int64).tobytes()],
                    "labels": [part["label"].tolist()], "x": [x[start:start + size].tobytes()],
                    "angles": [angles[start:start + size].tobytes()], "rows": np.int32(len(part))})

    placed = rows.mapInPandas(
        place, f"vec_id long, label {kind}, x array<int>, cell int, angle double")
    order = ["label", "cell", "angle", "vec_id"]
    packed = (
        placed.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInPandas(pack, BLOCK.format(kind))
        .withColumn("block", F.monotonically_increasing_id())
    )
    return stage(packed, "blocks")


class _Rows:
    """The vectors of a packed block, with norms and angles, in runs of one label and direction."""

    def __init__(self, ids: bytes, labels, x: bytes, angles: bytes, rows: int):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.asarray(labels)
        self.x = np.frombuffer(x, np.int32).reshape(rows, -1)
        self.angles = np.frombuffer(angles, np.float32).reshape(rows, -1).astype(float)
        self.norms = np.linalg.norm(self.x.astype(float), axis=1)
        cells = self.angles.argmin(axis=1) if self.angles.size else np.zeros(rows, int)
        self.runs = np.flatnonzero(np.r_[True, (cells[1:] != cells[:-1])
                                         | (self.labels[1:] != self.labels[:-1])])
        self.ends = np.r_[self.runs[1:], rows]
        self.cells = cells[self.runs]

    def scores(self, x: np.ndarray, start: int, end: int) -> np.ndarray:
        """Inner products in whole numbers: by floating point where that is exact."""
        mine = self.x[start:end]
        if float(np.abs(x).max(initial=0)) * float(np.abs(mine).max(initial=0)) * x.shape[1] < 2.0 ** 52:
            return (x.astype(float) @ mine.astype(float).T).astype(np.int64)
        return x.astype(np.int64) @ mine.astype(np.int64).T


def score_bounds(angles: np.ndarray, norms: np.ndarray, rows: _Rows, part: slice
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score that anchors of these angles and norms can have with ``part``."""
    held, lengths = rows.angles[part], rows.norms[part]
    least, most = held.min(axis=0), held.max(axis=0)
    apart = np.maximum(np.maximum(least - angles, angles - most), 0.0).max(axis=1, initial=0.0)
    # beyond a half turn the sum of two angles bounds the angle from the other side
    reach = np.where(angles + most <= np.pi, angles + most, np.where(
        angles + least >= np.pi, 2 * np.pi - angles - least, np.pi)).min(axis=1, initial=np.pi)
    high = np.cos(np.clip(apart - SLACK, 0.0, np.pi))
    low = np.cos(np.clip(reach + SLACK, 0.0, np.pi))
    short, long = norms * lengths.min(), norms * lengths.max()
    edge = SLACK * long + 1.0
    return (np.where(low >= 0, short, long) * low - edge,
            np.where(high >= 0, long, short) * high + edge)


def _stretches(rows: _Rows, anchors: _Rows, same: bool, need
               ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(start, end, anchors, scores)``: stretches of rows of one label and direction, the anchors
    of the same or another label whose windows they overlap, and the scores of both.

    ``need()`` gives each anchor's least and largest score of use, which change as rows are found.
    Within a run the rows are sorted by the angle to one direction, so those whose difference of
    angles still allows an anchor's least score are one stretch of it.
    """
    for start, end, cell in zip(rows.runs.tolist(), rows.ends.tolist(), rows.cells.tolist(), strict=True):
        part = slice(start, end)
        least, most = need()
        lower, upper = score_bounds(anchors.angles, anchors.norms, rows, part)
        able = np.flatnonzero((upper >= least) & (lower <= most)
                              & ((anchors.labels == rows.labels[start]) == same))
        if len(able) and rows.angles.shape[1]:
            long = anchors.norms[able] * rows.norms[part].max()
            bounded = (least[able] > 1) & (long > 0)
            cosine = (np.where(bounded, least[able], 0.0) - 1) / np.where(bounded, long, 1.0)
            reach = np.where(bounded, np.arccos(np.clip(cosine - SLACK, -1, 1)), np.pi) + SLACK
            own, angles = anchors.angles[able, cell], rows.angles[part, cell]
            first = np.searchsorted(angles, own - reach)
            last = np.searchsorted(angles, own + reach, side="right")
            some = first < last
            able = able[some]
            if len(able):
                start, end = start + int(first[some].min()), start + int(last[some].max())
        if len(able):
            yield start, end, able, rows.scores(anchors.x[able], start, end)


class _Top:
    """The best rows so far of a number of searches, by falling score, then id."""

    def __init__(self, searches: int, most: int):
        self.most = most
        self.scores = [np.zeros(0, np.int64) for _ in range(searches)]
        self.ids = [np.zeros(0, np.int64) for _ in range(searches)]
        #: Score below which a row no longer counts.
        self.least = np.full(searches, -np.inf)

    def add(self, search: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > 4 * self.most:
            bound = np.partition(scores, -self.most)[-self.most]
            scores, ids = scores[scores >= bound], ids[scores >= bound]
        scores, ids = np.r_[self.scores[search], scores], np.r_[self.ids[search], ids]
        kept = np.lexsort((ids, -scores))[:self.most]
        self.scores[search], self.ids[search] = scores[kept], ids[kept]
        if len(kept) == self.most:
            self.least[search] = scores[kept[-1]]

    def rows(self, **columns: np.ndarray) -> pd.DataFrame:
        """A row for each that was found, with the given columns of its search."""
        sizes = [len(s) for s in self.scores]
        return pd.DataFrame({
            **{name: np.repeat(values, sizes) for name, values in columns.items()},
            "id": np.concatenate([np.zeros(0, np.int64), *self.ids]),
            "score": np.concatenate([np.zeros(0, np.int64), *self.scores])})


def _unpacked(packed: pd.DataFrame) -> list[_Rows]:
    return [_Rows(r.ids, r.labels, r.x, r.angles, r.rows) for r in packed.itertuples(index=False)]


def _nearest_first(packed: pd.DataFrame, anchors: _Rows) -> Iterator[_Rows]:
    """Blocks by falling bound of their scores, so that high scores raise the limits early."""
    found = _unpacked(packed)
    bounds = [score_bounds(anchors.angles, anchors.norms, r, slice(None))[1].max() for r in found]
    for k in np.argsort(-np.array(bounds), kind="stable"):
        yield found[k]


def _paired(anchors: DataFrame, rows: DataFrame, pairs: DataFrame, settings: MiningSettings):
    """Both sides by (block of anchors, group of blocks of rows), for ``pairs (anchors, block)``.

    A block of rows is copied once per block of anchors it meets, one of anchors once per group.
    """
    parts = max(1, -(-rows.count() // settings.group))
    part = F.pmod(F.xxhash64("block"), F.lit(parts)).alias("part")
    right = rows.join(pairs, "block").select("anchors", part, "ids", "labels", "x", "angles", "rows")
    left = anchors.withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    return left.groupBy("anchors", "part").cogroup(right.groupBy("anchors", "part"))


FOUND = "anchors long, anchor_id long, {}id long, score long"


def _find_positives(anchors: DataFrame, rows: DataFrame, settings: MiningSettings) -> DataFrame:
    """``anchors, anchor_id, positive_id, positive_score``: the best other rows of the same label."""
    label = F.explode(F.array_distinct("labels")).alias("label")
    pairs = stage(anchors.select("anchors", label).join(rows.select("block", label), "label")
                  .select("anchors", "block").distinct(), "pairs")

    def find(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame(columns=["anchors", "anchor_id", "id", "score"])
        mine = _unpacked(left[["ids", "labels", "x", "angles", "rows"]])[0]
        top = _Top(len(mine.ids), settings.positives)
        need = lambda: (top.least, np.inf)
        for block in _nearest_first(right, mine):
            for start, end, able, scores in _stretches(block, mine, True, need):
                ids = block.ids[start:end]
                counts = (scores >= top.least[able, None]) & (ids != mine.ids[able, None])
                for k in np.flatnonzero(counts.any(axis=1)).tolist():
                    top.add(int(able[k]), scores[k, counts[k]], ids[counts[k]])
        return top.rows(anchors=np.full(len(mine.ids), left["anchors"].iloc[0]), anchor_id=mine.ids)

    found = _paired(anchors, rows, pairs, settings).applyInPandas(find, FOUND.format(""))
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id"))
    return stage(found.withColumn("place", place).filter(F.col("place") <= settings.positives).select(
        "anchors", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives")


def _find_negatives(anchors: DataFrame, rows: DataFrame, positives: DataFrame,
                    settings: MiningSettings) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``."""
    listed = positives.groupBy("anchors").agg(F.sort_array(F.collect_list(F.struct(
        "anchor_id", "positive_id", "positive_score"))).alias("searches"))  # at most a block's anchors
    asked = stage(anchors.join(listed, "anchors"), "asked")
    blocks_asked = asked.agg(F.max("anchors")).first()[0]
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks_asked or 0).cast("long")))
    pairs = rows.select("block", every.alias("anchors"))
    low, high = settings.least_percent, settings.most_percent

    def mine_block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame(columns=["anchors", "anchor_id", "positive_id", "id", "score"])
        mine = _unpacked(left[["ids", "labels", "x", "angles", "rows"]])[0]
        searches = left["searches"].iloc[0]
        place = {i: k for k, i in enumerate(mine.ids.tolist())}
        owner = np.array([place[s["anchor_id"]] for s in searches], np.int64)
        score = np.array([s["positive_score"] for s in searches], np.int64)
        least, most = -(-low * score // 100), high * score // 100
        top = _Top(len(owner), settings.negatives)
        order = np.argsort(owner, kind="stable")

        def need() -> tuple[np.ndarray, np.ndarray]:
            of_anchor = np.full(len(mine.ids), np.inf), np.full(len(mine.ids), -np.inf)
            np.minimum.at(of_anchor[0], owner, np.maximum(least, top.least))
            np.maximum.at(of_anchor[1], owner, most)
            return of_anchor

        for block in _nearest_first(right, mine):
            for start, end, able, scores in _stretches(block, mine, False, need):
                ids = block.ids[start:end]
                first = np.searchsorted(owner[order], able)
                last = np.searchsorted(owner[order], able, side="right")
                for k in range(int((last - first).max(initial=0))):  # the k-th search of each anchor
                    row = np.flatnonzero(first + k < last)
                    which = order[first[row] + k]
                    bound = np.maximum(least[which], top.least[which])
                    fits = (scores[row] >= bound[:, None]) & (scores[row] <= most[which, None])
                    for j in np.flatnonzero(fits.any(axis=1)).tolist():
                        top.add(int(which[j]), scores[row[j], fits[j]], ids[fits[j]])
        return top.rows(
            anchors=np.full(len(owner), left["anchors"].iloc[0]), anchor_id=mine.ids[owner],
            positive_id=np.array([s["positive_id"] for s in searches], np.int64))

    found = _paired(asked, rows, pairs, settings).applyInPandas(
        mine_block, FOUND.format("positive_id long, "))
    rank = F.row_number().over(
        Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id"))
    best = found.withColumn("rank", rank).filter(F.col("rank") <= settings.negatives)
    return best.join(positives.drop("anchors"), ["anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def mine_negatives(rows: DataFrame, is_anchor: Column,
                   settings: MiningSettings = MiningSettings()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows for which ``is_anchor``, an expression of ``vec_id``, holds. An anchor's
    positives are its best other rows of the same label; for each the best rows of other labels
    are returned whose score is between ``least_percent`` and ``most_percent`` of the positive's.
    Scores are inner products of the vectors in whole numbers; of equal ones the smaller id is
    better. Which rows take part states ``scaled``. An anchor without another row of its label,
    and a positive without a row in its window, has no result row. Other columns are not read.
    """
    ship_package(rows.sparkSession)
    fit = scaled(rows, settings)
    directions = reference_directions(fit, settings)
    packed = blocks(fit, directions, settings.block_bytes, settings)
    asked = blocks(fit.filter(is_anchor), directions, settings.anchor_bytes, settings)
    # numbered without gaps; there is a row per block of anchors, hundreds of thousands of rows each
    number = F.row_number().over(Window.orderBy("block")) - 1
    numbered = asked.select("block").withColumn("anchors", number.cast("long"))
    anchors = stage(asked.join(numbered, "block").drop("block"), "anchors")
    positives = _find_positives(anchors, packed, settings)
    return _find_negatives(anchors, packed, positives, settings)
