"""Removal of byte strings that occur elsewhere, by a hash-compared sort of suffixes.

A window of ``length`` bytes is known by its anchor: the first of its ``gram``-byte strings
with the least hash. Equal windows have equal anchors at equal offsets, so windows only have
to be compared among anchors with the same hash. There the suffixes from the anchors, and the
text before them, are sorted by merging; two are compared by their longest common extension,
found by binary search over prefix polynomial hashes. What neighbours share is verified byte by
byte. From the two orders follows which windows are equal.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.codepoints import mixed
from fleetgauge.llm.common import KEYS, broadcast_if_small, stage, text_key

#: Windows of a text that are looked at at once.
PIECE = 60_000
#: Bytes of contexts that are sorted at once; a group of equal anchors is never split.
CHUNK = 2 << 20
#: Bytes that are hashed at once, so that only the sums are as long as the contexts.
BLOCK = 1 << 16


@dataclass(frozen=True)
class RepeatSettings:
    length: int = 400
    gram: int = 64
    #: Anchors of one hash up to which one task sorts them. The windows of more frequent ones
    #: are counted by hash over the cluster instead, which needs no group in one place.
    group: int = 8192


def _random(seed: int) -> tuple[np.ndarray, int]:
    """A random odd value per byte, and an odd base."""
    rng = np.random.default_rng(seed)
    values = rng.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    return values, int(rng.integers(1 << 60, 1 << 61)) * 8 + 5


@cache
def _powers(seed: int, bits: int, inverse: bool = False) -> np.ndarray:
    """Powers of the base, or of its inverse, below ``2 ** bits``."""
    base = _random(seed)[1]
    factor = pow(base, -1, 1 << 64) if inverse else base
    powers = np.ones(1 << bits, np.uint64)
    for k in range(bits):
        half = 1 << k
        np.multiply(powers[:half], np.uint64(pow(factor, half, 1 << 64)), out=powers[half:2 * half])
    return powers


def _bits(data: np.ndarray) -> int:
    return max(17, len(data).bit_length())


def _prefix_hashes(data: np.ndarray, seed: int) -> np.ndarray:
    values, powers = _random(seed)[0], _powers(seed, _bits(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    for start in range(0, len(data), BLOCK):
        end = min(start + BLOCK, len(data))
        terms = values[data[start:end]]
        terms *= powers[start:end]
        terms[:1] += sums[start:start + 1]
        np.cumsum(terms, out=sums[start + 1:end + 1])
    return sums


def _string_hashes(data: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of the ``n`` bytes from each place on."""
    sums, m = _prefix_hashes(data, seed), len(data) - n + 1
    return mixed((sums[n:] - sums[:m]) * _powers(seed, _bits(data), True)[:m])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width``, by least values up to and from block borders."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.uint64(2**64 - 1))
    padded[:len(values)] = values
    grid = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], forward[width - 1:width - 1 + n])


def anchors(data: np.ndarray, settings: RepeatSettings) -> Iterator[tuple[int, int, int, int]]:
    """``(hash, at, first, last)``: an anchor and the starts of the windows that it is that of."""
    low = np.uint64(0xFFFF)
    width = settings.length - settings.gram + 1
    for start in range(0, len(data) - settings.length + 1, PIECE):
        part = data[start:start + PIECE + settings.length - 1]
        hashes = _string_hashes(part, settings.gram, 1)
        # the low bits give way to the place: the first of equal hashes is the least
        placed = (hashes | low) ^ low | np.arange(len(hashes), dtype=np.uint64)
        least = _sliding_least(placed, width)
        at = (least & low).astype(np.int64)
        change = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[change[1:], len(at)] - 1
        for c, e in zip(change.tolist(), last.tolist(), strict=True):
            a = int(at[c])
            yield int(hashes[a].view(np.int64)), start + a, start + c, start + e


def _contexts(settings: RepeatSettings, whole: bool):
    """Anchors of texts; with ``whole`` also the bytes that the windows of each span."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, size = [], 0
            for key, key2, text in zip(batch["_key"], batch["_key2"], batch["text"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                data = np.frombuffer(raw, np.uint8)
                for value, at, first, last in anchors(data, settings):
                    if whole:
                        end = last + settings.length
                        rows.append((value, key, key2, first, at - first, raw[first:end]))
                        size += end - first
                    else:
                        rows.append((value,))
                    if size > CHUNK or len(rows) > 100_000:
                        yield pd.DataFrame(rows, columns=names)
                        rows, size = [], 0
            yield pd.DataFrame(rows, columns=names)

    names = ["anchor", *KEYS, "first", "offset", "bytes"] if whole else ["anchor"]
    return of


CONTEXT = "anchor long, _key long, _key2 long, first long, offset int, bytes binary"
SPAN = "_key long, _key2 long, start long, end long"


class _Sorter:
    """Suffixes of a buffer in groups, sorted by extension forwards or backwards."""

    def __init__(self, data: np.ndarray, sums: np.ndarray, at: np.ndarray, reach: np.ndarray,
                 forward: bool, seed: int):
        self.data, self.sums, self.at, self.reach, self.forward = data, sums, at, reach, forward
        self.powers = _powers(seed, _bits(data))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Longest common extension of suffixes ``i`` and ``j``, by binary search."""
        x, y = self.at[i], self.at[j]
        low, high = np.zeros(len(i), np.int64), np.minimum(self.reach[i], self.reach[j])
        while (low < high).any():
            middle = (low + high + 1) // 2
            back = 0 if self.forward else middle
            xs, ys = x - back, y - back
            same = (self.sums[xs + middle] - self.sums[xs]) * self.powers[ys] == (
                self.sums[ys + middle] - self.sums[ys]) * self.powers[xs]
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def less(self, i: np.ndarray, j: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix ``i`` sorts before ``j``; a prefix sorts first."""
        n = self.common(i, j)
        end_i, end_j = n >= self.reach[i], n >= self.reach[j]
        step = (lambda k: self.at[k] + n) if self.forward else (lambda k: self.at[k] - 1 - n)
        last = len(self.data) - 1
        a = self.data[np.clip(step(i), 0, last)]
        b = self.data[np.clip(step(j), 0, last)]
        return np.where(end_i | end_j, np.where(end_i & end_j, or_equal, end_i), a < b)

    def order(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Suffixes in sorted order within each group: a merge sort of all groups at once."""
        n = len(self.at)
        order, run = np.arange(n), 1
        begin, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
        place = np.arange(n) - begin
        while run < sizes.max(initial=1):
            own = place // run
            other = own ^ 1
            first = begin + other * run
            length = np.clip(size - other * run, 0, run)
            low, high = np.zeros(n, np.int64), length.copy()
            left = own % 2 == 0
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                theirs, mine = order[first[open_] + middle], order[open_]
                # of equal ones those of the left run come first
                before = self.less(theirs, mine, ~left[open_])
                low[open_] = np.where(before, middle + 1, low[open_])
                high[open_] = np.where(before, high[open_], middle)
            target = begin + (own // 2) * 2 * run + place % run + low
            merged = np.empty(n, np.int64)
            merged[target] = order
            order, run = merged, run * 2
        return order

    def neighbours(self, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Common extension of each suffix with the one before it, verified; -1 at a group's start."""
        shared = np.full(len(order), -1, np.int64)
        inner = np.ones(len(order), bool)
        inner[starts] = False
        at = np.flatnonzero(inner)
        shared[at] = self.common(order[at - 1], order[at])
        for k in at.tolist():
            n = int(shared[k])
            x, y = int(self.at[order[k - 1]]), int(self.at[order[k]])
            back = 0 if self.forward else n
            if self.data[x - back:x - back + n].tobytes() != self.data[y - back:y - back + n].tobytes():
                raise _Collision
        return shared


class _Collision(Exception):
    """Two different strings have one hash; another base tells them apart."""


def repeated_windows(groups: np.ndarray, pieces: list[bytes], offsets: np.ndarray,
                     settings: RepeatSettings) -> Iterator[tuple[int, int, int]]:
    """``(i, a, b)``: windows a to b of context i occur in another context of its group.

    ``groups`` is sorted; ``offsets`` are the places of the anchors in the contexts.
    """
    for seed in range(2, 12):
        try:
            yield from _repeated_windows(groups, pieces, offsets, settings, seed)
            return
        except _Collision:
            continue
    raise RuntimeError("no hash tells the suffixes apart")


def _repeated_windows(groups, pieces, offsets, settings, seed) -> list[tuple[int, int, int]]:
    sizes_all = np.array([len(p) for p in pieces], np.int64)
    base = np.r_[0, np.cumsum(sizes_all)[:-1]]
    data = np.frombuffer(b"".join(pieces), np.uint8)
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    sizes = np.diff(np.r_[starts, len(groups)])
    at, n, length = base + offsets, len(groups), settings.length
    classes, most, sums = [], [], _prefix_hashes(data, seed)
    for forward, reach in ((True, sizes_all - offsets), (False, offsets)):
        sorter = _Sorter(data, sums, at, reach, forward, seed)
        order = sorter.order(starts, sizes)
        shared = sorter.neighbours(order, starts)
        after = np.r_[shared[1:], -1]
        best = np.empty(n, np.int64)
        best[order] = np.maximum(shared, after)
        classes.append((order, shared))
        most.append(best)
    windows = sizes_all - length + 1
    # offsets of the anchor in a window that may have an equal one
    low = np.maximum(np.maximum(offsets - windows + 1, length - most[0]), 0)
    high = np.minimum(offsets, most[1])
    hits: list[tuple[np.ndarray, int]] = []
    able = np.flatnonzero(low <= high)
    if not len(able):
        return []
    label = np.empty((2, n), np.int64)
    for o in range(int(low[able].min()), int(high[able].max()) + 1):
        active = able[(low[able] <= o) & (o <= high[able])]
        if len(active) < 2:
            continue
        for k, need in ((0, length - o), (1, o)):
            order, shared = classes[k]
            label[k][order] = np.cumsum(shared < need)
        pair = label[0][active] * (n + 1) + label[1][active]
        rank = np.argsort(pair, kind="stable")
        same = pair[rank][1:] == pair[rank][:-1]
        found = active[rank[np.r_[same, False] | np.r_[False, same]]]
        if len(found):
            hits.append((found, o))
    if not hits:
        return []
    which = np.concatenate([f for f, _ in hits])
    start = offsets[which] - np.concatenate([np.full(len(f), o) for f, o in hits])
    rank = np.lexsort((start, which))
    which, start = which[rank], start[rank]
    first = np.flatnonzero(np.r_[True, (which[1:] != which[:-1]) | (start[1:] != start[:-1] + 1)])
    last = np.r_[first[1:], len(which)] - 1
    return list(zip(which[first].tolist(), start[first].tolist(), start[last].tolist(), strict=True))


def _compared(settings: RepeatSettings):
    """Spans of the windows that occur twice, from contexts sorted by anchor."""
    def flush(rows: pd.DataFrame) -> pd.DataFrame:
        size = rows.groupby("anchor", sort=False)["anchor"].transform("size")
        rows = rows[size > 1]
        if not len(rows):
            return pd.DataFrame({c: np.array([], np.int64) for c in (*KEYS, "start", "end")})
        pieces = [bytes(b) for b in rows["bytes"]]
        found = list(repeated_windows(rows["anchor"].to_numpy(np.int64), pieces,
                                      rows["offset"].to_numpy(np.int64), settings))
        at = np.array([f[0] for f in found], np.int64)
        first = rows["first"].to_numpy(np.int64)[at]
        return pd.DataFrame({
            "_key": rows["_key"].to_numpy(np.int64)[at], "_key2": rows["_key2"].to_numpy(np.int64)[at],
            "start": first + np.array([f[1] for f in found], np.int64),
            "end": first + np.array([f[2] for f in found], np.int64) + settings.length})

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for start in range(0, len(batch), 1000):
                part = batch.iloc[start:start + 1000]
                held.append(part)
                size += int(part["bytes"].map(len).sum())
                if size < CHUNK:
                    continue
                rows = pd.concat(held)
                anchor = rows["anchor"].to_numpy(np.int64)
                whole = int(np.searchsorted(anchor, anchor[-1]))
                if whole:  # the last group may go on
                    yield flush(rows.iloc[:whole])
                    held = [rows.iloc[whole:]]
                    size = int(held[0]["bytes"].map(len).sum())
        if held:
            yield flush(pd.concat(held))

    return of


def _window_hashes(settings: RepeatSettings):
    """``h, h2``: two independent hashes of every window of a context, with its place."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 500):
                part = batch.iloc[start:start + 500]
                data = [np.frombuffer(bytes(b), np.uint8) for b in part["bytes"]]
                sizes = [len(d) - settings.length + 1 for d in data]
                h, h2 = (np.concatenate([_string_hashes(d, settings.length, s) for d in data])
                         for s in (21, 22))
                yield pd.DataFrame({
                    "h": h.view(np.int64), "h2": h2.view(np.int64),
                    "c": np.repeat(part["c"].to_numpy(np.int64), sizes),
                    "c2": np.repeat(part["c2"].to_numpy(np.int64), sizes),
                    "place": np.concatenate([np.arange(n, dtype=np.int64) for n in sizes])})

    return of


def _spans_by_hash(placed: DataFrame, settings: RepeatSettings) -> DataFrame:
    """Spans at frequent anchors, where no task sees a whole group.

    Equal contexts are repeated from end to end. Of each different context the windows are
    hashed to 128 bits and counted over the cluster.
    """
    rows = stage(placed.select(
        *KEYS, "first", F.octet_length("bytes").cast("long").alias("size"), "bytes",
        F.xxhash64("bytes").alias("c"), F.xxhash64(F.lit(5), F.col("bytes"), F.lit(9)).alias("c2")),
        "frequent")
    contexts = stage(rows.groupBy("c", "c2").agg(
        F.count("*").alias("n"), F.min("bytes").alias("bytes")), "contexts")
    windows = stage(contexts.select("c", "c2", "bytes").mapInPandas(
        _window_hashes(settings), "h long, h2 long, c long, c2 long, place long"), "windows")
    twice = stage(windows.groupBy("h", "h2").agg(F.count("*").alias("n")).filter("n > 1")
                  .select("h", "h2"), "twice")
    empty = F.array().cast("array<struct<a:bigint,b:bigint>>")
    one = lambda a, b: F.array(F.struct(a.alias("a"), b.alias("b")))
    joined = lambda runs, p: F.when(
        (F.size(runs) > 0) & (F.get(runs, F.size(runs) - 1)["b"] == p - 1),
        F.concat(F.slice(runs, 1, F.size(runs) - 1), one(F.get(runs, F.size(runs) - 1)["a"], p))
    ).otherwise(F.concat(runs, one(p, p)))
    found = (
        windows.join(broadcast_if_small(twice), ["h", "h2"])
        .groupBy("c", "c2").agg(F.collect_set("place").alias("places"))
        .select("c", "c2", F.explode(F.aggregate(F.sort_array("places"), empty, joined)).alias("r"))
        .select("c", "c2", F.col("r.a").alias("a"), (F.col("r.b") + settings.length).alias("b"))
    )
    equal = contexts.filter("n > 1").select(
        "c", "c2", F.lit(0).cast("long").alias("a"), F.octet_length("bytes").cast("long").alias("b"))
    parts = stage(found.union(equal), "frequent-spans")
    return rows.drop("bytes").join(broadcast_if_small(parts), ["c", "c2"]).select(
        *KEYS, (F.col("first") + F.col("a")).alias("start"), (F.col("first") + F.col("b")).alias("end"))


def repeated_spans(texts: DataFrame, settings: RepeatSettings = RepeatSettings()) -> DataFrame:
    """``_key, _key2, start, end``: spans of ``texts (_key, _key2, text)`` that occur elsewhere.

    Anchors are counted first, so only the surroundings of those that occur twice are shuffled.
    Anchors above ``group`` occurrences do not meet in one task: hashes of their windows, 128
    bits each, are counted over the cluster.
    """
    counted = stage(
        texts.select(*KEYS, "text").mapInPandas(_contexts(settings, False), "anchor long")
        .groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
        .select("anchor", (F.col("n") > settings.group).alias("frequent")), "anchors")
    placed = texts.select(*KEYS, "text").mapInPandas(_contexts(settings, True), CONTEXT).join(
        broadcast_if_small(counted), "anchor")
    kept = ["anchor", *KEYS, "first", "offset", "bytes"]
    spans = (
        placed.filter("NOT frequent").select(*kept)
        .repartition("anchor").sortWithinPartitions("anchor")
        .mapInPandas(_compared(settings), SPAN)
    )
    if counted.filter("frequent").isEmpty():
        return spans
    return spans.union(_spans_by_hash(placed.filter("frequent"), settings))


def _cut(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The bytes outside the spans, and the number of maximal removed runs."""
    kept, at, runs = [], 0, 0
    for start, end in sorted(spans):
        if end <= at:
            continue
        if start > at or not runs:
            runs += 1
            kept.append(raw[at:start])
        at = max(at, end)
    kept.append(raw[at:])
    return b"".join(kept), runs


def remove_repeats(docs: DataFrame, settings: RepeatSettings = RepeatSettings()) -> DataFrame:
    """Per document ``doc_id, n_bytes, n_removed, n_spans, kept``; repeated rows stay.

    Every byte inside a string of ``length`` bytes that also starts elsewhere, in this or another
    row, goes. ``kept`` is what is left, as bytes. Null texts are empty. A text that occurs twice
    and is long enough goes whole, and only one copy of it is compared with other texts.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text", *text_key(F.col("text")))
    long = keyed.filter(F.octet_length("text") >= settings.length)
    copies = stage(
        long.groupBy(*KEYS).agg(F.min("doc_id").alias("_least"), F.count("*").alias("n"))
        .filter("n > 1").select(*KEYS, "_least", F.lit(True).alias("_copied")), "copies")
    texts = (
        long.join(broadcast_if_small(copies), KEYS, "left")
        .filter("_copied IS NULL OR doc_id <=> _least").select(*KEYS, "text")
    )
    spans = stage(
        repeated_spans(texts, settings).groupBy(*KEYS)
        .agg(F.collect_set(F.struct("start", "end")).alias("_spans")), "spans")
    joined = (
        keyed.join(broadcast_if_small(spans), KEYS, "left")
        .join(broadcast_if_small(copies.drop("_least")), KEYS, "left")
        .select("doc_id", "text", "_spans", F.coalesce("_copied", F.lit(False)).alias("_copied"))
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                raw = row.text.encode("utf-8", "surrogatepass")
                if row[3]:
                    spans = [(0, len(raw))]
                else:
                    spans = [] if row[2] is None else [(s["start"], s["end"]) for s in row[2]]
                kept, runs = _cut(raw, spans)
                rows.append((row.doc_id, len(raw), len(raw) - len(kept), runs, kept))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInPandas(
        cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(kept: DataFrame) -> DataFrame:
    """``kept`` as the lowercase hex of its SHA-256."""
    return kept.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


