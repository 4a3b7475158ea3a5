"""SimHash near-duplicates, found at the anchors of a covering code.

Two fingerprints with at most ``2 * t`` differing bits differ in at most ``t`` bits in one of
their halves, and then some word is within ``t / 2`` (rounded up) of both halves. A code of
covering radius R has an anchor within R of that word, so both halves are within
``R + t / 2`` of that anchor. Each half goes to all anchors so near, and fingerprints are
compared per anchor. The code is the Hamming code of 31 bits (R = 1, 2^26 anchors), laid over
the low 31 bits of a half; its anchors near a word follow from the word's syndrome, so no
anchor list exists.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.common import KEYS, broadcast_if_small, stage, text_key
from fleetgauge.llm.components import components

SEED = 42
BITS = 31
RADIUS = 1


@dataclass(frozen=True)
class SimHashSettings:
    shingle: int = 4
    #: Most differing bits of two linked fingerprints; anchors are laid out for up to 4.
    distance: int = 4
    #: Fingerprints of an anchor that one task compares; fuller anchors are cut into blocks of
    #: this size and every pair of blocks is compared.
    block: int = 4096


def simhash(text: str | None, shingle: int = 4) -> int:
    """Majority bits of the hashes of the word shingles; 0 for a text without words.

    Fewer words than a shingle make one shingle of all. White space and A-Z are ASCII's.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    ones, done = np.zeros(64, np.int64), 0
    while done < n:  # long texts in parts: bounded memory
        part = min(n, done + 65536)
        hashes = np.array([digest(b" ".join(words[i:i + shingle]), SEED)
                           for i in range(done, part)], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
        done = part
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, settings: SimHashSettings = SimHashSettings()) -> DataFrame:
    """``docs`` with ``fingerprint``, 64 bits as a signed number. A column of that name is replaced."""
    shingle = settings.shingle

    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            values = np.array([simhash(t, shingle) for t in part], np.uint64)
            yield pd.Series(values.view(np.int64))

    return docs.drop("fingerprint").withColumn("fingerprint", of(F.col("text")))


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Syndrome in the Hamming code: the exclusive or of the (1-based) places of the ones."""
    out = np.zeros(len(words), np.uint64)
    for place in range(1, BITS + 1):
        out ^= ((words >> np.uint64(place - 1)) & np.uint64(1)) * np.uint64(place)
    return out


def anchors_near(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(index, anchor)``: all code words within 2 bits of each 31-bit word.

    A word with syndrome s is on the code if s = 0, and then no other code word is so near;
    else flipping place s, or any two places whose numbers give s, leads to the code.
    """
    syndromes, index, one = _syndromes(words), np.arange(len(words)), np.uint64(1)
    at, found = [index[syndromes == 0]], [words[syndromes == 0]]
    off = syndromes > 0
    s, w, k = syndromes[off], words[off], index[off]
    at.append(k)
    found.append(w ^ (one << (s - one)))
    for place in range(1, BITS + 1):
        p = np.uint64(place)
        other = s ^ p
        use = other > p  # each pair once; 0 would be the single flip
        at.append(k[use])
        found.append(w[use] ^ (one << (p - one)) ^ (one << (other[use] - one)))
    return np.concatenate(at), np.concatenate(found)


def _at_anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    mask = np.uint64((1 << BITS) - 1)
    for batch in batches:
        prints = batch["fingerprint"].to_numpy(np.int64)
        for start in range(0, len(prints), 20000):
            part = prints[start:start + 20000]
            for half in (0, 1):
                words = (part.view(np.uint64) >> np.uint64(32 * half)) & mask
                index, anchor = anchors_near(words)
                yield pd.DataFrame({
                    "anchor": anchor.astype(np.int64) * 2 + half, "fingerprint": part[index]})


def _spanning_links(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected within ``values``: one fewer than members.

    Searches breadth-first: a member is compared with those not reached yet only.
    """
    left, u, v = values, [], []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            node = queue.pop()
            near = np.bitwise_count(left ^ node) <= distance
            if near.any():
                found = left[near]
                u.append(np.full(len(found), node))
                v.append(found)
                queue.extend(found)
                left = left[~near]
    empty = np.array([], np.uint64)
    return (np.concatenate(u), np.concatenate(v)) if u else (empty, empty)


def links(prints: DataFrame, settings: SimHashSettings = SimHashSettings()) -> DataFrame:
    """Links ``u, v`` among distinct fingerprints that connect all that are near each other.

    Per anchor only a spanning forest is returned, never all pairs. An anchor with more than
    ``block`` fingerprints is cut into blocks by hash; each pair of blocks is a group of its own,
    so no task holds more than two blocks, and nothing near is missed.
    """
    if settings.distance > 4:
        raise ValueError("the anchors are laid out for at most 4 differing bits")
    distance, block = settings.distance, settings.block
    placed = stage(prints.mapInPandas(_at_anchors, "anchor long, fingerprint long"), "anchors")
    full = stage(
        placed.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
        .select("anchor", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "full-anchors")
    mine = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    grouped = (
        placed.join(full, "anchor")
        .select("anchor", "fingerprint", mine.alias("mine"), other.alias("other"))
        .select(F.xxhash64("anchor", F.least("mine", "other"), F.greatest("mine", "other"))
                .alias("group"), "fingerprint")
    )

    return _compared(grouped, distance)


def _compared(grouped: DataFrame, distance: int) -> DataFrame:
    """Compares the rows of each group. Groups are sorted runs of a partition."""
    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept_group, kept = np.array([], np.int64), np.array([], np.int64)

        def flush(group: np.ndarray, prints: np.ndarray) -> pd.DataFrame:
            u, v = _links_of_runs(group, prints.view(np.uint64), distance)
            return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

        for batch in batches:
            group = np.concatenate([kept_group, batch["group"].to_numpy(np.int64)])
            prints = np.concatenate([kept, batch["fingerprint"].to_numpy(np.int64)])
            whole = np.searchsorted(group, group[-1]) if len(group) else 0
            if whole:  # the last group may go on in the next batch
                yield flush(group[:whole], prints[:whole])
            kept_group, kept = group[whole:], prints[whole:]
        if len(kept):
            yield flush(kept_group, kept)

    return (
        grouped.repartition("group").sortWithinPartitions("group", "fingerprint")
        .mapInPandas(runs, "u long, v long").distinct()
    )


def _links_of_runs(group: np.ndarray, prints: np.ndarray,
                   distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of all groups of a sorted stretch; pairs of small groups at once."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    u, v = [], []
    for step in range(1, 8):  # groups of up to 8: compare with the neighbour `step` further
        first = np.repeat(sizes <= 8, sizes) & (
            np.arange(len(group)) + step < np.repeat(starts + sizes, sizes))
        i = np.flatnonzero(first)
        near = np.bitwise_count(prints[i] ^ prints[i + step]) <= distance
        near &= prints[i] != prints[i + step]
        u.append(prints[i[near]])
        v.append(prints[i[near] + step])
    for start, size in zip(starts[sizes > 8], sizes[sizes > 8], strict=True):
        a, b = _spanning_links(np.unique(prints[start:start + size]), distance)
        u.append(a)
        v.append(b)
    return np.concatenate(u), np.concatenate(v)


def _labelled(docs: DataFrame, settings: SimHashSettings) -> tuple[DataFrame, DataFrame]:
    """``doc_id, _key, _key2, fingerprint`` of every row, and ``fingerprint, root`` of each print."""
    lean = stage(
        fingerprints(docs.select("doc_id", "text", *text_key(F.col("text"))), settings)
        .drop("text"), "fingerprints")
    prints = stage(lean.select("fingerprint").distinct(), "distinct")
    roots = components(links(prints, settings))
    return lean, stage(
        prints.join(roots, F.col("fingerprint") == F.col("node"), "left")
        .select("fingerprint", F.coalesce("root", "fingerprint").alias("root")), "roots")


def near_duplicates(docs: DataFrame, settings: SimHashSettings = SimHashSettings()) -> DataFrame:
    """Per document ``doc_id, fingerprint, component_id``; repeated rows stay.

    Documents whose fingerprints differ in at most ``distance`` bits are linked; a component
    takes in all that links reach. ``component_id`` is its least non-null ``doc_id``. Texts
    without words, and null ones, have fingerprint zero and are linked like others. Copies are
    one fingerprint before anything is compared.
    """
    lean, roots = _labelled(docs, settings)
    first = lean.groupBy("fingerprint").agg(F.min("doc_id").alias("_least"))
    rooted = first.join(roots, "fingerprint")
    least = rooted.groupBy("root").agg(F.min("_least").alias("component_id"))
    named = stage(rooted.join(least, "root").select("fingerprint", "component_id"), "components")
    return lean.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one_each(docs: DataFrame, settings: SimHashSettings = SimHashSettings()) -> DataFrame:
    """``docs`` with one row of each component: that with the least ``doc_id``, nulls last.

    Of rows that share it, one with the least text hash stays, one row of equal ones.
    """
    lean, roots = _labelled(docs, settings)
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *KEYS)
    first = lean.groupBy("fingerprint").agg(F.min(row).alias("r"))
    kept = first.join(roots, "fingerprint").groupBy("root").agg(F.min("r").alias("r")).select("r.*")
    copies = lean.groupBy("doc_id", *KEYS).agg((F.count("*") > 1).alias("_copies")).filter("_copies")
    same = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (
        F.col(f"{a}._key") == F.col(f"{b}._key")) & (F.col(f"{a}._key2") == F.col(f"{b}._key2"))
    kept = stage(kept.alias("k").join(copies.alias("c"), same("k", "c"), "left").select(
        F.col("k.doc_id").alias("_id"), F.col("k._key").alias("_k"), F.col("k._key2").alias("_k2"),
        F.coalesce("c._copies", F.lit(False)).alias("_copies")), "kept")
    keyed = docs.withColumns(dict(zip(KEYS, text_key(F.col("text")), strict=True)))
    rows = keyed.join(broadcast_if_small(kept), F.col("doc_id").eqNullSafe(F.col("_id")) & (
        F.col("_key") == F.col("_k")) & (F.col("_key2") == F.col("_k2")))
    if kept.filter("_copies").isEmpty():
        return rows.select(*docs.columns)
    one = rows.filter("_copies").dropDuplicates(["doc_id", *KEYS])
    return rows.filter("NOT _copies").union(one).select(*docs.columns)
