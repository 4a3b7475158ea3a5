"""Exact duplicates: filters, batches, colliding digests, edge cases."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetgauge.llm import exact_dedup
from fleetgauge.llm.binary_fuse import build_filter
from fleetgauge.llm.exact_dedup import ExactSettings, exact_duplicates

#: Columns of documents, and some named like those that are made.
DOCS = "doc_id BIGINT, text STRING, n BIGINT, first STRING, kept STRING, _text STRING, _row INT"


def plain(rows):
    """``doc_id, keep_id, group_size, kept, text_sha256`` by a dictionary of texts."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), place == 0, digest) for place, i in enumerate(ids)]
    return sorted(out, key=str)


def found(docs, settings):
    return sorted((tuple(r) for r in exact_duplicates(docs, settings).collect()), key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 300, 20_000])
def test_filter_knows_its_keys(n):
    rng = np.random.default_rng(n)
    keys, others = (rng.integers(-1 << 62, 1 << 62, size, np.int64) for size in (n, 50_000))
    made = build_filter(np.r_[keys, keys[:5]])
    assert made.contains(keys).all()
    assert made.contains(others).mean() < 0.008


LONG = " ".join(f"w{i}" for i in range(30_000))
ROWS = [(1, "a  b"), (2, "a\tb"), (3, "a b "), (None, "a b"), (None, None), (5, ""), (5, ""), (5, ""),
        (4, None), (6, LONG), (7, LONG.replace(" ", "\n")), (8, LONG + "x"), (9, "ä b"),
        (10, "ä b"), (11, " \x0b\x0c"), (12, " "), (13, "a b"), (13, "c"), (None, "only null"),
        (None, "only null")]


@pytest.mark.parametrize("settings", [
    ExactSettings(), ExactSettings(batches=1), ExactSettings(batches=4, shard=2),
    ExactSettings(batches=3, shard=3, digits=1), ExactSettings(batches=2, digits=0)])
def test_equals_dictionary(frame, settings):
    docs = frame(DOCS, [(i, t, 1, "x", "y", "z", 3) for i, t in ROWS])
    assert found(docs, settings) == plain(ROWS)


def test_hot_text_without_broadcast(spark, monkeypatch):
    """A third of all rows hold one text; nothing fits a broadcast but the few hot groups."""
    monkeypatch.setattr(exact_dedup, "broadcast_if_small", lambda df: df)
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") % 3 == 0, "one text").otherwise(F.concat(F.lit("t"), F.col("id") % 700)).alias("text"))
    rows = [tuple(r) for r in docs.collect()]
    assert found(docs, ExactSettings(batches=2, shard=100, hot=10)) == plain(rows)


def test_no_rows(frame):
    assert found(frame(DOCS, []), ExactSettings()) == []


def test_filters_decide(spark, monkeypatch):
    """What the filters do not let through is new, so the answer depends on them."""
    docs = spark.range(60).select(
        F.col("id").alias("doc_id"), (F.col("id") % 30).cast("string").alias("text"))
    assert {r[2] for r in found(docs, ExactSettings())} == {2}
    monkeypatch.setattr(exact_dedup, "screen", lambda digests, *_: digests.limit(0))
    assert {r[2] for r in found(docs, ExactSettings())} == {1, 2}
