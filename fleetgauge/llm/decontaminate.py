"""Benchmark decontamination by winnowing: shared fingerprints, extended to whole windows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.common import KEYS, LOWER, UPPER, broadcast_if_small, stage, text_key

#: What separates words: ASCII other than digits and letters. Applied after lower-casing.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class WinnowSettings:
    #: Words of a window; a shared run of so many words is always found.
    window: int = 10
    #: Words of a fingerprinted k-gram. The sliding minimum spans ``window - gram + 1`` of them.
    gram: int = 4


def item_words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null has none."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NOT_WORD)
    return F.filter(parts, lambda w: w != "")  # only the ends can be empty


def _once(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once, however often ``f`` uses it."""
    return F.transform(F.array(value), f)[0]


def _head(items: Column, leave: int) -> Column:
    return F.slice(items, 1, F.greatest(F.size(items) - leave, F.lit(0)))


def _indices(n: Column) -> Column:
    """0 to n - 1; empty if n is not positive."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _gram_hashes(hashes: Column, n: int) -> Column:
    """A hash for each run of ``n`` words, from the hashes of the words. ``n`` is part of it."""
    return F.transform(_head(hashes, n - 1), lambda x, i: F.xxhash64(
        F.lit(n), x, *[F.get(hashes, i + k) for k in range(1, n)]))


def winnowed(grams: Column, settings: WinnowSettings) -> Column:
    """The k-gram hashes that are least in some sliding window.

    Which are chosen depends on the window's words alone, so equal windows share one.
    """
    span = settings.window - settings.gram + 1
    return F.array_distinct(F.transform(_head(grams, span - 1), lambda x, i: F.least(
        x, *[F.get(grams, i + k) for k in range(1, span)])))


def fingerprints(words: Column, lengths: list[int], settings: WinnowSettings) -> Column:
    """Fingerprints of a text: the winnowed k-grams and, for items too short for a full window,
    which winnowing doesn't promise to find, every run of their length."""
    def of(hashes: Column) -> Column:
        full = _once(_gram_hashes(hashes, settings.gram), lambda g: winnowed(g, settings))
        short = [F.array_distinct(_gram_hashes(hashes, n)) for n in lengths]
        return F.concat(full, *short) if short else full

    return _once(F.transform(words, lambda w: F.xxhash64(w)), of)


def item_windows(benchmark: DataFrame, settings: WinnowSettings = WinnowSettings()) -> DataFrame:
    """``n, window, items``: distinct windows with the sorted ids of the items that hold them.

    An item of fewer words, but not none, is one window. Rows with a null id count as an
    item without a name: their windows are looked for, but add no id.
    """
    words = benchmark.select("item_id", item_words(F.col("text")).alias("w")).filter("size(w) > 0")
    n = F.least(F.lit(settings.window), F.size("w"))
    return (
        words.select("item_id", n.alias("n"), F.explode(F.transform(
            _indices(F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i + 1, n), " "))
        ).alias("window"))
        .groupBy("n", "window").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )


def _covered(spans: Column) -> Column:
    """Words in the union of ``(start, n)`` spans."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum"))
    step = lambda a, x: F.struct(
        F.greatest(a["end"], x["start"] + x["n"]).alias("end"),
        (a["sum"] + F.greatest(x["start"] + x["n"] - F.greatest(a["end"], x["start"]), F.lit(0)))
        .alias("sum"))
    return F.aggregate(F.sort_array(spans), zero, step, lambda a: a["sum"])


def _candidate_windows(words: Column, found: Column, lengths: list[int],
                       settings: WinnowSettings) -> Column:
    """``(n, start, window)``: each run of words that holds a k-gram from ``found``."""
    reach = settings.window - settings.gram

    def starts(hashes: Column) -> Column:
        hits = lambda n: F.filter(F.transform(
            _gram_hashes(hashes, n), lambda h, i: F.when(F.array_contains(found, h), i)),
            lambda i: i.isNotNull())
        around = lambda i: F.sequence(
            F.greatest(i - reach, F.lit(0)), F.least(i, F.size(hashes) - settings.window))
        full = F.array_distinct(F.flatten(F.transform(F.filter(
            hits(settings.gram), lambda i: F.greatest(i - reach, F.lit(0)) <= F.size(hashes) - settings.window), around)))
        one = lambda n, at: F.transform(at, lambda s: F.struct(
            F.lit(n).alias("n"), s.alias("start"),
            F.array_join(F.slice(words, s + 1, n), " ").alias("window")))
        return F.concat(one(settings.window, full), *[one(n, hits(n)) for n in lengths])

    return _once(F.transform(words, lambda w: F.xxhash64(w)), starts)


def _short_lengths(windows: DataFrame, settings: WinnowSettings) -> list[int]:
    """Lengths of the short items, at most ``window - 1`` numbers."""
    return sorted(r[0] for r in windows.select("n").distinct().collect() if r[0] < settings.window)


def fingerprinted(docs: DataFrame, lengths: list[int], settings: WinnowSettings) -> DataFrame:
    """``doc_id, _key, _key2, n_words, prints`` of every document, staged: one read of the texts."""
    words = docs.select("doc_id", *text_key(F.col("text")), item_words(F.col("text")).alias("w"))
    return stage(words.select("doc_id", *KEYS, F.size("w").cast("long").alias("n_words"),
                              fingerprints(F.col("w"), lengths, settings).alias("prints")), "prints")


def _hits(docs: DataFrame, printed: DataFrame, windows: DataFrame, lengths: list[int],
          settings: WinnowSettings) -> DataFrame:
    """``_key, _key2, spans, n_hit, items`` of the distinct texts that share a window.

    Only texts that share a fingerprint are read again; around each shared k-gram every
    window that holds it is compared with the items' windows word by word.
    """
    wanted = stage(
        windows.select(fingerprints(F.split("window", " "), lengths, settings).alias("p"))
        .select(F.explode("p").alias("h")).distinct(), "item-prints")
    shared = stage(
        printed.select(*KEYS, F.explode("prints").alias("h"))
        .join(broadcast_if_small(wanted), "h")
        .groupBy(*KEYS).agg(F.collect_set("h").alias("found")), "shared")
    texts = docs.select(*text_key(F.col("text")), "text").join(broadcast_if_small(shared), KEYS)
    candidates = texts.select(*KEYS, "found", item_words(F.col("text")).alias("w")).select(
        *KEYS, F.explode(_candidate_windows(F.col("w"), F.col("found"), lengths, settings))
        .alias("c")).select(*KEYS, "c.*")
    return (
        candidates.join(broadcast_if_small(windows), ["n", "window"])
        .groupBy(*KEYS).agg(
            F.collect_set(F.struct("start", "n")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
        .select(*KEYS, "spans", _covered(F.col("spans")).cast("long").alias("n_hit"), "items")
    )


def find_contamination(docs: DataFrame, benchmark: DataFrame,
                       settings: WinnowSettings = WinnowSettings()) -> DataFrame:
    """Per document ``doc_id, n_words, n_hit, items, contaminated``; repeated rows stay.

    A word inside any occurrence of an item's window is hit. Null texts have no words. No
    item, or items without words, hit nothing.
    """
    windows = stage(item_windows(benchmark, settings), "windows")
    lengths = _short_lengths(windows, settings)
    printed = fingerprinted(docs, lengths, settings)
    hits = stage(_hits(docs, printed, windows, lengths, settings).drop("spans"), "hits")
    return (
        printed.drop("prints").join(broadcast_if_small(hits), KEYS, "left").drop(*KEYS)
        .withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
        .withColumn("items", F.coalesce(F.col("items"), F.array().cast(
            hits.schema["items"].dataType)))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame,
                      settings: WinnowSettings = WinnowSettings()) -> DataFrame:
    """``docs`` without the rows whose text shares a window with an item."""
    windows = stage(item_windows(benchmark, settings), "windows")
    lengths = _short_lengths(windows, settings)
    printed = fingerprinted(docs, lengths, settings)
    hits = stage(_hits(docs, printed, windows, lengths, settings).select(*KEYS), "hits")
    keyed = docs.withColumns(dict(zip(KEYS, text_key(F.col("text")), strict=True)))
    return keyed.join(broadcast_if_small(hits), KEYS, "left_anti").drop(*KEYS)
