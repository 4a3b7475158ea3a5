"""Quality rules: counts of the text itself, then an n-gram log-likelihood ratio.

The n-grams (words and pairs of words, by 64-bit hashes) are counted in a distributed table that
grows with the corpus. The least ratio of a kept document comes from good documents that the
model has not seen, so it follows the model whatever the corpus.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.common import (
    BROADCAST_BYTES, KEYS, WHITE, broadcast_if_small, ranked, shuffles_dropped, stage, staged_bytes,
    text_key, words_of)

SYMBOLS = "#*$%&|<>"
#: The hashes of words are staged as numbers of a dictionary for each file.
WORD_PAGES = {"parquet.dictionary.page.size": str(32 << 20)}


@dataclass(frozen=True)
class QualitySettings:
    least_words: int = 50
    #: Most words in repeated windows, in hundredths.
    repeat_percent: int = 50
    window: int = 3
    #: Share of the corpus distribution in the smoothed target distribution.
    backoff: float = 0.5
    #: One in so many good texts, by hash, is no part of the target and sets the least ratio.
    held: int = 5
    #: Share of those held-out good texts that may fall below the least ratio.
    lost: float = 0.01
    #: Most frequent n-grams that are looked up by broadcast.
    frequent: int = 1 << 19
    #: One in so many texts is read to find the frequent n-grams; any would do for the result.
    sample: int = 16
    #: Ranges of hashes in which the other n-grams of a large corpus are counted.
    ranges: int = 6



def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _head(items: Column, leave: int) -> Column:
    """All but the last ``leave`` items."""
    return F.slice(items, 1, F.greatest(F.size(items) - leave, F.lit(0)))


def _grams(hashes: Column, n: int) -> Column:
    """Hashes of the windows of ``n`` words, by the hashes of their words."""
    return F.transform(_head(hashes, n - 1), lambda x, i: F.xxhash64(
        x, *[F.get(hashes, i + k) for k in range(1, n)]))


def _covered(grams: Column, n: int) -> Column:
    """Words in windows of ``n`` whose hash occurs twice or more, each word once."""
    pairs = F.sort_array(F.transform(grams, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    starts = lambda st: F.sort_array(F.transform(F.filter(st, lambda x, j: (
        F.coalesce(F.get(st, j - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(st, j + 1)["h"] == x["h"], F.lit(False)))), lambda x: x["i"]))
    lengths = lambda at: F.transform(at, lambda p, j: F.least(
        F.lit(n), F.coalesce(F.get(at, j + 1) - p, F.lit(n))))
    # each step is bound to a name by a one-element transform, so that it is computed once
    once = lambda value, f: F.transform(F.array(value), f)[0]
    total = once(pairs, lambda st: once(starts(st), lambda at: F.aggregate(
        lengths(at), F.lit(0), lambda a, x: a + x)))
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), total).otherwise(0)


def n_grams_of(n_words: Column) -> Column:
    """Words and pairs of words."""
    return n_words + F.greatest(n_words - 1, F.lit(0))


def base_counts(docs: DataFrame, settings: QualitySettings = QualitySettings(),
                hashes: bool = False) -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``.

    Null and blank texts have zeros and fail. Windows are compared by 64-bit hashes within one
    text. Columns named like the new ones are replaced. With ``hashes`` also ``_hashes``, those
    of the words.
    """
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    text = F.coalesce(F.col("text"), F.lit(""))
    symbols = F.regexp_replace(text, f"[^{SYMBOLS}]+", "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    n = settings.window
    counted = (
        docs.drop(*added)
        .withColumns({"_words": words_of(F.col("text")), "_lines": lines})
        .withColumns({
            "_hashes": _hashes(F.col("_words")),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.length(symbols).cast("long")})
        .withColumns({
            "n_words": F.size("_hashes").cast("long"),
            "_grams": _grams(F.col("_hashes"), n)})
        .withColumns({
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": _covered(F.col("_grams"), n).cast("long")})
    )
    failed = (F.col("n_words") < settings.least_words) | (
        100 * F.col("n_repeat_words") > settings.repeat_percent * F.col("n_words"))
    return counted.withColumn("base_failed", failed).drop(
        "_words", "_lines", "_grams", *([] if hashes else ["_hashes"]))


def _with_target(docs: DataFrame, labels: DataFrame, settings: QualitySettings) -> DataFrame:
    """``docs`` (with ``KEYS``) with ``_good``, and ``_target``, which held-out good texts are not.

    Good are the documents that ``labels`` calls good (``quality`` 1 in all its rows).
    """
    good = stage(labels.groupBy("doc_id").agg(F.min("quality").alias("_quality"))
                 .filter("doc_id IS NOT NULL AND _quality = 1")
                 .select(F.col("doc_id").alias("_id"), F.lit(1).alias("_one")), "good")
    is_good = F.col("_one").isNotNull()
    unseen = F.pmod(F.col("_key2"), F.lit(settings.held)) == 0
    return docs.join(broadcast_if_small(good), F.col("doc_id") == F.col("_id"), "left").withColumns(
        {"_good": is_good, "_target": (is_good & ~unseen).cast("int")}).drop("_id", "_one")


def _grams_of(counted: DataFrame) -> DataFrame:
    """``gram, _row`` of every n-gram of the staged ``counted``, repeats included."""
    after = F.slice("_hashes", 2, F.greatest(F.size("_hashes") - 1, F.lit(0)))
    pairs = counted.select("_row", F.inline(F.arrays_zip(
        F.col("_hashes").alias("a"), after.alias("b"))).alias("a", "b"))
    both = F.array("a", F.when(F.col("b").isNotNull(), F.xxhash64("a", "b")))
    return pairs.select(F.explode(both).alias("gram"), "_row").filter("gram IS NOT NULL")


def gram_counts(grams: DataFrame) -> DataFrame:
    """``gram, n, n_target`` of every n-gram of the target that occurs twice or more.

    ``n`` counts all documents, ``n_target`` the target. One that occurs once needs no row: its
    counts are those of the document that holds it. Nor does one that the target lacks: its
    share of the target is 0 however often it occurs.
    """
    return grams.groupBy("gram").agg(
        F.count("*").alias("n"), F.sum(F.col("_row").bitwiseAND(F.lit(1))).alias("n_target")
    ).filter("n > 1 AND n_target > 0")


def _frequent(counts: DataFrame, most: int) -> int:
    """Least power of two so that at most ``most`` n-grams occur so often."""
    classes = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).count().collect()
    total, least = 0, 62
    for k, n in sorted(map(tuple, classes), reverse=True):
        total += n
        if total > most:
            break
        least = k
    return 1 << least


def text_ratios(counted: DataFrame, totals: tuple[int, int],
                settings: QualitySettings = QualitySettings()) -> DataFrame:
    """``counted`` with ``ratio``: mean log of target over corpus probability of a text's n-grams.

    A text without any has 0. ``counted`` is staged and has ``_row`` (odd for the target),
    ``_hashes`` of the words, and ``n_words``. ``totals`` are the n-grams of corpus and target.
    The target is mixed with ``backoff`` parts of the corpus distribution, so a ratio is at
    least ``log(backoff)``.

    N-grams that are frequent in a sample of the texts would be hot keys: they are counted by
    themselves and broadcast. All others meet their counts by a shuffle, in ``ranges`` of their
    hashes one after the other, so that only one range of them is on disk at a time. Sums
    are of whole numbers, so their order does not matter.
    """
    spark = counted.sparkSession
    log_of = lambda share: F.log(
        (1 - settings.backoff) * share * F.lit(totals[0] / totals[1]) + settings.backoff)
    whole = lambda ratio: F.round(ratio * (1 << 36)).cast("long")
    ratio = whole(log_of(F.col("n_target") / F.col("n"))).alias("_ratio")
    # what an n-gram without a count has: it occurs once, in this text, or not in the target
    odd = F.col("_row").bitwiseAND(F.lit(1)) == 1
    alone = F.when(odd, whole(log_of(F.lit(1)))).otherwise(whole(log_of(F.lit(0))))
    summed = lambda rows: rows.groupBy("_row").agg(
        F.sum(F.col("_ratio") - alone).alias("_sum"))
    grams = _grams_of(counted)
    some = _grams_of(counted.filter(F.pmod(F.xxhash64("_row"), F.lit(settings.sample)) == 0))
    ranges = 1 if staged_bytes(counted) <= BROADCAST_BYTES else settings.ranges
    with shuffles_dropped(spark):
        sampled = stage(some.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1"), "gram-sample")
        often = F.broadcast(
            sampled.filter(F.col("n") >= _frequent(sampled, settings.frequent)).select("gram"))
        known = stage(gram_counts(grams.join(often, "gram")).select("gram", ratio), "gram-ratios")
        parts = [stage(summed(grams.join(F.broadcast(known), "gram")), "gram-sums")]
        for k in range(ranges):
            rest = (grams.filter(F.pmod("gram", F.lit(ranges)) == k)
                    .join(often, "gram", "left_anti").repartition("gram"))
            here = gram_counts(rest).select("gram", ratio).hint("shuffle_hash")
            parts.append(stage(summed(rest.join(here, "gram")), "gram-sums"))
        sums = stage(reduce(DataFrame.union, parts).groupBy("_row").agg(
            F.sum("_sum").alias("_sum")), "text-sums")
    size = n_grams_of(F.col("n_words"))
    total = F.coalesce("_sum", F.lit(0)) + size * alone
    mean = F.when(size > 0, F.round(total / size / (1 << 36), 9)).otherwise(0.0)
    return counted.drop("_hashes").join(broadcast_if_small(sums), "_row", "left").withColumn(
        "ratio", mean).drop("_row", "_sum")


def _least_ratio(held: DataFrame, settings: QualitySettings) -> float | None:
    """The ratio of exact rank ``lost`` among ``held``; none if there are no rows."""
    places = ranked(held.select("ratio"), [F.col("ratio")], "_place")
    place = max(math.ceil(settings.lost * places.count()), 1) - 1
    found = places.filter(F.col("_place") == place).first()
    return found and found["ratio"]


def judge_quality(docs: DataFrame, labels: DataFrame,
                  settings: QualitySettings = QualitySettings()) -> DataFrame:
    """Per document ``doc_id``, the columns of ``base_counts``, ``ratio`` and ``kept``.

    ``ratio`` is the mean log ratio of the text's n-grams, 0 if it has none or if there is no
    target. ``kept`` is false if ``base_failed``, else true if ``ratio`` reaches what all but the
    share ``lost`` of the held-out good texts reach. Repeated rows stay; equal texts get equal
    ratios. The hashes of the words are kept with the counts, the n-grams are made of them.
    """
    keyed = dict(zip(KEYS, text_key(F.col("text")), strict=True))
    marked = _with_target(docs.select("doc_id", "text").withColumns(keyed), labels, settings)
    row = (2 * F.monotonically_increasing_id() + F.col("_target")).alias("_row")
    based = base_counts(marked, settings, hashes=True).drop("text", *KEYS).select("*", row)
    counted = stage(based, "counted", WORD_PAGES)
    size = n_grams_of(F.col("n_words"))
    totals = counted.agg(F.sum(size), F.sum(size * F.col("_target"))).first()
    if not totals[1]:
        return counted.drop("_row", "_hashes", "_good", "_target").withColumns(
            {"ratio": F.lit(0.0), "kept": ~F.col("base_failed")})
    judged = stage(text_ratios(counted, (totals[0], totals[1]), settings), "judged")
    least = _least_ratio(judged.filter("_good AND _target = 0 AND NOT base_failed"), settings)
    enough = F.lit(True) if least is None else F.col("ratio") >= least
    return judged.drop("_good", "_target").withColumn("kept", ~F.col("base_failed") & enough)
