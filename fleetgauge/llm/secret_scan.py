"""Secret scan: fixed patterns, then randomness tests of key-like runs of characters.

Spans are half-open and count code points. All of it is column expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns by kind, in order of rank, with the least length of a finding.
ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
ASSIGN_LEAST = 8

#: Alphabets that an encoding is inferred from, smallest first. Fixed values.
ENCODINGS = (
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)


@dataclass(frozen=True)
class SecretSettings:
    #: Least length of a run that is tested.
    least: int = 24
    #: Strata of the false-discovery control: lengths from each bound on.
    bounds: tuple[int, ...] = (24, 32, 40, 64, 128)
    #: Share of false findings allowed among those of a stratum.
    false_share: float = 0.1
    #: Thresholds tried for the combined p-value.
    steps: tuple[float, ...] = (0.001, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3)


def _once(value: Column, f) -> Column:
    return F.transform(F.array(value), f)[0]


#: Items of an array, and characters of a text, that are worked through at once, so that the
#: work on a long text grows as its length does.
BLOCK = 512
#: Less than the negative of any place in a text.
NOWHERE = -(1 << 40)
TEXT_BLOCK = 4096


def _running(values: Column, first: int, merge) -> Column:
    """Of each item the values before it, merged (``merge`` of two numbers); one more at the end.

    Blocks are merged first, then each block is run through from the value before it.
    """
    zero = F.struct(F.lit(first).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))

    def through(items: Column, start: Column) -> Column:
        return F.aggregate(items, start, lambda a, x: F.struct(
            merge(a["at"], x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))

    def blocked(given: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(given) / BLOCK).cast("int") - 1, F.lit(0)))
        blocks = F.transform(numbers, lambda k: F.slice(given, k * BLOCK + 1, F.lit(BLOCK)))
        return _once(blocks, lambda parts: _once(
            through(F.transform(parts, lambda p: F.aggregate(p, F.lit(first).cast("long"), merge)), zero),
            lambda sums: F.concat(F.flatten(F.transform(parts, lambda p, k: through(p, F.struct(
                F.get(sums["out"], k).alias("at"), F.array().cast("array<bigint>").alias("out")))["out"])),
                F.array(sums["at"]))))

    return _once(F.transform(values, lambda v: v.cast("long")), blocked)


def _add(a: Column, b: Column) -> Column:
    return a + b


def _greater(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _matches(text: Column, pattern: str, can: Column) -> Column:
    """``(start, end, found)`` of all leftmost, non-overlapping matches of a pattern.

    The text is cut at its matches; the lengths of the pieces give the places. ``can`` is a
    cheap condition that every text with a match meets.
    """
    def place(found: Column) -> Column:
        sizes = _once(F.split(text, pattern, -1), lambda pieces: F.transform(found, lambda x, i: F.struct(
            F.length(F.get(pieces, i)).alias("piece"), F.length(x).alias("found"), x.alias("text"))))
        return _once(sizes, lambda all_: _once(
            _running(F.transform(all_, lambda x: x["piece"] + x["found"]), 0, _add),
            lambda before: F.transform(all_, lambda x, i: F.struct(
                (F.get(before, i) + x["piece"]).cast("int").alias("start"),
                (F.get(before, i) + x["piece"] + x["found"]).cast("int").alias("end"),
                x["text"].alias("found")))))

    none = F.array().cast("array<struct<start:int,end:int,found:string>>")
    found = _once(F.regexp_extract_all(text, F.lit(pattern), 0), place)
    return F.when(can & text.rlike(pattern), found).otherwise(none)


def base_matches(text: Column) -> dict[str, Column]:
    """Spans of the fixed patterns, by kind."""
    sign = text.contains("=") | text.contains(":")
    assign = F.filter(_matches(text, ASSIGN, sign), lambda m: F.length(
        F.regexp_extract(m["found"], ASSIGN, 1)) >= ASSIGN_LEAST)
    return {"assign": assign, "access": _matches(text, ACCESS, text.contains("AKIA")),
            "hex": _matches(text, HEX, F.lit(True))}


def _tail(z: Column) -> Column:
    """Two-sided tail of the normal distribution, to about 1e-7 (a rational approximation)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    coefficients = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    series = reduce(lambda a, c: (a + c) * t, reversed(coefficients), F.lit(0.0))
    return F.greatest(series * F.exp(-x * x), F.lit(1e-12))


def _encoding(found: Column) -> Column:
    """Index of the smallest alphabet that holds all characters, -1 if none does."""
    index = F.lit(-1)
    for i, (_, alphabet) in reversed(list(enumerate(ENCODINGS))):
        index = F.when(F.translate(found, alphabet, "") == "", i).otherwise(index)
    return index


def _p_value(found: Column, encoding: Column) -> Column:
    """Combined p-value of three tests of a uniform, independent sequence of symbols.

    Chi-squared of the symbol counts (cube-root normal approximation), runs above and below
    the middle of the alphabet, and the correlation of neighbours, combined by Fisher's sum.
    """
    alphabets = F.array(*[F.lit(a) for _, a in ENCODINGS])

    def tests(alphabet: Column) -> Column:
        size, n = F.length(alphabet).cast("double"), F.length(found).cast("double")
        counts = F.transform(F.split(alphabet, ""), lambda c: (
            n - F.length(F.replace(found, c, F.lit("")))))
        squares = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c)
        chi, free = squares * size / n - n, size - 1
        z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / free, 1 / 3) - (1 - 2 / (9 * free))) / F.sqrt(
            2 / (9 * free))
        # only an excess counts against chance
        p_chi = F.when(z_chi > 0, _tail(z_chi) / 2).otherwise(1 - _tail(z_chi) / 2)

        middle = (size - 1) / 2

        def sequence(values: Column) -> Column:
            """Changes of side and sum of products of the neighbours in a block."""
            pairs = F.transform(F.slice(values, 1, F.size(values) - 1), lambda v, i: F.struct(
                v.alias("a"), F.get(values, i + 1).alias("b")))
            changes = F.size(F.filter(pairs, lambda p: (p["a"] < middle) != (p["b"] < middle)))
            product = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + (p["a"] - middle) * (
                p["b"] - middle))
            return F.struct(changes.alias("changes"), product.alias("product"))

        def of_blocks(blocks: Column) -> Column:
            """Each block with the first character of the next, so that every pair counts once."""
            return F.transform(blocks, lambda block, i: _once(F.transform(
                F.split(F.concat(block, F.coalesce(F.left(F.get(blocks, i + 1), F.lit(1)), F.lit(""))), ""),
                lambda c: F.position(c, alphabet) - 1.0), sequence))

        def combined(sums: Column) -> Column:
            changes = F.aggregate(sums, F.lit(0), lambda a, x: a + x["changes"])
            product = F.aggregate(sums, F.lit(0.0), lambda a, x: a + x["product"])
            z_runs = (changes - (n - 1) / 2) / F.sqrt((n - 1) / 4)
            z_serial = product / ((size * size - 1) / 12) / F.sqrt(n - 1)
            half = -(F.log(_tail(z_runs)) + F.log(_tail(z_serial)) + F.log(
                F.greatest(p_chi, F.lit(1e-12))))
            return F.exp(-half) * (1 + half + half * half / 2)

        return _once(_once(F.regexp_extract_all(found, F.lit(f"(?s).{{1,{TEXT_BLOCK}}}"), 0), of_blocks),
                     combined)

    return _once(F.element_at(alphabets, encoding + 1), tests)


def candidates(text: Column, settings: SecretSettings) -> Column:
    """``(start, end, stratum, p)`` of runs that look like an encoded key.

    Runs of ``least`` or more characters of base64 or its URL form, and their pieces that are so
    long when ``/``, ``-`` and ``_``, or all of these, end a run, as they do in paths and names. A run
    or piece is in one alphabet and holds letters and digits. The stratum is the encoding and
    the class of the length.
    """
    def runs(marks: str) -> Column:
        chars = f"A-Za-z0-9+{marks}"
        return _matches(text, rf"(?<![{chars}])[{chars}]{{{settings.least},}}", text.rlike("[0-9]"))

    mixed = lambda m: m["found"].rlike("[0-9]") & m["found"].rlike("[A-Za-z]")
    every = F.sort_array(F.concat(*[runs(marks) for marks in ("/_-", "_-", "/", "")]))
    found = _once(every, lambda all_: F.filter(all_, lambda m, i: ~F.coalesce(
        (F.get(all_, i - 1)["start"] == m["start"]) & (F.get(all_, i - 1)["end"] == m["end"]), F.lit(False))))
    coded = F.transform(F.filter(found, mixed), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), m["found"].alias("found"),
        _encoding(m["found"]).alias("encoding")))
    length = lambda m: reduce(lambda a, b: a + b, [
        (F.length(m["found"]) >= b).cast("int") for b in settings.bounds])
    return F.transform(F.filter(coded, lambda m: m["encoding"] >= 0), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"),
        (m["encoding"] * 100 + length(m)).alias("stratum"),
        _p_value(m["found"], m["encoding"]).alias("p")))


def stratum_thresholds(docs: DataFrame, settings: SecretSettings) -> dict[int, float]:
    """Least p-value of a finding, by stratum; a stratum without one finds nothing.

    Random keys have uniform p-values, other runs small ones. Twice the runs above a half
    estimate the keys of a stratum, so of the ``r`` runs with ``p >= t`` about
    ``r - 2 * (runs above a half) * (1 - t)`` are no keys. The least ``t`` with an allowed share
    of those is taken. Counts are of all documents; there is a row per encoding and class
    of length, whatever the corpus.
    """
    found = _held(docs.select("text"), "_found", candidates(F.col("text"), settings)).select(
        F.explode("_found").alias("c")).select("c.*")
    at_least = [F.sum((F.col("p") >= t).cast("long")).alias(f"r{i}")
                for i, t in enumerate(settings.steps)]
    rows = found.groupBy("stratum").agg(
        F.sum((F.col("p") > 0.5).cast("long")).alias("upper"), *at_least).collect()
    thresholds = {}
    for row in rows:
        for i, t in enumerate(settings.steps):
            found_here, keys = row[f"r{i}"], 2 * row["upper"] * (1 - t)
            if found_here and found_here - keys <= settings.false_share * found_here:
                thresholds[row["stratum"]] = t
                break
    return thresholds


def _by_start(spans: Column) -> Column:
    """Sorted by start, of equal ones the longest first."""
    return F.sort_array(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("less"), s["rank"].alias("rank"))))


def _apart(base: Column, spans: Column) -> Column:
    """The ``spans`` that meet no ``base`` span, sorted by start.

    In the order of starts, a span meets an earlier base span if the furthest end of those is
    beyond its start, and a later one if the next base start is before its end.
    """
    def of(sorted_: Column) -> Column:
        is_base = lambda s: s["rank"] >= 0
        ends = F.transform(sorted_, lambda s: F.when(is_base(s), -s["less"]).otherwise(-1))
        starts = F.transform(F.reverse(sorted_), lambda s: F.when(is_base(s), -s["start"]).otherwise(NOWHERE))
        return _once(_running(ends, -1, _greater), lambda before: _once(
            F.reverse(_running(starts, NOWHERE, _greater)), lambda after: F.transform(F.filter(F.transform(
                sorted_, lambda s, i: F.struct(
                    s["start"].alias("start"), (-s["less"]).alias("end"),
                    (~is_base(s) & (F.get(before, i) <= s["start"])
                     & (-F.get(after, i + 1) >= -s["less"])).alias("free"))),
                lambda s: s["free"]), lambda s: F.struct(s["start"], s["end"]))))

    marked = F.concat(
        F.transform(base, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"),
                                             F.lit(0).alias("rank"))),
        F.transform(spans, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"),
                                              F.lit(-1).alias("rank"))))
    return _once(_by_start(marked), of)


def _outermost(spans: Column) -> Column:
    """The spans, sorted by start and the longest first, that no other holds."""
    ends = F.transform(spans, lambda s: s["end"])
    return _once(_running(ends, -1, _greater), lambda before: F.transform(F.filter(
        F.transform(spans, lambda s, i: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                 F.get(before, i).alias("before"))),
        lambda s: s["before"] < s["end"]), lambda s: F.struct(s["start"], s["end"])))


def scan_secrets(docs: DataFrame, settings: SecretSettings = SecretSettings()) -> DataFrame:
    """``docs`` with ``secrets``: ``(start, rank, end)`` of all spans in order, ranks into ``KINDS``.

    Base spans always stay. A run found by the tests is added as ``random`` if it meets no
    base span, and a piece of a run if no longer one around it is added. Null texts have no spans; every row stays. A column named like the new one
    is replaced.
    """
    return _scanned(docs.drop("secrets"), settings).withColumnRenamed("_secrets", "secrets")


def _held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that the optimizer does not merge into what is built on it.

    Nested in one expression, the steps would be deeper than the planner's stack.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def _scanned(docs: DataFrame, settings: SecretSettings) -> DataFrame:
    """``docs`` with ``_secrets``."""
    thresholds = stratum_thresholds(docs, settings)
    text = F.col("text")

    def ranked_spans(found: Column, rank: int) -> Column:
        return F.transform(found, lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end")))

    base = F.concat(*[ranked_spans(found, rank)
                      for rank, found in enumerate(base_matches(text).values())])
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    marked = _held(docs, "_base", F.when(text.isNull(), none).otherwise(base))
    if not thresholds:
        random = none
    else:
        limits = F.create_map(*[F.lit(x) for pair in thresholds.items() for x in pair])
        passed = F.filter(candidates(text, settings), lambda c: F.coalesce(
            c["p"] >= limits[c["stratum"]], F.lit(False)))
        marked = _held(marked, "_found", passed)
        marked = _held(marked, "_free", _apart(F.col("_base"), F.col("_found")))
        random = ranked_spans(_outermost(F.col("_free")), len(KINDS) - 1)
        random = F.when(text.isNull(), none).otherwise(random)
    return _held(marked, "_secrets", F.sort_array(F.concat("_base", random))).select(
        *docs.columns, "_secrets")


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"),
        s["end"].cast("string"))), ",")


def redact_secrets(docs: DataFrame, settings: SecretSettings = SecretSettings(),
                   mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with each span, or each run of overlapping spans, replaced by ``mark``.

    Rows and columns stay, also one named ``secrets``; ``n_chars``, where there is one, is counted anew for changed texts.
    """
    text = F.col("text")

    def between(blocks: Column, start: Column, end: Column) -> Column:
        """Characters from ``start`` to before ``end``, from the text in blocks."""
        size = TEXT_BLOCK
        first, last = (start / size).cast("int"), ((end - 1) / size).cast("int")
        inside = F.substring(F.get(blocks, first), (start - first * size + 1).cast("int"),
                             (end - start).cast("int"))
        over = F.concat(
            F.substring(F.get(blocks, first), (start - first * size + 1).cast("int"), F.lit(size)),
            F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
            F.left(F.get(blocks, last), (end - last * size).cast("int")))
        return F.when(end <= start, F.lit("")).when(first == last, inside).otherwise(over)

    def cut_out(blocks: Column) -> Column:
        ends = F.transform("_secrets", lambda s: s["end"])
        length = F.length(text).cast("long")
        return _once(_running(ends, 0, _greater), lambda before: F.concat(
            F.array_join(F.transform("_secrets", lambda s, i: F.when(
                s["start"] >= F.get(before, i),
                F.concat(between(blocks, F.get(before, i), s["start"].cast("long")), F.lit(mark))
            ).otherwise("")), ""),
            between(blocks, F.get(before, F.size("_secrets")), length)))

    cut = _once(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{TEXT_BLOCK}}}"), 0), cut_out)
    clean = _scanned(docs, settings).withColumn(
        "text", F.when(F.size("_secrets") > 0, cut).otherwise(text))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(
            F.size("_secrets") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)
        ).otherwise(F.col("n_chars")))
    return clean.select(*docs.columns)
