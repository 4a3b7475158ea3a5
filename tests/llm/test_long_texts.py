"""Pages and texts that are long or hostile; spans of secrets against plain versions."""

from __future__ import annotations

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from fleetgauge.llm import secret_scan as ss
from fleetgauge.llm.html_main_text import main_text

PAGES = {
    "quotes": "<p>x</p>" + "<a '" * 2000 + ">", "attributes": "<p id= id= " * 200_000 + ">",
    "value": "<p>x</p><p id=" + "x" * 10_000_000, "marks": "<p>x</p>" + "<!" * 5_000_000,
    "scripts": "<p>x</p>" + "<script " * 1_200_000, "open": "<" * 2_000_000,
    "values": '<a b="' * 500_000, "ends": "<script>" + "</script " * 1_000_000,
    "blanks": "<p" + " " * 5_000_000 + "x", "paragraphs": "<p>" * 500_000 + "x"}


@pytest.mark.parametrize("name", PAGES)
def test_hostile_page_is_read_once(name):
    start = time.monotonic()
    main_text(PAGES[name])
    assert time.monotonic() - start < 20


@pytest.mark.parametrize("page, text", [
    ("<p title=don't>it's here</p><p>and here</p>", "it's here\n\nand here"),
    ("<p>a b</p><p class='x", "a b"), ("<p>a b</p><", "a b"), ("<p>a b</p></", "a b"),
    ("<p>a &lt; b</p><p>c<br/>d</p>", "a < b\n\nc d"), ('<p data-x="a>b">c</p>', "c"),
    ("<p>x <3 y</p>", "x <3 y"), ("<p>a</p><script>if (a<b) '</p>'", "a")])
def test_broken_markup(page, text):
    assert main_text(page) == text


def plain_p(text, alphabet):
    """Chi-squared, runs and serial correlation, joined by Fisher's sum, with the exact tail."""
    size, n = len(alphabet), len(text)
    tail = lambda z: max(math.erfc(abs(z) / math.sqrt(2)), 1e-12)
    chi = sum(text.count(c) ** 2 for c in alphabet) * size / n - n
    free = size - 1
    z = ((max(chi, 0) / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    p_chi = tail(z) / 2 if z > 0 else 1 - tail(z) / 2
    values, middle = [alphabet.index(c) for c in text], (size - 1) / 2
    pairs = list(zip(values, values[1:]))
    runs = (sum((a < middle) != (b < middle) for a, b in pairs) - (n - 1) / 2) / math.sqrt((n - 1) / 4)
    serial = sum((a - middle) * (b - middle) for a, b in pairs) / ((size * size - 1) / 12) / math.sqrt(n - 1)
    half = -(math.log(tail(runs)) + math.log(tail(serial)) + math.log(max(p_chi, 1e-12)))
    return math.exp(-half) * (1 + half + half * half / 2)


def test_tests_equal_a_plain_version(frame):
    rng, rows = random.Random(5), []
    for index, (_, alphabet) in enumerate(ss.ENCODINGS):
        for n in (24, 40, 300, 9000):
            rows += [(index, "".join(rng.choices(alphabet, k=n))), (index, (alphabet * n)[:n])]
    got = frame("i INT, t STRING", rows).select("i", "t", ss._p_value(F.col("t"), F.col("i") + 0).alias("p"))
    for row in got.collect():
        assert math.isclose(row.p, plain_p(row.t, ss.ENCODINGS[row.i][1]), rel_tol=1e-3, abs_tol=1e-9)


def test_thresholds_equal_a_plain_version(frame):
    rng = random.Random(6)
    keys = ["".join(rng.choices(ss.ENCODINGS[5][1], k=48)) for _ in range(60)] + ["abc1" * 12] * 20
    docs = frame("doc_id INT, text STRING", [(i, f"see {k} there") for i, k in enumerate(keys)])
    settings = ss.SecretSettings()
    found = docs.select(F.explode(ss.candidates(F.col("text"), settings)).alias("c")).select("c.*").collect()
    wanted = {}
    for stratum in {r.stratum for r in found}:
        ps = [r.p for r in found if r.stratum == stratum]
        for t in settings.steps:
            here, real = sum(p >= t for p in ps), 2 * sum(p > 0.5 for p in ps) * (1 - t)
            if here and here - real <= settings.false_share * here:
                wanted[stratum] = t
                break
    assert ss.stratum_thresholds(docs, settings) == wanted != {}


def test_overlaps_equal_a_plain_version(frame):
    rng, rows = random.Random(7), []
    for i in range(60):
        span = lambda: (lambda a: (a, a + 1 + rng.randrange(12)))(rng.randrange(80))
        rows.append((i, [span() for _ in range(rng.randrange(6))],
                     sorted({span() for _ in range(rng.randrange(14))})))
    rows.append((99, [(k * 10, k * 10 + 3) for k in range(1500)], [(k * 5, k * 5 + 2) for k in range(3000)]))
    kind = "ARRAY<STRUCT<start: INT, end: INT>>"
    df = frame(f"i INT, base {kind}, spans {kind}", rows)
    free = ss._held(df, "free", ss._apart(F.col("base"), F.col("spans")))
    got = {r.i: ([tuple(x) for x in r.free], [tuple(x) for x in r.whole]) for r in free.select(
        "i", "free", ss._outermost(F.col("free")).alias("whole")).collect()}
    for i, base, spans in rows:
        apart = [s for s in spans if not any(b[0] < s[1] and s[0] < b[1] for b in base)]
        whole = [s for s in apart if not any(
            o[0] <= s[0] and s[1] <= o[1] and o[1] - o[0] > s[1] - s[0] for o in apart)]
        assert (sorted(got[i][0]), sorted(got[i][1])) == (sorted(apart), sorted(whole))


def test_many_keys_in_one_text(frame):
    """Across blocks of spans and of text, with letters of several bytes between."""
    rng = random.Random(8)
    keys = ["".join(rng.choices("0123456789abcdef", k=32 + i % 3)) for i in range(1200)]
    text = "ä🙂 ".join(keys)
    docs = frame("doc_id INT, text STRING", [(1, text), (2, None), (3, ""), (4, "plain"), (4, "plain")])
    spans = {r.doc_id: r.secrets for r in ss.scan_secrets(docs).collect()}
    at, wanted = 0, []
    for key in keys:
        wanted.append((at, 2, at + len(key)))
        at += len(key) + 3
    assert [tuple(s) for s in spans[1]] == wanted
    cleaned = {r.doc_id: r.text for r in ss.redact_secrets(docs).collect()}
    assert cleaned == {1: "ä🙂 ".join(["[REDACTED]"] * 1200), 2: None, 3: "", 4: "plain"}
