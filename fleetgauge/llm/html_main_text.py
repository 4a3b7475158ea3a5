"""Main text of web pages by the distribution of text over blocks of lines.

Mark-up becomes lines: an element that starts a block starts a line, an element that holds
blocks sets empty lines around itself. Over the lines slide windows; where their text rises from
nothing above a bound is a surge point, where it falls to nothing a dive point, and the text
between is a candidate. Elements that never hold an article are left out as they are read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BlockSettings:
    #: Lines of a window.
    window: int = 3
    #: Characters of a window from which on it is a surge.
    surge: int = 80
    #: Most characters of links, as a share, of a line that counts as text.
    links: float = 0.5


#: Fixed words of the format: elements whose content is no text, that are never part of an
#: article, that start a line, that hold lines, and that have no end tag.
NO_TEXT = frozenset("script style noscript template svg math head iframe object canvas audio video "
                    "select textarea option datalist".split())
APART = frozenset("nav footer aside form menu button dialog".split())
LINE = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption figure "
                 "figcaption pre blockquote address fieldset details summary hr title legend".split())
HOLDER = frozenset("html body div section article main header footer aside nav form center".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
ARTICLE = frozenset("article main".split())
#: Words in a class, id or role that mark a part as not the article's.
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|sidebar|side|menu|nav|navbar|navigation|"
    r"breadcrumbs?|masthead|site-header|footer|comments?|commentlist|respond|replies|disqus|cookies?|"
    r"consent|notices?|alert|popup|modal|overlay|newsletter|subscribe|signup|login|search|share|"
    r"sharing|social|related|recommended|widget|toolbar|pagination|copyright)(?:$|[\s_-])", re.I)

# Every pattern ends at the end of the page if its own end is missing, and gives nothing back that
# it has read, so a page is read once whatever it holds.
TAG = re.compile(
    r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)"""
    r"""((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?=>)|[^\s"'>][^\s>]*+))?+)*+)(>|\Z)""")
COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[|\]\]>|<[!?][^>]*+(?:>|\Z)", re.S)
RAW = re.compile(r"<(script|style|textarea|template|noscript|svg|iframe)\b[^>]*+(?:>.*?(?:</\1\s*+>|\Z)|\Z)",
                 re.S | re.I)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)


@dataclass
class _Line:
    text: list[str] = field(default_factory=list)
    links: int = 0
    article: bool = False
    gap: bool = False


def _lines(page: str) -> list[_Line]:
    """Lines of a page, with gaps at the borders of elements that hold lines."""
    page = RAW.sub(" ", COMMENT.sub("", page))
    lines = [_Line()]
    skipped, depth = "", 0  # the element that is left out, and how often it is nested
    articles = in_link = 0
    at = 0

    def text(part: str) -> None:
        if part and not skipped:
            lines[-1].text.append(part)
            lines[-1].article = lines[-1].article or articles > 0
            if in_link:
                lines[-1].links += len(part.strip())

    def new_line(gap: bool = False) -> None:
        if gap and not (len(lines) > 1 and lines[-2].gap and not lines[-1].text):
            lines.extend((_Line(gap=True), _Line()))
        elif not gap and lines[-1].text:
            lines.append(_Line())

    for tag in TAG.finditer(page):
        text(page[at:tag.start()])
        at = tag.end()
        if not tag[4]:  # cut off by the end of the page
            break
        close, name = bool(tag[1]), tag[2].lower()
        if skipped:
            if name == skipped and name not in VOID and not tag[3].endswith("/"):
                depth += -1 if close else 1
            ends = depth == 0 or (name in ARTICLE and not close and skipped not in ARTICLE) or (
                name in ARTICLE and close and articles and skipped not in ARTICLE)
            if not ends:
                continue
            skipped = ""
            new_line()
            if depth == 0:
                continue
        if not close and name not in VOID and name not in ("html", "body", *ARTICLE):
            marks = " ".join(m.strip("\"'") for m in NAMED.findall(tag[3])) if tag[3] else ""
            apart = name in NO_TEXT or name in APART or (name == "header" and not articles)
            if apart or (marks and MARKS.search(marks)):
                if not tag[3].endswith("/"):
                    skipped, depth = name, 1
                    new_line()
                continue
        if name in ARTICLE:
            articles = max(0, articles + (-1 if close else 1))
        if name == "a":
            in_link = 0 if close else 1
        if name in HOLDER:
            new_line(gap=True)
        elif name in LINE:
            new_line()
        elif name == "br" and not skipped:
            lines[-1].text.append(" ")
    rest = page[at:]
    text(rest[:-1] if rest.endswith("<") else rest.removesuffix("</"))
    return lines


def main_text(page: str | None, settings: BlockSettings = BlockSettings()) -> str:
    """Blocks of the main text, joined by two line feeds; empty if there is none.

    If parts of the page are marked as articles, only their lines count. A candidate is kept if
    its windows surge, and the one with most text is kept in any case; a line of which most is
    links is no text. White space in a block becomes one space.
    """
    if not page:
        return ""
    lines = _lines(page)
    blocks = [" ".join(html.unescape("".join(line.text)).split()) for line in lines]
    marked = any(b and line.article for b, line in zip(blocks, lines, strict=True))
    lengths, owner = [], []
    for i, (block, line) in enumerate(zip(blocks, lines, strict=True)):
        if line.gap:  # an empty stretch as wide as a window, so that no window spans it
            lengths += [0] * settings.window
            owner += [-1] * settings.window
        elif block and (line.article or not marked):
            linked = line.links > settings.links * len(block)
            lengths.append(0 if linked and not marked else len(block))
            owner.append(i if lengths[-1] else -1)
    if not any(lengths):
        return ""
    sums = np.convolve(np.array(lengths), np.ones(settings.window, np.int64))
    text = np.r_[False, sums > 0, False]
    surges = np.flatnonzero(text[1:] & ~text[:-1])
    dives = np.flatnonzero(~text[1:] & text[:-1])
    parts = [(int(sums[a:b].max()), sum(lengths[a:b]), a, b)
             for a, b in zip(surges.tolist(), dives.tolist(), strict=True)]
    most = max(p[1] for p in parts)
    kept = [p for p in parts if marked or p[0] >= settings.surge or p[1] == most]
    return "\n\n".join(blocks[i] for _, _, a, b in kept for i in owner[a:b] if i >= 0)


def extract_text(pages: DataFrame, settings: BlockSettings = BlockSettings()) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``; every row stays.

    Null html has an empty text. Columns named like the new ones are replaced.
    """
    @F.pandas_udf("string")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([main_text(h, settings) for h in part], dtype="object")

    return pages.drop("text", "n_chars").withColumn("text", of(F.col("html"))).withColumn(
        "n_chars", F.length("text").cast("long"))
