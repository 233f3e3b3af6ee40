"""Main text of HTML pages: flat text blocks, classified by a decision tree over each block and its neighbours."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunewright.llm.common import prepare

#: Elements that end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form frame h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav ol option p pre section "
    "select summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content is no markup; their text is dropped.
RAW = "script style template textarea noscript svg math iframe object title select option button".split()
#: Elements that never hold others.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements of which the content is not the article's.
OUTER = frozenset("nav aside footer form menu dialog fieldset".split())
#: Words in class and id names: of the page around an article, and of the article.
_OUTER_WORDS = (
    r"(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|foot|gdpr|header|masthead|menu|modal|"
    r"nav\w*|newsletter|notices?|pagination|popup|promo\w*|recommend\w*|related|respond|replies|share|sharing|sidebar|side|skip|"
    r"social|sponsor\w*|subscribe|tags?|toolbar|widget|topbar|login|signup|search)"
)
OUTER_NAME = re.compile(rf"(?:^|[\s_-]){_OUTER_WORDS}(?:$|[\s_-]|\d)", re.I)
#: An id names a place in the text as well ("related-work"), so one that says a part of the page says nothing else but what form it has.
OUTER_ID = re.compile(
    rf"(?:(?:site|page|main|top|bottom|left|right|post|article|global|primary)[_-])*{_OUTER_WORDS}"
    r"(?:[_-]?(?:area|articles?|bar|block|box|container|content|field|form|inner|links?|list|menu|notice|panel|posts?|section|stories|thread|widget|wrap\w*|\d+))*",
    re.I,
)
#: Class names that say what surrounds an element, not what it is.
_BESIDE = re.compile(r"(?:has|with|without|no|is|js|hide)[_-]\S+", re.I)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|$)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|$)",
    re.S | re.I,
)
_ATTRIBUTES = re.compile(r"([^\s=\"'/>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)


@dataclass
class Block:
    """A run of text without a block element inside."""

    text: str
    words: int
    link_words: int
    article: bool  # inside an article or main element
    outer: int  # elements around it, inside the article if any, that belong to the page and not the article
    heading: bool

    @property
    def density(self) -> float:
        return self.link_words / self.words if self.words else 0.0


def _said(name: str, rest: str, article: bool) -> tuple[bool, bool]:
    """Whether an element's names say that it is of the page around an article, and whether it is not shown."""
    named = hidden = False
    for attribute, *values in _ATTRIBUTES.findall(rest):
        attribute, value = attribute.lower(), "".join(values)
        if attribute == "hidden" or (attribute == "aria-hidden" and value.lower() == "true") or (attribute == "style" and _NO_DISPLAY.search(value)):
            hidden = True
        elif name in ("body", "html", "h1", "h2", "h3", "h4", "h5", "h6"):
            continue  # a heading is named after what it heads
        elif attribute == "id":
            named |= bool(OUTER_ID.fullmatch(value.strip())) and not (name == "header" and article)
        elif attribute in ("class", "role", "aria-label") and not (name == "header" and article):
            named |= bool(OUTER_NAME.search(_BESIDE.sub(" ", value)))
    return named, hidden


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order. Elements left open at the end of the page are closed there."""
    out: list[Block] = []
    parts: list[tuple[str, bool]] = []
    stack: list[tuple[str, int, bool, bool, bool]] = [("", 0, False, False, False)]  # name, outer, article, heading, link

    def flush() -> None:
        if not parts:
            return
        text = " ".join(html.unescape("".join(t for t, _ in parts)).split())
        links = sum(len(html.unescape(t).split()) for t, link in parts if link)
        parts.clear()
        if text:
            _, outer, article, heading, _ = stack[-1]
            out.append(Block(text, len(text.split()), links, article, outer, heading))

    opened: Counter[str] = Counter()  # so that an end tag of nothing costs nothing
    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            parts.append((page[at : token.start()], stack[-1][4]))
        at = token.end()
        name = token["name"]
        if name is None:
            if token["raw"] and token["raw"].lower() in BLOCKS:
                flush()
            continue
        name = name.lower()
        if name in BLOCKS:
            flush()
        if token["close"]:
            if not opened[name]:
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    opened.subtract(x[0] for x in stack[depth:])
                    del stack[depth:]
                    break
                if stack[depth][0] in ("article", "main", "body") and name not in BLOCKS:
                    break
            continue
        if name in VOID:
            continue
        if name in ("p", "li", "option", "dt", "dd", "tr", "td", "th") and stack[-1][0] == name:
            stack.pop()
            opened[name] -= 1
        _, outer, article, heading, link = stack[-1]
        named, hidden = _said(name, token["rest"], article)
        if name in ("article", "main"):
            outer, article = (outer + 1 if named else (0 if not article else outer)), article or not named
            outer += hidden
        elif name in OUTER or (name == "header" and not article) or named or hidden:
            outer += 1
        opened[name] += 1
        stack.append((name, outer, article, heading or name in ("h1", "h2", "h3", "h4", "h5", "h6"), link or name == "a"))
    if at < len(page):
        parts.append((page[at:], stack[-1][4]))
    flush()
    return out


#: Columns of the table below.
FEATURES = "words density before_words before_density after_words after_density article outer heading any_article".split()
#: The labelled blocks: the features as above, then 1 for text of the article.
LABELLED = [
    # menus, lists of links, page headers and footers
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0, 1, 0), (2, 1.0, 1, 1.0, 3, 1.0, 0, 1, 0, 1, 0), (3, 1.0, 2, 1.0, 9, 0.0, 0, 1, 0, 1, 0),
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0, 0, 0), (4, 1.0, 1, 1.0, 40, 0.0, 0, 0, 0, 0, 0), (2, 1.0, 30, 0.0, 2, 1.0, 0, 0, 0, 0, 0),
    (6, 0.8, 50, 0.1, 3, 1.0, 0, 0, 0, 0, 0), (14, 0.0, 60, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (9, 0.3, 70, 0.0, 0, 0.0, 0, 1, 0, 0, 0),
    (25, 0.0, 90, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (40, 0.0, 20, 0.0, 5, 0.0, 0, 2, 0, 1, 0), (3, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0, 0),
    (2, 0.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0, 0), (5, 0.0, 0, 0.0, 1, 1.0, 0, 1, 1, 1, 0), (6, 0.6, 4, 0.5, 2, 1.0, 0, 0, 0, 0, 0),
    # adverts, notices, comments and forms, long ones too
    (12, 0.0, 1, 1.0, 11, 0.0, 0, 1, 0, 1, 0), (8, 0.1, 3, 1.0, 10, 0.0, 0, 1, 0, 1, 0), (60, 0.0, 1, 1.0, 12, 0.0, 0, 1, 0, 1, 0),
    (35, 0.1, 80, 0.0, 30, 0.0, 0, 1, 0, 1, 0), (120, 0.0, 60, 0.0, 90, 0.0, 0, 1, 0, 0, 0), (18, 0.0, 70, 0.0, 22, 0.0, 1, 1, 0, 1, 0),
    (55, 0.0, 40, 0.0, 60, 0.0, 1, 1, 0, 1, 0), (3, 1.0, 50, 0.0, 60, 0.0, 1, 1, 0, 1, 0), (9, 0.0, 60, 0.0, 80, 0.0, 1, 2, 1, 1, 0),
    (22, 0.0, 30, 0.0, 10, 0.0, 0, 0, 0, 1, 0), (70, 0.0, 15, 0.0, 12, 0.1, 0, 0, 0, 1, 0), (7, 0.0, 90, 0.0, 0, 0.0, 0, 0, 0, 1, 0),
    (150, 0.0, 60, 0.0, 0, 0.0, 0, 0, 0, 1, 0), (5, 0.0, 20, 0.0, 20, 0.0, 0, 0, 1, 1, 0), (30, 0.0, 1, 1.0, 45, 0.0, 0, 0, 0, 1, 0),
    (10, 0.0, 2, 1.0, 25, 0.0, 0, 0, 0, 1, 0), (9, 0.0, 0, 0.0, 60, 0.0, 0, 0, 1, 1, 0), (45, 0.0, 90, 0.0, 70, 0.0, 0, 0, 0, 1, 0),
    # text of an article that is marked as one
    (11, 0.0, 12, 0.0, 60, 0.0, 1, 0, 1, 1, 1), (4, 0.0, 60, 0.0, 80, 0.0, 1, 0, 1, 1, 1), (1, 0.0, 9, 0.0, 30, 0.0, 1, 0, 0, 1, 1),
    (9, 0.0, 11, 0.0, 40, 0.0, 1, 0, 0, 1, 1), (55, 0.0, 9, 0.0, 70, 0.0, 1, 0, 0, 1, 1), (240, 0.0, 30, 0.0, 14, 0.0, 1, 0, 0, 1, 1),
    (3, 0.0, 120, 0.0, 14, 0.0, 1, 0, 0, 1, 1), (30, 0.2, 40, 0.0, 35, 0.1, 1, 0, 0, 1, 1), (60, 0.5, 20, 0.0, 20, 0.0, 1, 0, 0, 1, 1),
    (6, 1.0, 60, 0.0, 70, 0.0, 1, 0, 0, 1, 1), (2, 1.0, 30, 0.0, 2, 1.0, 1, 0, 0, 1, 1), (12, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 1, 1),
    # text of an article that no element marks
    (40, 0.0, 2, 1.0, 60, 0.0, 0, 0, 0, 0, 1), (90, 0.0, 40, 0.0, 70, 0.0, 0, 0, 0, 0, 1), (25, 0.1, 80, 0.0, 10, 0.0, 0, 0, 0, 0, 1),
    (12, 0.0, 50, 0.0, 60, 0.0, 0, 0, 0, 0, 1), (8, 0.0, 3, 1.0, 55, 0.0, 0, 0, 1, 0, 1), (6, 0.0, 45, 0.0, 70, 0.0, 0, 0, 1, 0, 1),
    (9, 0.0, 70, 0.0, 30, 0.0, 0, 0, 0, 0, 1), (300, 0.0, 5, 0.5, 3, 1.0, 0, 0, 0, 0, 1), (35, 0.25, 60, 0.1, 40, 0.0, 0, 0, 0, 0, 1),
    (15, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (20, 0.0, 0, 0.0, 30, 0.0, 0, 0, 0, 0, 1), (11, 0.0, 12, 0.0, 14, 0.0, 0, 0, 0, 0, 1),
]


def grow(rows: list[tuple], least: int = 1, depth: int = 8):
    """A tree by least Gini impurity: a leaf is a share of ones, a node (feature, cut, at most, above)."""
    ones = sum(r[-1] for r in rows)
    if not rows or depth == 0 or ones in (0, len(rows)) or len(rows) < 2 * least:
        return ones / len(rows) if rows else 0.0

    def impurity(part):
        p = sum(r[-1] for r in part) / len(part)
        return len(part) * 2 * p * (1 - p)

    best = None
    for f in range(len(FEATURES)):
        values = sorted({r[f] for r in rows})
        for low, high in zip(values, values[1:]):
            cut = (low + high) / 2
            left, right = [r for r in rows if r[f] <= cut], [r for r in rows if r[f] > cut]
            if len(left) >= least and len(right) >= least:
                cost = impurity(left) + impurity(right)
                if best is None or cost < best[0] - 1e-12:
                    best = (cost, f, cut, left, right)
    if best is None:
        return ones / len(rows)
    _, f, cut, left, right = best
    return f, cut, grow(left, least, depth - 1), grow(right, least, depth - 1)


def decide(tree, row) -> float:
    while isinstance(tree, tuple):
        feature, cut, low, high = tree
        tree = low if row[feature] <= cut else high
    return tree


def features(found: list[Block]) -> list[tuple]:
    """Per block: its words and link density, those of its neighbours, and what surrounds it."""
    some = int(any(b.article for b in found))
    none = Block("", 0, 0, False, 0, False)
    return [
        (b.words, b.density, p.words, p.density, n.words, n.density, int(b.article), b.outer, int(b.heading), some)
        for p, b, n in zip([none, *found], found, [*found[1:], none])
    ]


def main_text(page: str | None, tree) -> str:
    """The article's blocks in page order, joined by an empty line; empty for null and for pages without."""
    found = blocks(page or "")
    return "\n\n".join(b.text for b, row in zip(found, features(found)) if decide(tree, row) >= 0.5)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", labelled: list[tuple] | None = None) -> DataFrame:
    """key, url, text, n_chars (code points) of every page.

    The decision tree is trained on `labelled` (by default the table above). Null, empty and broken
    pages give what text they hold or an empty one; nothing is cut. Repeated rows give repeated rows;
    null keys and urls are like others; extra columns are not read.
    """
    prepare(pages.sparkSession)
    tree = grow(labelled or LABELLED)

    @F.pandas_udf("string")
    def text(rows: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, tree) for p in rows], dtype="object")

    out = pages.select(F.col(key), F.col(url), text(F.col(page)).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
