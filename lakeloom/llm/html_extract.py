"""Main text of web pages by the distribution of line blocks.

Markup is stripped to lines, one for each block element. Parts that are no article by their element, role or
the head word of a class (menus, headers, footers, side bars, notices, adverts, forms, reader comments) and all scripts and
styles leave empty lines. A word elsewhere in a class is a hint only: such parts go unless they hold most of the
text of their page. Over windows of ``WINDOW`` lines the lengths of texts that are not links are summed
up. Text begins at a surge, the first window that reaches the threshold, taken back to the first line of that
run, and ends at a dive, a window without any text; what lies between is kept, all runs of it. The threshold is
lower where no window of a page reaches it, and short passages between two surges are kept with them. Marks of an
article (``article``, ``main``, the role main, or a class such as post-content) are evidence about the result: where the
marked lines hold at least ``MARKED_SHARE`` of the text so found, they are its boundaries, and all lines inside
are kept; where they hold less, the page marks something else, and what the distribution gives stays.

Each page is worked through once, from its first to its last character, with a stack of open elements; memory
is linear in one page. There is no shuffle.

Defined results: NULL and empty pages give an empty text, and so does a page of menus only. Repeated rows are
extracted each by itself; NULL ids and urls stay NULL. Extra columns are kept by ``extract``; one of
the added name goes on with an underscore before it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakeloom.llm.common import beside

WINDOW = 3
# Characters of a window at which text surges.
SURGE = 60
# Part of the surging text from which on marked lines are taken for the article.
MARKED_SHARE = 0.25
ROWS = 500

# Elements of HTML by what they do here.
RAW = ("script", "style", "textarea", "title", "iframe")
# Not shown as text either, but with elements inside; they break no line.
EMBEDDED = {"noscript", "template", "svg", "math", "select", "object"}
CONTAINERS = {
    "html", "body", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "ul", "ol", "dl",
    "table", "figure", "details", "dialog", "menu", "fieldset", "button", "center", "blockquote", "head",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "label", "mark", "q", "ruby", "rb", "rp", "rt", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "wbr",
}
NO_ARTICLE = {"nav", "footer", "aside", "form", "dialog", "menu", "button", "head"}
NO_ARTICLE_ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "form", "menu",
    "menubar", "toolbar",
}
NO_ARTICLE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "commentlist", "comments",
    "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar",
    "navigation", "newsletter", "notice", "notices", "popup", "promo", "promoted", "promotion", "related", "replies", "respond",
    "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
    "widgets",
}
# Parts of a class that say where or in what something is laid out, not what it is.
LAYOUT_WORDS = {
    "area", "article", "articles", "bar", "block", "body", "bottom", "box", "buttons", "column", "container", "content", "entry",
    "form", "group", "holder", "inner", "item", "items", "layout", "left", "links", "list", "main", "outer", "page", "panel",
    "post", "posts", "right", "row", "section", "slot", "stories", "story", "text", "top", "wrap", "wrapper",
}
ARTICLE_WORDS = {"article", "entry", "post", "story"}
MODIFIERS = {"has", "hide", "no", "show", "with", "without"}
COMMENT_WORDS = {"comment", "commentlist", "comments", "disqus", "replies", "respond"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})(?=[\s/>])(?P<rawattr>[^>]*)>(?P<rawtext>.*?)(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<close>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<attr>(?:[^>"']|"[^"]*"|'[^']*')*)>""",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[a-z]+")
_ARTICLE = re.compile(
    r"""\brole\s*=\s*["']?main\b|\b(?:class|id)\s*=\s*(?:["'][^"']*?)?\b(?:article|post|entry|story|main)[-_]?(?:body|content|text)\b"""
    r"""|\bitemprop\s*=\s*["']?articleBody\b""",
    re.I,
)


# What class words say about an element: nothing, perhaps no article, no article.
NOTHING, PERHAPS, SURELY = 0, 1, 2


class Line(NamedTuple):
    text: str
    weight: int  # characters that are no link; 0 for what is no article
    inside: bool  # within a marked article
    doubt: int = 0  # number of the outermost element that perhaps is no article


def by_words(token: str, in_article: bool) -> int:
    """What one class or id says: its head, the last part that is not about layout, decides; other parts are a hint."""
    parts = _WORD.findall(token)
    if MODIFIERS.intersection(parts):
        return NOTHING
    rest = parts[:]
    while rest and rest[-1] in LAYOUT_WORDS:
        rest.pop()
    # The header of an article has its title.
    if not rest or rest[-1] == "header" and (in_article or ARTICLE_WORDS.intersection(parts)):
        return NOTHING
    return SURELY if rest[-1] in NO_ARTICLE_WORDS else PERHAPS if NO_ARTICLE_WORDS.intersection(rest) else NOTHING


def no_article(tag: str, attributes: str, in_article: bool) -> int:
    """Whether an element holds something else than the article: ``NOTHING`` says so, ``PERHAPS`` or ``SURELY``."""
    if tag in NO_ARTICLE or (tag == "header" and not in_article):
        return SURELY
    if not attributes.strip():
        return NOTHING
    tokens: list[str] = []
    for name, value in _ATTRIBUTE.findall(attributes):
        value = value.strip("\"'").lower()
        match name.lower():
            case "role" if value in NO_ARTICLE_ROLES:
                return SURELY
            case "hidden" if value != "until-found":
                return SURELY
            case "style" if re.search(r"display\s*:\s*none", value):
                return SURELY
            case "class" | "id":
                tokens += value.split()
    if tag in ("html", "body", "main"):
        return NOTHING
    if tag == "article" or _ARTICLE.search(attributes):
        return SURELY if COMMENT_WORDS.intersection(_WORD.findall(" ".join(tokens))) else NOTHING
    return max((by_words(token, in_article) for token in tokens), default=NOTHING)


def lines(page: str) -> list[Line]:
    """The page without markup, one line for each block."""
    found: list[Line] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # element, is no article, is a marked article, perhaps is no article
    parts: list[str] = []
    linked = skipped = marked = embedded = 0
    doubts = doubt = line_doubt = doubted = 0  # numbers given, of the open element, of the line, open elements in doubt
    in_link = skip_line = False

    def end_line() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                found.append(Line(text, 0 if 2 * linked > len(text) else len(text) - linked, marked > 0, doubt or line_doubt))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not skipped and not skip_line:
            parts.append(text)
            if in_link:
                linked += len(text.strip())

    def pop() -> None:
        nonlocal skipped, marked, embedded, doubted, doubt
        tag, sure, article, unsure = stack.pop()
        skipped -= sure
        marked -= article
        embedded -= tag in EMBEDDED
        doubted -= unsure
        if sure and not skipped and tag not in EMBEDDED:
            found.extend([Line("", 0, marked > 0, doubt)] * WINDOW)
        if not doubted:
            doubt = 0

    at = 0
    while token := _TOKEN.search(page, at):
        add(page[at : token.start()])
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            # In svg and math "/>" closes any element.
            if embedded and token["raw"] and token["rawattr"].endswith("/"):
                at = token.start("rawtext")
            continue
        if tag in EMBEDDED and not token["close"]:
            if not token["attr"].endswith("/"):
                stack.append((tag, True, False, False))
                skipped += 1
                embedded += 1
            continue
        if embedded and tag not in EMBEDDED and tag not in CONTAINERS:
            continue
        if tag == "a":
            in_link = not token["close"]
            continue
        if tag in INLINE:
            continue
        if not skipped and tag not in EMBEDDED:
            end_line()
        if tag not in EMBEDDED and not embedded:
            skip_line, line_doubt = False, 0
        if tag not in CONTAINERS and tag not in EMBEDDED:
            in_link = False
            # A paragraph or an item by itself ends where the next block begins.
            said = NOTHING if token["close"] else no_article(tag, token["attr"], marked > 0)
            skip_line = said == SURELY
            if said == PERHAPS:
                doubts += 1
                line_doubt = doubts
            continue
        if token["close"]:
            if any(open_[0] == tag for open_ in stack):
                in_link = False
                while stack[-1][0] != tag:
                    pop()
                pop()
        elif not token["attr"].endswith("/"):
            said = no_article(tag, token["attr"], marked > 0)
            article = said == NOTHING and (tag in ("article", "main") or bool(token["attr"] and _ARTICLE.search(token["attr"])))
            stack.append((tag, said == SURELY, article, said == PERHAPS))
            skipped += said == SURELY
            marked += article
            if said == PERHAPS:
                doubted += 1
                if not doubt:
                    doubts += 1
                    doubt = doubts
    # A "<" that opens no element is text.
    add(page[at:])
    if not skipped:
        end_line()
    return settled(found)


def settled(found: list[Line]) -> list[Line]:
    """Of the elements in doubt those stay that hold most of the page's text that is no link; of others, empty lines."""
    held: dict[int, int] = {}
    for line in found:
        held[line.doubt] = held.get(line.doubt, 0) + line.weight
    half = sum(held.values()) / 2
    dropped = {number for number, weight in held.items() if number and weight <= half}
    out: list[Line] = []
    for i, line in enumerate(found):
        if line.doubt not in dropped:
            out.append(line)
        elif i + 1 == len(found) or found[i + 1].doubt != line.doubt:
            out.extend([Line("", 0, line.inside)] * WINDOW)
    return out


def between_surge_and_dive(weights: list[int]) -> list[bool]:
    """For each line whether it is kept."""
    sums = [sum(weights[i : i + WINDOW]) for i in range(len(weights))]
    threshold = min(SURGE, max(sums, default=0))
    kept = [False] * len(weights)
    i = 0
    while i < len(weights):
        if not weights[i]:
            i += 1
            continue
        # A run: from a line with text to the dive, where a whole window has none.
        end = i
        while end < len(weights) and sums[end]:
            end += 1
        if max(sums[i:end]) >= threshold > 0:
            kept[i:end] = [True] * (end - i)
        i = end
    if any(kept):
        first, last = kept.index(True), len(kept) - 1 - kept[::-1].index(True)
        kept[first : last + 1] = [True] * (last + 1 - first)
    return kept


def main_text(page: str) -> str:
    all_lines = lines(page)
    kept = between_surge_and_dive([line.weight for line in all_lines])
    surging = [line for line, keep in zip(all_lines, kept, strict=True) if keep]
    marked = sum(line.weight for line in surging if line.inside)
    inside = [line.text for line in all_lines if line.inside and line.text]
    if inside and marked >= MARKED_SHARE * sum(line.weight for line in surging):
        return " ".join(inside)
    # A line of links between two surges is a menu all the same.
    return " ".join(line.text for line in surging if line.weight)


def extract(df: DataFrame, page: str = "html", into: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add the main text of each page; ``keep`` limits the other columns."""
    keep = df.columns if keep is None else keep
    at = {c: i for i, c in enumerate(df.columns)}
    held = [T.StructField(name, df.schema[at[c]].dataType) for name, c in zip(beside(keep, [into]), keep, strict=True)]
    schema = T.StructType([*held, T.StructField(into, T.StringType())])
    names, place = schema.names, at[page]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                texts = pa.array([main_text(body.as_py() or "") for body in part.column(place)], pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(at[c]) for c in keep), texts], names=names)

    return df.mapInArrow(run, schema)
