"""Box-office figures from landed summary pages (PG-1).

Rule, per page: inside the first ``mojo-summary-table`` block,

- worldwide gross = text of the first ``a-size-medium`` span inside the
  **last** ``a-section`` of the ``mojo-performance-summary-table`` block;
- budget / domestic opening = text after the last ``$`` of the
  ``a-section`` rows of the ``mojo-summary-values`` block whose text contains
  "Budget" / "Domestic Opening" (a later row overrides an earlier one);
- newlines removed and surrounding whitespace stripped;
- if any of the blocks, the section or the span is missing, all three
  figures are blank; a missing Budget / Opening row only blanks that field.

Matching nested ``div`` blocks needs a tree, which regular expressions cannot
balance, so pages are parsed with the standard-library HTML tokenizer inside
an Arrow-batched pandas UDF: one vectorised call per batch of pages, no
per-row JVM round trip, and the whole page text is parsed.
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The class names and labels the page layout uses.
SUMMARY_CLASS = "mojo-summary-table"
PERFORMANCE_CLASS = "mojo-performance-summary-table"
VALUES_CLASS = "mojo-summary-values"
SECTION_CLASS = "a-section"
FIGURE_CLASS = "a-size-medium"
BUDGET_LABEL = "Budget"
OPENING_LABEL = "Domestic Opening"

VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
             "param", "source", "track", "wbr"}

FIELDS = ("domestic_opening", "worldwide_gross", "budget")
RESULT_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in FIELDS])


class _Node:
    __slots__ = ("tag", "classes", "children", "parent")

    def __init__(self, tag: str, classes: set[str], parent: _Node | None):
        self.tag, self.classes, self.parent = tag, classes, parent
        self.children: list[_Node | str] = []

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text() for c in self.children)

    def find_all(self, tag: str, cls: str) -> list[_Node]:
        out: list[_Node] = []
        stack = list(reversed([c for c in self.children if isinstance(c, _Node)]))
        while stack:
            n = stack.pop()
            if n.tag == tag and cls in n.classes:
                out.append(n)
            stack.extend(reversed([c for c in n.children if isinstance(c, _Node)]))
        return out

    def find(self, tag: str, cls: str) -> _Node | None:
        stack = list(reversed([c for c in self.children if isinstance(c, _Node)]))
        while stack:
            n = stack.pop()
            if n.tag == tag and cls in n.classes:
                return n
            stack.extend(reversed([c for c in n.children if isinstance(c, _Node)]))
        return None


class _SummaryClosed(Exception):
    """Raised to stop parsing once the summary block has been read."""


class _TreeBuilder(HTMLParser):
    def __init__(self, stop_after_first: str | None = None) -> None:
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root", set(), None)
        self.cur = self.root
        self.stop_after_first = stop_after_first

    def handle_starttag(self, tag, attrs):
        classes = set()
        for k, v in attrs:
            if k == "class" and v:
                classes.update(v.split())
        node = _Node(tag, classes, self.cur)
        self.cur.children.append(node)
        if tag not in VOID_TAGS:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.cur = self.cur.parent or self.root

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent
            if self.stop_after_first and n.parent is self.root \
                    and self.stop_after_first in n.classes:
                raise _SummaryClosed

    def handle_data(self, data):
        self.cur.children.append(data)


_HIDING = re.compile(r"<!--|<(?:script|style|textarea|title|xmp|iframe|noscript)\b", re.IGNORECASE)
# Such an element that is closed and holds no markup, so that it hides none.
_CLOSED = re.compile(r"<(script|style|textarea|title|xmp|iframe|noscript)"
                     r'(?: [a-z][a-z-]*(?:="[^"<>&]*")?)*>[^<]*</\1>', re.IGNORECASE)
_DIV_START = re.compile(r"<div\b[^<>]*\bclass\s*=\s*[\"']?([^\"'<>]*)", re.IGNORECASE)


def _parse(text: str, stop_after_first: str | None = None) -> _Node | None:
    builder = _TreeBuilder(stop_after_first)
    try:
        builder.feed(text)
        builder.close()
    except _SummaryClosed:
        pass
    except Exception:  # noqa: BLE001 - a page that does not parse has no figures
        return None
    return builder.root


# Markup that needs no tokenizer: text, bare tags, attributes in double quotes.
_PLAIN = re.compile(r'([^<]+)|<([a-z][a-z0-9]*)((?: [a-z][a-z-]*="[^"<>&]*")*)>'
                    r'|</([a-z][a-z0-9]*)>')
_NO_CLASS: set[str] = set()
_PLAIN_CLASS = re.compile(r' class="([^"]*)"')
# Elements whose content is text, whatever it looks like.
_RAW_TEXT = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes",
             "noscript", "plaintext"}


def _plain_block(html: str, start: int) -> _Node | None:
    """Tree of the summary block at ``start``, as ``_parse`` builds it; None if anything up to
    its end is not plain markup, or it has no end."""
    root = cur = _Node("#root", set(), None)
    path = [root]  # open elements; without parent links a tree is freed as soon as it is read
    token = _PLAIN.scanner(html, start).match
    while (m := token()) is not None:
        kind = m.lastindex
        if kind == 1:
            text = m[1]
            cur.children.append(unescape(text) if "&" in text else text)
        elif kind == 3:
            tag, attrs = m[2], m[3]
            if tag in _RAW_TEXT:
                return None
            node = _Node(tag, {c for v in _PLAIN_CLASS.findall(attrs) for c in v.split()}
                         if attrs else _NO_CLASS, None)
            cur.children.append(node)
            if tag not in VOID_TAGS:
                path.append(node)
                cur = node
        else:
            tag, k = m[4], len(path) - 1
            while k > 0 and path[k].tag != tag:
                k -= 1
            if k > 0:
                closed = path[k]
                del path[k:]
                cur = path[-1]
                if k == 1 and SUMMARY_CLASS in closed.classes:
                    return root
    return None


def _summary_block(html: str) -> _Node | None:
    """The first summary ``div`` of the page.

    Fast path: when the first occurrence of the class name sits in a ``div``
    start tag carrying it as a class, parsing starts at that tag and stops
    when the block closes, so the rest of a large page is never tokenised.
    Otherwise (the name first appears in a script, text or other tag) the
    whole page is parsed. A block of plain markup is read by one expression,
    several times faster than the tokenizer.
    """
    at = html.find(SUMMARY_CLASS)
    tag_start = html.rfind("<", 0, at)
    # a tag inside a comment, script or style is none: such pages are parsed whole
    if tag_start >= 0 and not (_HIDING.search(html, 0, at)
                               and _HIDING.search(_CLOSED.sub("", html[:at]))):
        m = _DIV_START.match(html, tag_start)
        if m and SUMMARY_CLASS in m.group(1).split() and m.end() >= at:
            root = _plain_block(html, tag_start) or _parse(
                html[tag_start:], stop_after_first=SUMMARY_CLASS)
            return root.find("div", SUMMARY_CLASS) if root is not None else None
    root = _parse(html)
    return root.find("div", SUMMARY_CLASS) if root is not None else None


def _clean(s: str) -> str:
    return s.replace("\n", "").strip()


def extract_one(html: str | None) -> tuple[str, str, str]:
    """(domestic_opening, worldwide_gross, budget) of one page, blanks on failure."""
    blank = ("", "", "")
    try:
        return _figures(html)
    except Exception:  # noqa: BLE001 - a page that can't be read has no figures
        return blank


def _figures(html: str | None) -> tuple[str, str, str]:
    blank = ("", "", "")
    if not html or SUMMARY_CLASS not in html:
        # No summary block can exist without its class name in the text.
        return blank
    summary = _summary_block(html)
    if summary is None:
        return blank
    perf = summary.find("div", PERFORMANCE_CLASS)
    if perf is None:
        return blank
    sections = perf.find_all("div", SECTION_CLASS)
    if not sections:
        return blank
    span = sections[-1].find("span", FIGURE_CLASS)
    if span is None:
        return blank
    gross = _clean(span.text())
    values = summary.find("div", VALUES_CLASS)
    if values is None:
        return blank
    budget = opening = ""
    for row in values.find_all("div", SECTION_CLASS):
        text = row.text()
        if BUDGET_LABEL in text:
            budget = _clean(text).split("$")[-1]
        if OPENING_LABEL in text:
            opening = _clean(text).split("$")[-1]
    return opening, gross, budget


@F.pandas_udf(RESULT_SCHEMA)
def _extract_batch(html: pd.Series) -> pd.DataFrame:
    rows = [extract_one(h) for h in html]
    return pd.DataFrame(rows, columns=list(FIELDS))


def box_office_figures(html: Column) -> Column:
    """Struct ``(domestic_opening, worldwide_gross, budget)`` from a page column.

    The UDF's argument is computed on the JVM side: pages that do not even
    contain the summary class name are passed as NULL, so only candidate
    pages cross to Python; the others come back blank without being shipped.
    """
    return _extract_batch(F.when(html.contains(SUMMARY_CLASS), html))


def extract_box_office(pages: DataFrame, key: str = "imdb_id", html: str = "html") -> DataFrame:
    """``(key, domestic_opening, worldwide_gross, budget)`` as strings, one row per page.

    Parsing costs far more than reading, and a file of pages may be one split:
    pages are dealt over the shuffle partitions by key and text first, without
    the text of those that hold no summary.
    """
    found = pages.select(key, F.when(F.col(html).contains(SUMMARY_CLASS), F.col(html)).alias(html))
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return found.repartition(n, F.col(key), F.xxhash64(html)).select(
        key, box_office_figures(F.col(html)).alias("_f")).select(
        key, *[F.col(f"_f.{f}").alias(f) for f in FIELDS])
