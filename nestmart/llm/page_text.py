"""Main text of web pages by nearest-URL page differencing.

A page's markup gives text lines (one per block). Lines inside elements that
say what they are (menus, adverts, scripts, ...) go; where an outermost marked
article holds most of the open text, the lines outside it go too. What is left is decided by differencing:
every page is paired with the page of the same host whose URL path is nearest,
the open lines of the two are aligned by a longest common subsequence, and the
shared lines are deleted as template.

The markup has one veto: a marked article of which differencing would leave
less than a fifth (``LEFT``) is a near copy of its neighbour, not a page
filled into the same template, and stays whole.

Pages of one host with the same open lines are one page for the pairing, so
copies don't delete each other. The pairs come from one global range sort by
host, path and id, whose partitions also know the last row before and the
first row after them; a host with a third of all pages is split like others.
Only hashes of lines are sorted and paired (64 bits a line, compared within a
pair of pages); the text is read again for the result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html.parser import HTMLParser
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nestmart.session import materialize

#: Elements and names of the HTML standard, and usual names of page parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb "
    "rp rt rtc ruby s samp small span strike strong sub sup time tt u var wbr "
    "math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow "
    "ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none "
    "semantics".split())
DROPPED = frozenset(
    "head title script style noscript template nav header footer aside form button select "
    "textarea datalist iframe object svg canvas audio video menu dialog".split())
PARTS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner sponsor sponsored promo "
    "promotion cookie cookies consent gdpr notice notices alert popup modal overlay sidebar aside "
    "menu nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer comment "
    "comments commentlist respond replies disqus share sharing social newsletter subscribe signup "
    "login search related recommended skip pagination pager toolbar widget".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu "
    "menubar toolbar".split())
#: A marked article keeps its shared lines if under one part in so many of its characters would be left.
LEFT = 5
#: Parts into which the copies of one page are dealt when lines are deleted.
SALTS = 16
#: An element that ends an open one of these, up to the given border.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
          "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}


def _names_part(named: dict[str, str]) -> bool:
    """A class or id is the name of a page part, or begins with it (``ad-box``, not ``has-ads``)."""
    return any(name in PARTS or re.split(r"[^a-z0-9]+", name.lstrip("-_"))[0] in PARTS
               for name in f"{named.get('class', '')} {named.get('id', '')}".split())


class _Lines(HTMLParser):
    """Blocks of text of a page, in parts that know their region.

    A region is an element that is dropped, marks an article or is suspected by its
    role or name of being no part of the text; region 0 is the page.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int]] = []
        self.count: Counter = Counter()
        self.regions: list[tuple[int, str]] = [(0, "")]
        self.blocks: list[list[tuple[int, str]]] = []
        self.parts: list[tuple[int, str]] = []

    def _flush(self) -> None:
        if self.parts:
            self.blocks.append(self.parts)
        self.parts = []

    def _pop(self, at: int) -> None:
        for tag, _ in self.open[at:]:
            self.count[tag] -= 1
        del self.open[at:]

    def _implied(self, tag: str) -> None:
        """Close what a start tag ends: a paragraph before a block, an item before the next."""
        if tag not in INLINE and self.count["p"]:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == "p":
                    self._pop(k)
                if k >= len(self.open) or self.open[k][0] not in INLINE:
                    break
        closed, border = CLOSES.get(tag, ((), ()))
        if any(self.count[c] for c in closed):
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] in border:
                    break
                if self.open[k][0] in closed:
                    self._pop(k)
                    break

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self._flush()
        if tag in VOID:
            return
        self._implied(tag)
        named = {k: (v or "").lower() for k, v in attrs}
        role = named.get("role", "")
        skip = tag in DROPPED or "hidden" in named or named.get(
            "aria-hidden") == "true" or "display:none" in named.get("style", "").replace(" ", "")
        article = tag in ("article", "main") or role in ("main", "article") or named.get(
            "itemprop") == "articlebody"
        kind = "dropped" if skip else "article" if article else "role" if role in ROLES else (
            "name" if tag not in ("html", "body") and _names_part(named) else "")
        region = self.open[-1][1] if self.open else 0
        if kind and self.regions[region][1] != "dropped":
            self.regions.append((region, kind))
            region = len(self.regions) - 1
        self.open.append((tag, region))
        self.count[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self._flush()
        if self.count[tag]:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == tag:
                    self._pop(k)
                    break

    def handle_data(self, data: str) -> None:
        region = self.open[-1][1] if self.open else 0
        if self.regions[region][1] != "dropped":
            self.parts.append((region, data))


def _read(html: str | None) -> list[tuple[int, str]]:
    """(region of the outermost article or 0, line) of every open line."""
    parser = _Lines()
    parser.feed(html or "")
    parser.close()
    parser._flush()
    size, holds = [0] * len(parser.regions), [kind == "article" for _, kind in parser.regions]
    for block in parser.blocks:
        for k, text in block:
            size[k] += len("".join(text.split()))
    for k in range(len(size) - 1, 0, -1):
        parent = parser.regions[k][0]
        size[parent] += size[k]
        holds[parent] |= holds[k]
    marks = any(n and kind == "article" for n, (_, kind) in zip(size, parser.regions, strict=True))
    article, gone = [0], [False]
    for k, (parent, kind) in enumerate(parser.regions[1:], 1):
        article.append(article[parent] or (k if kind == "article" else 0))
        # what holds an article, or most of the text of a page without one, is a wrapper
        gone.append(gone[parent] or kind == "dropped" or kind in ("role", "name")
                    and not holds[k] and not (kind == "name" and not marks and 2 * size[k] > size[0]))
    lines = []
    for block in parser.blocks:
        kept = [x for x in block if not gone[x[0]]]
        for where, parts in groupby(kept, key=lambda x: article[x[0]]):
            line = " ".join("".join(text for _, text in parts).split())
            if line:
                lines.append((where, line))
    return lines


def page_lines(html: str | None) -> tuple[bool, list[bool], list[str]]:
    """(marked, own, lines): all open lines, and which of them are the page's own.

    Those of the article if an outermost element that marks one holds most of
    the open text, else all.
    """
    lines = _read(html)
    size: Counter = Counter()
    for where, line in lines:
        size[where] += len(line)
    article = max(size, key=size.__getitem__, default=0)
    marked = bool(article) and 2 * size[article] > size.total()
    return marked, [not marked or where == article for where, _ in lines], [x for _, x in lines]


def shared_lines(a: list[str], b: list[str]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b`` (bit-parallel rows)."""
    at: dict[str, int] = {}
    for j, line in enumerate(b):
        at[line] = at.get(line, 0) | 1 << j
    row, rows = (1 << len(b)) - 1, []
    full = row
    for line in a:
        hit = row & at.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    i, j, found = len(a), len(b), []
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if not i or rows[i - 1] >> (j - 1) & 1:
            found.append(i)
            j -= 1
    return found[::-1]


def _digests(marked: bool, own: list[bool], lines: list[str]) -> tuple[bytes, list[int]]:
    """A page's digest and one of each of its lines."""
    found = [blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest()
             for line in lines]
    whole = blake2b(bytes([marked, *own]), digest_size=16)
    for digest in found:
        whole.update(digest)
    return whole.digest(), [int.from_bytes(d, "little", signed=True) for d in found]


def _outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages = [page_lines(x.as_py()) for x in batch.column("html")]
        found = [_digests(*page) for page in pages]
        yield pa.RecordBatch.from_arrays(
            [batch.column("url"), pa.array([x[0] for x in found], pa.binary()),
             pa.array([x[0] for x in pages], pa.bool_()),
             pa.array([x[1] for x in pages], pa.list_(pa.bool_())),
             pa.array([x[1] for x in found], pa.list_(pa.int64())),
             pa.array([[len(line) for line in x[2]] for x in pages], pa.list_(pa.int32()))],
            names=["url", "content", "marked", "own", "hashes", "sizes"])


def _own_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages = [page_lines(x.as_py()) for x in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("url"),
             pa.array([_digests(*page)[0] for page in pages], pa.binary()),
             pa.array([[line for inside, line in zip(own, lines, strict=True) if inside]
                       for _, own, lines in pages], pa.list_(pa.string()))],
            names=["id", "url", "content", "lines"])


def _common(a: str, b: str) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def _template(page: dict, other: list[int]) -> list[int]:
    """Places among the page's own lines of those that it shares with the other page."""
    gone = [i for i in shared_lines(page["hashes"], other) if page["own"][i]]
    if page["marked"]:
        size = sum(n for n, own in zip(page["sizes"], page["own"], strict=True) if own)
        if LEFT * (size - sum(page["sizes"][i] for i in gone)) < size:
            return []
    place = list(accumulate(page["own"], initial=0))
    return [place[i] for i in gone]


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for x in batch.to_pylist():
            near = [p for p in (x["prev"], x["next"]) if p and p["host"] == x["host"]]
            if near:
                pair = max(near, key=lambda p, x=x: _common(p["path"], x["path"]))
                out.append(_template(x, pair["hashes"]))
            else:
                out.append([])
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), batch.column("content"), pa.array(out, pa.list_(pa.int32()))],
            names=["host", "content", "gone"])


def _paired(pages: DataFrame) -> DataFrame:
    """(host, content, gone) of distinct pages (host, path, content, outline) that lose lines."""
    order = ["host", "path", "content"]
    rows = materialize(
        pages.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
            "part", F.spark_partition_id()), "pages")
    row = F.struct("host", "path", "content", "hashes")
    key = F.struct("host", "path", "content")
    ends = rows.groupBy("part").agg(F.min_by(row, key).alias("first"),
                                    F.max_by(row, key).alias("last"))
    # a row for each partition of the sort, so one task can order them
    over = Window.orderBy("part")
    ends = ends.select("part", F.lag("last").over(over).alias("before"),
                       F.lead("first").over(over).alias("after"))
    inside = Window.partitionBy("part").orderBy(*order)
    return (rows.withColumn("prev", F.lag(row).over(inside))
            .withColumn("next", F.lead(row).over(inside)).join(ends, "part")
            .select("host", "path", "content", "marked", "own", "hashes", "sizes",
                    F.coalesce("prev", "before").alias("prev"),
                    F.coalesce("next", "after").alias("next"))
            .mapInArrow(_difference, "host string, content binary, gone array<int>")
            .filter(F.size("gone") > 0))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text) of every page: its main text, blocks joined by a space.

    * NULL or empty html, or no text left: the empty text.
    * A page that has no other page of its host, or only copies of itself:
      all lines of its article stay, or all open lines if it marks none.
      NULL urls are one host.
    * An element whose role, class or id is or begins with the name of a page
      part goes, unless it marks or holds an article; by class or id alone,
      also unless it holds most of the text of a page that marks none.
    * Markup that doesn't nest is read as browsers do for paragraphs, list
      items and table cells; other stray end tags are ignored.
    * Repeated rows are returned each; an empty table gives no rows. Other
      columns are not read.
    """
    id_type = pages.schema[id_col].dataType.simpleString()
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).alias("html"))
    address = F.regexp_extract(F.coalesce("url", F.lit("")),
                               r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?([^/?#]*)([^?#]*)", 0)
    split = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?([^/?#]*)([^?#]*)$"
    host = F.lower(F.regexp_extract(address, split, 1)).alias("host")
    outline = ("marked", "own", "hashes", "sizes")
    distinct = base.select("url", "html").mapInArrow(
        _outline, "url string, content binary, marked boolean, own array<boolean>, "
        "hashes array<long>, sizes array<int>").filter(F.size("hashes") > 0).select(
        host, F.regexp_extract(address, split, 2).alias("path"), "content", *outline).groupBy(
        "host", "content").agg(F.min("path").alias("path"),
                               *(F.first(c).alias(c) for c in outline))
    gone = materialize(_paired(distinct), "pages").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    texts = base.mapInArrow(
        _own_lines, f"id {id_type}, url string, content binary, lines array<string>").select(
        "id", "url", host, "content", "lines",
        F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt"))
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda _, i: ~F.array_contains("gone", i)))
    return texts.join(gone, ["host", "content", "salt"], "left").select(
        F.col("id").alias(id_col), F.col("url").alias(url_col),
        F.concat_ws(" ", kept).alias("text"))
