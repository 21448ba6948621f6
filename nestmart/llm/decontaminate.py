"""Benchmark decontamination as a prefix-filtered set join.

An item is cut into windows of ``window`` consecutive words (one window if it
has fewer). A text contains a window only if it contains every word of it, so
the necessary prefix of a window is one word: the rarest, by the counts of all
texts. Texts' words are joined with these prefix words; the prefix word's
place in the window fixes where the window would begin, so the positional
bound (it begins inside the text) and the length bound (it ends inside the
text) leave one candidate place, which is verified word by word.

The benchmark is read in blocks of at most ``BLOCK_BYTES`` of text; each block
is a pass over the texts inside one stage, so a benchmark of any size is
matched whole while what is sent to the tasks at once stays bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import Lexer, pieces, spans, words

WINDOW = 13
BLOCK_BYTES = 8 << 20
#: Word characters: digits, letters, and everything from U+0080 on.
LEXER = Lexer.separated_by(bytes(b for b in range(0x80) if not chr(b).isalnum()), lower=True)


def _split(text: str | None) -> list[bytes]:
    """Words of one text, folded."""
    for piece in pieces(pa.array([text], pa.string())):
        found = words(piece, LEXER)
        return [piece.data[a:b].tobytes().lower() for a, b in
                zip(found.start.tolist(), found.end.tolist(), strict=True)]
    return []


def _hash(own: list[bytes]) -> np.ndarray:
    """Hashes of single words, as :func:`words` gives them inside a text."""
    piece = next(pieces(pa.array([b" ".join(own).decode()], pa.string())))
    return words(piece, LEXER).hash


@dataclass
class Index:
    """Distinct windows of a block, found by their rarest word.

    ``rare``: sorted distinct prefix word hashes; postings ``lo[i]:hi[i]`` of
    ``rare[i]`` name the windows and the prefix word's place in them.
    """

    texts: list[bytes]
    items: list[list[str]]
    hashes: np.ndarray
    begin: np.ndarray
    length: np.ndarray
    rare: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    window: np.ndarray
    place: np.ndarray


def windows_of(rows: list[tuple[str | None, str | None]],
               size: int) -> dict[tuple[bytes, ...], list[str]]:
    """Word sequence of every window -> ids of the items that have it (items without one have
    windows, too)."""
    found: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in rows:
        own = _split(text)
        for k in range(max(1, len(own) - size + 1) if own else 0):
            ids = found.setdefault(tuple(own[k:k + size]), set())
            if item is not None:
                ids.add(item)
    return {w: sorted(ids) for w, ids in sorted(found.items())}


def build_index(found: dict[tuple[bytes, ...], list[str]], count: dict[bytes, int]) -> Index:
    vocabulary = sorted({w for own in found for w in own})
    code = dict(zip(vocabulary, _hash(vocabulary), strict=True))
    prefix = []
    for j, own in enumerate(found):
        place = min(range(len(own)), key=lambda k: (count.get(own[k], 0), own[k], k))
        prefix.append((int(code[own[place]]), j, place))
    prefix.sort()
    keys = np.array([p[0] for p in prefix], dtype=np.uint64)
    rare, lo, n = np.unique(keys, return_index=True, return_counts=True)
    length = np.array([len(own) for own in found], dtype=np.int64)
    return Index([b" ".join(own) for own in found], list(found.values()),
                 np.array([code[w] for own in found for w in own], dtype=np.uint64),
                 np.cumsum(length) - length, length, rare, lo, lo + n,
                 np.array([p[1] for p in prefix], dtype=np.int64),
                 np.array([p[2] for p in prefix], dtype=np.int64))


def _candidates(index: Index, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of every place where a window's prefix word stands."""
    if not len(index.rare):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    at = np.searchsorted(index.rare, h)
    at[at == len(index.rare)] = 0
    hit = np.flatnonzero(index.rare[at] == h)
    at = at[hit]
    n = index.hi[at] - index.lo[at]
    posting = np.repeat(index.lo[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return np.repeat(hit, n) - index.place[posting], index.window[posting]


def _matches(index: Index, piece, found) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of every verified occurrence in a piece."""
    start, window = _candidates(index, found.hash)
    end = start + index.length[window]
    ok = (start >= 0) & (end <= len(found.hash))
    start, window, end = start[ok], window[ok], end[ok]
    ok = found.doc[start] == found.doc[end - 1] if len(start) else ok[:0]
    start, window = start[ok], window[ok]
    for k in range(int(index.length.max(initial=0))):
        own = index.length[window] > k
        ok = ~own
        ok[own] = found.hash[start[own] + k] == index.hashes[index.begin[window[own]] + k]
        start, window = start[ok], window[ok]
    ok = np.array([b" ".join(piece.data[found.start[k]:found.end[k]].tobytes().lower()
                             for k in range(s, s + index.length[w])) == index.texts[w]
                   for s, w in zip(start.tolist(), window.tolist(), strict=True)], dtype=bool)
    return start[ok], window[ok]


def _join(index: Index):
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            n_words = np.zeros(n, dtype=np.int64)
            hits: list[list[dict]] = [x or [] for x in batch.column("spans").to_pylist()]
            items: list[list[str]] = [x or [] for x in batch.column("items").to_pylist()]
            for piece in pieces(batch.column("text")):
                found = words(piece, LEXER)
                own = np.bincount(found.doc, minlength=piece.hi - piece.lo)
                n_words[piece.lo:piece.hi] = own
                start, window = _matches(index, piece, found)
                base = np.cumsum(own) - own
                for d in np.unique(found.doc[start]).tolist():
                    mine = found.doc[start] == d
                    covered = np.zeros(own[d] + 1, dtype=np.int64)
                    first = start[mine] - base[d]
                    np.add.at(covered, first, 1)
                    np.add.at(covered, first + index.length[window[mine]], -1)
                    covered = np.cumsum(covered)[:own[d]] > 0
                    i = piece.lo + d
                    for s in hits[i]:
                        covered[s["start"]:s["end"]] = True
                    lo, hi = spans(covered)
                    hits[i] = [{"start": a, "end": b} for a, b in
                               zip(lo.tolist(), hi.tolist(), strict=True)]
                    items[i] = sorted({*items[i], *(x for w in set(window[mine].tolist())
                                                    for x in index.items[w])})
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text"), pa.array(n_words),
                 pa.array(hits, span), pa.array(items, pa.list_(pa.string()))],
                names=["id", "text", "n_words", "spans", "items"])

    return run


def _count(vocabulary: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            for piece in pieces(batch.column("text")):
                h = words(piece, LEXER).hash
                at = np.searchsorted(vocabulary, h)
                at[at == len(vocabulary)] = 0
                total += np.bincount(at[vocabulary[at] == h], minlength=len(vocabulary))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])],
                                         names=["word", "n"])

    return run


def word_counts(texts: DataFrame, vocabulary: list[bytes]) -> dict[bytes, int]:
    """How often each of the given words stands in all of ``texts`` (text)."""
    if not vocabulary:
        return {}
    h = _hash(vocabulary)
    order = np.argsort(h)
    rows = texts.mapInArrow(_count(h[order]), "word long, n long").groupBy("word").agg(
        F.sum("n").alias("n")).collect()
    return {vocabulary[order[r.word]]: r.n for r in rows}


def _blocks(items: DataFrame, limit: int) -> Iterator[list[tuple[str | None, str | None]]]:
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // limit))
    for k in range(n):
        own = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield [(r.item, r.text) for r in own.toLocalIterator()]


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                  mark_col: str | None = None) -> DataFrame:
    """Occurrences of benchmark windows in every text.

    Words are runs of digits, letters and characters from U+0080 on, A-Z in
    lower case. A window is ``window`` consecutive words of an item; an item
    of fewer words, but not none, is one window.

    Returns id_col, n_words, spans (maximal ranges of word numbers inside
    occurrences, end exclusive) and items (ids, as sorted strings, of items
    with an occurring window); one row for each input row. With ``mark_col``
    also the text's xxhash64 under that name, which tells rows apart that share
    an id or have none.

    * NULL or empty text: no words, no spans.
    * NULL or empty item: no windows. The windows of an item without an id count
      for spans, and name no item.
    * Repeated rows and items: a repeated row gives the same result twice, a
      repeated item id is listed once, items with equal windows are all listed.
    * Empty documents: no rows. Empty benchmark: no spans.
    * Other columns of either table are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = out.select("text")
    out = out.select("id", "text", F.lit(0).cast("long").alias("n_words"),
                     F.lit(None).cast("array<struct<start:long,end:long>>").alias("spans"),
                     F.lit(None).cast("array<string>").alias("items"))
    items = benchmark.select(F.col(item_col).cast("string").alias("item"),
                             F.col(item_text_col).alias("text"))
    for rows in _blocks(items, block_bytes):
        found = windows_of(rows, window)
        count = word_counts(texts, sorted({w for own in found for w in own}))
        out = out.mapInArrow(
            _join(build_index(found, count)),
            f"id {id_type}, text string, n_words long, "
            "spans array<struct<start:long,end:long>>, items array<string>")
    return out.select(F.col("id").alias(id_col), "n_words", "spans", "items",
                      *([F.xxhash64("text").alias(mark_col)] if mark_col else []))


def hit_words(spans_col: str | Column = "spans") -> Column:
    """Number of words inside spans."""
    return F.aggregate(spans_col, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least a twentieth of the words are hit, and at least one."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
