"""Periodic runs of words by recursive frequency splitting and a lag scan.

A run is a stretch of words with period q that no neighbouring word extends,
``MIN_PERIODS`` * q words long at least and ``MIN_WORDS`` at least. Each of its
words occurs in it ``MIN_PERIODS`` times or more, so

1. a word that occurs more rarely in a segment (at first: the text) is in no
   run of it and splits it; what is left between such words is split again by
   its own frequencies, until a segment holds no rare word, or too few words;
2. in a segment that survives, a run of lag q covers three blocks of q words in
   a row that begin at multiples of q, so for each lag only these blocks are
   compared, by differences of prefix hashes. Each group of equal blocks is
   extended to its run by a binary search over prefix hashes;
3. every run is confirmed on the words themselves before it is given; where
   equal hashes of other words deceived the search, the segment's lag is
   scanned word by word instead.

For n words of a segment the scan takes about n log n steps, whatever repeats.
A text is the unit of work: rows don't depend on each other, and there is no
shuffle. Splitting handles all texts of about two megabytes at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import BASE, WHITE_SPACE, Lexer, Words, mix, pieces, words

MIN_PERIODS, MIN_WORDS = 4, 6
LEXER = Lexer.separated_by(WHITE_SPACE)
_SPLIT = r"[\x20\x09-\x0D]+"


def split_by_frequency(value: np.ndarray, segment: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) of the stretches that survive; ``segment`` ascends over ``value``."""
    done: list[tuple[int, int]] = []
    at = np.arange(len(value))
    while len(at):
        # stretches of neighbouring places of one segment
        new = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(segment[at]) != 0)))
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(at)))
        long = np.repeat(size >= MIN_WORDS, size)
        at, new = at[long], new[long]
        if not len(at):
            break
        own = np.cumsum(new) - 1
        order = np.lexsort((value[at], own))
        v, s = value[at][order], own[order]
        head = np.flatnonzero(np.concatenate(([True], (v[1:] != v[:-1]) | (s[1:] != s[:-1]))))
        count = np.diff(np.append(head, len(v)))
        rare = np.zeros(len(at), dtype=bool)
        rare[order] = np.repeat(count < MIN_PERIODS, count)
        # segments without a rare word are stable
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(at)))
        stable = ~np.logical_or.reduceat(rare, begin)
        done += [(int(at[b]), int(at[b]) + int(n)) for b, n in zip(
            begin[stable], size[stable], strict=True)]
        at = at[~np.repeat(stable, size) & ~rare]
    return sorted(done)


def _prefix_hashes(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of value[i] * B**i modulo 2**64 before every place, and the powers of B."""
    power = np.full(len(value) + 1, BASE, dtype=np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    total = np.zeros(len(value) + 1, dtype=np.uint64)
    np.cumsum(value * power[:-1], out=total[1:])
    return total, power


class Segment:
    """Words of a segment (as 64-bit values) with constant-time comparison of stretches."""

    def __init__(self, value: np.ndarray):
        self.value, self.n = value, len(value)
        self.total, self.power = _prefix_hashes(value)

    def equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the stretches at a and at b (a < b) of the given sizes have equal hashes."""
        x = (self.total[a + size] - self.total[a]) * self.power[b - a]
        return x == self.total[b + size] - self.total[b]

    def candidates(self) -> tuple[np.ndarray, np.ndarray]:
        """(place, lag) of the first of each group of three equal blocks in a row."""
        places, lags = [], []
        for q in range(1, self.n // MIN_PERIODS + 1):
            ends = self.total[::q]
            block = ends[1:] - ends[:-1]
            # block k begins at k * q: move each to its right neighbour's place
            same = block[:-1] * self.power[q] == block[1:]
            three = same[:-1] & same[1:]
            if not three.any():
                continue
            first = np.flatnonzero(three & ~np.concatenate(([False], three[:-1])))
            places.append(first * q)
            lags.append(np.full(len(first), q))
        if not places:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(places), np.concatenate(lags)

    def extend(self, at: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the longest stretches of period q around ``at``."""
        # to the right: the most k with value[at:at + k] == value[at + q:at + q + k]
        low, high = np.zeros(len(at), dtype=np.int64), self.n - at - q
        while (low < high).any():
            mid = (low + high + 1) // 2
            ok = self.equal(at, at + q, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        end = at + q + low
        low, high = np.zeros(len(at), dtype=np.int64), at.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            ok = self.equal(at - mid, at - mid + q, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return at - low, end

    def _scan(self, q: int) -> Iterator[tuple[int, int]]:
        """Stretches of period q, place by place."""
        same = np.concatenate(([False], self.value[:-q] == self.value[q:], [False]))
        edge = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            yield a, b + q

    def _holds(self, start: int, end: int, q: int) -> bool:
        v = self.value
        return (np.array_equal(v[start:end - q], v[start + q:end])
                and (start == 0 or v[start - 1] != v[start - 1 + q])
                and (end == self.n or v[end] != v[end - q]))

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs, by start and period."""
        at, q = self.candidates()
        if not len(at):
            return []
        start, end = self.extend(at, q)
        least: dict[tuple[int, int], int] = {}
        for a, b, lag in zip(start.tolist(), end.tolist(), q.tolist(), strict=True):
            if b - a >= max(MIN_WORDS, MIN_PERIODS * lag):
                least[a, b] = min(lag, least.get((a, b), lag))
        if not all(self._holds(a, b, lag) for (a, b), lag in least.items()):
            least = {}
            for lag in sorted(set(q.tolist())):
                for a, b in self._scan(lag):
                    if b - a >= max(MIN_WORDS, MIN_PERIODS * lag):
                        least.setdefault((a, b), lag)
        return sorted(((a, b - a, lag) for (a, b), lag in least.items()),
                      key=lambda r: (r[0], r[2]))


def _exact(found: Words, data: bytes, lo: int, hi: int) -> np.ndarray:
    """Well-spread values of the words [lo, hi), equal only for equal words (``mix`` is one to one)."""
    number: dict[bytes, int] = {}
    own = [number.setdefault(data[a:b], len(number)) for a, b in zip(
        found.start[lo:hi].tolist(), found.end[lo:hi].tolist(), strict=True)]
    return mix(np.array(own, dtype=np.uint64) + BASE)


def _runs_of(piece, found: Words) -> dict[int, list[tuple[int, int, int]]]:
    """Runs of every text that has any, by the text's number in the piece."""
    base = np.searchsorted(found.doc, np.arange(piece.hi - piece.lo))
    data = None
    out: dict[int, list[tuple[int, int, int]]] = {}
    for lo, hi in split_by_frequency(found.hash, found.doc):
        if not len(Segment(found.hash[lo:hi]).candidates()[0]):
            continue
        data = piece.data.tobytes() if data is None else data
        doc = int(found.doc[lo])
        shift = lo - int(base[doc])
        out.setdefault(doc, []).extend(
            (a + shift, n, q)
            for a, n, q in Segment(_exact(found, data, lo, hi)).runs())
    return {d: r for d, r in out.items() if r}


def _collapsed(own: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    gone = np.zeros(len(own) + 1, dtype=np.int64)
    for a, n, q in runs:
        gone[a + q] += 1
        gone[a + n] -= 1
    gone = np.cumsum(gone)[:len(own)] > 0
    return [w for w, g in zip(own, gone.tolist(), strict=True) if not g]


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, runs, kept = [], [], []
        for piece in pieces(batch.column("text")):
            found = _runs_of(piece, words(piece, LEXER))
            for i in range(piece.hi - piece.lo):
                own = piece.text(i).split()
                n_words.append(len(own))
                here = found.get(i, [])
                if here:
                    own = _collapsed(own, here)
                kept.append(b" ".join(own))
                runs.append([{"start": a, "length": n, "period": q} for a, n, q in here])
        run = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(n_words, pa.int64()), pa.array(runs, run),
             pa.array(kept, pa.binary()).cast(pa.string())],
            names=["id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of every text, and the text with each run cut to its first period.

    Words are runs of other characters than ASCII white space, compared as
    they are and numbered from 0. A run is a stretch with smallest period q,
    at least max(6, 4 * q) words long, that cannot be made longer.

    Returns id_col, n_words, runs (array of start, length, period; by start,
    then period) and collapsed (words left, joined by a space: a word goes if
    any run holds it after that run's first q words); one row for each input
    row. Other columns of ``docs`` are not read.

    * NULL or empty text: no words, no runs, collapsed is empty.
    * NULL, shared and repeated ids: each row is judged by itself.
    * Empty table: no rows. Very long texts: memory is in proportion to the row.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(
        _find, f"id {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>,"
               " collapsed string")
    return found.select(F.col("id").alias(id_col), "n_words", "runs", "collapsed")


def with_planted_tail(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text; for one id in ten its words from some place on repeat with some period.

    With h the CRC-32 of the decimal id and g = h / 10: where h is a multiple
    of 10, word i from a = g % n on becomes word a + (i - a) % p, with
    p = 1 + (n - a) / (3 + g % 8). Rows without an id keep their text.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    own = F.filter(F.split(text_col, _SPLIT, -1), lambda w: w != "")

    def tail(w: Column) -> Column:
        n = F.greatest(F.size(w), F.lit(1))
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (g % 8 + 3))).cast("int")
        return F.array_join(F.transform(w, lambda _, i: F.element_at(
            w, F.when(i >= a, a + (i - a) % p).otherwise(i) + 1)), " ")

    planted = F.transform(F.array(own), tail)[0]
    return F.when((h % 10 == 0) & (F.size(own) > 0),
                  planted).otherwise(F.col(text_col))


def listed(runs: Column) -> Column:
    """Every run as a line ``start,length,period``."""
    return F.concat_ws("", F.transform(runs, lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                    r["period"].cast("string")), F.lit("\n"))))


def longest(runs: Column) -> Column:
    """The longest run (ties: the smallest start, then period); NULL if there is none."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"),
        (-r["period"]).alias("shorter"))))
    return F.when(F.size(runs) > 0, F.struct(
        (-best["before"]).alias("start"), best["length"].alias("length"),
        (-best["shorter"]).alias("period")))
