"""Fill-in-middle transformation by memoised content-defined chunks.

A text is cut into a prefix, a middle and a suffix at token boundaries whose
numbers follow from the document's id and its number of tokens. To find the
places of the cuts without walking through every text token by token:

1. a rolling hash of the last ``WINDOW`` bytes cuts the text into chunks, so
   equal passages give equal chunks wherever they stand;
2. a chunk has a summary: its characters, the words that start in it, the
   places at which words end, and whether it begins and ends inside a word. A
   cache with the chunk's bytes as key keeps the summaries, so a chunk that
   texts share is read once, and equal hashes of other bytes are never taken
   for it;
3. the summaries combine from left to right into running numbers of word ends
   and characters; the cut after a number of tokens lies in the first chunk
   whose running number reaches it, and the cached places of that chunk give it.

The cache belongs to a task and is bounded; what it holds changes no result.
Rows don't depend on each other, so there is no shuffle. The output text and
its restoration are expressions.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import BASE, WHITE_SPACE, Piece, mix, pieces

#: Bytes of the rolling hash, mean bytes of a chunk (a power of two), most bytes of a chunk.
WINDOW, MEAN_CHUNK, MAX_CHUNK = 32, 256, 1 << 14
#: Bytes of chunks that a task remembers.
CACHE_BYTES = 16 << 20
#: Texts are hashed in slices of so many bytes.
SLICE_BYTES = 2 << 20

# Fixed values of the transformation.
SEED = 42
PLAIN_FROM, SPM_UPTO = 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_BLANK = np.zeros(256, dtype=bool)
_BLANK[np.frombuffer(WHITE_SPACE, dtype=np.uint8)] = True


def _hash_ends(data: np.ndarray) -> np.ndarray:
    """Numbers of the bytes that the rolling hash of the WINDOW bytes up to them selects."""
    if len(data) < WINDOW:
        return np.zeros(0, dtype=np.int64)
    run, size = mix(np.arange(256, dtype=np.uint64) + BASE)[data], 1
    while size < WINDOW:
        run = run[:-size] + run[size:] * np.uint64(pow(int(BASE), size, 1 << 64))
        size *= 2
    return np.flatnonzero(run >> np.uint64(64 - MEAN_CHUNK.bit_length() + 1) == 0) + WINDOW - 1


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin: at every text, after bytes that the hash selects, and at
    ``MAX_CHUNK`` bytes from the last such place; always between two characters."""
    found = []
    for lo in range(0, len(data), SLICE_BYTES):
        begin = max(0, lo - WINDOW + 1)
        at = _hash_ends(data[begin:lo + SLICE_BYTES]) + begin
        found.append(at[at >= lo] + 1)
    at = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
    at = at[at < len(data)]
    text = np.searchsorted(offsets, at, side="right") - 1
    # the window must lie in one text, and a character must not be cut
    at = at[(at - offsets[text] >= WINDOW) & (data[at] & 0xC0 != 0x80)]
    starts = np.union1d(at, offsets[:-1][np.diff(offsets) > 0])
    sizes = np.diff(np.append(starts, len(data)))
    more = []
    for k in np.flatnonzero(sizes > MAX_CHUNK):
        for cut in range(int(starts[k]) + MAX_CHUNK, int(starts[k] + sizes[k]), MAX_CHUNK):
            while data[cut] & 0xC0 == 0x80:
                cut -= 1
            more.append(cut)
    return np.union1d(starts, np.array(more, dtype=np.int64)) if more else starts


def chunked(piece: Piece) -> tuple[np.ndarray, list[bytes]]:
    """Where a piece's chunks begin, and their bytes."""
    starts = chunk_starts(piece.data, piece.offsets)
    raw, cut = piece.data.tobytes(), [*starts.tolist(), len(piece.data)]
    return starts, [raw[a:b] for a, b in pairwise(cut)]


class Summaries:
    """Summaries of chunks by their bytes, in two generations of at most ``CACHE_BYTES`` each.

    A summary is (characters, words that start in the chunk if white space
    precedes it, whether it begins inside a word, whether it ends inside one,
    places at which a word ends before a later character of the chunk).
    """

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.size = limit, 0
        self.young: dict[bytes, tuple] = {}
        self.old: dict[bytes, tuple] = {}
        self.made = 0

    def of(self, chunks: list[bytes]) -> list[tuple]:
        out, missing = [], {}
        for c in chunks:
            known = self.young.get(c)
            if known is None:
                known = self.old.get(c)
                if known is None:
                    missing[c] = None
                else:
                    self._keep(c, known)
            out.append(known)
        if missing:
            new = dict(zip(missing, self._summarise(list(missing)), strict=True))
            self.made += len(new)
            out = [new[c] if s is None else s for c, s in zip(chunks, out, strict=True)]
            for c, s in new.items():
                self._keep(c, s)
        return out

    def _keep(self, chunk: bytes, summary: tuple) -> None:
        if self.size > self.limit:
            self.young, self.old, self.size = {}, self.young, 0
        self.young[chunk] = summary
        self.size += len(chunk)

    @staticmethod
    def _summarise(chunks: list[bytes]) -> Iterator[tuple]:
        data = np.frombuffer(b"".join(chunks), dtype=np.uint8)
        size = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        end = np.cumsum(size)
        first = end - size
        word = ~_BLANK[data]
        before = np.empty(len(data), dtype=bool)
        before[0], before[1:] = False, word[:-1]
        before[first] = False
        characters = data & 0xC0 != 0x80
        n_chars = np.add.reduceat(characters.astype(np.int64), first)
        n_words = np.add.reduceat((word & ~before).astype(np.int64), first)
        stop = np.flatnonzero(~word & before)
        upto = np.cumsum(characters)
        # characters of the chunk before the place
        place = (upto[stop] - 1).astype(np.int64)
        base = upto[first] - 1
        cut = np.searchsorted(stop, first)
        last = np.append(cut[1:], len(stop))
        begins, ends = word[first], word[end - 1]
        for k in range(len(chunks)):
            yield (int(n_chars[k]), int(n_words[k]), bool(begins[k]), bool(ends[k]),
                   (place[cut[k]:last[k]] - base[k]).astype(np.int32))


class Cuts:
    """Tokens of one text, from the summaries of its chunks."""

    def __init__(self, summaries: list[tuple]):
        self.summaries = summaries
        rows = [(c, w, b, e) for c, w, b, e, _ in summaries]
        chars, words, begins, ends = (np.array(x, dtype=np.int64) for x in zip(
            *rows, strict=True)) if rows else [np.zeros(0, dtype=np.int64)] * 4
        inside = np.concatenate(([0], ends[:-1]))
        #: a word that ended with the chunk before
        self.late = inside * (1 - begins)
        self.upto_char = np.cumsum(chars)
        started = np.cumsum(words - inside * begins)
        self.ended = started - ends
        self.n_chars = int(self.upto_char[-1]) if rows else 0
        n_words = int(started[-1]) if rows else 0
        self.n_tokens = n_words + (1 if rows and not ends[-1] else 0)

    def place(self, tokens: int) -> int:
        """Characters of the first ``tokens`` tokens."""
        if tokens <= 0:
            return 0
        if tokens >= self.n_tokens:
            return self.n_chars
        j = int(np.searchsorted(self.ended, tokens))
        before = int(self.upto_char[j - 1]) if j else 0
        rank = tokens - (int(self.ended[j - 1]) if j else 0) - int(self.late[j])
        return before if rank == 0 else before + int(self.summaries[j][4][rank - 1])


_CUT = "n long, prefix_chars long, middle_chars long"


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = Summaries()
    for batch in batches:
        h1 = batch.column("h1").to_pylist()
        h2 = batch.column("h2").to_pylist()
        out: list[tuple[int, int, int]] = []
        for piece in pieces(batch.column("text")):
            starts, chunks = chunked(piece)
            found = cache.of(chunks)
            first = np.searchsorted(starts, piece.offsets)
            for i in range(piece.hi - piece.lo):
                own = Cuts(found[first[i]:first[i + 1]])
                a, b = sorted(h % (own.n_tokens + 1)
                              for h in (h1[piece.lo + i], h2[piece.lo + i]))
                p = own.place(a)
                out.append((own.n_tokens, p, own.place(b) - p))
        n, p, m = zip(*out, strict=True) if out else ((), (), ())
        rest = [c for c in batch.schema.names if c not in ("h1", "h2")]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in rest], pa.array(n, pa.int64()),
             pa.array(p, pa.int64()), pa.array(m, pa.int64())],
            names=[*rest, "n", "prefix_chars", "middle_chars"])


def _draws(id_col: str, seed: int) -> list[Column]:
    """The first four groups of eight hex digits of the digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(
        F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def fill_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                seed: int = SEED) -> DataFrame:
    """Every text rearranged for filling in its middle.

    Tokens are runs of ASCII white space with the run of other characters that
    follows, and white space at the end of the text. Prefix, middle and suffix
    are cut at two token numbers drawn from a digest of ``seed`` and the id;
    the form (plain, psm: prefix, suffix, middle; spm: suffix, prefix, middle)
    is drawn from it too. A text that is empty or holds a marker stays plain.

    Returns id_col, n (tokens), form, prefix_chars, middle_chars (NULL if
    plain) and output; one row for each input row. :func:`restored` gives the
    text back from output and form. Other columns of ``docs`` are not read.

    * NULL text: the empty text.
    * NULL id: drawn like the empty id; ids that are equal draw equally, so
      repeated rows give equal rows.
    * Empty table: no rows.
    * Very long texts: hashed in slices; memory is in proportion to the row.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    h1, h2, h3, h4 = _draws(id_col, seed)
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    form = F.when((text == "") | marked | (h3 % 100 >= PLAIN_FROM), "plain").when(
        h4 % 100 < SPM_UPTO, "spm").otherwise("psm")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), h1.alias("h1"),
                       h2.alias("h2"), form.alias("form"))
    found = rows.mapInArrow(_locate, f"id {id_type}, text string, form string, {_CUT}")
    p, m = F.col("prefix_chars").cast("int"), F.col("middle_chars").cast("int")
    prefix = F.substring("text", F.lit(1), p)
    middle = F.substring("text", p + 1, m)
    suffix = F.substring("text", p + m + 1, F.length("text"))
    plain = F.col("form") == "plain"
    output = F.when(plain, F.col("text")).when(
        F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix,
                                         F.lit(MIDDLE), middle)).otherwise(
        F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    return found.select(F.col("id").alias(id_col), "n", "form",
                        F.when(~plain, F.col("prefix_chars")).alias("prefix_chars"),
                        F.when(~plain, F.col("middle_chars")).alias("middle_chars"),
                        output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that :func:`fill_middle` made ``output`` of, from it and its form only."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return F.when(form == "plain", output).when(
        form == "psm", F.concat(parts[1], parts[3], parts[2])).otherwise(
        F.concat(parts[2], parts[3], parts[1]))
