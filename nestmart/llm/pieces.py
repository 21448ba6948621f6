"""SentencePiece encoding and decoding with a max-plus parallel scan.

A text's encoding is the segmentation of greatest total piece score (spaces
written as U+2581, one in front). Scores add along a path and the best path is
a maximum, so a stretch of text is a matrix over (max, +): entry i, j is the
best score of a path that enters with its first i characters already taken by
the piece before and leaves with its last piece reaching j characters into the
next stretch. Texts longer than ``CHUNK`` characters are cut into chunks;
tasks compute the chunks' matrices, blocks of ``BLOCK`` matrices multiply
associatively, and a scan over blocks and then chunks gives the best scores at
every boundary. With these each chunk finds the best path back from every place
where it may be left to where that path came in; these maps compose, block by
block, too, which fixes each chunk's end, and it is then traced back on its own.

One rule holds for all lengths and chunk sizes: of equally good paths to a
place the one whose last piece is longest is taken. Scores are multiples of
``GRID``, so that sums in double precision are exact in any order of adding.

No piece holds U+2581 after another character (checked when a model is
loaded), so every path passes each such place: inside a chunk only the words
cut by its ends need the matrix, and words between are encoded from a cache.

The pieces and scores come from a model file of a public tokenizer. They are
used as a unigram model, whatever way the file's vocabulary was made.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmart.session import materialize

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
CHUNK = 1 << 15
BLOCK = 64
MEMO = 150_000
MEMO_CHARS = 48
#: The library adds in single precision, which is exact for whole numbers up to this one; words
#: whose sums might be beyond it are encoded here, by the same rule.
EXACT_SUM = 1 << 24
#: Chunks, and rows to decode, that a task holds as Python objects at once.
CHUNKS_AT_ONCE = 16
ROWS_AT_ONCE = 512
#: Scores are read as the nearest multiple of this.
GRID = 2.0 ** -16
UNKNOWN_PENALTY = 10.0
#: Texts whose new words are looked up together.
GROUP_CHARS = 1 << 20
LOST = float("-inf")


def _field(number: int, kind: int, value: bytes) -> bytes:
    out = bytes([number << 3 & 0x7F | kind | (0x80 if number > 15 else 0)])
    if number > 15:
        out += bytes([number >> 4])
    if kind == 2:
        n, size = len(value), b""
        while n > 0x7F:
            size, n = size + bytes([n & 0x7F | 0x80]), n >> 7
        out += size + bytes([n])
    return out + value


class Model:
    """Pieces and scores of a model file, read as a unigram model."""

    def __init__(self, data: bytes):
        source = sentencepiece.SentencePieceProcessor(model_proto=data)
        n = source.get_piece_size()
        self.names = [source.id_to_piece(i) for i in range(n)]
        self.score_of: dict[str, float] = {}
        self.id_of: dict[str, int] = {}
        self.bytes_of: dict[int, int] = {}
        self.skipped: set[int] = set()
        body = b""
        for i, name in enumerate(self.names):
            score, kind = round(source.get_score(i) / GRID) * GRID, 1
            if source.is_unknown(i):
                kind = 2
            elif source.is_control(i):
                kind = 3
            elif source.is_byte(i):
                kind = 6
                self.bytes_of[int(name[3:5], 16)] = i
            else:
                self.score_of[name], self.id_of[name] = score, i
            if kind in (2, 3):
                self.skipped.add(i)
            piece = (_field(1, 2, name.encode())
                     + _field(2, 5, struct.pack("<f", max(score, -EXACT_SUM / 2)))
                     + _field(3, 0, bytes([kind])))
            body += _field(1, 2, piece)
        if len(self.bytes_of) != 256:
            raise ValueError("the model has no byte pieces, so texts could not be restored")
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.score_of):
            raise ValueError("the model has pieces across word ends")
        self.unknown = min(self.score_of.values()) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.score_of))
        # each piece's part of a path's score; a character's bytes together count as unknown
        self.score_at = np.array([self.score_of.get(name, 0.0) for name in self.names])
        for b, i in self.bytes_of.items():
            self.score_at[i] = 0.0 if b & 0xC0 == 0x80 else self.unknown
        self.exact_chars = self._exact_chars()
        known = "".join(map(re.escape, sorted(set("".join(self.score_of)) - {SPACE})))
        # a character that no piece holds stands alone
        self.split = re.compile(f"{SPACE}+[{known}]*|[{known}]+|.", re.DOTALL).findall
        value = {i: bytes([b]) for b, i in self.bytes_of.items()}
        self.raw = [b"" if i in self.skipped else value.get(i, name.replace(SPACE, " ").encode())
                    for i, name in enumerate(self.names)]
        trainer = _field(3, 0, b"\x01") + _field(35, 0, b"\x01")
        normal = _field(1, 2, b"identity") + b"".join(_field(k, 0, b"\x00") for k in (3, 4, 5))
        self.library = sentencepiece.SentencePieceProcessor(
            model_proto=body + _field(2, 2, trainer) + _field(3, 2, normal))
        self.memo: dict[str, bytes] = {}

    def _exact_chars(self) -> int:
        """Length up to which the library's best path of a word is certainly the one of ``best``.

        Pieces that score below half of ``EXACT_SUM`` stand in the library's
        model with that score: it outweighs all others of such a word, and so
        does the true one. It must occur at most once, so these pieces may only
        be U+2581 (a word with several is encoded here).
        """
        usual = [x for x in self.score_of.values() if x > -EXACT_SUM / 2]
        chars = set("".join(self.score_of))
        if (not usual or not all(x.is_integer() for x in usual)
                or not all(c in self.score_of for c in chars)
                or any(x <= -EXACT_SUM / 2 and p.strip(SPACE) for p, x in self.score_of.items())):
            return 0
        return int((EXACT_SUM / 2 - 2 * UNKNOWN_PENALTY) // max(1.0, *map(abs, usual)))

    def by_library(self, word: str) -> bool:
        return len(word) <= self.exact_chars and not word.startswith(SPACE + SPACE)

    def edges(self, s: str, at: int) -> Iterator[tuple[int, float]]:
        """(length, score) of what can stand at a place, short to long."""
        score = self.score_of
        yield 1, score.get(s[at], self.unknown)
        for k in range(2, min(self.longest, len(s) - at) + 1):
            own = score.get(s[at:at + k])
            if own is not None:
                yield k, own

    def best(self, s: str, reach: list[float], until: int) -> tuple[list[float], list[int]]:
        """Score of, and last piece's start on, the best path to every place.

        Paths come in at the first places, with the scores ``reach``; the start
        is -1 where one that ends there is best. Pieces start before ``until``
        and may end after it. Of equal scores the longest last piece stays.
        """
        total = [*reach[:len(s) + 1], *[LOST] * (len(s) + 1 - len(reach))]
        start = [-1] * (len(s) + 1)
        for p in range(until):
            here = total[p]
            if here == LOST:
                continue
            for k, own in self.edges(s, p):
                if here + own > total[p + k]:
                    total[p + k], start[p + k] = here + own, p
        return total, start

    def ids(self, piece: str) -> list[int]:
        found = self.id_of.get(piece)
        return [found] if found is not None else [self.bytes_of[b] for b in piece.encode()]

    def trace(self, s: str, reach: list[float], end: int, until: int) -> list[int]:
        """Ids on the best path to ``end`` from where it came in; ``best`` has the rest."""
        _, start = self.best(s, reach, until)
        cuts = [end]
        while start[cuts[-1]] >= 0:
            cuts.append(start[cuts[-1]])
        cuts.reverse()
        return [i for a, b in zip(cuts, cuts[1:], strict=False) for i in self.ids(s[a:b])]

    def own(self, word: str) -> bytes:
        """Ids (int32) of a word, without the library."""
        return array("i", self.trace(word, [0.0], len(word), len(word))).tobytes()

    def learn(self, words: set[str]) -> None:
        """Remember the ids of words of up to ``MEMO_CHARS`` characters, by one library call.

        Words for which that might not be exact are encoded here.
        """
        memo = self.memo
        new = [w for w in words if w not in memo and len(w) <= MEMO_CHARS]
        if new and len(memo) > MEMO:
            memo.clear()
            new = [w for w in words if len(w) <= MEMO_CHARS]
        fast = [w for w in new if self.by_library(w)]
        for w, ids in zip(fast, self.library.encode(fast, num_threads=1), strict=True):
            memo[w] = array("i", ids).tobytes()
        for w in new:
            if w not in memo:
                memo[w] = self.own(w)

    def rare(self, word: str) -> bytes:
        """Ids (int32) of a word that is too long to be remembered."""
        if self.by_library(word):
            return array("i", self.library.encode(word)).tobytes()
        return self.own(word)

    def words(self, words: list[str]) -> bytes:
        """Ids (int32) of whole words, one after the other."""
        memo = self.memo
        try:
            return b"".join([memo[w] for w in words])
        except KeyError:
            distinct = set(words)
        self.learn(distinct)
        rare = {w: self.rare(w) for w in distinct if w not in memo}
        return b"".join([rare[w] if w in rare else memo[w] for w in words])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids (int32) of each text; their new words are learned together."""
        split = [self.split(normal(t)) if t else [] for t in texts]
        self.learn(set().union(*split))
        return [self.words(w) for w in split]

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text of ids; unknown and control ids, and ids that name no piece, give nothing."""
        ids = np.asarray(ids, dtype=np.int64)
        known = ids[(ids >= 0) & (ids < len(self.raw))].tolist()
        return b"".join(map(self.raw.__getitem__, known)).decode("utf-8", "replace")[1:]

    def ends(self, s: str, size: int) -> tuple[int, int] | None:
        """First and last place of a chunk where a word begins after another."""
        first = re.search(f"(?<=[^{SPACE}]){SPACE}", s[:size])
        if first is None:
            return None
        last = first.start()
        at = s.rfind(SPACE, 0, size)
        while at > last:
            if s[at - 1] != SPACE:
                last = at
                break
            at = s.rfind(SPACE, 0, at)
        return first.start(), last

    def matrix(self, s: str, size: int) -> np.ndarray:
        """(max, +) matrix of a chunk of ``size`` characters; the rest of ``s`` follows it."""
        n = self.longest
        out = np.full((n, n), LOST)
        ends = self.ends(s, size)
        if ends is None:
            for i in range(min(n, size + 1)):
                total = self.best(s, entering(i), size)[0][size:size + n]
                out[i, :len(total)] = total
            return out
        first, last = ends
        head = np.array([self.best(s[:first], entering(i), first)[0][first]
                         for i in range(min(n, first + 1))])
        middle = self.score_at[np.frombuffer(self.words(self.split(s[first:last])),
                                             dtype=np.int32)].sum()
        tail = np.array(self.best(s[last:], [0.0], size - last)[0][size - last:][:n])
        out[:len(head), :len(tail)] = head[:, None] + middle + tail[None, :]
        return out

    def ways(self, s: str, size: int, reach: list[float]) -> np.ndarray:
        """For every place where a chunk may be left, where the best path to it came in.

        ``reach`` has the best scores of paths into the chunk's first places.
        """
        ends = self.ends(s, size)
        if ends is not None:
            first = ends[0]
            _, start = self.best(s[:first], reach, first)
            return np.full(self.longest, _entry(start, first), dtype=np.int32)
        total, start = self.best(s, reach, size)
        out = np.full(self.longest, -1, dtype=np.int32)
        for j, score in enumerate(total[size:size + self.longest]):
            if score != LOST:
                out[j] = _entry(start, size + j)
        return out

    def chunk_ids(self, s: str, size: int, reach: list[float], leave: int) -> bytes:
        """Ids of the pieces that start in a chunk, given the scores into it and its end."""
        ends = self.ends(s, size)
        if ends is None:
            return array("i", self.trace(s, reach, size + leave, size)).tobytes()
        first, last = ends
        return (array("i", self.trace(s[:first], reach, first, first)).tobytes()
                + self.words(self.split(s[first:last]))
                + array("i", self.trace(s[last:], [0.0], size + leave - last,
                                        size - last)).tobytes())


def entering(place: int) -> list[float]:
    """Scores of the one path that comes in at a place."""
    return [LOST] * place + [0.0]


def _entry(start: list[int], at: int) -> int:
    while start[at] >= 0:
        at = start[at]
    return at


def normal(text: str) -> str:
    return SPACE + text.replace(" ", SPACE)


@lru_cache(maxsize=2)
def load(data: bytes) -> Model:
    return Model(data)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix product over (max, +)."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def reaches(matrices: list[np.ndarray], enter: np.ndarray) -> list[np.ndarray]:
    """Best scores at the beginning of every stretch, from those at the first one's."""
    seen = [enter]
    for m in matrices[:-1]:
        seen.append((seen[-1][:, None] + m).max(axis=0))
    return seen


def leaves(ways: list[np.ndarray], leave: int) -> list[int]:
    """Where each stretch is left, from where the last one is."""
    seen = [leave]
    for way in ways[:0:-1]:
        seen.append(int(way[seen[-1]]))
    return seen[::-1]


def _matrices(column: pa.ChunkedArray) -> list[np.ndarray]:
    found = [np.frombuffer(x, dtype=np.float64) for x in column.to_pylist()]
    return [x.reshape(round(len(x) ** 0.5), -1) for x in found]


def _ids_column(parts: list[bytes]) -> pa.Array:
    offsets = np.cumsum([0, *(len(p) // 4 for p in parts)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                    pa.array(np.frombuffer(b"".join(parts), dtype=np.int32)))


def _encode_short(data: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(data)
        for batch in batches:
            lo, held, size = 0, [], 0
            for i, t in enumerate(batch.column("text")):
                held.append(t.as_py() or "")
                size += len(held[-1])
                if size >= GROUP_CHARS or i + 1 == len(batch):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").slice(lo, len(held)),
                         _ids_column(model.encode(held))], names=["id", "ids"])
                    lo, held, size = i + 1, [], 0

    return run


def _few(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, len(batch), rows):
            yield batch.slice(lo, rows)


def _chunks(ahead: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in enumerate(batch.column("text")):
                s = normal(t.as_py())
                for lo in range(0, len(s), chunk):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").slice(i, 1), batch.column("row").slice(i, 1),
                         pa.array([lo // chunk], pa.int32()),
                         pa.array([min(chunk, len(s) - lo)], pa.int32()),
                         pa.array([s[lo:lo + chunk + ahead]], pa.string())],
                        names=["id", "row", "number", "size", "text"])

    return run


def _transfer(data: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(data)
        for batch in _few(batches, CHUNKS_AT_ONCE):
            found = [model.matrix(s.as_py(), n.as_py()).tobytes() for s, n in
                     zip(batch.column("text"), batch.column("size"), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("number"), pa.array(found, pa.binary())],
                names=["row", "number", "matrix"])

    return run


def _combine(table: pa.Table) -> pa.Table:
    table = table.sort_by("number")
    own = _matrices(table["matrix"])
    total = own[0]
    for m in own[1:]:
        total = product(total, m)
    return pa.table({"row": table["row"][:1], "block": table["block"][:1],
                     "matrix": pa.array([total.tobytes()], pa.binary())})


def _reach_blocks(table: pa.Table) -> pa.Table:
    table = table.sort_by("block")
    matrices = _matrices(table["matrix"])
    first = np.full(len(matrices[0]), LOST)
    first[0] = 0.0
    return pa.table({"row": table["row"], "block": table["block"],
                     "reach": pa.array([r.tobytes() for r in reaches(matrices, first)],
                                       pa.binary())})


def _reach_chunks(table: pa.Table) -> pa.Table:
    table = table.sort_by("number")
    first = np.frombuffer(table["reach"][0].as_py(), dtype=np.float64)
    found = reaches(_matrices(table["matrix"]), first)
    return pa.table({"row": table["row"], "number": table["number"],
                     "reach": pa.array([r.tobytes() for r in found], pa.binary())})


def _ways(data: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(data)
        for batch in _few(batches, CHUNKS_AT_ONCE):
            found = [model.ways(s, n, np.frombuffer(r, dtype=np.float64).tolist()).tobytes()
                     for s, n, r in zip(*(batch.column(c).to_pylist() for c in (
                         "text", "size", "reach")), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("number"), pa.array(found, pa.binary())],
                names=["row", "number", "way"])

    return run


def _way_list(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=np.int32) for x in column.to_pylist()]


def _compose(table: pa.Table) -> pa.Table:
    """A block's way: from where its last chunk is left to where its first is entered."""
    own = _way_list(table.sort_by("number")["way"])
    total = own[-1]
    for way in own[-2::-1]:
        # places that no path leaves from stay without one
        total = np.where(total >= 0, way[total], -1).astype(np.int32)
    return pa.table({"row": table["row"][:1], "block": table["block"][:1],
                     "way": pa.array([total.tobytes()], pa.binary())})


def _leave_blocks(table: pa.Table) -> pa.Table:
    table = table.sort_by("block")
    return pa.table({"row": table["row"], "block": table["block"],
                     "leave": pa.array(leaves(_way_list(table["way"]), 0), pa.int32())})


def _leave_chunks(table: pa.Table) -> pa.Table:
    table = table.sort_by("number")
    found = leaves(_way_list(table["way"]), table["leave"][0].as_py())
    return pa.table({"row": table["row"], "number": table["number"],
                     "leave": pa.array(found, pa.int32())})


def _trace(data: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(data)
        for batch in _few(batches, CHUNKS_AT_ONCE):
            found = [model.chunk_ids(s, n, np.frombuffer(r, dtype=np.float64).tolist(), leave)
                     for s, n, r, leave in zip(*(batch.column(c).to_pylist() for c in (
                         "text", "size", "reach", "leave")), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row"), batch.column("number"),
                 _ids_column(found)], names=["id", "row", "number", "ids"])

    return run


def _model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _encode_long(docs: DataFrame, data: bytes, id_type: str, chunk: int) -> DataFrame:
    numbered = docs.withColumn("row", F.monotonically_increasing_id())
    chunks = materialize(numbered.mapInArrow(
        _chunks(load(data).longest, chunk),
        f"id {id_type}, row long, number int, size int, text string").repartition(
        "row", "number"), "pieces")
    block = F.floor(F.col("number") / BLOCK).cast("int").alias("block")
    matrices = materialize(chunks.select("row", "number", "size", "text").mapInArrow(
        _transfer(data), "row long, number int, matrix binary").select("*", block), "pieces")
    blocks = matrices.groupBy("row", "block").applyInArrow(
        _combine, "row long, block int, matrix binary")
    bounds = blocks.groupBy("row").applyInArrow(
        _reach_blocks, "row long, block int, reach binary")
    reached = materialize(matrices.join(bounds, ["row", "block"]).groupBy(
        "row", "block").applyInArrow(_reach_chunks, "row long, number int, reach binary"), "pieces")
    ways = materialize(chunks.join(reached, ["row", "number"]).select(
        "row", "number", "size", "text", "reach").mapInArrow(
        _ways(data), "row long, number int, way binary").select("*", block), "pieces")
    lasts = ways.groupBy("row", "block").applyInArrow(
        _compose, "row long, block int, way binary").groupBy("row").applyInArrow(
        _leave_blocks, "row long, block int, leave int")
    left = ways.join(lasts, ["row", "block"]).groupBy("row", "block").applyInArrow(
        _leave_chunks, "row long, number int, leave int")
    traced = chunks.join(reached, ["row", "number"]).join(left, ["row", "number"]).select(
        "id", "row", "number", "size", "text", "reach", "leave").mapInArrow(
        _trace(data), f"id {id_type}, row long, number int, ids array<int>")
    return traced.groupBy("row").agg(
        F.first("id").alias("id"),
        F.flatten(F.sort_array(F.collect_list(F.struct("number", "ids")))["ids"]).alias("ids")
    ).select("id", "ids")


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           model_file: str = MODEL_FILE, chunk: int = CHUNK) -> DataFrame:
    """(id_col, ids) of every row: piece ids of its whole text.

    Characters without a piece become byte pieces, so decoding restores every
    text but for U+2581 in it, which comes back as a space. Of segmentations
    with equal scores the one with the longest last piece is taken, of these the
    one with the longest piece before it, and so on; ``chunk`` does not matter.

    * NULL or empty text: an empty list. NULL ids are ordinary.
    * Repeated rows are encoded each; an empty table gives no rows. Other
      columns are not read.
    """
    data = _model_bytes(model_file)
    if chunk < load(data).longest:
        raise ValueError("chunks must be at least as long as the longest piece")
    id_type = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    is_long = F.coalesce(F.length("text") > chunk, F.lit(False))
    short = base.filter(~is_long).mapInArrow(_encode_short(data), f"id {id_type}, ids array<int>")
    long = _encode_long(base.filter(is_long), data, id_type, chunk)
    return short.unionByName(long).select(F.col("id").alias(id_col), "ids")


def decode(encoded: DataFrame, ids_col: str = "ids", out_col: str = "text",
           model_file: str = MODEL_FILE) -> DataFrame:
    """``encoded`` with the text of ids_col added; NULL ids give NULL.

    A column ``out_col`` is replaced. Unknown and control ids, NULLs in the
    list and ids that name no piece give nothing; bytes that are no UTF-8 give
    U+FFFD. An empty table gives no rows.
    """
    data = _model_bytes(model_file)
    names = [c.lower() for c in encoded.columns]
    source = names.index(ids_col.lower())
    at = names.index(out_col.lower()) if out_col.lower() in names else len(names)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields]
    fields[at:at + 1] = [f"`{out_col}` string"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(data)
        for batch in _few(batches, ROWS_AT_ONCE):
            texts = [model.decode(ids.values.fill_null(-1).to_numpy()) if ids.is_valid else None
                     for ids in batch.column(source)]
            columns, given = batch.columns, batch.schema.names
            columns[at:at + 1], given[at:at + 1] = [pa.array(texts, pa.string())], [out_col]
            yield pa.RecordBatch.from_arrays(columns, names=given)

    return encoded.mapInArrow(run, ", ".join(fields))
