"""Substring dedup by Rabin-Karp hashes of every fixed-length word window.

Three steps, all of them Spark jobs:

1. every task hashes all windows of its texts and sends one row per bucket of
   hash values with the first occurrence, in its chunk, of each hash;
2. a bucket's group finds the hashes that occur more than once and keeps the
   first place of each; the other places are repeats;
3. a text's repeats merge into maximal word intervals, which are cut out.

A window that is in a third of all texts reaches its bucket once for each
chunk of about a million windows, not once for each text, so no bucket is
unbounded; the number of buckets follows the measured size of the input.

A window has two hashes. The second, of 32 bits, is compared inside a chunk and
names the bucket; the first, of 64 bits, is compared inside the bucket. So of n
different windows in b buckets about n * n / (b * 2**65) pairs are expected to be
taken for equal: 0.0006 among the 5 * 10**9 windows of 30 GB, in about 1,200
buckets. Beyond that equal hashes are not verified on words; words of equal 64-bit
hash (about 0.03 pairs among 10**9 different words) are one to both hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keyed import keyed
from .words import WHITE_SPACE, Lexer, mix, pieces, spans, window_hashes, words

WINDOW = 20
CHUNK_WINDOWS = 1 << 20
BUCKET_CHARS = 24 << 20
#: Buckets at least, so that small inputs are spread over tasks too.
MIN_BUCKETS = 64
LEXER = Lexer.separated_by(WHITE_SPACE)
_SECOND = np.uint64(0xD6E8FEB86659FD93)

_ENTRY = ("bucket int, local boolean, keys binary, marks binary, counts binary, "
          "places binary, n long, hashes binary")
_REPEAT = "key long, mark long, starts binary"


def _pack(places: np.ndarray) -> bytes:
    return pa.compress(places.astype(np.uint32).tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True)
    return np.frombuffer(raw, dtype=np.uint32)


def _row(bucket: int, local: bool, docs: np.ndarray, places: np.ndarray, keys: np.ndarray,
         marks: np.ndarray, hashes: np.ndarray | None) -> tuple:
    """Places of consecutive entries of one text are sent as differences."""
    change = np.flatnonzero(np.diff(docs, prepend=-1))
    delta = np.diff(places, prepend=0)
    delta[change] = places[change]
    counts = np.diff(np.append(change, len(docs)))
    return (bucket, local, keys[docs[change]].tobytes(), marks[docs[change]].tobytes(),
            counts.astype(np.int32).tobytes(), _pack(delta), len(docs),
            b"" if hashes is None else hashes.tobytes())


def _chunk_rows(parts: list[tuple], buckets: int, number: int) -> Iterator[tuple]:
    """Rows of one chunk; ``parts`` has (hash, second hash, text, place, keys, marks) per piece."""
    keys = np.concatenate([p[4] for p in parts])
    marks = np.concatenate([p[5] for p in parts])
    shift = np.cumsum([0, *[len(p[4]) for p in parts]])
    doc = np.concatenate([p[2] + s for p, s in zip(parts, shift, strict=False)])
    h = np.concatenate([p[0] for p in parts])
    second = np.concatenate([p[1] for p in parts])
    place = np.concatenate([p[3] for p in parts])
    by_key = np.argsort(keys, kind="stable")
    if not np.array_equal(by_key, np.arange(len(keys))):
        rank = np.empty(len(keys), dtype=np.int64)
        rank[by_key] = np.arange(len(keys))
        doc, keys, marks = rank[doc], keys[by_key], marks[by_key]
    if len(doc) > 1 and (np.diff(doc) < 0).any():
        order = np.lexsort((place, doc))
        doc, h, second, place = doc[order], h[order], second[order], place[order]
    order = np.argsort(h, kind="stable")
    ordered, other = h[order], second[order]
    # equal windows that a false pair stands between meet again in their bucket
    new = np.concatenate(([True], (ordered[1:] != ordered[:-1]) | (other[1:] != other[:-1])))
    first = order[new]
    leader = np.repeat(first, np.diff(np.append(np.flatnonzero(new), len(h))))
    later = (keys[doc[order]] != keys[doc[leader]]) | (place[order] != place[leader])
    repeats = np.sort(order[~new & later])
    if len(repeats):
        # any bucket may take them; the chunk's first text and number deal them to all
        first = doc[repeats[0]]
        bucket = hash((int(keys[first]), int(marks[first]), number)) % buckets
        yield _row(bucket, True, doc[repeats], place[repeats], keys, marks, None)
    tie = ~new & ~later & (marks[doc[order]] != marks[doc[leader]])
    first = order[new | tie]
    bucket = (second[first].astype(np.uint64) * np.uint64(buckets) >> np.uint64(32)).astype(
        np.int64)
    order = np.lexsort((first, bucket))
    first, bucket = first[order], bucket[order]
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    for lo, hi in zip(cut, np.append(cut[1:], len(first)), strict=True):
        own = first[lo:hi]
        yield _row(int(bucket[lo]), False, doc[own], place[own], keys, marks, h[own])


def _emit(buckets: int, window: int):
    chunk = max(CHUNK_WINDOWS, 64 * buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("local", pa.bool_()), ("keys", pa.binary()),
                            ("marks", pa.binary()), ("counts", pa.binary()),
                            ("places", pa.binary()), ("n", pa.int64()), ("hashes", pa.binary())])
        held, size, number = [], 0, 0

        def flush():
            rows = list(_chunk_rows(held, buckets, number))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                schema=schema)

        for batch in batches:
            key = np.asarray(batch.column("key"), dtype=np.int64)
            mark = np.asarray(batch.column("mark"), dtype=np.int64)
            for piece in pieces(batch.column("text")):
                found = words(piece, LEXER)
                h = window_hashes(found.hash, window)
                second = (window_hashes(mix(found.hash ^ _SECOND), window)
                          >> np.uint64(32)).astype(np.uint32)
                doc = found.doc[:len(h)]
                ok = np.flatnonzero(doc == found.doc[window - 1:][:len(h)]) if len(h) else []
                if not len(ok):
                    continue
                base = np.searchsorted(found.doc, np.arange(piece.hi - piece.lo))
                place = (ok - base[doc[ok]]).astype(np.int64)
                ids = key[piece.lo:piece.hi], mark[piece.lo:piece.hi]
                for lo in range(0, len(ok), chunk):
                    part = slice(lo, lo + chunk)
                    held.append((h[ok[part]], second[ok[part]], doc[ok[part]], place[part], *ids))
                    size += len(held[-1][0])
                    if size >= chunk:
                        yield flush()
                        held, size, number = [], 0, number + 1
        if held:
            yield flush()

    return run


def _by_text(key: np.ndarray, mark: np.ndarray, place: np.ndarray) -> Iterator[tuple]:
    order = np.lexsort((place, mark, key))
    key, mark, place = key[order], mark[order], place[order]
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (mark[1:] != mark[:-1])))
    cut = np.flatnonzero(new)
    for lo, hi in zip(cut, np.append(cut[1:], len(key)), strict=True):
        yield int(key[lo]), int(mark[lo]), place[lo:hi].astype(np.uint32).tobytes()


def _repeats(table: pa.Table) -> pa.Table:
    """Places of a bucket's windows other than the first of each hash."""
    keys, marks, places, hashes, done = [], [], [], [], []
    for row in table.to_batches(max_chunksize=64):
        for x in row.to_pylist():
            counts = np.frombuffer(x["counts"], dtype=np.int32)
            delta = _unpack(x["places"], x["n"]).astype(np.int64)
            total = np.cumsum(delta)
            begin = np.cumsum(counts) - counts
            place = total - np.repeat(total[begin] - delta[begin], counts)
            key = np.repeat(np.frombuffer(x["keys"], dtype=np.int64), counts)
            mark = np.repeat(np.frombuffer(x["marks"], dtype=np.int64), counts)
            if x["local"]:
                done.append((key, mark, place))
            else:
                keys.append(key)
                marks.append(mark)
                places.append(place.astype(np.uint32))
                hashes.append(np.frombuffer(x["hashes"], dtype=np.uint64))
    if hashes:
        h = np.concatenate(hashes)
        del hashes
        order = np.argsort(h)
        h = h[order]
        same = h[1:] == h[:-1]
        often = np.concatenate((same, [False])) | np.concatenate(([False], same))
        at, h = order[often], h[often]
        key, mark, place = (np.concatenate(x)[at] for x in (keys, marks, places))
        order = np.lexsort((place, key, h))
        key, mark, place, h = key[order], mark[order], place[order].astype(np.int64), h[order]
        new = np.concatenate(([True], h[1:] != h[:-1])) if len(h) else np.zeros(0, bool)
        leader = np.repeat(np.flatnonzero(new), np.diff(np.append(np.flatnonzero(new), len(h))))
        later = (key != key[leader]) | (place != place[leader])
        done.append((key[later], mark[later], place[later]))
    key, mark, place = (np.concatenate(x) for x in zip(*done, strict=True))
    rows = list(_by_text(key, mark, place)) if len(key) else []
    k, m, s = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table({"key": pa.array(k, pa.int64()), "mark": pa.array(m, pa.int64()),
                     "starts": pa.array(s, pa.binary())})


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column("text"), batch.column("starts")
            out: dict[str, list] = {"n_words": [], "n_removed": [], "kept": [], "intervals": []}
            for i in range(len(texts)):
                own = (texts[i].as_py() or "").encode().split()
                covered = np.zeros(len(own) + window + 1, dtype=np.int32)
                for starts in found[i].as_py() or ():
                    at = np.frombuffer(starts, dtype=np.uint32)
                    covered[at] += 1
                    covered[at + window] -= 1
                gone = np.cumsum(covered)[:len(own)] > 0
                lo, hi = spans(gone)
                out["n_words"].append(len(own))
                out["n_removed"].append(int(gone.sum()))
                out["intervals"].append([{"start": a, "end": b} for a, b in
                                         zip(lo.tolist(), hi.tolist(), strict=True)])
                if len(lo):
                    own = [w for w, g in zip(own, gone.tolist(), strict=True) if not g]
                out["kept"].append(b" ".join(own).decode())
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            rest = [n for n in batch.schema.names if n not in ("text", "starts")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in rest], pa.array(out["n_words"], pa.int64()),
                 pa.array(out["n_removed"], pa.int64()), pa.array(out["kept"], pa.string()),
                 pa.array(out["intervals"], span)],
                names=[*rest, "n_words", "n_removed", "kept", "intervals"])

    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW) -> DataFrame:
    """Words left of every text after cutting windows that also start earlier.

    A word goes if it lies in a window of ``window`` consecutive words whose
    word sequence also starts earlier: in a row with a smaller id, or earlier
    in the same row. Windows are judged on the input. Words are runs of other
    bytes than ASCII white space, compared as they are.

    Returns id_col, n_words, n_removed, kept (words left, joined by a space)
    and intervals (maximal removed ranges of word numbers, end exclusive); one
    row for each input row. Other columns of ``docs`` are not read.

    * NULL or empty text: no words; kept is empty.
    * NULL id: comes after all other ids.
    * Rows that share an id: places with the same id and start are neither
      earlier nor later, so repeated rows keep what one of them would.
    * Empty table: no rows.
    """
    base = keyed(docs, id_col, text_col)
    chars = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(MIN_BUCKETS, -(-chars // BUCKET_CHARS))
    entries = base.select("key", "mark", "text").mapInArrow(_emit(buckets, window), _ENTRY)
    repeats = entries.groupBy("bucket").applyInArrow(_repeats, _REPEAT)
    by_text = repeats.groupBy("key", "mark").agg(F.collect_list("starts").alias("starts"))
    joined = base.join(by_text, ["key", "mark"], "left").select("id", "text", "starts")
    id_type = docs.schema[id_col].dataType.simpleString()
    out = joined.mapInArrow(
        _cut(window), f"id {id_type}, n_words long, n_removed long, kept string, "
                      "intervals array<struct<start:long,end:long>>")
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", "kept", "intervals")


def digest(kept: str) -> str:
    """Lowercase hex SHA-256 of kept words, as the query reports it."""
    return hashlib.sha256(kept.encode()).hexdigest()
