"""MinHash near-dedup by a multi-index Hamming join of b-bit signatures.

A text's signature has ``SYMBOLS`` min-hashes of its shingles, ``BITS`` low
bits of each. Two signatures' distance is the number of places at which they
differ: for texts of Jaccard similarity s it is about ``SYMBOLS * (1 - s)``.

1. Rows of equal shingle sets (128-bit hash of the set) form a class; only
   classes are compared. A third of all rows in one class is one class.
2. Signatures are split into ``CHUNKS`` chunks. If two differ at no more than
   ``DISTANCE = CHUNKS * (ERRORS + 1) - 1`` places, some chunk has at most
   ``ERRORS`` (one) differing place. All ways to have it are enumerated: a key
   for each place of each chunk, made of the chunk's other places. So all
   pairs within ``DISTANCE`` share a key; a pair of similarity 0.85 is beyond
   it with a chance of 4e-7 (binomial tail), a more similar one more rarely.
3. Classes that share a key are not paired with one another at once: each
   meets the hub of its key, the smallest class that a task's part holds, and
   those the hub of the whole. Of a class's hubs the smallest and the one met
   in most keys are tried; what lies within ``DISTANCE`` is confirmed on the
   full shingle sets, and the links' components are found.
4. Keys that still join classes of different components are searched in
   blocks, signature against signature: for ``ROUNDS`` rounds each component
   tries its closest pair with another one, then every pair not yet tried is,
   at the first key that the two share. So no pair within ``DISTANCE`` is lost:
   it is confirmed, refused on the full sets, or already connected.

The last search, of every pair, also asks that a longer signature of ``MORE``
further min-hashes of eight bits agrees: ``FAR`` differing places in all at
most, beyond which, too, a pair of similarity 0.85 lies with a chance of 1e-7.
A key without a near pair of different components never gets one, so each round
searches only the keys in which the round before found some.

A key's members reach its bucket once for each part of ``PART_CLASSES``
classes, and a large key's search is dealt over pairs of blocks, so no task
holds all of it. Step 4's last search is quadratic in the members of a key that
stay unconnected though their signatures share the key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmart.session import materialize

from .components import connected_components
from .keyed import NO_ID, keyed
from .words import BASE, WHITE_SPACE, Lexer, Piece, mix, pieces, window_hashes, words

SHINGLE = 5
#: Similarity threshold in whole numbers.
UP, DOWN = 85, 100
SYMBOLS, BITS, CHUNKS, ERRORS = 128, 16, 21, 1
DISTANCE = CHUNKS * (ERRORS + 1) - 1
MORE, FAR = 384, 119
#: Rounds in which each component tries its closest pair.
ROUNDS = 2
#: Sets below this size are similar to their equals only.
LEAST_SET = DOWN // (DOWN - UP)
#: Classes of which a task makes one part; bytes of keys that a bucket holds on average.
PART_CLASSES, BUCKET_BYTES, MIN_BUCKETS = 8192, 16 << 20, 64
#: Members of a block, and bytes of signatures in a group, of the search by blocks.
BLOCK, GROUP_BYTES = 2048, 24 << 20
LEXER = Lexer.separated_by(WHITE_SPACE, lower=True)

_RANDOM = np.random.default_rng(12)
_SALT = _RANDOM.integers(0, 1 << 32, SYMBOLS + MORE, dtype=np.uint32)
_FACTOR = _RANDOM.integers(0, 1 << 31, SYMBOLS + MORE, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_WEIGHT = _RANDOM.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_EDGES = np.linspace(0, SYMBOLS, CHUNKS + 1).astype(int)


def shingle_sets(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text of a piece, as sorted 64-bit hashes in one array,
    and where each text's begin. A text of fewer words has its whole sequence."""
    found = words(piece, LEXER)
    n_texts = piece.hi - piece.lo
    base = np.searchsorted(found.doc, np.arange(n_texts + 1))
    n_words = np.diff(base)
    h = window_hashes(found.hash, SHINGLE)
    doc = found.doc[:len(h)]
    h = h[doc == found.doc[SHINGLE - 1:]] if len(h) else h
    count = np.where(n_words >= SHINGLE, n_words - SHINGLE + 1, n_words > 0)
    begin = np.concatenate(([0], np.cumsum(count)))
    out = np.empty(int(begin[-1]), dtype=np.uint64)
    short = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    whole = np.ones(len(out), dtype=bool)
    whole[begin[short]] = False
    out[whole] = h
    for d in short.tolist():
        own = found.hash[base[d]:base[d + 1]]
        out[begin[d]] = window_hashes(own, len(own))[0] ^ np.uint64(len(own))
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        if b - a > 1:
            out[a:b].sort()
    new = np.ones(len(out), dtype=bool)
    new[1:] = out[1:] != out[:-1]
    new[begin[:-1][count > 0]] = True
    return out[new], np.concatenate(([0], np.cumsum(new)))[begin]


def signatures(sets: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Low bits of the min-hashes of non-empty sets that begin at ``begin``: ``BITS`` of
    the first ``SYMBOLS``, eight of the others."""
    x = (sets >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(begin), SYMBOLS), dtype=np.uint16)
    more = np.empty((len(begin), MORE), dtype=np.uint8)
    for k in range(SYMBOLS + MORE):
        least = np.minimum.reduceat((x ^ _SALT[k]) * _FACTOR[k], begin)
        if k < SYMBOLS:
            out[:, k] = least & np.uint32(0xFFFF)
        else:
            more[:, k - SYMBOLS] = least & np.uint32(0xFF)
    return out, more


def _binary(rows: np.ndarray, present: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values; empty where ``present`` is False."""
    size = np.where(present, rows.shape[1] * rows.itemsize, 0)
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(present), [
        None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(rows.tobytes())])


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch.column("text")):
            sets, begin = shingle_sets(piece)
            size = np.diff(begin)
            some = size > 0
            head = begin[:-1][some]
            c1, c2 = np.zeros((2, len(size)), dtype=np.uint64)
            # texts without a shingle are joined with nothing; their rows are spread
            keys = np.asarray(batch.column("key"), dtype=np.int64)[piece.lo:piece.hi]
            c1[~some] = mix(keys[~some].view(np.uint64) + BASE)
            signed = size >= LEAST_SET
            rows, more = np.zeros((0, SYMBOLS), np.uint16), np.zeros((0, MORE), np.uint8)
            if len(head):
                c1[some] = np.add.reduceat(mix(sets + BASE), head)
                c2[some] = np.add.reduceat(mix(sets * BASE), head)
                rows, more = (x[signed[some]] for x in signatures(sets, head))
            own = batch.slice(piece.lo, piece.hi - piece.lo)
            yield pa.RecordBatch.from_arrays(
                [*[own.column(c) for c in ("id", "key", "mark")], pa.array(size, pa.int64()),
                 pa.array(c1.view(np.int64)), pa.array(c2.view(np.int64)),
                 _binary(rows, signed), _binary(more, signed)],
                names=["id", "key", "mark", "n", "c1", "c2", "signature", "more"])


def keys_of(rows: np.ndarray) -> np.ndarray:
    """All keys of signatures: for every place of a chunk, a hash of the chunk's other places."""
    part = (rows.astype(np.uint64) + np.uint64(1)) * _WEIGHT
    out = np.empty_like(part)
    for lo, hi in zip(_EDGES[:-1], _EDGES[1:], strict=True):
        out[:, lo:hi] = part[:, lo:hi].sum(axis=1, dtype=np.uint64)[:, None] - part[:, lo:hi]
    return mix(out + np.arange(1, SYMBOLS + 1, dtype=np.uint64) * BASE)


def _matrix(column: pa.Array, dtype=np.uint16, width: int = SYMBOLS) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(-1, width)


_ENTRY = pa.schema([("bucket", pa.int32()), ("local", pa.bool_()), ("keys", pa.binary()),
                    ("nodes", pa.binary()), ("hubs", pa.binary())])
_SHARED = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("hub", pa.int64())])


def _by_key(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Entries by key and node, whether each is its key's first, and its key's first node."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    return keys, nodes, new, np.repeat(nodes[at], np.diff(np.append(at, len(keys))))


def _dealt(values: np.ndarray, buckets: int) -> np.ndarray:
    return ((values >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _packed(bucket: np.ndarray, local: bool, *columns: np.ndarray) -> Iterator[tuple]:
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    for lo, hi in zip(cut, np.append(cut[1:], len(bucket)), strict=True):
        own = [c[order[lo:hi]].tobytes() for c in columns]
        yield (int(bucket[lo]), local, *own, *([b""] if len(own) == 2 else []))


def _part_rows(rows: np.ndarray, nodes: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Each key once, to the key's bucket; its other members with the part's hub, anywhere."""
    keys, nodes, new, hub = _by_key(keys_of(rows).ravel(), np.repeat(nodes, SYMBOLS))
    yield from _packed(_dealt(keys[new], buckets), False, keys[new], nodes[new])
    rest = ~new & (nodes != hub)
    if rest.any():
        spread = _dealt(mix(nodes[rest].view(np.uint64) + BASE), buckets)
        yield from _packed(spread, True, keys[rest], nodes[rest], hub[rest])


def _emit(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[tuple]) -> pa.RecordBatch:
            rows, nodes = (np.concatenate(x) for x in zip(*held, strict=True))
            found = list(zip(*_part_rows(rows, nodes, buckets), strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(found, _ENTRY, strict=True)], schema=_ENTRY)

        held, size = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, PART_CLASSES):
                part = batch.slice(lo, PART_CLASSES)
                held.append((_matrix(part.column("signature")),
                             np.asarray(part.column("node"), dtype=np.int64)))
                size += part.num_rows
                if size >= PART_CLASSES:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return run


def _shared(table: pa.Table) -> pa.Table:
    """(key, node, hub) of a bucket's keys that more than one part or class has."""
    def column(name: str, rows: pa.Table, dtype) -> np.ndarray:
        return np.frombuffer(b"".join(rows.column(name).to_pylist()), dtype=dtype)

    local = np.asarray(table.column("local"))
    own = table.filter(pa.array(local))
    out = [(column("keys", own, np.uint64), column("nodes", own, np.int64),
            column("hubs", own, np.int64))]
    rest = table.filter(pa.array(~local))
    keys, nodes = column("keys", rest, np.uint64), column("nodes", rest, np.int64)
    if len(keys):
        keys, nodes, new, hub = _by_key(keys, nodes)
        later = ~new & (nodes != hub)
        out.append((keys[later], nodes[later], hub[later]))
    keys, nodes, hubs = (np.concatenate(x) for x in zip(*out, strict=True))
    return pa.table([keys.view(np.int64), nodes, hubs], schema=_SHARED)


def _near(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows of two signature tables are near, and of these equal places and distance."""
    same = a == b
    far = SYMBOLS - same.sum(axis=1)
    near = np.flatnonzero(far <= DISTANCE)
    return near, same[near], far[near]


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures are near."""
    for batch in batches:
        for lo in range(0, batch.num_rows, PART_CLASSES):
            part = batch.slice(lo, PART_CLASSES)
            near = _near(_matrix(part.column("sa")), _matrix(part.column("sb")))[0]
            yield part.select(["a", "b"]).take(pa.array(near))


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full shingle sets are similar."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            part = batch.slice(lo, 64)
            n = part.num_rows
            own: list[np.ndarray] = []
            for name in ("ta", "tb"):
                for piece in pieces(part.column(name)):
                    sets, begin = shingle_sets(piece)
                    own += [sets[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True)]
            ok = []
            for i in range(n):
                both = len(np.intersect1d(own[i], own[n + i], assume_unique=True))
                either = len(own[i]) + len(own[n + i]) - both
                ok.append(both > 0 and DOWN * both >= UP * either)
            yield part.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def first_shared_key(same: np.ndarray) -> np.ndarray:
    """Number of the first key that pairs share, by the places at which they are equal."""
    wrong = ~same
    errors = np.stack([wrong[:, lo:hi].sum(axis=1) for lo, hi in zip(
        _EDGES[:-1], _EDGES[1:], strict=True)], axis=1)
    chunk = (errors <= ERRORS).argmax(axis=1)
    lo = _EDGES[chunk]
    # the differing place, or the chunk's first if there is none
    inside = (np.arange(SYMBOLS) >= lo[:, None]) & (np.arange(SYMBOLS) < _EDGES[chunk + 1][:, None])
    one = wrong & inside
    return np.where(one.any(axis=1), one.argmax(axis=1), lo)


_FOUND = pa.schema([("root", pa.int64()), ("far", pa.int32()), ("a", pa.int64()),
                    ("b", pa.int64()), ("key", pa.int64())])


def _search(closest: bool):
    """Near pairs (by root and distance) of different components of a group's keys.

    With ``closest`` each component's closest pair; else every pair, given by
    the first key that it shares.
    """
    def pairs(rows, more, node, root, size, left, right, key) -> list[np.ndarray]:
        place = (keys_of(rows[left[:1]])[0].view(np.int64) == key).argmax() if len(left) else 0
        a, b, far = [], [], []
        for i in left.tolist():
            to = right[right > i] if left is right else right
            n = size[to]
            to = to[(root[to] != root[i])
                    & (DOWN * np.minimum(n, size[i]) >= UP * np.maximum(n, size[i]))]
            if not len(to):
                continue
            near, same, d = _near(rows[i:i + 1], rows[to])
            if len(near) and not closest:
                d = d + (more[to[near]] != more[i]).sum(axis=1)
                own = (d <= FAR) & (first_shared_key(same) == place)
                near, d = near[own], d[own]
            a.append(np.full(len(near), i))
            b.append(to[near])
            far.append(d)
        if not a:
            return [np.zeros(0, dtype=np.int64)] * 5
        a, b, far = (np.concatenate(x) for x in (a, b, far))
        a, b = np.where(node[a] < node[b], a, b), np.where(node[a] < node[b], b, a)
        if not closest:
            return [root[a], far, node[a], node[b], np.full(len(a), key)]
        own = np.concatenate((root[a], root[b]))
        a, b, far = np.tile(node[a], 2), np.tile(node[b], 2), np.tile(far, 2)
        order = np.lexsort((b, a, far, own))
        order = order[np.diff(own[order], prepend=-1) != 0]
        return [own[order], far[order], a[order], b[order], np.full(len(order), key)]

    def run(table: pa.Table) -> pa.Table:
        key, i, j, block, node, root, size = (
            np.asarray(table.column(c).combine_chunks())
            for c in ("key", "i", "j", "block", "node", "root", "n"))
        rows = _matrix(table.column("signature"))
        more = None if closest else _matrix(table.column("more"), np.uint8, MORE)
        order = np.lexsort((node, j, i, key))
        new = np.ones(len(order), dtype=bool)
        new[1:] = np.logical_or.reduce([x[order[1:]] != x[order[:-1]] for x in (key, i, j)])
        cut = np.flatnonzero(new)
        out = []
        for lo, hi in zip(cut, np.append(cut[1:], len(order)), strict=True):
            own = order[lo:hi]
            one = i[own[0]] == j[own[0]]
            left = np.sort(own if one else own[block[own] == i[own[0]]])
            right = left if one else np.sort(own[block[own] != i[own[0]]])
            out.append(pairs(rows, more, node, root, size, left, right, key[own[0]]))
        found = [np.concatenate(x) for x in zip(*out, strict=True)]
        return pa.table([pa.array(c, f.type) for c, f in zip(found, _FOUND, strict=True)],
                        schema=_FOUND)

    return run


class _Join:
    """The tables of one run, and the steps on them."""

    def __init__(self, base: DataFrame, classes: DataFrame):
        self.base, self.classes = base, classes
        self.spark = base.sparkSession

    def shared_keys(self) -> DataFrame:
        """(key, node, hub) for every member of a shared key but the hub."""
        signed = self.classes.filter(F.col("n") >= LEAST_SET)
        buckets = max(MIN_BUCKETS, -(-signed.count() * SYMBOLS * 16 // BUCKET_BYTES))
        entries = signed.select("node", "signature").mapInArrow(
            _emit(buckets), "bucket int, local boolean, keys binary, nodes binary, hubs binary")
        return materialize(entries.groupBy("bucket").applyInArrow(
            _shared, "key long, node long, hub long"), "minhash")

    @staticmethod
    def hub_pairs(shared: DataFrame) -> DataFrame:
        """(a, b): each class with the smallest of its hubs and the one met most often."""
        met = shared.repartition("node").groupBy("node", "hub").agg(F.count("*").alias("n"))
        best = met.groupBy("node").agg(F.min("hub").alias("low"),
                                       F.max(F.struct("n", "hub"))["hub"].alias("near"))
        return best.select(F.col("node").alias("a"), F.explode(F.array_distinct(
            F.array("low", "near"))).alias("b"))

    def close(self, pairs: DataFrame) -> DataFrame:
        """Near pairs whose sizes allow the similarity."""
        own = self.classes.select("node", "n", "signature")
        both = pairs.join(own.toDF("a", "na", "sa"), "a").join(own.toDF("b", "nb", "sb"), "b")
        alike = both.filter(DOWN * F.least("na", "nb") >= UP * F.greatest("na", "nb"))
        return materialize(alike.select("a", "b", "sa", "sb").mapInArrow(
            _close, "a long, b long"), "minhash")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Pairs (materialised) that are similar on the full sets of their texts."""
        wanted = pairs.select(F.col("a").alias("node")).unionByName(
            pairs.select(F.col("b").alias("node"))).distinct()
        first = self.classes.select("node", "key", "mark").join(wanted, "node")
        texts = materialize(self.base.select("key", "mark", "text").join(
            first, ["key", "mark"]).select("node", "text"), "minhash")
        both = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")
        return materialize(both.select("a", "b", "ta", "tb").mapInArrow(
            _similar, "a long, b long").distinct(), "minhash")

    def open_members(self, members: DataFrame, links: DataFrame) -> DataFrame:
        """Members, with component, of the keys that have several components, in blocks."""
        roots = connected_components(links.toDF("u", "v"))
        now = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        keys = now.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"),
                                      F.count("*").alias("size")).filter("low < high")
        blocks = F.ceil(F.col("size") / BLOCK).cast("int")
        return materialize(now.join(keys.select("key", blocks.alias("blocks")), "key"), "minhash")

    def search(self, members: DataFrame, closest: bool) -> DataFrame:
        """(root, far, a, b, key): near pairs of different components, all or each component's
        closest in each key."""
        rows = members.agg(F.sum("blocks")).first()[0] or 0
        groups = max(MIN_BUCKETS, -(-rows * (SYMBOLS * BITS // 8 + MORE) // GROUP_BYTES))
        dealt = members.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.select("key", "node", "root", "block", F.least("block", "other").alias("i"),
                             F.greatest("block", "other").alias("j"))
        own = self.classes.select("node", "n", "signature", *([] if closest else ["more"]))
        return materialize(dealt.join(own, "node").withColumn(
            "group", F.pmod(F.xxhash64("key", "i", "j"), F.lit(groups))).groupBy(
            "group").applyInArrow(
                _search(closest), "root long, far int, a long, b long, key long"), "minhash")

    def links(self) -> DataFrame:
        """Confirmed pairs of classes that connect all that is linked."""
        shared = self.shared_keys()
        tried = self.close(self.hub_pairs(shared))
        found = self.confirmed(tried)
        members = materialize(shared.select("key", "node").unionByName(
            shared.select("key", F.col("hub").alias("node"))).distinct(), "minhash")
        still_open = self.open_members(members, found)
        for number in range(ROUNDS + 1):
            closest = number < ROUNDS
            near = self.search(still_open, closest)
            pairs = near.groupBy("root").agg(F.min(F.struct("far", "a", "b")).alias("least")).select(
                "least.a", "least.b") if closest else near.select("a", "b")
            pairs = materialize(pairs.distinct().join(
                tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b"))),
                ["a", "b"], "left_anti"), "minhash")
            found, tried = found.unionByName(self.confirmed(pairs)), tried.unionByName(pairs)
            if closest:
                live = still_open.select("key", "node").join(
                    near.select("key").distinct(), "key", "left_semi")
                still_open = self.open_members(live, found)
        return found


def minhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Near-duplicate component of every text: Jaccard of 5-word shingle sets 0.85 or more.

    A-Z are lower-cased; words are runs of other characters than ASCII white
    space; a text of fewer than five words has its whole word sequence as its
    one shingle. Sets are compared as sets of 64-bit shingle hashes.

    Returns id_col, n_shingles (size of the set), component (the smallest id
    reachable by links, the row's own included) and kept (whether that is the
    row's own); one row for each input row. Other columns of ``docs`` are not
    read; ids are compared as whole numbers.

    * NULL or empty text, or one without words: an empty set, linked with nothing.
    * NULL id: comes after all other ids; component is NULL, and the row is
      kept, if nothing with an id is reachable.
    * Rows that share an id: linked by their own texts; repeated rows are
      one text, so either all or none of them are kept.
    * Empty table: no rows. Ties (similarity 0.85 exactly) are links.
    """
    base = keyed(docs, id_col, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = materialize(base.mapInArrow(
        _describe, f"id {id_type}, key long, mark long, n long, c1 long, c2 long, "
                   "signature binary, more binary"), "minhash")
    classes = materialize(rows.filter("n > 0").groupBy("c1", "c2").agg(
        F.min(F.struct("key", "mark")).alias("first"), F.count("*").alias("n_rows"),
        F.first("n").alias("n"), F.first("signature").alias("signature"),
        F.first("more").alias("more")).select(
        F.monotonically_increasing_id().alias("node"), "c1", "c2", "first.*", "n_rows", "n",
        "signature", "more"), "minhash")
    roots = connected_components(_Join(base, classes).links().toDF("u", "v"))
    heads = classes.select("node", "c1", "c2", "key", "n_rows").join(roots, "node", "left")
    linked = heads.filter(F.col("root").isNotNull())
    lowest = linked.groupBy("root").agg(F.min("key").alias("component"))
    known = linked.join(lowest, "root").select("c1", "c2", "component").unionByName(
        heads.filter(F.col("root").isNull() & (F.col("n_rows") > 1)).select(
            "c1", "c2", F.col("key").alias("component")))
    own = rows.select("id", "key", "n", "c1", "c2").alias("r").join(
        materialize(known, "minhash").alias("h"),
        (F.col("r.c1") == F.col("h.c1")) & (F.col("r.c2") == F.col("h.c2"))
        & (F.col("r.n") > 0), "left")
    component = F.coalesce("component", "key")
    return own.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(component != NO_ID, component).alias("component"),
                      (component == F.col("key")).alias("kept"))
