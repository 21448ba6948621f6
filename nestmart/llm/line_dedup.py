"""Line dedup as an exact set-similarity join.

Lines with the same set of words (by a 128-bit hash of the set) form a class,
known by its first line. Each class's words are ordered by rarity; its prefix,
long enough that two classes above the threshold must share a word in it, is
joined with the other classes' prefixes. Length, positional and parity filters
are conditions of that join; what passes is verified on the words themselves.

One earlier match settles a line, so most lines of a large group of near copies
need no look at the rest of the group: each class is first compared with its
hubs, the first classes that share one of its runs of ``RUN`` words next to each
other in the order of rarity, begun at ``ANCHORS`` fixed places of that order.
Only classes which that leaves open look for partners in the prefix join, among
all classes.

Rarity is the rank of the word's bucket (``RARITY_BUCKETS`` buckets of word
hashes) by the words counted in it over all lines, ties by hash: any total
order of the words gives the exact result, a truer one fewer candidates.

All of it is DataFrame operations: array functions describe the lines, the rest
is joins and groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestmart.session import discard, materialize

from .keyed import keyed
from .words import WHITE_SPACE, Lexer, mix, pieces, words

RARITY_BUCKETS = 1 << 16
#: Threshold 4/5 in whole numbers.
UP, DOWN = 4, 5
#: Candidate lines that are sent to all tasks to find their words; more are joined by a shuffle.
BROADCAST_LINES = 500_000
#: Words of a run that names a hub; places where runs begin, equal shares of all words apart.
RUN, ANCHORS = 4, 5
#: So many hubs more has a run that more classes share.
SPREAD = 16
#: Min-hashes of a class in the description by Arrow tasks.
HUBS = 3
LEXER = Lexer.separated_by(WHITE_SPACE)
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WHITE_SPACE = r"[\x20\x09-\x0D]+"
_SALT = np.uint64(0xA0761D6478BD642F)
_HUB_SALTS = [np.uint64(int(_SALT) * (i + 2) % (1 << 64)) for i in range(HUBS)]
#: A line's place: rows that share a key are told apart by mark, which doesn't order them.
_PLACE = ["key", "line_no", "mark"]
_LINE = ("key long, mark long, line_no int, c1 long, c2 long, size int, p1 long, p2 long, "
         "prefix array<long>, hubs array<long>")


def _stored(df: DataFrame) -> DataFrame:
    """A scratch copy; shuffle files of its making go with it, not at the driver's next collection."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEAN_UP, "false")
    conf.set(_CLEAN_UP, "true")
    try:
        return materialize(df, "line-dedup")
    finally:
        conf.set(_CLEAN_UP, before)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(RARITY_BUCKETS - 1)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(RARITY_BUCKETS, dtype=np.int64)
    for batch in batches:
        for piece in pieces(batch.column("text")):
            total += np.bincount(_bucket(words(piece, LEXER).hash), minlength=RARITY_BUCKETS)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])],
                                     names=["bucket", "n"])


def rarity_ranks(texts: DataFrame) -> np.ndarray:
    """Rank of every bucket of word hashes, rarest first, by the words of all texts."""
    rows = texts.mapInArrow(_count, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).collect()
    n = np.zeros(RARITY_BUCKETS, dtype=np.int64)
    for r in rows:
        n[r.bucket] = r.n
    rank = np.empty(RARITY_BUCKETS, dtype=np.uint64)
    rank[np.argsort(n, kind="stable")] = np.arange(RARITY_BUCKETS, dtype=np.uint64)
    return rank


def _parts(text: Column, blanked: Column | None = None) -> Column:
    """The words of a text, and perhaps empty strings; a plain split, of ``blanked`` if given,
    unless other white space than blanks and line feeds is there."""
    others = reduce(or_, (F.contains(text, F.lit(c)) for c in "\t\x0b\x0c\r"))
    return F.when(others, F.split(text, _WHITE_SPACE, -1)).otherwise(
        F.split(text if blanked is None else blanked, " ", -1))


def _bucket_of(word: Column) -> Column:
    return F.hash(word).bitwiseAND(RARITY_BUCKETS - 1)


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Words of all texts by the bucket of their hash."""
    blanked = F.replace("text", F.lit("\n"), F.lit(" "))
    rows = texts.select(F.explode(_parts(F.col("text"), blanked)).alias("word")).groupBy(_bucket_of(F.col("word")).alias("bucket")).agg(
        F.count("*").alias("n")).collect()
    n = np.zeros(RARITY_BUCKETS, dtype=np.int64)
    for r in rows:
        n[r.bucket] = r.n
    return n


def describe(rows: DataFrame, counts: np.ndarray) -> DataFrame:
    """Every line with a word: place, class, size, parity of its words in 128 bits, prefix, hubs.

    A word is known by 63 bits: its bucket's rank by ``counts``, which stands for
    the 16 bits of one hash, a one, and 47 of another. Marks (a rank, and
    zeros) are sorted in among the words of every line: runs begin behind them,
    and the middle one parts the two parities. ``hubs`` has NULL where no run is.
    """
    rest = 65 - RARITY_BUCKETS.bit_length()
    by_rarity = np.argsort(counts, kind="stable")
    top = np.empty(RARITY_BUCKETS, dtype=np.int64)
    top[by_rarity] = np.arange(-RARITY_BUCKETS // 2, RARITY_BUCKETS // 2) << rest
    upto = np.cumsum(counts[by_rarity])
    shares = np.searchsorted(upto, np.arange(ANCHORS) * upto[-1] // ANCHORS, side="right")
    marks = sorted({int(top[by_rarity[min(k, RARITY_BUCKETS - 1)]]) for k in shares})
    ranks = F.split(F.lit(",".join(map(str, (top + (1 << rest - 1)).tolist()))), ",").cast(
        "array<bigint>")
    mark_array = F.array(*(F.lit(m).cast("long") for m in marks))

    def known(w: Column) -> Column:
        # never NULL; arrays that can't hold one sort as plain longs
        return F.coalesce(ranks[_bucket_of(w)], F.lit(0).cast("long")).bitwiseOR(
            F.shiftrightunsigned(F.xxhash64(w), 65 - rest))

    def parity(words: Column) -> Column:
        return F.aggregate(words, F.lit(0).cast("long"), lambda x, w: x.bitwiseXOR(F.call_function(
            "shiftleft", F.lit(1).cast("long"), w.bitwiseAND(63).cast("int"))))

    def run(k: int) -> Column:
        words = F.slice("words", F.col(f"at{k}") + 1, F.lit(RUN))
        return F.when(F.col(f"at{k}") + RUN <= F.size("words"), F.xxhash64(F.lit(k), words))

    lines = rows.select("key", "mark", F.posexplode(F.split("text", "\n", -1)).alias(
        "line_no", "line")).filter(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    words = lines.select(*_PLACE, F.sort_array(F.concat(F.array_except(
        F.transform(_parts(F.col("line")), known), F.array(known(F.lit("")))), mark_array)).alias(
        "words"))
    words = words.select("*", *(F.array_position("words", F.lit(m).cast("long")).cast("int").alias(
        f"at{k}") for k, m in enumerate(marks)))
    size, half = F.size("words") - len(marks), F.col(f"at{len(marks) // 2}")
    length = size - F.ceil(UP * size / DOWN).cast("int") + 1
    return words.select(
        *_PLACE, F.xxhash64("words").alias("c1"), F.xxhash64(F.lit(1), "words").alias("c2"),
        size.alias("size"), parity(F.slice("words", F.lit(1), half)).alias("p1"),
        parity(F.slice("words", half + 1, F.size("words"))).alias("p2"),
        F.slice(F.array_except(F.slice("words", F.lit(1), length + len(marks)), mark_array),
                F.lit(1), length).alias("prefix"),
        F.array(*(run(k) for k in range(len(marks)))).alias("hubs"))


def _describe(rank: np.ndarray):
    """The description by Arrow tasks, with its own hashes; the query no longer runs it."""
    rest = np.uint64(RARITY_BUCKETS.bit_length() - 1)
    up = np.uint64(64) - rest - np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.asarray(batch.column("key"))
            mark = np.asarray(batch.column("mark"))
            for piece in pieces(batch.column("text")):
                found = words(piece, LEXER)
                if not len(found.hash):
                    continue
                feeds = np.concatenate(([0], np.cumsum(piece.data == 10)))
                line = feeds[found.start] + found.doc
                # 16 bits of rank stand for the bucket's 16 bits, then the others but one
                order = (rank[_bucket(found.hash)] << up) | (found.hash >> rest >> np.uint64(1))
                at = np.lexsort((order, line))
                line, order, h = line[at], order[at], found.hash[at]
                new = np.concatenate(([True], (line[1:] != line[:-1]) | (order[1:] != order[:-1])))
                line, order, h, doc = line[new], order[new], h[new], found.doc[at][new]
                begin = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
                size = np.diff(np.append(begin, len(line)))
                bit = np.uint64(1) << (mix(h ^ _SALT) & np.uint64(63))
                half = (h >> np.uint64(40) & np.uint64(1)).astype(bool)
                p1 = np.bitwise_xor.reduceat(np.where(half, bit, np.uint64(0)), begin)
                p2 = np.bitwise_xor.reduceat(np.where(half, np.uint64(0), bit), begin)
                c1 = np.add.reduceat(mix(h + _SALT), begin)
                c2 = np.add.reduceat(mix(h * _SALT), begin)
                hubs = np.stack([np.minimum.reduceat(mix(h ^ salt), begin)
                                 for salt in _HUB_SALTS], axis=1)
                length = size - (UP * size + DOWN - 1) // DOWN + 1
                upto = np.cumsum(length)
                take = np.arange(int(upto[-1])) + np.repeat(begin - (upto - length), length)
                doc = doc[begin]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[piece.lo + doc]), pa.array(mark[piece.lo + doc]),
                     pa.array((line[begin] - doc - feeds[piece.offsets[doc]]).astype(np.int32)),
                     pa.array(c1.view(np.int64)), pa.array(c2.view(np.int64)),
                     pa.array(size.astype(np.int32)), pa.array(p1.view(np.int64)),
                     pa.array(p2.view(np.int64)),
                     pa.ListArray.from_arrays(
                         pa.array(np.concatenate(([0], upto)).astype(np.int32)),
                         pa.array(order[take].view(np.int64))),
                     pa.ListArray.from_arrays(
                         pa.array(np.arange(0, HUBS * len(begin) + 1, HUBS, dtype=np.int32)),
                         pa.array(hubs.reshape(-1).view(np.int64)))],
                    names=["key", "mark", "line_no", "c1", "c2", "size", "p1", "p2", "prefix",
                           "hubs"])

    return run


def _earlier(b: str = "b", a: str = "a") -> Column:
    return ((F.col(f"{b}.key") < F.col(f"{a}.key")) | (
        (F.col(f"{b}.key") == F.col(f"{a}.key"))
        & (F.col(f"{b}.line_no") < F.col(f"{a}.line_no"))))


def _alike_in_size() -> Column:
    return DOWN * F.least("a.size", "b.size") >= UP * F.greatest("a.size", "b.size")


def _odd(*parities: str) -> Column:
    return sum((F.bit_count(F.col(f"a.{p}").bitwiseXOR(F.col(f"b.{p}"))) for p in parities),
               F.lit(0))


def _alike_in_parity(*parities: str) -> Column:
    """At most as many words stand in one class only as the threshold allows."""
    return _odd(*parities) <= F.col("a.size") + F.col("b.size") - 2 * _least_overlap()


def _least_overlap() -> Column:
    """UP / (UP + DOWN) * (sum of sizes), rounded up."""
    return F.ceil(UP * (F.col("a.size") + F.col("b.size")) / (UP + DOWN))


def _pair() -> list[Column]:
    return [*(F.col(f"a.{c}").alias(c) for c in _PLACE),
            *(F.col(f"b.{c}").alias(f"{c}2") for c in _PLACE)]


def _hub_pairs(classes: DataFrame) -> DataFrame:
    """Pairs (class's first line, hub's): of a class's hubs the one most alike by parity.

    Hubs are the first class that shares a name and, of a name that many share,
    the first of each of ``SPREAD`` parts of these.
    """
    named = _stored(classes.select(F.explode("hubs").alias("hub")).filter(
        "hub is not null").groupBy("hub").agg(F.count("*").alias("n")).filter("n > 1"))
    shared = F.broadcast(named) if named.count() <= BROADCAST_LINES else named
    rows = _stored(classes.select(
        *_PLACE, "size", "p1", "p2", F.explode("hubs").alias("hub")).join(shared, "hub"))
    first = F.min(F.struct(*_PLACE, "size", "p1", "p2")).alias("first")
    part = F.pmod(F.xxhash64(*_PLACE), F.lit(SPREAD)).alias("part")
    spread = rows.filter(F.col("n") > SPREAD).groupBy("hub", part).agg(first)
    hubs = rows.groupBy("hub").agg(first).select("hub", "first.*").unionByName(
        spread.select("hub", "first.*"))
    found = rows.alias("a").join(
        hubs.alias("b"), (F.col("a.hub") == F.col("b.hub")) & _earlier() & _alike_in_size()
        & _alike_in_parity("p1", "p2"))
    alike = (_odd("p1", "p2") / (F.col("a.size") + F.col("b.size"))).alias("off")
    others = [f"{c}2" for c in _PLACE]
    return found.select(*_pair(), alike).groupBy(*_PLACE).agg(
        F.min(F.struct("off", *others)).alias("best")).select(
        *_PLACE, *(F.col(f"best.{c}") for c in others))


def _candidates(classes: DataFrame, settled: DataFrame) -> DataFrame:
    """Pairs (open class's first line, any earlier class's) that pass all filters.

    Classes meet by a word of their prefixes and the bits of the larger one's
    size, so words shared by lines of other lengths make no pairs. The smaller
    one is there a second time if its partner may have one bit more: it then
    has the word among its first ``size`` - 2 UP / (UP + DOWN) ``size`` + 1.
    """
    if settled.count() <= BROADCAST_LINES:
        settled = F.broadcast(settled)
    bits = F.length(F.bin("size"))
    near = DOWN * F.col("size") >= UP * F.call_function("shiftleft", F.lit(1), F.col("bits"))
    short = F.col("pos") <= F.floor((DOWN - UP) * F.col("size") / (UP + DOWN))
    rows = classes.join(settled.withColumn("settled", F.lit(True)), _PLACE, "left").select(
        "p1", "p2", F.posexplode("prefix").alias("pos", "word"), *_PLACE, "size",
        bits.alias("bits"), F.col("settled").isNull().alias("open")).select("*", F.explode(
            F.when(near & short, F.array("bits", F.col("bits") + 1)).otherwise(F.array("bits"))
        ).alias("as_bits")).select(
        F.xxhash64("word", "as_bits").alias("word"), "p1", "p2", *_PLACE, "pos", "open",
        F.when(F.col("bits") == F.col("as_bits"), F.col("size")).otherwise(
            -F.col("size")).alias("size"))  # below 0 where it can only be the smaller one
    # a is the larger one, of equal ones the later; all conditions name both sides and
    # both have the same columns: nothing is cut before the exchange, and one serves both
    a, b = F.col("a.size"), F.abs("b.size")
    larger = (a > b) | ((a == b) & _earlier())
    least = F.ceil(UP * (a + b) / (UP + DOWN))
    is_open = (_earlier() & F.col("a.open")) | (_earlier("a", "b") & F.col("b.open"))
    ok = (larger & (DOWN * b >= UP * a) & (F.least(a - F.col("a.pos"), b - F.col("b.pos")) >= least)
          & is_open & (_odd("p1", "p2") <= a + b - 2 * least))

    def pick(name: str, first: str, other: str) -> Column:
        return F.when(_earlier(), F.col(f"{first}.{name}")).otherwise(F.col(f"{other}.{name}"))

    return rows.alias("a").join(rows.alias("b"), (F.col("a.word") == F.col("b.word")) & ok).select(
        *(pick(c, "a", "b").alias(c) for c in _PLACE),
        *(pick(c, "b", "a").alias(f"{c}2") for c in _PLACE)).distinct()


def _words_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Distinct words of the wanted lines (key, line_no, mark), one row for each."""
    n = wanted.count()
    by_row = wanted.groupBy("key", "mark").agg(F.collect_list("line_no").alias("numbers"))
    if n <= BROADCAST_LINES:
        by_row = F.broadcast(by_row)
    lines = docs.join(by_row, ["key", "mark"]).select(
        "key", "mark", "numbers", F.split("text", "\n", -1).alias("lines")).select(
        "key", "mark", F.explode(F.arrays_zip("numbers", F.transform(
            "numbers", lambda k: F.get("lines", k)).alias("line"))).alias("at")).select(
        "key", F.col("at.numbers").alias("line_no"), "mark", F.col("at.line").alias("line"))
    words = _stored(lines.select(*_PLACE, F.array_distinct(F.array_remove(
        _parts(F.col("line")), "")).alias("words")))
    # repeated rows have the same lines
    return words if words.count() == n else _stored(
        words.dropDuplicates(_PLACE))


def _matches(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Later lines (key, line_no, mark) of pairs whose word sets are similar."""
    others = [f"{c}2" for c in _PLACE]
    earlier = words.select(*(F.col(c).alias(f"{c}2") for c in (*_PLACE, "words")))
    both = F.size(F.array_intersect("words", "words2"))
    found = pairs.join(words, _PLACE).join(earlier, others)
    return found.filter(
        (UP + DOWN) * both >= UP * (F.size("words") + F.size("words2"))).select(
        *_PLACE).distinct()


def _verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Later lines (key, line_no, mark) of candidate pairs whose Jaccard is 4/5 or more."""
    pairs = _stored(pairs)
    own = pairs.select(*_PLACE).unionByName(
        pairs.select(*(F.col(f"{c}2").alias(c) for c in _PLACE)))
    words = _words_of(docs, _stored(own.distinct()))
    return _stored(_matches(pairs, words))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               mark_col: str | None = None) -> DataFrame:
    """Line numbers that an earlier line matches, for every row.

    A line is what stands between line feeds; its words are runs of other
    characters than ASCII white space. A line goes if an earlier line (in a
    row with a smaller id, or above in the same row) has a word set of Jaccard
    similarity 0.8 or more. Lines are judged on the input, so a line that
    itself goes still makes later matches go.

    Returns id_col, n_lines, removed (line numbers from 0, sorted); one row
    for each input row. With ``mark_col`` also the text's xxhash64 under that
    name, which tells rows apart that share an id or have none.

    * Lines without a word stay and match nothing. NULL text: no lines; empty
      text: one line.
    * NULL id: comes after all other ids.
    * Rows that share an id: lines with the same id and number are neither
      earlier nor later.
    * Empty table: no rows. Other columns of ``docs`` are not read.
    """
    base = keyed(docs, id_col, text_col)
    described = _stored(describe(base, bucket_counts(base.select("text"))))
    classes = _stored(described.groupBy("c1", "c2").agg(
        F.min(F.struct(*_PLACE, "size", "p1", "p2", "prefix", "hubs")).alias("first"),
        F.count("*").alias("n_lines")).select("c1", "c2", "first.*", "n_lines"))
    lines = _stored(described.select(*_PLACE, "c1", "c2"))
    discard(described)
    # sets of up to three words match only their equals
    joined = classes.filter(F.col("size") > 3)
    settled = _verified(base, _hub_pairs(joined))
    matched = settled.unionByName(_verified(base, _candidates(joined, settled)))
    heads = classes.select("c1", "c2", *_PLACE, "n_lines").join(
        matched.withColumn("matched", F.lit(True)), _PLACE, "left").filter(
        "matched or n_lines > 1").select(
        "c1", "c2", F.struct("key", "line_no").alias("first"),
        F.coalesce("matched", F.lit(False)).alias("matched"))
    gone = lines.select("key", "mark", "line_no", "c1", "c2").join(
        _stored(heads), ["c1", "c2"]).filter(
        F.col("matched") | (F.struct("key", "line_no") > F.col("first")))
    by_row = gone.select("key", "mark", "line_no").distinct().groupBy("key", "mark").agg(
        F.sort_array(F.collect_list("line_no")).alias("removed"))
    rows = base.select("id", "key", "mark", F.xxhash64("text").alias("own_mark"), F.when(F.col("text").isNull(), 0).otherwise(
        F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    ).cast("long").alias("n_lines"))
    return rows.join(by_row, ["key", "mark"], "left").select(
        F.col("id").alias(id_col), "n_lines",
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        *([F.col("own_mark").alias(mark_col)] if mark_col else []))


def drop_lines(text: Column, removed: Column) -> Column:
    """The text without the given lines (numbers from 0); NULL stays NULL."""
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda _, i: ~F.array_contains(
        removed, i)), "\n")
