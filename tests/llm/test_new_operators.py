"""Fill-in-middle, MinHash groups and periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nestmart.llm import fill_middle as fim
from nestmart.llm import minhash_join, periodic_runs
from nestmart.llm.fill_middle import fill_middle, restored
from nestmart.llm.minhash_join import minhash_groups
from nestmart.llm.periodic_runs import listed, longest, with_planted_tail
from nestmart.llm.queries import QUERIES

from .test_operators import SCHEMA, corpus, split

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- fill-in-middle ---------------------------------------------------------------------------

def plain_fill_middle(i, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(tokens) + 1) for x in h[:2])
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return i, len(tokens), "plain", None, None, text
    form = "spm" if h[3] % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return i, len(tokens), form, len(p), len(m), out


def test_fill_middle(spark, docs):
    more = [(100 + k, t, "", "", 0, 0) for k, t in enumerate(
        ["has <P> in it", "<S>", "<M> x", "ends in <", "< <P", "\t\n", " a", "a ", "\U0001F600 é"] * 6)]
    found = fill_middle(docs.unionByName(spark.createDataFrame(more, SCHEMA)))
    rows = found.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    want = [plain_fill_middle(i, t) for i, t, *_ in [*corpus(), *more]]
    assert sorted([tuple(r)[:6] for r in rows], key=repr) == sorted(want, key=repr)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    texts = {(i, t or "") for i, t, *_ in [*corpus(), *more]}
    assert all((r.doc_id, r.back) in texts for r in rows)
    assert fill_middle(empty(spark)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é\t\n\U0001F600")), max_size=6), st.integers(0, 3))
def test_chunks_combine_to_token_places(texts, copies):
    # repeated and shifted passages, so that chunks are shared and begin anywhere
    long = "".join(texts) * 40
    texts = [*texts, *(long[k:] + long for k in range(copies))]
    cache = fim.Summaries(limit=2000)
    for piece in fim.pieces(pa.array(texts, pa.string())):
        starts, chunks = fim.chunked(piece)
        found = cache.of(chunks)
        first = np.searchsorted(starts, piece.offsets)
        for i in range(piece.hi - piece.lo):
            tokens = TOKEN.findall(texts[piece.lo + i])
            cuts = fim.Cuts(found[first[i]:first[i + 1]])
            assert cuts.n_tokens == len(tokens)
            assert [cuts.place(k) for k in range(len(tokens) + 1)] == [
                sum(map(len, tokens[:k])) for k in range(len(tokens) + 1)]


def test_shared_chunks_are_summarised_once():
    rng = random.Random(2)
    passage = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000))
    texts = [f"{'x ' * k}{passage}" for k in range(20)]
    (piece,) = fim.pieces(pa.array(texts))
    chunks = fim.chunked(piece)[1]
    cache = fim.Summaries()
    cache.of(chunks)
    # only the first chunk of each text differs
    assert len(chunks) > 19 * len(set(chunks)) / 2 and cache.made == len(set(chunks))
    assert cache.made <= len(chunks) / 20 + 20
    assert cache.of(chunks) and cache.made == len(set(chunks))


def test_chunks_are_bounded_and_cut_no_character():
    texts = ["x" * 50_000, "é" * 40_000, " " * 40_000, "", "\U0001F600" * 20_000]
    for piece in fim.pieces(pa.array(texts)):
        for chunk in fim.chunked(piece)[1]:
            assert 0 < len(chunk) <= fim.MAX_CHUNK + 3 and chunk.decode() is not None


# --- MinHash ----------------------------------------------------------------------------------

def shingles(text):
    own = split("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(own[k:k + 5]) for k in range(max(1, len(own) - 4))} if own else set()


def plain_groups(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    group = list(range(len(rows)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                group[top(a)] = top(b)
    ids = {}
    for k, (i, *_) in enumerate(rows):
        ids.setdefault(top(k), []).append(1 << 62 if i is None else i)
    out = []
    for k, (i, *_) in enumerate(rows):
        least = min(ids[top(k)])
        own = 1 << 62 if i is None else i
        out.append((i, len(sets[k]), None if least == 1 << 62 else least, least == own))
    return out


def near_copies(seed=7):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for group in range(6):
        line = [rng.choice(vocabulary) for _ in range(rng.choice([12, 60, 300]))]
        for _ in range(12):
            line = list(line) if rng.random() < 0.7 else [*line, rng.choice(vocabulary)]
            own = list(line)
            for _ in range(rng.randint(0, max(1, len(own) // 50))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                line = own
            rows.append((len(rows) + 10 * group, " ".join(own)))
    # exactly 85 of 100 shingles in common, and 84 of 100
    base = [f"q{k}" for k in range(96)]
    rows += [(900, " ".join(base)), (901, " ".join([*base[:89], *(f"z{k}" for k in range(7))]))]
    shared = "p " + " ".join(rng.choice(vocabulary) for _ in range(40))
    rows += [(1000 + k, " ".join(rng.choice(vocabulary) for _ in range(20)) + " " + shared)
             for k in range(30)]
    return rows


def test_minhash_groups(spark, docs):
    got = [tuple(r) for r in minhash_groups(docs).collect()]
    assert sorted(got, key=repr) == sorted(plain_groups(corpus()), key=repr)
    assert any(r[2] not in (None, r[0]) for r in got)
    assert minhash_groups(empty(spark)).collect() == []


def test_minhash_groups_of_near_copies_and_chains(spark):
    rows = near_copies()
    want = plain_groups(rows)
    assert sum(not w[3] for w in want) > 30
    for n in (1, 5):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(n)
        assert sorted(tuple(r) for r in minhash_groups(df).collect()) == sorted(want)


def test_minhash_threshold_is_exact(spark):
    # sets of 100 - x and 100 shingles, one within the other
    for x, linked in ((85, True), (84, False)):
        long = [f"v{k}" for k in range(104)]
        df = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(long[:x + 4]).upper())],
                                   "doc_id long, text string")
        assert {r.doc_id: r.component for r in minhash_groups(df).collect()} == {
            1: 1, 2: 1 if linked else 2}


def test_minhash_rows_without_or_with_shared_id(spark):
    a, b = "one two three four five six seven", "quite another text that has some more words"
    rows = [(1, a), (2, a), (2, b), (None, a), (None, b), (None, "alone"), (None, "alone"), (3, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in minhash_groups(df).collect()), key=repr)
    assert got == sorted(plain_groups(rows), key=repr)
    assert (2, 4, 2, True) in got and (None, 1, None, True) in got and (3, 4, 2, False) in got


def test_keys_guarantee_pairs_within_the_distance():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 16, (300, minhash_join.SYMBOLS), dtype=np.uint16)
    b = a.copy()
    for k in range(300):
        at = rng.choice(minhash_join.SYMBOLS, minhash_join.DISTANCE, replace=False)
        b[k, at] += np.uint16(1)
    shared = minhash_join.keys_of(a) == minhash_join.keys_of(b)
    assert shared.any(axis=1).all()
    assert (minhash_join.first_shared_key(a == b) == shared.argmax(axis=1)).all()


def test_search_by_blocks_finds_what_hubs_miss(spark, monkeypatch):
    # links only through the search: hub pairs are taken away
    rows = near_copies(9)
    monkeypatch.setattr(minhash_join._Join, "hub_pairs", staticmethod(
        lambda shared: shared.select(F.col("node").alias("a"), F.col("hub").alias("b")).limit(0)))
    monkeypatch.setattr(minhash_join, "BLOCK", 3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in minhash_groups(df).collect()) == sorted(plain_groups(rows))


# --- periodic runs ----------------------------------------------------------------------------

def plain_runs(own):
    found = {}
    for q in range(1, len(own) // 4 + 1):
        a = 0
        while a + q < len(own):
            b = a
            while b + q < len(own) and own[b] == own[b + q]:
                b += 1
            if b > a and b - a + q >= max(6, 4 * q):
                found.setdefault((a, b - a + q), q)
            a = b + 1
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(own, runs):
    gone = {k for a, n, q in runs for k in range(a + q, a + n)}
    return " ".join(w for k, w in enumerate(own) if k not in gone)


def repeating(rng, n):
    out = []
    while len(out) < n:
        unit = [rng.choice(["a", "b", "é", "c" * 3]) for _ in range(rng.randint(1, 7))]
        out += rng.choice([unit * rng.randint(1, 8) + unit[:rng.randint(0, len(unit))],
                           [f"u{rng.randint(0, 9)}" for _ in range(rng.randint(1, 9))]])
    return out


def test_periodic_runs(spark, docs):
    rng = random.Random(8)
    more = [(100 + k, " ".join(repeating(rng, rng.randint(0, 200))), "", "", 0, 0)
            for k in range(220)]
    more += [(300, "a " * 5000, "", "", 0, 0), (301, "a b " * 3, "", "", 0, 0),
             (302, "a " * 5, "", "", 0, 0), (303, "a b " * 4, "", "", 0, 0)]
    found = periodic_runs.periodic_runs(docs.unionByName(spark.createDataFrame(more, SCHEMA)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()]
    want = []
    for i, t, *_ in [*corpus(), *more]:
        own = split(t)
        runs = plain_runs(own)
        want.append((i, len(own), runs, plain_collapsed(own, runs)))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(len(w[2]) for w in want) > 500
    assert periodic_runs.periodic_runs(empty(spark)).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60), st.integers(1, 6))
def test_segments_give_all_runs(own, times):
    own = own[:20] * times + own
    value = np.array([ord(x) for x in own], dtype=np.uint64)
    value = periodic_runs.mix(value)
    got = []
    for lo, hi in periodic_runs.split_by_frequency(value, np.zeros(len(value), dtype=np.int64)):
        got += [(a + lo, n, q) for a, n, q in periodic_runs.Segment(value[lo:hi]).runs()]
    assert sorted(got) == plain_runs(own)


def test_equal_hashes_of_other_words_change_nothing(monkeypatch):
    monkeypatch.setattr(periodic_runs, "BASE", np.uint64(0))
    own = ["a", "b", "c", "d"] * 5 + ["a"] * 9 + ["b", "a"] * 6
    value = np.array([ord(x) for x in own], dtype=np.uint64)
    monkeypatch.setattr(periodic_runs.Segment, "equal", lambda self, a, b, size: size >= 0)
    found = periodic_runs.Segment(value)
    monkeypatch.setattr(found, "candidates", lambda: (
        np.zeros(8, dtype=np.int64), np.arange(1, 9)))
    assert found.runs() == plain_runs(own)


def test_planted_tail(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 97)) + " ") for i in range(300)]
    rows += [(None, "a b"), (7, None), (8, "")]
    got = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", "text", with_planted_tail().alias("out")).collect()
    planted = 0
    for r in got:
        own = split(r.text)
        h = 1 if r.doc_id is None else zlib.crc32(str(r.doc_id).encode())
        if h % 10 or not own:
            assert r.out == r.text
            continue
        n, g = len(own), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        assert r.out == " ".join(own[a + (i - a) % p] if i >= a else own[i] for i in range(n))
        planted += 1
    assert planted > 10


def test_longest_and_listed(spark):
    runs = [(5, 8, 2), (0, 8, 2), (0, 8, 1), (9, 6, 1)]
    row = spark.createDataFrame(
        [(runs,), ([],)], "runs array<struct<start:long,length:long,period:long>>").select(
        longest(F.col("runs")).alias("best"), listed(F.col("runs")).alias("text")).collect()
    assert tuple(row[0].best) == (0, 8, 1) and row[1].best is None
    assert row[0].text == "5,8,2\n0,8,2\n0,8,1\n9,6,1\n" and row[1].text == ""


def test_periodic_query_on_the_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    assert len(got) == len(table)
    for i, text in table:
        own = split(text)
        h = zlib.crc32(str(i).encode())
        g, n = h // 10, len(own)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            own = [own[a + (k - a) % p] if k >= a else own[k] for k in range(n)]
        runs = plain_runs(own)
        r = got[i]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == sha("".join("%d,%d,%d\n" % x for x in runs))
        assert r.collapsed_sha256 == sha(plain_collapsed(own, runs))
        if runs:
            best = min(runs, key=lambda x: (-x[1], x[0], x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (
                *best, 1000 * best[1] // best[2])
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
    assert sum(r.n_runs > 0 for r in got.values()) > 5


def test_minhash_query_on_the_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in QUERIES["op12_minhash"](spark, sf_dir).collect())
    assert got == sorted(plain_groups([tuple(r) for r in table]))
