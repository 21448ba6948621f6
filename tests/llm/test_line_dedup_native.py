"""Line dedup in DataFrame operations only; groups of near copies settled at hubs."""

import random

from nestmart.llm import line_dedup as module
from nestmart.llm.line_dedup import bucket_counts, describe, line_dedup


def test_line_dedup_runs_no_python_on_the_executors(spark, monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("Python on the executors")

    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e g"), (3, "f e d c b a")],
                                 "doc_id long, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", refuse)
    found = line_dedup(docs)
    assert "Python" not in found._jdf.queryExecution().toString()
    assert {r.doc_id: r.removed for r in found.collect()} == {1: [], 2: [], 3: [0]}


def test_describe_counts_words_and_prefixes(spark):
    rng = random.Random(3)
    texts = ["", " \t ", "one", *(" ".join(rng.choice("abcdefghijkl") * rng.randint(1, 3)
                                           for _ in range(n)) for n in range(1, 60)), None]
    base = module.keyed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"),
                        "doc_id", "text")
    got = {r.key: r for r in describe(base, bucket_counts(base.select("text"))).collect()}
    sets = {k: set(t.split()) for k, t in enumerate(texts) if t and t.split()}
    assert {k: r["size"] for k, r in got.items()} == {k: len(s) for k, s in sets.items()}
    for k, s in sets.items():
        assert len(set(got[k].prefix)) == len(got[k].prefix) == len(s) - (4 * len(s) + 4) // 5 + 1
        assert (got[k].c1, got[k].c2) == next(
            (got[i].c1, got[i].c2) for i in sets if sets[i] == s)


def test_line_dedup_settles_half_of_a_group_at_hubs(spark):
    """300 texts, each 2 to 6 of 60 words off one base."""
    rng = random.Random(8)
    rows = []
    for i in range(300):
        line = [f"w{k}" for k in range(60)]
        for k in rng.sample(range(60), rng.randint(2, 6)):
            line[k] = f"x{i}_{k}"
        rows.append((i, " ".join(line)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    base = module.keyed(docs, "doc_id", "text")
    classes = describe(base, bucket_counts(base.select("text"))).localCheckpoint()
    pairs = module._hub_pairs(classes)
    assert pairs.count() <= 299
    settled = module._verified(base, pairs)
    sets = [set(t.split()) for _, t in rows]
    want = {i: [0] if any(5 * len(sets[i] & s) >= 4 * len(sets[i] | s) for s in sets[:i]) else []
            for i, _ in rows}
    assert {r.doc_id: r.removed for r in line_dedup(docs).collect()} == want
    assert 20 < sum(map(len, want.values())) < 300
    assert 2 * settled.count() >= sum(map(len, want.values()))
