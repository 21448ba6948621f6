"""Lines of many lengths and kinds of white space; what the word join and the scratch space hold."""

import random
from pathlib import Path

from nestmart.llm import line_dedup as module
from nestmart.llm.line_dedup import bucket_counts, describe, line_dedup


def test_wide_lines_go_once_classes_are_stored_and_sizes_and_white_space_match(spark, monkeypatch):
    rng = random.Random(11)
    rows = []
    for n in (4, 7, 8, 9, 15, 16, 17, 20, 31, 32, 33, 40):
        line = [f"n{n}_{k}" for k in range(n)]
        for size in range(max(1, n * 3 // 4), n * 4 // 3 + 1):
            some = (line + [f"y{n}_{size}_{k}" for k in range(size - n)])[:size]
            rng.shuffle(some)
            rows.append(rng.choice([" ", "  ", "\t", " \x0b", "\x0c", "\r"]).join(some))
    rng.shuffle(rows)
    stored, store = [], module._stored
    monkeypatch.setattr(module, "_stored", lambda df: stored.append(store(df)) or stored[-1])
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.removed for r in line_dedup(docs).collect()}
    sets = [set(t.split()) for t in rows]
    assert got == {i: [0] if any(5 * len(sets[i] & s) >= 4 * len(sets[i] | s) for s in sets[:i])
                   else [] for i in range(len(rows))}
    described = next(s for s in stored if "prefix" in s.columns)
    assert not any(Path(f.removeprefix("file:")).exists() for f in described.inputFiles())


def test_the_word_join_reads_one_exchange(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f g")],
                                 "doc_id long, text string")
    base = module.keyed(docs, "doc_id", "text")
    classes = describe(base, bucket_counts(base.select("text"))).localCheckpoint()
    pairs = module._candidates(classes, classes.limit(0).select("key", "line_no", "mark"))
    assert [(r.key, r.key2) for r in pairs.collect()] == [(2, 1)]
    assert "ReusedExchange" in pairs._jdf.queryExecution().executedPlan().toString()
