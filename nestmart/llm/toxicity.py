"""Toxicity by cumulative-link ordinal regression on sparse word features.

Features of a text are its distinct words and their beginnings of 4, 5 and 6
letters. The model is fitted on at most ``LABELLED`` labelled rows (those with
the smallest hash of their id; a bounded sample, as a model fit may use), of
which rows with the same three smallest word hashes count once. Grades: 0 for
label 0; rows with label 1 get 1, 2 or 3 by the thirds of how many distinct
indicative words they hold. With one weight vector w and ordered thresholds
c1 <= c2 <= c3, P(grade >= k) = 1 / (1 + exp(c_k - w.x)); the expected
severity is the sum of the three.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmart.session import materialize

LABELLED = 20_000
FEATURES = 4_000
#: A feature needs so many texts with label 1, and this share of them.
MIN_TOXIC_TEXTS = 4
MIN_TOXIC_SHARE = 0.01
MIN_LOG_ODDS = 2.0
BEGINNINGS = (4, 5, 6)
GRADES = 3
STEPS, RATE, SHRINK = 2000, 0.1, 1e-6
MEMO = 200_000
WORD = re.compile(r"[^\W\d_]+")


def text_words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def word_features(word: str) -> list[str]:
    """The word itself, and its beginnings marked by a trailing asterisk."""
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)]


@dataclass
class Severity:
    """weights: by feature; cuts: the ordered thresholds."""

    weights: dict[str, float]
    cuts: list[float]

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.., a row for each score."""
        return 1 / (1 + np.exp(np.clip(np.array(self.cuts)[None, :] - score[:, None], -50, 50)))


def fit_cumulative_link(rows: list[list[int]], grades: np.ndarray, features: int
                        ) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts of largest likelihood; ``rows`` has each text's feature numbers."""
    flat = np.array([f for r in rows for f in r], dtype=np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    reached = grades[:, None] >= np.arange(1, GRADES + 1)[None, :]
    # cuts are c1, c1 + exp(g2), c1 + exp(g2) + exp(g3): always ordered
    p = np.concatenate((np.zeros(features), [2.0], np.zeros(GRADES - 1)))
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, STEPS + 1):
        score = np.bincount(owner, weights=p[flat], minlength=len(rows))
        gaps = np.exp(p[features + 1:])
        cuts = p[features] + np.concatenate(([0.0], np.cumsum(gaps)))
        tail = 1 / (1 + np.exp(np.clip(cuts[None, :] - score[:, None], -40, 40)))
        full = np.concatenate((np.ones((len(rows), 1)), tail, np.zeros((len(rows), 1))), axis=1)
        i = np.arange(len(rows))
        own = np.maximum(full[i, grades] - full[i, grades + 1], 1e-12)
        slope = np.concatenate((np.zeros((len(rows), 1)), tail * (1 - tail),
                                np.zeros((len(rows), 1))), axis=1)
        low, high = slope[i, grades] / own, slope[i, grades + 1] / own
        d_score = -(low - high)
        d_cut = np.zeros(GRADES + 2)
        np.add.at(d_cut, grades, low)
        np.add.at(d_cut, grades + 1, -high)
        d_cut = d_cut[1:GRADES + 1] / len(rows)
        grad = np.zeros_like(p)
        grad[:features] = np.bincount(flat, weights=d_score[owner], minlength=features) / len(
            rows) + SHRINK * p[:features]
        grad[features] = d_cut.sum()
        for k in range(GRADES - 1):
            grad[features + 1 + k] = d_cut[k + 1:].sum() * gaps[k]
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad ** 2
        p -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    gaps = np.exp(p[features + 1:])
    return p[:features], p[features] + np.concatenate(([0.0], np.cumsum(gaps)))


def _sampled(label: dict[int, int]):
    keys = np.array(sorted(label), dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.asarray(batch.column("key"))
            chosen = np.flatnonzero(np.isin(key, keys))
            own = batch.column("text").take(pa.array(chosen))
            words = [sorted(text_words(t.as_py())) for t in own]
            sign = [",".join(sorted(xxhash.xxh64_hexdigest(w) for w in ws)[:3]) for ws in words]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[chosen]), pa.array([label[int(k)] for k in key[chosen]], pa.int32()),
                 pa.array(sign, pa.string()), pa.array(words, pa.list_(pa.string()))],
                names=["key", "label", "sign", "words"])

    return run


def fit_severity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", label_id_col: str = "doc_id", label_col: str = "toxic",
                 labelled: int = LABELLED) -> Severity:
    """Fit on labelled rows of ``docs``; see :func:`severity` for odd input."""
    picked = labels.select(F.col(label_id_col).cast("long").alias("key"),
                           F.col(label_col).cast("int").alias("label")).dropna().groupBy(
        "key").agg(F.max("label").alias("label")).orderBy(F.xxhash64("key"), "key").limit(labelled)
    label = {r.key: int(r.label > 0) for r in picked.collect()}
    texts = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    sample = materialize(
        texts.filter("key is not null").mapInArrow(
            _sampled(label), "key long, label int, sign string, words array<string>")
        .dropDuplicates(["key"]), "toxicity")
    once = sample.groupBy("sign", "label").agg(F.min("key").alias("key"))
    sample = sample.join(F.broadcast(once.select("key")), "key")
    total = sample.agg(F.sum("label"), F.count("*")).first()
    bad, n = total[0] or 0, total[1]
    if not bad or bad == n:
        return Severity({}, [50.0] * GRADES)
    parts = [F.transform(F.filter("words", lambda w, k=k: F.length(w) > k),
                         lambda w, k=k: F.concat(F.substring(w, 1, k), F.lit("*")))
             for k in BEGINNINGS]
    marked = sample.select("key", "label",
                           F.array_distinct(F.concat("words", *parts)).alias("features"))
    counted = marked.select("label", F.explode("features").alias("feature")).groupBy(
        "feature").agg(F.sum("label").alias("bad"), F.count("*").alias("n"))
    odds = (F.log((F.col("bad") + 0.5) / (bad + 1))
            - F.log((F.col("n") - F.col("bad") + 0.5) / (n - bad + 1)))
    chosen = counted.filter(F.col("bad") >= max(MIN_TOXIC_TEXTS, MIN_TOXIC_SHARE * bad)).withColumn("odds", odds).filter(
        F.col("odds") >= MIN_LOG_ODDS).orderBy(
        F.desc(F.round(F.col("odds") * F.sqrt("bad"), 9)), "feature").limit(FEATURES)
    names = [r.feature for r in chosen.collect()]
    if not names:
        return Severity({}, [50.0] * GRADES)
    code = {f: i for i, f in enumerate(names)}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sorted({code[f] for w in ws for f in word_features(w) if f in code})
                   for ws in batch.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"), pa.array(own, pa.list_(pa.int32()))],
                names=["key", "label", "features"])

    rows = sample.select("key", "label", "words").mapInArrow(
        held, "key long, label int, features array<int>").orderBy("key").collect()
    strength = np.array([len(r.features) for r in rows])
    toxic = np.array([r.label for r in rows]) == 1
    thirds = np.quantile(strength[toxic], [1 / 3, 2 / 3])
    grades = np.where(toxic, 1 + (strength > thirds[0]) + (strength > thirds[1]), 0)
    weights, cuts = fit_cumulative_link([r.features for r in rows], grades, len(names))
    return Severity({f: float(w) for f, w in zip(names, weights, strict=True)},
                    [float(c) for c in cuts])


def _graded(model: Severity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            score = np.zeros(len(batch))
            for i, t in enumerate(batch.column("text")):
                held: set[str] = set()
                for w in text_words(t.as_py()):
                    own = memo.get(w)
                    if own is None:
                        own = tuple(f for f in word_features(w) if f in model.weights)
                        if len(memo) >= MEMO:
                            memo.clear()
                        memo[w] = own
                    if own:
                        held.update(own)
                score[i] = sum(model.weights[f] for f in sorted(held))
            tail = model.at_least(score)
            rest = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in rest), pa.array(tail[:, 0]),
                 pa.array(tail.sum(axis=1))], names=[*rest, "p_toxic", "severity"])

    return run


def severity(docs: DataFrame, model: Severity, id_col: str = "doc_id", text_col: str = "text"
             ) -> DataFrame:
    """Expected severity (0 to 3) of every text, and the probability of grade 1 or more.

    Returns id_col, p_toxic, severity, rejected (p_toxic >= 0.5); one row for
    each input row.

    * NULL or empty text: no features; severity of the empty score.
    * Ids must be whole numbers to be matched with labels when fitting; NULL
      ids match none. An id with labels 0 and 1 counts as 1. Repeated rows
      count once in the fit.
    * Labels of one kind only, or none: nothing is rejected.
    * An empty table gives no rows. Other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _graded(model), f"id {id_type}, p_toxic double, severity double")
    return out.select(F.col("id").alias(id_col), F.round("p_toxic", 6).alias("p_toxic"),
                      F.round("severity", 6).alias("severity"),
                      (F.col("p_toxic") >= 0.5).alias("rejected"))


def drop_toxic(docs: DataFrame, model: Severity, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that are not rejected, all columns kept; see :func:`severity`."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.RecordBatch.from_arrays([batch.column(text_col)], names=["text"])
            p = next(_graded(model)(iter([own]))).column("p_toxic")
            yield batch.filter(pa.array(np.asarray(p) < 0.5)).select(names)

    return docs.mapInArrow(run, docs.schema)
