"""Language identification by word-first backoff.

A word that the model knows adds its log frequency in every language; an
unseen word adds the mean log frequency of its longest known character
n-grams (5, then 4, ... 1 letters, word ends marked). The language of the
largest sum is predicted; the score is its share after a softmax.

The model is fitted on at most ``TRAIN_TEXTS`` texts, chosen by a hash of
their ids, and keeps at most ``WORDS`` words and ``GRAMS`` n-grams of each
length for a language (a bounded sample and size, as a model fit may use).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nestmart.session import materialize

TRAIN_TEXTS = 20_000
WORDS = 40_000
GRAMS = 10_000
LONGEST = 5
SMOOTHING = 0.5
MEMO = 150_000
UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")


def grams(word: str, size: int) -> list[str]:
    """Character n-grams of a word with its ends marked by a space."""
    marked = f" {word} "
    return [marked[i:i + size] for i in range(len(marked) - size + 1)]


@dataclass
class Languages:
    """Log frequencies by language: a row of ``table`` for each word and n-gram."""

    names: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    table: np.ndarray
    memo: dict[str, np.ndarray] = field(default_factory=dict)

    def unseen(self, word: str) -> np.ndarray:
        """What an unknown word adds: backoff to ever shorter n-grams."""
        found = self.memo.get(word)
        if found is None:
            found = np.zeros(len(self.names))
            for size in range(LONGEST, 0, -1):
                rows = [r for r in map(self.grams.get, grams(word, size)) if r is not None]
                if rows:
                    found = self.table[rows].mean(axis=0)
                    break
            if len(self.memo) >= MEMO:
                self.memo.clear()
            if len(word) < 64:
                self.memo[word] = found
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = Counter(WORD.findall((text or "").lower()))
        if not counts or not self.names:
            return UNDETERMINED, 0.0
        total = np.zeros(len(self.names))
        rows, times = [], []
        for w, n in counts.items():
            r = self.words.get(w)
            if r is None:
                total += n * self.unseen(w)
            else:
                rows.append(r)
                times.append(n)
        if rows:
            total += np.array(times, dtype=float) @ self.table[rows]
        share = np.exp(total - total.max())
        best = int(np.argmax(share))
        return self.names[best], float(share[best] / share.sum())


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, Counter] = {}
        for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
            counts.setdefault(lang.as_py(), Counter()).update(WORD.findall(text.as_py().lower()))
        rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
        if rows:
            lang, word, n = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang), pa.array(word), pa.array(n, pa.int64())],
                names=["lang", "gram", "n"])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, word, n in zip(*(batch.column(x).to_pylist() for x in ("lang", "gram", "n")),
                                 strict=True):
            for size in range(1, LONGEST + 1):
                for g in grams(word, size):
                    counts[lang, size, g] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.string()),
             pa.array([k[1] for k in counts], pa.int32()),
             pa.array([k[2] for k in counts], pa.string()),
             pa.array(list(counts.values()), pa.int64())], names=["lang", "size", "gram", "n"])


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("lang", "size").orderBy(F.desc("n"), "gram")
    return counts.withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= most).drop("rank")


def _sample(rows: DataFrame, texts: int) -> DataFrame:
    """(id, text, lang) of the ``texts`` smallest hashes of each language, one row for each."""
    hashed = rows.withColumn("hash", F.xxhash64("id", "text"))
    place = F.pmod("hash", F.lit(1 << 30))
    hashes = materialize(hashed.select("lang", "hash").distinct(), "langid")
    cut = hashes.groupBy("lang").agg(F.count("*").alias("size"))
    # twice as many hashes as wanted are ranked, so no task ranks a whole language
    near = hashes.join(F.broadcast(cut), "lang").filter(
        place.cast("double") * F.col("size") <= (1 << 30) * (2.0 * texts + 100))
    order = Window.partitionBy("lang").orderBy(place, "hash")
    chosen = near.withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= texts).select("lang", "hash")
    return hashed.join(F.broadcast(materialize(chosen, "langid")), ["lang", "hash"],
                       "left_semi").dropDuplicates(["lang", "hash"]).select("id", "text", "lang")


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", train: Column | None = None,
                  texts: int = TRAIN_TEXTS) -> Languages:
    """Learn from rows with a text and a language for which ``train`` holds (all if None).

    Rows with a NULL id, text or language are left out; no such row at all
    gives a model without languages, which predicts ``und`` for every text.
    Of more than ``texts`` rows, up to that many of each language are read:
    those with the smallest hashes of id and text, repeated rows once.
    """
    rows = docs.filter(train) if train is not None else docs
    rows = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.col(lang_col).cast("string").alias("lang")).dropna()
    if rows.count() > texts:
        rows = _sample(rows, texts)
    words = materialize(rows.select("lang", "text").mapInArrow(
        _count_words, "lang string, gram string, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")), "langid")
    sized = words.select("lang", F.lit(0).alias("size"), "gram", "n").filter("n > 1")
    short = words.mapInArrow(
        _count_grams, "lang string, size int, gram string, n long").groupBy(
        "lang", "size", "gram").agg(F.sum("n").alias("n"))
    kept = _most_frequent(sized, WORDS).unionByName(_most_frequent(short, GRAMS)).orderBy(
        "size", "gram", "lang").collect()
    names = sorted({r.lang for r in kept})
    place = {lang: i for i, lang in enumerate(names)}
    known: dict[int, dict[str, np.ndarray]] = {}
    for r in kept:
        known.setdefault(r.size, {}).setdefault(r.gram, np.zeros(len(names)))[place[r.lang]] = r.n
    tables, word_rows, gram_rows, at = [], {}, {}, 0
    for size, rows_of in sorted(known.items()):
        counts = np.array(list(rows_of.values())) + SMOOTHING
        tables.append(np.log(counts / counts.sum(axis=0)))
        (word_rows if size == 0 else gram_rows).update(
            (g, at + i) for i, g in enumerate(rows_of))
        at += len(rows_of)
    return Languages(names, word_rows, gram_rows,
                     np.concatenate(tables) if tables else np.zeros((0, 0)))


def predict_languages(docs: DataFrame, model: Languages, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score) of every row, from its text alone.

    * NULL text, or text without a letter: ``und`` with score 0.
    * Equal sums: the language first in alphabetical order.
    * Repeated rows give the same result; an empty table gives no rows. Other
      columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.predict(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([x[0] for x in found], pa.string()),
                 pa.array([x[1] for x in found], pa.float64())],
                names=["id", "lang_pred", "score"])

    id_type = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, lang_pred string, score double")
    return out.select(F.col("id").alias(id_col), "lang_pred", "score")


def held_out(id_col: str = "doc_id") -> Column:
    """A fifth of the ids, by crc32 of the id as text; false for a NULL id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
