"""Quality rules: base counts, and a hashed n-gram log-likelihood ratio.

Texts are read as tokens (runs of word characters, runs of other marks); their
unigrams and bigrams are hashed into ``BUCKETS`` buckets. One pass over all
texts counts the buckets of the raw corpus and of trusted target texts; a
text's score is the mean, over its n-grams, of the log ratio of the two
smoothed multinomials. A text is kept if its base counts pass and its score
reaches a threshold that is the same for all texts.

Trusted texts are all labelled rows with quality 1, and the threshold goes by
all labelled rows; labels are joined to the texts, none reaches the driver.
Raw-corpus counts and scores cover every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmart.session import materialize

from .words import BASE, WHITE_SPACE, Lexer, Words, mix, pieces, window_hashes, words

BUCKETS = 1 << 16
SMOOTHING = 0.5
MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
WORD_LEXER = Lexer.separated_by(WHITE_SPACE)


def _token_lexer() -> Lexer:
    lexer = Lexer.separated_by(WHITE_SPACE)
    kind = lexer.kind.copy()
    marks = [b for b in range(0x80) if kind[b] and not chr(b).isalnum()]
    kind[marks] = 2
    return Lexer(kind, lexer.fold)


TOKEN_LEXER = _token_lexer()


def ngram_buckets(tokens: Words) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every unigram and bigram."""
    h, doc = tokens.hash, tokens.doc
    top = np.uint64(64 - BUCKETS.bit_length() + 1)
    pair = mix(h[:-1] * BASE + h[1:]) if len(h) > 1 else h[:0]
    inside = doc[:-1] == doc[1:]
    return (np.concatenate((h >> top, pair[inside] >> top)).astype(np.int64),
            np.concatenate((doc, doc[:-1][inside])))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw = np.zeros(BUCKETS, dtype=np.int64)
    target = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        chosen = np.asarray(batch.column("trusted").to_numpy(zero_copy_only=False), dtype=bool)
        for piece in pieces(batch.column("text")):
            bucket, doc = ngram_buckets(words(piece, TOKEN_LEXER))
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[chosen[piece.lo:piece.hi][doc]], minlength=BUCKETS)
    seen = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])],
        names=["bucket", "raw", "target"])


def log_ratios(texts: DataFrame) -> np.ndarray:
    """Log of target over raw probability by bucket; ``texts`` has text, trusted."""
    rows = texts.mapInArrow(_count, "bucket long, raw long, target long").groupBy(
        "bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    raw = np.full(BUCKETS, SMOOTHING)
    target = np.full(BUCKETS, SMOOTHING)
    for r in rows:
        raw[r.bucket] += r.raw
        target[r.bucket] += r.target
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def _repeated_words(found: Words, texts: int) -> np.ndarray:
    """Per text, the words in 3-word windows that the text has twice or more."""
    h = window_hashes(found.hash, 3)
    doc = found.doc[:len(h)]
    ok = np.flatnonzero(doc == found.doc[2:][:len(h)]) if len(h) else np.zeros(0, np.int64)
    own = mix(h[ok] + doc[ok].astype(np.uint64) * BASE)
    order = np.argsort(own)
    same = own[order][1:] == own[order][:-1]
    often = ok[order[np.concatenate((same, [False])) | np.concatenate(([False], same))]] \
        if len(ok) else ok
    covered = np.zeros(len(found.doc), dtype=bool)
    for k in range(3):
        covered[often + k] = True
    return np.bincount(found.doc[covered], minlength=texts)


def _repeated_lines(text: bytes) -> int:
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line.split(None, 1):
            n += line in seen
            seen.add(line)
    return n


def _score(weights: np.ndarray):
    marks = np.zeros(256, dtype=bool)
    marks[np.frombuffer(SYMBOLS, dtype=np.uint8)] = True
    letter = (WORD_LEXER.kind > 0) & ((np.arange(256) & 0xC0) != 0x80)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[] for _ in range(6)]
            for piece in pieces(batch.column("text")):
                n = piece.hi - piece.lo
                found = words(piece, WORD_LEXER)
                bucket, doc = ngram_buckets(words(piece, TOKEN_LEXER))
                grams = np.bincount(doc, minlength=n)
                total = np.bincount(doc, weights=weights[bucket], minlength=n)
                upto = [np.concatenate(([0], np.cumsum(t[piece.data]))) for t in (letter, marks)]
                for k, x in enumerate((
                        np.bincount(found.doc, minlength=n), *(np.diff(u[piece.offsets])
                                                               for u in upto),
                        [_repeated_lines(piece.text(i)) for i in range(n)],
                        _repeated_words(found, n),
                        np.where(grams > 0, total / np.maximum(grams, 1), 0.0))):
                    out[k].append(np.asarray(x, dtype=np.int64 if k < 5 else float))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("key"),
                 *(pa.array(np.concatenate(x)) for x in out)],
                names=["id", "key", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "score"])

    return run


def threshold(hist: list[tuple[float, int, int]]) -> float:
    """Cut with the largest share of good texts at or above it less that of bad ones.

    ``hist``: (score, good, bad) in any order. Ties go to the lower cut; with
    no good or no bad text every score passes.
    """
    good, bad = sum(x[1] for x in hist), sum(x[2] for x in hist)
    if not good or not bad:
        return float("-inf")
    best, above_good, above_bad = (0.0, float("-inf")), good, bad
    previous = None
    for score, g, b in sorted(hist):
        gain = above_good / good - above_bad / bad
        if gain > best[0] + 1e-12:
            best = gain, (score + previous) / 2 if previous is not None else score
        above_good, above_bad, previous = above_good - g, above_bad - b, score
    return best[1]


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", label_id_col: str = "doc_id",
                   label_col: str = "quality") -> tuple[DataFrame, float]:
    """Counts and score of every text, and the score from which texts are kept.

    The frame has id_col, n_words, word_chars (code points in words),
    n_symbols, n_dup_lines (lines with a word, equal to an earlier line of the
    text), n_repeat_words (words in 3-word windows that the text has twice or
    more, first included), score; one row for each input row.

    * NULL or empty text: all counts 0, score 0.
    * Ids must be whole numbers to be matched with labels; NULL ids match
      none. An id with labels 0 and 1 counts as 0.
    * No labelled text of either kind: the threshold is minus infinity.
    * Repeated rows each count; an empty table gives no rows. Other columns
      are not read.
    """
    label = labels.select(F.col(label_id_col).cast("long").alias("key"),
                          F.col(label_col).cast("int").alias("label")).dropna().groupBy(
        "key").agg(F.min("label").alias("label")).filter(F.col("label").isin(0, 1))
    texts = docs.select(F.col(id_col).alias("id"), F.col(id_col).cast("long").alias("key"),
                        F.col(text_col).alias("text"))
    # the labels grow with the texts: shuffled at any size, never sent whole to every task;
    # texts without an id match none and are spread by their text
    good = label.filter("label = 1").select(F.col("key").alias("_good")).hint("merge")
    spread = F.coalesce(F.col("key"), F.xxhash64("text"))
    weights = log_ratios(texts.join(
        good, (spread == F.col("_good")) & F.col("key").isNotNull(), "left").select(
        "text", F.col("_good").isNotNull().alias("trusted")))
    id_type = docs.schema[id_col].dataType.simpleString()
    scored = materialize(texts.mapInArrow(
        _score(weights), f"id {id_type}, key long, n_words long, word_chars long, n_symbols long, "
                         "n_dup_lines long, n_repeat_words long, score double"), "quality")

    hist = scored.join(label, "key").groupBy(
        F.round("score", 3).alias("score")).agg(
        F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad")).collect()
    cut = threshold([(r.score, r.good, r.bad) for r in hist])
    return scored.drop("key").withColumnRenamed("id", id_col), cut
