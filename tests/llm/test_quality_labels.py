"""The quality model and its threshold go by every labelled text."""

from pyspark.sql import functions as F

from nestmart.llm.quality import quality_scores


def test_all_trusted_texts_count(spark):
    docs = spark.range(20_400).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("some words and w"), F.col("id")).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    scored, cut = quality_scores(docs, labels)
    # target and raw corpus are the same texts: no n-gram speaks for either
    assert scored.filter(F.abs("score") > 1e-12).count() == 0
    assert cut == float("-inf")


def test_texts_without_an_id_are_scored_and_never_trusted(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "a b"), (2, "c d")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (1, 0), (2, 1), (2, 1)],
                                   "doc_id long, quality int")
    scored, cut = quality_scores(docs, labels)
    rows = {(r.doc_id, r.n_words): r.score for r in scored.collect()}
    assert scored.count() == 4 and rows[2, 2] > cut > rows[1, 2] == rows[None, 2]
