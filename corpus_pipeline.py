"""The training-data pipeline: five stages over ``documents``, each written as Parquet.

Toxic documents go; lines that an earlier line matches go; of each group of
near duplicates one document stays; contaminated
documents go; what is left is encoded.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestmart.llm.decontaminate import decontaminate, hit_words, is_contaminated
from nestmart.llm.line_dedup import drop_lines, line_dedup
from nestmart.llm.pieces import encode
from nestmart.llm.simhash import simhash_groups
from nestmart.llm.toxicity import drop_toxic, fit_severity
from nestmart.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic is below one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return drop_toxic(docs, fit_severity(docs, labels))


def unused(docs: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    return [next(n for n in (name + "_" * k for k in count()) if n.lower() not in taken)
            for name in names]


def same_row(own_id: str, own_mark: str) -> Column:
    """The row of documents has this id, or none either, and a text of this hash."""
    return F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.xxhash64("text") == F.col(own_mark))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier line matches; n_chars, if there, follows.

    Rows that share an id, or have none, are told apart by the hash of their text.
    """
    own_id, mark, removed = unused(docs, "own_id", "own_mark", "own_removed")
    gone = line_dedup(docs, mark_col=mark).filter(F.size("removed") > 0).dropDuplicates(
        ["doc_id", mark]).select(F.col("doc_id").alias(own_id), mark,
                                 F.col("removed").alias(removed))
    joined = docs.join(gone, same_row(own_id, mark), "left")
    left = joined.withColumn("text", F.when(F.col(removed).isNull(), F.col("text")).otherwise(
        drop_lines(F.col("text"), F.col(removed))))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.select([F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group: that with the smallest id, then the smallest text hash.

    Rows that share an id, or have none, are told apart by the hash of their
    text, and come after those with an id. Of rows with equal id and text one stays.
    """
    own_id, mark = unused(docs, "own_id", "own_mark")
    found = materialize(simhash_groups(docs, mark_col=mark).select(
        F.col("doc_id").alias(own_id), mark, "stays"), "near-duplicates")
    rows = docs.join(found.filter(~F.col("stays")).select(own_id, mark).distinct(),
                     same_row(own_id, mark), "left_anti")
    again = materialize(found.filter("stays").groupBy(own_id, mark).count().filter(
        "count > 1").select(own_id, mark), "near-duplicates")
    repeated = rows.join(again, same_row(own_id, mark), "left_semi").withColumn(
        mark, F.xxhash64("text")).dropDuplicates(["doc_id", mark]).drop(mark)
    return rows.join(again, same_row(own_id, mark), "left_anti").unionByName(repeated)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items.

    Rows that share an id, or have none, are told apart by the hash of their text.
    """
    own_id, mark = unused(docs, "own_id", "own_mark")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = materialize(decontaminate(docs, items, mark_col=mark), "contaminated")
    gone = found.filter(is_contaminated(hit_words("spans"), F.col("n_words"))).select(
        F.col("doc_id").alias(own_id), mark).distinct()
    return docs.join(gone, same_row(own_id, mark), "left_anti")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document."""
    return encode(docs).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity), ("line_dedup", lines), ("near_duplicates", near_duplicates),
    ("decontamination", benchmark), ("pieces", pieces)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
