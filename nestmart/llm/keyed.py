"""Rows of a table of texts, told apart by id and, only where ids repeat, by text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows without an id come after all others.
NO_ID = (1 << 63) - 1


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, mark, text): key orders the rows; mark differs where rows share a key
    and not the text, and is 0 for all rows if there are none such."""
    rows = docs.select(F.col(id_col).alias("id"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"),
                       F.xxhash64(F.col(text_col)).alias("mark"), F.col(text_col).alias("text"))
    shared = rows.groupBy("key").agg(F.min("mark").alias("a"), F.max("mark").alias("b")).filter(
        "a <> b").limit(1).count()
    return rows if shared else rows.withColumn("mark", F.lit(0).cast("long"))
