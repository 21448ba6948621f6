"""Top-k selection and two-pass response reconciliation (TK-1, FI-7, SE-2, SE-3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_ids(df: DataFrame, k: int = 10_000, score: str = "popularity",
            key: str = "id") -> DataFrame:
    """The ``k`` keys with the highest score, ties broken by the smaller key.

    ``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: every task
    keeps only its own top k and a single final merge sees k rows per task,
    so the full input is never sorted. The limit is the feature here.
    """
    return (df.where(F.col(key).isNotNull())
            .orderBy(F.col(score).desc_nulls_last(), F.col(key).asc())
            .limit(k)
            .select(key, score))


# What marks a response as failed, per landed dataset.
def failed_response(dataset: str) -> Column:
    """Predicate of a failed response: no popularity, no cast, or a blank worldwide gross."""
    return {"movie_details": F.col("popularity").isNull(),
            "movie_credits": F.col("cast").isNull(),
            "box_office": F.col("worldwide_gross") == ""}[dataset]


def split_responses(df: DataFrame, failed: Column) -> tuple[DataFrame, DataFrame]:
    """(ok, failed) by a sentinel predicate; NULL predicate counts as ok."""
    is_failed = F.coalesce(failed, F.lit(False))
    return df.where(~is_failed), df.where(is_failed)


def reconcile_strict(first: DataFrame, retry: DataFrame, failed: Column) -> DataFrame:
    """First-pass successes plus retry successes; keys failing twice vanish."""
    ok_first, _ = split_responses(first, failed)
    ok_retry, _ = split_responses(retry, failed)
    return ok_first.unionByName(ok_retry)


def reconcile_keep(first: DataFrame, retry: DataFrame, failed: Column) -> DataFrame:
    """First-pass successes plus every retry row, failed or not."""
    ok_first, _ = split_responses(first, failed)
    return ok_first.unionByName(retry)


def to_retry(first: DataFrame, retry: DataFrame, key: str, failed: Column) -> DataFrame:
    """The rows of ``retry`` whose key failed in the first pass; settled keys go before any
    costly work on them."""
    _, again = split_responses(first, failed)
    return retry.join(again.select(key).distinct(), key, "left_semi").select(*retry.columns)


def settle(first: DataFrame, retry: DataFrame, key: str, failed: Column) -> DataFrame:
    """Both passes as one: first-pass successes, and for each failed key its retried rows,
    failed again or not; a failed key that was not retried keeps its first row.

    ``retry`` holds rows of failed keys only (:func:`to_retry`). Rows without
    a key match no other and stay.
    """
    ok, again = split_responses(first, failed)
    left = again.join(retry.select(key).distinct(), key, "left_anti").select(*first.columns)
    return ok.unionByName(retry).unionByName(left)
