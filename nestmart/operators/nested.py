"""Nested shaping: collect rows into sorted arrays of structs, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def collect_sorted(df: DataFrame, key: str, fields: Sequence[str], sort_by: Sequence[str],
                   name: str) -> DataFrame:
    """``key, name: array<struct<fields>>`` with entries sorted by ``sort_by`` (AG-6).

    The reference collects in arrival order, which is arbitrary; sorting makes
    the arrays reproducible, and the reports group by whole arrays. Sorting is
    done on a struct whose leading fields are the sort keys (NULLs first, then
    the remaining fields), then the struct is rebuilt with the declared field
    order. ``collect_list`` aggregates partially before the shuffle; the array
    size per key is bounded by the data model (one film's cast or crew).
    """
    fields = list(fields)
    lead = list(sort_by) + [f for f in fields if f not in sort_by]
    collected = df.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(*lead))).alias("_sorted"))
    return collected.select(
        key,
        F.transform("_sorted", lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias(name),
    )


def sorted_entries(arr: Column, fields: Sequence[str], sort_by: Sequence[str]) -> Column:
    """The array's structs reduced to ``fields`` and sorted as :func:`collect_sorted` sorts.

    For entries that already stand in one row: no explode, no shuffle and no
    collected list. An empty or NULL array gives NULL, as a key without rows
    does in a left join to collected arrays.
    """
    lead = list(sort_by) + [f for f in fields if f not in sort_by]
    ordered = F.sort_array(F.transform(arr, lambda x: F.struct(*[x[f].alias(f) for f in lead])))
    return F.when(F.size(arr) > 0, F.transform(
        ordered, lambda x: F.struct(*[x[f].alias(f) for f in fields])))


def explode_entries(df: DataFrame, keep: Sequence[str], arr: str) -> DataFrame:
    """One row per array entry with the struct flattened to columns (AR-4, PR-4).

    Rows with a NULL or empty array produce nothing, like a lateral UNNEST.
    """
    return df.select(*keep, F.inline(arr))


def explode_with_position(df: DataFrame, keep: Sequence[str], arr: str,
                          pos_name: str = "pos") -> DataFrame:
    """Like ``explode_entries`` plus the 0-based position in the array."""
    return (df.select(*keep, F.posexplode(arr).alias(pos_name, "_entry"))
            .select(*keep, pos_name, "_entry.*"))
