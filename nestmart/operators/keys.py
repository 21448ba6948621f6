"""Key rules: required columns, one row per key, key uniqueness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmart.session import discard, materialize


class DuplicateKeyError(ValueError):
    """Raised when a merge source holds several rows for one key."""


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``cols`` (FI-1)."""
    return df.na.drop(how="any", subset=list(cols))


def dedupe(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """One row per key, chosen deterministically (AG-7).

    The winner is the row whose struct ``(prefer..., other columns...)`` is
    smallest, a NULL counting as larger than any value. ``min`` of a struct aggregates partially on the map side, so a
    key holding a large share of the rows is reduced to one row per input
    partition before the shuffle, instead of landing whole on one task as a
    window ``row_number`` would make it. Column order of ``df`` is kept.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    order = [c for c in prefer if c in rest] + [c for c in rest if c not in prefer]
    picked = df.groupBy(*keys).agg(
        F.min(F.struct(*(x for c in order
                         for x in (F.col(c).isNull().alias(f"_no_{c}"), c)))).alias("_pick"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_pick.{c}").alias(c)
                           for c in df.columns])


# Repeated keys that are broadcast at most.
MOST_REPEATED = 500_000


def dedupe_stored(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """The rows of :func:`dedupe`, shuffling wide rows only where their key is repeated.

    For a stored ``df``, which is read again: a first pass counts the keys
    alone, then rows of a key of their own stay where they are. With more than
    ``MOST_REPEATED`` repeated keys it is the plain :func:`dedupe`.
    """
    names = [f"_key_{i}" for i in range(len(keys))]
    again = materialize(df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).count()
                        .where(F.col("count") > 1).select(*names), "repeated-keys")
    found = again.limit(MOST_REPEATED + 1).count()
    if not 0 < found <= MOST_REPEATED:
        discard(again)
        return dedupe(df, keys, prefer) if found else df
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    alone = df.join(F.broadcast(again), same, "left_anti")
    return alone.unionByName(dedupe(df.join(F.broadcast(again), same, "left_semi"), keys, prefer))


# Sketch sizes: entries tracked for each task's fair share (the sketch errs by about
# 3.5 / tracked of the rows), least entries, and the most that the sketch allows.
TRACKED_PER_SHARE = 8
LEAST_TRACKED = 1024
MOST_TRACKED = 1_000_000


def heavy_keys(facts: DataFrame, key: str, shares: int | None = None) -> dict[object, int]:
    """Keys that hold more than a fair share of the facts, and over how many tasks to deal each.

    A fair share is one of ``shares`` equal parts (the shuffle partitions by
    default). One pass over the key column with a frequent-items sketch: its
    size is fixed, it merges map-side, and fewer than ``shares`` keys can be
    heavy, so that many at most reach the driver. A task count is a power of
    two, at most ``shares`` rounded up. NULL keys don't count, they never match.
    """
    spark = facts.sparkSession
    n = shares or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tracked = min(max(n * TRACKED_PER_SHARE, LEAST_TRACKED), MOST_TRACKED)
    keys = facts.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"))
    row = keys.agg(F.count("*").alias("n"),
                   F.expr(f"approx_top_k(_key, {min(n, tracked)}, {tracked})").alias("top")).first()
    found = {}
    for item, count in (row["top"] or []) if row is not None else []:
        if count * n > row["n"]:
            wanted = -(-count * n // row["n"])
            found[item] = 1 << (wanted - 1).bit_length()
    return found


def join_dimension(facts: DataFrame, dimension: DataFrame, key: str, spread_by: str,
                   heavy: Mapping[object, int] | None = None) -> DataFrame:
    """Inner join of facts to a dimension on ``key``; only heavy keys are dealt to several tasks.

    ``heavy`` is counted by :func:`heavy_keys` if not given (one small job).
    Without a heavy key this is the plain join: the dimension is read as it
    is stored, bucketed or small enough to broadcast. Otherwise facts of a
    heavy key get a salt that follows from ``spread_by`` (a retried task deals
    the same), and the dimension rows of these keys alone are repeated, once
    a salt. A key missed by the sketch costs time only, never rows.
    """
    heavy = heavy_keys(facts, key) if heavy is None else heavy
    if not heavy:
        return facts.join(dimension, key)
    tasks = F.lit(1)
    for n in sorted(set(heavy.values())):
        tasks = F.when(F.col(key).isin([k for k in heavy if heavy[k] == n]), n).otherwise(tasks)
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(spread_by), tasks).cast("int"))
    repeated = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), tasks - 1)))
    return salted.join(repeated, [key, "_salt"]).drop("_salt")


def duplicate_keys(df: DataFrame, key: str, *within: str) -> DataFrame:
    """Keys (non-NULL) that occur more than once (with equal ``within`` columns), and counts."""
    return (df.where(F.col(key).isNotNull()).groupBy(key, *within).count()
            .where(F.col("count") > 1))


def assert_unique(df: DataFrame, key: str, what: str = "source", within: Sequence[str] = ()) -> None:
    """Fail like a warehouse MERGE does when several source rows hit one key.

    One aggregation job with map-side partial counts; only a single offending
    row (if any) travels to the driver.
    """
    hit = duplicate_keys(df, key, *within).limit(1).collect()
    if hit:
        raise DuplicateKeyError(
            f"{what}: key {key}={hit[0][key]!r} occurs {hit[0]['count']} times")
