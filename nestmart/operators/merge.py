"""Upserts as one full outer join per table (ME-1..ME-4).

A warehouse ``MERGE`` is expressed as ``stored FULL JOIN staging`` on the key,
with per-column rules for matched, stored-only and staging-only rows. The
result is a complete new version of the table; ``sources.tables`` writes it
next to the live one and swaps. Row provenance is tracked with marker columns
rather than ``key IS NOT NULL`` so that NULL-key rows, which never match,
are still inserted the way a MERGE inserts them.

Scale: the join is a single hash exchange on the key. When the stored table
is bucketed by that key (``publish`` writes it so), Spark keeps its
partitioning and only the day's staging rows are shuffled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestmart import schemas
from nestmart.functions.columns import append_series, metric_placeholder
from nestmart.operators.keys import assert_unique

# Stored columns a matched film keeps; only money and metrics change on a match.
MOVIE_STATIC = ["imdb_id", "original_title", "title", "genres", "origin_country",
                "production_companies", "release_date", "runtime", "casts", "crews"]
MOVIE_MONEY = ["opening_gross", "movie_budget"]


def _date_lit(run_date: str | dt.date | Column) -> Column:
    if isinstance(run_date, Column):
        return run_date.cast("date")
    return F.lit(str(run_date)).cast("date")


def _marked(df: DataFrame, side: str) -> DataFrame:
    return df.withColumn(f"_{side}_row", F.lit(True)).alias(side)


def merge_movies(stored: DataFrame, staging: DataFrame, run_date: str | dt.date,
                 replace_day: bool = False, check_unique: bool = True) -> DataFrame:
    """Fold one day's films into the stored table.

    - stored and staged: static columns keep the stored values; opening gross
      and budget take today's value unless it is NULL; metrics = stored ++ today.
    - stored only: metrics gain a placeholder entry for ``run_date``.
    - staged only: inserted as staged.

    With ``replace_day`` (see ``append_series``) the day may be older than what
    is stored; a film that has later entries then keeps its stored money.
    """
    if check_unique:
        assert_unique(staging, "movie_id", "staging movies")
    day = _date_lit(run_date)
    t, s = _marked(stored, "t"), _marked(staging, "s")
    joined = t.join(s, F.col("t.movie_id") == F.col("s.movie_id"), "full")
    in_t = F.coalesce(F.col("t._t_row"), F.lit(False))
    in_s = F.coalesce(F.col("s._s_row"), F.lit(False))

    out = [F.when(in_t, F.col("t.movie_id")).otherwise(F.col("s.movie_id")).alias("movie_id")]
    out += [F.when(in_t, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in MOVIE_STATIC]
    late = F.lit(False)
    if replace_day:
        late = F.coalesce(F.exists("t.metrics", lambda e: e["collect_date"] > day), late)
    out += [F.when(late, F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")))
            .otherwise(F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}"))).alias(c)
            for c in MOVIE_MONEY]
    out.append(append_series(F.col("t.metrics"), F.col("s.metrics"), in_s, day,
                             schemas.METRIC, replace_day=replace_day).alias("metrics"))
    return joined.select(*out).to(schemas.MOVIES)


def merge_movie_days(stored: DataFrame, staging: DataFrame, days: Sequence[str | dt.date],
                     day_col: str = "run_date", check_unique: bool = True) -> DataFrame:
    """Fold several days' films into the stored table, as :func:`merge_movies` day by day would.

    ``staging`` holds the films of all days with the day in ``day_col``; a day
    of ``days`` without films still gives every known film a placeholder. One
    full join for all days: a film's staged days become one sorted array (as
    many entries as days), and the fold over them runs inside the row.
    """
    if check_unique:
        assert_unique(staging, "movie_id", "staging movies", [day_col])
    # films without an id never match, each stays a row of its own
    staged = staging.withColumn("_own", F.when(F.col("movie_id").isNull(),
                                               F.monotonically_increasing_id()))
    films = staged.groupBy("movie_id", "_own").agg(F.sort_array(F.collect_list(F.struct(
        F.col(day_col).cast("date").alias("day"), *MOVIE_STATIC, *MOVIE_MONEY, "metrics"))).alias(
        "_days")).drop("_own")
    t, s = _marked(stored, "t"), _marked(films, "s")
    joined = t.join(s, F.col("t.movie_id") == F.col("s.movie_id"), "full")
    in_t = F.coalesce(F.col("t._t_row"), F.lit(False))
    seen = F.col("s._days")
    first = F.get(seen, F.lit(0))
    series = T.ArrayType(schemas.METRIC)
    empty = F.array().cast(series)

    def entries(day: Column) -> Column:
        today = F.get(F.filter(seen, lambda x: x["day"] == day), F.lit(0))
        known = in_t | F.coalesce(first["day"] < day, F.lit(False))
        return F.when(today.isNotNull(), F.coalesce(today["metrics"].cast(series), empty)).when(
            known, F.array(metric_placeholder(day)).cast(series)).otherwise(empty)

    def latest(money: str) -> Column:
        return F.aggregate(seen, F.col(f"t.{money}").cast("bigint"), lambda acc, x: F.coalesce(
            x[money].cast("bigint"), acc))

    out = [F.when(in_t, F.col("t.movie_id")).otherwise(F.col("s.movie_id")).alias("movie_id")]
    out += [F.when(in_t, F.col(f"t.{c}")).otherwise(first[c]).alias(c) for c in MOVIE_STATIC]
    out += [F.when(seen.isNull(), F.col(f"t.{c}")).otherwise(latest(c)).alias(c)
            for c in MOVIE_MONEY]
    ordered = F.array(*[_date_lit(d) for d in sorted(map(str, days))]).cast("array<date>")
    out.append(F.concat(F.coalesce(F.col("t.metrics").cast(series), empty),
                        F.flatten(F.transform(ordered, entries))).alias("metrics"))
    return joined.select(*out).to(schemas.MOVIES)


def latest_per_key(staging: DataFrame, key: str, attrs: Sequence[str],
                   day_col: str = "run_date") -> DataFrame:
    """Each key's attributes of its last day; rows without a key all stay."""
    known = staging.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.max_by(F.struct(*attrs), day_col).alias("_last")).select(key, "_last.*")
    return known.unionByName(staging.where(F.col(key).isNull()).select(key, *attrs))


def merge_dim(stored: DataFrame, staging: DataFrame, key: str, attrs: Sequence[str],
              check_unique: bool = True) -> DataFrame:
    """Person / company upsert: staged attributes overwrite, NULLs included.

    Unlike the film merge there is no coalesce: a matched row takes the staged
    value even when it is NULL. Stored-only rows stay as they are.
    """
    if check_unique:
        assert_unique(staging, key, f"staging {key}")
    t, s = _marked(stored, "t"), _marked(staging, "s")
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full")
    in_s = F.coalesce(F.col("s._s_row"), F.lit(False))
    cols = [F.when(in_s, F.col(f"s.{key}")).otherwise(F.col(f"t.{key}")).alias(key)]
    cols += [F.when(in_s, F.col(f"s.{a}")).otherwise(F.col(f"t.{a}")).alias(a) for a in attrs]
    return joined.select(*cols)


def changed_rows(stored: DataFrame, staging: DataFrame, key: str,
                 attrs: Sequence[str]) -> DataFrame:
    """Staged rows that :func:`merge_dim` would change ``stored`` by: those whose key is
    not stored, or is with other attributes. A row without a key is always one."""
    t = stored.select(F.col(key).alias("_key"), F.struct(*attrs).alias("_old"))
    joined = staging.join(t, F.col(key) == F.col("_key"), "left")
    same = F.col("_old").isNotNull() & F.struct(*attrs).eqNullSafe(F.col("_old"))
    return joined.where(~same).select(*staging.columns)


PERSON_ATTRS = ["name", "gender", "department"]
COMPANY_ATTRS = ["company_name", "company_country"]


def merge_credits(stored: DataFrame, staging: DataFrame, check_unique: bool = True) -> DataFrame:
    return merge_dim(stored, staging, "person_id", PERSON_ATTRS, check_unique).to(schemas.CREDITS)


def merge_companies(stored: DataFrame, staging: DataFrame,
                    check_unique: bool = True) -> DataFrame:
    return merge_dim(stored, staging, "company_id", COMPANY_ATTRS, check_unique).to(schemas.PRODUCTION_COMPANIES)
