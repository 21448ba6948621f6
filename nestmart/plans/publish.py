"""Publish one day into the warehouse tables (CJ-8, ME-1..ME-4).

For each of ``movies``, ``credits``, ``production_companies``: read the live
table (or start empty), merge the day's staging table into it, and put the
result in its place once all three are written; then drop the staging tables.

Every film changes every day (its series grows), so ``movies`` is written
whole as ``movies__next``, bucketed by the key, and swapped in. The two
dimensions are partitioned by a hash of the key; only partitions with changed
rows are written, to new files that their catalog entries are then pointed at.
Live files are never updated in place, so a failed day leaves the live tables
untouched; a retried task rewrites its own output files only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestmart import schemas
from nestmart.operators import merge
from nestmart.operators.keys import assert_unique
from nestmart.plans.concurrent import run_all
from nestmart.session import materialize, shuffles_removed
from nestmart.sources import tables

#: Key and attributes of the tables that take a row's last attributes.
DIMENSIONS = {
    "credits": ("person_id", merge.PERSON_ATTRS),
    "production_companies": ("company_id", merge.COMPANY_ATTRS),
}


# Bucket sizing: a bucket is one merge task's share of the stored table.
TARGET_BUCKET_BYTES = 256 * 1024 * 1024
GROW_FACTOR = 4


def default_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def choose_buckets(spark: SparkSession, database: str | None, table: str,
                   requested: int | None) -> int:
    """Bucket count for the next version of ``table``.

    An explicit count wins. Otherwise the stored table keeps its own count, so
    the daily merge stays aligned with its layout whatever the session's
    shuffle setting is, and doubles it only once buckets have grown beyond
    ``GROW_FACTOR`` x ``TARGET_BUCKET_BYTES`` (the metrics series grows every
    day). A new table starts at the session's shuffle partition count.
    """
    if requested:
        return requested
    if not tables.table_exists(spark, database, table):
        return default_buckets(spark)
    details = tables.table_details(spark, database, table)
    current = (tables.bucket_count(spark, database, table, details)
               or tables.key_buckets(spark, database, table) or default_buckets(spark))
    size = tables.stored_bytes(spark, database, table, details)
    while size / current > GROW_FACTOR * TARGET_BUCKET_BYTES:
        current *= 2
    return current


def stored_or_empty(spark: SparkSession, database: str | None, table: str) -> DataFrame:
    if tables.table_exists(spark, database, table):
        return spark.table(tables.qualified(database, table)).select(
            *schemas.WAREHOUSE_SCHEMAS[table].fieldNames())
    return spark.createDataFrame([], schemas.WAREHOUSE_SCHEMAS[table])


def stage_day(staging: dict[str, DataFrame], database: str | None,
              buckets: int | None = None, append: bool = False, parts: int = 1) -> None:
    """Write the day's three staging tables (IO-7), side by side.

    Each is bucketed and sorted as the next version of its table will be.
    With ``append`` the day is added to the days that are staged already.
    Films are staged in ``parts``, each with every so many buckets, one after
    another: shuffle files stand for one part at a time, and a bucket's rows
    are still written at once. The tables of a day cut so don't go side by
    side either.
    """
    def write(table: str, df: DataFrame) -> None:
        key = schemas.KEYS[table]
        n = choose_buckets(df.sparkSession, database, table, buckets)
        cuts = min(parts, n) if table == "movies" else 1
        bucket = F.pmod(F.hash(key), F.lit(n))  # as Spark buckets rows
        for k in range(cuts):
            rows = df.where(bucket % cuts == k) if cuts > 1 else df
            tables.write_staging(rows, database, table, key, n, append or k > 0)

    run_all({t: (lambda df=df, t=t: write(t, df)) for t, df in staging.items()},
            max_workers=1 if parts > 1 else 4)


#: Lets a scan of one sorted file per bucket tell the planner its order.
SCAN_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"


@contextmanager
def sorted_scans(spark: SparkSession) -> Iterator[None]:
    """Within it, joins of tables that are bucketed and sorted by the key don't sort again."""
    before = spark.conf.get(SCAN_ORDER, None)
    spark.conf.set(SCAN_ORDER, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SCAN_ORDER)
        else:
            spark.conf.set(SCAN_ORDER, before)


def _next_movies(spark: SparkSession, database: str | None, days: list[str],
                 fold: Callable[[DataFrame, DataFrame], DataFrame],
                 buckets: int | None) -> Callable[[], None]:
    """Write the next version of ``movies`` beside the live one; returns the swap."""
    staged = tables.read_staging(spark, database, "movies")
    n = tables.bucket_count(spark, database, "staging_movies") or choose_buckets(
        spark, database, "movies", buckets)
    key = schemas.KEYS["movies"]
    tables.create_table_as(fold(stored_or_empty(spark, database, "movies"), staged), database,
                           "movies__next", bucket_by=key, buckets=n, sort_by=[key])
    tables.set_published(spark, database, "movies__next", *days,
                         *tables.published_days(spark, database, "movies"))
    return lambda: tables.swap_table(spark, database, "movies__next", "movies")


def _next_dimension(spark: SparkSession, database: str | None, table: str, days: list[str],
                    staged: DataFrame, buckets: int | None) -> Callable[[], None]:
    """Write the partitions of a dimension that the staged rows change; returns the switch.

    Staged rows equal to what is stored change nothing, so a day rewrites the
    partitions of its new and changed keys only; the others keep their files.
    The whole table is written where it is new, not key-partitioned yet or
    changes its bucket count. The list of changed partitions (at most the
    bucket count) is all that reaches the driver.

    A switch that broke off is finished by running the day again: changed
    partitions have nothing left to change. Rows without a key are inserted
    each time, so theirs is switched last, right before the day is recorded.
    """
    key, attrs = DIMENSIONS[table]
    n = choose_buckets(spark, database, table, buckets)
    done = [*days, *tables.published_days(spark, database, table)]
    stored = stored_or_empty(spark, database, table)
    schema = schemas.WAREHOUSE_SCHEMAS[table]
    if tables.key_buckets(spark, database, table) != n:
        whole = merge.merge_dim(stored, staged, key, attrs, check_unique=False).to(schema)
        tables.create_key_partitioned(whole, database, f"{table}__next", key, n, table)
        tables.set_published(spark, database, f"{table}__next", *done)
        return lambda: tables.swap_table(spark, database, f"{table}__next", table)

    changes = materialize(tables.with_key_bucket(
        merge.changed_rows(stored, staged, key, attrs).to(schema), key, n), f"changes-{table}")
    per_bucket = changes.groupBy(tables.KEY_BUCKET).agg(
        F.max(F.col(key).isNull()).alias("without_key")).collect()
    changed = [r[0] for r in sorted(per_bucket, key=lambda r: (r.without_key, r[0]))]
    folder = None
    if changed:
        live = spark.table(tables.qualified(database, table)).where(
            F.col(tables.KEY_BUCKET).isin(changed)).select(*schema.fieldNames())
        merged = merge.merge_dim(live, changes, key, attrs, check_unique=False).to(schema)
        folder = tables.write_key_files(tables.with_key_bucket(merged, key, n), database, table,
                                        key, len(changed))

    def switch() -> None:
        if folder:
            tables.point_partitions(spark, database, table, folder, changed)
        tables.set_published(spark, database, table, *done)
    return switch


def _publish(spark: SparkSession, database: str | None, todo: list[str], days: list[str],
             fold_movies: Callable[[DataFrame, DataFrame], DataFrame],
             dimension_rows: Callable[[str, DataFrame], DataFrame],
             buckets: int | None) -> None:
    """Merge the staged tables of ``todo``, then swap all in; record ``days`` in each.

    The merges are independent and run side by side; all must succeed before any swap.
    """
    def prepare(table: str) -> Callable[[], None]:
        if table == "movies":
            return _next_movies(spark, database, days, fold_movies, buckets)
        staged = dimension_rows(table, tables.read_staging(spark, database, table))
        return _next_dimension(spark, database, table, days, staged, buckets)

    with sorted_scans(spark):
        switches = run_all({t: (lambda t=t: prepare(t)) for t in todo})
    for table in todo:
        switches[table]()


def publish_staged(spark: SparkSession, database: str | None, run_date: str | dt.date,
                   buckets: int | None = None, replace_day: bool = False,
                   keep_staging: bool = False) -> None:
    """Merge the staged day into the live tables, swap, drop staging (CJ-8).

    A day that broke off can be run again: swaps that broke off are undone
    first, and a table that already carries the day, its last or an older one,
    is left as it is (with ``replace_day`` it is merged again, replacing the
    day's entries).
    """
    for table in tables.STAGED:
        tables.recover_table(spark, database, table)
    todo = [t for t in tables.STAGED
            if replace_day or str(run_date) not in tables.published_days(spark, database, t)]

    def dimension_rows(table: str, staged: DataFrame) -> DataFrame:
        key = DIMENSIONS[table][0]
        assert_unique(staged, key, f"staging {key}")
        return staged

    _publish(spark, database, todo, [str(run_date)],
             lambda stored, staged: merge.merge_movies(stored, staged, run_date, replace_day),
             dimension_rows, buckets)
    if not keep_staging:
        tables.drop_staging(spark, database)


def publish_day(spark: SparkSession, staging: dict[str, DataFrame], database: str | None,
                run_date: str | dt.date, buckets: int | None = None,
                replace_day: bool = False, parts: int = 1) -> None:
    """Stage the day's frames, then merge, swap and clean up."""
    with shuffles_removed(spark):
        stage_day(staging, database, buckets, parts=parts)
        publish_staged(spark, database, run_date, buckets=buckets, replace_day=replace_day)


def publish_days(spark: SparkSession, stagings: Mapping[str, dict[str, DataFrame]],
                 database: str | None, buckets: int | None = None, parts: int = 1) -> None:
    """Publish several days in one pass: one merge and one swap a table.

    ``stagings`` has each day's three staging frames by date. The result is
    that of publishing them one after another in date order: films gain an
    entry or a placeholder for every day, money keeps its last known value,
    persons and companies take their last day's attributes. Days that a table
    already carries are left out of it. The days are staged one after another,
    so the shuffle files of one day (of one of its ``parts``, see
    :func:`stage_day`) stand at a time.
    """
    for table in tables.STAGED:
        tables.recover_table(spark, database, table)
    days = {t: sorted(set(stagings) - tables.published_days(spark, database, t))
            for t in tables.STAGED}
    todo = [t for t in tables.STAGED if days[t]]

    def dimension_rows(table: str, staging: DataFrame) -> DataFrame:
        key, attrs = DIMENSIONS[table]
        assert_unique(staging, key, f"staging {key}", ["run_date"])
        return merge.latest_per_key(staging, key, attrs)

    with shuffles_removed(spark):
        tables.drop_staging(spark, database)
        for day in sorted(stagings):
            rows = {t: stagings[day][t].withColumn("run_date", F.lit(day).cast("date"))
                    for t in todo if day in days[t]}
            stage_day(rows, database, buckets, append=True, parts=parts)
        for group in sorted({tuple(days[t]) for t in todo}):
            _publish(spark, database, [t for t in todo if tuple(days[t]) == group], list(group),
                     lambda stored, films: merge.merge_movie_days(stored, films, list(group)),
                     dimension_rows, buckets)
    tables.drop_staging(spark, database)
