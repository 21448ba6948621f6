"""Catalog tables: staging, create-as, swap (IO-7..IO-10).

Tables live in a database of the session catalog; their files go under the
warehouse (or the database location), which on a cluster is shared storage.
A table is never read and overwritten by one plan: new versions are written
under a side name and swapped in.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAGED = ("movies", "credits", "production_companies")
PREVIOUS = "__prev"
PUBLISHED = "nestmart.published"


#: Partition column of a key-partitioned table, and the property with its bucket count.
KEY_BUCKET = "key_bucket"
KEY_BUCKETS = "nestmart.key_buckets"
#: Folder below the database's with the files of a key-partitioned table.
FILES = "__files"


def qualified(database: str | None, table: str) -> str:
    return f"`{database}`.`{table}`" if database else f"`{table}`"


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    name = f"`{database}`"
    if location:
        spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db) LOCATION :at",
                  args={"db": name, "at": location})
    else:
        spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db)", args={"db": name})


def drop_table(spark: SparkSession, database: str | None, table: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": qualified(database, table)})


def table_exists(spark: SparkSession, database: str | None, table: str) -> bool:
    name = f"{database}.{table}" if database else table
    return spark.catalog.tableExists(name)


def table_details(spark: SparkSession, database: str | None, table: str) -> dict[str, str]:
    """``DESCRIBE TABLE EXTENDED`` detail rows (Location, Num Buckets, ...) as a dict."""
    rows = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t)",
                     args={"t": qualified(database, table)}).collect()
    return {r.col_name.strip(): (r.data_type or "").strip() for r in rows if r.col_name}


def bucket_count(spark: SparkSession, database: str | None, table: str,
                 details: dict[str, str] | None = None) -> int | None:
    details = details if details is not None else table_details(spark, database, table)
    value = details.get("Num Buckets")
    return int(value) if value and value.isdigit() else None


def stored_bytes(spark: SparkSession, database: str | None, table: str,
                 details: dict[str, str] | None = None) -> int:
    """Bytes under the table's location (Hadoop content summary, any file system).

    The files of a key-partitioned table lie in several folders side by side.
    """
    details = details if details is not None else table_details(spark, database, table)
    location = details.get("Location")
    if not location:
        return 0
    parent = location.rstrip("/").rpartition("/")[0]
    fs, path = _file_system(spark, parent if parent.endswith(FILES) else location)
    return int(fs.getContentSummary(path).getLength()) if fs.exists(path) else 0


def _file_system(spark: SparkSession, location: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _delete(spark: SparkSession, location: str) -> None:
    fs, path = _file_system(spark, location)
    fs.delete(path, True)


def create_table_as(df: DataFrame, database: str | None, table: str, replace: bool = True,
                    bucket_by: str | None = None, buckets: int | None = None,
                    sort_by: Sequence[str] = (), append: bool = False) -> str:
    """CREATE [OR REPLACE] TABLE ... AS (IO-9), optionally bucketed by a key.

    With ``append`` the rows are added to the table, which must be laid out so.

    Bucketing by the merge key lets later joins on it keep the table's
    partitioning instead of shuffling it again.
    """
    mode = "append" if append else "overwrite" if replace else "errorifexists"
    writer = df.write.mode(mode).format("parquet").option("compression", "zstd")
    if bucket_by and buckets:
        writer = writer.bucketBy(buckets, bucket_by)
        if sort_by:
            writer = writer.sortBy(*sort_by)
    name = qualified(database, table)
    writer.saveAsTable(name)
    return name


def write_staging(df: DataFrame, database: str | None, table: str, key: str | None = None,
                  buckets: int | None = None, append: bool = False) -> str:
    """Overwrite ``staging_<table>`` (IO-7), or add a further day's rows to it.

    With ``key`` and ``buckets`` it is laid out like a table that is bucketed
    so: one sorted file for each bucket (and write). The merge join of a single
    day then needs neither an exchange nor a sort, that of several no exchange.
    """
    if not (key and buckets):
        return create_table_as(df, database, f"staging_{table}", append=append)
    return create_table_as(df.repartition(buckets, key), database, f"staging_{table}",
                           bucket_by=key, buckets=buckets, sort_by=[key], append=append)


def read_staging(spark: SparkSession, database: str | None, table: str) -> DataFrame:
    return spark.table(qualified(database, f"staging_{table}"))


def drop_staging(spark: SparkSession, database: str | None,
                 tables: Iterable[str] = STAGED) -> None:
    """Drop the staging tables if present (IO-8)."""
    for t in tables:
        drop_table(spark, database, f"staging_{t}")


def swap_table(spark: SparkSession, database: str | None, new: str, live: str) -> None:
    """Put ``new`` in the place of ``live`` (IO-10): ``live`` steps aside, ``new`` is
    renamed, and only then the old version is dropped.

    Not atomic, but no statement leaves fewer than one whole version:
    :func:`recover_table` finishes or undoes a swap that broke off.
    """
    recover_table(spark, database, live)
    if table_exists(spark, database, live):
        _rename(spark, database, live, f"{live}{PREVIOUS}")
    _rename(spark, database, new, live)
    drop_version(spark, database, f"{live}{PREVIOUS}")


def drop_version(spark: SparkSession, database: str | None, table: str) -> None:
    """Drop one version of a table, if present; a key-partitioned one with its files, which
    don't go with the table by themselves."""
    files = (key_partitions(spark, database, table).values()
             if key_buckets(spark, database, table) else [])
    drop_table(spark, database, table)
    for location in files:
        _delete(spark, location)


def _rename(spark: SparkSession, database: str | None, old: str, new: str) -> None:
    spark.sql("ALTER TABLE IDENTIFIER(:old) RENAME TO IDENTIFIER(:new)",
              args={"old": qualified(database, old), "new": qualified(database, new)})


def recover_table(spark: SparkSession, database: str | None, live: str) -> None:
    """Make ``live`` whole again after a swap that broke off.

    The old version stands aside only while its successor is complete: without
    ``live`` the old version comes back (the day is then merged again); with
    ``live`` the swap was done and the old version goes.
    """
    if not table_exists(spark, database, f"{live}{PREVIOUS}"):
        return
    if table_exists(spark, database, live):
        drop_version(spark, database, f"{live}{PREVIOUS}")
    else:
        _rename(spark, database, f"{live}{PREVIOUS}", live)


def day_ranges(days: Iterable[str]) -> str:
    """Days as ascending ranges, ``2024-01-01..2024-01-31,2024-02-02``: short however
    many days there are, as long as few are missing."""
    out: list[list[dt.date]] = []
    for day in sorted({dt.date.fromisoformat(d) for d in days}):
        if out and day - out[-1][1] == dt.timedelta(days=1):
            out[-1][1] = day
        else:
            out.append([day, day])
    return ",".join(f"{a}..{b}" if a != b else f"{a}" for a, b in out)


def days_of(ranges: str | None) -> set[str]:
    """The days that :func:`day_ranges` wrote."""
    days: set[str] = set()
    for part in (ranges or "").split(","):
        if part:
            first, _, last = part.partition("..")
            a, b = dt.date.fromisoformat(first), dt.date.fromisoformat(last or first)
            days |= {str(a + dt.timedelta(days=k)) for k in range((b - a).days + 1)}
    return days


def set_published(spark: SparkSession, database: str | None, table: str,
                  *run_dates: str) -> None:
    """Record in the table's properties which days it was published for."""
    set_property(spark, database, table, PUBLISHED, day_ranges(run_dates))


def set_property(spark: SparkSession, database: str | None, table: str, key: str,
                 value: str) -> None:
    """Set one of our table properties; ``key`` is a constant of this module."""
    spark.sql(f"ALTER TABLE IDENTIFIER(:t) SET TBLPROPERTIES ('{key}' = :value)",
              args={"t": qualified(database, table), "value": value})


def table_property(spark: SparkSession, database: str | None, table: str, key: str) -> str | None:
    if not table_exists(spark, database, table):
        return None
    rows = spark.sql("SHOW TBLPROPERTIES IDENTIFIER(:t)",
                     args={"t": qualified(database, table)}).collect()
    return {r.key: r.value for r in rows}.get(key)


def published_days(spark: SparkSession, database: str | None, table: str) -> set[str]:
    """All days that the table was published for."""
    return days_of(table_property(spark, database, table, PUBLISHED))


def published_day(spark: SparkSession, database: str | None, table: str) -> str | None:
    """The latest of them."""
    return max(published_days(spark, database, table), default=None)


# Key-partitioned tables ----------------------------------------------------------
#
# A table partitioned by a hash of its key, so that an upsert rewrites only the
# partitions it changes. New partition files are written beside the old ones and
# the catalog entry of the partition is then pointed at them: no partition is
# ever half written or missing, and the others keep their files.

def with_key_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` with the partition of each row's key (a NULL key has one, too)."""
    return df.withColumn(KEY_BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def key_buckets(spark: SparkSession, database: str | None, table: str) -> int | None:
    """Bucket count of a key-partitioned table; None for any other."""
    value = table_property(spark, database, table, KEY_BUCKETS)
    return int(value) if value else None


def write_key_files(df: DataFrame, database: str | None, table: str, key: str,
                    buckets: int) -> str:
    """Write rows with their ``KEY_BUCKET`` to a new folder, one sorted file a bucket."""
    spark = df.sparkSession
    home = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    folder = f"{home.rstrip('/')}/{table}{FILES}/{uuid.uuid4().hex[:12]}"
    (df.repartition(max(buckets, 1), KEY_BUCKET).sortWithinPartitions(KEY_BUCKET, key)
     .write.partitionBy(KEY_BUCKET).option("compression", "zstd").parquet(folder))
    return folder


def create_key_partitioned(df: DataFrame, database: str | None, table: str, key: str,
                           buckets: int, live: str) -> None:
    """Create ``table`` from ``df``, partitioned by key, files in the folder of ``live``."""
    spark = df.sparkSession
    folder = write_key_files(with_key_bucket(df, key, buckets), database, live, key, buckets)
    drop_version(spark, database, table)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"CREATE TABLE IDENTIFIER(:t) ({fields}, {KEY_BUCKET} int) USING parquet "
              f"PARTITIONED BY ({KEY_BUCKET}) LOCATION :at",
              args={"t": qualified(database, table), "at": folder})
    spark.catalog.recoverPartitions(qualified(database, table))
    set_property(spark, database, table, KEY_BUCKETS, str(buckets))


def key_partitions(spark: SparkSession, database: str | None, table: str,
                   wanted: Iterable[int] | None = None) -> dict[int, str]:
    """Location of each partition (of the ``wanted`` ones that exist)."""
    name = qualified(database, table)
    rows = spark.sql("SHOW PARTITIONS IDENTIFIER(:t)", args={"t": name}).collect()
    known = {int(r[0].partition("=")[2]) for r in rows}
    out = {}
    for k in sorted(known if wanted is None else known & set(wanted)):
        described = spark.sql(
            f"DESCRIBE TABLE EXTENDED IDENTIFIER(:t) PARTITION ({KEY_BUCKET} = :k)",
            args={"t": name, "k": k}).collect()
        out[k] = next(r.data_type for r in described if r.col_name.strip() == "Location")
    return out


def point_partitions(spark: SparkSession, database: str | None, table: str, folder: str,
                     changed: Sequence[int]) -> None:
    """Point the ``changed`` partitions, in this order, at their files below ``folder``.

    Each is one catalog change, so a reader sees a partition's old rows or its
    new ones. The files they had are deleted at the end.
    """
    name = qualified(database, table)
    old = key_partitions(spark, database, table, changed)
    for k in changed:
        partition = f"PARTITION ({KEY_BUCKET} = :k)"
        change = (f"{partition} SET LOCATION :at" if k in old
                  else f"ADD {partition} LOCATION :at")
        spark.sql(f"ALTER TABLE IDENTIFIER(:t) {change}",
                  args={"t": name, "k": k, "at": f"{folder}/{KEY_BUCKET}={k}"})
    spark.catalog.refreshTable(name)
    for location in old.values():
        _delete(spark, location)
