"""Date-addressed lake: raw JSON landings and the clean Parquet layer (IO-1..IO-6)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestmart import schemas
from nestmart.session import folder_bytes, materialize

CORRUPT = "_corrupt_record"

#: Records in one landed file at most.
RECORDS_PER_FILE = 250_000
#: Of landings and the clean layer, which stay on disk; gzip takes far longer beyond SEVEN.
GZIP_LEVEL, ZSTD_LEVEL = "SEVEN", 9


def day_path(lake: str, layer: str, date: str | dt.date, name: str, ext: str) -> str:
    """``{lake}/{layer}/YYYY/MM/DD/{name}.{ext}`` (IO-6)."""
    year, month, day = str(date).split("-")
    return f"{lake.rstrip('/')}/{layer}/{year}/{month}/{day}/{name}.{ext}"


def read_id_export(spark: SparkSession, path: str) -> DataFrame:
    """Gzipped JSON-lines id export ``(id, popularity)`` (IO-1).

    Blank lines are skipped by the JSON reader. A ``.gz`` file is not
    splittable, so it is read by one task per file; downstream top-k keeps
    only k rows per task, so no repartition is needed before it.
    """
    return spark.read.schema(schemas.ID_EXPORT).json(path)


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])


def read_raw_json(spark: SparkSession, lake: str, date: str | dt.date, name: str,
                  multi_line: bool = False) -> DataFrame:
    """One day's raw landing with its declared schema, PERMISSIVE (IO-2).

    ``multi_line`` must match the layout: ``True`` for a file holding one
    JSON array (read as a single unsplittable stream), ``False`` for
    JSON-lines (splittable). A mismatch loses records silently, so the
    layout is a parameter, never guessed. Malformed records keep their text
    in ``_corrupt_record``.
    """
    return (spark.read.schema(_with_corrupt(schemas.RAW_SCHEMAS[name]))
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("multiLine", multi_line)
            .json(day_path(lake, "raw", date, name, "json")))


def write_raw_json(df: DataFrame, lake: str, date: str | dt.date, name: str) -> str:
    """Land a batch of records for a date as gzipped JSON-lines (IO-3); returns the path.

    Field names and repeated values make up most of such text, so it is
    landed compressed. A gzipped file is read by one task: a large batch is
    cut into files of ``RECORDS_PER_FILE``.
    """
    path = day_path(lake, "raw", date, name, "json")
    (df.write.mode("overwrite").option("compression", "gzip")
     .option("zlib.compress.level", GZIP_LEVEL)
     .option("maxRecordsPerFile", RECORDS_PER_FILE).json(path))
    return path


def write_clean(df: DataFrame, lake: str, date: str | dt.date, name: str) -> str:
    """Overwrite one day's clean Parquet dataset (IO-4); returns the path."""
    path = day_path(lake, "clean", date, name, "parquet")
    (df.write.mode("overwrite").option("compression", "zstd")
     .option("parquet.compression.codec.zstd.level", ZSTD_LEVEL).parquet(path))
    return path


def read_clean(spark: SparkSession, lake: str, date: str | dt.date, name: str) -> DataFrame:
    """Read one day's clean Parquet dataset (IO-5)."""
    return spark.read.parquet(day_path(lake, "clean", date, name, "parquet"))


def clean_bytes(spark: SparkSession, lake: str, date: str | dt.date, name: str) -> int:
    """Stored size of one day's clean dataset."""
    return folder_bytes(spark, day_path(lake, "clean", date, name, "parquet"))


# Records that don't parse -------------------------------------------------------

def split_corrupt(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` of a frame read by :func:`read_raw_json`.

    ``good`` has the declared columns; ``bad`` the text of each record that is
    no JSON of the schema, the file that it came from and, as JSON, what could
    be read of it. A record whose columns can only partly be read is bad.
    The JSON reader refuses queries for the text column alone, so ``raw`` should
    be a saved copy, as :func:`quarantine` makes it.
    """
    names = [c for c in raw.columns if c != CORRUPT]
    bad = raw.select(F.col(CORRUPT).alias("record"), F.input_file_name().alias("file"),
                     F.to_json(F.struct(*names)).alias("readable"))
    return (raw.where(F.col(CORRUPT).isNull()).select(*names),
            bad.where(F.col("record").isNotNull()))


def quarantine(spark: SparkSession, lake: str, date: str | dt.date, name: str,
               multi_line: bool = False) -> DataFrame:
    """Set one landed day's bad records aside and return its good ones (IO-2).

    Bad records go to ``{lake}/quarantine/YYYY/MM/DD/{name}.parquet``
    (overwritten, so a day may be run again); a day without any leaves an
    empty dataset there, which tells it from a day not looked at. The landing
    is parsed once, into a copy in the shared scratch folder that both parts
    are read from.
    """
    good, bad = split_corrupt(materialize(
        read_raw_json(spark, lake, date, name, multi_line), f"landed-{name}"))
    bad.write.mode("overwrite").parquet(day_path(lake, "quarantine", date, name, "parquet"))
    return good


def read_quarantine(spark: SparkSession, lake: str, date: str | dt.date, name: str) -> DataFrame:
    """``(record, file, readable)`` of one day's bad records."""
    return spark.read.schema("record string, file string, readable string").parquet(
        day_path(lake, "quarantine", date, name, "parquet"))


# Several days in one dataset ----------------------------------------------------

DAY_PARTS = ("year", "month", "day")


def days_path(lake: str, layer: str, name: str) -> str:
    """``{lake}/{layer}_days/{name}``, with ``year=/month=/day=`` folders below (IO-6)."""
    return f"{lake.rstrip('/')}/{layer}_days/{name}"


def write_days(df: DataFrame, lake: str, name: str, date_col: str, layer: str = "clean") -> str:
    """Write rows to the folders of their days; days that ``df`` doesn't hold stay as they are.

    A day written again replaces that day's files. The date itself is kept as
    a column. Rows without a date are refused, as no range would ever read them.
    """
    path = days_path(lake, layer, name)
    d = F.col(date_col).cast("date")
    known = F.when(d.isNotNull(), F.year(d)).otherwise(
        F.raise_error(F.lit(f"write_days: row without {date_col}")))
    parts = df.withColumns({"year": known.cast("int"), "month": F.month(d), "day": F.dayofmonth(d)})
    (parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*DAY_PARTS).parquet(path))
    return path


def read_days(spark: SparkSession, lake: str, name: str, start: str | dt.date,
              end: str | dt.date, layer: str = "clean") -> DataFrame:
    """Rows of the days ``start``..``end``, inclusive; only those days' files are read.

    The range is a predicate on the partition columns alone, so folders
    outside it are pruned before any file is opened.
    """
    day = F.make_date(*[F.col(c) for c in DAY_PARTS])
    first, last = (F.lit(str(d)).cast("date") for d in (start, end))
    return spark.read.parquet(days_path(lake, layer, name)).where(
        day.between(first, last)).drop(*DAY_PARTS)
