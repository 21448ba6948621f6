"""Process every landed day exactly once (the daily schedule as a stream).

The original runs the day's job from a scheduler, once per date, without
catch-up runs. Here the landing step writes a one-row marker
``{lake}/landed/<date>/`` after the day's three raw datasets, and a
Structured Streaming query over the markers runs the day's job in
``foreachBatch``. The stream's checkpoint (``{lake}/_stream/<database>``
unless another is given, so every launch finds it again) records which markers were consumed, so each day is
published once; ``trigger(availableNow=True)`` processes whatever has landed
and stops, which suits a periodic launch.

A micro-batch that fails is replayed from the checkpoint. To keep the replay
from appending a second metrics entry for the same date, days are published
with ``replace_day=True``: stored entries of the run date are replaced, not
duplicated. Days of one batch run in date order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from nestmart.plans.job import run_day
from nestmart.sources.tables import STAGED, table_exists

MARKER_DIR = "landed"
MARKER_SCHEMA = T.StructType([T.StructField("run_date", T.StringType())])


def mark_landed(spark: SparkSession, lake_root: str, run_date: str | dt.date) -> str:
    """Write the day's landing marker; call after its raw datasets are complete."""
    path = f"{lake_root.rstrip('/')}/{MARKER_DIR}/{run_date}"
    spark.createDataFrame([(str(run_date),)], MARKER_SCHEMA).coalesce(1).write.mode(
        "overwrite").json(path)
    return path


def landed_days(spark: SparkSession, lake_root: str) -> DataFrame:
    """Streaming frame of landing markers."""
    return (spark.readStream.schema(MARKER_SCHEMA)
            .json(f"{lake_root.rstrip('/')}/{MARKER_DIR}/*"))


def process_landed_days(spark: SparkSession, lake_root: str, database: str | None,
                        checkpoint: str | None = None, multi_line: bool = False,
                        buckets: int | None = None) -> str:
    """Publish every day landed since the last run, then stop; returns the checkpoint."""
    checkpoint = checkpoint or f"{lake_root.rstrip('/')}/_stream/{database or 'default'}"

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        # A batch holds one marker row per landed day: a handful of dates.
        dates = sorted({r.run_date for r in batch.select("run_date").distinct().collect()})
        for date in dates:
            run_day(batch.sparkSession, lake_root, date, database, multi_line=multi_line,
                    buckets=buckets, replace_day=True)

    query = (landed_days(spark, lake_root).writeStream
             .foreachBatch(run_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    # Batches run in the stream's own session; drop its stale file listings here.
    for table in STAGED:
        if table_exists(spark, database, table):
            spark.catalog.refreshTable(f"{database}.{table}" if database else table)
    return checkpoint
