"""Parallel metric arrays to one array of structs (CJ-9, JO-5, AR-8, AR-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestmart import schemas
from nestmart.functions.columns import zip_truncated
from nestmart.sources.tables import create_table_as, qualified, swap_table

LEGACY_COLUMNS = list(schemas.LEGACY_SERIES)


def restructure_metrics(legacy: DataFrame) -> DataFrame:
    """Replace the five ``array<struct<value>>`` columns by one ``metrics`` array.

    Entries are paired by position; offsets missing from any array drop out,
    so the result has the length of the shortest input, and a NULL or empty
    input array gives an empty series. All other columns pass through.
    """
    values = {name: F.col(f"`{name}`.value") for name in LEGACY_COLUMNS}
    zipped = zip_truncated(values, schemas.LEGACY_SERIES)
    metrics = F.transform(zipped, lambda z: F.struct(
        z["popularity"].alias("popularity"),
        z["vote_count"].alias("vote_count"),
        z["vote_average"].alias("vote_average"),
        z["gross"].alias("gross"),
        z["current_date"].alias("collect_date"),
    ))
    keep = [F.col(f"`{c}`") for c in legacy.columns if c not in schemas.LEGACY_SERIES]
    return legacy.select(*keep, metrics.alias("metrics"))


def restructure_table(spark: SparkSession, database: str | None, table: str = "movies",
                      buckets: int | None = None) -> None:
    """Rewrite a stored legacy table in the new shape: create side table, then swap."""
    side = f"{table}__restructured"
    new = restructure_metrics(spark.table(qualified(database, table)))
    create_table_as(new, database, side, replace=False,
                    bucket_by="movie_id" if buckets else None, buckets=buckets)
    swap_table(spark, database, side, table)
