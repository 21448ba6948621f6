"""One daily run: raw landing → clean layer → staging → warehouse (IO-12).

The run date, lake root and database are parameters; nothing is formatted
into SQL text. The clean layer is written and read back, as in the
original two-job split, which also cuts the lineage between the steps.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from nestmart.operators.keys import dedupe_stored
from nestmart.plans.clean import (clean_box_office, clean_cast, clean_crew, cut_credits,
                                  finish_details, nest_credits, typed_credits, typed_details)
from nestmart.plans.concurrent import run_all
from nestmart.plans.model import model_day
from nestmart.plans.publish import publish_day, publish_days
from nestmart.session import discard, materialize, shuffles_removed
from nestmart.sources import lake

RAW = ("movie_details", "movie_credits", "box_office")
CLEAN = ("movie_details", "crew_of_movies", "cast_of_movies", "credits_of_movies", "box_office")


def run_clean(spark: SparkSession, lake_root: str, run_date: str | dt.date,
              multi_line: bool = False, quarantine: bool = False) -> None:
    """Clean one landed day into the clean layer (five Parquet datasets).

    The typed details and credits are saved (packed scratch copies, removed at
    the end), so the day's JSON is parsed once; both are de-duplicated from
    there, without a shuffle of rows whose key is not repeated, and the
    credits feed the cast, the crew and the nested output. With ``quarantine``
    records that don't parse are set aside first (``lake.quarantine``);
    otherwise what can be read of them goes through the cleaning rules.
    """
    read = lake.quarantine if quarantine else lake.read_raw_json
    raw = {n: read(spark, lake_root, run_date, n, multi_line) for n in RAW}
    with shuffles_removed(spark):
        saved = run_all({
            "details": lambda: materialize(typed_details(raw["movie_details"]), "typed-details"),
            "credits": lambda: materialize(typed_credits(raw["movie_credits"]), "typed-credits")})
        try:
            one = run_all({"details": lambda: dedupe_stored(saved["details"], ["id"]),
                           "credits": lambda: dedupe_stored(saved["credits"], ["movie_id"])})
            credits = cut_credits(one["credits"])
            clean = {
                "movie_details": finish_details(one["details"]),
                "crew_of_movies": clean_crew(credits),
                "cast_of_movies": clean_cast(credits),
                "credits_of_movies": nest_credits(credits),
                "box_office": clean_box_office(raw["box_office"]),
            }
            run_all({name: (lambda df=df, name=name: lake.write_clean(df, lake_root, run_date,
                                                                      name))
                     for name, df in clean.items()})
        finally:
            for df in saved.values():
                discard(df)


def staged_day(spark: SparkSession, lake_root: str,
               run_date: str | dt.date) -> dict[str, DataFrame]:
    """The day's three staging frames from its clean layer."""
    return model_day({n: lake.read_clean(spark, lake_root, run_date, n) for n in CLEAN}, run_date)


#: Stored clean rows (details, nested credits) that staging shuffles at a time, and the most
#: parts that it cuts a day into for that, as each reads the day's clean layer again.
PART_BYTES, MOST_PARTS = 8 << 20, 4


def stage_parts(spark: SparkSession, lake_root: str, run_date: str | dt.date) -> int:
    """Parts in which to stage a day's films, by the size of what is shuffled for them."""
    size = sum(lake.clean_bytes(spark, lake_root, run_date, n)
               for n in ("movie_details", "credits_of_movies"))
    return max(1, min(MOST_PARTS, -(-size // PART_BYTES)))


def run_model_and_publish(spark: SparkSession, lake_root: str, run_date: str | dt.date,
                          database: str | None, buckets: int | None = None,
                          replace_day: bool = False) -> None:
    publish_day(spark, staged_day(spark, lake_root, run_date), database, run_date,
                buckets=buckets, replace_day=replace_day,
                parts=stage_parts(spark, lake_root, run_date))


def run_day(spark: SparkSession, lake_root: str, run_date: str | dt.date,
            database: str | None, multi_line: bool = False, buckets: int | None = None,
            replace_day: bool = False, quarantine: bool = False) -> None:
    """Clean, model and publish one landed day."""
    run_clean(spark, lake_root, run_date, multi_line, quarantine)
    run_model_and_publish(spark, lake_root, run_date, database, buckets, replace_day)


def run_days(spark: SparkSession, lake_root: str, run_dates: Sequence[str | dt.date],
             database: str | None, multi_line: bool = False, buckets: int | None = None) -> None:
    """Clean and model several landed days, and publish them in one pass over the tables."""
    for run_date in run_dates:
        run_clean(spark, lake_root, run_date, multi_line)
    publish_days(spark, {str(d): staged_day(spark, lake_root, d) for d in run_dates}, database,
                 buckets=buckets, parts=max((stage_parts(spark, lake_root, d) for d in run_dates),
                                            default=1))
