"""Model jobs: shape the clean layer into staging tables (CJ-5..CJ-7)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestmart import schemas
from nestmart.functions.columns import as_float64
from nestmart.operators.keys import dedupe, require
from nestmart.operators.nested import collect_sorted, explode_entries

PERSON_COLS = ["person_id", "name", "gender", "department"]


def spread_null_key(key: Column, unique: Column, tag: str = "\u0000none:") -> Column:
    """Join key where NULLs become distinct never-matching values.

    A left join sends every NULL-key row to one hash partition; with many
    films lacking an imdb id that single task would carry them all. Replacing
    NULL by a unique tagged value spreads them out; the join also requires the
    original key to be non-NULL, so a tagged value can never match.
    """
    return F.when(key.isNull(), F.concat(F.lit(tag), unique.cast("string"))).otherwise(key)


def collect_casts(cast: DataFrame) -> DataFrame:
    """``movie_id, casts: array<struct<person_id, order>>`` sorted by order, person (AG-6)."""
    return collect_sorted(cast.select("movie_id", "person_id", "order"), "movie_id",
                          ["person_id", "order"], ["order", "person_id"], "casts")


def collect_crews(crew: DataFrame) -> DataFrame:
    """``movie_id, crews: array<struct<person_id, job>>`` sorted by person, job (AG-6)."""
    return collect_sorted(crew.select("movie_id", "person_id", "job"), "movie_id",
                          ["person_id", "job"], ["person_id", "job"], "crews")


def film_join_chain(details: DataFrame, people: Sequence[DataFrame],
                    box_office: DataFrame) -> DataFrame:
    """Films ⟕ casts and crews ⟕ box office (JO-1).

    ``people`` holds frames with ``movie_id`` and arrays: the nested credits of
    the clean layer, or casts and crews collected from their exploded datasets.
    The right sides are unique per key (one row per film, one box office row
    per imdb id), so no film is multiplied. Box office joins first, on the imdb
    id, with NULL ids spread out (see ``spread_null_key``): films don't carry
    their people through that shuffle. Frames of ``people`` join on
    ``movie_id``, so the planner can use one hash partitioning for all, which
    the staging table's buckets can keep. Box office columns keep a ``bo_``
    prefix and stand last.
    """
    films = details.select(
        "movie_id", "imdb_id", "original_title", "title",
        F.transform("genres", lambda g: g["genre_name"]).alias("genres"),
        "origin_country",
        F.transform("production_companies", lambda c: c["company_id"])
        .alias("production_companies"),
        "release_date", "runtime", "budget", "revenue", "popularity", "vote_count",
        "vote_average",
    )
    bo = box_office.select(
        F.col("imdb_id").alias("bo_imdb_id"),
        F.col("budget").alias("bo_budget"),
        F.col("domestic_opening").alias("bo_opening"),
        F.col("worldwide_gross").alias("bo_gross"),
    )
    joined = films.join(bo, (spread_null_key(F.col("imdb_id"), F.col("movie_id"))
                             == F.col("bo_imdb_id")) & F.col("imdb_id").isNotNull(), "left")
    for frame in people:
        joined = joined.join(frame, "movie_id", "left")
    return joined.select(*[c for c in joined.columns if c not in bo.columns], *bo.columns)


def model_movies(details: DataFrame, people: Sequence[DataFrame],
                 box_office: DataFrame, run_date: str | dt.date) -> DataFrame:
    """The day's ``staging_movies``: one nested row per film (CJ-5).

    Box office wins over details for budget and gross (SC-7); the opening
    gross only exists in box office. The day's figures become a one-element
    ``metrics`` array stamped with the run date.
    """
    joined = film_join_chain(details, people, box_office)
    metric = F.struct(
        as_float64("popularity").alias("popularity"),
        F.col("vote_count").cast("bigint").alias("vote_count"),
        as_float64("vote_average").alias("vote_average"),
        F.coalesce("bo_gross", "revenue").cast("bigint").alias("gross"),
        F.lit(str(run_date)).cast("date").alias("collect_date"),
    )
    return joined.select(
        "movie_id", "imdb_id", "original_title", "title", "genres", "origin_country",
        "production_companies", "release_date", "runtime", "casts", "crews",
        F.col("bo_opening").alias("opening_gross"),
        F.coalesce("bo_budget", "budget").alias("movie_budget"),
        F.array(metric).alias("metrics"),
    ).to(schemas.MOVIES)


def model_credits(cast: DataFrame, crew: DataFrame) -> DataFrame:
    """``staging_credits``: one row per person from cast and crew (CJ-6, SE-1).

    One de-duplication after the union (one shuffle instead of three); a
    person in both keeps the cast row.
    """
    people = (cast.select(*PERSON_COLS, F.lit(0).alias("_src"))
              .unionByName(crew.select(*PERSON_COLS, F.lit(1).alias("_src"))))
    return dedupe(people, ["person_id"], prefer=["_src"]).drop("_src").to(schemas.CREDITS)


def model_companies(details: DataFrame) -> DataFrame:
    """``staging_production_companies``: one row per company id (CJ-7).

    Companies without an id are dropped: they can never match in the merge
    and would be inserted again every day.
    """
    companies = explode_entries(details, [], "production_companies")
    return dedupe(require(companies, ["company_id"]), ["company_id"]).to(
        schemas.PRODUCTION_COMPANIES)


def model_day(clean: dict[str, DataFrame], run_date: str | dt.date) -> dict[str, DataFrame]:
    """The three staging frames of one day, keyed by warehouse table name."""
    return {
        "movies": model_movies(clean["movie_details"], [clean["credits_of_movies"]],
                               clean["box_office"], run_date),
        "credits": model_credits(clean["cast_of_movies"], clean["crew_of_movies"]),
        "production_companies": model_companies(clean["movie_details"]),
    }
