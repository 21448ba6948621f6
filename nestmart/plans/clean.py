"""Clean jobs: type raw daily landings into the clean layer (CJ-1..CJ-4).

Each function takes the raw frame as read with its declared schema and
returns the clean frame; the caller decides whether to write it
(``sources.lake.write_clean``) or feed it straight into modelling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from nestmart.functions.columns import (empty_to_null, keep_by_order, keep_values,
                                        money_to_long, retype_entries, try_cast, zero_to_null)
from nestmart.operators.keys import dedupe, require
from nestmart.operators.nested import explode_entries, sorted_entries

# Fixed values of the clean rules.
CREW_JOBS = ("Director", "Writer", "Screenplay")   # crew kept, case-sensitive
CAST_MAX_ORDER = 20                                  # 0-based, inclusive: 21 people
ZERO_IS_UNKNOWN = ("budget", "revenue")              # 0 means "not known" for these only

# Raw nested field -> clean field name and type, per array.
GENRE_FIELDS = [("id", "genre_id", "bigint"), ("name", "genre_name", None)]
COMPANY_FIELDS = [("id", "company_id", "bigint"), ("name", "company_name", None),
                  ("origin_country", "company_country", None)]
CAST_FIELDS = [("id", "person_id", "bigint"), ("gender", "gender", "int"), ("name", "name", None),
               ("order", "order", "int"), ("known_for_department", "department", None)]
CREW_FIELDS = [("id", "person_id", "bigint"), ("gender", "gender", "int"), ("name", "name", None),
               ("department", "department", None), ("job", "job", None)]


def clean_movie_details(raw: DataFrame) -> DataFrame:
    """Typed film details, one row per film (CJ-1).

    Steps, in the reference's order: typed projection with re-typed nested
    arrays; empty genres / companies to NULL (``origin_country`` stays as
    is); drop rows without id or popularity; one row per id; rename; 0 to
    NULL for budget and revenue.
    """
    return finish_details(dedupe(typed_details(raw), ["id"]))


def typed_details(raw: DataFrame) -> DataFrame:
    """Film details up to the de-duplication by ``id``."""
    typed = raw.select(
        try_cast("id", "bigint").alias("id"),
        "imdb_id",
        "original_title",
        "title",
        try_cast("budget", "bigint").alias("budget"),
        empty_to_null(retype_entries("genres", GENRE_FIELDS)).alias("genres"),
        "origin_country",
        try_cast("popularity", "float").alias("popularity"),
        empty_to_null(retype_entries("production_companies", COMPANY_FIELDS))
        .alias("production_companies"),
        try_cast("release_date", "date").alias("release_date"),
        try_cast("revenue", "bigint").alias("revenue"),
        try_cast("runtime", "int").alias("runtime"),
        try_cast("vote_average", "float").alias("vote_average"),
        try_cast("vote_count", "int").alias("vote_count"),
    )
    return require(typed, ["id", "popularity"])


def finish_details(one: DataFrame) -> DataFrame:
    """Film details from the de-duplication by ``id`` on."""
    return one.withColumnRenamed("id", "movie_id").withColumns(
        {c: zero_to_null(c) for c in ZERO_IS_UNKNOWN})


def clean_credits(raw: DataFrame) -> DataFrame:
    """Typed credits, one row per film, cast and crew still nested and whole."""
    return dedupe(typed_credits(raw), ["movie_id"])


def typed_credits(raw: DataFrame) -> DataFrame:
    """Credits up to the de-duplication by ``movie_id``."""
    typed = raw.select(
        try_cast("id", "bigint").alias("movie_id"),
        retype_entries("cast", CAST_FIELDS).alias("cast"),
        retype_entries("crew", CREW_FIELDS).alias("crew"),
    )
    return require(typed, ["movie_id"])


def cut_credits(credits: DataFrame, jobs: tuple[str, ...] = CREW_JOBS,
                max_order: int = CAST_MAX_ORDER) -> DataFrame:
    """Credits with only the entries that the clean layer keeps, all that a day's datasets need."""
    return credits.select("movie_id", keep_by_order("cast", max_order).alias("cast"),
                          keep_values("crew", "job", jobs).alias("crew"))


def nest_credits(credits: DataFrame, jobs: tuple[str, ...] = CREW_JOBS,
                 max_order: int = CAST_MAX_ORDER) -> DataFrame:
    """``movie_id, casts, crews``: the kept entries as the film table holds them (AG-6).

    Built inside the row, casts by order and person, crews by person and job;
    a film without a kept entry has NULL. Equal to collecting the exploded
    datasets again, without their two shuffles.
    """
    return credits.select(
        "movie_id",
        sorted_entries(keep_by_order("cast", max_order), ["person_id", "order"],
                       ["order", "person_id"]).alias("casts"),
        sorted_entries(keep_values("crew", "job", jobs), ["person_id", "job"],
                       ["person_id", "job"]).alias("crews"))


def clean_crew(credits: DataFrame, jobs: tuple[str, ...] = CREW_JOBS) -> DataFrame:
    """One row per kept crew entry (CJ-2); the job filter runs inside the array."""
    kept = credits.select("movie_id", keep_values("crew", "job", jobs).alias("crew"))
    return explode_entries(kept, ["movie_id"], "crew")


def clean_cast(credits: DataFrame, max_order: int = CAST_MAX_ORDER) -> DataFrame:
    """One row per cast entry with ``order <= max_order`` (CJ-3); NULL order is dropped."""
    kept = credits.select("movie_id", keep_by_order("cast", max_order).alias("cast"))
    return explode_entries(kept, ["movie_id"], "cast")


def clean_box_office(raw: DataFrame) -> DataFrame:
    """Money strings to bigint, one row per imdb id (CJ-4).

    Worldwide gross loses ``$`` and ``,``; opening and budget lose only ``,``,
    so a stray ``$`` there leaves an unparsable string and gives NULL.
    """
    typed = raw.select(
        "imdb_id",
        money_to_long("domestic_opening", strip_dollar=False).alias("domestic_opening"),
        money_to_long("worldwide_gross", strip_dollar=True).alias("worldwide_gross"),
        money_to_long("budget", strip_dollar=False).alias("budget"),
    )
    return dedupe(require(typed, ["imdb_id"]), ["imdb_id"])


def clean_day(raw_details: DataFrame, raw_credits: DataFrame,
              raw_box_office: DataFrame) -> dict[str, DataFrame]:
    """All clean datasets of one day, keyed by their clean-layer names."""
    credits = cut_credits(clean_credits(raw_credits))
    return {
        "movie_details": clean_movie_details(raw_details),
        "crew_of_movies": clean_crew(credits),
        "cast_of_movies": clean_cast(credits),
        "credits_of_movies": nest_credits(credits),
        "box_office": clean_box_office(raw_box_office),
    }


__all__ = ["clean_movie_details", "typed_details", "finish_details", "clean_credits",
           "typed_credits", "cut_credits", "nest_credits", "clean_crew", "clean_cast",
           "clean_box_office", "clean_day", "CREW_JOBS", "CAST_MAX_ORDER"]
