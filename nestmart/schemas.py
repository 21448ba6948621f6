"""Declared schemas: raw landings, clean layer and warehouse tables.

Raw schemas are declared rather than inferred: inference turns an all-NULL
``cast`` column into a string and a mix of ``0`` and ``1.5e6`` into double,
and a BIGINT schema makes the JSON reader drop ``1500000.0`` to NULL, so raw
numbers are read as DOUBLE and narrowed with ``try_cast`` in the clean jobs.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- raw landings

ID_EXPORT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("popularity", T.DoubleType()),
])

RAW_MOVIE_DETAILS = T.StructType([
    T.StructField("id", T.DoubleType()),
    T.StructField("imdb_id", T.StringType()),
    T.StructField("original_title", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("budget", T.DoubleType()),
    T.StructField("genres", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
    ]))),
    T.StructField("origin_country", T.ArrayType(T.StringType())),
    T.StructField("popularity", T.DoubleType()),
    T.StructField("production_companies", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("origin_country", T.StringType()),
    ]))),
    T.StructField("release_date", T.StringType()),
    T.StructField("revenue", T.DoubleType()),
    T.StructField("runtime", T.DoubleType()),
    T.StructField("vote_average", T.DoubleType()),
    T.StructField("vote_count", T.DoubleType()),
])

RAW_CAST_MEMBER = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("gender", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("order", T.LongType()),
    T.StructField("known_for_department", T.StringType()),
])

RAW_CREW_MEMBER = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("gender", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("department", T.StringType()),
    T.StructField("job", T.StringType()),
])

RAW_MOVIE_CREDITS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("cast", T.ArrayType(RAW_CAST_MEMBER)),
    T.StructField("crew", T.ArrayType(RAW_CREW_MEMBER)),
])

RAW_BOX_OFFICE = T.StructType([
    T.StructField("imdb_id", T.StringType()),
    T.StructField("domestic_opening", T.StringType()),
    T.StructField("worldwide_gross", T.StringType()),
    T.StructField("budget", T.StringType()),
])

BOX_OFFICE_PAGE = T.StructType([
    T.StructField("imdb_id", T.StringType()),
    T.StructField("html", T.StringType()),
])

RAW_SCHEMAS = {
    "movie_details": RAW_MOVIE_DETAILS,
    "movie_credits": RAW_MOVIE_CREDITS,
    "box_office": RAW_BOX_OFFICE,
}

# ---------------------------------------------------------------- clean layer

CLEAN_MOVIE_DETAILS = T.StructType([
    T.StructField("movie_id", T.LongType()),
    T.StructField("imdb_id", T.StringType()),
    T.StructField("original_title", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("budget", T.LongType()),
    T.StructField("genres", T.ArrayType(T.StructType([
        T.StructField("genre_id", T.LongType()),
        T.StructField("genre_name", T.StringType()),
    ]))),
    T.StructField("origin_country", T.ArrayType(T.StringType())),
    T.StructField("popularity", T.FloatType()),
    T.StructField("production_companies", T.ArrayType(T.StructType([
        T.StructField("company_id", T.LongType()),
        T.StructField("company_name", T.StringType()),
        T.StructField("company_country", T.StringType()),
    ]))),
    T.StructField("release_date", T.DateType()),
    T.StructField("revenue", T.LongType()),
    T.StructField("runtime", T.IntegerType()),
    T.StructField("vote_average", T.FloatType()),
    T.StructField("vote_count", T.IntegerType()),
])

CLEAN_CAST = T.StructType([
    T.StructField("movie_id", T.LongType()),
    T.StructField("person_id", T.LongType()),
    T.StructField("gender", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("order", T.IntegerType()),
    T.StructField("department", T.StringType()),
])

CLEAN_CREW = T.StructType([
    T.StructField("movie_id", T.LongType()),
    T.StructField("person_id", T.LongType()),
    T.StructField("gender", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("department", T.StringType()),
    T.StructField("job", T.StringType()),
])

CLEAN_BOX_OFFICE = T.StructType([
    T.StructField("imdb_id", T.StringType()),
    T.StructField("domestic_opening", T.LongType()),
    T.StructField("worldwide_gross", T.LongType()),
    T.StructField("budget", T.LongType()),
])

# ---------------------------------------------------------------- warehouse

CAST_ENTRY = T.StructType([
    T.StructField("person_id", T.LongType()),
    T.StructField("order", T.LongType()),
])

CREW_ENTRY = T.StructType([
    T.StructField("person_id", T.LongType()),
    T.StructField("job", T.StringType()),
])

METRIC = T.StructType([
    T.StructField("popularity", T.DoubleType()),
    T.StructField("vote_count", T.LongType()),
    T.StructField("vote_average", T.DoubleType()),
    T.StructField("gross", T.LongType()),
    T.StructField("collect_date", T.DateType()),
])

MOVIES = T.StructType([
    T.StructField("movie_id", T.LongType()),
    T.StructField("imdb_id", T.StringType()),
    T.StructField("original_title", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.ArrayType(T.StringType())),
    T.StructField("origin_country", T.ArrayType(T.StringType())),
    T.StructField("production_companies", T.ArrayType(T.LongType())),
    T.StructField("release_date", T.DateType()),
    T.StructField("runtime", T.LongType()),
    T.StructField("casts", T.ArrayType(CAST_ENTRY)),
    T.StructField("crews", T.ArrayType(CREW_ENTRY)),
    T.StructField("opening_gross", T.LongType()),
    T.StructField("movie_budget", T.LongType()),
    T.StructField("metrics", T.ArrayType(METRIC)),
])

CREDITS = T.StructType([
    T.StructField("person_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("gender", T.LongType()),
    T.StructField("department", T.StringType()),
])

PRODUCTION_COMPANIES = T.StructType([
    T.StructField("company_id", T.LongType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("company_country", T.StringType()),
])

DIM_DATE = T.StructType([
    T.StructField("date_key", T.DecimalType(38, 9)),
    T.StructField("date_id", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("quarter", T.IntegerType()),
    T.StructField("quarter_name", T.StringType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("month_name", T.StringType()),
    T.StructField("month_name_short", T.StringType()),
    T.StructField("day_of_month", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("day_name", T.StringType()),
    T.StructField("day_name_short", T.StringType()),
    T.StructField("week_of_year", T.IntegerType()),
    T.StructField("day_of_year", T.IntegerType()),
    T.StructField("is_weekend", T.BooleanType()),
])

# Legacy warehouse shape: five parallel arrays of single-field structs.
LEGACY_SERIES = {
    "popularity": T.DoubleType(),
    "vote_count": T.LongType(),
    "vote_average": T.DoubleType(),
    "gross": T.LongType(),
    "current_date": T.DateType(),
}

WAREHOUSE_SCHEMAS = {
    "movies": MOVIES,
    "credits": CREDITS,
    "production_companies": PRODUCTION_COMPANIES,
    "dim_date": DIM_DATE,
}

# Table keys used by merges and de-duplication.
KEYS = {
    "movies": "movie_id",
    "credits": "person_id",
    "production_companies": "company_id",
}
