"""Registered queries: one Spark query and one DuckDB oracle per key of SURVEY §2.

Each query takes ``(spark, sf_dir)``, reads the supplied test tables (whole
tables, through the rules of ``fixtures``) and runs the library's operators
on them. Results are flat: arrays and structs are exploded or summarised,
averaged doubles are rounded to 6 places, dates are rendered as
``yyyy-MM-dd`` strings, so Spark and DuckDB results hash alike.

Oracles are independent SQL over the same tables: they recompute the
expected result from the flat fixture rules, not from our Spark code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestmart import fixtures as fx
from nestmart.plans import reports

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return wrap


def presented(df: DataFrame) -> DataFrame:
    """Round doubles to 6 places and render dates as strings, column order kept."""
    cols: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# Oracle building blocks (DuckDB dialect) ------------------------------------

def oracle(fx_names: list[str], body: str, *ctes: str) -> str:
    """``WITH fx_... AS (...), <ctes> <body>`` in DuckDB's dialect."""
    parts = [f"fx_{n} AS ({fx.sql(n, 'duckdb')})" for n in fx_names]
    parts += [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


ORACLE_FILM = """
film AS (
  SELECT movie_id, title,
         CASE WHEN no_genres THEN NULL ELSE [genre_a, genre_b] END AS genres,
         NULLIF(budget, 0) AS movie_budget
  FROM fx_film WHERE popularity IS NOT NULL)"""

ORACLE_CASTS = """
cast_entries AS (
  SELECT movie_id, person_id, ord
  FROM fx_line WHERE NOT is_crew AND ord <= 20),
film_casts AS (
  SELECT movie_id, list({'person_id': person_id, 'order': ord} ORDER BY ord, person_id) AS casts
  FROM cast_entries GROUP BY movie_id)"""


# Reports ---------------------------------------------------------------------

@register("report_by_genre", fx.with_clause(["film", "day"]) + "," + ORACLE_FILM + """,
agg AS (
  SELECT f.title, f.genres, f.movie_budget,
         avg(CAST(CAST(d.popularity AS FLOAT) AS DOUBLE)) AS popularity,
         max(d.gross) AS gross
  FROM film f JOIN fx_day d ON f.movie_id = d.movie_id
  GROUP BY f.title, f.genres, f.movie_budget)
SELECT g.genre AS genre,
       round(avg(a.movie_budget), 6) AS budget,
       round(avg(a.popularity), 6) AS popularity,
       round(avg(a.gross), 6) AS gross
FROM agg a, unnest(a.genres) AS g(genre)
WHERE a.movie_budget IS NOT NULL
GROUP BY g.genre
""")
def q_report_by_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(reports.report_by_genre(fx.film_table(spark, sf_dir)))


@register("report_by_title", fx.with_clause(["film", "day"]) + """
SELECT f.title AS title,
       round(avg(CAST(CAST(d.popularity AS FLOAT) AS DOUBLE)), 6) AS popularity,
       max(d.gross) AS gross
FROM fx_film f JOIN fx_day d ON f.movie_id = d.movie_id
WHERE f.popularity IS NOT NULL
GROUP BY f.title
""")
def q_report_by_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(reports.report_by_title(fx.film_table(spark, sf_dir)))


@register("report_by_cast", fx.with_clause(["film", "line", "day"]) + "," + ORACLE_FILM + ","
          + ORACLE_CASTS + """,
people AS (SELECT DISTINCT person_id, name FROM fx_line),
agg AS (
  SELECT f.title, c.casts, f.movie_budget,
         avg(CAST(CAST(d.popularity AS FLOAT) AS DOUBLE)) AS popularity,
         avg(CAST(CAST(d.vote_average AS FLOAT) AS DOUBLE)) AS vote_average,
         avg(d.vote_count) AS vote_count,
         max(d.gross) AS gross
  FROM film f JOIN fx_day d ON f.movie_id = d.movie_id
  LEFT JOIN film_casts c ON f.movie_id = c.movie_id
  GROUP BY f.title, c.casts, f.movie_budget),
billed AS (
  SELECT u.c.person_id AS cast_id, a.popularity, a.vote_average, a.vote_count, a.gross
  FROM agg a, unnest(a.casts) AS u(c)
  WHERE u.c."order" <= 4)
SELECT b.cast_id AS cast_id, p.name AS name,
       round(avg(b.popularity), 6) AS popularity,
       round(avg(b.vote_average), 6) AS vote_average,
       round(avg(b.vote_count), 6) AS vote_count,
       round(avg(b.gross), 6) AS gross
FROM billed b JOIN people p ON p.person_id = b.cast_id
WHERE b.gross IS NOT NULL
GROUP BY b.cast_id, p.name
""")
def q_report_by_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    movies = fx.film_table(spark, sf_dir)
    return presented(reports.report_by_cast(movies, fx.people(spark, sf_dir)))


# Shared Spark-side steps -------------------------------------------------------

def _clean_details(spark: SparkSession, sf_dir: str, day: int | None = None,
                   dups: bool = False, companies: DataFrame | None = None) -> DataFrame:
    from nestmart.plans.clean import clean_movie_details
    return clean_movie_details(fx.raw_movie_details(spark, sf_dir, day, duplicate_rule=dups,
                                                    companies=companies))


def _clean_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.plans.clean import clean_credits
    return clean_credits(fx.raw_movie_credits(spark, sf_dir))


def _raw_box_office_with_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.raw_box_office(spark, sf_dir)
    return raw.unionByName(raw.where(F.col("worldwide_gross").startswith("$")
                                     & F.col("worldwide_gross").contains(",")))


ORACLE_BO = """
bo AS (
  SELECT 'tt' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0') AS imdb_id,
         CASE WHEN o_orderkey % 5 IN (0, 1) THEN NULL
              ELSE CAST(round(o_totalprice) AS BIGINT) END AS gross,
         CASE WHEN o_orderkey % 5 = 3 THEN CAST(round(o_totalprice / 10) AS BIGINT) END AS opening,
         CASE WHEN o_orderkey % 5 = 3 THEN CAST(round(o_totalprice / 3) AS BIGINT) END AS budget
  FROM orders WHERE o_orderstatus <> 'P')"""

ORACLE_COMPANY_COUNT = """
comp AS (
  SELECT l.movie_id, count(DISTINCT l.company_id) AS n
  FROM fx_line l JOIN fx_company c ON l.company_id = c.company_id
  GROUP BY l.movie_id)"""


# Clean layer -------------------------------------------------------------------

@register("clean_movie_details", oracle(["film", "line", "company"], """
SELECT f.movie_id AS movie_id, f.imdb_id AS imdb_id, f.original_title AS original_title,
       f.title AS title, CAST(NULLIF(f.budget, 0) AS BIGINT) AS budget,
       CAST(CASE WHEN f.no_genres THEN NULL ELSE 2 END AS BIGINT) AS n_genres,
       CAST(CASE WHEN f.no_genres THEN NULL ELSE f.genre_a_id END AS BIGINT) AS first_genre_id,
       CASE WHEN f.no_genres THEN NULL ELSE f.genre_a END AS first_genre,
       CAST(CASE WHEN f.no_country THEN 0 ELSE 1 END AS BIGINT) AS n_countries,
       round(CAST(CAST(f.popularity AS FLOAT) AS DOUBLE), 6) AS popularity,
       comp.n AS n_companies,
       CAST(TRY_CAST(f.release_date AS DATE) AS VARCHAR) AS release_date,
       NULLIF(f.revenue, 0) AS revenue,
       CAST(f.runtime AS BIGINT) AS runtime,
       round(CAST(CAST(f.vote_average AS FLOAT) AS DOUBLE), 6) AS vote_average,
       f.vote_count AS vote_count
FROM fx_film f LEFT JOIN comp ON f.movie_id = comp.movie_id
WHERE f.popularity IS NOT NULL
""", ORACLE_COMPANY_COUNT))
def q_clean_movie_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _clean_details(spark, sf_dir, dups=True)
    return presented(d.select(
        "movie_id", "imdb_id", "original_title", "title", "budget",
        _size("genres").cast("bigint").alias("n_genres"),
        F.col("genres")[0]["genre_id"].alias("first_genre_id"),
        F.col("genres")[0]["genre_name"].alias("first_genre"),
        _size("origin_country").cast("bigint").alias("n_countries"),
        "popularity",
        _size("production_companies").cast("bigint").alias("n_companies"),
        "release_date", "revenue", "runtime", "vote_average", "vote_count"))


@register("drop_null_keys", oracle(["film"], """
SELECT movie_id AS id, round(popularity, 6) AS popularity FROM fx_film
WHERE popularity IS NOT NULL
UNION ALL
SELECT movie_id, round(popularity, 6) FROM fx_film
WHERE popularity IS NOT NULL AND (runtime - 61) % 10 = 0
"""))
def q_drop_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.operators.keys import require
    raw = fx.raw_movie_details(spark, sf_dir, duplicate_rule=True)
    kept = require(raw.select(F.col("id").try_cast("bigint").alias("id"), "popularity"),
                   ["id", "popularity"])
    return presented(kept)


@register("dedupe_by_key", oracle(["film"], """
SELECT DISTINCT movie_id AS id, title, round(popularity, 6) AS popularity FROM fx_film
"""))
def q_dedupe_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.operators.keys import dedupe
    raw = fx.raw_movie_details(spark, sf_dir, duplicate_rule=True)
    one = dedupe(raw.select(F.col("id").try_cast("bigint").alias("id"), "title", "popularity"),
                 ["id"])
    return presented(one)


@register("zero_to_null", oracle(["film"], """
SELECT movie_id, CAST(NULLIF(budget, 0) AS BIGINT) AS budget, NULLIF(revenue, 0) AS revenue,
       vote_count
FROM fx_film WHERE popularity IS NOT NULL
"""))
def q_zero_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _clean_details(spark, sf_dir)
    return presented(d.select("movie_id", "budget", "revenue", "vote_count"))


@register("empty_to_null", oracle(["film", "line", "company"], """
SELECT f.movie_id AS movie_id, f.no_genres AS genres_null,
       comp.n IS NULL AS companies_null,
       CAST(CASE WHEN f.no_country THEN 0 ELSE 1 END AS BIGINT) AS n_countries
FROM fx_film f LEFT JOIN comp ON f.movie_id = comp.movie_id
WHERE f.popularity IS NOT NULL
""", ORACLE_COMPANY_COUNT))
def q_empty_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _clean_details(spark, sf_dir)
    return presented(d.select(
        "movie_id", F.col("genres").isNull().alias("genres_null"),
        F.col("production_companies").isNull().alias("companies_null"),
        _size("origin_country").cast("bigint").alias("n_countries")))


@register("array_retype", oracle(["film"], """
SELECT movie_id, CAST(0 AS BIGINT) AS pos, CAST(genre_a_id AS BIGINT) AS genre_id,
       genre_a AS genre_name
FROM fx_film WHERE popularity IS NOT NULL AND NOT no_genres
UNION ALL
SELECT movie_id, CAST(1 AS BIGINT), CAST(genre_b_id AS BIGINT), genre_b
FROM fx_film WHERE popularity IS NOT NULL AND NOT no_genres
"""))
def q_array_retype(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.operators.nested import explode_with_position
    d = _clean_details(spark, sf_dir)
    return presented(explode_with_position(d, ["movie_id"], "genres"))


@register("try_cast_money", """
SELECT CASE WHEN o_orderstatus = 'P' THEN NULL
            ELSE 'tt' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0') END AS imdb_id,
       CASE WHEN o_orderkey % 5 = 3 THEN CAST(round(o_totalprice / 10) AS BIGINT) END
         AS domestic_opening,
       CASE WHEN o_orderkey % 5 IN (0, 1) THEN NULL
            ELSE CAST(round(o_totalprice) AS BIGINT) END AS worldwide_gross,
       CASE WHEN o_orderkey % 5 = 3 THEN CAST(round(o_totalprice / 3) AS BIGINT) END AS budget
FROM orders
""")
def q_try_cast_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.functions.columns import money_to_long
    raw = fx.raw_box_office(spark, sf_dir)
    return presented(raw.select(
        "imdb_id",
        money_to_long("domestic_opening", strip_dollar=False).alias("domestic_opening"),
        money_to_long("worldwide_gross", strip_dollar=True).alias("worldwide_gross"),
        money_to_long("budget", strip_dollar=False).alias("budget")))


@register("clean_box_office", oracle([], """
SELECT imdb_id, opening AS domestic_opening, gross AS worldwide_gross, budget FROM bo
""", ORACLE_BO))
def q_clean_box_office(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.plans.clean import clean_box_office
    return presented(clean_box_office(_raw_box_office_with_dups(spark, sf_dir)))


@register("filter_crew_jobs", oracle(["line"], """
SELECT movie_id, person_id, CAST(gender AS BIGINT) AS gender, name, department, job
FROM fx_line WHERE is_crew AND job IN ('Director', 'Writer', 'Screenplay')
"""))
def q_filter_crew_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.plans.clean import clean_crew
    return presented(clean_crew(_clean_credits(spark, sf_dir)))


@register("filter_cast_order", oracle(["line"], """
SELECT movie_id, person_id, CAST(gender AS BIGINT) AS gender, name, ord AS "order",
       department
FROM fx_line WHERE NOT is_crew AND ord <= 20
"""))
def q_filter_cast_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.plans.clean import clean_cast
    return presented(clean_cast(_clean_credits(spark, sf_dir)))


@register("explode_cast", oracle(["line"], """
SELECT movie_id, person_id, ord AS "order", department
FROM fx_line WHERE NOT is_crew
"""))
def q_explode_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.operators.nested import explode_entries
    credits = _clean_credits(spark, sf_dir)
    return presented(explode_entries(credits, ["movie_id"], "cast").select(
        "movie_id", "person_id", "order", "department"))


@register("lookup_keys", oracle(["film"], """
SELECT imdb_id FROM fx_film WHERE imdb_id IS NOT NULL AND imdb_id <> ''
"""))
def q_lookup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.functions.columns import non_blank
    raw = fx.raw_movie_details(spark, sf_dir)
    return raw.where(non_blank("imdb_id")).select("imdb_id")


# Model layer -------------------------------------------------------------------

def _day_clean(spark: SparkSession, sf_dir: str, day: int,
               lines: fx.FilmLines | None = None) -> dict[str, DataFrame]:
    from nestmart.plans.clean import clean_day
    credits = fx.raw_movie_credits(spark, sf_dir) if lines is None else lines.credits
    details = fx.raw_movie_details(spark, sf_dir, day, companies=lines and lines.companies)
    return clean_day(details, credits, fx.raw_box_office(spark, sf_dir))


def _day_staging(spark: SparkSession, sf_dir: str, day: int,
                 lines: fx.FilmLines | None = None) -> dict[str, DataFrame]:
    from nestmart.plans.model import model_day
    return model_day(_day_clean(spark, sf_dir, day, lines), fx.day_date(day))


def _size(c: str | Column) -> Column:
    """Array length, NULL for a NULL array whatever ``spark.sql.legacy.sizeOfNull`` says."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.isNotNull(), F.size(col))


def _first(arr: str, field: str) -> Column:
    return F.get(F.col(arr), 0)[field]


ORACLE_ENTRY_COUNTS = """
cast_n AS (SELECT movie_id, count(*) AS n FROM fx_line
           WHERE NOT is_crew AND ord <= 20 GROUP BY movie_id),
crew_n AS (SELECT movie_id, count(*) AS n FROM fx_line
           WHERE is_crew AND job IN ('Director', 'Writer', 'Screenplay') GROUP BY movie_id)"""

ORACLE_DAY0 = """
d0 AS (
  SELECT f.movie_id, f.imdb_id, f.title, f.no_genres, f.budget, d.popularity, d.vote_count,
         d.gross, bo.imdb_id AS bo_imdb_id, bo.opening, bo.budget AS bo_budget, bo.gross AS bo_gross
  FROM fx_film f JOIN fx_day d ON f.movie_id = d.movie_id AND d.day = 0
  LEFT JOIN bo ON f.imdb_id = bo.imdb_id)"""


@register("model_movies", oracle(["film", "line", "day"], """
SELECT d0.movie_id AS movie_id, d0.imdb_id AS imdb_id, d0.title AS title,
       CAST(CASE WHEN d0.no_genres THEN NULL ELSE 2 END AS BIGINT) AS n_genres,
       c.n AS n_casts, cr.n AS n_crews,
       d0.opening AS opening_gross,
       coalesce(d0.bo_budget, CAST(NULLIF(d0.budget, 0) AS BIGINT)) AS movie_budget,
       coalesce(d0.bo_gross, d0.gross) AS gross,
       round(CAST(CAST(d0.popularity AS FLOAT) AS DOUBLE), 6) AS popularity,
       d0.vote_count AS vote_count,
       '2024-01-01' AS collect_date
FROM d0 LEFT JOIN cast_n c ON d0.movie_id = c.movie_id
LEFT JOIN crew_n cr ON d0.movie_id = cr.movie_id
""", ORACLE_BO, ORACLE_DAY0, ORACLE_ENTRY_COUNTS))
def q_model_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _day_staging(spark, sf_dir, 0)["movies"]
    return presented(m.select(
        "movie_id", "imdb_id", "title",
        _size("genres").alias("n_genres"), _size("casts").alias("n_casts"),
        _size("crews").alias("n_crews"), "opening_gross", "movie_budget",
        _first("metrics", "gross").alias("gross"),
        _first("metrics", "popularity").alias("popularity"),
        _first("metrics", "vote_count").alias("vote_count"),
        _first("metrics", "collect_date").alias("collect_date")))


@register("left_join_chain", oracle(["film", "line", "day"], """
SELECT d0.movie_id AS movie_id, c.n AS n_casts, cr.n AS n_crews,
       d0.bo_imdb_id IS NOT NULL AS has_box_office
FROM d0 LEFT JOIN cast_n c ON d0.movie_id = c.movie_id
LEFT JOIN crew_n cr ON d0.movie_id = cr.movie_id
""", ORACLE_BO, ORACLE_DAY0, ORACLE_ENTRY_COUNTS))
def q_left_join_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.plans.model import collect_casts, collect_crews, film_join_chain
    c = _day_clean(spark, sf_dir, 0)
    j = film_join_chain(c["movie_details"], [collect_casts(c["cast_of_movies"]),
                                             collect_crews(c["crew_of_movies"])],
                        c["box_office"])
    return presented(j.select("movie_id", _size("casts").alias("n_casts"),
                              _size("crews").alias("n_crews"),
                              F.col("bo_imdb_id").isNotNull().alias("has_box_office")))


@register("gross_budget_fallback", oracle(["film", "day"], """
SELECT movie_id,
       coalesce(bo_budget, CAST(NULLIF(budget, 0) AS BIGINT)) AS movie_budget,
       CASE WHEN bo_budget IS NOT NULL THEN 'box_office'
            WHEN NULLIF(budget, 0) IS NOT NULL THEN 'details' END AS budget_source,
       coalesce(bo_gross, gross) AS gross,
       CASE WHEN bo_gross IS NOT NULL THEN 'box_office'
            WHEN gross IS NOT NULL THEN 'details' END AS gross_source
FROM d0
""", ORACLE_BO, ORACLE_DAY0))
def q_gross_budget_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.plans.model import collect_casts, collect_crews, film_join_chain
    c = _day_clean(spark, sf_dir, 0)
    j = film_join_chain(c["movie_details"], [collect_casts(c["cast_of_movies"]),
                                             collect_crews(c["crew_of_movies"])],
                        c["box_office"])

    def source(bo: str, own: str) -> Column:
        return (F.when(F.col(bo).isNotNull(), F.lit("box_office"))
                .when(F.col(own).isNotNull(), F.lit("details")))

    return presented(j.select(
        "movie_id",
        F.coalesce("bo_budget", "budget").alias("movie_budget"),
        source("bo_budget", "budget").alias("budget_source"),
        F.coalesce("bo_gross", "revenue").alias("gross"),
        source("bo_gross", "revenue").alias("gross_source")))


@register("collect_casts", oracle(["line"], """
SELECT movie_id,
       row_number() OVER (PARTITION BY movie_id ORDER BY ord, person_id) - 1 AS pos,
       person_id, ord AS "order"
FROM fx_line WHERE NOT is_crew AND ord <= 20
"""))
def q_collect_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.operators.nested import explode_with_position
    from nestmart.plans.clean import nest_credits
    nested = nest_credits(_clean_credits(spark, sf_dir))
    return presented(explode_with_position(nested, ["movie_id"], "casts"))


@register("collect_crews", oracle(["line"], """
SELECT movie_id,
       row_number() OVER (PARTITION BY movie_id ORDER BY person_id, job) - 1 AS pos,
       person_id, job
FROM fx_line WHERE is_crew AND job IN ('Director', 'Writer', 'Screenplay')
"""))
def q_collect_crews(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.operators.nested import explode_with_position
    from nestmart.plans.clean import nest_credits
    nested = nest_credits(_clean_credits(spark, sf_dir))
    return presented(explode_with_position(nested, ["movie_id"], "crews"))


@register("model_credits", oracle(["line"], """
SELECT DISTINCT person_id, name, CAST(gender AS BIGINT) AS gender, department
FROM fx_line
WHERE (NOT is_crew AND ord <= 20) OR (is_crew AND job IN ('Director', 'Writer', 'Screenplay'))
"""))
def q_model_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(_day_staging(spark, sf_dir, 0)["credits"])


@register("model_companies", oracle(["film", "line", "day", "company"], """
SELECT DISTINCT c.company_id, c.company_name, c.company_country
FROM fx_line l JOIN fx_day d ON l.movie_id = d.movie_id AND d.day = 0
JOIN fx_company c ON l.company_id = c.company_id
"""))
def q_model_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(_day_staging(spark, sf_dir, 0)["production_companies"])


# Dimension joins and nested reads over the film table ---------------------------

ORACLE_FILMS_KEPT = """
kept AS (SELECT movie_id FROM fx_film WHERE popularity IS NOT NULL)"""


@register("company_join", oracle(["film", "line", "company"], """
SELECT DISTINCT l.movie_id AS movie_id, c.company_id AS company_id, c.company_name AS company_name,
       c.company_country AS company_country
FROM fx_line l JOIN kept k ON l.movie_id = k.movie_id
JOIN fx_company c ON l.company_id = c.company_id
""", ORACLE_FILMS_KEPT))
def q_company_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.plans.reports import film_companies
    companies = fx.fx(spark, sf_dir, "company")
    return presented(film_companies(fx.film_table(spark, sf_dir), companies).select(
        "movie_id", "company_id", "company_name", "company_country"))


@register("crew_join", oracle(["film", "line"], """
SELECT l.movie_id AS movie_id, l.person_id AS person_id, l.job AS job, p.name AS name,
       p.department AS department
FROM fx_line l JOIN kept k ON l.movie_id = k.movie_id
JOIN (SELECT DISTINCT person_id, name, department FROM fx_line) p ON l.person_id = p.person_id
WHERE l.is_crew AND l.job IN ('Director', 'Writer', 'Screenplay')
""", ORACLE_FILMS_KEPT))
def q_crew_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.plans.reports import crew_with_names
    joined = crew_with_names(fx.film_table(spark, sf_dir), fx.people(spark, sf_dir))
    return presented(joined.select("movie_id", "person_id", "job", "name", "department"))


@register("dim_join", oracle(["film", "line"], """
SELECT l.movie_id AS movie_id, l.person_id AS person_id, l.ord AS "order", p.name AS name
FROM fx_line l JOIN kept k ON l.movie_id = k.movie_id
JOIN (SELECT DISTINCT person_id, name FROM fx_line) p ON l.person_id = p.person_id
WHERE NOT l.is_crew AND l.ord <= 20
""", ORACLE_FILMS_KEPT))
def q_dim_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.plans.reports import cast_with_names
    joined = cast_with_names(fx.film_table(spark, sf_dir), fx.people(spark, sf_dir))
    return presented(joined.select("movie_id", "person_id", "order", "name"))


@register("group_by_array", oracle(["film", "day"], """
SELECT f.title AS title,
       CASE WHEN f.no_genres THEN NULL ELSE f.genre_a END AS genre_1,
       CASE WHEN f.no_genres THEN NULL ELSE f.genre_b END AS genre_2,
       CAST(NULLIF(f.budget, 0) AS BIGINT) AS movie_budget,
       count(DISTINCT f.movie_id) AS n_films,
       count(*) AS n_days
FROM fx_film f JOIN fx_day d ON f.movie_id = d.movie_id
GROUP BY 1, 2, 3, 4
"""))
def q_group_by_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    movies = fx.film_table(spark, sf_dir)
    grouped = movies.groupBy("title", "genres", "movie_budget").agg(
        F.count("*").alias("n_films"), F.sum(_size("metrics")).alias("n_days"))
    return presented(grouped.select(
        "title", F.get("genres", 0).alias("genre_1"), F.get("genres", 1).alias("genre_2"),
        "movie_budget", "n_films", F.col("n_days").cast("bigint").alias("n_days")))


@register("explode_metrics", oracle(["film", "day"], """
SELECT movie_id, CAST(DATE '2024-01-01' + CAST(day AS INTEGER) AS VARCHAR) AS collect_date,
       round(CAST(CAST(popularity AS FLOAT) AS DOUBLE), 6) AS popularity, vote_count,
       round(CAST(CAST(vote_average AS FLOAT) AS DOUBLE), 6) AS vote_average, gross
FROM fx_day
"""))
def q_explode_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.operators.nested import explode_entries
    rows = explode_entries(fx.film_table(spark, sf_dir), ["movie_id"], "metrics")
    return presented(rows.select("movie_id", "collect_date", "popularity", "vote_count",
                                 "vote_average", "gross"))


@register("array_field", oracle(["film", "line", "company", "day"], """
SELECT movie_id,
       row_number() OVER (PARTITION BY movie_id ORDER BY company_id) - 1 AS pos,
       company_id
FROM (SELECT DISTINCT l.movie_id, l.company_id
      FROM fx_line l JOIN fx_day d ON l.movie_id = d.movie_id AND d.day = 0
      JOIN fx_company c ON l.company_id = c.company_id) x
"""))
def q_array_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _day_staging(spark, sf_dir, 0)["movies"]
    return presented(m.select("movie_id", F.posexplode("production_companies").alias(
        "pos", "company_id")))


# Merges, publish, restructure, tables --------------------------------------------

def _scratch_db(spark: SparkSession, label: str) -> str:
    from nestmart.session import new_id, scratch_path
    from nestmart.sources.tables import ensure_database
    name = f"nestmart_{label}_{new_id()}"
    ensure_database(spark, name, scratch_path(spark, label))
    return name


def _merged_days(spark: SparkSession, sf_dir: str, last_day: int) -> DataFrame:
    """The film table after merging fixture days 0..last_day, as frames (no tables).

    The days' line items are joined and grouped once. Each day's staging frame
    is stored by film (a scratch table under the shared
    ``spark.checkpoint.dir``) because the key check and the merge both read
    it. The three merges stay one lazy chain; the table path (``publish``)
    cuts lineage at every day by writing the tables.
    """
    from nestmart import schemas
    from nestmart.operators.merge import merge_movies
    db = _scratch_db(spark, "merged_days")
    lines = fx.stored_lines(spark, sf_dir, db)
    stored = spark.createDataFrame([], schemas.MOVIES)
    for d in fx.DAYS[: last_day + 1]:
        staged = fx.stored(spark, _day_staging(spark, sf_dir, d, lines)["movies"], db,
                           f"staging_{d}", "movie_id")
        stored = merge_movies(stored, staged, fx.day_date(d))
    return stored


def _series_rows(movies: DataFrame) -> DataFrame:
    from nestmart.operators.nested import explode_with_position
    rows = explode_with_position(movies, ["movie_id"], "metrics")
    return presented(rows.select("movie_id", "pos", "collect_date", "popularity",
                                 "vote_count", "gross"))


def _oracle_series(last_day: int) -> str:
    return oracle(["film", "day"], """
SELECT g.movie_id AS movie_id, CAST(g.day - g.first_day AS BIGINT) AS pos,
       CAST(DATE '2024-01-01' + CAST(g.day AS INTEGER) AS VARCHAR) AS collect_date,
       round(CAST(CAST(p.popularity AS FLOAT) AS DOUBLE), 6) AS popularity,
       p.vote_count AS vote_count,
       CASE WHEN p.movie_id IS NULL THEN NULL ELSE coalesce(bo.gross, p.gross) END AS gross
FROM grid g LEFT JOIN fx_day p ON g.movie_id = p.movie_id AND g.day = p.day
JOIN fx_film f ON g.movie_id = f.movie_id
LEFT JOIN bo ON f.imdb_id = bo.imdb_id
""", ORACLE_BO, f"""
first_seen AS (SELECT movie_id, min(day) AS first_day FROM fx_day
               WHERE day <= {last_day} GROUP BY movie_id)""", f"""
grid AS (SELECT s.movie_id, s.first_day, g.d AS day
         FROM first_seen s, unnest([0, 1, 2]) AS g(d)
         WHERE g.d >= s.first_day AND g.d <= {last_day})""")


@register("append_metrics", _oracle_series(1))
def q_append_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _series_rows(_merged_days(spark, sf_dir, 1))


@register("merge_movies", _oracle_series(2))
def q_merge_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _series_rows(_merged_days(spark, sf_dir, 2))


@register("full_join_coalesce", oracle(["film", "day"], """
SELECT f.movie_id AS movie_id, f.title AS title, f.imdb_id AS imdb_id,
       coalesce(bo.budget, CAST(NULLIF(f.budget, 0) AS BIGINT)) AS movie_budget,
       bo.opening AS opening_gross, CAST(3 - s.first_day AS BIGINT) AS n_metrics,
       CAST(DATE '2024-01-01' + CAST(s.first_day AS INTEGER) AS VARCHAR) AS first_date
FROM first_seen s JOIN fx_film f ON s.movie_id = f.movie_id
LEFT JOIN bo ON f.imdb_id = bo.imdb_id
""", ORACLE_BO, """
first_seen AS (SELECT movie_id, min(day) AS first_day FROM fx_day GROUP BY movie_id)"""))
def q_full_join_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _merged_days(spark, sf_dir, 2)
    return presented(m.select("movie_id", "title", "imdb_id", "movie_budget", "opening_gross",
                              _size("metrics").alias("n_metrics"),
                              _first("metrics", "collect_date").alias("first_date")))


def _land_days(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Land the raw datasets of every fixture day (independent writes, run side by side).

    The line items are joined and grouped once for all of them, into scratch
    tables that go when the days have landed.
    """
    from nestmart.plans.concurrent import run_all
    from nestmart.session import shuffles_removed
    from nestmart.sources import lake
    db = _scratch_db(spark, "lines")
    with shuffles_removed(spark):
        lines = fx.stored_lines(spark, sf_dir, db)
        writes = {}
        for d in fx.DAYS:
            date = fx.day_date(d)
            writes[f"details-{d}"] = (lambda d=d, date=date: lake.write_raw_json(
                fx.raw_movie_details(spark, sf_dir, d, companies=lines.companies), root, date,
                "movie_details"))
            writes[f"credits-{d}"] = (lambda date=date: lake.write_raw_json(
                lines.credits, root, date, "movie_credits"))
            writes[f"box-{d}"] = (lambda date=date: lake.write_raw_json(
                fx.raw_box_office(spark, sf_dir), root, date, "box_office"))
        run_all(writes, max_workers=6)
        fx.drop_stored_lines(spark, db)


@register("publish_day", _oracle_series(2))
def q_publish_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landed days through the whole daily job: raw JSON → clean → staging → tables."""
    from nestmart.plans.job import run_day
    from nestmart.session import scratch_path
    from nestmart.sources.tables import qualified
    db = _scratch_db(spark, "publish")
    root = scratch_path(spark, "lake")
    _land_days(spark, sf_dir, root)
    for d in fx.DAYS:
        run_day(spark, root, fx.day_date(d), db)
    return _series_rows(spark.table(qualified(db, "movies")))


@register("publish_days", _oracle_series(2))
def q_publish_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same three landed days, published in one pass over the tables."""
    from nestmart.plans.job import run_days
    from nestmart.session import scratch_path
    from nestmart.sources.tables import qualified
    db = _scratch_db(spark, "publish_days")
    root = scratch_path(spark, "lake")
    _land_days(spark, sf_dir, root)
    run_days(spark, root, [fx.day_date(d) for d in fx.DAYS], db)
    return _series_rows(spark.table(qualified(db, "movies")))


def _customer_people(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = fx.table(spark, sf_dir, "customer")
    stored = c.where(F.col("c_nationkey") < 20).select(
        F.col("c_custkey").alias("person_id"), F.col("c_name").alias("name"),
        (F.col("c_nationkey") % 3).cast("bigint").alias("gender"),
        F.col("c_mktsegment").alias("department"))
    staged = c.where(F.col("c_nationkey") >= 5).select(
        F.col("c_custkey").alias("person_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.upper("c_name"))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit(None))
        .otherwise(F.col("c_name")).alias("name"),
        ((F.col("c_nationkey") + 1) % 3).cast("bigint").alias("gender"),
        F.col("c_mktsegment").alias("department"))
    return stored, staged


@register("merge_credits", """
SELECT c_custkey AS person_id,
       CASE WHEN c_nationkey >= 5 THEN
              CASE c_mktsegment WHEN 'BUILDING' THEN upper(c_name)
                                WHEN 'MACHINERY' THEN NULL ELSE c_name END
            ELSE c_name END AS name,
       CAST(CASE WHEN c_nationkey >= 5 THEN (c_nationkey + 1) % 3 ELSE c_nationkey % 3 END
            AS BIGINT) AS gender,
       c_mktsegment AS department
FROM customer
""")
def q_merge_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.operators.merge import merge_credits
    stored, staged = _customer_people(spark, sf_dir)
    return presented(merge_credits(stored, staged))


@register("merge_companies", """
SELECT s.s_suppkey AS company_id,
       CASE WHEN s.s_nationkey >= 5 THEN
              CASE WHEN s.s_acctbal < 0 THEN NULL ELSE upper(s.s_name) END
            ELSE s.s_name END AS company_name,
       n.n_name AS company_country
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
""")
def q_merge_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.operators.merge import merge_companies
    comp = fx.table(spark, sf_dir, "supplier").join(
        fx.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    stored = comp.where(F.col("s_nationkey") < 20).select(
        F.col("s_suppkey").alias("company_id"), F.col("s_name").alias("company_name"),
        F.col("n_name").alias("company_country"))
    staged = comp.where(F.col("s_nationkey") >= 5).select(
        F.col("s_suppkey").alias("company_id"),
        F.when(F.col("s_acctbal") >= 0, F.upper("s_name")).alias("company_name"),
        F.col("n_name").alias("company_country"))
    return presented(merge_companies(stored, staged))


@register("restructure_metrics", oracle(["film", "day"], """
SELECT movie_id, pos, CAST(DATE '2024-01-01' + CAST(day AS INTEGER) AS VARCHAR) AS collect_date,
       round(CAST(CAST(popularity AS FLOAT) AS DOUBLE), 6) AS popularity, vote_count, gross
FROM ranked
WHERE movie_id % 11 <> 0 AND pos < n - CASE WHEN movie_id % 5 = 0 THEN 1 ELSE 0 END
UNION ALL
SELECT DISTINCT movie_id, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE),
       CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
FROM fx_day WHERE movie_id % 11 = 0
""", """
ranked AS (
  SELECT movie_id, day, popularity, vote_count, gross,
         row_number() OVER (PARTITION BY movie_id ORDER BY day) - 1 AS pos,
         count(*) OVER (PARTITION BY movie_id) AS n
  FROM fx_day)"""))
def q_restructure_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legacy parallel arrays built from the film table, then zipped back.

    Legacy rule: every 5th film lost the last gross entry (zip truncates),
    every 11th lost its vote-count array (zip gives an empty series).
    """
    from nestmart.plans.restructure import restructure_metrics
    m = fx.film_table(spark, sf_dir)

    def wrap(field: str) -> Column:
        return F.transform("metrics", lambda x: F.struct(x[field].alias("value")))

    gross = wrap("gross")
    legacy = m.select(
        *[c for c in m.columns if c != "metrics"],
        wrap("popularity").alias("popularity"),
        F.when(F.col("movie_id") % 11 != 0, wrap("vote_count")).alias("vote_count"),
        wrap("vote_average").alias("vote_average"),
        F.when(F.col("movie_id") % 5 == 0, F.slice(gross, F.lit(1), F.size(gross) - 1))
        .otherwise(gross).alias("gross"),
        wrap("collect_date").alias("current_date"),
    )
    out = restructure_metrics(legacy)
    rows = out.select("movie_id", F.posexplode_outer("metrics").alias("pos", "m"))
    return presented(rows.select("movie_id", "pos", "m.collect_date", "m.popularity",
                                 "m.vote_count", "m.gross"))


@register("table_swap", """
SELECT s_suppkey, upper(s_name) AS s_name, s_acctbal FROM supplier
""")
def q_table_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.sources.tables import create_table_as, qualified, swap_table
    db = _scratch_db(spark, "swap")
    sup = fx.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    create_table_as(sup, db, "suppliers")
    create_table_as(sup.withColumn("s_name", F.upper("s_name")), db, "suppliers__next",
                    bucket_by="s_suppkey", buckets=4)
    swap_table(spark, db, "suppliers__next", "suppliers")
    return presented(spark.table(qualified(db, "suppliers")))


@register("staging_lifecycle", oracle(["film", "line", "day", "company"], """
SELECT 'movies' AS table_name, count(*) AS n_rows FROM fx_day WHERE day = 0
UNION ALL
SELECT 'credits', count(DISTINCT person_id) FROM fx_line
WHERE (NOT is_crew AND ord <= 20) OR (is_crew AND job IN ('Director', 'Writer', 'Screenplay'))
UNION ALL
SELECT 'production_companies', count(DISTINCT c.company_id)
FROM fx_line l JOIN fx_day d ON l.movie_id = d.movie_id AND d.day = 0
JOIN fx_company c ON l.company_id = c.company_id
"""))
def q_staging_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the day's staging tables, record their sizes, drop them, check they are gone."""
    from functools import reduce

    from nestmart.plans.model import model_day
    from nestmart.plans.publish import stage_day
    from nestmart.session import materialize, scratch_path
    from nestmart.sources.tables import STAGED, drop_staging, read_staging, table_exists
    db = _scratch_db(spark, "staging")
    clean = _day_clean(spark, sf_dir, 0, fx.stored_lines(spark, sf_dir, db))
    clean["movie_details"] = materialize(clean["movie_details"], "details")
    stage_day(model_day(clean, fx.day_date(0)), db)
    sizes = [read_staging(spark, db, t).groupBy().count()
             .select(F.lit(t).alias("table_name"), F.col("count").alias("n_rows"))
             for t in STAGED]
    out = scratch_path(spark, "staging-sizes")
    reduce(DataFrame.unionByName, sizes).write.parquet(out)
    drop_staging(spark, db)
    left = [t for t in STAGED if table_exists(spark, db, f"staging_{t}")]
    if left:
        raise RuntimeError(f"staging tables still present after drop: {left}")
    return spark.read.parquet(out)


# Selection, responses, pages -----------------------------------------------------

@register("top_ids", """
SELECT p_partkey AS id, p_retailprice AS popularity
FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10000
""")
def q_top_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land ``part`` as a gzipped JSON-lines id export, read it back, keep the top 10,000."""
    from nestmart.operators.selection import top_ids
    from nestmart.session import scratch_path
    from nestmart.sources.lake import read_id_export
    path = scratch_path(spark, "id-export")
    (fx.table(spark, sf_dir, "part")
     .select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("popularity"))
     .write.option("compression", "gzip").json(path))
    return presented(top_ids(read_id_export(spark, path), k=10_000))


@register("top_ids_cut", """
SELECT o_custkey AS id, CAST(count(*) AS DOUBLE) AS popularity
FROM orders GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 50
""")
def q_top_ids_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 busiest customers: the cut falls among equal scores."""
    from nestmart.operators.selection import top_ids
    counts = fx.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.count("*").cast("double").alias("popularity"))
    return presented(top_ids(counts, k=50))


def _first_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of the first fetch: errored events come back without a value."""
    ev = fx.table(spark, sf_dir, "events")
    return ev.select("event_id", F.when(F.col("event_type") != "error", F.col("value"))
                     .alias("value"))


def _retry_pass(spark: SparkSession, sf_dir: str, first: DataFrame) -> DataFrame:
    """Re-fetch of the failed ids: events before noon now answer, later ones fail again."""
    from nestmart.operators.selection import split_responses
    _, failed = split_responses(first, F.col("value").isNull())
    ev = fx.table(spark, sf_dir, "events").select("event_id", "ts", F.col("value").alias("v"))
    return failed.select("event_id").join(ev, "event_id").select(
        "event_id", F.when(F.hour("ts") < 12, F.col("v")).alias("value"))


@register("response_failures", """
SELECT event_id,
       CASE WHEN event_type = 'error' OR value IS NULL THEN 'failed' ELSE 'ok' END AS status
FROM events
""")
def q_response_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.operators.selection import split_responses
    ok, failed = split_responses(_first_pass(spark, sf_dir), F.col("value").isNull())
    return ok.select("event_id", F.lit("ok").alias("status")).unionByName(
        failed.select("event_id", F.lit("failed").alias("status")))


@register("reconcile_strict", """
SELECT event_id, round(value, 6) AS value FROM events
WHERE event_type <> 'error' AND value IS NOT NULL
UNION ALL
SELECT event_id, round(value, 6) FROM events
WHERE (event_type = 'error' OR value IS NULL) AND hour(ts) < 12 AND value IS NOT NULL
""")
def q_reconcile_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.operators.selection import reconcile_strict
    first = _first_pass(spark, sf_dir)
    retry = _retry_pass(spark, sf_dir, first)
    return presented(reconcile_strict(first, retry, F.col("value").isNull()))


@register("reconcile_keep", """
SELECT event_id, round(value, 6) AS value FROM events
WHERE event_type <> 'error' AND value IS NOT NULL
UNION ALL
SELECT event_id, CASE WHEN hour(ts) < 12 THEN round(value, 6) END FROM events
WHERE event_type = 'error' OR value IS NULL
""")
def q_reconcile_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.operators.selection import reconcile_keep
    first = _first_pass(spark, sf_dir)
    retry = _retry_pass(spark, sf_dir, first)
    return presented(reconcile_keep(first, retry, F.col("value").isNull()))


def _summary_pages(spark: SparkSession, sf_dir: str, layout: Column | None = None) -> DataFrame:
    """A box-office summary page per order, in the layout the extractor reads.

    The layout varies with the order key (or is ``layout``): complete (0, 5), no performance
    block (1), no Budget row (2), no summary block at all (3), no values
    block (4). Figures: gross = total price, opening = a tenth, budget = a third.
    """
    o = fx.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 6 if layout is None else layout
    gross = F.format_number(F.round("o_totalprice").cast("bigint"), 0)
    opening = F.format_number(F.round(F.col("o_totalprice") / 10).cast("bigint"), 0)
    budget = F.format_number(F.round(F.col("o_totalprice") / 3).cast("bigint"), 0)
    row = '<div class="a-section a-spacing-none">'
    perf = F.concat(
        F.lit('<div class="mojo-performance-summary-table">'),
        F.lit(row + '<span class="a-size-small">Domestic</span>'
              '<span class="a-size-medium">$'), opening, F.lit("</span></div>"),
        F.lit(row + '<span class="a-size-small">Worldwide</span>\n'
              '<span class="a-size-medium">\n  $'), gross, F.lit("\n</span></div></div>"))
    values = F.concat(
        F.lit('<div class="mojo-summary-values mojo-hidden-from-mobile">'),
        F.lit(row + "<span>Domestic Distributor</span><span>Studio &amp; Co</span></div>"),
        F.lit(row + "<span>Domestic Opening</span>\n<span class=\"money\">$"), opening,
        F.lit("</span></div>"),
        F.when(k != 2, F.concat(F.lit(row + "<span>Budget</span><span>$"), budget,
                                F.lit("</span></div>"))).otherwise(F.lit("")),
        F.lit(row + "<span>Release Date</span><span>Jan 1, 2024</span></div></div>"))
    summary = F.concat(
        F.lit('<div class="a-section mojo-summary-table">'),
        F.when(k != 1, perf).otherwise(F.lit("")),
        F.when(k != 4, values).otherwise(F.lit("")),
        F.lit("</div>"))
    html = F.concat(
        F.lit('<html><head><title>Summary</title></head><body><div id="a-page">'),
        F.when(k != 3, summary).otherwise(F.lit('<div class="a-section">No data</div>')),
        F.lit("</div></body></html>"))
    imdb = F.concat(F.lit("tt"), F.lpad(F.col("o_orderkey").cast("string"), 7, "0"))
    return o.select(imdb.alias("imdb_id"), html.alias("html"))


@register("scrape_box_office", """
SELECT 'tt' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0') AS imdb_id,
       CASE WHEN o_orderkey % 6 IN (1, 3, 4) THEN ''
            ELSE format('{:,}', CAST(round(o_totalprice / 10) AS BIGINT)) END AS domestic_opening,
       CASE WHEN o_orderkey % 6 IN (1, 3, 4) THEN ''
            ELSE '$' || format('{:,}', CAST(round(o_totalprice) AS BIGINT)) END AS worldwide_gross,
       CASE WHEN o_orderkey % 6 IN (1, 2, 3, 4) THEN ''
            ELSE format('{:,}', CAST(round(o_totalprice / 3) AS BIGINT)) END AS budget
FROM orders
UNION ALL
SELECT url, '', '', '' FROM pages
""")
def q_scrape_box_office(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary pages built from ``orders`` plus every raw web page of ``pages`` (no figures)."""
    from nestmart.operators.pages import extract_box_office
    web = fx.table(spark, sf_dir, "pages").select(F.col("url").alias("imdb_id"), "html")
    return extract_box_office(_summary_pages(spark, sf_dir).unionByName(web))


@register("pages_to_box_office", """
WITH pages_read AS (
  SELECT o_orderkey, o_totalprice,
         CASE WHEN o_orderkey % 6 IN (1, 3, 4) AND o_orderkey % 12 < 6 THEN 0
              ELSE o_orderkey % 6 END AS layout
  FROM orders)
SELECT 'tt' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0') AS imdb_id,
       CASE WHEN layout NOT IN (1, 3, 4) THEN CAST(round(o_totalprice / 10) AS BIGINT) END
         AS domestic_opening,
       CASE WHEN layout NOT IN (1, 3, 4) THEN CAST(round(o_totalprice) AS BIGINT) END
         AS worldwide_gross,
       CASE WHEN layout NOT IN (1, 2, 3, 4) THEN CAST(round(o_totalprice / 3) AS BIGINT) END
         AS budget
FROM pages_read
UNION ALL
SELECT DISTINCT url, NULL, NULL, NULL FROM pages WHERE url IS NOT NULL
""")
def q_pages_to_box_office(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two passes of pages: of the keys that fail in the first, half answer in full when retried.

    The raw web pages are in both passes and hold no figures in either.
    """
    from nestmart.plans.box_office import pages_to_box_office
    web = fx.table(spark, sf_dir, "pages").select(F.col("url").alias("imdb_id"), "html")
    key = F.col("o_orderkey")
    again = _summary_pages(spark, sf_dir, F.when(key % 12 < 6, F.lit(0)).otherwise(key % 6))
    return presented(pages_to_box_office(_summary_pages(spark, sf_dir).unionByName(web),
                                         again.unionByName(web)))


# Calendar --------------------------------------------------------------------

ORACLE_CALENDAR_COLS = """
CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key,
strftime(d, '%Y-%m-%d') AS date_id,
CAST(year(d) AS BIGINT) AS year,
CAST(quarter(d) AS BIGINT) AS quarter,
CAST(quarter(d) AS VARCHAR) AS quarter_name,
CAST(month(d) AS BIGINT) AS month,
strftime(d, '%B') AS month_name,
strftime(d, '%b') AS month_name_short,
CAST(day(d) AS BIGINT) AS day_of_month,
CAST(dayofweek(d) + 1 AS BIGINT) AS day_of_week,
strftime(d, '%A') AS day_name,
strftime(d, '%a') AS day_name_short,
CAST(strftime(d, '%U') AS BIGINT) AS week_of_year,
CAST(dayofyear(d) AS BIGINT) AS day_of_year,
dayofweek(d) IN (0, 6) AS is_weekend"""


@register("dim_date", """
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS s, max(CAST(o_orderdate AS DATE)) AS e
           FROM orders),
days AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d FROM b)
SELECT """ + ORACLE_CALENDAR_COLS + """
FROM days
""")
def q_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar spanning every order date (the default span is a parameter)."""
    from nestmart.plans.calendar import dim_date_spanning
    return presented(dim_date_spanning(fx.table(spark, sf_dir, "orders"), "o_orderdate"))


@register("calendar_join", """
SELECT o_orderkey, CAST(strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS BIGINT) AS date_key,
       strftime(CAST(o_orderdate AS DATE), '%A') AS day_name,
       CAST(strftime(CAST(o_orderdate AS DATE), '%U') AS BIGINT) AS week_of_year,
       CAST(quarter(o_orderdate) AS VARCHAR) AS quarter_name,
       dayofweek(o_orderdate) IN (0, 6) AS is_weekend
FROM orders
""")
def q_calendar_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nestmart.plans.calendar import date_bounds, dim_date, join_calendar
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    start, end = date_bounds(orders, "o_orderdate")
    cal = dim_date(spark, start, end)
    joined = join_calendar(orders, "o_orderdate", cal, (end - start).days + 1)
    return presented(joined.select("o_orderkey", "date_key", "day_name", "week_of_year",
                                   "quarter_name", "is_weekend"))


@register("film_calendar_join", oracle(["film"], """
SELECT f.movie_id AS movie_id, f.title AS title, strftime(r.d, '%Y-%m-%d') AS release_date,
       CAST(strftime(r.d, '%Y%m%d') AS BIGINT) AS date_key,
       strftime(r.d, '%A') AS day_name
FROM fx_film f JOIN kept k ON f.movie_id = k.movie_id
LEFT JOIN (SELECT movie_id, TRY_CAST(release_date AS DATE) AS d FROM fx_film) r
  ON f.movie_id = r.movie_id
""", ORACLE_FILMS_KEPT))
def q_film_calendar_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Films to the calendar on their release date; films without a date stay."""
    from nestmart.plans.calendar import dim_date_spanning, join_calendar
    films = fx.film_table(spark, sf_dir).select("movie_id", "title", "release_date")
    joined = join_calendar(films, "release_date", dim_date_spanning(films, "release_date"))
    return presented(joined.select("movie_id", "title", "release_date", "date_key", "day_name"))


SERIES_SPAN = ("1993-01-01", "1997-12-31")

ORACLE_SERIES_DAYS = f"""
days AS (
  SELECT o_custkey, o_totalprice, o_orderstatus,
         CASE WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '{SERIES_SPAN[0]}'
                   AND DATE '{SERIES_SPAN[1]}' THEN CAST(o_orderdate AS DATE) END AS d
  FROM orders)
"""

ORACLE_MONTH_COLS = """CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month,
       dayofweek(d) IN (0, 6) AS is_weekend, count(*) AS n_days,
       round(sum(round(o_totalprice / 1000)) FILTER (o_orderstatus <> 'P'), 6) AS popularity,
       CAST(max(round(o_totalprice)) AS BIGINT) AS gross"""


@register("metric_calendar", "WITH " + ORACLE_SERIES_DAYS + f"""
SELECT o_custkey AS movie_id, {ORACLE_MONTH_COLS}
FROM days GROUP BY o_custkey, year(d), month(d), dayofweek(d) IN (0, 6)
""")
def q_metric_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per film, month and weekend, from the dates inside its series; dates beyond the
    calendar's five years have no month."""
    from nestmart.plans.calendar import film_months
    return presented(film_months(fx.order_series(spark, sf_dir), *SERIES_SPAN))


@register("month_totals", "WITH " + ORACLE_SERIES_DAYS + f"""
SELECT {ORACLE_MONTH_COLS}
FROM days GROUP BY year(d), month(d), dayofweek(d) IN (0, 6)
""")
def q_month_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over all films."""
    from nestmart.plans.calendar import month_totals
    return presented(month_totals(fx.order_series(spark, sf_dir), *SERIES_SPAN))


# Lake round trips and schema conforming ------------------------------------------

@register("raw_json_roundtrip", oracle(["film", "day", "line", "company"], """
SELECT f.movie_id AS id, f.imdb_id AS imdb_id, f.title AS title,
       CAST(CASE WHEN f.no_genres THEN 0 ELSE 2 END AS BIGINT) AS n_genres,
       coalesce(comp.n, 0) AS n_companies,
       round(d.popularity, 6) AS popularity, f.release_date AS release_date,
       round(CAST(coalesce(d.gross, 0) AS DOUBLE), 6) AS revenue
FROM fx_film f JOIN fx_day d ON f.movie_id = d.movie_id AND d.day = 0
LEFT JOIN comp ON f.movie_id = comp.movie_id
""", ORACLE_COMPANY_COUNT))
def q_raw_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land day 0's details as JSON-lines, read them back with the declared schema."""
    from nestmart.session import scratch_path
    from nestmart.sources import lake
    root = scratch_path(spark, "lake")
    date = fx.day_date(0)
    lake.write_raw_json(fx.raw_movie_details(spark, sf_dir, 0), root, date, "movie_details")
    raw = lake.read_raw_json(spark, root, date, "movie_details", multi_line=False)
    return presented(raw.select(
        F.col("id").cast("bigint").alias("id"), "imdb_id", "title",
        _size("genres").alias("n_genres"),
        _size("production_companies").alias("n_companies"),
        "popularity", "release_date", "revenue"))


@register("clean_parquet_roundtrip", oracle(["film", "day"], """
SELECT f.movie_id AS movie_id, f.imdb_id AS imdb_id,
       CAST(NULLIF(f.budget, 0) AS BIGINT) AS budget,
       round(CAST(CAST(d.popularity AS FLOAT) AS DOUBLE), 6) AS popularity,
       CAST(TRY_CAST(f.release_date AS DATE) AS VARCHAR) AS release_date,
       d.gross AS revenue, d.vote_count AS vote_count
FROM fx_film f JOIN fx_day d ON f.movie_id = d.movie_id AND d.day = 0
"""))
def q_clean_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write day 0's clean details to the clean layer and read them back."""
    from nestmart.session import scratch_path
    from nestmart.sources import lake
    root = scratch_path(spark, "lake")
    date = fx.day_date(0)
    lake.write_clean(_clean_details(spark, sf_dir, 0), root, date, "movie_details")
    back = lake.read_clean(spark, root, date, "movie_details")
    return presented(back.select("movie_id", "imdb_id", "budget", "popularity", "release_date",
                                 "revenue", "vote_count"))


@register("day_range", oracle(["film", "day"], """
SELECT f.movie_id AS movie_id, CAST(DATE '2024-01-01' + CAST(d.day AS INTEGER) AS VARCHAR)
         AS landed_on,
       round(CAST(CAST(d.popularity AS FLOAT) AS DOUBLE), 6) AS popularity,
       d.vote_count AS vote_count
FROM fx_film f JOIN fx_day d ON f.movie_id = d.movie_id AND d.day >= 1
"""))
def q_day_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fixture days' clean details in one partitioned dataset; the last two read back."""
    from nestmart.session import scratch_path
    from nestmart.sources import lake
    root = scratch_path(spark, "lake")
    companies = fx.stored_companies(spark, _scratch_db(spark, "companies"),
                                    fx.company_arrays(spark, sf_dir))
    for d in fx.DAYS:
        lake.write_days(_clean_details(spark, sf_dir, d, companies=companies).withColumn(
            "landed_on", F.lit(fx.day_date(d)).cast("date")), root, "movie_details", "landed_on")
    back = lake.read_days(spark, root, "movie_details", fx.day_date(1), fx.day_date(2))
    return presented(back.select("movie_id", "landed_on", "popularity", "vote_count"))


@register("quarantine", """
SELECT CASE WHEN o_orderkey % 7 <> 0 THEN 'tt' || o_orderkey END AS imdb_id,
       CASE WHEN o_orderkey % 7 <> 0 THEN CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR)
         END AS worldwide_gross,
       CASE WHEN o_orderkey % 7 = 0 THEN '{"imdb_id":"tt' || o_orderkey || '","worldwide_gross'
         END AS record
FROM orders
""")
def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing in which every seventh record is cut off: good records, and the bad ones' text."""
    from nestmart.session import scratch_path
    from nestmart.sources import lake
    root, date = scratch_path(spark, "lake"), fx.day_date(0)
    gross = F.round("o_totalprice").cast("bigint").cast("string")
    start = F.concat(F.lit('{"imdb_id":"tt'), "o_orderkey", F.lit('","worldwide_gross'))
    line = F.when(F.col("o_orderkey") % 7 == 0, start).otherwise(
        F.concat(start, F.lit('":"'), gross, F.lit('"}')))
    fx.table(spark, sf_dir, "orders").select(line).write.text(
        lake.day_path(root, "raw", date, "box_office", "json"))
    good = lake.quarantine(spark, root, date, "box_office")
    bad = lake.read_quarantine(spark, root, date, "box_office")
    return good.select("imdb_id", "worldwide_gross").unionByName(
        bad.select("record"), allowMissingColumns=True)


@register("conform_schema", oracle(["film", "line", "day"], """
SELECT f.movie_id AS movie_id, CAST(f.runtime AS BIGINT) AS runtime,
       c.n AS n_casts, c.first_person AS first_person, c.first_order AS first_order,
       CAST(NULLIF(f.budget, 0) AS BIGINT) AS movie_budget
FROM fx_film f LEFT JOIN (
  SELECT movie_id, count(*) AS n, arg_min(person_id, ord * 1000000000 + person_id) AS first_person,
         min(ord) AS first_order
  FROM fx_line WHERE NOT is_crew AND ord <= 20 GROUP BY movie_id) c ON f.movie_id = c.movie_id
WHERE f.popularity IS NOT NULL
"""))
def q_conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A film frame with shuffled columns, narrow or text types and reordered struct fields,
    brought back to the declared ``movies`` schema."""
    from nestmart import schemas
    from nestmart.sources.conform import conform
    m = fx.film_table(spark, sf_dir)
    messy = m.select(
        F.col("movie_budget").cast("string").alias("movie_budget"),
        F.transform("casts", lambda c: F.struct(c["order"].cast("int").alias("order"),
                                                c["person_id"].cast("string").alias("person_id")))
        .alias("casts"),
        F.col("runtime").cast("string").alias("runtime"),
        F.col("movie_id").cast("int").alias("movie_id"),
        "title", "metrics", F.lit("x").alias("not_in_schema"))
    fit = conform(messy, schemas.MOVIES)
    return presented(fit.select(
        "movie_id", "runtime", _size("casts").alias("n_casts"),
        _first("casts", "person_id").alias("first_person"),
        _first("casts", "order").alias("first_order"), "movie_budget"))


# Streaming --------------------------------------------------------------------

@register("stream_days", _oracle_series(2))
def q_stream_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days landed with markers, published by the landing stream in two runs."""
    from nestmart.session import scratch_path
    from nestmart.sources.tables import qualified
    from nestmart.streaming.landing import mark_landed, process_landed_days
    db = _scratch_db(spark, "stream")
    root = scratch_path(spark, "lake")
    checkpoint = scratch_path(spark, "landing-stream")
    _land_days(spark, sf_dir, root)
    for d in fx.DAYS:
        mark_landed(spark, root, fx.day_date(d))
        if d == 0:
            process_landed_days(spark, root, db, checkpoint)
    process_landed_days(spark, root, db, checkpoint)
    return _series_rows(spark.table(qualified(db, "movies")))
