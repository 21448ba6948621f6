"""Film-shaped inputs derived from the supplied test tables.

Every frame here is a deterministic rule over whole tables (no row subsets,
no caps): ``part`` rows become films, ``lineitem ⋈ orders ⋈ customer`` rows
become cast and crew entries, ``supplier ⋈ nation`` rows become companies,
and each film is observed on three days. The rules are plain SQL text
accepted by both Spark SQL and DuckDB, so a Spark query and its DuckDB oracle
start from the same definition; the few dialect differences (array literals,
generators, money formatting) go through ``DIALECT``.

Raw-shaped frames (nested JSON-like rows as they land) are built on the Spark
side only, from the flat rules, by ``raw_*`` functions.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# First run date; day d of the fixture is FIRST_DAY + d.
FIRST_DAY = "2024-01-01"
DAYS = (0, 1, 2)

DIALECT = {
    "spark": {
        "days": "explode(array(0, 1, 2))",
        # orders meet their customer first: line items, the larger side, are shuffled once
        "people": "JOIN ({orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey)\n"
                  "  ON l.l_orderkey = o.o_orderkey",
    },
    "duckdb": {
        "days": "unnest([0, 1, 2])",
        "people": "JOIN {orders} o ON l.l_orderkey = o.o_orderkey\n"
                  "JOIN {customer} c ON o.o_custkey = c.c_custkey",
    },
}

FX_FILM = """
SELECT
  p_partkey AS movie_id,
  CASE WHEN p_partkey % 17 = 0 THEN NULL
       WHEN p_partkey % 19 = 0 THEN ''
       ELSE concat('tt', lpad(CAST(p_partkey AS VARCHAR(20)), 7, '0')) END AS imdb_id,
  concat(p_name, ' (', p_brand, ')') AS original_title,
  p_name AS title,
  CASE WHEN p_size % 4 = 0 THEN 0 ELSE p_size * 100000 END AS budget,
  p_size % 10 = 0 AS no_genres,
  p_type AS genre_a,
  p_size AS genre_a_id,
  p_brand AS genre_b,
  p_size + 100 AS genre_b_id,
  p_size % 7 = 0 AS no_country,
  CASE p_size % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'FR' ELSE 'JP' END AS country,
  CASE WHEN p_partkey % 101 = 0 THEN NULL ELSE p_retailprice / 10 END AS popularity,
  CASE WHEN p_partkey % 3 = 0 THEN 0
       ELSE CAST(round(p_retailprice * 1000) AS BIGINT) END AS revenue,
  CASE WHEN p_partkey % 23 = 0 THEN ''
       ELSE concat('20', lpad(CAST(p_partkey % 25 AS VARCHAR(20)), 2, '0'), '-01-15')
       END AS release_date,
  60 + p_size AS runtime,
  CAST(p_size AS DOUBLE) / 5 AS vote_average,
  p_partkey % 500 AS vote_count,
  CASE WHEN p_size <= 16 THEN 0 WHEN p_size <= 33 THEN 1 ELSE 2 END AS missing_day
FROM {part}
"""

FX_LINE = """
SELECT
  l.l_partkey AS movie_id,
  o.o_custkey AS person_id,
  c.c_name AS name,
  c.c_nationkey % 3 AS gender,
  c.c_mktsegment AS department,
  l.l_suppkey AS company_id,
  CASE l.l_linenumber % 4
       WHEN 0 THEN CASE WHEN l.l_quantity > 45 THEN 'director' ELSE 'Director' END
       WHEN 1 THEN 'Writer' WHEN 2 THEN 'Screenplay' ELSE 'Producer' END AS job,
  CASE WHEN l.l_discount = 0 THEN NULL
       ELSE (l.l_orderkey + l.l_linenumber) % 30 END AS ord,
  l.l_returnflag = 'R' AS is_crew
FROM {lineitem} l
{people}
"""

# Every film is observed on two of the three days, all but its ``missing_day``
# (by size class): missing day 1 or 2 drives the placeholder branch of the
# merge, missing day 0 drives a late insert.
FX_DAY = """
SELECT
  movie_id,
  d AS day,
  popularity + d AS popularity,
  vote_count + d AS vote_count,
  vote_average,
  CASE WHEN revenue = 0 THEN NULL ELSE revenue + d * 10 END AS gross
FROM (SELECT movie_id, popularity, vote_count, vote_average, revenue, missing_day,
             {days} AS d
      FROM ({fx_film}) f) x
WHERE d <> missing_day AND popularity IS NOT NULL
"""

FX_COMPANY = """
SELECT s.s_suppkey AS company_id, s.s_name AS company_name, n.n_name AS company_country
FROM {supplier} s JOIN {nation} n ON s.s_nationkey = n.n_nationkey
"""


def _view_name(sf_dir: str, t: str) -> str:
    import hashlib
    return f"nestmart_src_{hashlib.sha1(sf_dir.encode()).hexdigest()[:10]}_{t}"


def source_views(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Temp view per test table of ``sf_dir``, created once per session.

    The view holds an already resolved Parquet relation, so fixture SQL does
    not list files and read footers again every time it names a table.
    """
    names = {t: _view_name(sf_dir, t) for t in TABLES}
    if not spark.catalog.tableExists(names["part"]):
        for t, v in names.items():
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(v)
    return names


def table_refs(dialect: str, sf_dir: str | None = None,
               spark: SparkSession | None = None) -> dict[str, str]:
    if dialect == "spark":
        if spark is not None:
            return source_views(spark, sf_dir)
        return {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}
    return {t: t for t in TABLES}


def sql(name: str, dialect: str, sf_dir: str | None = None,
        spark: SparkSession | None = None) -> str:
    """SQL text of fixture ``name`` ('film', 'line', 'day', 'company') for a dialect."""
    refs = table_refs(dialect, sf_dir, spark)
    film = FX_FILM.format(**refs)
    if name == "film":
        return film
    if name == "line":
        return FX_LINE.format(people=DIALECT[dialect]["people"].format(**refs), **refs)
    if name == "day":
        return FX_DAY.format(days=DIALECT[dialect]["days"], fx_film=film)
    if name == "company":
        return FX_COMPANY.format(**refs)
    raise KeyError(name)


def with_clause(names: list[str]) -> str:
    """``WITH fx_film AS (...), ...`` for DuckDB oracles."""
    parts = [f"fx_{n} AS ({sql(n, 'duckdb')})" for n in names]
    return "WITH " + ",\n".join(parts)


# ---------------------------------------------------------------- Spark frames

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.table(source_views(spark, sf_dir)[name])


def fx(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(sql(name, "spark", sf_dir, spark))


def day_date(d: int | str) -> str:
    import datetime as dt
    return (dt.date.fromisoformat(FIRST_DAY) + dt.timedelta(days=int(d))).isoformat()


def raw_movie_details(spark: SparkSession, sf_dir: str, day: int | None = None,
                      duplicate_rule: bool = False,
                      companies: DataFrame | None = None) -> DataFrame:
    """``movie_details`` rows as they land (nested, untyped numbers as double).

    With ``day`` set, only films observed that day, carrying that day's
    popularity and vote count. With ``duplicate_rule`` every film of size 1, 11,
    21, ... appears twice (exact duplicates) to exercise de-duplication.
    ``companies`` are the company arrays if they are stored already.
    """
    film = fx(spark, sf_dir, "film")
    companies = company_arrays(spark, sf_dir) if companies is None else companies
    if day is not None:
        # The day's figures; on the last day titles change, which a merge must ignore.
        seen = fx(spark, sf_dir, "day").where(F.col("day") == day).select(
            "movie_id", F.col("popularity").alias("day_pop"),
            F.col("vote_count").alias("day_votes"), F.col("gross").alias("day_gross"))
        film = (film.join(seen, "movie_id")
                .withColumn("popularity", F.col("day_pop"))
                .withColumn("vote_count", F.col("day_votes"))
                .withColumn("revenue", F.coalesce("day_gross", F.lit(0))))
        if day == DAYS[-1]:
            film = film.withColumn("title", F.upper("title"))
    genre = F.struct(F.col("genre_a_id").cast("bigint").alias("id"),
                     F.col("genre_a").alias("name"))
    genre2 = F.struct(F.col("genre_b_id").cast("bigint").alias("id"),
                      F.col("genre_b").alias("name"))
    empty_genres = F.array().cast("array<struct<id:bigint,name:string>>")
    raw = film.join(companies, "movie_id", "left").select(
        F.col("movie_id").cast("double").alias("id"),
        "imdb_id", "original_title", "title",
        F.col("budget").cast("double").alias("budget"),
        F.when(F.col("no_genres"), empty_genres).otherwise(F.array(genre, genre2)).alias("genres"),
        F.when(F.col("no_country"), F.array().cast("array<string>"))
        .otherwise(F.array("country")).alias("origin_country"),
        F.col("popularity").cast("double").alias("popularity"),
        F.coalesce("production_companies",
                   F.array().cast("array<struct<id:bigint,name:string,origin_country:string>>"))
        .alias("production_companies"),
        "release_date",
        F.col("revenue").cast("double").alias("revenue"),
        F.col("runtime").cast("double").alias("runtime"),
        F.col("vote_average").cast("double").alias("vote_average"),
        F.col("vote_count").cast("double").alias("vote_count"),
    )
    if duplicate_rule:
        dup = raw.where((F.col("runtime") - 61) % 10 == 0)
        raw = raw.unionByName(dup)
    return raw


def company_arrays(spark: SparkSession, sf_dir: str,
                   pairs: DataFrame | None = None) -> DataFrame:
    """Per film, its distinct suppliers as raw company structs (sorted by id).

    A film's rows come from all partitions, so they are shuffled as flat rows:
    lists collected before the shuffle would hold about one entry each.
    """
    if pairs is None:
        pairs = fx(spark, sf_dir, "line").select("movie_id", "company_id").distinct()
    comp = fx(spark, sf_dir, "company")
    joined = pairs.join(comp, "company_id").repartition("movie_id")
    return joined.groupBy("movie_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("company_id").alias("id"), F.col("company_name").alias("name"),
        F.col("company_country").alias("origin_country")))).alias("production_companies"))


def _credit_arrays() -> list[Column]:
    """The cast and the crew of a film's line items, as they land."""
    cast = F.struct(F.col("person_id").alias("id"), F.col("gender").cast("bigint").alias("gender"),
                    "name", F.col("ord").cast("bigint").alias("order"),
                    F.col("department").alias("known_for_department"))
    crew = F.struct(F.col("person_id").alias("id"), F.col("gender").cast("bigint").alias("gender"),
                    "name", "department", "job")
    return [F.sort_array(F.collect_list(F.when(~F.col("is_crew"), cast))).alias("cast"),
            F.sort_array(F.collect_list(F.when(F.col("is_crew"), crew))).alias("crew")]


def raw_movie_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``movie_credits`` rows as they land: per film, cast and crew arrays.

    Cast entries come from non-returned line items, crew from returned ones;
    a film with no entries of a kind carries an empty array.
    """
    grouped = fx(spark, sf_dir, "line").repartition("movie_id").groupBy("movie_id").agg(
        *_credit_arrays())
    return grouped.select(F.col("movie_id").alias("id"), "cast", "crew")


class FilmLines(NamedTuple):
    """What the line items say of each film, stored by film."""

    credits: DataFrame     #: raw ``movie_credits`` rows
    companies: DataFrame   #: ``company_arrays`` rows


def stored_companies(spark: SparkSession, database: str, companies: DataFrame) -> DataFrame:
    """Company arrays as a table bucketed by film, for inputs of several days."""
    return stored(spark, companies, database, "film_companies", "movie_id")


def stored_lines(spark: SparkSession, sf_dir: str, database: str) -> FilmLines:
    """Raw credits and company arrays of all films in one pass over the line items.

    The same rows as :func:`raw_movie_credits` and :func:`company_arrays` give,
    as tables of ``database`` bucketed by film: inputs of several days and
    outputs read them without joining and grouping the line items again.
    """
    grouped = fx(spark, sf_dir, "line").repartition("movie_id").groupBy("movie_id").agg(
        *_credit_arrays(), F.collect_set("company_id").alias("company_ids"))
    lines = stored(spark, grouped.withColumnRenamed("movie_id", "id"), database, "film_lines",
                   "id")
    pairs = lines.select(F.col("id").alias("movie_id"), F.explode("company_ids").alias(
        "company_id"))
    return FilmLines(lines.select("id", "cast", "crew"), stored_companies(
        spark, database, company_arrays(spark, sf_dir, pairs)))


def drop_stored_lines(spark: SparkSession, database: str) -> None:
    """Drop the tables of :func:`stored_lines`; nothing may read them later."""
    from nestmart.sources.tables import drop_table
    for name in ("film_lines", "film_companies"):
        drop_table(spark, database, name)


def stored(spark: SparkSession, df: DataFrame, database: str, name: str,
           key: str) -> DataFrame:
    """``df`` as a table bucketed by ``key``: joins and groups by it need no shuffle of it."""
    from nestmart.sources.tables import create_table_as
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.table(create_table_as(df, database, name, bucket_by=key, buckets=n))


def raw_box_office(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``box_office`` rows as they land: money as display strings.

    Built from ``orders``: one row per order, ``imdb_id = 'tt' + orderkey``.
    Pending orders (status ``P``) land without an imdb id. The string forms
    rotate with the order key: blank, a dash, ``$`` with
    thousands separators, separators only, and a bare ``$`` amount; the
    intended numbers are ``o_totalprice`` rounded (gross), a tenth of it
    (opening) and a third of it (budget).
    """
    orders = table(spark, sf_dir, "orders")
    gross = F.round("o_totalprice").cast("bigint")
    opening = F.round(F.col("o_totalprice") / 10).cast("bigint")
    budget = F.round(F.col("o_totalprice") / 3).cast("bigint")
    k = F.col("o_orderkey") % 5

    def shown(v):
        grouped = F.format_number(v, 0)
        return (F.when(k == 0, F.lit(""))
                .when(k == 1, F.lit("–"))
                .when(k == 2, F.concat(F.lit("$"), grouped))
                .when(k == 3, grouped)
                .otherwise(F.concat(F.lit("$"), v.cast("string"))))

    imdb = F.concat(F.lit("tt"), F.lpad(F.col("o_orderkey").cast("string"), 7, "0"))
    return orders.select(
        F.when(F.col("o_orderstatus") != "P", imdb).alias("imdb_id"),
        shown(opening).alias("domestic_opening"),
        shown(gross).alias("worldwide_gross"),
        shown(budget).alias("budget"),
    )


def film_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested ``movies`` table as after the three fixture days (reports input).

    Films come from ``fx_film`` (films without popularity never pass the
    clean step), casts from non-returned line items with ``ord <= 20``,
    crews from returned ones with a kept job, and ``metrics`` holds one entry
    per observed day in date order.
    """
    from nestmart import schemas
    from nestmart.functions.columns import as_float64, empty_to_null, zero_to_null
    from nestmart.plans.model import collect_casts, collect_crews

    film = fx(spark, sf_dir, "film").where(F.col("popularity").isNotNull())
    line = fx(spark, sf_dir, "line")
    cast = line.where(~F.col("is_crew") & (F.col("ord") <= 20)).select(
        "movie_id", "person_id", F.col("ord").alias("order"))
    crew = line.where(F.col("is_crew") & F.col("job").isin("Director", "Writer", "Screenplay")
                      ).select("movie_id", "person_id", "job")
    metric = F.struct(
        as_float64("popularity").alias("popularity"),
        F.col("vote_count").cast("bigint").alias("vote_count"),
        as_float64("vote_average").alias("vote_average"),
        F.col("gross").cast("bigint").alias("gross"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), F.col("day").cast("int")).alias("collect_date"),
    )
    days = fx(spark, sf_dir, "day").groupBy("movie_id").agg(
        F.sort_array(F.collect_list(F.struct(F.col("day").alias("_d"), metric.alias("m"))))
        .alias("_days"))
    series = days.select("movie_id", F.col("_days.m").alias("metrics"))
    companies = fx(spark, sf_dir, "line").select("movie_id", "company_id").distinct().groupBy(
        "movie_id").agg(F.sort_array(F.collect_list("company_id")).alias("production_companies"))
    films = film.select(
        "movie_id", "imdb_id", "original_title", "title",
        F.when(~F.col("no_genres"), F.array("genre_a", "genre_b")).alias("genres"),
        F.when(F.col("no_country"), F.array().cast("array<string>"))
        .otherwise(F.array("country")).alias("origin_country"),
        F.col("release_date").try_cast("date").alias("release_date"),
        "runtime",
        zero_to_null("budget").alias("movie_budget"),
    )
    out = (films.join(collect_casts(cast), "movie_id", "left")
           .join(collect_crews(crew), "movie_id", "left")
           .join(companies, "movie_id", "left")
           .join(series, "movie_id", "left"))
    return out.select(
        "movie_id", "imdb_id", "original_title", "title", "genres", "origin_country",
        empty_to_null("production_companies").alias("production_companies"),
        "release_date", "runtime", "casts", "crews",
        F.lit(None).cast("bigint").alias("opening_gross"),
        "movie_budget", "metrics",
    ).to(schemas.MOVIES)


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The person dimension: one row per customer appearing in any line item."""
    from nestmart import schemas
    return fx(spark, sf_dir, "line").select(
        "person_id", "name", "gender", "department").distinct().to(schemas.CREDITS)


def order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Films with years of dated metrics: one per customer with orders, an entry per order.

    Popularity is the order's total in thousands (NULL for pending orders),
    gross the rounded total, the date the order's.
    """
    from nestmart import schemas
    total = F.col("o_totalprice")
    entry = F.struct(
        F.col("o_orderdate").cast("date").alias("collect_date"), F.col("o_orderkey"),
        F.when(F.col("o_orderstatus") != "P", F.round(total / 1000)).alias("popularity"),
        F.round(total).cast("bigint").alias("gross"))
    films = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("movie_id")).agg(
        F.sort_array(F.collect_list(entry)).alias("_entries"))
    return films.select("movie_id", F.transform("_entries", lambda e: F.struct(
        e["popularity"].alias("popularity"), F.lit(None).cast("bigint").alias("vote_count"),
        F.lit(None).cast("double").alias("vote_average"), e["gross"].alias("gross"),
        e["collect_date"].alias("collect_date"))).cast(
            T.ArrayType(schemas.METRIC)).alias("metrics"))
