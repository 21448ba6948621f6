"""Clean and model jobs on hand-made raw rows (FIXTURES §3)."""

import datetime as dt

from nestmart import schemas
from nestmart.plans.clean import (clean_box_office, clean_cast, clean_credits, clean_crew,
                                  clean_movie_details)
from nestmart.plans.model import (collect_casts, collect_crews, model_companies,
                                  model_credits, model_movies)


def details_row(id, popularity=1.5, budget=100.0, revenue=7.0, runtime=90.0, genres=None,
                companies=None, release="2020-01-15", imdb="tt1", title="t"):
    return (id, imdb, title, title, budget,
            [(10, "Drama"), (11, "Comedy")] if genres is None else genres,
            [], popularity,
            [(5, "Acme", "US")] if companies is None else companies,
            release, revenue, runtime, 6.5, 10.0)


def test_clean_movie_details_rules(spark):
    rows = [
        details_row(None),                        # NULL id -> dropped
        details_row(1.0, popularity=None),        # NULL popularity -> dropped
        details_row(2.0), details_row(2.0),       # exact duplicate -> one row
        details_row(3.0, budget=0.0, revenue=0.0, runtime=0.0, genres=[], companies=[],
                    release=""),
    ]
    raw = spark.createDataFrame(rows, schemas.RAW_MOVIE_DETAILS)
    out = {r.movie_id: r for r in clean_movie_details(raw).collect()}
    assert sorted(out) == [2, 3]
    r3 = out[3]
    assert (r3.budget, r3.revenue, r3.runtime) == (None, None, 0)
    assert r3.genres is None and r3.production_companies is None
    assert r3.origin_country == []          # stays empty, not NULL
    assert r3.release_date is None
    r2 = out[2]
    assert [(g.genre_id, g.genre_name) for g in r2.genres] == [(10, "Drama"), (11, "Comedy")]
    assert r2.release_date == dt.date(2020, 1, 15)


def test_clean_credits_cast_cut_and_jobs(spark):
    cast = [(1, 1, "a", 20, "Acting"), (2, 1, "b", 21, "Acting"), (3, 1, "c", None, "Acting")]
    crew = [(4, 1, "d", "Directing", "Director"), (5, 1, "e", "Directing", "director"),
            (6, 1, "f", "Production", "Producer")]
    raw = spark.createDataFrame([(100, cast, crew), (101, None, []), (None, cast, crew)],
                                schemas.RAW_MOVIE_CREDITS)
    credits = clean_credits(raw)
    assert [r.person_id for r in clean_cast(credits).collect()] == [1]
    assert [r.job for r in clean_crew(credits).collect()] == ["Director"]
    assert sorted(r.movie_id for r in credits.collect()) == [100, 101]


def test_clean_box_office_strings(spark):
    raw = spark.createDataFrame(
        [("tt1", "", "", ""), ("tt2", "–", "–", "–"), ("tt3", "1,234", "$1,234,567", "$5"),
         (None, "1", "1", "1")], schemas.RAW_BOX_OFFICE)
    out = {r.imdb_id: r for r in clean_box_office(raw).collect()}
    assert sorted(out) == ["tt1", "tt2", "tt3"]
    assert (out["tt1"].worldwide_gross, out["tt2"].budget) == (None, None)
    assert (out["tt3"].domestic_opening, out["tt3"].worldwide_gross, out["tt3"].budget) == \
        (1234, 1234567, None)


def _clean_frames(spark):
    details = clean_movie_details(spark.createDataFrame(
        [details_row(1.0, imdb="tt1"), details_row(2.0, imdb=None, budget=0.0, revenue=7.0)],
        schemas.RAW_MOVIE_DETAILS))
    cast = spark.createDataFrame(
        [(1, 9, 1, "p9", 0, "Acting"), (1, 9, 1, "p9", 1, "Acting"), (1, 8, 0, "p8", 2, "Acting")],
        schemas.CLEAN_CAST)
    crew = spark.createDataFrame([(1, 9, 1, "p9", "Directing", "Director")], schemas.CLEAN_CREW)
    bo = spark.createDataFrame([("tt1", 50, None, 300)], schemas.CLEAN_BOX_OFFICE)
    return details, cast, crew, bo


def test_model_movies_joins_and_fallbacks(spark):
    details, cast, crew, bo = _clean_frames(spark)
    out = {r.movie_id: r for r in model_movies(
        details, [collect_casts(cast), collect_crews(crew)], bo, "2024-01-01").collect()}
    one, two = out[1], out[2]
    assert one.movie_budget == 300 and one.opening_gross == 50
    assert one.metrics[0].gross == 7                 # box office gross NULL -> revenue
    assert [c.person_id for c in one.casts] == [9, 9, 8]   # same person twice kept
    assert two.imdb_id is None and two.opening_gross is None  # kept, no box office
    assert two.movie_budget is None and two.casts is None
    assert one.metrics[0].collect_date == dt.date(2024, 1, 1)
    assert one.genres == ["Drama", "Comedy"] and one.production_companies == [5]


def test_model_credits_one_row_per_person(spark):
    details, cast, crew, bo = _clean_frames(spark)
    people = model_credits(cast, crew).collect()
    assert sorted(r.person_id for r in people) == [8, 9]
    assert {r.person_id: r.department for r in people}[9] == "Acting"  # cast row wins


def test_model_companies_drop_null_ids(spark):
    details = clean_movie_details(spark.createDataFrame(
        [details_row(1.0, companies=[(5, "Acme", "US"), (None, "Ghost", "FR")]),
         details_row(2.0, companies=[(5, "Acme", "US")])], schemas.RAW_MOVIE_DETAILS))
    assert [(r.company_id, r.company_name) for r in model_companies(details).collect()] == \
        [(5, "Acme")]


def test_spread_null_key_keeps_join_results(spark):
    from pyspark.sql import functions as F

    from nestmart.plans.model import spread_null_key
    films = spark.createDataFrame([(1, None), (2, ""), (3, "tt3"), (4, None)],
                                  "movie_id int, imdb_id string")
    bo = spark.createDataFrame([("", 10), ("tt3", 30), ("\u0000none:1", 99)],
                               "bo_imdb_id string, gross int")
    out = films.join(bo, (spread_null_key(F.col("imdb_id"), F.col("movie_id"))
                          == F.col("bo_imdb_id")) & F.col("imdb_id").isNotNull(), "left")
    got = {r.movie_id: r.gross for r in out.collect()}
    # NULL ids never match, not even a right-side key equal to the spread tag;
    # blank and real ids match as a plain equality join would.
    assert got == {1: None, 2: 10, 3: 30, 4: None}
