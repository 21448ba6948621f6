"""Merge semantics and publish invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from nestmart import schemas
from nestmart.operators.keys import DuplicateKeyError
from nestmart.operators.merge import merge_companies, merge_credits, merge_movies


def film(spark, movie_id, title="t", budget=100, day="2024-01-01", pop=1.0, metrics=True):
    d = dt.date.fromisoformat(day)
    m = [(pop, 1, 1.0, 10, d)] if metrics else None
    return spark.createDataFrame(
        [(movie_id, "tt", title, title, ["g"], [], [1], d, 90, [(1, 0)], [(1, "Director")],
          None, budget, m)], schemas.MOVIES)


def union(*dfs):
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def test_matched_keeps_static_and_old_budget(spark):
    stored = film(spark, 1, title="old", budget=100)
    staged = film(spark, 1, title="new", budget=None, day="2024-01-02", pop=2.0)
    r = merge_movies(stored, staged, "2024-01-02").first()
    assert r.title == "old" and r.movie_budget == 100
    assert [m.popularity for m in r.metrics] == [1.0, 2.0]


def test_absent_today_gets_placeholder_and_new_is_inserted(spark):
    stored = film(spark, 1)
    staged = film(spark, 2, day="2024-01-02")
    out = {r.movie_id: r for r in merge_movies(stored, staged, "2024-01-02").collect()}
    assert [m.popularity for m in out[1].metrics] == [1.0, None]
    assert out[1].metrics[1].collect_date == dt.date(2024, 1, 2)
    assert len(out[2].metrics) == 1


def test_same_day_twice_appends_twice_unless_replace(spark):
    stored = merge_movies(film(spark, 1), film(spark, 1, day="2024-01-02"), "2024-01-02")
    again = film(spark, 1, day="2024-01-02", pop=3.0)
    twice = merge_movies(stored, again, "2024-01-02").first()
    assert [m.collect_date.day for m in twice.metrics] == [1, 2, 2]
    once = merge_movies(stored, again, "2024-01-02", replace_day=True).first()
    assert [(m.collect_date.day, m.popularity) for m in once.metrics] == [(1, 1.0), (2, 3.0)]


def test_duplicate_staging_key_fails(spark):
    with pytest.raises(DuplicateKeyError):
        merge_movies(film(spark, 1), union(film(spark, 2), film(spark, 2)), "2024-01-02")


def test_dim_merge_overwrites_with_null_and_inserts_null_keys(spark):
    stored = spark.createDataFrame([(1, "a", 1, "X"), (2, "b", 0, "Y")], schemas.CREDITS)
    staged = spark.createDataFrame([(1, None, 0, "Z"), (3, "c", 1, "W")], schemas.CREDITS)
    out = {r.person_id: r for r in merge_credits(stored, staged).collect()}
    assert out[1].name is None and out[1].department == "Z"
    assert out[2].name == "b" and out[3].name == "c"
    cs = spark.createDataFrame([(1, "acme", "US")], schemas.PRODUCTION_COMPANIES)
    cn = spark.createDataFrame([(None, "ghost", "FR")], schemas.PRODUCTION_COMPANIES)
    rows = merge_companies(cs, cn).collect()
    assert sorted((r.company_id or 0, r.company_name) for r in rows) == [(0, "ghost"), (1, "acme")]


def test_series_length_invariant_over_days(spark):
    """After n days each film's series has one entry per day since it first appeared."""
    presence = {1: [0, 1, 2, 3], 2: [1, 3], 3: [0], 4: [2, 3]}
    stored = spark.createDataFrame([], schemas.MOVIES)
    sizes = []
    for d in range(4):
        day = f"2024-01-0{d + 1}"
        staged = union(*[film(spark, k, day=day) for k, days in presence.items() if d in days])
        stored = merge_movies(stored, staged, day)
        rows = {r.movie_id: len(r.metrics) for r in stored.collect()}
        sizes.append(len(rows))
        for k, days in presence.items():
            if days[0] <= d:
                assert rows[k] == d - days[0] + 1
    assert sizes == sorted(sizes)     # the table never shrinks


def test_publish_day_with_tables(spark, scratch_db):
    from nestmart.plans.publish import publish_day
    from nestmart.sources.tables import qualified, table_exists
    credits = spark.createDataFrame([(1, "a", 1, "X")], schemas.CREDITS)
    comps = spark.createDataFrame([(5, "acme", "US")], schemas.PRODUCTION_COMPANIES)
    for d, ids in enumerate([[1, 2], [2], [1, 3]]):
        day = f"2024-01-0{d + 1}"
        staging = {"movies": union(*[film(spark, k, day=day) for k in ids]),
                   "credits": credits, "production_companies": comps}
        publish_day(spark, staging, scratch_db, day, buckets=4)
    movies = spark.table(qualified(scratch_db, "movies"))
    got = {r.movie_id: r.n for r in movies.select("movie_id", F.size("metrics").alias("n")).collect()}
    assert got == {1: 3, 2: 3, 3: 1}
    assert not table_exists(spark, scratch_db, "staging_movies")
    assert spark.table(qualified(scratch_db, "credits")).count() == 1


def test_bucket_count_is_kept_and_grows(spark, scratch_db):
    from nestmart.plans import publish
    from nestmart.sources.tables import bucket_count, create_table_as
    df = spark.createDataFrame([(1, "a", "US")], schemas.PRODUCTION_COMPANIES)
    create_table_as(df, scratch_db, "production_companies", bucket_by="company_id", buckets=3)
    assert bucket_count(spark, scratch_db, "production_companies") == 3
    assert publish.choose_buckets(spark, scratch_db, "production_companies", None) == 3
    assert publish.choose_buckets(spark, scratch_db, "production_companies", 5) == 5
    assert publish.choose_buckets(spark, scratch_db, "movies", None) == \
        publish.default_buckets(spark)
    old = publish.TARGET_BUCKET_BYTES
    try:
        publish.TARGET_BUCKET_BYTES = 1        # every byte is "too big": doubles until it fits
        assert publish.choose_buckets(spark, scratch_db, "production_companies", None) > 3
    finally:
        publish.TARGET_BUCKET_BYTES = old


def test_older_day_run_again_after_later_ones(spark):
    stored = merge_movies(film(spark, 1, budget=100),
                          union(film(spark, 1, budget=300, day="2024-01-03", pop=3.0),
                                film(spark, 2, day="2024-01-03", pop=5.0)), "2024-01-03")
    late = film(spark, 1, budget=200, day="2024-01-02", pop=2.0)
    out = {r.movie_id: r for r in
           merge_movies(stored, late, "2024-01-02", replace_day=True).collect()}
    assert [m.popularity for m in out[1].metrics] == [1.0, 2.0, 3.0]
    assert out[1].movie_budget == 300            # money of the latest day stays
    assert [m.popularity for m in out[2].metrics] == [5.0]   # no entry before its first day
    absent = merge_movies(stored, film(spark, 9, day="2024-01-02"), "2024-01-02",
                          replace_day=True).where("movie_id = 1").first()
    assert [m.popularity for m in absent.metrics] == [1.0, None, 3.0]


def _people(spark, rows):
    return spark.createDataFrame(rows, schemas.CREDITS)


def _film(spark, rows):
    """(movie_id, title, opening, budget, metrics) as film rows."""
    full = [(i, f"tt{i}", t, t, [t], None, None, None, 90, None, None, o, b, m)
            for i, t, o, b, m in rows]
    return spark.createDataFrame(full, schemas.MOVIES)


def test_several_days_in_one_merge_equal_day_by_day(spark):
    import datetime as dt

    from nestmart.operators.merge import merge_movie_days, merge_movies
    days = [dt.date(2024, 1, d) for d in (1, 2, 3, 4)]

    def metric(d, v):
        return [(float(v), v, 1.0, v * 10, d)]

    stored = _film(spark, [(1, "one", 5, None, metric(dt.date(2023, 12, 31), 1)), (2, "two", None, 7, None),
                           (9, "nine", 1, 1, [])])
    staged = {
        days[0]: [(1, "ONE", None, 3, metric(days[0], 2)), (3, "three", 1, None, metric(days[0], 3))],
        days[1]: [(3, "THREE", None, 4, metric(days[1], 4)), (2, "x", 8, None, None)],
        days[2]: [],
        days[3]: [(4, "four", None, None, metric(days[3], 5)), (3, "y", 2, None, metric(days[3], 6)),
                  (None, "no id", 1, 2, metric(days[3], 7))],
    }
    want = stored
    for d in days:
        want = merge_movies(want, _film(spark, staged[d]), d)
    frames = [_film(spark, rows).withColumn("run_date", F.lit(str(d)).cast("date"))
              for d, rows in staged.items()]
    union = frames[0]
    for f in frames[1:]:
        union = union.unionByName(f)
    got = merge_movie_days(stored, union, days)
    key = lambda r: (r.movie_id is None, r.movie_id or 0)
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
    assert got.schema == want.schema
    with pytest.raises(DuplicateKeyError):
        merge_movie_days(stored, union.unionByName(frames[0]), days)


def test_days_published_together_and_again(spark, scratch_db):
    from nestmart.plans.publish import publish_day, publish_days
    from nestmart.sources import tables
    days = ["2024-01-01", "2024-01-02", "2024-01-04"]

    def staging(d, v):
        return {"movies": _film(spark, [(1, f"t{v}", None, v, [(1.0, v, 1.0, v, None)])]),
                "credits": _people(spark, [(v, "new", 1, None), (7, f"last {d}", None, "x")]),
                "production_companies": spark.createDataFrame(
                    [(1, f"c{v}", None)], schemas.PRODUCTION_COMPANIES)}

    publish_days(spark, {d: staging(d, k) for k, d in enumerate(days)}, scratch_db, buckets=3)

    def rows(t):
        return spark.table(tables.qualified(scratch_db, t)).collect()

    assert tables.published_days(spark, scratch_db, "movies") == set(days)
    assert tables.published_day(spark, scratch_db, "credits") == days[-1]
    (film,) = rows("movies")
    assert [m.vote_count for m in film.metrics] == [0, 1, 2] and film.movie_budget == 2
    assert {r.person_id: r.name for r in rows("credits")} == {
        0: "new", 1: "new", 2: "new", 7: "last 2024-01-04"}
    assert [r.company_name for r in rows("production_companies")] == ["c2"]
    # the last day, an older one, and both with a new one: nothing is doubled
    publish_day(spark, staging(days[0], 0), scratch_db, days[0])
    publish_day(spark, staging(days[2], 2), scratch_db, days[2])
    publish_days(spark, {d: staging(d, k) for k, d in enumerate([*days, "2024-01-05"])}, scratch_db)
    (film,) = rows("movies")
    assert [m.vote_count for m in film.metrics] == [0, 1, 2, 3]
    assert not tables.table_exists(spark, scratch_db, "staging_movies")


def test_day_ranges_round_trip():
    from nestmart.sources.tables import day_ranges, days_of
    days = ["2024-02-28", "2024-02-29", "2024-03-01", "2023-12-31", "2024-01-01", "2024-05-05"]
    text = day_ranges(days)
    assert text == "2023-12-31..2024-01-01,2024-02-28..2024-03-01,2024-05-05"
    assert days_of(text) == set(days) and days_of("") == days_of(None) == set()


def _dim_files(spark, db, table):
    """File names and rows of each key bucket."""
    from nestmart.sources.tables import KEY_BUCKET, qualified
    out = {}
    for r in spark.table(qualified(db, table)).select(
            KEY_BUCKET, F.col("_metadata.file_path").alias("f")).distinct().collect():
        out.setdefault(r[KEY_BUCKET], set()).add(r.f)
    return out


def _dim_day(spark, people, companies=()):
    return {"movies": spark.createDataFrame([], schemas.MOVIES), "credits": _people(spark, people),
            "production_companies": spark.createDataFrame(list(companies),
                                                          schemas.PRODUCTION_COMPANIES)}


def test_only_changed_key_buckets_are_written(spark, scratch_db):
    from nestmart.plans.publish import publish_day
    from nestmart.sources import tables
    people = [(k, f"p{k}", 1, "X") for k in range(200)]
    publish_day(spark, _dim_day(spark, people), scratch_db, "2024-01-01", buckets=8)
    before = _dim_files(spark, scratch_db, "credits")
    assert len(before) == 8 and tables.key_buckets(spark, scratch_db, "credits") == 8

    # equal rows, one changed to NULL, one new
    staged = [(3, "p3", 1, "X"), (4, "p4", 1, "X"), (5, None, 1, "X"), (900, "new", 0, None)]
    publish_day(spark, _dim_day(spark, staged), scratch_db, "2024-01-02")
    after = _dim_files(spark, scratch_db, "credits")
    touched = {r[0] for r in tables.with_key_bucket(
        spark.createDataFrame([(5,), (900,)], "person_id bigint"), "person_id", 8).select(
        tables.KEY_BUCKET).collect()}
    assert {k for k in after if after[k] != before[k]} == touched
    rows = {r.person_id: r for r in
            spark.table(tables.qualified(scratch_db, "credits")).collect()}
    assert len(rows) == 201
    assert rows[5].name is None and rows[900].name == "new" and rows[4].name == "p4"
    assert tables.published_days(spark, scratch_db, "credits") == {"2024-01-01", "2024-01-02"}

    # a day without changes writes nothing and is recorded
    publish_day(spark, _dim_day(spark, staged), scratch_db, "2024-01-03")
    assert _dim_files(spark, scratch_db, "credits") == after
    assert "2024-01-03" in tables.published_days(spark, scratch_db, "credits")

    # another bucket count: the whole table is laid out again, replaced files go
    publish_day(spark, _dim_day(spark, [(6, "six", 1, "X")]), scratch_db, "2024-01-04", buckets=3)
    assert len(_dim_files(spark, scratch_db, "credits")) == 3
    out = {r.person_id: r.name for r in
           spark.table(tables.qualified(scratch_db, "credits")).collect()}
    assert len(out) == 201 and out[6] == "six" and out[5] is None
    live = tables.stored_bytes(spark, scratch_db, "credits")
    assert 0 < live < 3 * 8_000


def test_switch_of_key_buckets_that_broke_off(spark, scratch_db, monkeypatch):
    from nestmart.plans.publish import publish_day
    from nestmart.sources import tables
    publish_day(spark, _dim_day(spark, [(k, "old", 1, "X") for k in range(50)]), scratch_db,
                "2024-01-01", buckets=4)
    staged = [(k, "new", 1, "X") for k in range(0, 60, 2)]
    real = tables.point_partitions

    def breaks_off(spark, database, table, folder, changed):
        real(spark, database, table, folder, changed[:1])
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, "point_partitions", breaks_off)
    with pytest.raises(RuntimeError):
        publish_day(spark, _dim_day(spark, staged), scratch_db, "2024-01-02")
    assert "2024-01-02" not in tables.published_days(spark, scratch_db, "credits")
    assert spark.table(tables.qualified(scratch_db, "credits")).where("name is null").count() == 0
    monkeypatch.setattr(tables, "point_partitions", real)
    publish_day(spark, _dim_day(spark, staged), scratch_db, "2024-01-02")
    out = {r.person_id: r.name for r in
           spark.table(tables.qualified(scratch_db, "credits")).collect()}
    assert out == {**{k: "old" for k in range(50)}, **{k: "new" for k in range(0, 60, 2)}}


def test_rows_without_a_key_are_inserted_in_a_bucket(spark, scratch_db):
    from nestmart.plans.publish import publish_day
    from nestmart.sources.tables import qualified
    publish_day(spark, _dim_day(spark, [(1, "a", 1, "X"), (None, "n", 1, "X")]), scratch_db,
                "2024-01-01", buckets=4)
    publish_day(spark, _dim_day(spark, [(None, "m", 1, "X")]), scratch_db, "2024-01-02")
    rows = spark.table(qualified(scratch_db, "credits")).collect()
    assert sorted((r.person_id or 0, r.name) for r in rows) == [(0, "m"), (0, "n"), (1, "a")]
