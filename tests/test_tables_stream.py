"""Table-level jobs: restructure swap, calendar table, landing stream re-runs."""

import datetime as dt

from pyspark.sql import functions as F

from nestmart import schemas
from nestmart.sources.tables import qualified, table_exists


def test_restructure_table_swaps_in_new_shape(spark, scratch_db):
    from nestmart.plans.restructure import restructure_table
    from nestmart.sources.tables import create_table_as
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    legacy = spark.createDataFrame(
        [(1, "t", [(1.0,), (2.0,)], [(1,), (2,)], [(5.0,), (6.0,)], [(10,)], [(d1,), (d2,)]),
         (2, "u", None, [(1,)], [(5.0,)], [(10,)], [(d1,)])],
        "movie_id bigint, title string, popularity array<struct<value:double>>, "
        "vote_count array<struct<value:bigint>>, vote_average array<struct<value:double>>, "
        "gross array<struct<value:bigint>>, current_date array<struct<value:date>>")
    create_table_as(legacy, scratch_db, "movies")
    restructure_table(spark, scratch_db, "movies", buckets=2)
    out = {r.movie_id: r for r in spark.table(qualified(scratch_db, "movies")).collect()}
    assert [(m.popularity, m.gross, m.collect_date) for m in out[1].metrics] == [(1.0, 10, d1)]
    assert out[2].metrics == []
    assert "popularity" not in spark.table(qualified(scratch_db, "movies")).columns
    assert not table_exists(spark, scratch_db, "movies__restructured")


def test_dim_date_table_is_ordered(spark, scratch_db):
    from nestmart.plans.calendar import create_dim_date_table
    create_dim_date_table(spark, scratch_db, "2023-12-25", "2024-01-07")
    rows = spark.table(qualified(scratch_db, "dim_date")).select(
        "date_key", F.col("_metadata.file_path").alias("f")).collect()
    assert len(rows) == 14
    by_file: dict[str, list[int]] = {}
    for r in rows:                      # rows of one file are read in file order
        by_file.setdefault(r.f, []).append(int(r.date_key))
    spans = sorted((keys[0], keys[-1]) for keys in by_file.values())
    assert all(keys == sorted(keys) for keys in by_file.values())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))   # disjoint, ascending ranges


def _film(spark, movie_id, day):
    return spark.createDataFrame(
        [(float(movie_id), f"tt{movie_id}", "t", "t", 10.0, [(1, "Drama")], [], 2.0,
          [(5, "Acme", "US")], "2020-01-01", 7.0, 90.0, 6.0, 3.0)], schemas.RAW_MOVIE_DETAILS)


def test_landing_stream_runs_each_day_once(spark, scratch_db):
    from nestmart.session import scratch_path
    from nestmart.sources import lake
    from nestmart.streaming.landing import mark_landed, process_landed_days
    root = scratch_path(spark, "t-stream-lake")
    ckpt = scratch_path(spark, "t-stream-ckpt")
    credits = spark.createDataFrame([], schemas.RAW_MOVIE_CREDITS)
    box = spark.createDataFrame([], schemas.RAW_BOX_OFFICE)

    def land(day, ids):
        films = _film(spark, ids[0], day)
        for i in ids[1:]:
            films = films.unionByName(_film(spark, i, day))
        lake.write_raw_json(films, root, day, "movie_details")
        lake.write_raw_json(credits, root, day, "movie_credits")
        lake.write_raw_json(box, root, day, "box_office")
        mark_landed(spark, root, day)

    def sizes():
        t = spark.table(qualified(scratch_db, "movies"))
        return {r.movie_id: r.n for r in t.select("movie_id", F.size("metrics").alias("n")).collect()}

    land("2024-01-01", [1, 2])
    process_landed_days(spark, root, scratch_db, ckpt)
    assert sizes() == {1: 1, 2: 1}
    process_landed_days(spark, root, scratch_db, ckpt)      # nothing new: no change
    assert sizes() == {1: 1, 2: 1}
    land("2024-01-02", [2])
    land("2024-01-03", [1, 3])
    process_landed_days(spark, root, scratch_db, ckpt)
    assert sizes() == {1: 3, 2: 3, 3: 1}


def test_broken_swap_is_recovered(spark, scratch_db):
    from nestmart.sources import tables
    df = spark.range(3)
    tables.create_table_as(df, scratch_db, "t")
    tables.create_table_as(spark.range(5), scratch_db, "t__next")
    tables._rename(spark, scratch_db, "t", "t__prev")  # the driver dies here
    tables.recover_table(spark, scratch_db, "t")
    assert spark.table(f"{scratch_db}.t").count() == 3
    tables.swap_table(spark, scratch_db, "t__next", "t")
    assert spark.table(f"{scratch_db}.t").count() == 5
    assert not tables.table_exists(spark, scratch_db, "t__prev")
    tables.create_table_as(df, scratch_db, "t__prev")  # dies before the old version is dropped
    tables.recover_table(spark, scratch_db, "t")
    assert spark.table(f"{scratch_db}.t").count() == 5
    tables.set_published(spark, scratch_db, "t", "2024-01-02")
    assert tables.published_day(spark, scratch_db, "t") == "2024-01-02"
