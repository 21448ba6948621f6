"""What the job of several days leaves on disk and shuffles."""

import os
import time

import pytest
from pyspark.sql import functions as F

from nestmart import fixtures as fx
from nestmart import registry, schemas
from nestmart.operators import keys
from nestmart.operators.keys import dedupe, dedupe_stored
from nestmart.session import local_path, materialize, scratch_path
from nestmart.sources import tables
from test_plans import exchanges, plan


def rows(df):
    return sorted(df.collect(), key=str)


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def folders(spark, start):
    root = local_path(spark.sparkContext.getCheckpointDir())
    return {f"{d}/{x}" for d, dirs, _ in os.walk(f"{root}/nestmart") for x in dirs
            if x.startswith(start)}


def test_published_days_leave_no_shuffles_caches_or_scratch_copies(spark, sf_dir):
    scratch = ("film_lines", "film_companies", "typed-")
    shuffles, copies = shuffle_files(spark), folders(spark, scratch)
    out = registry.QUERIES["publish_days"](spark, sf_dir)
    for _ in range(50):                       # executors remove the files in the background
        if not (left := shuffle_files(spark) - shuffles):
            break
        time.sleep(0.2)
    assert not left
    assert folders(spark, scratch) == copies
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().isEmpty()
    assert out.count() > 0


def test_cleaning_keeps_no_credits_in_storage(spark, sf_dir, monkeypatch):
    from nestmart.plans import job
    held, write = [], job.lake.write_clean
    monkeypatch.setattr(job.lake, "write_clean", lambda *a: held.append(
        spark.sparkContext._jsc.sc().getPersistentRDDs().size()) or write(*a))
    root = scratch_path(spark, "lake")
    registry._land_days(spark, sf_dir, root)
    job.run_clean(spark, root, fx.day_date(0))
    assert held == [0] * 5


DOUBLED = [(1, "a", 2.0), (1, "a", None), (2, "b", 1.0), (3, "c", 1.0), (3, "c", 1.0),
           (None, "d", 5.0), (None, "d", 4.0), (4, None, 1.0), (4, "e", 1.0)]


@pytest.mark.parametrize("by", [["id"], ["name"], ["id", "name"]])
@pytest.mark.parametrize("most", [500_000, 1])
def test_stored_rows_are_deduplicated_alike(spark, monkeypatch, by, most):
    monkeypatch.setattr(keys, "MOST_REPEATED", most)
    df = materialize(spark.createDataFrame(DOUBLED, "id bigint, name string, x double"), "t")
    for prefer in ([], ["x"]):
        assert rows(dedupe_stored(df, by, prefer)) == rows(dedupe(df, by, prefer))


def test_rows_with_a_key_of_their_own_are_not_shuffled(spark):
    df = materialize(spark.range(1000).withColumn("wide", F.array(F.lit(1), F.lit(2))), "t")
    assert exchanges(plan(dedupe_stored(df, ["id"]))) == 0
    twice = materialize(df.unionByName(df.where("id < 3")), "t")
    one = dedupe_stored(twice, ["id"])
    assert rows(one) == rows(df)


def test_a_films_people_are_shuffled_once_for_staging(spark, sf_dir):
    from nestmart.plans.model import model_movies
    clean = {n: materialize(df, "t") for n, df in registry._day_clean(spark, sf_dir, 0).items()
             if n in ("movie_details", "credits_of_movies", "box_office")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        staged = model_movies(clean["movie_details"], [clean["credits_of_movies"]],
                              clean["box_office"], "2024-01-01").repartition(n, "movie_id")
        text = plan(staged)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # films and box office by imdb id, then films and people by film: no more for the buckets
    assert exchanges(text) == 4


def test_days_staged_in_parts(spark, sf_dir, scratch_db):
    from nestmart.plans.publish import publish_days, stage_day
    days = {fx.day_date(d): {t: materialize(df, "t") for t, df in registry._day_staging(
        spark, sf_dir, d).items()} for d in (0, 1)}
    other = registry._scratch_db(spark, "parts")
    publish_days(spark, days, scratch_db, buckets=5)
    publish_days(spark, days, other, buckets=5, parts=3)
    for t in tables.STAGED:
        cols = schemas.WAREHOUSE_SCHEMAS[t].fieldNames()
        one, many = (spark.table(tables.qualified(db, t)).select(*cols)
                     for db in (scratch_db, other))
        assert rows(one) == rows(many) and one.count() > 0
    stage_day(days[fx.day_date(0)], other, buckets=5, parts=3)
    staged = spark.table(tables.qualified(other, "staging_movies"))
    assert staged.count() == days[fx.day_date(0)]["movies"].count()
    assert len(staged.inputFiles()) == 5      # a bucket is written by one part


def test_parts_follow_the_size_of_the_day(spark, monkeypatch):
    from nestmart.plans import job
    sizes = {"movie_details": 5, "credits_of_movies": 6}
    monkeypatch.setattr(job.lake, "clean_bytes", lambda spark, lake, date, name: sizes[name])
    monkeypatch.setattr(job, "PART_BYTES", 4)
    assert job.stage_parts(spark, "lake", "2024-01-01") == 3
    sizes["movie_details"] = 0
    sizes["credits_of_movies"] = 0
    assert job.stage_parts(spark, "lake", "2024-01-01") == 1
    sizes["credits_of_movies"] = 1000
    assert job.stage_parts(spark, "lake", "2024-01-01") == job.MOST_PARTS
