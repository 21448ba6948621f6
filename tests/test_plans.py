"""Scale properties of the physical plans, checked on explain output."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from nestmart import fixtures as fx
from nestmart import registry
from nestmart.operators.keys import dedupe, join_dimension
from nestmart.operators.merge import merge_movies
from nestmart.plans import reports
from nestmart.sources.tables import create_table_as, qualified


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def exchanges(text: str) -> int:
    return len(re.findall(r"^\(\d+\) Exchange", text, flags=re.M))


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    db = registry._scratch_db(spark, "tplans")
    create_table_as(fx.film_table(spark, sf_dir), db, "movies", bucket_by="movie_id", buckets=4)
    create_table_as(fx.people(spark, sf_dir), db, "credits", bucket_by="person_id", buckets=4)
    create_table_as(registry._day_staging(spark, sf_dir, 1)["movies"], db, "staging_movies")
    return {t: spark.table(qualified(db, t)) for t in ("movies", "credits", "staging_movies")}


def test_genre_report_prunes_and_pushes_down(stored):
    text = plan(reports.report_by_genre(stored["movies"]))
    assert "metrics:array<struct<popularity:double,gross:bigint>>" in text
    assert "IsNotNull(movie_budget)" in text
    assert exchanges(text) == 2
    assert "Window" not in text and "EvalPython" not in text


def test_cast_report_aggregates_before_the_join(stored):
    text = plan(reports.report_by_cast(stored["movies"], stored["credits"]))
    tree = text.split("\n\n")[0]
    join_line = next(i for i, ln in enumerate(tree.splitlines()) if "Join" in ln)
    below = "\n".join(tree.splitlines()[join_line:])
    assert "HashAggregate" in below          # per-person aggregate feeds the join
    assert "collect_date" not in text        # unused metric field not read


def test_merge_shuffles_only_staging(stored):
    text = plan(merge_movies(stored["movies"], stored["staging_movies"], "2024-01-02",
                             check_unique=False))
    assert "Bucketed: true" in text
    assert exchanges(text) == 1


def test_dedupe_aggregates_partially(spark, sf_dir):
    raw = fx.raw_movie_details(spark, sf_dir, duplicate_rule=True)
    text = plan(dedupe(raw, ["id"]))
    tree = text.split("\n\n")[0]
    aggs = [ln for ln in tree.splitlines() if "Aggregate" in ln]
    assert len(aggs) >= 2                     # partial before the exchange, final after
    assert "Window" not in text


def test_model_has_no_cartesian_or_window(spark, sf_dir):
    text = plan(registry._day_staging(spark, sf_dir, 0)["movies"])
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Window" not in text


def test_dimension_join_is_plain_without_skew(spark, stored):
    from nestmart.operators.keys import heavy_keys
    cast = stored["movies"].selectExpr("movie_id", "explode(casts) AS c").selectExpr(
        "movie_id", "c.person_id")
    assert heavy_keys(cast, "person_id") == {}
    text = plan(reports.cast_with_names(stored["movies"], stored["credits"]))
    assert "_salt" not in text


def test_hot_person_is_dealt_to_many_partitions(spark):
    from nestmart.operators.keys import heavy_keys
    films = spark.range(9000).selectExpr("id AS movie_id", "IF(id % 3 = 0, 7L, id) AS person_id")
    people = spark.range(0, 9000).selectExpr("id AS person_id", "concat('p', id) AS name")
    assert heavy_keys(films, "person_id", shares=64) == {7: 32}
    joined = join_dimension(films, people, "person_id", "movie_id", heavy_keys(
        films, "person_id", shares=64))
    assert "_salt" in plan(joined)
    assert joined.columns == ["person_id", "movie_id", "name"]
    assert joined.count() == 9000
    assert joined.where("name <> concat('p', person_id)").count() == 0
    tree = joined.withColumn("task", F.spark_partition_id())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        per_task = tree.groupBy("task").count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert per_task < 1000                     # 3,000 rows have the hot key


def test_heavy_keys_of_nothing_and_of_nulls(spark):
    from nestmart.operators.keys import heavy_keys
    facts = spark.createDataFrame([(1, None), (2, None), (3, 5)], "movie_id long, person_id long")
    assert heavy_keys(facts.where("movie_id < 0"), "person_id") == {}
    assert heavy_keys(facts.where("person_id IS NULL"), "person_id") == {}
    dims = spark.createDataFrame([(5, "a"), (None, "b")], "person_id long, name string")
    assert [tuple(r) for r in join_dimension(facts, dims, "person_id", "movie_id").collect()] == [
        (5, 3, "a")]


def test_casts_and_crews_are_built_inside_the_row(spark, sf_dir):
    from nestmart.plans.clean import clean_credits, nest_credits
    from nestmart.plans.model import model_movies
    from nestmart.session import materialize
    raw = materialize(fx.raw_movie_credits(spark, sf_dir), "plan")
    clean = registry._day_clean(spark, sf_dir, 0)
    details, box = (materialize(clean[n], "plan") for n in ("movie_details", "box_office"))
    nested = plan(nest_credits(clean_credits(raw)))
    assert exchanges(nested) == 1            # the dedupe's
    text = plan(model_movies(details, [nest_credits(clean_credits(raw))], box, "2024-01-01"))
    for other in (nested, text):
        assert "collect_list" not in other and "Generate" not in other and "sort_array" in other


def test_merge_of_staged_and_stored_neither_shuffles_nor_sorts(spark, sf_dir):
    from nestmart.operators.merge import merge_movie_days
    from nestmart.plans.publish import publish_day, sorted_scans, stage_day
    db = registry._scratch_db(spark, "tbuckets")
    days = {d: registry._day_staging(spark, sf_dir, d) for d in (0, 1)}
    publish_day(spark, days[0], db, fx.day_date(0), buckets=5)
    stage_day(days[1], db)
    t, s = (spark.table(qualified(db, x)) for x in ("movies", "staging_movies"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with sorted_scans(spark):
            one = plan(merge_movies(t, s, fx.day_date(1), check_unique=False))
            many = plan(merge_movie_days(t, s.withColumn("run_date", fx.F.lit(fx.day_date(1))),
                                         [fx.day_date(1)], check_unique=False))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert exchanges(one) == 0 and not re.findall(r"^\(\d+\) Sort$", one, flags=re.M)
    assert "SortMergeJoin" in one and one.count("Bucketed: true") == 2
    assert exchanges(many) == 0
