"""Calendar inside a series, day-partitioned datasets, quarantine, pages to box office."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from nestmart import schemas
from nestmart.session import local_path, scratch_path
from nestmart.sources import lake


def _movies(spark, series):
    rows = [(k, None if ms is None else [(p, 1, 1.0, g, d) for p, g, d in ms])
            for k, ms in series.items()]
    return spark.createDataFrame(rows, "movie_id bigint, metrics array<struct<popularity:double,"
                                 "vote_count:bigint,vote_average:double,gross:bigint,"
                                 "collect_date:date>>")


def test_series_calendar_equals_the_table(spark):
    from nestmart.plans.calendar import SERIES_ATTRS, dim_date, join_series_calendar
    days = [dt.date(2023, 12, 25) + dt.timedelta(days=k) for k in range(20)]
    movies = _movies(spark, {1: [(1.0, 1, d) for d in days], 2: [(1.0, 1, None)], 3: None, 4: []})
    span = ("2023-12-28", "2024-01-05")
    out = {r.movie_id: r.metrics for r in join_series_calendar(movies, *span).collect()}
    table = {r.date_id: tuple(r[a] for a in SERIES_ATTRS) for r in dim_date(spark, *span).collect()}
    got = {m.collect_date: None if m.calendar is None else tuple(m.calendar) for m in out[1]}
    assert got == {d: table.get(d) for d in days} and len(table) == 9
    assert out[2][0].calendar is None and out[3] is None and out[4] == []


def test_film_months_against_plain_python(spark):
    from nestmart.plans.calendar import film_months, month_totals
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=3 * k) for k in range(40)]
    series = {1: [(float(k), 10 * k, d) for k, d in enumerate(days)],
              2: [(None, None, days[0]), (None, 7, days[0]), (2.5, None, None)], 3: None, 4: []}
    span = ("2024-01-01", "2024-03-31")
    want = {}
    for film, ms in series.items():
        for p, g, d in ms or []:
            inside = d is not None and dt.date(2024, 1, 1) <= d <= dt.date(2024, 3, 31)
            key = (film, *((d.year, d.month, d.weekday() >= 5) if inside else (None,) * 3))
            n, ps, gs = want.setdefault(key, [0, [], []])
            want[key][0] = n + 1
            ps += [p] if p is not None else []
            gs += [g] if g is not None else []
    want = {k: (n, sum(ps) if ps else None, max(gs, default=None))
            for k, (n, ps, gs) in want.items()}
    rows = film_months(_movies(spark, series), *span).collect()
    assert {tuple(r)[:4]: tuple(r)[4:] for r in rows} == want and len(rows) == len(want)
    totals = {tuple(r)[:3]: r.n_days for r in month_totals(_movies(spark, series), *span).collect()}
    assert sum(totals.values()) == 43


def test_days_are_pruned_and_rewritten_alone(spark):
    root = scratch_path(spark, "t-days")
    df = spark.createDataFrame([(k, dt.date(2024, 1, 30) + dt.timedelta(days=k % 5))
                                for k in range(50)], "id bigint, on date")
    path = lake.write_days(df, root, "x", "on")
    back = lake.read_days(spark, root, "x", "2024-01-31", "2024-02-01")
    assert sorted(r.id for r in back.collect()) == [k for k in range(50) if k % 5 in (1, 2)]
    assert back.columns == ["id", "on"]
    text = back._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull" in text or "PartitionFilters: [(make_date" in text
    assert {r.f.split("/x/")[1].rsplit("/", 1)[0] for r in back.select(
        F.col("_metadata.file_path").alias("f")).collect()} == {
        "year=2024/month=1/day=31", "year=2024/month=2/day=1"}
    lake.write_days(spark.createDataFrame([(99, dt.date(2024, 1, 31))], "id bigint, on date"),
                    root, "x", "on")
    rows = lake.read_days(spark, root, "x", "2024-01-01", "2024-12-31").collect()
    assert sorted(r.id for r in rows) == sorted([k for k in range(50) if k % 5 != 1] + [99])
    with pytest.raises(Exception, match="row without on"):
        lake.write_days(spark.createDataFrame([(1, None)], "id bigint, on date"), root, "x", "on")
    assert os.path.isdir(local_path(path))


def test_quarantine_keeps_text_of_bad_records(spark):
    root = scratch_path(spark, "t-quarantine")
    lines = ['{"imdb_id":"tt1","budget":"5"}', '{"imdb_id":"tt2","bud', "", "no json",
             '{"imdb_id":"tt3"}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(
        lake.day_path(root, "raw", "2024-01-01", "box_office", "json"))
    for _ in range(2):                                   # a day may be run again
        good = lake.quarantine(spark, root, "2024-01-01", "box_office")
        assert sorted(r.imdb_id for r in good.collect()) == ["tt1", "tt3"]
        assert lake.CORRUPT not in good.columns
        bad = lake.read_quarantine(spark, root, "2024-01-01", "box_office").collect()
        assert sorted(r.record for r in bad) == ["no json", '{"imdb_id":"tt2","bud']
        assert all("box_office" in r.file for r in bad)
        assert good.count() == 2
    empty = lake.day_path(root, "raw", "2024-01-02", "box_office", "json")
    spark.createDataFrame([], "value string").write.text(empty)
    assert lake.quarantine(spark, root, "2024-01-02", "box_office").count() == 0
    assert lake.read_quarantine(spark, root, "2024-01-02", "box_office").count() == 0


def _page(gross):
    return ('<div class="mojo-summary-table"><div class="mojo-performance-summary-table">'
            f'<div class="a-section"><span class="a-size-medium">{gross}</span></div></div>'
            '<div class="mojo-summary-values"><div class="a-section">Budget $7</div></div></div>')


def test_pages_to_box_office_retries_failed_keys_only(spark):
    from nestmart.plans.box_office import pages_to_box_office, read_pages
    first = spark.createDataFrame(
        [("a", _page("$1,000")), ("b", "<p>busy</p>"), ("c", None), ("d", "<p>busy</p>"),
         (None, _page("$9"))], "imdb_id string, html string")
    retry = spark.createDataFrame(
        [("a", _page("$2")), ("b", _page("$30")), ("c", "<p>busy</p>"), ("z", _page("$4"))],
        "imdb_id string, html string")
    rows = read_pages(first, retry).collect()
    assert len(rows) == 5                       # a, b, c once; d not retried; the page without id
    out = {r.imdb_id: (r.worldwide_gross, r.budget) for r in
           pages_to_box_office(first, retry).collect()}
    assert out == {"a": (1000, 7), "b": (30, 7), "c": (None, None), "d": (None, None)}
    none = first.where("false")
    assert pages_to_box_office(none, none).collect() == []


def test_failed_responses_per_dataset(spark):
    from nestmart.operators.selection import failed_response, split_responses
    details = spark.createDataFrame([(1, 2.0), (2, None)], "id bigint, popularity double")
    ok, failed = split_responses(details, failed_response("movie_details"))
    assert [r.id for r in ok.collect()] == [1] and [r.id for r in failed.collect()] == [2]
    credits = spark.createDataFrame([(1, [1]), (2, None), (3, [])], "id bigint, cast array<int>")
    ok, failed = split_responses(credits, failed_response("movie_credits"))
    assert sorted(r.id for r in ok.collect()) == [1, 3] and failed.count() == 1
    assert set(schemas.RAW_SCHEMAS) == {"movie_details", "movie_credits", "box_office"}
