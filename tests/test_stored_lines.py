"""Inputs of several days: line items are read once, landings are compressed."""

import os

import pytest

from nestmart import fixtures as fx
from nestmart import registry
from nestmart.session import local_path, scratch_path
from nestmart.sources import lake


@pytest.fixture()
def line_reads(monkeypatch):
    """Names of the fixtures read while a test runs."""
    read, plain = [], fx.fx
    monkeypatch.setattr(fx, "fx", lambda spark, sf_dir, name: read.append(name) or plain(
        spark, sf_dir, name))
    return read


def rows(df):
    return sorted(df.collect(), key=str)


def test_stored_lines_hold_the_same_rows(spark, sf_dir, scratch_db):
    lines = fx.stored_lines(spark, sf_dir, scratch_db)
    assert rows(lines.credits) == rows(fx.raw_movie_credits(spark, sf_dir))
    assert rows(lines.companies) == rows(fx.company_arrays(spark, sf_dir))


def test_landing_reads_the_line_items_once(spark, sf_dir, line_reads):
    root = scratch_path(spark, "lake")
    registry._land_days(spark, sf_dir, root)
    assert line_reads.count("line") == 1
    for d in fx.DAYS:
        for name in ("movie_details", "movie_credits", "box_office"):
            path = local_path(lake.day_path(root, "raw", fx.day_date(d), name, "json"))
            files = [f for f in os.listdir(path) if f.startswith("part-")]
            assert files and all(f.endswith(".json.gz") for f in files)


def test_large_landing_is_cut_into_files(spark, monkeypatch):
    monkeypatch.setattr(lake, "RECORDS_PER_FILE", 10)
    root = scratch_path(spark, "lake")
    path = lake.write_raw_json(spark.range(35).coalesce(1), root, "2024-01-01", "box_office")
    assert len([f for f in os.listdir(local_path(path)) if f.startswith("part-")]) == 4
    assert spark.read.json(path).count() == 35


@pytest.mark.parametrize("query", ["append_metrics", "merge_movies", "full_join_coalesce",
                                   "staging_lifecycle", "day_range"])
def test_queries_of_several_days_read_the_line_items_once(spark, sf_dir, line_reads, query):
    registry.QUERIES[query](spark, sf_dir)
    assert line_reads.count("line") == 1
