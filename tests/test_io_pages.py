"""Lake layouts, table lifecycle and page extraction."""

import os

from pyspark.sql import functions as F

from nestmart import schemas
from nestmart.operators.pages import extract_box_office, extract_one
from nestmart.session import local_path, scratch_path
from nestmart.sources import lake
from nestmart.sources.conform import conform
from nestmart.sources.tables import (create_table_as, drop_staging, qualified, swap_table,
                                     table_exists, write_staging)

ARRAY_FORM = """[
  {
    "imdb_id": "tt1",
    "domestic_opening": "1,000",
    "worldwide_gross": "$2,000",
    "budget": "500"
  },
  {
    "imdb_id": "tt2",
    "domestic_opening": "",
    "worldwide_gross": "",
    "budget": ""
  }
]"""


def _land(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_raw_json_layouts(spark):
    root = scratch_path(spark, "t-lake")
    p = lake.day_path(root, "raw", "2024-01-01", "box_office", "json")
    _land(local_path(p), ARRAY_FORM)
    arr = lake.read_raw_json(spark, root, "2024-01-01", "box_office", multi_line=True)
    assert sorted(r.imdb_id for r in arr.collect()) == ["tt1", "tt2"]
    df = spark.createDataFrame([("tt3", "1", "2", "3"), ("tt4", "", "", "")],
                               schemas.RAW_BOX_OFFICE)
    lake.write_raw_json(df, root, "2024-01-02", "box_office")
    lines = lake.read_raw_json(spark, root, "2024-01-02", "box_office", multi_line=False)
    assert sorted(r.imdb_id for r in lines.collect()) == ["tt3", "tt4"]


def test_day_path_layout():
    assert lake.day_path("s3://b", "clean", "2024-03-09", "box_office", "parquet") == \
        "s3://b/clean/2024/03/09/box_office.parquet"


def test_clean_roundtrip(spark):
    root = scratch_path(spark, "t-lake")
    df = spark.createDataFrame([("tt1", 1, 2, 3)], schemas.CLEAN_BOX_OFFICE)
    lake.write_clean(df, root, "2024-01-01", "box_office")
    back = lake.read_clean(spark, root, "2024-01-01", "box_office")
    assert back.collect() == df.collect()


def test_staging_and_swap(spark, scratch_db):
    df = spark.createDataFrame([(1, "a", "US")], schemas.PRODUCTION_COMPANIES)
    for t in ("movies", "credits", "production_companies"):
        write_staging(df, scratch_db, t)
    assert table_exists(spark, scratch_db, "staging_credits")
    drop_staging(spark, scratch_db)
    assert not table_exists(spark, scratch_db, "staging_credits")
    create_table_as(df, scratch_db, "live")
    create_table_as(df.withColumn("company_name", F.lit("b")), scratch_db, "live__next",
                    bucket_by="company_id", buckets=2)
    swap_table(spark, scratch_db, "live__next", "live")
    assert spark.table(qualified(scratch_db, "live")).first().company_name == "b"
    assert not table_exists(spark, scratch_db, "live__next")


def test_conform_reorders_and_casts(spark):
    df = spark.createDataFrame([("7", 3, [(1, "9")])],
                               "runtime string, movie_id int, casts array<struct<order:int,person_id:string>>")
    out = conform(df, schemas.MOVIES)
    assert out.schema == schemas.MOVIES or out.columns == [f.name for f in schemas.MOVIES]
    r = out.first()
    assert (r.movie_id, r.runtime, r.casts[0].person_id, r.casts[0].order) == (3, 7, 9, 1)
    assert r.metrics is None


PAGE = """<html><body><div class="a-section mojo-summary-table">
<div class="mojo-performance-summary-table">
 <div class="a-section"><span class="a-size-medium">$1</span></div>
 <div class="a-section"><span class="a-size-small">World</span>
   <span class="a-size-medium">
     $2,500 </span><span class="a-size-medium">$9</span></div>
</div>
<div class="mojo-summary-values">
 <div class="a-section"><span>Domestic Opening</span><span>$1,000</span></div>
 {budget}
</div></div></body></html>"""


def test_extract_rules():
    full = PAGE.format(budget='<div class="a-section"><span>Budget</span><span>$300</span></div>')
    assert extract_one(full) == ("1,000", "$2,500", "300")
    assert extract_one(PAGE.format(budget="")) == ("1,000", "$2,500", "")
    no_perf = full.replace("mojo-performance-summary-table", "other")
    assert extract_one(no_perf) == ("", "", "")
    assert extract_one("<p>unrelated</p>") == ("", "", "")
    assert extract_one(None) == ("", "", "")


def test_extract_in_spark(spark):
    full = PAGE.format(budget="")
    pages = spark.createDataFrame([("tt1", full), ("tt2", "<html></html>")], "imdb_id string, html string")
    out = {r.imdb_id: r for r in extract_box_office(pages).collect()}
    assert out["tt1"].worldwide_gross == "$2,500" and out["tt2"].budget == ""


def test_extract_fast_path_equals_full_parse():
    from nestmart.operators import pages
    full = PAGE.format(budget='<div class="a-section"><span>Budget</span><span>$300</span></div>')
    padded = "<html><body>" + "<p>filler</p>" * 500 + full + "<script>x='mojo-summary-table'</script>"
    assert extract_one(padded) == ("1,000", "$2,500", "300")
    tricky = "<script>var c = 'mojo-summary-table';</script>" + full   # name first seen in a script
    assert extract_one(tricky) == ("1,000", "$2,500", "300")
    root = pages._parse(full)
    assert root.find("div", pages.SUMMARY_CLASS) is not None
