"""Column helpers on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestmart import schemas
from nestmart.functions import columns as C


def test_money_parsing_rules(spark):
    df = spark.createDataFrame(
        [("",), ("–",), ("$1,234,567",), ("1,234",), ("$5",), (None,)], "s string")
    out = df.select(C.money_to_long("s", strip_dollar=True).alias("gross"),
                    C.money_to_long("s", strip_dollar=False).alias("budget")).collect()
    assert [r.gross for r in out] == [None, None, 1234567, 1234, 5, None]
    # budget and opening strip only commas: a stray dollar leaves text -> NULL
    assert [r.budget for r in out] == [None, None, None, 1234, None, None]


def test_string_to_long_matches_legacy_cast(spark):
    vals = [" 12 ", "1234.5", "-7", "1e3", "", "12a", "99999999999999999999", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    out = [r.n for r in df.select(C.string_to_long("s").alias("n")).collect()]
    assert out == [12, 1234, -7, None, None, None, None, None]


def test_try_cast_bad_input_is_null(spark):
    row = spark.range(1).select(
        C.try_cast(F.lit(""), "bigint").alias("a"),
        C.try_cast(F.lit(""), "date").alias("b"),
        C.try_cast(F.lit(3_000_000_000), "int").alias("c"),
    ).first()
    assert (row.a, row.b, row.c) == (None, None, None)


def test_zero_to_null_only_zero(spark):
    df = spark.createDataFrame([(0,), (5,), (None,)], "x int")
    assert [r.y for r in df.select(C.zero_to_null("x").alias("y")).collect()] == [None, 5, None]


def test_empty_to_null(spark):
    df = spark.createDataFrame([([],), (None,), (["a", "b"],)], "a array<string>")
    out = [r.b for r in df.select(C.empty_to_null("a").alias("b")).collect()]
    assert out == [None, None, ["a", "b"]]


def test_keep_by_order_is_inclusive_and_drops_null(spark):
    df = spark.createDataFrame([([(1, 20), (2, 21), (3, None), (4, 0)],)],
                               "c array<struct<person_id:int,order:int>>")
    kept = df.select(C.keep_by_order("c", 20).alias("k")).first().k
    assert [e.person_id for e in kept] == [1, 4]


def test_keep_values_case_sensitive(spark):
    df = spark.createDataFrame([([("Director",), ("director",), ("Producer",), ("Writer",)],)],
                               "c array<struct<job:string>>")
    kept = df.select(C.keep_values("c", "job", ("Director", "Writer", "Screenplay")).alias("k"))
    assert [e.job for e in kept.first().k] == ["Director", "Writer"]


def test_zip_truncated_cuts_to_shortest_and_null_is_empty(spark):
    schema = "a array<int>, b array<int>"
    df = spark.createDataFrame([([1, 2, 3], [10, 20]), ([1, 2], None)], schema)
    out = df.select(C.zip_truncated({"a": F.col("a"), "b": F.col("b")},
                                    {"a": T.IntegerType(), "b": T.IntegerType()}).alias("z"))
    rows = out.collect()
    assert [(e.a, e.b) for e in rows[0].z] == [(1, 10), (2, 20)]
    assert rows[1].z == []


def test_sunday_week_numbers(spark):
    df = spark.createDataFrame([(dt.date(2008, 1, 1),), (dt.date(2012, 12, 31),),
                                (dt.date(2023, 1, 1),)], "d date")
    assert [r.w for r in df.select(C.sunday_week("d").alias("w")).collect()] == [0, 53, 1]


def test_append_series_branches(spark):
    day = F.lit("2024-01-03").cast("date")
    m = "struct<popularity:double,vote_count:bigint,vote_average:double,gross:bigint,collect_date:date>"
    df = spark.createDataFrame(
        [([(1.0, 1, 1.0, 1, dt.date(2024, 1, 1))], None, False),
         (None, [(2.0, 2, 2.0, 2, dt.date(2024, 1, 3))], True),
         ([(1.0, 1, 1.0, 1, dt.date(2024, 1, 1))], [(2.0, 2, 2.0, 2, dt.date(2024, 1, 3))], True)],
        f"stored array<{m}>, today array<{m}>, present boolean")
    out = df.select(C.append_series("stored", "today", F.col("present"), day,
                                    schemas.METRIC).alias("s")).collect()
    assert [e.popularity for e in out[0].s] == [1.0, None]
    assert out[0].s[1].collect_date == dt.date(2024, 1, 3)
    assert [e.popularity for e in out[1].s] == [2.0]
    assert [e.popularity for e in out[2].s] == [1.0, 2.0]


def test_dim_date_default_span(spark):
    from nestmart.plans.calendar import dim_date
    cal = dim_date(spark)
    assert cal.count() == 8401
    first = cal.orderBy("date_key").first()
    assert str(first.date_key).startswith("20080101")
    assert (first.day_name, first.week_of_year, first.is_weekend) == ("Tuesday", 0, False)
    sunday = cal.where(F.col("date_id") == "2023-01-01").first()
    assert (sunday.day_of_week, sunday.week_of_year, sunday.is_weekend) == (1, 1, True)


def test_money_follows_the_legacy_cast(spark):
    from nestmart.functions.columns import string_to_long
    rows = [(".5", 0), ("\t12\n", 12), ("12.", 12), ("-3.9", -3), ("", None), ("-", None),
            ("1e3", None), (None, None)]
    df = spark.createDataFrame(rows, "s string, want long")
    got = df.select(string_to_long("s").alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_dedupe_prefers_values_to_nulls(spark):
    from nestmart.operators.keys import dedupe
    df = spark.createDataFrame([(1, None, 4), (1, "Ann", 5)], "id int, name string, n int")
    assert [tuple(r) for r in dedupe(df, ["id"]).collect()] == [(1, "Ann", 5)]


def test_calendar_join_keeps_every_fact(spark):
    from nestmart.plans.calendar import dim_date, join_calendar
    facts = spark.createDataFrame([(1, "1994-05-05"), (2, None), (3, "2020-01-01")],
                                  "id int, d string")
    got = join_calendar(facts, "d", dim_date(spark)).select("id", "date_id").collect()
    assert {r.id: r.date_id is not None for r in got} == {1: False, 2: False, 3: True}


def test_pages_ignore_hidden_blocks_and_survive_depth():
    from nestmart.operators.pages import extract_one
    page = ('<div class="mojo-summary-table"><div class="mojo-performance-summary-table">'
            '<div class="a-section"><span class="a-size-medium">{}</span></div></div>'
            '<div class="mojo-summary-values"></div></div>')
    assert extract_one(f"<!-- {page.format('$111')} -->{page.format('$5')}")[1] == "$5"
    assert extract_one(f"<script>var a = '{page.format('$7')}'</script>") == ("", "", "")
    assert extract_one(page.format("<i>" * 5000 + "$9")) == ("", "", "")
