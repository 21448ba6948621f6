"""Calendar dimension (CJ-10) and star join to it (JO-6)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestmart import schemas
from nestmart.functions.columns import date_key, is_weekend, sunday_week

# The calendar span of the original warehouse.
DEFAULT_START = "2008-01-01"
DEFAULT_END = "2030-12-31"

# Calendars up to this many days (about 2,700 years) are broadcast to joins.
BROADCAST_MAX_DAYS = 1_000_000


def calendar_columns(d: Column) -> list[Column]:
    """All ``dim_date`` columns derived from one date column."""
    return [
        date_key(d).alias("date_key"),
        d.alias("date_id"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.quarter(d).cast("string").alias("quarter_name"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_short"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_name_short"),
        sunday_week(d).alias("week_of_year"),
        F.dayofyear(d).alias("day_of_year"),
        is_weekend(d).alias("is_weekend"),
    ]


def dim_date(spark: SparkSession, start: str | dt.date = DEFAULT_START,
             end: str | dt.date = DEFAULT_END) -> DataFrame:
    """The calendar between two dates, inclusive (2008-01-01..2030-12-31 by default).

    Days come from ``spark.range``, generated in parallel over contiguous
    partitions (partition order is date order), not exploded in one task.
    """
    first = dt.date.fromisoformat(str(start))
    n_days = (dt.date.fromisoformat(str(end)) - first).days + 1
    days = spark.range(max(n_days, 0)).select(
        F.date_add(F.lit(first.isoformat()).cast("date"), F.col("id").cast("int")).alias("d"))
    return days.select(*calendar_columns(F.col("d"))).to(schemas.DIM_DATE)


def date_bounds(df: DataFrame, date_col: str) -> tuple[dt.date | None, dt.date | None]:
    """First and last date of a column: one aggregation, two scalars to the driver."""
    d = F.col(date_col).cast("date")
    row = df.agg(F.min(d).alias("start"), F.max(d).alias("end")).first()
    return (row["start"], row["end"]) if row is not None else (None, None)


def dim_date_spanning(df: DataFrame, date_col: str) -> DataFrame:
    """The calendar covering every date of ``df[date_col]``."""
    start, end = date_bounds(df, date_col)
    if start is None:
        return df.sparkSession.createDataFrame([], schemas.DIM_DATE)
    return dim_date(df.sparkSession, start, end)


def join_calendar(facts: DataFrame, date_col: str, calendar: DataFrame,
                  calendar_days: int | None = None) -> DataFrame:
    """Star join of facts to the calendar on the fact's date (JO-6).

    Every fact is kept: one without a date, or with a date outside the
    calendar, has NULL calendar columns.

    The calendar holds one row per day, so its size is bounded by the span
    it covers; it is broadcast when that span (passed as ``calendar_days``)
    is under ``BROADCAST_MAX_DAYS`` and otherwise left to the planner.
    """
    cal = calendar
    if calendar_days is not None and calendar_days <= BROADCAST_MAX_DAYS:
        cal = F.broadcast(calendar)
    return facts.join(cal, F.col(date_col).cast("date") == cal["date_id"], "left")


def span_days(df: DataFrame, date_col: str) -> int:
    """Number of days between the first and last date of a column (one small job)."""
    row = df.agg(F.datediff(F.max(F.col(date_col).cast("date")),
                            F.min(F.col(date_col).cast("date"))).alias("n")).first()
    return 0 if row is None or row["n"] is None else int(row["n"]) + 1


def create_dim_date_table(spark: SparkSession, database: str | None,
                          start: str | dt.date = DEFAULT_START,
                          end: str | dt.date = DEFAULT_END, table: str = "dim_date") -> str:
    """CREATE OR REPLACE the calendar table, rows in ``date_key`` order (CJ-10, TK-2).

    ``spark.range`` partitions hold contiguous, ascending day ranges, so
    sorting within partitions gives the total order; no range shuffle is needed.
    """
    from nestmart.sources.tables import create_table_as
    cal = dim_date(spark, start, end).sortWithinPartitions("date_key")
    return create_table_as(cal, database, table)


# ---------------------------------------------------------------- dates inside a series

# Calendar attributes that a series entry is given.
SERIES_ATTRS = ("date_key", "year", "quarter", "month", "month_name", "week_of_year",
                "day_name", "is_weekend")


def join_series_calendar(movies: DataFrame, start: str | dt.date, end: str | dt.date,
                         attrs: tuple[str, ...] = SERIES_ATTRS) -> DataFrame:
    """Calendar attributes for every date inside ``metrics`` (JO-6), without exploding it.

    The calendar is a function of the date, so the join is date arithmetic
    inside the row: each entry gains a struct ``calendar``, with the values
    that the calendar table has for its ``collect_date``. As in
    :func:`join_calendar`, an entry without a date or with one outside
    ``start``..``end`` stays and has a NULL ``calendar``. A NULL series stays NULL.
    """
    first, last = (F.lit(str(d)).cast("date") for d in (start, end))
    types = {f.name: f.dataType for f in schemas.DIM_DATE.fields}

    def dated(entry: Column) -> Column:
        day = entry["collect_date"]
        found = dict(zip(schemas.DIM_DATE.fieldNames(), calendar_columns(day)))
        values = F.struct(*[found[a].cast(types[a]).alias(a) for a in attrs])
        return entry.withField("calendar", F.when(day.between(first, last), values))

    return movies.withColumn("metrics", F.transform("metrics", dated))


def film_months(movies: DataFrame, start: str | dt.date, end: str | dt.date,
                keys: tuple[str, ...] = ("movie_id",)) -> DataFrame:
    """Per film, year, month and weekend or not: the series' figures (JO-6).

    ``n_days`` counts entries, ``popularity`` is the sum and ``gross`` the
    maximum of the known values. The series is summed up inside the row, so
    what is exploded is one row a film and month (twice, for weekends), not
    one a film and day. Entries outside the calendar have NULL year, month
    and ``is_weekend`` and are one group.
    """
    dated = join_series_calendar(movies, start, end, ("year", "month", "is_weekend")).select(
        *keys, "metrics")
    months = F.array_distinct(F.transform("metrics", lambda m: F.struct(
        m["calendar"]["year"].alias("year"), m["calendar"]["month"].alias("month"))))

    def group(entries: Column, month: Column, weekend: Column) -> Column:
        mine = F.filter(entries, lambda m: m["calendar"]["is_weekend"].eqNullSafe(weekend))
        known = F.filter(mine, lambda m: m["popularity"].isNotNull())
        return F.struct(
            month["year"].alias("year"), month["month"].alias("month"),
            weekend.alias("is_weekend"), F.size(mine).cast("bigint").alias("n_days"),
            F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda acc, m: (
                acc + m["popularity"]))).alias("popularity"),
            F.array_max(F.transform(mine, lambda m: m["gross"])).alias("gross"))

    def groups(month: Column) -> Column:
        entries = F.filter("metrics", lambda m: m["calendar"]["year"].eqNullSafe(month["year"])
                           & m["calendar"]["month"].eqNullSafe(month["month"]))
        weekends = F.array(F.lit(False), F.lit(True), F.lit(None).cast("boolean"))
        return F.filter(F.transform(weekends, lambda w: group(entries, month, w)),
                        lambda g: g["n_days"] > 0)

    rows = dated.select(*keys, F.explode(F.flatten(F.transform(months, groups))).alias("_g"))
    return rows.select(*keys, "_g.*")


def month_totals(movies: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Totals over all films by year, month and weekend: film days, popularity, best gross."""
    return film_months(movies, start, end).groupBy("year", "month", "is_weekend").agg(
        F.sum("n_days").alias("n_days"), F.sum("popularity").alias("popularity"),
        F.max("gross").alias("gross"))
