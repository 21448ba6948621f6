"""Column helpers: every function takes and returns ``Column`` expressions.

They compile to Catalyst expressions (no Python runs per row); lambdas passed
to ``F.transform`` / ``F.filter`` are higher-order-function bodies, not UDFs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- casts (SC-1, SC-2)

def try_cast(c: ColumnOrName, data_type: T.DataType | str) -> Column:
    """Cast that yields NULL on malformed or overflowing input instead of failing.

    Spark 4 runs with ANSI mode on, where ``cast('' as bigint)`` raises; the
    warehouse semantics wanted here are "bad input becomes NULL".
    """
    return _col(c).try_cast(data_type)


def typed_null(data_type: T.DataType | str) -> Column:
    return F.lit(None).cast(data_type)


def as_float64(c: ColumnOrName) -> Column:
    """32-bit float widened to double, keeping the float's rounding."""
    return _col(c).cast(T.FloatType()).cast(T.DoubleType())


# ---------------------------------------------------------------- value rules

def zero_to_null(c: ColumnOrName) -> Column:
    """0 becomes NULL (SC-6); everything else passes."""
    return F.nullif(_col(c), F.lit(0))


def empty_to_null(c: ColumnOrName) -> Column:
    """Empty array becomes NULL; NULL stays NULL (AR-3, AR-11, SC-8)."""
    arr = _col(c)
    return F.when(F.size(arr) > 0, arr)


def null_to_empty(c: ColumnOrName, element_type: T.DataType) -> Column:
    """NULL array read as empty, the way repeated fields behave in a warehouse."""
    return F.coalesce(_col(c), F.array().cast(T.ArrayType(element_type)))


def strip_chars(c: ColumnOrName, pattern: str) -> Column:
    """Remove every match of ``pattern`` (SC-4)."""
    return F.regexp_replace(_col(c), pattern, "")


# The characters removed before money strings are parsed.
GROSS_STRIP = r"\$|,"   # worldwide gross: dollar sign and thousands separators
PLAIN_STRIP = ","       # opening and budget: thousands separators only


# What a non-ANSI string-to-long cast accepts (a fraction is truncated, no
# digit before the point is 0), and the characters that it trims.
WHOLE_NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]*)$"
TRIMMED = r"^[\x00-\x20]+|[\x00-\x20]+$"


def string_to_long(c: ColumnOrName) -> Column:
    """String to bigint the way a non-ANSI cast does it: ``' 12 '`` → 12,
    ``'1234.5'`` → 1234, ``'.5'`` → 0; anything else (blank, dash, exponent, overflow) → NULL."""
    s = F.regexp_replace(_col(c), TRIMMED, "")
    whole = F.regexp_extract(s, r"^([+-]?[0-9]+)", 1)
    return F.when(s.rlike(WHOLE_NUMBER),
                  F.when(whole == "", F.lit(0).cast("bigint")).otherwise(
                      try_cast(whole, "bigint")))


def money_to_long(c: ColumnOrName, strip_dollar: bool) -> Column:
    """Parse a money string to bigint; blanks, dashes and leftovers give NULL."""
    return string_to_long(strip_chars(c, GROSS_STRIP if strip_dollar else PLAIN_STRIP))


def non_blank(c: ColumnOrName) -> Column:
    """Predicate: not NULL and not the empty string (FI-5)."""
    x = _col(c)
    return x.isNotNull() & (x != F.lit(""))


# ---------------------------------------------------------------- arrays

def keep_by_order(arr: ColumnOrName, max_order: int, field: str = "order") -> Column:
    """Keep array entries whose ordinal is <= ``max_order`` (FI-3).

    Applied to the array before it is exploded: Catalyst does not push a
    filter on the exploded struct below the generator.
    """
    return F.filter(_col(arr), lambda x: x[field] <= F.lit(max_order))


def keep_values(arr: ColumnOrName, field: str, values: Iterable[str]) -> Column:
    """Keep array entries whose ``field`` is in ``values`` (FI-2, case-sensitive)."""
    vals = list(values)
    return F.filter(_col(arr), lambda x: x[field].isin(vals))


def retype_entries(arr: ColumnOrName, fields: list[tuple[str, str, str | None]]) -> Column:
    """Map an array of structs to new field names and types (AR-1).

    ``fields`` holds ``(source_field, target_name, target_type_or_None)``.
    """
    def rebuild(x: Column) -> Column:
        parts = []
        for src, dst, typ in fields:
            v = x[src]
            if typ is not None:
                v = try_cast(v, typ)
            parts.append(v.alias(dst))
        return F.struct(*parts)

    return F.transform(_col(arr), rebuild)


def zip_truncated(arrays: dict[str, ColumnOrName],
                  element_types: dict[str, T.DataType]) -> Column:
    """Positional zip of arrays cut to the shortest (JO-5, AR-9).

    ``arrays_zip`` pads to the longest with NULLs; a positional inner join
    keeps only offsets present in every array, so the zip is sliced to the
    least size. A NULL or empty input gives an empty array. Fields of the
    zipped structs are named after the keys of ``arrays``.
    """
    named = [F.coalesce(_col(c), F.array().cast(T.ArrayType(element_types[name]))).alias(name)
             for name, c in arrays.items()]
    shortest = F.least(*[F.size(c) for c in named]) if len(named) > 1 else F.size(named[0])
    return F.slice(F.arrays_zip(*named), F.lit(1), shortest)


# ---------------------------------------------------------------- series (ME-2, AR-6, AR-7)

def metric_placeholder(run_date: Column) -> Column:
    """One all-NULL metrics entry stamped with the run date."""
    return F.struct(
        typed_null("double").alias("popularity"),
        typed_null("bigint").alias("vote_count"),
        typed_null("double").alias("vote_average"),
        typed_null("bigint").alias("gross"),
        run_date.cast("date").alias("collect_date"),
    )


def append_series(stored: ColumnOrName, today: ColumnOrName, present_today: Column,
                  run_date: Column, element_type: T.DataType,
                  replace_day: bool = False) -> Column:
    """Stored series ++ today's entries, or ++ a placeholder when absent today.

    NULL and empty stored arrays are treated alike. ``replace_day`` (off by
    default, as in the original daily merge) makes a date safe to run again,
    also after later dates: stored entries of ``run_date`` are replaced, the
    series stays in date order (entries without a date first), and a film
    whose first entry is later than ``run_date`` gains no placeholder.
    """
    empty = F.array().cast(T.ArrayType(element_type))
    old = F.coalesce(_col(stored), empty)
    placeholder = F.array(metric_placeholder(run_date))
    if not replace_day:
        new = F.when(present_today, F.coalesce(_col(today), empty)).otherwise(placeholder)
        return F.concat(old, new)
    day = run_date.cast("date")
    known = F.exists(old, lambda m: F.coalesce(m["collect_date"] <= day, F.lit(False)))
    new = F.when(present_today, F.coalesce(_col(today), empty)).otherwise(
        F.when(known, placeholder).otherwise(empty))
    kept = F.filter(old, lambda m: ~m["collect_date"].eqNullSafe(day))
    dated = F.transform(F.concat(kept, new),
                        lambda m: F.struct(m["collect_date"].alias("on"), m.alias("entry")))
    return F.sort_array(dated)["entry"]


# ---------------------------------------------------------------- series summaries

def series_sum(arr_field: ColumnOrName, zero: Column) -> Column:
    """Sum of the non-NULL values of an array (NULL entries skipped)."""
    return F.aggregate(_col(arr_field), zero, lambda acc, x: acc + F.coalesce(x, zero))


def series_count(arr_field: ColumnOrName) -> Column:
    """Number of non-NULL values of an array."""
    return F.size(F.filter(_col(arr_field), lambda x: x.isNotNull()))


# ---------------------------------------------------------------- calendar (SC-3, SC-9..SC-11)

def date_key(d: ColumnOrName) -> Column:
    """yyyymmdd as a NUMERIC-like decimal key."""
    return F.date_format(_col(d), "yyyyMMdd").cast(T.DecimalType(38, 9))


def sunday_week(d: ColumnOrName) -> Column:
    """Week of year with weeks starting on Sunday; days before the first Sunday are week 0.

    ``weekofyear`` is ISO-8601 (Monday start, week 1 may begin in December)
    and would differ on most days.
    """
    x = _col(d)
    return F.floor((F.dayofyear(x) + F.lit(7) - F.dayofweek(x)) / F.lit(7)).cast("int")


def is_weekend(d: ColumnOrName) -> Column:
    """Saturday or Sunday (Spark's dayofweek: 1 = Sunday, 7 = Saturday)."""
    return F.dayofweek(_col(d)).isin(1, 7)
