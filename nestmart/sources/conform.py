"""Bring a frame to a declared table schema (IO-11).

Top-level and nested struct fields are matched by name and put in the
declared order, arrays of structs are rebuilt element-wise with
``transform``, leaves are cast with ``try_cast`` (malformed → NULL), and
declared fields missing from the input become typed NULLs. Input fields not
in the schema are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _same(a: T.DataType, b: T.DataType) -> bool:
    return a.simpleString() == b.simpleString()


def conform_column(c: Column, src: T.DataType, dst: T.DataType) -> Column:
    if _same(src, dst):
        return c
    if isinstance(dst, T.StructType) and isinstance(src, T.StructType):
        have = {f.name: f.dataType for f in src.fields}
        return F.struct(*[
            (conform_column(c[f.name], have[f.name], f.dataType) if f.name in have
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in dst.fields])
    if isinstance(dst, T.ArrayType) and isinstance(src, T.ArrayType):
        return F.transform(c, lambda x: conform_column(x, src.elementType, dst.elementType))
    return c.try_cast(dst)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        (conform_column(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])
