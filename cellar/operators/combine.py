"""Combining tables read from several files (U1-U7) and schema drift checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# lattice join of Spark types, mirroring the cell lattice (INT < LONG < DOUBLE; DATE < DATETIME)
_RANK_NUM = {T.IntegerType: 1, T.LongType: 2, T.DoubleType: 3}


def join_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """U4: the lowest common type of two column types."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    ra, rb = _RANK_NUM.get(type(a)), _RANK_NUM.get(type(b))
    if ra and rb:
        return [T.IntegerType(), T.LongType(), T.DoubleType()][max(ra, rb) - 1]
    if {type(a), type(b)} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return T.StringType()


def combine(tables: list[DataFrame], how: str = "union") -> DataFrame:
    """U1 union (absent columns missing) / U2 intersection / U3 fail on differing names.

    Column order: first appearance over the tables in order. Types: lattice join per name.
    """
    order: list[str] = []
    types: dict[str, T.DataType] = {}
    present: dict[str, int] = {}
    for df in tables:
        for f in df.schema.fields:
            if f.name not in types:
                order.append(f.name)
                types[f.name] = f.dataType
            else:
                types[f.name] = join_types(types[f.name], f.dataType)
            present[f.name] = present.get(f.name, 0) + 1
    if how == "fail":
        odd = [c for c in order if present[c] != len(tables)]
        if odd:
            raise ValueError(f"The tables have differing columns: {odd}")
    if how == "intersection":
        order = [c for c in order if present[c] == len(tables)]
    aligned = []
    for df in tables:
        names = set(df.columns)
        aligned.append(df.select(*[
            (_cast(F.col(f"`{c}`"), df.schema[c].dataType, types[c]) if c in names
             else F.lit(None).cast(types[c])).alias(c) for c in order]))
    return reduce(lambda x, y: x.unionByName(y), aligned)


def _cast(c, src: T.DataType, dst: T.DataType):
    if src == dst:
        return c
    if isinstance(dst, T.StringType) and isinstance(src, T.BooleanType):
        return F.when(c, F.lit("true")).when(~c, F.lit("false"))
    return c.cast(dst)


def check_names(df: DataFrame, saved: list[str], policy: str = "fail") -> DataFrame:
    """Compare column names with a saved schema (types ignored): fail / use new / ignore."""
    if policy == "fail" and list(df.columns) != list(saved):
        raise ValueError(f"The table structure changed: expected {saved}, found {df.columns}")
    if policy == "saved":
        keep = [c for c in saved if c in df.columns]
        return df.select(*keep)
    return df


def legacy_combine(tables: list[DataFrame]) -> DataFrame:
    """The first table gives the schema; all others must have the same names and types."""
    first = tables[0].schema
    for df in tables[1:]:
        if [(f.name, f.dataType) for f in df.schema.fields] != [(f.name, f.dataType) for f in first.fields]:
            raise ValueError("Input files have different structures")
    return reduce(lambda x, y: x.unionByName(y), tables)
