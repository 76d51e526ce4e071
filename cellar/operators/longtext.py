"""Texts longer than a cell holds: rows are continued on further rows and put together again.

A cell holds ``MAX_CELL_TEXT`` characters. ``continued`` gives a row as many sheet rows as its longest
text needs; the first one has all columns, the others only the number of the row and the further pieces.
``whole`` undoes it: rows of one part pass as they are, only the parts of long ones are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.render import MAX_CELL_TEXT
from .ordinal import quoted, stable_partitions, with_ordinals


def continued(df: DataFrame, texts: list[str], row: str, part: str, parts: str, order_by: list[str] | None = None,
              limit: int = MAX_CELL_TEXT) -> DataFrame:
    """``df`` with ``row`` (a number of its own, also of rows that repeat), ``part`` and ``parts``; the columns
    ``texts`` cut into pieces of at most ``limit`` characters."""
    taken = {c.lower() for c in df.columns}
    if len({row.lower(), part.lower(), parts.lower()} - taken) < 3:
        raise ValueError(f"{row!r}, {part!r} and {parts!r} must be three names that the table does not have")
    numbered = with_ordinals(stable_partitions(df, order_by), row)
    needed = F.greatest(F.lit(1), *[F.ceil(F.coalesce(F.length(quoted(c)), F.lit(0)) / F.lit(limit)).cast("int") for c in texts])
    each = numbered.withColumn(parts, needed).withColumn(part, F.explode(F.sequence(F.lit(0), quoted(parts) - 1)))
    begin = quoted(part) * limit
    out = []
    for c in df.columns:
        first = quoted(part) == 0
        if c in texts:
            out.append(F.when(first | (F.length(quoted(c)) > begin), F.substring(quoted(c), begin + 1, F.lit(limit))).alias(c))
        else:
            out.append(F.when(first, quoted(c)).alias(c))
    return each.select(quoted(row), quoted(part), quoted(parts), *out)


def whole(df: DataFrame, texts: list[str], row: str, part: str, parts: str) -> DataFrame:
    """The rows that ``continued`` was given."""
    columns = [c for c in df.columns if c not in (row, part, parts)]
    short = df.where(quoted(parts) == 1).select(*[quoted(c) for c in columns])
    pieces = df.where(quoted(parts) > 1).groupBy(quoted(row)).agg(F.sort_array(F.collect_list(F.struct(
        quoted(part).alias("part"), F.struct(*[quoted(c).alias(f"c{j}") for j, c in enumerate(columns)]).alias("v")))).alias("got"))

    def value(j: int, c: str):
        first = F.col("got")[0]["v"][f"c{j}"]
        if c not in texts:
            return first.alias(c)
        joined = F.array_join(F.transform("got", lambda g: g["v"][f"c{j}"]), "")
        return F.when(first.isNotNull(), joined).alias(c)

    return short.unionByName(pieces.select(*[value(j, c) for j, c in enumerate(columns)]))
