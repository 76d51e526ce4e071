"""Addressed cell updates as a distributed merge.

Base cells and patches are in long form ``(sheet, row, col, k, n, s)``. Patches are
reduced to one per address (J2: last write wins by the caller's sequence column), checked
(J3), and merged with a full outer equi-join on (sheet, row, col): hash or sort-merge as
Catalyst chooses, with AQE skew handling. Addresses are unique per side after J2, so no
key can blow up the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.address import parse_address
from ..plans.cells import to_cell

CLEARED = "x"  # kind of a patch that clears its cell (J4)


def patches_from_table(df: DataFrame, address_col: str | None = None, sheet: str | None = None,
                       seq_col: str | None = None, missing: str | None = None) -> DataFrame:
    """Patch rows -> long-form patches (sheet, row, col, seq, k, n, s).

    J7: the address column is the configured string column, else the first string column.
    J3: a row with two non-missing values fails. J4: a row without values clears the cell,
    or writes the ``missing`` text when given.
    """
    if address_col is None:
        strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in ("sheet", seq_col)]
        if not strings:
            raise ValueError("The patch table has no string column for the addresses")
        address_col = strings[0]
    value_cols = [f for f in df.schema.fields if f.name not in (address_col, seq_col, "sheet")]
    if not value_cols:
        raise ValueError("The patch table has no value column")
    vals = [F.col(f"`{f.name}`") for f in value_cols]
    n_present = sum((v.isNotNull().cast("int") for v in vals), F.lit(0))
    cells = [to_cell(F.col(f"`{f.name}`"), f.dataType) for f in value_cols]
    chosen = F.coalesce(*cells)
    if missing is not None:
        fallback = F.struct(F.lit("s").alias("k"), F.lit(None).cast("double").alias("n"), F.lit(missing).alias("s"))
    else:
        fallback = F.struct(F.lit(CLEARED).alias("k"), F.lit(None).cast("double").alias("n"),
                            F.lit(None).cast("string").alias("s"))
    addr = parse_address(F.col(f"`{address_col}`"))
    checked = F.when(n_present <= 1, F.coalesce(chosen, fallback)).otherwise(
        F.raise_error(F.concat(F.lit("more than one value given for cell "), F.col(f"`{address_col}`"))).cast("struct<k:string,n:double,s:string>"))
    out = df.select(
        (F.col("sheet") if "sheet" in df.columns else F.lit(sheet)).alias("sheet"),
        addr["row"].alias("row"), addr["col"].alias("col"),
        (F.col(f"`{seq_col}`").cast("long") if seq_col else F.lit(0).cast("long")).alias("seq"),
        checked.alias("cell"),
    )
    return out.select("sheet", "row", "col", "seq", "cell.k", "cell.n", "cell.s")


def last_write_wins(patches: DataFrame) -> DataFrame:
    """One patch per address, the one with the highest ``seq`` (partial aggregation first).

    Which of two patches is the last is only known from a sequence: an address that is patched
    twice with different values under one ``seq`` fails.
    """
    value = F.struct("k", "n", "s")
    top = patches.groupBy("sheet", "row", "col").agg(
        F.max(F.struct("seq", value.alias("p"))).alias("hi"), F.min(F.struct("seq", value.alias("p"))).alias("lo"))
    unclear = (F.col("hi.seq") == F.col("lo.seq")) & ~F.col("hi.p").eqNullSafe(F.col("lo.p"))
    where = F.concat_ws(" ", F.lit("patches without a sequence disagree on"), "sheet", "row", "col")
    p = F.when(unclear, F.raise_error(where).cast("struct<k:string,n:double,s:string>")).otherwise(F.col("hi.p"))
    return top.select("sheet", "row", "col", p.alias("p")).select("sheet", "row", "col", "p.k", "p.n", "p.s")


def require_sheets(patches: DataFrame, sheets: DataFrame) -> None:
    """Every patched sheet must exist (left anti join; raises with the missing names)."""
    missing = patches.select("sheet").distinct().join(sheets.select("sheet").distinct(), "sheet", "left_anti")
    bad = [r["sheet"] for r in missing.limit(20).collect()]
    if bad:
        raise ValueError(f"Sheets to update do not exist: {bad}")


def apply_patches(base: DataFrame, patches: DataFrame) -> DataFrame:
    """Existing cells replaced, missing ones created, cleared ones removed (J4). A ``style`` column
    is carried along; ``sinks.update`` has the rule for cells of a workbook (J6)."""
    p = last_write_wins(patches).select(
        "sheet", "row", "col", F.col("k").alias("pk"), F.col("n").alias("pn"), F.col("s").alias("ps"))
    b = base
    has_style = "style" in base.columns
    merged = b.join(p, ["sheet", "row", "col"], "full_outer")
    take = F.col("pk").isNotNull()
    out = merged.select(
        "sheet", "row", "col",
        F.when(take, F.col("pk")).otherwise(F.col("k")).alias("k"),
        F.when(take, F.col("pn")).otherwise(F.col("n")).alias("n"),
        F.when(take, F.col("ps")).otherwise(F.col("s")).alias("s"),
        *([F.col("style")] if has_style else []),
    )
    return out.filter(F.col("k") != F.lit(CLEARED))
