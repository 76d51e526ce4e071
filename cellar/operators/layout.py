"""Where written rows land: sheet assignment (W7), append over partly filled sheets.

Ordinals come from ``operators.ordinal`` (no single-partition window).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.address import XLSX_MAX_ROWS
from ..functions.text import MAX_SHEET_NAME
from .ordinal import fresh


def assign_sheets(df: DataFrame, ordinal: str, base_name: str, header: bool = True,
                  max_rows: int = XLSX_MAX_ROWS) -> DataFrame:
    """W7 for a new sheet chain: sheet_no = n div c, row = n mod c + header (0-based row)."""
    cap = max_rows - (1 if header else 0)
    n = F.col(ordinal)
    sheet_no = (n / cap).cast("long")
    return df.withColumn("sheet_no", sheet_no).withColumn(
        "sheet", continuation_name_col(F.lit(base_name), sheet_no)).withColumn(
        "row", (n % cap + (1 if header else 0)).cast("long"))


def continuation_name_col(base: Column, i: Column) -> Column:
    """C23 with the writer's rule (Q6): sheet 0 keeps the name, sheet i is '<name> (i)'."""
    name = F.when(i == 0, base).otherwise(F.concat(base, F.lit(" ("), i.cast("string"), F.lit(")")))
    return F.when(F.length(name) <= MAX_SHEET_NAME, name).otherwise(
        F.raise_error(F.concat(F.lit("sheet name too long: "), name)))


def _which(n: Column, highs: list[int], lo: int, hi: int) -> Column:
    """Number of the first of the sorted ``highs`` that ``n`` does not exceed: a balanced tree."""
    if lo >= hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(n <= highs[mid], _which(n, highs, lo, mid)).otherwise(_which(n, highs, mid + 1, hi))


def append_chain(df: DataFrame, ordinal: str, chain: DataFrame, max_rows: int, header: bool = True,
                 sheet_col: str = "sheet_no", row_col: str = "row") -> DataFrame:
    """Rows (0-based ``ordinal``) appended over an existing chain of sheets.

    ``chain`` = (sheet_no, last_row) for the existing sheets ``name``, ``name (1)``, ... in order.
    Each existing sheet takes ``max_rows - (last_row + 1)`` more rows after its own last row
    (a full sheet is passed over); rows beyond the chain open new sheets with a header.
    The chain holds one row per existing sheet of one workbook (bounded by the sheets a
    workbook can hold): its bounds become literals that each row is compared with in a balanced
    tree, so there is no join.
    """
    sheets = sorted((r["sheet_no"], r["last_row"]) for r in chain.select("sheet_no", "last_row").collect())
    free = [(no, last, max(0, max_rows - (last + 1))) for no, last in sheets]
    total, k = sum(f for *_, f in free), (sheets[-1][0] + 1 if sheets else 0)
    lows, at = [], 0
    for _, _, f in free:
        lows.append(at)
        at += f
    open_ = [(no, last, lo, lo + f - 1) for (no, last, f), lo in zip(free, lows) if f]
    n = F.col(ordinal)
    cap = max_rows - (1 if header else 0)
    beyond = n - F.lit(total)
    new_no, new_row = F.lit(k) + (beyond / cap).cast("long"), beyond % cap + (1 if header else 0)
    if not open_:
        return df.withColumn(sheet_col, new_no.cast("long")).withColumn(row_col, new_row.cast("long"))
    which = _which(n, [hi for *_, hi in open_], 0, len(open_))

    (slot,) = fresh(df, "__which")

    def pick(values: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), F.col(slot) + 1)

    inside = F.col(slot) < len(open_)
    out = df.withColumn(slot, which.cast("int"))
    out = out.withColumn(sheet_col, F.when(inside, pick([no for no, *_ in open_])).otherwise(new_no).cast("long"))
    start = pick([last + 1 - lo for _, last, lo, _ in open_])
    return out.withColumn(row_col, F.when(inside, start + n).otherwise(new_row).cast("long")).drop(slot)

