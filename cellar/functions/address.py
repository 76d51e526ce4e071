"""Spreadsheet coordinates as Spark Column expressions (JVM side, codegen friendly).

Column indexes are 0-based everywhere in this library (A = 0); row numbers given by
users are 1-based and converted to 0-based indexes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sheet capacities of the two workbook formats.
XLSX_MAX_ROWS = 1048576
XLSX_MAX_COLS = 16384
XLS_MAX_ROWS = 65536
XLS_MAX_COLS = 256

# Seven letters cover every non-negative int32 column number (26**7 > 2**31).
_MAX_LETTERS = 7


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def col_label(idx) -> Column:
    """0-based column index -> letters (0 -> A, 25 -> Z, 26 -> AA). NULL for negatives."""
    i = _col(idx).cast("long")
    n = i + 1
    letters = []
    for _ in range(_MAX_LETTERS):
        letters.append(F.when(n > 0, F.chr(F.lit(65) + (n - 1) % 26)))
        # truncating division keeps n at 0 once exhausted
        n = ((n - 1) / 26).cast("long")
    return F.when(i >= 0, F.concat_ws("", *reversed(letters)))


def col_index(label, strict: bool = True) -> Column:
    """Letters -> 0-based index; '' -> -1; anything but [A-Z]+ raises (or NULL if not strict)."""
    s = _col(label)
    value = F.aggregate(
        F.split(s, ""), F.lit(0).cast("long"), lambda acc, c: acc * 26 + (F.ascii(c) - 64)
    ) - 1
    bad = F.raise_error(F.concat(F.lit("no column (capital letters or a number): "), s)) if strict else F.lit(None)
    return (
        F.when(s.isNull(), F.lit(None).cast("long"))
        .when(s == "", F.lit(-1).cast("long"))
        .when(s.rlike("^[A-Z]+$"), value)
        .otherwise(bad.cast("long"))
    )


def parse_col(text, default: int = 0) -> Column:
    """Column given as 1-based number or as letters -> 0-based index; blank -> default."""
    s = F.trim(_col(text))
    num = s.try_cast("int")
    return (
        F.when(s.isNull() | (s == ""), F.lit(default).cast("long"))
        .when(num.isNotNull(), (num - 1).cast("long"))
        .otherwise(col_index(s))
    )


def parse_row(text, default: int = 0) -> Column:
    """1-based row number text -> 0-based index; blank -> default; < 1 raises."""
    s = F.trim(_col(text))
    num = s.try_cast("int")
    idx = F.when(s.isNull() | (s == ""), F.lit(default)).otherwise(num - 1)
    err = F.raise_error(F.concat(F.lit("rows count from 1, got '"), s, F.lit("'")))
    return F.when(idx >= 0, idx).otherwise(err.cast("int"))


_A1 = r"^\$?([A-Za-z]+)\$?([0-9]+)$"
_NUMERIC = r"^\s*([+-]?[0-9]+)\s*:\s*([+-]?[0-9]+)\s*$"


def parse_address(text, strict: bool = True) -> Column:
    """Cell address -> STRUCT<row INT, col INT> (both 0-based).

    Accepts ``B7`` (letters + 1-based row, optional ``$``) and ``<col>:<row>`` with 1-based numbers.
    Anything else, or a negative result, raises (``strict``) or gives NULL.
    """
    s = _col(text)
    is_pair = F.instr(s, ":") > 0
    pair_col = F.regexp_extract(s, _NUMERIC, 1).try_cast("int") - 1
    pair_row = F.regexp_extract(s, _NUMERIC, 2).try_cast("int") - 1
    a1_ok = s.rlike(_A1)
    a1_col = col_index(F.upper(F.regexp_extract(s, _A1, 1)), strict=False).cast("int")
    a1_row = F.regexp_extract(s, _A1, 2).try_cast("int") - 1
    row = F.when(is_pair, pair_row).when(a1_ok, a1_row)
    col = F.when(is_pair, pair_col).when(a1_ok, a1_col)
    ok = row.isNotNull() & col.isNotNull() & (row >= 0) & (col >= 0)
    res = F.struct(row.alias("row"), col.alias("col"))
    if not strict:
        return F.when(ok, res)
    err = F.raise_error(F.concat(F.lit("no cell address: '"), s, F.lit("'")))
    return F.when(ok, res).otherwise(err.cast("struct<row:int,col:int>"))


def a1(row, col) -> Column:
    """0-based (row, col) -> A1 address text."""
    return F.concat(col_label(col), (_col(row) + 1).cast("string"))
