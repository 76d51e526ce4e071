"""The cell intermediate form and its typing, all as Spark expressions.

A cell is ``STRUCT<k STRING, n DOUBLE, s STRING>`` (kinds in ``functions.types``). Rows of
a sheet are ``(path, row_idx, seq, cells MAP<INT, cell>)``; the wide table is a projection
``element_at(cells, j)`` per column, so no pivot and no shuffle is needed.

* ``cell_bit``   -- lattice bit of one cell (C7, C9, C10, C14, C15)
* ``lattice_type`` -- CASE from an OR-ed mask to a type name (A1, A3)
* ``cell_value`` -- value of a cell in a column of a given type (C8, C18, widening rules)
* ``melt``       -- any DataFrame -> rows with a cells map (to run the sheet operators on
  tables that do not come from workbooks)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import (
    datetime_kind,
    datetime_to_serial,
    render_datetime,
    render_time,
    serial_datable,
    serial_to_datetime,
)
from ..functions.display import displayed
from ..functions.numbers import narrow_bit
from ..functions.text import ERROR_PATTERN, is_blank
from ..functions.types import (
    BIT_BOOLEAN,
    BIT_DATE,
    BIT_DATETIME,
    BIT_DOUBLE,
    BIT_INT,
    BIT_LONG,
    BIT_STRING,
    BIT_TIME,
    CELL_STRUCT,
    spark_type,
)

# which cell bits a column type accepts (the lattice's down-sets)
ACCEPTS = {
    "INT": BIT_INT,
    "LONG": BIT_INT | BIT_LONG,
    "DOUBLE": BIT_INT | BIT_LONG | BIT_DOUBLE,
    "BOOLEAN": BIT_BOOLEAN,
    "DATE": BIT_DATE,
    "DATETIME": BIT_DATE | BIT_DATETIME,
    "TIME": BIT_TIME,
    "STRING": 255,
}


def _bits(m: Column, bits: int) -> Column:
    return m.bitwiseAND(F.lit(bits))


def enrich(cell: Column, date1904=False) -> Column:
    """Stage 1 of typing: keep (k, n, s) and add the calendar value ``ts`` of serial dates."""
    return F.struct(
        cell["k"].alias("k"), cell["n"].alias("n"), cell["s"].alias("s"),
        F.when(cell["k"] == "d", serial_to_datetime(cell["n"], date1904)).alias("ts"),
    )


class CellView:
    """Fields of a typed cell as separate Columns (struct fields or staged columns)."""

    def __init__(self, k: Column, n: Column, s: Column, ts: Column, b: Column | None = None):
        self.k, self.n, self.s, self.ts, self.b = k, n, s, ts, b

    def __getitem__(self, name: str) -> Column:
        return getattr(self, name)

    def isNull(self) -> Column:  # noqa: N802 - mirrors Column
        return self.k.isNull()

    @classmethod
    def of(cls, e) -> "CellView":
        return e if isinstance(e, CellView) else cls(e["k"], e["n"], e["s"], e["ts"], e["b"])


def staged_typing(df: DataFrame, cell_cols: list[str], date1904=False, error_pattern: str | None = ERROR_PATTERN,
                  blank_to_missing: bool = True) -> tuple[DataFrame, list[CellView]]:
    """Type cell struct columns in three projections (timestamp, then bit), all code-generated.

    Each stage materialises its columns once, so the optimizer does not inline the serial
    date arithmetic into every use (the non-cheap expressions stop CollapseProject).
    """
    ts_cols = [F.when(F.col(c)["k"] == "d", serial_to_datetime(F.col(c)["n"], date1904)).alias(f"{c}__ts")
               for c in cell_cols]
    df = df.select("*", *ts_cols)
    views = [CellView(F.col(c)["k"], F.col(c)["n"], F.col(c)["s"], F.col(f"{c}__ts")) for c in cell_cols]
    df = df.select("*", *[_bit_of(v, date1904, error_pattern, blank_to_missing).alias(f"{c}__b")
                          for c, v in zip(cell_cols, views)])
    for c, v in zip(cell_cols, views):
        v.b = F.col(f"{c}__b")
    return df, views


def _bit_of(e, date1904, error_pattern, blank_to_missing) -> Column:
    k, n, s, ts = e["k"], e["n"], e["s"], e["ts"]
    text_bit = F.lit(BIT_STRING)
    if blank_to_missing:
        text_bit = F.when(is_blank(s), F.lit(0)).otherwise(F.lit(BIT_STRING))
    return (
        F.when(e.isNull(), F.lit(0))
        .when(k == "n", narrow_bit(n))
        .when(k == "d", F.when(ts.isNull(), F.lit(BIT_DOUBLE)).otherwise(datetime_kind(ts, date1904)))
        .when(k == "b", F.lit(BIT_BOOLEAN))
        .when(k == "s", F.when(s.isNull(), F.lit(0)).otherwise(text_bit))
        .when(k == "e", F.lit(BIT_STRING if error_pattern is not None else 0))
        .otherwise(F.lit(0))
    )


def typed(e: Column, date1904=False, error_pattern: str | None = ERROR_PATTERN,
          blank_to_missing: bool = True) -> Column:
    """Stage 2 of typing: add the lattice bit ``b`` to an enriched cell."""
    return F.struct(e["k"].alias("k"), e["n"].alias("n"), e["s"].alias("s"), e["ts"].alias("ts"),
                    _bit_of(e, date1904, error_pattern, blank_to_missing).alias("b"))


def typed_map(cells: Column, date1904=False, error_pattern: str | None = ERROR_PATTERN,
              blank_to_missing: bool = True) -> Column:
    """All cells of a row typed once (two ``transform_values`` passes), for many column picks."""
    m = F.transform_values(cells, lambda _, c: enrich(c, date1904))
    return F.transform_values(m, lambda _, e: typed(e, date1904, error_pattern, blank_to_missing))


def typed_array(cells: Column, date1904=False, error_pattern: str | None = ERROR_PATTERN,
                blank_to_missing: bool = True) -> Column:
    a = F.transform(cells, lambda c: enrich(c, date1904))
    return F.transform(a, lambda e: typed(e, date1904, error_pattern, blank_to_missing))


def _one(cell: Column, date1904, error_pattern, blank_to_missing) -> Column:
    """Typed form of a single raw cell behind lambda boundaries (keeps generated code small)."""
    a = F.transform(F.array(cell), lambda c: enrich(c, date1904))
    return F.transform(a, lambda e: typed(e, date1904, error_pattern, blank_to_missing))


def cell_bit(cell: Column, date1904=False, error_pattern: str | None = ERROR_PATTERN,
             blank_to_missing: bool = True) -> Column:
    """Lattice bit of one raw cell; 0 = missing."""
    return F.element_at(_one(cell, date1904, error_pattern, blank_to_missing), 1)["b"]


def mask_of_array(cells: Column, date1904=False, error_pattern: str | None = ERROR_PATTERN,
                  blank_to_missing: bool = True) -> Column:
    """OR of the bits of an array of raw cells."""
    return F.aggregate(typed_array(cells, date1904, error_pattern, blank_to_missing), F.lit(0),
                       lambda acc, e: acc.bitwiseOR(e["b"]))


def lattice_type(mask: Column) -> Column:
    """A1: the lowest lattice node accepting every bit of ``mask`` (0 -> STRING without type)."""
    m = mask
    num = BIT_INT | BIT_LONG | BIT_DOUBLE
    dt = BIT_DATE | BIT_DATETIME
    return (
        F.when(m == 0, F.lit("STRING"))
        .when(_bits(m, BIT_STRING) != 0, F.lit("STRING"))
        .when(_bits(m, 255 & ~num) == 0, F.when(_bits(m, BIT_DOUBLE) != 0, F.lit("DOUBLE"))
              .when(_bits(m, BIT_LONG) != 0, F.lit("LONG")).otherwise(F.lit("INT")))
        .when(m == BIT_BOOLEAN, F.lit("BOOLEAN"))
        .when(_bits(m, 255 & ~dt) == 0, F.when(_bits(m, BIT_DATETIME) != 0, F.lit("DATETIME"))
              .otherwise(F.lit("DATE")))
        .when(m == BIT_TIME, F.lit("TIME"))
        .otherwise(F.lit("STRING"))
    )


def legacy_lattice_type(mask: Column) -> Column:
    """A10: no LONG (whole numbers beyond int become double); dates mixed with anything else -> STRING."""
    m = mask
    num = BIT_INT | BIT_LONG | BIT_DOUBLE
    dt = BIT_DATE | BIT_DATETIME | BIT_TIME
    return (
        F.when(m == 0, F.lit("STRING"))
        .when(_bits(m, BIT_STRING) != 0, F.lit("STRING"))
        .when(_bits(m, 255 & ~num) == 0, F.when(m == BIT_INT, F.lit("INT")).otherwise(F.lit("DOUBLE")))
        .when(m == BIT_BOOLEAN, F.lit("BOOLEAN"))
        .when(_bits(m, 255 & ~dt) == 0, F.lit("DATETIME"))
        .otherwise(F.lit("STRING"))
    )


def oldest_lattice_type(mask: Column) -> Column:
    """Booleans and dates read as text; whole numbers int, other numbers double."""
    m = mask
    return (
        F.when(m == 0, F.lit("STRING"))
        .when(_bits(m, BIT_STRING | BIT_BOOLEAN | BIT_DATE | BIT_DATETIME | BIT_TIME) != 0, F.lit("STRING"))
        .when(_bits(m, BIT_LONG | BIT_DOUBLE) != 0, F.lit("DOUBLE"))
        .otherwise(F.lit("INT"))
    )


def _time_of(ts: Column) -> Column:
    tt = spark_type("TIME")
    if isinstance(tt, T.StringType):
        return render_time(ts)
    return F.date_format(ts, "HH:mm:ss.SSSSSS").cast(tt)


def render_typed(e, error_pattern: str | None = ERROR_PATTERN, formats: list[str] | None = None) -> Column:
    """Text of a typed cell (struct or CellView), as used for STRING columns.

    C32: with ``formats``, a number cell carries its format code in ``s`` and shows as that format does.
    """
    k, n, s, ts, b = e["k"], e["n"], e["s"], e["ts"], e["b"]
    nb = narrow_bit(n)
    num_text = F.when((nb == BIT_INT) | (nb == BIT_LONG), n.cast("decimal(20,0)").cast("string")).otherwise(
        n.cast("string"))
    if formats:
        num_text = displayed(n, s, formats)
    date_text = (
        F.when(ts.isNull(), n.cast("string"))
        .when(b == BIT_TIME, render_time(ts))
        .when(b == BIT_DATE, F.date_format(ts, "yyyy-MM-dd"))
        .otherwise(render_datetime(ts))
    )
    return (
        F.when(e.isNull(), F.lit(None).cast("string"))
        .when(k == "s", s)
        .when(k == "n", num_text)
        .when(k == "d", date_text)
        .when(k == "b", F.when(n == 1.0, F.lit("true")).otherwise(F.lit("false")))
        .when(k == "e", F.lit(error_pattern))
    )


def render_cell(cell: Column, date1904=False, error_pattern: str | None = ERROR_PATTERN) -> Column:
    """C18 for a raw cell."""
    t = _one(cell, date1904, error_pattern, True)
    return F.element_at(F.transform(t, lambda e: render_typed(e, error_pattern)), 1)


def value_typed(e, type_name: str, error_pattern: str | None = ERROR_PATTERN, on_misfit: str = "failfast",
                where: Column | None = None, formats: list[str] | None = None) -> Column:
    """Value of a typed cell in a column of ``type_name``; a misfit fails (reference rule) or gives NULL."""
    n, ts, bit = e["n"], e["ts"], e["b"]
    if type_name == "INT":
        val = n.cast("int")
    elif type_name == "LONG":
        val = n.cast("long")
    elif type_name == "DOUBLE":
        val = n
    elif type_name == "BOOLEAN":
        val = n == 1.0
    elif type_name == "DATE":
        val = F.to_date(ts)
    elif type_name == "DATETIME":
        val = ts
    elif type_name == "TIME":
        val = _time_of(ts)
    else:
        val = render_typed(e, error_pattern, formats)
    spark_type_ = spark_type(type_name)
    fits = _bits(bit, ACCEPTS[type_name]) != 0
    if type_name == "STRING":
        return F.when(bit == 0, F.lit(None).cast(spark_type_)).otherwise(val)
    if on_misfit == "failfast":
        msg = F.concat(
            F.lit(f"Cell does not fit the column type {type_name}: kind "), e["k"], F.lit(" value "),
            F.coalesce(e["s"], e["n"].cast("string"), F.lit("")),
            F.lit("") if where is None else F.concat(F.lit(" at "), where),
        )
        bad = F.raise_error(msg).cast(spark_type_)
    else:
        bad = F.lit(None).cast(spark_type_)
    return F.when(bit == 0, F.lit(None).cast(spark_type_)).when(fits, val.cast(spark_type_)).otherwise(bad)


def cell_value(cell: Column, type_name: str, date1904=False, error_pattern: str | None = ERROR_PATTERN,
               blank_to_missing: bool = True, on_misfit: str = "failfast", where: Column | None = None) -> Column:
    """Value of a raw cell in a column of ``type_name``."""
    t = _one(cell, date1904, error_pattern, blank_to_missing)
    return F.element_at(F.transform(t, lambda e: value_typed(e, type_name, error_pattern, on_misfit, where)), 1)


def struct_cell(kind: str, num: Column | None = None, txt: Column | None = None) -> Column:
    return F.struct(
        F.lit(kind).alias("k"),
        (num if num is not None else F.lit(None)).cast("double").alias("n"),
        (txt if txt is not None else F.lit(None)).cast("string").alias("s"),
    )


def to_cell(c: Column, dtype: T.DataType) -> Column:
    """A typed Spark value -> a cell (what the writer stores, what the reader would see)."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                          T.DecimalType)):
        cell = struct_cell("n", num=c.cast("double"))
    elif isinstance(dtype, T.BooleanType):
        cell = struct_cell("b", num=F.when(c, 1.0).otherwise(0.0))
    elif isinstance(dtype, (T.DateType, T.TimestampNTZType)):
        cell = struct_cell("d", num=datetime_to_serial(c))
    else:
        cell = struct_cell("s", txt=c.cast("string"))
    return F.when(c.isNotNull(), cell)


def melt(df: DataFrame, columns: list[str], path: Column | str, row_idx: Column | str,
         hidden: Column | None = None) -> DataFrame:
    """Any table -> the sheet rows form: column j of ``columns`` becomes map key j."""
    types = dict(df.dtypes)
    schema = {f.name: f.dataType for f in df.schema.fields}
    pairs = []
    for j, name in enumerate(columns):
        pairs.append(F.lit(j))
        pairs.append(to_cell(F.col(name), schema[name]))
    cells = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()) if pairs else F.create_map()
    p = F.col(path) if isinstance(path, str) else path
    r = F.col(row_idx) if isinstance(row_idx, str) else row_idx
    del types
    return df.select(
        p.alias("path"),
        r.cast("int").alias("row_idx"),
        (hidden if hidden is not None else F.lit(False)).alias("hidden"),
        cells.cast(f"map<int,{CELL_STRUCT}>").alias("cells"),
    )
