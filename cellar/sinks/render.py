"""Row XML rendered with Spark built-in expressions (JVM side, inside whole-stage codegen).

Only the finished ``<row>`` text leaves the JVM; Python tasks deflate and store it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import datetime_to_serial

# Cell style ids of the workbook we write (see sinks.parts.STYLES_XML).
STYLE_DATE = 1  # yyyy-mm-dd
STYLE_DATETIME = 2  # yyyy-mm-dd hh:mm:ss
STYLE_TIME = 3  # hh:mm:ss;@

_ILLEGAL_XML = r"[\x00-\x08\x0b\x0c\x0e-\x1f\uFFFE\uFFFF]"


class UnsupportedColumn(TypeError):
    pass


def xml_escape(s: Column) -> Column:
    s = F.replace(s, F.lit("&"), F.lit("&amp;"))
    s = F.replace(s, F.lit("<"), F.lit("&lt;"))
    s = F.replace(s, F.lit(">"), F.lit("&gt;"))
    # characters that XML can't hold are written as _xHHHH_; only texts with one take this way
    escaped = F.array_join(F.transform(F.split(s, ""), lambda c: F.when(c.rlike(_ILLEGAL_XML), F.concat(
        F.lit("_x"), F.lpad(F.hex(F.ascii(c)), 4, "0"), F.lit("_"))).otherwise(c)), "")
    return F.when(s.rlike(_ILLEGAL_XML), escaped).otherwise(s)


def xml_escape_py(s: str) -> str:
    import re

    s = s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")
    return re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]", lambda m: f"_x{ord(m.group()):04X}_", s)


# The most characters a cell can hold (text longer than this is refused).
MAX_CELL_TEXT = 32767


def text_cell(ref: Column, text: Column) -> Column:
    # literal "_xHHHH_" would read back as an escaped character: escape its underscore
    safe = F.regexp_replace(text, "_(x[0-9A-Fa-f]{4}_)", "_x005F_$1")
    cell = F.concat(F.lit('<c r="'), ref, F.lit('" t="inlineStr"><is><t xml:space="preserve">'), xml_escape(safe),
                    F.lit("</t></is></c>"))
    too_long = F.raise_error(F.concat(F.lit(f"Text longer than {MAX_CELL_TEXT} characters cannot be stored (cell "),
                                      ref, F.lit(")")))
    return F.when(F.length(text) > MAX_CELL_TEXT, too_long.cast("string")).otherwise(cell)


def cell_xml(c: Column, dtype: T.DataType, ref: Column, missing: str | None, name: str = "",
             styles: tuple[int, int, int] = (STYLE_DATE, STYLE_DATETIME, STYLE_TIME)) -> Column:
    """One cell by Spark type (first match wins); NULL -> missing pattern or no cell."""
    s_date, s_dt, s_time = styles
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)):
        body = F.concat(F.lit('<c r="'), ref, F.lit('"><v>'), c.cast("string"), F.lit("</v></c>"))
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        v = c.cast("double")
        num = F.concat(F.lit('<c r="'), ref, F.lit('"><v>'), v.cast("string"), F.lit("</v></c>"))
        # Neither infinity nor NaN can be stored
        body = F.when((F.abs(v) == F.lit(float("inf"))) | F.isnan(v), F.raise_error(
            F.lit(f"column {name}: a sheet holds finite numbers only"))).otherwise(num)
    elif isinstance(dtype, T.BooleanType):
        body = F.concat(F.lit('<c r="'), ref, F.lit('" t="b"><v>'), F.when(c, F.lit("1")).otherwise(F.lit("0")),
                        F.lit("</v></c>"))
    elif isinstance(dtype, T.DateType):
        body = F.concat(F.lit('<c r="'), ref, F.lit(f'" s="{s_date}"><v>'),
                        datetime_to_serial(c).cast("string"), F.lit("</v></c>"))
    elif isinstance(dtype, T.TimestampNTZType):
        body = F.concat(F.lit('<c r="'), ref, F.lit(f'" s="{s_dt}"><v>'),
                        datetime_to_serial(c).cast("string"), F.lit("</v></c>"))
    elif isinstance(dtype, T.TimestampType):
        # zoned date-time: written as text in the session time zone
        body = text_cell(ref, F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
    elif isinstance(dtype, T.StringType):
        body = text_cell(ref, c)
    elif isinstance(dtype, (T.DayTimeIntervalType, T.YearMonthIntervalType)):
        body = text_cell(ref, c.cast("string"))
    elif hasattr(T, "TimeType") and isinstance(dtype, T.TimeType):
        secs = F.date_part(F.lit("SECOND"), c)
        frac = ((F.hour(c) * 60.0 + F.minute(c)) * 60.0 + secs.cast("double")) / 86400.0
        body = F.concat(F.lit('<c r="'), ref, F.lit(f'" s="{s_time}"><v>'), frac.cast("string"),
                        F.lit("</v></c>"))
    else:
        raise UnsupportedColumn(f"Column '{name}' has the unsupported type {dtype.simpleString()}")
    empty = text_cell(ref, F.lit(missing)) if missing is not None else F.lit("")
    return F.when(c.isNull(), empty).otherwise(body)


def check_types(schema: T.StructType, shown: dict[str, str] | None = None) -> None:
    """``shown``: names for messages, where columns go by other names."""
    for f in schema.fields:
        cell_xml(F.col(f"`{f.name}`"), f.dataType, F.lit("A1"), None, (shown or {}).get(f.name, f.name))


def row_xml(schema: T.StructType, row0: Column, missing: str | None, row_key: str | None = None,
            styles: tuple[int, int, int] = (STYLE_DATE, STYLE_DATETIME, STYLE_TIME),
            shown: dict[str, str] | None = None) -> Column:
    """``<row r="n">`` + cells; ``row0`` is the 0-based sheet row."""
    from ..sources.excel import col_label_py

    rn = (row0 + 1).cast("string")
    parts = [F.lit('<row r="'), rn, F.lit('">')]
    j = 0
    fields = list(schema.fields)
    if row_key is not None:
        fields = [f for f in fields if f.name == row_key] + [f for f in fields if f.name != row_key]
    for f in fields:
        ref = F.concat(F.lit(col_label_py(j)), rn)
        parts.append(cell_xml(F.col(f"`{f.name}`"), f.dataType, ref, missing, (shown or {}).get(f.name, f.name), styles))
        j += 1
    parts.append(F.lit("</row>"))
    return F.concat(*parts)


def header_xml(names: list[str], row0: int) -> str:
    from ..sources.excel import col_label_py

    rn = row0 + 1
    cells = "".join(
        f'<c r="{col_label_py(j)}{rn}" t="inlineStr"><is><t xml:space="preserve">{xml_escape_py(n)}</t></is></c>'
        for j, n in enumerate(names)
    )
    return f'<row r="{rn}">{cells}</row>'
