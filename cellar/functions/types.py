"""Cell type tags and the widening lattice bits.

A column's type is the lowest lattice node accepting every non-missing scanned cell:

    STRING -- DOUBLE -- LONG -- INT
           |- BOOLEAN
           |- DATETIME -- DATE
           `- TIME
"""

from __future__ import annotations

from pyspark.sql import types as T

# One bit per cell type.
BIT_INT = 1
BIT_LONG = 2
BIT_DOUBLE = 4
BIT_BOOLEAN = 8
BIT_DATE = 16
BIT_DATETIME = 32
BIT_TIME = 64
BIT_STRING = 128

TYPE_NAMES = {
    BIT_INT: "INT",
    BIT_LONG: "LONG",
    BIT_DOUBLE: "DOUBLE",
    BIT_BOOLEAN: "BOOLEAN",
    BIT_DATE: "DATE",
    BIT_DATETIME: "DATETIME",
    BIT_TIME: "TIME",
    BIT_STRING: "STRING",
}

SPARK_TYPES = {
    "INT": T.IntegerType(),
    "LONG": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIME": T.TimeType(6) if hasattr(T, "TimeType") else T.StringType(),
    "STRING": T.StringType(),
}

def time_enabled() -> bool:
    """TIME columns need ``spark.sql.timeType.enabled``; without it times are read as text."""
    from pyspark.sql import SparkSession

    s = SparkSession.getActiveSession()
    return bool(s is not None and hasattr(T, "TimeType")
                and str(s.conf.get("spark.sql.timeType.enabled", "false")).lower() == "true")


def spark_type(name: str) -> T.DataType:
    if name == "TIME":
        return T.TimeType(6) if time_enabled() else T.StringType()
    return SPARK_TYPES[name]


# cell kinds emitted by the sheet scan (see sources/ooxml.py)
KIND_NUMBER = "n"  # plain number (already rounded to 15 digits when asked)
KIND_DATE = "d"  # number with a date/time display format: a serial date
KIND_BOOL = "b"  # boolean (n = 1.0 / 0.0)
KIND_TEXT = "s"  # text, shared or inline, or a formula's text result
KIND_ERROR = "e"  # error value such as #DIV/0!

CELL_STRUCT = "struct<k:string,n:double,s:string>"
CELLS_MAP = f"map<int,{CELL_STRUCT}>"
