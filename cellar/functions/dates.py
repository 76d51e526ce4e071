"""Serial date numbers <-> calendar values.

Rules of the 1900 date system: serial 1 is 1900-01-01 and the non-existent 1900-02-29 has
serial 60, so serials from 61 on count from 1899-12-30 and smaller ones from 1899-12-31.
The 1904 system counts from 1904-01-01. The fraction of a day is rounded half-up to the
millisecond. Negative serials (and ones past 9999-12-31) cannot be dated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .types import BIT_DATE, BIT_DATETIME, BIT_TIME

_DAY_MS = 86400000.0
_MAX_SERIAL_1900 = 2958465  # 9999-12-31


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _flag(date1904) -> Column:
    if isinstance(date1904, bool):
        return F.lit(date1904)
    return _col(date1904)


def serial_datable(x, date1904=False) -> Column:
    """Can this serial be shown as a date? (false -> the reader keeps the plain double)."""
    v = _col(x)
    return (v >= 0) & (v < F.lit(_MAX_SERIAL_1900 + 1) - F.when(_flag(date1904), 1462).otherwise(0))


def serial_to_datetime(x, date1904=False) -> Column:
    """Serial number -> TIMESTAMP_NTZ with millisecond precision; NULL when not datable.

    One ``timestampadd`` of whole microseconds to the base date (no time zone involved).
    """
    v = _col(x)
    whole = F.floor(v)
    ms = ((v - whole) * _DAY_MS + 0.5).cast("long")
    flag = _flag(date1904)
    # day offsets of the three bases from 1899-12-30: 1904-01-01 is +1462, 1899-12-31 is +1
    base_shift = F.when(flag, F.lit(1462)).when(whole < 61, F.lit(1)).otherwise(F.lit(0))
    micros = (whole.cast("long") + base_shift) * 86400000000 + ms * 1000
    ts = F.timestamp_add("MICROSECOND", micros, F.lit("1899-12-30 00:00:00").cast("timestamp_ntz"))
    return F.when(serial_datable(v, date1904), ts)


def datetime_to_serial(ts, date1904: bool = False) -> Column:
    """C8 inverse (write side): DATE / TIMESTAMP_NTZ -> serial number; before the base -> -1."""
    t = _col(ts).cast("timestamp_ntz")
    d = F.to_date(t)
    if date1904:
        days = F.datediff(d, F.lit("1904-01-01").cast("date"))
        ok = d >= F.lit("1904-01-01").cast("date")
    else:
        days = F.datediff(d, F.lit("1899-12-30").cast("date")) - F.when(
            d < F.lit("1900-03-01").cast("date"), 1
        ).otherwise(0)
        ok = d >= F.lit("1900-01-01").cast("date")
    sec = F.date_part(F.lit("SECOND"), t)  # decimal seconds with microseconds
    whole_sec = F.floor(sec)
    micros = ((sec - whole_sec) * 1000000).cast("long")
    frac = (
        ((F.hour(t) * 60.0 + F.minute(t)) * 60.0 + whole_sec.cast("double")) * 1000.0 + micros / 1000.0
    ) / _DAY_MS
    return F.when(t.isNull(), F.lit(None).cast("double")).when(ok, days.cast("double") + frac).otherwise(
        F.lit(-1.0)
    )


def datetime_kind(ts, date1904=False) -> Column:
    """Lattice bit of a dated serial: the base year -> TIME, midnight -> DATE, else DATETIME."""
    t = _col(ts)
    base_year = F.when(_flag(date1904), F.lit(1904)).otherwise(F.lit(1899))
    midnight = (F.hour(t) == 0) & (F.minute(t) == 0) & (F.date_part(F.lit("SECOND"), t) == 0)
    return (
        F.when(t.isNull(), F.lit(0))
        .when(F.year(t) == base_year, F.lit(BIT_TIME))
        .when(midnight, F.lit(BIT_DATE))
        .otherwise(F.lit(BIT_DATETIME))
    )


def legacy_time_as_datetime(t) -> Column:
    """A time-only value becomes 1900-01-01 plus the time."""
    v = _col(t).cast("string")
    return F.concat(F.lit("1900-01-01 "), v).cast("timestamp_ntz")


def render_datetime(ts) -> Column:
    """ISO text of a date-time as Java prints it: seconds and fraction only when non-zero."""
    t = _col(ts)
    sec = F.date_part(F.lit("SECOND"), t)
    micros = ((sec - F.floor(sec)) * 1000000).cast("long")
    base = F.date_format(t, "yyyy-MM-dd'T'HH:mm")
    return (
        F.when(t.isNull(), F.lit(None).cast("string"))
        .when(micros != 0, F.concat(base, F.date_format(t, ":ss"), _fraction(micros)))
        .when(F.floor(sec) != 0, F.concat(base, F.date_format(t, ":ss")))
        .otherwise(base)
    )


def _fraction(micros: Column) -> Column:
    return F.when(micros % 1000 == 0, F.format_string(".%03d", (micros / 1000).cast("long"))).otherwise(
        F.format_string(".%06d", micros)
    )


def render_time(ts) -> Column:
    """ISO text of a time of day (HH:mm[:ss[.fff]])."""
    t = _col(ts)
    sec = F.date_part(F.lit("SECOND"), t)
    micros = ((sec - F.floor(sec)) * 1000000).cast("long")
    base = F.date_format(t, "HH:mm")
    return (
        F.when(t.isNull(), F.lit(None).cast("string"))
        .when(micros != 0, F.concat(base, F.date_format(t, ":ss"), _fraction(micros)))
        .when(F.floor(sec) != 0, F.concat(base, F.date_format(t, ":ss")))
        .otherwise(base)
    )
