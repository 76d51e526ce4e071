"""Numeric cell rules: 15-significant-digit rounding and whole-number narrowing."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import Column
from pyspark.sql import functions as F

from .types import BIT_DOUBLE, BIT_INT, BIT_LONG

_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1
_LONG_LIMIT = 2.0**63  # doubles in [-2**63, 2**63) fit a long


def round15_value(x: float) -> float:
    """Round the exact binary value of ``x`` to 15 significant digits, ties away from zero."""
    if x != x or x in (float("inf"), float("-inf")) or x == 0.0:
        return x
    # '%.14e' rounds the exact binary value correctly except at exact ties (it picks even).
    # A tie needs a 16th significant digit of 5; those few values go through decimal.
    if ("%.15e" % x).split("e")[0][-1] == "5":
        with localcontext() as ctx:
            ctx.prec = 15
            ctx.rounding = ROUND_HALF_UP
            return float(+Decimal(x))
    return float("%.14e" % x)


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once (and written once into the plan)."""
    return F.element_at(F.transform(F.array(value), use), 1)


# ---- C6 as Column expressions

_LEAST, _MOST = 1e-7, 1e15  # where x * 10**s needs no more than two doubles to be exact


def _high(v: Column) -> Column:
    """The upper half of a double's digits (Veltkamp's splitting)."""
    c = v * 134217729.0
    return c - (c - v)


def _round15_common(a: Column) -> Column:
    """``a`` in [1e-7, 1e15): scaled to 15 digits before the point as an exact sum of two doubles."""
    k = F.floor(F.log10(a))
    s = F.lit(14) - k + (a < F.pow(F.lit(10.0), k)).cast("long")
    b = F.pow(F.lit(10.0), s)  # exact, as s is in 0 .. 22
    p = a * b
    ah, bh = _high(a), _high(b)
    al, bl = a - ah, b - bh
    # the product's rounding error, exactly (Dekker)
    err = ((ah * bh - p) + ah * bl + al * bh) + al * bl
    whole = F.floor(p)
    up = (p - whole) - 0.5 >= -err
    # both numbers are exact, so the quotient is the double nearest to the rounded decimal
    return (whole + up.cast("long")).cast("double") / b


_LIMB = 10**9


def _div(a: Column, b) -> Column:
    """Whole quotient of longs, rounded down."""
    b = b if isinstance(b, Column) else F.lit(b)
    return F.call_function("div", a - F.pmod(a, b), b)


def _times(limbs: Column, factor: Column) -> Column:
    """A number in base 10**9, lowest limb first, times a factor below 2**31."""
    start = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("long").alias("carry"))

    def step(st: Column, limb: Column) -> Column:
        v = limb * factor + st["carry"]
        return F.struct(F.concat(st["out"], F.array(v % _LIMB)).alias("out"), _div(v, _LIMB).alias("carry"))

    return F.aggregate(limbs, start, step, lambda st: F.when(
        st["carry"] > 0, F.concat(st["out"], F.array(st["carry"]))).otherwise(st["out"]))


def _round15_any(a: Column) -> Column:
    """Any positive finite double: m * 2**q has the digits of the whole number m * 5**-q (q < 0) or
    m * 2**q, computed limb by limb; the 16th digit decides."""

    def parts(e: Column) -> Column:
        half = F.shiftright(F.lit(53) - e, 1)
        # powers of two: exact, in two steps within the range of doubles
        m = (a * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), F.lit(53) - e - half)).cast("long")
        return bind(F.struct(m.alias("m"), (e - 53).alias("q")), digits)

    def digits(v: Column) -> Column:
        m, q = v["m"], v["q"]
        base, chunk = F.when(q < 0, F.lit(5)).otherwise(F.lit(2)), F.when(q < 0, F.lit(12)).otherwise(F.lit(24))
        n = F.abs(q)
        limbs = F.array(m % _LIMB, _div(m, _LIMB) % _LIMB, _div(m, _LIMB * _LIMB))
        steps = F.filter(F.sequence(F.lit(0), (n / chunk).cast("int")), lambda i: i * chunk < n)
        grown = F.aggregate(steps, limbs, lambda acc, i: _times(acc, F.pow(base, F.least(chunk, n - i * chunk)).cast("long")))
        text = F.array_join(F.transform(F.reverse(grown), lambda x: F.lpad(x.cast("string"), 9, "0")), "")
        # digits * 10**point
        return bind(F.ltrim(text, F.lit("0")), lambda t: rounded(t, F.least(q, F.lit(0))))

    def rounded(t: Column, point: Column) -> Column:
        lead = F.substring(t, 1, 15).cast("long") + (F.substring(t, 16, 1) >= "5").cast("long")
        text = F.concat(lead.cast("string"), F.lit("E"), (F.length(t) - 15 + point).cast("string"))
        return F.when(F.length(t) > 15, text.cast("double"))

    return F.coalesce(bind(F.greatest(F.floor(F.log2(a)), F.lit(-1022)).cast("int"), parts), a)


def round15(x) -> Column:
    """The exact binary value rounded half up to 15 significant digits, as built-in functions only."""
    v = (F.col(x) if isinstance(x, str) else x).cast("double")
    a = F.abs(v)
    kept = F.isnan(v) | (a == float("inf")) | (a == 0) | ((a < _MOST) & (a == F.floor(a).cast("double")))
    rounded = F.when((a >= _LEAST) & (a < _MOST), _round15_common(a)).otherwise(_round15_any(a))
    return F.when(v.isNull() | kept, v).otherwise(F.when(v < 0, -rounded).otherwise(rounded))


def narrow_bit(x) -> Column:
    """Type bit of a numeric value: INT if whole and in int32, LONG if whole and in int64, else DOUBLE."""
    v = F.col(x) if isinstance(x, str) else x
    whole = (v == F.floor(v)) & ~F.isnan(v)
    return (
        F.when(v.isNull(), F.lit(0))
        .when(whole & (v >= _INT_MIN) & (v <= _INT_MAX), F.lit(BIT_INT))
        .when(whole & (v >= -_LONG_LIMIT) & (v < _LONG_LIMIT), F.lit(BIT_LONG))
        .otherwise(F.lit(BIT_DOUBLE))
    )


def narrow_type(x) -> Column:
    """C7 as a type name (INT / LONG / DOUBLE)."""
    b = narrow_bit(x)
    return (
        F.when(b == BIT_INT, F.lit("INT"))
        .when(b == BIT_LONG, F.lit("LONG"))
        .when(b == BIT_DOUBLE, F.lit("DOUBLE"))
    )
