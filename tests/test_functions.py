"""Scalar functions against hand-computed values and brute force."""

import datetime as dt
import math
import random
import struct
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from cellar import functions as CF
from cellar.functions.numbers import round15_value


def test_col_label_pairs_and_roundtrip(spark):
    # 1-based pairs of the reference tests: 1<->A, 26<->Z, 27<->AA, 28<->AB, 52<->AZ, 53<->BA
    df = spark.range(0, 16384).select(F.col("id"), CF.col_label("id").alias("lab"))
    rows = df.select("id", "lab", CF.col_index("lab").alias("back")).collect()
    assert all(r["back"] == r["id"] for r in rows)
    by_id = {r["id"]: r["lab"] for r in rows}
    assert [by_id[i - 1] for i in (1, 26, 27, 28, 52, 53)] == ["A", "Z", "AA", "AB", "AZ", "BA"]
    assert by_id[16383] == "XFD"


def test_col_index_rules(spark):
    df = spark.createDataFrame([("",), ("A",), ("AA",)], "s string")
    assert [r[0] for r in df.select(CF.col_index("s")).collect()] == [-1, 0, 26]
    bad = spark.createDataFrame([("a1",)], "s string")
    with pytest.raises(Exception):
        bad.select(CF.col_index("s")).collect()


def test_parse_address(spark):
    df = spark.createDataFrame([("A5",), ("5:96",), ("OZ23914",), ("$B$7",)], "a string")
    got = [(r["p"]["row"], r["p"]["col"]) for r in df.select(CF.parse_address("a").alias("p")).collect()]
    assert got == [(4, 0), (95, 4), (23913, 415), (6, 1)]
    with pytest.raises(Exception):
        spark.createDataFrame([("0:1",)], "a string").select(CF.parse_address("a")).collect()
    with pytest.raises(Exception):
        spark.createDataFrame([("hello",)], "a string").select(CF.parse_address("a")).collect()


def test_parse_col_row(spark):
    df = spark.createDataFrame([("C", "3"), ("", ""), ("27", "1")], "c string, r string")
    got = df.select(CF.parse_col("c").alias("c"), CF.parse_row("r").alias("r")).collect()
    assert [(x["c"], x["r"]) for x in got] == [(2, 2), (0, 0), (26, 0)]


def _round15_decimal(x):
    with localcontext() as ctx:
        ctx.prec = 15
        ctx.rounding = ROUND_HALF_UP
        return float(+Decimal(x))


def test_round15_matches_decimal_half_up(spark):
    rnd = random.Random(7)
    vals = [rnd.uniform(1e-5, 1e12) * rnd.choice([1, -1]) for _ in range(3000)]
    vals += [1234567890123.125, 0.1 + 0.2, 2.675, 1e15 + 2, 123.0]
    for v in vals:
        assert round15_value(v) == _round15_decimal(v)
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(CF.round15("x")).collect()]
    assert got == [_round15_decimal(v) for v in vals]


def test_narrow_type(spark):
    df = spark.createDataFrame([(1.0,), (2.0**31,), (1.5,), (1e19,)], "x double")
    assert [r[0] for r in df.select(CF.narrow_type("x")).collect()] == ["INT", "LONG", "DOUBLE", "DOUBLE"]


def test_serial_dates_1900_rules(spark):
    df = spark.createDataFrame([(1.0,), (59.0,), (61.0,), (0.5,), (-1.0,), (45292.75,)], "x double")
    got = [r[0] for r in df.select(CF.serial_to_datetime("x")).collect()]
    assert got == [dt.datetime(1900, 1, 1), dt.datetime(1900, 2, 28), dt.datetime(1900, 3, 1),
                   dt.datetime(1899, 12, 31, 12), None, dt.datetime(2024, 1, 1, 18)]
    kinds = [r[0] for r in df.select(CF.datetime_kind(CF.serial_to_datetime("x"))).collect()]
    assert kinds == [16, 16, 16, 64, 0, 32]


def test_serial_dates_1904_and_inverse(spark):
    df = spark.createDataFrame([(0.0,), (366.0,)], "x double")
    got = [r[0] for r in df.select(CF.serial_to_datetime("x", True)).collect()]
    assert got == [dt.datetime(1904, 1, 1), dt.datetime(1905, 1, 1)]
    ts = spark.createDataFrame([(dt.datetime(2020, 2, 29, 13, 5, 7, 250000),), (dt.datetime(1900, 1, 1),)],
                               "t timestamp_ntz")
    back = ts.select(CF.serial_to_datetime(CF.datetime_to_serial("t")).alias("b"), "t").collect()
    assert all(r["b"] == r["t"] for r in back)


def test_sheet_name_rules(spark):
    names = ["ok", "", "a" * 32, "bad/name", "fine name"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(CF.valid_sheet_name("n")).collect()] == [True, False, False, False, True]
    leg = spark.createDataFrame([("a" * 30,), ('x:y*"z"',)], "n string").select(CF.legacy_sheet_name("n")).collect()
    assert leg[0][0] == "a" * 22 + "..." and leg[1][0] == "x_y__z_"
    cont = spark.createDataFrame([("Sheet", 1), ("s" * 28, 10)], "n string, i int").select(
        CF.continuation_sheet_name("n", "i")).collect()
    assert cont[0][0] == "Sheet (1)" and cont[1][0] is None


def test_unique_names():
    assert CF.unique_names(["Hello", "Hello", "Hello", "World"]) == ["Hello", "Hello_2", "Hello_3", "World"]


def test_blank_and_extension(spark):
    df = spark.createDataFrame([(" \t\n",), ("x",), ("/a/b/File.XLSX",)], "s string")
    assert [r[0] for r in df.select(CF.is_blank("s")).collect()] == [True, False, False]
    assert df.select(CF.path_extension("s")).collect()[2][0] == "xlsx"


def test_legacy_value_rules(spark):
    df = spark.createDataFrame([("N/A", "12", "10:30:00"), ("x", "zz", None)], "a string, b string, t string")
    got = df.select(CF.nullif_pattern("a", "N/A").alias("a"), CF.lenient("b", "int").alias("b"),
                    CF.legacy_time_as_datetime("t").alias("t")).collect()
    assert (got[0]["a"], got[0]["b"], got[0]["t"]) == (None, 12, dt.datetime(1900, 1, 1, 10, 30))
    assert (got[1]["a"], got[1]["b"], got[1]["t"]) == ("x", None, None)


def test_round15_over_all_doubles(spark):
    rnd = random.Random(3)
    vals = [struct.unpack("<d", struct.pack("<Q", rnd.getrandbits(64)))[0] for _ in range(60)]
    vals += [rnd.choice([1, -1]) * rnd.random() * 10.0 ** rnd.randint(-9, 17) for _ in range(3000)]
    for k in range(-8, 17):
        lo = hi = 10.0**k
        for _ in range(5):
            vals += [lo, hi]
            lo, hi = math.nextafter(lo, 0), math.nextafter(hi, math.inf)
    # exact ties
    vals += [(rnd.randint(10**14, 10**15 - 1) + 0.5) / 2 ** rnd.randint(0, 20) for _ in range(500)]
    vals += [5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, 0.0, -0.0, 999999999999999.9, 1e22, 1e23]
    vals = [v for v in vals if math.isfinite(v)]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,), (math.inf,)], "x double")
    out = df.select(CF.round15("x"))
    assert [r[0] for r in out.collect()] == [_round15_decimal(v) for v in vals] + [None, math.inf]
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_number_text(spark):
    cases = [("0", 2.5, "3"), ("0", -2.5, "-3"), ("0.00", 2.675, "2.68"), ("0.00", 1.005, "1.01"), ("#,##0", 1234567.4, "1,234,567"),
             ("#,##0.00", 999.995, "1,000.00"), ("0%", 0.125, "13%"), ("0.0#%", 0.12345, "12.35%"), ("0.00E+00", 12345.0, "1.23E+04"),
             ("0.00E+00", 0.000999999, "1.00E-03"), ("0.0E-0", 12345.0, "1.2E4"), ("0.00E+00", 0.0, "0.00E+00"), ("#.##", 0.5, ".5"),
             ("#.##", 3.0, "3"), ("0;(0)", -7.0, "(7)"), ('0;-0;"nil"', 0.0, "nil"), ('"a;b"0', 4.0, "a;b4"), ("\\#0", 4.0, "#4"),
             ("[Red]0.0", 1.25, "1.3"), ("[$€-407]#,##0", 1500.0, "€1,500"), ("0.0,,", 12345678.0, "12.3"), ("00000", 42.0, "00042"),
             ("General", 42.0, "42"), ("General", 1.5, "1.5"), ("# ?/?", 1.5, "1.5"), ("[<10]0;0.0", 3.25, "3.25"), ("##0.0E+0", 5.0, "5"),
             ("0_)", 3.0, "3 "), ("0*x", 3.0, "3"), ("@", 3.0, "3"), ("0.00", 1e18, "1000000000000000000"), ("0", None, None),
             ("0.0", -0.04, "-0.0"), ("", 7.0, "7"), ('"only text"', 7.0, "only text"), ("0.000", 0.1 + 0.2, "0.300")]
    df = spark.createDataFrame([(i, c, x) for i, (c, x, _) in enumerate(cases)], "i int, code string, x double")
    got = {r["i"]: r["t"] for r in df.select("i", CF.displayed(F.col("x"), F.col("code"), sorted({c for c, *_ in cases})).alias("t")).collect()}
    assert [(c, x, got[i]) for i, (c, x, _) in enumerate(cases)] == cases
