"""Workbook writer: round trips per type, sheet split by capacity, checks."""

import datetime as dt
import os
import re
import zipfile

import pytest
from pyspark.sql import functions as F

import xlsxbuild as X
from cellar import list_sheets, read_excel, write_excel, write_excel_by_key
from cellar.sinks.excel import sheets_needed


def _sample(spark):
    rows = [(1, 2**40, 1.5, True, "a & <b>", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 6, 30, 15, 250000), None),
            (2, -3, -0.25, False, "  spaced ", dt.date(1900, 3, 1), dt.datetime(1999, 12, 31, 23, 59, 59), "x"),
            (3, 0, 1e-7, None, None, None, None, "y")]
    return spark.createDataFrame(rows, "i int, l long, d double, b boolean, s string, dd date, ts timestamp_ntz, "
                                       "m string")


def test_roundtrip_types(spark, tmp):
    df = _sample(spark)
    p = os.path.join(tmp, "types.xlsx")
    rep = write_excel({"data": df}, p, order_by=["i"]).collect()[0]
    assert rep["rows"] == 3 and rep["sheets"] == 1
    with zipfile.ZipFile(p) as z:
        assert z.testzip() is None
        assert "docProps/core.xml" not in z.namelist()  # N13: no author metadata
    back = read_excel(spark, p)
    assert dict(back.dtypes) == {"i": "int", "l": "bigint", "d": "double", "b": "boolean", "s": "string",
                                 "dd": "date", "ts": "timestamp_ntz", "m": "string"}
    got = [tuple(r) for r in back.collect()]
    assert got[0] == (1, 2**40, 1.5, True, "a & <b>", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 6, 30, 15, 250000),
                      None)
    assert got[1][4] == "  spaced " and got[2][2] == 1e-7 and got[2][3] is None


def test_missing_pattern_and_row_key(spark, tmp):
    df = _sample(spark)
    p = os.path.join(tmp, "missing.xlsx")
    write_excel({"data": df}, p, order_by=["i"], missing="?", row_key="m")
    back = read_excel(spark, p)
    assert back.columns[0] == "RowID"
    assert [r["RowID"] for r in back.collect()] == ["?", "x", "y"]
    assert back.collect()[2]["s"] == "?"


def test_split_over_sheets_with_header_each(spark, tmp):
    df = spark.range(0, 25).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    p = os.path.join(tmp, "split.xlsx")
    rep = write_excel({"nums": df}, p, order_by=["k"], max_rows=10).collect()[0]
    assert rep["sheets"] == sheets_needed(25, True, 10) == 3
    names = [r["Sheet"] for r in list_sheets(spark, p).orderBy("sheet_pos").collect()]
    assert names == ["nums", "nums (1)", "nums (2)"]
    parts = [read_excel(spark, p, sheet=i).collect() for i in range(3)]
    assert [len(x) for x in parts] == [9, 9, 7]
    assert [r["k"] for x in parts for r in x] == list(range(25))


def test_headerless_exact_multiple(spark, tmp):
    df = spark.range(0, 20).select(F.col("id").alias("k"))
    p = os.path.join(tmp, "exact.xlsx")
    rep = write_excel({"t": df}, p, order_by=["k"], header=False, max_rows=10).collect()[0]
    assert rep["sheets"] == 2  # Q6: the writer's rule, no empty third sheet


def test_checks(spark, tmp):
    emb = spark.createDataFrame([(1, [1.0, 2.0])], "id int, v array<float>")
    with pytest.raises(TypeError):
        write_excel({"e": emb}, os.path.join(tmp, "e.xlsx"))
    inf = spark.createDataFrame([(float("inf"),)], "x double")
    with pytest.raises(Exception, match="finite numbers"):
        write_excel({"i": inf}, os.path.join(tmp, "i.xlsx")).collect()
    with pytest.raises(ValueError):
        write_excel({"bad/name": _sample(spark)}, os.path.join(tmp, "b.xlsx"))
    with pytest.raises(Exception, match="continuation sheet"):
        write_excel({"a" * 29: spark.range(30).select("id")}, os.path.join(tmp, "c.xlsx"), order_by=["id"],
                    max_rows=10)


def test_folder_and_number_checks(spark, tmp):
    one = spark.range(1).select("id")
    with pytest.raises(FileNotFoundError):
        write_excel({"s": one}, os.path.join(tmp, "no", "x.xlsx"), create_folders=False)
    nan = spark.createDataFrame([(float("nan"),)], "x double")
    with pytest.raises(Exception, match="finite numbers"):
        write_excel({"s": nan}, os.path.join(tmp, "n.xlsx"))
    # control characters come back as they went in
    p = os.path.join(tmp, "control.xlsx")
    odd = spark.createDataFrame([("a\x01b_x0041_c",)], "x string")
    write_excel({"s": odd}, p, paper="envelope_c5")
    assert [r["x"] for r in read_excel(spark, p).collect()] == ["a\x01b_x0041_c"]


def test_files_with_other_columns_at_one_position(spark, tmp):
    write_excel({"s": spark.createDataFrame([(1, 11)], "a int, b int")}, os.path.join(tmp, "f1.xlsx"))
    write_excel({"s": spark.createDataFrame([(2, 22)], "a int, c int")}, os.path.join(tmp, "f2.xlsx"))
    rows = sorted(tuple(r) for r in read_excel(spark, tmp).select("a", "b", "c").collect())
    assert rows == [(1, 11, None), (2, None, 22)]


def test_unordered_rows_and_hot_key(spark, tmp):
    from cellar.operators.ordinal import stable_partitions, with_ordinals

    p = os.path.join(tmp, "u.xlsx")
    write_excel({"s": spark.range(0, 40, 1, 4)}, p)
    assert sorted(r["id"] for r in read_excel(spark, p).collect()) == list(range(40))
    hot = spark.range(4000).select(F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"), "id")
    staged = stable_partitions(hot, ["k"], partitions=8)
    got = with_ordinals(staged, "n").collect()
    assert sorted(r["n"] for r in got) == list(range(4000))
    # NULL keys come first, and the hot one spans several buckets
    assert {r["n"] for r in got if r["k"] is None} == set(range(3600))
    assert staged.where("k IS NULL").select(F.spark_partition_id()).distinct().count() > 1


def test_many_tables_one_workbook_and_by_key(spark, tmp):
    a = spark.range(5).select(F.col("id").alias("x"))
    b = spark.range(3).select(F.col("id").alias("y"))
    p = os.path.join(tmp, "two.xlsx")
    write_excel({"A": a, "B": b}, p, order_by={"A": ["x"], "B": ["y"]})
    assert read_excel(spark, p, sheet="B").count() == 3
    folder = os.path.join(tmp, "bykey")
    df = spark.range(100).select((F.col("id") % 4).alias("g"), F.col("id"))
    rep = write_excel_by_key(df, "g", folder, order_by=["id"]).collect()
    assert sorted(r["rows"] for r in rep) == [25, 25, 25, 25]
    back = read_excel(spark, folder, path_column="Path")
    assert back.count() == 100 and back.columns == ["id", "Path"]


def test_autosize_and_page_setup(spark, tmp):
    df = spark.createDataFrame([("short",), ("a much longer value",)], "txt string")
    p = os.path.join(tmp, "auto.xlsx")
    write_excel({"s": df}, p, autosize=True, orientation="landscape", paper="a4")
    with zipfile.ZipFile(p) as z:
        xml = z.read("xl/worksheets/sheet1.xml").decode()
    assert '<col min="1" max="1" width="21.00"' in xml and 'orientation="landscape"' in xml and 'paperSize="9"' in xml


def test_write_into_existing_workbook(spark, tmp):
    p = os.path.join(tmp, "book.xlsx")
    first = spark.range(0, 8).select(F.col("id").alias("k"))
    write_excel({"data": first, "other": spark.range(2).select(F.col("id").alias("z"))}, p, order_by=["id"]
                if False else {"data": ["k"], "other": ["z"]}, max_rows=10)
    with pytest.raises(FileExistsError):
        write_excel({"x": first}, p, mode="errorifexists")
    with pytest.raises(ValueError):
        write_excel({"data": first}, p, mode="append", sheet_exists="fail")
    more = spark.range(8, 20).select(F.col("id").alias("k"))
    write_excel({"data": more, "fresh": spark.range(3).select(F.col("id").alias("q"))}, p,
                order_by={"data": ["k"], "fresh": ["q"]}, mode="append", sheet_exists="append", max_rows=10)
    names = [r["Sheet"] for r in list_sheets(spark, p).orderBy("sheet_pos").collect()]
    assert names == ["data", "other", "data (1)", "data (2)", "fresh"]
    # the first sheet had rows 1..8 (header at 0): one more row fits, then continuation sheets
    got = [r["k"] for i in (0, 2, 3) for r in read_excel(spark, p, sheet=i).collect()]
    assert got == list(range(20))
    assert read_excel(spark, p, sheet="fresh").count() == 3
    write_excel({"other": spark.range(5).select(F.col("id").alias("w"))}, p, order_by=["w"], mode="append",
                sheet_exists="overwrite")
    assert read_excel(spark, p, sheet="other").columns == ["w"]
    with zipfile.ZipFile(p) as z:
        assert z.testzip() is None


def test_update_workbook_cells(spark, tmp):
    from cellar import update_workbook

    src = os.path.join(tmp, "base.xlsx")
    write_excel({"Sheet1": spark.range(0, 10).select(F.col("id").alias("n"), F.lit("t").alias("txt"))}, src,
                order_by=["n"])
    # the sample of the updater's documentation: text, a number by col:row, and an all-missing row
    patches = spark.createDataFrame([("A5", "Ok", None), ("5:96", None, 50), ("B3", None, None)],
                                    "Address string, String string, Integer int")
    out = os.path.join(tmp, "updated.xlsx")
    update_workbook(spark, src, patches, out)
    back = read_excel(spark, out, header_row=None, skip_empty_rows=False).collect()
    assert back[4]["A"] == "Ok"          # A5 replaced (was 3)
    assert back[2]["B"] is None          # B3 cleared
    assert back[95]["E"] == 50           # E96 created
    assert back[1]["A"] == "0" and back[1]["B"] == "t"


def test_text_limit_and_escapes(spark, tmp):
    ok = spark.createDataFrame([(1, "a_x0041_b & <c>\nline2  "), (2, "x" * 32767)], "k int, t string")
    p = os.path.join(tmp, "text.xlsx")
    write_excel({"t": ok}, p, order_by=["k"])
    back = [r["t"] for r in read_excel(spark, p).collect()]
    assert back == ["a_x0041_b & <c>\nline2  ", "x" * 32767]
    big = spark.createDataFrame([(1, "y" * 32768)], "k int, t string")
    with pytest.raises(Exception, match="32767"):
        write_excel({"t": big}, os.path.join(tmp, "big.xlsx"), order_by=["k"])


def test_same_sheet_name_tables_merged(spark, tmp):
    a = spark.range(0, 3).select(F.col("id").alias("v"))
    b = spark.range(10, 12).select(F.col("id").alias("v"))
    p = os.path.join(tmp, "merged.xlsx")
    write_excel([("s", a), ("s", b)], p, order_by=["v"], sheet_exists="append")
    assert [r["v"] for r in read_excel(spark, p).collect()] == [0, 1, 2, 10, 11]
    with pytest.raises(ValueError):
        write_excel([("s", a), ("s", b)], os.path.join(tmp, "dup.xlsx"))


def test_key_file_names_never_collide():
    from cellar.sinks.excel import _file_for

    names = [_file_for(k) for k in ["a/b", "a_b", "a b", "", ".hidden", "Plain"]]
    assert len(set(names)) == len(names) and names[-1] == "Plain.xlsx"


def test_columns_named_like_the_writers_own(spark, tmp):
    names = ["__n", "__b", "__tie", "__tno", "__pid", "__mono", "__row", "__sheet", "__xml", "__wb", "c0", "C1", "a`b", "x.y"]
    df = spark.range(0, 30, 1, 3).select(*[(F.col("id") * (j + 1)).alias(n) for j, n in enumerate(names)])
    want = sorted(tuple(i * (j + 1) for j in range(len(names))) for i in range(30))
    p = os.path.join(tmp, "names.xlsx")
    write_excel([("s", df.where("`__n` < 10")), ("s", df.where("`__n` >= 10"))], p, order_by=["__N"], sheet_exists="append")
    back = read_excel(spark, p)
    assert back.columns == names and sorted(map(tuple, back.collect())) == want
    back = read_excel(spark, p, row_id="generated")
    assert sorted(tuple(r)[1:] for r in back.collect()) == want
    write_excel_by_key(df.withColumn("__k", F.col("`__n`") % 2), "__k", tmp + "/keys", order_by=["__n"])
    back = read_excel(spark, tmp + "/keys")
    assert sorted(map(tuple, back.collect())) == want


def test_update_in_place_keeps_styles_and_parts(spark, tmp):
    from cellar import update_workbook

    rows = ['<row r="1" spans="1:3">' + X.num("A1", 1, 4) + X.text("B1", "keep") + "</row>",
            '<row r="2" s="3" customFormat="1" ht="20">' + X.num("A2", 2) + '<c r="B2" s="2"/><c r="D2" t="s"><v>0</v></c></row>',
            '<row r="4"><c r="A4"><f>A1+1</f><v>2</v></c></row>', '<row r="6"/>']
    xml = X.sheet_xml(rows).replace("<sheetData>", '<dimension ref="A1:D4"/><cols><col min="1" max="2" style="1"/>'
                                    '<col min="3" max="9" width="4"/><col min="5" max="16384" style="2"/></cols><sheetData>')
    xml = xml.replace("</sheetData>", '</sheetData><mergeCells count="1"><mergeCell ref="F1:G1"/></mergeCells>')
    p = X.build(os.path.join(tmp, "u.xlsx"), [("s", xml), ("t", X.sheet_xml([X.row(1, X.text("A1", "other"))]))], strings=["shared"])
    with zipfile.ZipFile(p, "a", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/media/image1.png", bytes(range(256)) * 40)
        z.writestr("xl/calcChain.xml", "<calcChain/>")
        z.writestr("docProps/app.xml", "<x/>", zipfile.ZIP_STORED)
    with zipfile.ZipFile(p) as z:
        before = {n: z.read(n) for n in z.namelist()}
    patches = spark.createDataFrame(
        [("A1", 10.0, None, None), ("B1", None, "new <b> & _x0041_", None), ("B2", 5.0, None, None), ("C2", 6.0, None, None),
         ("A3", 7.0, None, None), ("C3", 8.0, None, None), ("K3", 9.0, None, None), ("D2", None, None, None), ("A6", None, None, True),
         ("C9", None, None, False)], "a string, n double, t string, b boolean")
    update_workbook(spark, p, patches)
    with zipfile.ZipFile(p) as z:
        assert z.testzip() is None
        after = {n: z.read(n) for n in z.namelist()}
    assert set(before) - set(after) == {"xl/calcChain.xml"}
    assert all(after[n] == before[n] for n in after if n not in ("xl/worksheets/sheet1.xml", "xl/styles.xml"))
    got = after["xl/worksheets/sheet1.xml"].decode()
    cells = dict(re.findall(r'<c r="([A-Z]+[0-9]+)"((?: [a-z]+="[^"]*")*)', got))
    assert {k: re.findall(r's="([0-9]+)"', v) for k, v in cells.items()} == {
        "A1": ["4"], "B1": [], "A2": [], "B2": ["2"], "C2": ["3"], "A3": ["1"], "C3": [], "K3": ["2"], "A4": [], "A6": ["1"], "C9": []}
    assert "<f>A1+1</f>" in got and '<row r="2" s="3" customFormat="1" ht="20">' in got and "mergeCells" in got
    assert "dimension" not in got and '<col min="1" max="2" style="1"/>' in got
    back = read_excel(spark, p, header_row=None, skip_empty_rows=False, use15=False).collect()
    assert (back[0]["B"], back[5]["A"], back[8]["C"]) == ("new <b> & _x0041_", "true", "false")
    # a second update into a new file, of the other sheet, with a date
    out = os.path.join(tmp, "v.xlsx")
    update_workbook(spark, p, spark.createDataFrame([("t", "B1", dt.date(2024, 2, 29))], "sheet string, a string, d date"), out)
    (row,) = read_excel(spark, out, sheet="t", header_row=None).collect()
    assert tuple(row) == ("other", dt.date(2024, 2, 29))
    with zipfile.ZipFile(out) as z:
        assert z.read("xl/worksheets/sheet1.xml").decode() == got


def test_updates_of_prefixed_and_unnumbered_rows(spark, tmp):
    from cellar import update_workbook
    from cellar.sinks import update

    xml = ('<x:worksheet xmlns:x="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><x:sheetData>'
           + "".join(f"<x:row><x:c><x:v>{i}</x:v></x:c><x:c><x:v>{-i}</x:v></x:c></x:row>" for i in range(50))
           + "</x:sheetData></x:worksheet>")
    p = X.build(os.path.join(tmp, "x.xlsx"), [("s", xml), ("e", X.sheet_xml([]).replace("<sheetData></sheetData>", "<sheetData/>"))])
    split = update.RAW_SPLIT
    update.RAW_SPLIT = 500
    try:
        update_workbook(spark, p, spark.createDataFrame([("s", "B3", 77), ("e", "C2", 78)], "sheet string, a string, n int"))
    finally:
        update.RAW_SPLIT = split
    back = read_excel(spark, p, header_row=None).collect()
    assert [tuple(r) for r in back] == [(i, 77 if i == 2 else -i) for i in range(50)]
    assert [tuple(r) for r in read_excel(spark, p, sheet="e", header_row=None).collect()] == [(None, None, 78)]


def test_texts_longer_than_a_cell_go_through_a_workbook(spark, tmp):
    from cellar.operators import longtext as X

    long = "ab_x0041_<&>" * 6000 + " " * 40000 + "end\n"
    rows = [(1, "u", long), (1, "u", long), (None, "v", "short"), (2, None, None), (3, "w" * 32768, "x" * 32767), (4, "z", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    cut = X.continued(df, ["url", "html"], "row", "part", "parts", ["page_id"])
    write_excel({"p": cut}, f"{tmp}/p.xlsx", order_by=["row", "part"])
    back = X.whole(read_excel(spark, f"{tmp}/p.xlsx", blank_to_missing=False), ["url", "html"], "row", "part", "parts")
    got = [(r["page_id"], r["url"], r["html"]) for r in back.collect()]
    assert sorted(got, key=repr) == sorted(rows, key=repr)
