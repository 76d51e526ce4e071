"""Workbook reader on hand-made fixtures (FIXTURES.md section 3)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import xlsxbuild as X
from cellar import inventory, list_files, list_sheets, read_excel, sheets_table
from cellar.sources.excel import ReadOptions, select_first_sheet


def _types_book(path):
    rows = [X.row(1, *[X.text(f"{c}1", n) for c, n in zip(
        "ABCDEFGHIJK", ["int", "int_long", "int_double", "bool", "date", "date_dt", "time", "date_int", "empty",
                        "err_int", "boolfmt"])])]
    data = [
        (X.num("A{}", 1), X.num("B{}", 5), X.num("C{}", 2), X.boolean("D{}", True), X.num("E{}", 45292, X.DATE),
         X.num("F{}", 45292, X.DATE), X.num("G{}", 0.25, X.TIME), X.num("H{}", 45292, X.DATE), X.text("I{}", "  "),
         X.error("J{}"), X.num("K{}", 1, X.BOOLFMT)),
        (X.num("A{}", 2), X.num("B{}", 2**40), X.num("C{}", 2.5), X.boolean("D{}", False), X.num("E{}", 45293, X.DATE),
         X.num("F{}", 45293.5, X.DATETIME), X.num("G{}", 0.5, X.TIME), X.num("H{}", 7), X.text("I{}", ""),
         X.num("J{}", 3), X.num("K{}", 0, X.BOOLFMT)),
    ]
    for i, cells in enumerate(data):
        r = i + 2
        rows.append(X.row(r, *[c.replace("{}", str(r)) for c in cells]))
    return X.build(path, [("types", X.sheet_xml(rows))])


def test_type_inference_lattice(spark, tmp):
    p = _types_book(os.path.join(tmp, "types.xlsx"))
    df = read_excel(spark, p)
    types = dict(df.dtypes)
    assert types == {"int": "int", "int_long": "bigint", "int_double": "double", "bool": "boolean",
                     "date": "date", "date_dt": "timestamp_ntz", "time": "time(6)", "date_int": "string",
                     "empty": "string", "err_int": "string", "boolfmt": "boolean"}
    rows = df.collect()
    assert rows[0]["int_long"] == 5 and rows[1]["int_long"] == 2**40
    assert rows[0]["date"] == dt.date(2024, 1, 1)
    assert rows[0]["time"] == dt.time(6, 0) and rows[1]["time"] == dt.time(12, 0)
    assert rows[1]["date_dt"] == dt.datetime(2024, 1, 2, 12)
    assert rows[0]["date_int"] == "2024-01-01" and rows[1]["date_int"] == "7"
    assert rows[0]["err_int"] == "#XL_EVAL_ERROR#" and rows[1]["err_int"] == "3"
    assert rows[0]["empty"] is None
    assert [r["boolfmt"] for r in rows] == [True, False]
    # error cells as missing
    df2 = read_excel(spark, p, error_pattern=None)
    assert dict(df2.dtypes)["err_int"] == "int"


def _sparse_book(path):
    rows = [X.row(1, X.text("A1", "a"), X.text("D1", "d")),
            X.row(3, X.num("A3", 1), X.styled_empty("B3"), X.num("D3", 4)),
            X.row(5, X.styled_empty("A5")),
            X.row(7, '<c t="inlineStr"><is><t>x</t></is></c>', X.num("D7", 9))]
    return X.build(path, [("s", X.sheet_xml(rows))])


def test_sparse_rows_and_columns(spark, tmp):
    p = _sparse_book(os.path.join(tmp, "sparse.xlsx"))
    df = read_excel(spark, p)
    assert df.columns == ["a", "empty_B", "empty_C", "d"]
    assert [tuple(r) for r in df.collect()] == [("1", None, None, 4), ("x", None, None, 9)]
    # interior empty rows kept when empty rows are not skipped
    kept = read_excel(spark, p, skip_empty_rows=False).collect()
    assert len(kept) == 6  # rows 2..7
    # F8: trailing columns up to the last column of the range
    wide = read_excel(spark, p, last_col="F")
    assert wide.columns[-2:] == ["empty_E", "empty_F"]
    # F17 raw row numbers and F1 column range
    raw = read_excel(spark, p, raw=True, first_col="D", last_col="D").collect()
    assert [(r["row"], r["d"]) for r in raw] == [(3, 4), (7, 9)]


def _hidden_book(path):
    rows = [X.row(1, *[X.text(f"{c}1", c.lower()) for c in "ABCDEFG"])]
    for r in range(2, 7):
        rows.append(X.row(r, *[X.num(f"{c}{r}", r * 10 + i) for i, c in enumerate("ABCDEFG")], hidden=r in (2, 5)))
    return X.build(path, [("h", X.sheet_xml(rows, hidden_cols=(1, 3, 4)))])


def test_hidden_rows_columns_and_rowid(spark, tmp):
    p = _hidden_book(os.path.join(tmp, "hidden.xlsx"))
    df = read_excel(spark, p)
    assert df.columns == ["a", "c", "f", "g"]
    assert [r["a"] for r in df.collect()] == [30, 40, 60]
    every = read_excel(spark, p, skip_hidden_rows=False, skip_hidden_cols=False)
    assert every.columns == list("abcdefg") and every.count() == 5
    # Ids from a hidden column (B), still usable
    ids = read_excel(spark, p, row_id="B").collect()
    assert [r["RowID"] for r in ids] == ["31", "41", "61"]
    gen = read_excel(spark, p, row_id="generated").collect()
    assert [r["RowID"] for r in gen] == ["Row0", "Row1", "Row2"]


def test_header_row_blank_and_duplicate_names(spark, tmp):
    rows = [X.row(2, X.num("A2", 99)),
            X.row(5, X.text("A5", "x"), X.text("B5", " "), X.text("C5", "x"), X.text("E5", "y")),
            X.row(6, X.num("A6", 1), X.num("B6", 2), X.num("C6", 3), X.num("D6", 4), X.num("E6", 5))]
    p = X.build(os.path.join(tmp, "header5.xlsx"), [("s", X.sheet_xml(rows))])
    df = read_excel(spark, p, header_row=5, first_row=6)
    assert df.columns == ["x", "empty_B", "x_2", "empty_D", "y"]
    assert [tuple(r) for r in df.collect()] == [(1, 2, 3, 4, 5)]
    nohdr = read_excel(spark, p, header_row=None, column_names="index", first_row=6)
    assert nohdr.columns == ["Col0", "Col1", "Col2", "Col3", "Col4"]


def test_sheet_selection(spark, tmp):
    empty = X.sheet_xml([X.row(1, X.styled_empty("A1"))])
    full = X.sheet_xml([X.row(1, X.text("A1", "v")), X.row(2, X.num("A2", 7))])
    p = X.build(os.path.join(tmp, "empty_first.xlsx"), [("first", empty), ("second", full)])
    assert read_excel(spark, p).collect()[0]["v"] == 7  # S7: first sheet with data
    assert read_excel(spark, p, sheet="second").count() == 1
    assert read_excel(spark, p, sheet=1).count() == 1
    with pytest.raises(Exception):
        read_excel(spark, p, sheet="nope").collect()
    with pytest.raises(Exception):
        read_excel(spark, p, sheet=5).collect()
    listed = list_sheets(spark, p).orderBy("sheet_pos").collect()
    assert [r["Sheet"] for r in listed] == ["first", "second"]
    sel = select_first_sheet(sheets_table(list_files(spark, p))).collect()
    assert sel[0]["sheet"] == "second"


def test_shared_strings_and_1904(spark, tmp):
    rows = [X.row(1, X.shared("A1", 0), X.shared("B1", 1)),
            X.row(2, X.shared("A2", 2), X.num("B2", 0, X.DATE)),
            X.row(3, X.shared("A3", 2), X.num("B3", 366, X.DATE))]
    p = X.build(os.path.join(tmp, "date1904.xlsx"), [("s", X.sheet_xml(rows))], date1904=True,
                strings=["name", "when", "k & v"])
    got = read_excel(spark, p).collect()
    assert got[0]["name"] == "k & v"
    # Q2: with the 1904 base every date of 1904 reads as a time of day; 1905 is a date
    assert dict(read_excel(spark, p).dtypes)["when"] == "string"
    assert got[1]["when"] == "1905-01-01"


def test_corrupt_and_dtd(spark, tmp):
    bad = X.sheet_xml([X.row(1, X.num("B1", 1), X.num("A1", 2))])
    p = X.build(os.path.join(tmp, "corrupt.xlsx"), [("s", bad)])
    with pytest.raises(Exception, match="out of order"):
        read_excel(spark, p, header_row=None).collect()
    dtd = X.sheet_xml([X.row(1, X.num("A1", 1))], doctype=True)
    p2 = X.build(os.path.join(tmp, "dtd.xlsx"), [("s", dtd)])
    with pytest.raises(Exception, match="DTD"):
        read_excel(spark, p2, header_row=None).collect()


def test_type_drift_after_scan_limit(spark, tmp):
    rows = [X.row(1, X.text("A1", "v"))] + [X.row(r, X.num(f"A{r}", r)) for r in range(2, 30)]
    rows.append(X.row(30, X.text("A30", "late text")))
    p = X.build(os.path.join(tmp, "drift.xlsx"), [("s", X.sheet_xml(rows))])
    with pytest.raises(Exception, match="does not fit"):
        read_excel(spark, p, scan_limit=10).collect()
    perm = read_excel(spark, p, scan_limit=10, on_misfit="permissive").collect()
    assert perm[-1]["v"] is None and perm[0]["v"] == 2
    assert dict(read_excel(spark, p, scan_limit=None).dtypes)["v"] == "string"


def _multi(tmp):
    d = os.path.join(tmp, "multi")
    os.makedirs(d)
    X.build(os.path.join(d, "f1.xlsx"), [("s", X.sheet_xml([X.row(1, *[X.text(f"{c}1", c.lower()) for c in "ABC"]),
                                                           X.row(2, X.num("A2", 1), X.num("B2", 1), X.num("C2", 1))]))])
    X.build(os.path.join(d, "f2.xlsx"), [("s", X.sheet_xml([X.row(1, X.text("A1", "a"), X.text("B1", "b")),
                                                           X.row(2, X.num("A2", 2), X.num("B2", 2**40))]))])
    X.build(os.path.join(d, "f3.xlsx"), [("s", X.sheet_xml([X.row(1, *[X.text(f"{c}1", n) for c, n in zip("ABC", "bcd")]),
                                                           X.row(2, X.num("A2", 2.5), X.num("B2", 3), X.num("C2", 3))]))])
    with open(os.path.join(d, "notes.txt"), "w") as fh:
        fh.write("not a workbook")
    return d


def test_multi_file_union_intersection_fail(spark, tmp):
    d = _multi(tmp)
    u = read_excel(spark, d, path_column="Path")
    assert u.columns == ["a", "b", "c", "d", "Path"]
    assert dict(u.dtypes)["b"] == "double"
    assert u.count() == 3
    i = read_excel(spark, d, combine="intersection")
    assert i.columns == ["b"]
    with pytest.raises(ValueError):
        read_excel(spark, d, combine="fail")
    with pytest.raises(ValueError):
        read_excel(spark, d, path_column="a")


def test_inventory(spark, tmp):
    d = os.path.join(tmp, "inv")
    os.makedirs(d)
    X.build(os.path.join(d, "ok.xlsx"), [("s", X.sheet_xml([X.row(1, X.num("A1", 1))]))])
    with open(os.path.join(d, "old.xls"), "wb") as fh:
        fh.write(b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" + b"\0" * 100)
    with open(os.path.join(d, "text.xlsx"), "w") as fh:
        fh.write("hello")
    open(os.path.join(d, "empty.xlsx"), "w").close()  # zero-byte files never reach a Spark task
    inv = {os.path.basename(r["path"]): r["format"] for r in
           inventory(list_files(spark, d, extensions=("xlsx", "xls"))).collect()}
    assert inv == {"ok.xlsx": "ooxml", "old.xls": "ole2", "text.xlsx": "other"}


def test_user_schema_skips_inference(spark, tmp):
    p = _hidden_book(os.path.join(tmp, "hidden.xlsx"))
    df = read_excel(spark, p, schema={"a": "LONG", "g": "STRING"})
    assert dict(df.dtypes) == {"a": "bigint", "g": "string"}
    assert [r["g"] for r in df.collect()] == ["36", "46", "66"]


def test_legacy_lattices(spark, tmp):
    p = _types_book(os.path.join(tmp, "types.xlsx"))
    legacy = dict(read_excel(spark, p, lattice="legacy").dtypes)
    assert legacy["int_long"] == "double" and legacy["date_dt"] == "timestamp_ntz"
    oldest = dict(read_excel(spark, p, lattice="oldest").dtypes)
    assert oldest["bool"] == "string" and oldest["int"] == "int" and oldest["int_double"] == "double"


def test_options_validated(spark, tmp):
    with pytest.raises(ValueError):
        ReadOptions(first_col="D", last_col="B").validate()
    with pytest.raises(ValueError):
        ReadOptions(first_row=5, last_row=2).validate()
    with pytest.raises(ValueError):
        ReadOptions(first_col="a1").validate()


def test_hidden_columns_in_sheets_table(spark, tmp):
    p = _hidden_book(os.path.join(tmp, "hidden.xlsx"))
    row = sheets_table(list_files(spark, p)).collect()[0]
    assert row["hidden_cols"] == [1, 3, 4]


def test_corrupt_skip_and_rejects(spark, tmp):
    from cellar import rejects

    d = os.path.join(tmp, "mixed")
    os.makedirs(d)
    X.build(os.path.join(d, "good.xlsx"), [("s", X.sheet_xml([X.row(1, X.text("A1", "v")), X.row(2, X.num("A2", 1))]))])
    X.build(os.path.join(d, "bad.xlsx"), [("s", X.sheet_xml([X.row(1, X.text("A1", "v")),
                                                             X.row(2, X.num("B2", 1), X.num("A2", 2))]))])
    with open(os.path.join(d, "junk.xlsx"), "w") as fh:
        fh.write("junk")
    with pytest.raises(Exception):
        read_excel(spark, d).collect()
    ok = read_excel(spark, d, on_corrupt="skip")
    assert [r["v"] for r in ok.collect()] == [1]
    rej = {os.path.basename(r["path"]): r["reason"] for r in rejects(list_files(spark, d)).collect()}
    assert set(rej) == {"bad.xlsx", "junk.xlsx"} and "out of order" in rej["bad.xlsx"]


def test_unique_row_ids_from_column(spark, tmp):
    rows = [X.row(1, X.text("A1", "id"), X.text("B1", "v"))] + [
        X.row(r, X.text(f"A{r}", "k"), X.num(f"B{r}", r)) for r in range(2, 5)]
    p = X.build(os.path.join(tmp, "ids.xlsx"), [("s", X.sheet_xml(rows))])
    got = [r["RowID"] for r in read_excel(spark, p, row_id="A", unique_ids=True).orderBy("v").collect()]
    assert got == ["k", "k_1", "k_2"]


def test_split_read_matches_whole_read(spark, tmp):
    from cellar import write_excel

    df = spark.range(0, 3000).select(F.col("id").alias("k"), (F.col("id") * 0.5).alias("half"),
                                     F.concat(F.lit("t"), F.col("id").cast("string")).alias("txt"))
    p = os.path.join(tmp, "big.xlsx")
    write_excel({"s": df}, p, order_by=["k"])
    whole = [tuple(r) for r in read_excel(spark, p, row_id="generated").collect()]
    spark.conf.set("cellar.read.splitBytes", "4000")
    try:
        split = read_excel(spark, p, row_id="generated")
        got = sorted((tuple(r) for r in split.collect()), key=lambda t: t[1])
    finally:
        spark.conf.unset("cellar.read.splitBytes")
    assert got == whole
    assert [t[0] for t in got] == [f"Row{i}" for i in range(3000)]


def test_skip_mode_reads_big_files_whole(spark, tmp):
    from cellar import write_excel

    p = os.path.join(tmp, "whole.xlsx")
    write_excel({"s": spark.range(0, 500).select(F.col("id").alias("k"))}, p, order_by=["k"])
    spark.conf.set("cellar.read.splitBytes", "1000")
    try:
        assert read_excel(spark, p, on_corrupt="skip").count() == 500
    finally:
        spark.conf.unset("cellar.read.splitBytes")


def test_numbers_as_displayed_in_text_columns(spark, tmp):
    # style 5 of this workbook: two decimals and groups; 6: a built-in percent format
    p = X.build(os.path.join(tmp, "d.xlsx"), [("s", X.sheet_xml([
        X.row(1, X.text("A1", "t"), X.text("B1", "n")),
        X.row(2, X.num("A2", 1234.5, 5), X.num("B2", 0.25, 6)),
        X.row(3, X.num("A3", 7), X.num("B3", 1)),
        X.row(4, X.text("A4", "x"))]))], styles=X.STYLES.replace('count="2">', 'count="3"><numFmt numFmtId="166" formatCode="#,##0.00"/>')
        .replace('count="5">', 'count="7">').replace("</cellXfs>", '<xf numFmtId="166"/><xf numFmtId="9"/></cellXfs>'))
    assert [tuple(r) for r in read_excel(spark, p).collect()] == [("1234.5", 0.25), ("7", 1.0), ("x", None)]
    assert [tuple(r) for r in read_excel(spark, p, displayed=True).collect()] == [("1,234.50", 0.25), ("7", 1.0), ("x", None)]
    got = read_excel(spark, p, displayed=True, types={"n": "STRING"}).collect()
    assert [r["n"] for r in got] == ["25%", "1", None]


def _gappy(path, rows=400, broken=False):
    """Numbers in A, text in B from row 301 on, every seventh row hidden, gaps after every fifth."""
    out, r = [X.row(1, X.text("A1", "n"), X.text("B1", "t"))], 2
    for i in range(rows):
        cells = [X.num(f"A{r}", i + (0.5 if i > 250 else 0))] + ([X.text(f"B{r}", f"x{i}")] if i >= 300 else [])
        out.append(X.row(r, *cells, hidden=i % 7 == 3))
        r += 4 if i % 5 == 4 else 1
    if broken:
        out.insert(-3, '<row r="9999"><c r="C9999"><v>1</v></c><c r="B9999"><v>2</v></c></row>')
    return X.build(path, [("s", X.sheet_xml(out))])


def _both(spark, read):
    """A read in one piece and in many splits."""
    out = []
    for size in ("8388608", "500"):
        spark.conf.set("cellar.read.splitBytes", size)
        try:
            out.append(sorted(map(tuple, read().collect()), key=repr))
        finally:
            spark.conf.unset("cellar.read.splitBytes")
    return out


@pytest.mark.parametrize("options", [{"last_row": 700}, {"first_row": 20, "last_row": 100, "skip_hidden_rows": False},
                                     {"row_id": "generated", "path_column": "P"}])
def test_empty_rows_over_splits(spark, tmp, options):
    _gappy(os.path.join(tmp, "a.xlsx"))
    _gappy(os.path.join(tmp, "b.xlsx"), 60)
    whole, split = _both(spark, lambda: read_excel(spark, tmp, skip_empty_rows=False, **options))
    assert whole == split and len(whole) > 60


def test_scan_limit_over_splits(spark, tmp):
    p = _gappy(os.path.join(tmp, "a.xlsx"))
    for limit, kinds in ((10, None), (250, ["double", "string"]), (5000, ["double", "string"])):
        for size in ("8388608", "500"):
            spark.conf.set("cellar.read.splitBytes", size)
            try:
                # of all rows but hidden ones
                if kinds:
                    df = read_excel(spark, p, scan_limit=limit)
                    assert [t for _, t in df.dtypes] == kinds and df.count() > 300
                else:
                    df = read_excel(spark, p, scan_limit=limit)
                    assert df.dtypes[0] == ("n", "int")
                    with pytest.raises(Exception, match="not fit"):
                        df.collect()
            finally:
                spark.conf.unset("cellar.read.splitBytes")


def test_corrupt_files_are_left_out_over_splits(spark, tmp):
    _gappy(os.path.join(tmp, "a.xlsx"), broken=True)
    _gappy(os.path.join(tmp, "b.xlsx"), 200)
    whole, split = _both(spark, lambda: read_excel(spark, tmp, on_corrupt="skip", path_column="P"))
    assert whole == split and {r[-1][-6:] for r in whole} == {"b.xlsx"} and len(whole) > 150
    whole, split = _both(spark, lambda: read_excel(spark, tmp, on_corrupt="skip", skip_empty_rows=False))
    assert whole == split


@pytest.mark.parametrize("split", [None, "16"])
def test_sheets_of_a_list_are_read_in_one_go(spark, tmp, split):
    """Types over all sheets, columns by name, rows in the order of the sheets; no more jobs for more sheets."""
    many = 40
    sheets = []
    for i in range(many):
        names = [X.text("A1", "k"), X.text("B1", "v")] if i % 2 else [X.text("A1", "v"), X.text("B1", "k")]
        rows = [X.row(1, *names)]
        for r in range(2, 5):
            k, v = X.num(f"{'A' if i % 2 else 'B'}{r}", 10 * i + r), X.num(f"{'B' if i % 2 else 'A'}{r}", r + (0.5 if i == 7 else 0))
            rows.append(X.row(r, *((k, v) if i % 2 else (v, k))))
        sheets.append((f"s{i}", X.sheet_xml(rows)))
    X.build(f"{tmp}/many.xlsx", sheets)
    if split:
        spark.conf.set("cellar.read.splitBytes", split)
    try:
        tracker = spark.sparkContext.statusTracker()

        def read(wanted):
            spark.sparkContext.setJobGroup(f"{tmp}{len(wanted)}{split}", "sheets")
            got = read_excel(spark, f"{tmp}/many.xlsx", sheet=wanted, row_id="generated")
            rows = got.collect()
            jobs = len(tracker.getJobIdsForGroup(f"{tmp}{len(wanted)}{split}"))
            return got, rows, jobs

        got, rows, jobs = read(range(many))
        assert dict(got.dtypes) == {"RowID": "string", "v": "double", "k": "int"}
        assert {r["RowID"]: (r["k"], r["v"]) for r in rows} == {
            f"Row{3 * i + r - 2}": (10 * i + r, r + (0.5 if i == 7 else 0)) for i in range(many) for r in range(2, 5)}
        assert jobs == read(["s3", "s1"])[2]
        assert [r["k"] for r in sorted(read(["s3", 1])[1], key=lambda r: int(r["RowID"][3:]))] == [32, 33, 34, 12, 13, 14]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        if split:
            spark.conf.unset("cellar.read.splitBytes")
    with pytest.raises(ValueError):
        read_excel(spark, f"{tmp}/many.xlsx", sheet=[0, 1], scan_limit=5)
    with pytest.raises(ValueError):
        read_excel(spark, f"{tmp}/many.xlsx", sheet=[])
    with pytest.raises(Exception, match="does not exist"):
        read_excel(spark, f"{tmp}/many.xlsx", sheet=[0, many]).count()
