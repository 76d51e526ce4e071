"""Driver contract: entry runs on sf0.001; every query has an oracle; a few match DuckDB."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["segment", "customers", "acctbal", "min_key", "max_key"]
    assert sum(r["customers"] for r in rows) == spark.read.parquet(f"{SF}/customer.parquet").count()


def test_every_query_has_oracle():
    # the training-data queries say themselves which of them SQL can express
    assert {k for k in E.queries() if k in E._QUERIES} == {k for k in E.oracle_sql() if k in E._QUERIES}


@pytest.mark.parametrize("name", ["col_label", "append_chain", "cell_update", "read_range", "stream_workbooks",
                                  "stream_to_workbooks"])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ["customer", "orders", "lineitem", "part"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = E.queries()[name](spark, SF)
    cols = sorted(got.columns)
    norm = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else v
    a = sorted((tuple(norm(r[c]) for c in cols) for r in got.collect()), key=repr)
    odf = con.execute(E.oracle_sql()[name]).df()
    b = sorted((tuple(norm(None if (v != v if isinstance(v, float) else False) else v) for v in row)
                for row in odf[cols].astype(object).itertuples(index=False)), key=repr)
    assert len(a) == len(b)
    assert [tuple(map(str, r)) for r in a] == [tuple(map(str, r)) for r in b]


def _check_over_sheets(spark, tmp, monkeypatch, name, table, rows):
    """The query on a table that fills three sheets, against its SQL."""
    monkeypatch.setattr("cellar.sinks.excel.XLSX_MAX_ROWS", 50)
    con = duckdb.connect()
    con.execute(f"COPY ({rows}) TO '{tmp}/{table}.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp}/{table}.parquet')")
    got = E.queries()[name](spark, tmp)
    want = con.execute(E.oracle_sql()[name])
    assert got.columns == [d[0] for d in want.description]
    a, b = (sorted(tuple(map(str, r)) for r in x) for x in (got.collect(), want.fetchall()))
    assert len(a) == 120
    assert a == b


def test_roundtrip_lineitem_reads_all_sheets(spark, tmp, monkeypatch):
    # keys repeat or are missing, and only rows of the last sheet have fractions
    _check_over_sheets(spark, tmp, monkeypatch, "roundtrip_lineitem", "lineitem", """
        SELECT CASE WHEN i % 40 <> 7 THEN i // 3 END AS l_orderkey, i % 11 AS l_partkey, i % 5 AS l_suppkey,
               CAST(i % 2 AS INTEGER) AS l_linenumber, CAST(i % 50 AS DOUBLE) AS l_quantity,
               CASE WHEN i >= 110 THEN i + 0.25 ELSE i END::DOUBLE AS l_extendedprice,
               CASE WHEN i >= 110 THEN 0.05 ELSE 0 END::DOUBLE AS l_discount,
               CASE WHEN i >= 110 THEN 0.5 END::DOUBLE AS l_tax, CASE WHEN i % 3 = 0 THEN 'A' END AS l_returnflag,
               'O' AS l_linestatus, CASE WHEN i % 4 <> 0 THEN TIMESTAMP '1995-01-31' + to_days(CAST(i AS INTEGER)) END AS l_shipdate
        FROM range(120) t(i)""")


def test_select_columns_reads_all_sheets(spark, tmp, monkeypatch):
    # keys repeat or are missing, customers begin on the second sheet
    _check_over_sheets(spark, tmp, monkeypatch, "select_columns", "orders", """
        SELECT CASE WHEN i % 40 <> 7 THEN i // 3 END AS o_orderkey, CASE WHEN i >= 60 THEN i % 11 END AS o_custkey,
               CASE WHEN i % 3 = 0 THEN 'F' END AS o_orderstatus, CASE WHEN i >= 110 THEN i + 0.25 ELSE i END::DOUBLE AS o_totalprice,
               TIMESTAMP '1995-01-31' AS o_orderdate, '5-LOW' AS o_orderpriority
        FROM range(120) t(i)""")
