"""Plan shape checks: the operators keep data distributed (no single-partition exchange),
filters reach the file scan, and only bounded sides are broadcast."""

import os

from pyspark.sql import functions as F

import xlsxbuild as X
from cellar import read_excel
from cellar.operators import ids as W
from cellar.operators import profile as P
from cellar.operators.ordinal import stable_partitions, with_ordinals
from cellar.plans import cells as C


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(spark):
    data = [(f"f{i % 3}", i, False, {0: {"k": "n", "n": float(i), "s": None}}) for i in range(300)]
    return spark.createDataFrame(data, f"path string, row_idx int, hidden boolean, cells map<int,{C.CELL_STRUCT}>")


def test_ordinals_have_no_single_partition(spark):
    df = spark.range(0, 2000).select((F.col("id") * 7 % 2000).alias("k"))
    df = with_ordinals(stable_partitions(df, ["k"]), "n")
    plan = _plan(df)
    # neither one task for all rows nor range bounds as literals; the window is over one row per partition
    assert "SinglePartition" not in plan and "CASE WHEN" not in plan and "element_at" not in plan
    assert plan.index("BroadcastExchange") < plan.index("Window")


def test_profiles_and_ids_have_no_single_partition(spark):
    rows = _rows(spark)
    for df in (P.type_runs(rows), P.column_masks(rows), P.materialise_empty_rows(rows),
               W.make_unique(spark.range(100).select((F.col("id") % 7).cast("string").alias("uid"),
                                                     F.col("id").alias("o")), "uid", "o"),
               W.generated_row_ids(spark.range(100).select((F.col("id") % 3).alias("f"), F.col("id").alias("s")),
                                   "f", "s")):
        assert "SinglePartition" not in _plan(df)


def test_read_plan_is_map_side_with_pushed_filters(spark, tmp):
    p = X.build(os.path.join(tmp, "p.xlsx"), [("s", X.sheet_xml([X.row(1, X.text("A1", "a"), X.text("B1", "b")),
                                                                  X.row(2, X.num("A2", 1), X.num("B2", 2))]))])
    df = read_excel(spark, p).select("b")
    plan = _plan(df)
    assert "MapInArrow" in plan and "SortMergeJoin" not in plan and "SinglePartition" not in plan
    assert "LessThanOrEqual(length" in plan  # file size filter reaches the binaryFile scan
    # only column b (key 1) is picked from the cell map, in both the small-file and split branches
    assert "element_at(cells#" in plan and "__c0" not in plan and "__c1" in plan
