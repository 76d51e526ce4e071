"""Table operators checked against brute force on small inputs."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cellar.operators import combine as U
from cellar.operators import ids as W
from cellar.operators import layout as L
from cellar.operators import patch as J
from cellar.operators import profile as P
from cellar.operators.ordinal import running_sum, stable_partitions, with_ordinals
from cellar.plans import cells as C


def test_ordinals_match_row_number(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("k"), (F.col("id") % 3).alias("g"))
    got = with_ordinals(stable_partitions(df, ["k"]), "n")
    brute = df.withColumn("rn", F.row_number().over(Window.orderBy("k")) - 1)
    assert got.join(brute, "k").filter(F.col("n") != F.col("rn")).count() == 0
    per_g = with_ordinals(stable_partitions(df, ["k"], group="g"), "n", group="g")
    brute_g = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1)
    assert per_g.join(brute_g, ["k", "g"]).filter(F.col("n") != F.col("rn")).count() == 0


def test_hot_key_spread_over_buckets(spark):
    # a third of the rows share one group value: the ordering key still spreads them
    df = spark.range(0, 3000).select(F.when(F.col("id") < 1000, F.lit(0)).otherwise(F.col("id")).alias("g"),
                                     F.col("id").alias("k"))
    staged = stable_partitions(df, ["k"], group="g", partitions=8)
    sizes = [r["c"] for r in staged.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("c")).collect()]
    assert max(sizes) < 1000


def test_running_sum_over_100000_partitions(spark):
    df = spark.range(0, 100_000).select(((F.col("id") * 7919) % 100_000).alias("i"), (F.col("id") % 5).alias("v"))
    got = running_sum(df, "i", "v", "s")
    want = df.withColumn("w", F.sum("v").over(Window.orderBy("i").rowsBetween(Window.unboundedPreceding, -1)))
    assert got.join(want, "i").filter("s <> coalesce(w, 0)").count() == 0 and got.count() == 100_000


def test_repeated_rows_spread_over_partitions(spark):
    df = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"))
    staged = stable_partitions(df, ["k"], partitions=8)
    assert staged.groupBy(F.spark_partition_id()).count().count() > 1
    assert sorted(r["n"] for r in with_ordinals(staged, "n").collect()) == list(range(4000))


def _replay(ids):
    """Names one row after the other, with a counter per name."""
    counter, out = {}, []
    for name in ids:
        while name in counter:
            counter[name] += 1
            name = f"{name}_{counter[name]}"
        counter[name] = 0
        out.append(name)
    return out


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_unique_ids_like_a_replay(spark, seed):
    rng = random.Random(seed)
    ids = []
    for _ in range(400):
        name = rng.choice(["a", "b", "", "x_0", "x_01", "n\nl"])
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            name += f"_{rng.choice([1, 1, 1, 2, 3, 5, 40])}"
        ids.append(name)
    if seed == 2:
        ids = ["a", "a_1", "a", "a_1", "a_1_1"]
    rows = [(i, name, 0, 0) for i, name in enumerate(ids)] + [(1000, None, 0, 0)]
    df = spark.createDataFrame(rows, "o int, id string, __t int, __new int").repartition(5)
    got = {r["o"]: r["u"] for r in W.make_unique(df, "id", "o", "u").collect()}
    assert got.pop(1000) is None
    assert [got[i] for i in range(len(ids))] == _replay(ids)


def test_type_runs_over_segments(spark):
    rng = random.Random(4)
    kinds = [("n", 1.0, None), ("n", 1.5, None), ("s", None, "x"), ("s", None, " "), ("b", 1.0, None)]
    rows, want = [], {}
    for f in ("f", None, "g"):
        r = 65500
        last = {}
        while r < 65700:
            cells = {}
            for j in (0, 2, 3):
                k = rng.choice([kinds[0]] * 6 + kinds + [None]) if j else kinds[0]
                if k:
                    cells[j] = {"k": k[0], "n": k[1], "s": k[2]}
                    bit = {1.0: 1, 1.5: 4}[k[1]] if k[0] == "n" else 8 if k[0] == "b" else 128 if k[2] == "x" else 0
                    if bit:
                        runs = want.setdefault((f, j), [])
                        if runs and runs[-1][2] == r - 1 and runs[-1][0] == bit:
                            runs[-1] = (bit, runs[-1][1], r)
                        else:
                            if runs and runs[-1][2] < r - 1:
                                runs.append((0, runs[-1][2] + 1, r - 1))
                            runs.append((bit, r, r))
            rows.append((f, r, False, cells))
            r += rng.choice([1, 1, 1, 1, 1, 1, 4])
    df = spark.createDataFrame(rows, f"path string, row_idx int, hidden boolean, cells map<int,{C.CELL_STRUCT}>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = P.type_runs(df).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(((r["path"], r["col"], r["b"], r["first_row"], r["last_row"]) for r in got), key=repr) == sorted(
        ((f, j, *run) for (f, j), runs in want.items() for run in runs), key=repr)
    assert P.type_runs(df.limit(0)).count() == 0


def test_append_chain_brute_force(spark):
    chain = spark.createDataFrame([(0, 5), (1, 9), (2, 2)], "sheet_no long, last_row long")  # cap 10
    df = spark.range(0, 30).select(F.col("id").alias("n"))
    got = {r["n"]: (r["sheet_no"], r["row"]) for r in L.append_chain(df, "n", chain, max_rows=10).collect()}
    expect, n = {}, 0
    for s, last in [(0, 5), (1, 9), (2, 2)]:
        for row in range(last + 1, 10):
            expect[n] = (s, row)
            n += 1
    s = 3
    while n < 30:
        for row in range(1, 10):
            if n < 30:
                expect[n] = (s, row)
                n += 1
        s += 1
    assert got == expect


def test_patches(spark):
    base = spark.createDataFrame([("S", 0, 0, "n", 1.0, None), ("S", 0, 1, "s", None, "old"), ("S", 1, 0, "n", 5.0, None)],
                                 "sheet string, row int, col int, k string, n double, s string")
    pt = spark.createDataFrame([("B1", "new", None, 1), ("B1", "newer", None, 2), ("C3", None, 7.0, 1),
                                ("A2", None, None, 1)], "addr string, txt string, num double, seq long")
    out = J.apply_patches(base, J.patches_from_table(pt, "addr", sheet="S", seq_col="seq"))
    got = {(r["row"], r["col"]): (r["k"], r["n"], r["s"]) for r in out.collect()}
    assert got == {(0, 0): ("n", 1.0, None), (0, 1): ("s", None, "newer"), (2, 2): ("n", 7.0, None)}
    two = spark.createDataFrame([("A1", "x", 1.0, 1)], "addr string, txt string, num double, seq long")
    with pytest.raises(Exception, match="more than one value"):
        J.apply_patches(base, J.patches_from_table(two, "addr", sheet="S", seq_col="seq")).collect()
    with pytest.raises(ValueError):
        J.require_sheets(J.patches_from_table(pt, "addr", sheet="T", seq_col="seq"), base)


def test_combine_modes(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2**40, 2.5)], "k long, w double")
    u = U.combine([a, b], "union")
    assert u.columns == ["k", "v", "w"] and dict(u.dtypes)["k"] == "bigint"
    assert U.combine([a, b], "intersection").columns == ["k"]
    with pytest.raises(ValueError):
        U.combine([a, b], "fail")
    with pytest.raises(ValueError):
        U.legacy_combine([a, b])
    with pytest.raises(ValueError):
        U.check_names(a, ["k", "other"])


def _rows(spark):
    data = [("f", 0, {0: ("n", 1.0, None)}), ("f", 1, {0: ("n", 2.0, None)}), ("f", 2, {0: ("s", None, "t")}),
            ("f", 5, {0: ("n", 1.5, None)}), ("g", 0, {0: ("b", 1.0, None)})]
    df = spark.createDataFrame([(p, r, False, {k: {"k": v[0], "n": v[1], "s": v[2]} for k, v in m.items()})
                                for p, r, m in data],
                               f"path string, row_idx int, hidden boolean, cells map<int,{C.CELL_STRUCT}>")
    return df


def test_type_runs_and_masks(spark):
    rows = _rows(spark)
    runs = sorted(tuple(r) for r in P.type_runs(rows).select("path", "b", "first_row", "last_row", "n_rows").collect())
    assert runs == sorted([
        ("f", 1, 0, 1, 2), ("f", 128, 2, 2, 1), ("f", 0, 3, 4, 2), ("f", 4, 5, 5, 1), ("g", 8, 0, 0, 1)])
    masks = {r["path"]: (r["mask"]) for r in P.column_masks(rows).collect()}
    assert masks == {"f": 1 | 128 | 4, "g": 8}
    lat = spark.createDataFrame([(1,), (3,), (7,), (48,), (8,), (9,), (0,), (64,)], "m int").select(
        C.lattice_type(F.col("m"))).collect()
    assert [r[0] for r in lat] == ["INT", "LONG", "DOUBLE", "DATETIME", "BOOLEAN", "STRING", "STRING", "TIME"]


def test_materialise_and_filter_rows(spark):
    rows = _rows(spark)
    full = P.materialise_empty_rows(rows.filter("path = 'f'"), first_row=0)
    assert sorted(r["row_idx"] for r in full.collect()) == [0, 1, 2, 3, 4, 5]
    assert P.filter_rows(rows, first_row=1, last_row=4).count() == 2


def test_ids(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("b", 1), ("b", 2)], "file string, seq long")
    ids = [r["RowID"] for r in W.generated_row_ids(df, "file", "seq").orderBy("file", "seq").collect()]
    assert ids == ["Row0", "Row1", "Row2", "Row3", "Row4"]
    u = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, "x")], "o int, id string")
    got = [r["id"] for r in W.make_unique(u, "id", "o").orderBy("o").collect()]
    assert got == ["x", "x_1", "y", "x_2"]
    assert W.duplicate_ids(u, "id").collect()[0]["copies"] == 3


def test_legacy_ids(spark):
    df = spark.createDataFrame([("a", 0, 0, 2), ("a", 0, 1, 5), ("b", 1, 0, 1)], "file string, fno int, seq long, row_idx int")
    idx = {(r["file"], r["row_idx"]): r["RowID"] for r in W.index_row_ids(df, "file", "row_idx", "fno").collect()}
    assert idx == {("a", 2): "Row2", ("a", 5): "Row5", ("b", 1): "Row7"}  # offset of earlier files added once
    plain = sorted(r["RowID"] for r in W.plain_row_ids(df, "file", "seq").collect())
    assert plain == ["1", "2", "3"]
    e = spark.createDataFrame([("",), ("x",)], "i string").select(
        W.empty_id_to_generated(F.col("i"), F.lit("Row9")).alias("o")).collect()
    assert [r["o"] for r in e] == ["Row9", "x"]


def test_masks_do_not_generate_more_code_for_more_columns(spark):
    """Every column's typing in one projection made methods that the JVM does not compile."""
    def wide(n):
        cells = {j: {"k": "n", "n": j + (0.5 if j % 2 else 0.0), "s": None} for j in range(n)}
        return spark.createDataFrame([("f", 0, False, cells)], f"path string, row_idx int, hidden boolean, cells map<int,{C.CELL_STRUCT}>")

    def plan(n):
        return P.column_masks(wide(n))._jdf.queryExecution().optimizedPlan().toString()

    assert plan(60).count("timestampadd") == plan(3).count("timestampadd")
    got = {r["col"]: r["mask"] for r in P.column_masks(wide(60)).collect()}
    assert got == {j: 4 if j % 2 else 1 for j in range(60)}
    assert {r["col"] for r in P.column_masks(wide(60), [1, 5]).collect()} == {1, 5}
    empty = spark.createDataFrame([("f", 0, False, {0: None}), ("f", 1, False, None)],
                                  f"path string, row_idx int, hidden boolean, cells map<int,{C.CELL_STRUCT}>")
    assert P.column_masks(empty).count() == 0 and P.type_runs(empty).count() == 0
