import numpy as np
import pytest

from pyspark.sql import functions as F

from assayloom.functions import vectors as V
from assayloom.operators import encode as E


def test_ordinal_text_with_null(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (3, None)], "i int, s string")
    assert [r.s for r in E.ordinal_encode(df, ["s"]).orderBy("i").collect()] == [1, 0, 1, 2]


def test_ordinal_keeps_the_values_own_order(spark):
    df = spark.createDataFrame([(100, True, 2.5), (9, False, float("nan")), (10, True, None)], "i int, b boolean, d double")
    out = E.ordinal_encode(df.withColumn("k", F.col("i")), ["i", "b", "d"]).orderBy("k").collect()
    assert [(r.i, r.b, r.d) for r in out] == [(0, 0, 1), (1, 1, 1), (2, 1, 0)]


def test_ordinal_codes_of_many_values(spark):
    df = spark.range(300).select((F.col("id") % 150).cast("string").alias("s"))
    got = {r.value: r.code for r in E.ordinal_codes(df, "s").collect()}
    assert got == {v: i for i, v in enumerate(sorted({str(i) for i in range(150)}))}


def test_codes_can_be_fitted_elsewhere(spark):
    base = spark.createDataFrame([("a",), ("b",), ("c",)], "s string")
    assert [r.s for r in E.ordinal_encode(base.where("s = 'c'"), ["s"], fit_on=base).collect()] == [2]


def test_assemble(spark):
    df = spark.createDataFrame([(1, 2.0), (None, 3.0)], "a int, b double")
    assert [r.features for r in E.assemble(df, ["a", "b"]).collect()] == [[1.0, 2.0], [None, 3.0]]
    assert [r.features for r in E.assemble(df, ["a", "b"], missing=0).collect()] == [[1.0, 2.0], [0.0, 3.0]]


def test_bits(spark):
    df = spark.createDataFrame([("0110",), ("1",), (None,)], "b string")
    arrays = [r[0] for r in df.select(V.bits_to_array("b")).collect()]
    assert arrays == [[0, 1, 1, 0], [1], None]
    assert [r[0] for r in df.select(V.set_bits(V.bits_to_array("b"))).collect()] == [[1, 2], [0], None]


def test_vector_functions(spark):
    df = spark.createDataFrame([([1.0, -2.0], 3.0, "0.5", "x")], "v array<double>, s double, t string, u string")
    row = df.select(
        V.relu("v").alias("relu"), V.append_value("v", "s").alias("longer"), V.as_vector("s").alias("one"),
        V.affine("v", [2.0, 1.0], 0.5).alias("affine"), V.to_float32("t").alias("f"), V.to_float32("u").alias("g"),
        V.floor_fraction(F.lit(15), 0.1).alias("n"), V.percent_label(F.lit(12.34)).alias("label"),
        V.concat_vectors("v", "v").alias("twice"),
    ).first()
    assert row.relu == [1.0, 0.0] and row.longer == [1.0, -2.0, 3.0] and row.one == [3.0] and row.affine == 0.5
    assert row.f == 0.5 and row.g is None and row.n == 1 and row.label == "12.3%" and row.twice == [1.0, -2.0] * 2


def test_affine_many(spark):
    rng = np.random.default_rng(0)
    x, w, b = rng.normal(size=(50, 4)), rng.normal(size=(3, 4)), rng.normal(size=3)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)] + [(50, None)], "i int, x array<double>")
    got = {r.i: r.affine for r in V.affine_many(df, "x", w, b).collect()}
    assert got.pop(50) is None
    np.testing.assert_allclose([got[i] for i in range(50)], x @ w.T + b)


def test_relu_keeps_nulls(spark):
    df = spark.createDataFrame([([1.0, None, -2.0],)], "x array<double>")
    assert df.select(V.relu("x").alias("x")).first().x == [1.0, None, 0.0]


def test_affine_refuses_ragged_rows_and_slices_its_output(spark):
    bad = spark.createDataFrame([([1.0],), ([1.0, 2.0, 3.0],)], "x array<double>").coalesce(1)
    with pytest.raises(Exception, match="entries, not 2"):
        V.affine_many(bad, "x", [[1.0, 1.0]], [0.0]).collect()
    good = spark.createDataFrame([(i, [float(i), 1.0] if i % 3 else None) for i in range(20)], "i int, x array<double>").coalesce(1)
    got = {r.i: r.affine for r in V.affine_many(good, "x", [[1.0] * 2] * 3, [0.5] * 3).collect()}
    assert got == {i: [i + 1.5] * 3 if i % 3 else None for i in range(20)}


def test_one_encoder_for_columns_of_many_types(spark, no_broadcast):
    import datetime as dt

    rows = [(i, ["b", "a", None][i % 3], [10, 9, 100][i % 3], [float("nan"), -0.5, 2.0][i % 3], dt.date(2020, 1, 1 + i % 4), i % 2 == 0, None)
            for i in range(24)]
    df = spark.createDataFrame(rows, "id long, s string, n int, d double, day date, f boolean, none string")
    cols = ["s", "n", "d", "day", "f", "none"]
    encoder = E.fit_ordinal(df, cols)
    assert {c: n for c, (_, _, n, _) in encoder.columns.items()} == {"s": 2, "n": 3, "d": 2, "day": 4, "f": 2, "none": 0}
    want = [(i, [1, 0, 2][i % 3], [1, 0, 2][i % 3], [2, 0, 1][i % 3], i % 4, int(i % 2 == 0), 0) for i in range(24)]
    for out in (E.ordinal_encode(df, cols), encoder.transform(df.repartition(3))):
        assert out.columns == df.columns and sorted(map(tuple, out.collect())) == want
    other = spark.createDataFrame([(1, "zz", 9)], "id long, s string, n int")
    assert tuple(E.fit_ordinal(df, ["s", "n"]).transform(other).first()) == (1, 2, 0)


def test_passes_of_the_encoder_do_not_grow_with_the_columns(spark):
    wide = spark.range(50).selectExpr("id", *[f"string(id % {k + 2}) AS c{k}" for k in range(12)])
    tracker = spark.sparkContext.statusTracker()

    def jobs(n):
        spark.sparkContext.setJobGroup(f"fit-{n}", "fit")
        E.fit_ordinal(wide, [f"c{k}" for k in range(n)])
        return len(tracker.getJobIdsForGroup(f"fit-{n}"))

    assert jobs(2) == jobs(12)
