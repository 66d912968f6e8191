import pytest

from pyspark.sql import functions as F

from assayloom.operators import rows as R
from assayloom.operators import select as S
from assayloom.operators import sets as U


def test_row_index_is_the_sorted_position(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") * 7919 % 5003).alias("v"))
    got = sorted((r.row_index, r.v, r.id) for r in R.with_row_index(df, ["v", "id"]).collect())
    want = sorted((i * 7919 % 5003, i) for i in range(5000))
    assert got == [(n, v, i) for n, (v, i) in enumerate(want)]


def test_row_index_splits_one_repeated_key(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), "id")
    out = R.with_row_index(df, ["k"])
    assert sorted(r.row_index for r in out.collect()) == list(range(4000))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_row_index_is_the_same_on_every_read(spark):
    out = R.with_row_index(spark.range(1000).select((F.col("id") % 10).alias("k"), "id"), ["k"])
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, out.repartition(3).collect()))


def test_row_index_of_nothing(spark):
    assert R.with_row_index(spark.range(0), ["id"]).count() == 0


def test_ids_and_gather(spark, rows):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a")], "row_id long, s string")
    ids = R.ids_where_member(df, "s", ["a", "z"])
    assert rows(ids) == [(0,), (2,)]
    assert rows(R.gather(df, ids.unionByName(ids))) == [(0, "a"), (2, "a")]
    order = spark.createDataFrame([(2, 0), (0, 1), (2, 2)], "row_id long, position int")
    out = R.gather_in_order(df, order).orderBy("position")
    assert [(r.position, r.s, r.row_id) for r in out.collect()] == [(0, "a", 2), (1, "a", 0), (2, "a", 2)]


def test_shape_listing_and_peek(spark, rows):
    df = spark.range(7).withColumn("s", F.lit("x"))
    assert tuple(R.shape(df).first()) == (7, 2)
    assert rows(R.column_listing(df, "t"), "table", "pos", "column", "type", "n_rows") == [
        ("t", 0, "id", "bigint", 7), ("t", 1, "s", "string", 7)]
    assert [r.id for r in R.peek(df, [F.desc("id")]).collect()] == [6, 5, 4, 3, 2]


def test_selection(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "XLogP3-AA", "c"])
    assert S.select_lenient(df, ["c", "zz", "XLogP3-AA"]).first()[:] == (3, None, 2)
    assert S.drop_columns(df, ["XLogP3-AA"]).columns == ["a", "c"]
    with pytest.raises(ValueError):
        S.drop_columns(df, ["zz"])
    with pytest.raises(Exception):
        S.select_strict(df, ["zz"]).collect()
    assert S.slice_columns(df, None, -1).columns == ["a", "XLogP3-AA"]
    assert S.slice_columns(df, -1).columns == ["c"]
    assert S.last_column_first(df).columns == ["c", "a", "XLogP3-AA"]
    assert S.rename(df, {"a": "b", "no": "x"}).columns == ["b", "XLogP3-AA", "c"]
    features, targets = S.split_features_targets(df, ["c", "a"])
    assert features.columns == ["c", "a"] and targets.columns == ["XLogP3-AA"]


def test_not_null(spark, rows):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "d double, s string")
    assert rows(S.not_null(df, ["d", "s"])) == [(1.0, "a")]
    assert rows(S.keep_found(df, "s"), "s") == [("a",), ("b",), ("c",)]


def test_sets(spark, rows):
    a = spark.createDataFrame([(1,), (1,), (2,), (3,)], "row_id long")
    b = spark.createDataFrame([(2,), (2,), (4,)], "row_id long")
    assert rows(U.union_ids(a, b)) == [(1,), (1,), (2,), (2,), (2,), (3,), (4,)]
    assert rows(U.difference_ids(a, b)) == [(1,), (3,)]
    left = spark.createDataFrame([(1, "x")], "i int, s string")
    right = spark.createDataFrame([("y", 2.0)], "s string, d double")
    assert rows(U.append_rows(left, right), "i", "s", "d") == [(None, "y", 2.0), (1, "x", None)]
    hits = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("m", 5, None)], "k string, rank int, v string")
    assert rows(U.first_match(hits, "k", ["rank"], ["v"])) == [("k", "a"), ("m", None)]
