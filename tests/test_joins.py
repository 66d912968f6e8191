import pytest

from pyspark.sql import functions as F

from assayloom.operators import joins as J
from assayloom.session import broadcast_limit, fits_broadcast, measured_size


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _skewed(spark):
    """Ten thousand rows; a third share one key, a tenth have none."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(
        (F.col("id") % 500).cast("string"))
    left = spark.range(10_000).select(F.col("id").alias("row_id"), key.alias("k"))
    right = spark.createDataFrame(
        [("hot", d) for d in range(7)] + [(str(i), 0) for i in range(0, 500, 2)] + [(None, 99)], "k string, d int")
    return left, right


@pytest.mark.parametrize("how", ["left", "inner"])
def test_skew_join_equals_plain_join(spark, no_broadcast, how, rows):
    left, right = _skewed(spark)
    salted = J.skew_join(left, right, ["k"], how)
    assert sorted(salted.columns) == ["d", "k", "row_id"]
    assert rows(salted, "row_id", "k", "d") == rows(left.join(right, "k", how), "row_id", "k", "d")


def test_skew_join_spreads_the_hot_key(spark, no_broadcast):
    left, right = _skewed(spark)
    hot = {r.k: r._n_salts for r in J.hot_keys(left, ["k"]).collect()}
    assert hot["hot"] > 80 and len(hot) <= 256
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = J.skew_join(left, right, ["k"], "left").withColumn("p", F.spark_partition_id())
        sizes = [r["count"] for r in out.groupBy("p").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_skew_join_without_hot_keys_is_plain(spark, no_broadcast, rows):
    left = spark.range(1000).withColumnRenamed("id", "k")
    right = spark.range(0, 1000, 2).select(F.col("id").alias("k"), F.lit(1).alias("d"))
    out = J.skew_join(left, right, ["k"])
    assert "_salt" not in _plan(out)
    assert rows(out) == rows(left.join(right, "k", "left"))


def test_skew_join_refuses_other_kinds(spark):
    with pytest.raises(ValueError):
        J.skew_join(spark.range(1), spark.range(1), ["id"], "full")


def test_dimension_join_broadcasts_only_what_is_measured_small(spark, rows):
    left, right = _skewed(spark)
    want = rows(left.join(right, "k", "left"), "row_id", "k", "d")
    for freeze in (False, True):
        small = J.dimension_join(left, right, ["k"], freeze=freeze)
        assert "BroadcastHashJoin" in _plan(small)
        assert rows(small, "row_id", "k", "d") == want
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        large = J.dimension_join(left, right, ["k"])
        assert "_salt" in _plan(large)
        assert rows(large, "row_id", "k", "d") == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_measured_size(spark):
    df = spark.createDataFrame([("abc", [1.0, 2.0], 1), (None, None, None)], "s string, a array<double>, i int")
    n, size = measured_size(df)
    assert n == 2 and 60 <= size <= 120
    assert fits_broadcast(df)
    assert broadcast_limit(spark) == 10 * 1024 * 1024


def test_suffixes(spark):
    a = spark.createDataFrame([(1, 2, 3)], "k int, v int, a int")
    b = spark.createDataFrame([(1, 4, 5)], "k int, v int, b int")
    out = J.suffix_join(a, b, ["k"])
    assert out.columns == ["k", "v_x", "a", "v_y", "b"] and tuple(out.first()) == (1, 2, 3, 4, 5)


def test_assert_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError):
        J.assert_unique(df, ["k"])
    assert J.assert_unique(df, ["k", "v"]) is df


def test_alignment_after_a_fan_out(spark, rows):
    enriched = spark.createDataFrame([(0, "d1"), (0, "d2"), (1, "d3")], "row_id int, donor string")
    targets = spark.createDataFrame([(0, 10), (1, 11)], "row_id int, target int")
    by_id = J.concat_columns(enriched, targets)
    assert rows(by_id, "row_id", "donor", "target") == [(0, "d1", 10), (0, "d2", 10), (1, "d3", 11)]
    by_place = J.concat_columns(enriched, targets, "position", left_order=["row_id", "donor"])
    assert rows(by_place, "row_id", "donor", "target") == [(0, "d1", 10), (0, "d2", 11), (1, "d3", None)]
    longer = J.concat_columns(targets, enriched, "position", right_order=["row_id", "donor"])
    assert rows(longer, "target", "donor") == [(None, "d3"), (10, "d1"), (11, "d2")]
    with pytest.raises(ValueError):
        J.concat_columns(enriched, targets, "elsewhere")


def test_concat_keeps_both_sides_and_shared_names(spark, rows):
    a = spark.createDataFrame([(0, "p"), (1, "q")], "row_id int, v string")
    b = spark.createDataFrame([(1, "r"), (2, "s")], "row_id int, v string")
    assert rows(J.concat_columns(a, b), "row_id", "v_x", "v_y") == [(0, "p", None), (1, "q", "r"), (2, None, "s")]
    assert rows(J.concat_columns(a, b, how="left"), "row_id", "v_x", "v_y") == [(0, "p", None), (1, "q", "r")]
    side = J.concat_columns(a, b, "position")
    assert rows(side, "v_x", "v_y") == [("p", "r"), ("q", "s")]


def test_key_hits(spark, rows):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    dim = spark.createDataFrame([("a",), ("a",), ("c",)], "k string")
    assert rows(J.key_hits(left, dim, "k")) == [("a", 2, True), ("b", 1, False)]
    assert rows(J.hit_summary(left, dim, "k")) == [(False, 1, 1), (True, 1, 2)]
    assert rows(J.missing_keys(left, dim, "k")) == [("b",)]


@pytest.mark.parametrize("swap", [False, True])
def test_full_join_of_hot_ids_emits_each_lone_row_once(spark, no_broadcast, rows, swap):
    left, right = _skewed(spark)
    right = right.unionByName(spark.createDataFrame([("alone", 5), ("alone", 5), (None, 1)], "k string, d int"))
    one, other = (right, left) if swap else (left, right)
    out = J.skew_full_join(one, other, ["k"])
    assert "_salt" in _plan(out)
    assert out.columns == one.join(other, "k", "full").columns
    assert rows(out, "row_id", "k", "d") == rows(one.join(other, "k", "full"), "row_id", "k", "d")


def test_full_concat_spreads_the_hot_id(spark, no_broadcast):
    left, right = _skewed(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = J.concat_columns(left.withColumnRenamed("row_id", "x"), right, row_id="k").withColumn("p", F.spark_partition_id())
        sizes = [r["count"] for r in out.where("x IS NOT NULL").groupBy("p").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_full_join_without_hot_keys_is_plain(spark, no_broadcast, rows):
    left = spark.range(1000).withColumnRenamed("id", "k")
    right = spark.range(0, 2000, 2).select(F.col("id").alias("k"), F.lit(1).alias("d"))
    out = J.skew_full_join(left, right, ["k"])
    assert "_salt" not in _plan(out)
    assert rows(out) == rows(left.join(right, "k", "full"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_a_broadcast_list_per_key_gives_the_rows_of_the_join(spark, rows, how):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "k int, v string")
    right = spark.createDataFrame([(1, 10, None), (1, 11, 1.5), (1, 11, 1.5), (2, None, None), (None, 12, 2.0), (4, 13, 3.0)], "k int, d int, `x-y` double")
    out = J.dimension_join(left, right, ["k"], how, many=True)
    assert out.columns == ["k", "v", "d", "x-y"] and rows(out) == rows(left.join(right, "k", how))
    assert rows(J.dimension_join(left, right.select("k"), ["k"], how, many=True)) == rows(left.join(right.select("k"), "k", how))
    plan = J.dimension_join(left.sort("v"), right, ["k"], how, many=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan
