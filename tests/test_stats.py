import math

from pyspark.sql import functions as F

from assayloom.operators.profile import completeness, row_completeness
from assayloom.operators.stats import (
    agg_stats, first_seen, group_summary, mean_squared_error, regroup_stats, value_counts, value_shares,
)

LONG = "obs_id string, count double, normalized_count double"
META = "obs_id string, cell_type string, sm_name string"


def _assay(spark):
    long = spark.createDataFrame([
        ("o1", 1.0, 0.1), ("o1", 3.0, 0.3), ("o2", 8.0, 0.8),
        ("gone", 100.0, 1.0),                       # no metadata
        ("nokey", 50.0, 1.0),                       # metadata without a cell type
        ("nulls", None, 2.0), ("nulls", None, 4.0),  # nothing counted
        ("nan", float("nan"), 1.0), ("nan", 5.0, 1.0),
        (None, 7.0, 7.0),
    ], LONG)
    meta = spark.createDataFrame([
        ("o1", "T", "A"), ("o2", "T", "A"), ("nokey", None, "A"), ("nulls", "T", "N"), ("nan", "T", "Q"),
    ], META)
    return long, meta


def test_observation_stats(spark):
    long, _ = _assay(spark)
    for exact in (None, (18, 4)):
        got = {r.obs_id: tuple(r)[1:] for r in agg_stats(long, ["obs_id"], exact=exact).collect()}
        assert None not in got and set(got) == {"o1", "o2", "gone", "nokey", "nulls", "nan"}
        assert got["o1"][:2] == (2.0, 4.0) and math.isclose(got["o1"][2], 0.2) and math.isclose(got["o1"][3], 0.4)
        assert got["nulls"] == (None, 0.0, 3.0, 6.0)
        assert got["nan"][:2] == (5.0, 5.0)


def test_groups_take_the_mean_of_means(spark):
    long, meta = _assay(spark)
    got = {(r.cell_type, r.sm_name): r for r in group_summary(long, meta, "obs_id", ["cell_type", "sm_name"]).collect()}
    assert set(got) == {("T", "A"), ("T", "N"), ("T", "Q")}
    assert got["T", "A"].count_mean == 5.0 and got["T", "A"].count_sum == 12.0
    assert got["T", "N"].count_mean is None and got["T", "N"].count_sum == 0.0


def test_regroup_keeps_names(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0)], "k string, count_mean double, count_sum double")
    assert regroup_stats(df, ["k"], {"count_mean": "mean", "count_sum": "sum"}).columns == ["k", "count_mean", "count_sum"]


def test_exact_sums_do_not_depend_on_order(spark):
    df = spark.range(10_000).select(F.lit("k").alias("k"), (F.col("id") * 0.01).alias("m"))
    a = agg_stats(df, ["k"], {"m": ["sum", "mean"]}, (18, 4)).first()
    b = agg_stats(df.orderBy(F.desc("m")).repartition(7), ["k"], {"m": ["sum", "mean"]}, (18, 4)).first()
    assert a == b and a.m_sum == 499950.0


def test_only_needed_columns_are_read(spark, tmp_path):
    path = str(tmp_path / "long")
    spark.range(10).select(F.col("id").alias("obs_id"), F.lit(1.0).alias("count"), F.lit(2.0).alias("normalized_count"),
                           F.lit("x").alias("gene")).write.parquet(path)
    plan = agg_stats(spark.read.parquet(path), ["obs_id"])._jdf.queryExecution().toString()
    assert "ReadSchema: struct<obs_id:bigint,count:double,normalized_count:double>" in plan
    assert "partial_avg" in plan
    assert "PushedFilters: [IsNotNull(obs_id)]" in plan


def test_grouped_observations_are_not_shuffled_again_for_the_join(spark, no_broadcast):
    long, meta = _assay(spark)
    plan = group_summary(long, meta, "obs_id", ["cell_type", "sm_name"])._jdf.queryExecution().executedPlan().toString()
    # measurements by observation, metadata by observation, groups
    assert plan.count("Exchange hashpartitioning") == 3 and "Join Inner" in plan or "], Inner" in plan


def test_value_counts_and_shares(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "s string")
    assert [tuple(r) for r in value_counts(df, "s").collect()] == [("b", 2), ("a", 1), ("c", 1)]
    assert {r.s: r.percent for r in value_shares(df, "s").collect()} == {"a": 25.0, "b": 50.0, "c": 25.0}


def test_first_seen_keeps_null(spark):
    df = spark.createDataFrame([(0, "b"), (1, None), (2, "a"), (3, "b")], "row_id int, s string")
    assert [r.s for r in first_seen(df, "s").collect()] == ["b", None, "a"]


def test_mean_squared_error(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0, 4.0]), ([0.0, 0.0], [2.0, 0.0])], "p array<double>, t array<double>")
    assert mean_squared_error(df, "p", "t").first().mse == 2.0
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 2.0)], "p double, t double")
    assert mean_squared_error(df, "p", "t").first().mse == 2.0


def test_completeness(spark, rows):
    df = spark.createDataFrame([(1, None, float("nan")), (2, "x", 1.0)], "i int, s string, d double")
    assert rows(completeness(df)) == [("d", 1, 1), ("i", 2, 0), ("s", 1, 1)]
    assert rows(row_completeness(df)) == [(1, 1), (3, 1)]
