import hashlib
import math

import pytest

from pyspark.sql import functions as F

from assayloom.operators import split as S


def _first(ids, seed, k):
    return set(sorted(ids, key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())[:k])


@pytest.mark.parametrize("k", [0, 1, 17, 4999, 5000])
def test_sample_is_exact_and_reproducible(spark, k):
    df = spark.range(5000)
    got = {r.id for r in S.exact_sample(df, ["id"], k, "s").collect()}
    assert got == _first(range(5000), "s", k)
    assert got == {r.id for r in S.exact_sample(df.repartition(3), ["id"], k, "s").collect()}


def test_sample_beyond_one_counting_round(spark, monkeypatch):
    monkeypatch.setattr(S, "_FINAL", 1)
    monkeypatch.setattr(S, "_DIGITS", 1)
    got = {r.id for r in S.exact_sample(spark.range(2000), ["id"], 777, 3).collect()}
    assert got == _first(range(2000), 3, 777)


def test_sample_larger_than_the_table(spark):
    with pytest.raises(ValueError):
        S.exact_sample(spark.range(3), ["id"], 4, 1)


def test_the_split_is_a_comparison(spark):
    plan = S.two_way_split(spark.range(100), ["id"], 0.2, 42)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_two_way_and_nested_sizes(spark):
    df = spark.range(25)
    sizes = {r.split: r["count"] for r in S.two_way_split(df, ["id"], 0.2, 42).groupBy("split").count().collect()}
    assert sizes == {"test": 5, "train": 20}
    nested = S.nested_split(df, ["id"], 0.2, 0.1, 42)
    sizes = {r.split: r["count"] for r in nested.groupBy("split").count().collect()}
    assert sizes == {"test": 5, "val": 2, "train": 18} and nested.count() == 25


def _cells(spark):
    return spark.range(45).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") < 25, "major").when(F.col("id") < 40, "minor").otherwise("other").alias("g"))


def test_group_holdout_three_way(spark):
    out = S.group_holdout(_cells(spark), ["row_id"], "g", ["major"], ["minor"], 1, test_fraction=0.2, val_fraction=0.1)
    sizes = {(r.g, r.split): r["count"] for r in out.groupBy("g", "split").count().collect()}
    assert sizes == {("major", "test"): 5, ("major", "val"): 2, ("major", "train"): 18,
                     ("minor", "train"): 1, ("minor", "test"): 14}


def test_group_holdout_two_way(spark):
    out = S.group_holdout(_cells(spark), ["row_id"], "g", ["major"], ["minor"], 1)
    sizes = {(r.g, r.split): r["count"] for r in out.groupBy("g", "split").count().collect()}
    assert sizes == {("major", "train"): 25, ("minor", "train"): 1, ("minor", "test"): 14}
    assert out.select("row_id").distinct().count() == out.count() == 40


def test_sizes_follow_float_arithmetic():
    assert S.floor_of(0.1)(15) == 1 and S.ceil_of(0.2)(25) == 5 and S.ceil_of(0.1)(3) == math.ceil(0.1 * 3)


def test_split_summary(spark, rows):
    df = spark.createDataFrame([(s, [1.0, 2.0], [3.0]) for s in ("train", "train", "test", "val")],
                               "split string, x array<double>, y array<double>")
    assert rows(S.split_summary(df, "x", "y")) == [
        ("n_features", 2), ("n_targets", 1), ("n_test", 1), ("n_train", 2), ("n_val", 1)]


def test_validation_without_test(spark):
    df = spark.range(40).select("id", F.when(F.col("id") < 30, "a").otherwise("b").alias("g"))
    got = {r.split: r["count"] for r in S.group_holdout(df, ["id"], "g", ["a"], ["b"], 1, 0.1, 0.0, 0.2).groupBy("split").count().collect()}
    assert got == {"val": 6, "train": 25, "test": 9}


def test_a_draw_among_repeated_ids_is_an_error(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (2,)], "id long")
    with pytest.raises(ValueError):
        S.exact_sample(df, ["id"], 1, 0)


@pytest.mark.parametrize("draw", [
    lambda df, seed: S.two_way_split(df, ["id"], 0.1, seed),
    lambda df, seed: S.nested_split(df, ["id"], 0.1, 0.1, seed),
    lambda df, seed: S.group_holdout(df, ["id"], "g", ["a"], ["b"], seed, test_fraction=0.1),
])
def test_repeated_ids_never_change_the_sizes_silently(spark, draw):
    """One id has half of the rows: a draw takes them all or none, or refuses."""
    df = spark.createDataFrame([(0 if i < 50 else i, "a") for i in range(100)], "id long, g string")
    refused = 0
    for seed in range(40):
        if refused:
            break
        try:
            n = draw(df, seed).where("split = 'test'").count()
        except ValueError:
            refused += 1
        else:
            assert n == 10
    assert refused


@pytest.mark.parametrize("known", [False, True])
def test_a_draw_makes_every_key_once(spark, known):
    n, made = 20_000, spark.sparkContext.accumulator(0)

    def key(i):
        made.add(1)
        return hashlib.md5(f"s:{i}".encode()).hexdigest()

    cut = S.kth_key(spark.range(n), F.udf(key)("id"), S.floor_of(0.3), n if known else None)
    assert cut == sorted(hashlib.md5(f"s:{i}".encode()).hexdigest() for i in range(n))[5999]
    assert made.value == n


def test_a_cut_far_from_its_expected_place(spark):
    """Half of the rows share the id with the smallest key."""
    by_key = sorted(range(1501), key=lambda i: hashlib.md5(f"s:{i}".encode()).hexdigest())
    df = spark.createDataFrame([(i,) for i in by_key + [by_key[0]] * 1499], "id long")
    cut = S.kth_key(df, S.draw_key(["id"], "s"), lambda n: 1510)
    assert cut == hashlib.md5(f"s:{by_key[10]}".encode()).hexdigest()
    with pytest.raises(ValueError):
        S.kth_key(df, S.draw_key(["id"], "s"), lambda n: 700)
