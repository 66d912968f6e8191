import numpy as np
import pytest

from pyspark.sql import functions as F

from assayloom.operators import regress as R


def _data(spark, n=400, d=3, m=5):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, d))
    y = x @ rng.normal(size=(d, m)) + rng.normal(size=m) + 0.1 * rng.normal(size=(n, m))
    flag = (np.arange(n) % 2).astype(float)
    y = y + 2.0 * flag[:, None]
    rows = [(i, x[i].tolist(), y[i].tolist(), float(flag[i]), *map(float, x[i]), float(y[i, 0])) for i in range(n)]
    df = spark.createDataFrame(
        rows, "i int, x array<double>, y array<double>, flag double, x0 double, x1 double, x2 double, y0 double")
    return df.repartition(5), x, y, flag


def _ridge(x, y, reg):
    a = np.hstack([np.ones((len(x), 1)), x])
    p = np.diag([0.0] + [reg] * x.shape[1])
    return np.linalg.solve(a.T @ a + p, a.T @ y)


@pytest.mark.parametrize("block", [2, 1024])
def test_ridge_equals_the_closed_form(spark, block):
    df, x, y, _ = _data(spark)
    model = R.fit_ridge(df, "x", "y", 2.0, block).orderBy("target").collect()
    want = _ridge(x, y, 2.0)
    np.testing.assert_allclose([r.intercept for r in model], want[0])
    np.testing.assert_allclose([r.coef for r in model], want[1:].T)


@pytest.mark.parametrize("max_bytes", [None, 64])
def test_ridge_scores_in_target_order(spark, max_bytes):
    df, x, y, _ = _data(spark)
    scored = R.score_ridge(df, R.fit_ridge(df, "x", "y", 2.0), "x", max_bytes=max_bytes).orderBy("i").collect()
    beta = _ridge(x, y, 2.0)
    np.testing.assert_allclose([r.prediction for r in scored], beta[0] + x @ beta[1:])


def test_linear_equals_least_squares(spark):
    df, x, y, _ = _data(spark)
    intercept, slopes = R.linear_coefficients(R.fit_linear(df, ["x0", "x1", "x2"], "y0"))
    want = _ridge(x, y[:, :1], 0.0)[:, 0]
    np.testing.assert_allclose([intercept, *slopes], want, rtol=1e-9)
    by_vector = R.fit_linear_vector(df, "x", "y0")
    np.testing.assert_allclose([*by_vector.coefficients], want[1:], rtol=1e-6)


def test_second_stage_uses_the_flag(spark):
    df, _, y, _ = _data(spark)
    scored = R.score_stacked(R.fit_stacked(df, ["x0", "x1", "x2"], "flag", "y0"), df)
    losses = {r.stage: r.loss for r in R.stage_losses(scored, "y0", ["base_prediction", "prediction"]).collect()}
    assert losses["prediction"] < 0.2 * losses["base_prediction"] < np.var(y[:, 0])


def test_second_stage_of_many_outputs(spark):
    df, _, y, _ = _data(spark)
    models = R.fit_stacked_ridge(df, "x", "flag", "y", 0.1)
    scored = R.score_stacked_ridge(models, df, "x", "flag").orderBy("i").collect()
    base = np.mean((np.array([r.base_prediction for r in scored]) - y) ** 2)
    second = np.mean((np.array([r.prediction for r in scored]) - y) ** 2)
    assert second < 0.2 * base < np.var(y)


def test_boosted_beats_the_mean(spark):
    df, _, y, _ = _data(spark)
    model = R.fit_boosted(df, ["x0", "x1", "x2", "flag"], "y0", rounds=5, depth=3)
    scored = R.score(model, df, ["i", "y0"])
    assert R.stage_losses(scored, "y0", ["prediction"]).first().loss < np.var(y[:, 0])


def test_objective_history_falls(spark):
    df, *_ = _data(spark)
    model = R.fit_linear(df, ["x0", "x1", "x2"], "y0", solver="l-bfgs", max_iter=10)
    losses = [r.loss for r in R.objective_history(spark, "base", model).orderBy("epoch").collect()]
    assert len(losses) > 1 and losses[-1] <= losses[0]


def test_second_stage_equals_its_direct_solution(spark):
    """Closed form against a penalised fit on all stage-one predictions and the flag."""
    df, *_ = _data(spark)
    rows = df.orderBy("i").select("x", "flag", "y").collect()
    x, f, y = np.array([r.x for r in rows]), np.array([float(r.flag) for r in rows]), np.array([r.y for r in rows])

    def ridge(z, t, reg):
        zc, tc = z - z.mean(0), t - t.mean(0)
        return t.mean(0) + zc @ np.linalg.solve(zc.T @ zc + reg * np.eye(z.shape[1]), zc.T @ tc)

    base = ridge(x, y, 0.1)
    want = ridge(np.column_stack([base, f]), y, 0.1)
    models = R.fit_stacked_ridge(df, "x", "flag", "y", 0.1)
    got = R.score_stacked_ridge(models, df, "x", "flag").orderBy("i").collect()
    assert np.allclose([r.base_prediction for r in got], base)
    assert np.allclose([r.prediction for r in got], want)


def test_two_stages_at_full_width(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.random(3).tolist(), i % 2, rng.random(18211).tolist()) for i in range(20)]
    df = spark.createDataFrame(rows, "i int, x array<double>, flag int, y array<double>").repartition(4)
    scored = R.score_stacked_ridge(R.fit_stacked_ridge(df, "x", "flag", "y", 0.1), df, "x", "flag")
    assert scored.select(F.size("prediction").alias("n")).distinct().first().n == 18211


def test_missing_entries_in_a_fit(spark):
    df, *_ = _data(spark)
    hole = df.withColumn("x", F.when(F.col("i") == 0, F.array(F.lit(None).cast("double"), F.lit(1.0), F.lit(1.0))).otherwise(F.col("x")))
    with pytest.raises(Exception, match="missing"):
        R.fit_ridge(hole, "x", "y").collect()
    left = R.fit_ridge(hole, "x", "y", missing="drop").orderBy("target").collect()
    want = R.fit_ridge(df.where("i <> 0"), "x", "y").orderBy("target").collect()
    assert np.allclose([r.coef for r in left], [r.coef for r in want])


@pytest.mark.parametrize("parts", [1, 3])
@pytest.mark.parametrize("rows", [
    [([1.0], [1.0]), ([1.0, 2.0], [1.0]), ([1.0, 2.0, 3.0], [1.0])],
    [([1.0], [1.0, 2.0]), ([2.0], [1.0, 2.0]), ([3.0], [1.0])],
])
def test_arrays_of_different_lengths_are_an_error(spark, rows, parts):
    df = spark.createDataFrame(rows, "features array<double>, targets array<double>").repartition(parts)
    with pytest.raises(Exception, match="different lengths"):
        R.ridge_sums(df, "features", "targets").collect()


@pytest.mark.parametrize("block", [2, 1024])
@pytest.mark.parametrize("flag", [None, "flag"])
def test_steps_end_at_the_closed_form(spark, block, flag):
    df, x, y, _ = _data(spark)
    models, history = R.fit_ridge_steps(df, "x", "y", 2.0, flag, block=block)
    want = [R.fit_ridge(df, "x", "y", 2.0)] if flag is None else list(R.fit_stacked_ridge(df, "x", "flag", "y", 2.0))
    assert len(models) == len(want)
    for got, closed in zip(models, want):
        got, closed = got.orderBy("target").collect(), closed.orderBy("target").collect()
        np.testing.assert_allclose([r.coef for r in got], [r.coef for r in closed], rtol=1e-6, atol=1e-9)
        np.testing.assert_allclose([r.intercept for r in got], [r.intercept for r in closed], rtol=1e-6, atol=1e-9)
    losses = {(r.stage, r.epoch): r.loss for r in history.collect()}
    assert len(losses) == 4 if flag is None else len(losses) == 4 + 5
    np.testing.assert_allclose(losses["base", 0], ((y - y.mean(0)) ** 2).mean())
    beta = _ridge(x, y, 2.0)
    np.testing.assert_allclose(losses["base", 3], ((y - beta[0] - x @ beta[1:]) ** 2).mean())
    assert all(losses[s, e] >= losses[s, e + 1] - 1e-12 for s, e in losses if (s, e + 1) in losses)


def test_steps_without_spread_or_rows(spark):
    flat = spark.createDataFrame([(1.0, 2.0)] * 5, "a double, b double").select(F.array("a").alias("x"), F.array("b").alias("y"))
    models, history = R.fit_ridge_steps(flat, "x", "y", 1.0, steps=3)
    row = models[0].first()
    assert (row.coef, row.intercept) == ([0.0], 2.0)
    assert [r.loss for r in history.orderBy("epoch").collect()] == [0.0] * 4
    with pytest.raises(ValueError, match="no rows"):
        R.fit_ridge_steps(flat.limit(0), "x", "y")


def test_trees_grow_on_pieces_of_bounded_size(spark, monkeypatch):
    df = spark.createDataFrame([(float(i % 7), float(i % 3), float(i)) for i in range(400)], "a double, b double, y double")
    given = []
    monkeypatch.setattr(R, "_TREE_ROWS", 60, raising=False)
    monkeypatch.setattr(R.Pipeline, "fit", lambda self, rows: given.append(rows))
    R.fit_boosted(df.coalesce(1), ["a", "b"], "y", rounds=1, depth=2)
    R.fit_boosted(df.repartition(40), ["a", "b"], "y", rounds=1, depth=2)
    pieces = [given[0].rdd.glom().map(len).collect(), given[1].rdd.glom().map(len).collect()]
    assert [sum(p) for p in pieces] == [400, 400] and max(pieces[0]) <= 66 and len(pieces[1]) == 40
    assert sorted(map(tuple, given[0].collect())) == sorted(map(tuple, df.collect()))
