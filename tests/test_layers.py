import glob

import numpy as np
import pytest

from pyspark.sql import functions as F

from assayloom.operators import layers as N
from assayloom.operators import regress as R
from assayloom.session import shared_dir


def _bent(spark, n=600):
    """A target that bends: no line through the features comes near it."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 3))
    flag = (np.arange(n) % 2).astype(float)
    y = np.column_stack([np.abs(x[:, 0]) + x[:, 1], 10 * np.maximum(x[:, 2], 0) + 5 * flag])
    df = spark.createDataFrame(
        [(i, x[i].tolist(), y[i].tolist(), float(flag[i])) for i in range(n)], "i int, x array<double>, y array<double>, flag double")
    return df.repartition(4, "i"), x, y, flag


def _loop(model, x, y, flag, epochs, rate):
    """The same descent in one process, with the gradient by differences."""
    x, y = (x - x.mean(0)) / x.std(0), (y - y.mean(0)) / y.std(0)

    def loss(flat):
        return ((model.moved(flat).run(x, flag)[1] - y) ** 2).mean()

    flat = model.flat()
    m = v = np.zeros(len(flat))
    losses = [loss(flat)]
    for t in range(1, epochs + 1):
        g = np.array([(loss(flat + d) - loss(flat - d)) / 2e-6 for d in 1e-6 * np.eye(len(flat))])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        flat = flat - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        losses.append(loss(flat))
    return losses


@pytest.mark.parametrize("second, piece", [(None, 5), ((3,), 1 << 16)])
def test_steps_equal_numeric_gradients(spark, monkeypatch, second, piece):
    monkeypatch.setattr(N, "_PIECE", piece)
    monkeypatch.setattr(N, "_CELLS", 40)
    df, x, y, flag = _bent(spark, 80)
    stage = {} if second is None else {"flag": "flag", "second": second}
    start, _ = N.fit_layers(df, "x", "y", (4, 3), epochs=0, seed=2, **stage)
    _, history = N.fit_layers(df, "x", "y", (4, 3), epochs=4, rate=0.01, seed=2, **stage)
    got = [r.loss for r in history.orderBy("epoch").collect()]
    np.testing.assert_allclose(got, _loop(start, x, y, flag, 4, 0.01), rtol=1e-5)


def test_a_bent_target_beats_the_line_and_repeats(spark):
    df, x, y, flag = _bent(spark)
    model, history = N.fit_layers(df, "x", "y", (16,), "flag", (8,), epochs=40, rate=0.04)
    losses = [r.loss for r in history.orderBy("epoch").collect()]
    assert len(losses) == 41 and losses[-1] < 0.2 * losses[0]
    scored = N.score_layers(df, model, "x", "flag").orderBy("i").collect()
    own = (np.array([r.prediction for r in scored]) - y) ** 2
    np.testing.assert_allclose((own / y.var(0)).mean(), losses[-1], rtol=1e-9)
    line = R.score_ridge(df, R.fit_ridge(df, "x", "y", 0.0), "x").orderBy("i").collect()
    assert (own.mean(0) < 0.5 * ((np.array([r.prediction for r in line]) - y) ** 2).mean(0)).all()
    again, _ = N.fit_layers(df, "x", "y", (16,), "flag", (8,), epochs=40, rate=0.04)
    np.testing.assert_allclose(again.flat(), model.flat(), rtol=1e-4, atol=1e-6)


def test_no_hidden_layer_is_a_line(spark):
    df, x, y, _ = _bent(spark, 200)
    model, _ = N.fit_layers(df, "x", "y", (), epochs=200, rate=0.05)
    a = np.column_stack([np.ones(len(x)), x])
    want = a @ np.linalg.lstsq(a, y, rcond=None)[0]
    got = np.array([r.prediction for r in N.score_layers(df, model, "x").orderBy("i").collect()])
    assert np.abs(got - want).max() < 0.02 * y.std()


def test_missing_values_and_wrong_shapes(spark):
    df, *_ = _bent(spark, 40)
    hole = df.withColumn("x", F.when(F.col("i") == 0, F.array(F.lit(None).cast("double"), F.lit(1.0), F.lit(1.0))).otherwise(F.col("x")))
    with pytest.raises(Exception, match="missing"):
        N.fit_layers(hole, "x", "y", (2,), epochs=1)
    model, history = N.fit_layers(hole, "x", "y", (2,), epochs=1, missing="drop")
    whole, _ = N.fit_layers(df.where("i <> 0"), "x", "y", (2,), epochs=1)
    np.testing.assert_allclose(model.flat(), whole.flat(), rtol=1e-6)
    scored = {r.i: r.prediction for r in N.score_layers(hole, model, "x").collect()}
    assert scored[0] is None and len(scored[1]) == 2
    short = df.withColumn("y", F.when(F.col("i") == 3, F.slice("y", 1, 1)).otherwise(F.col("y")))
    with pytest.raises(Exception, match="different lengths"):
        N.fit_layers(short, "x", "y", (2,), epochs=1)
    for bad in (df.where("i < 0"), df.withColumn("x", F.expr("slice(x, 1, 0)"))):
        with pytest.raises(ValueError):
            N.fit_layers(bad, "x", "y", (2,), epochs=1)
    with pytest.raises(ValueError, match="bytes"):
        N.fit_layers(df, "x", "y", (2,), epochs=1, max_bytes=8)
    with pytest.raises(ValueError, match="second stage"):
        N.fit_layers(df, "x", "y", (2,), flag="flag")


def test_stored_chunks_stay_small_and_a_constant_has_no_spread(spark):
    """Readers, writers and batches hold thousands of chunks, so a chunk may not grow with its task's rows."""
    df = spark.range(0, 20_000, 1, 1).selectExpr("array(0.1D, cast(id % 7 AS double)) AS x", "array(cast(id % 5 AS double)) AS y")
    folder = shared_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{folder}/layer-*"))
    model, history = N.fit_layers(df, "x", "y", (2,), epochs=0)
    stored = [spark.read.parquet(d) for d in set(glob.glob(f"{folder}/layer-*")) - before]
    chunks = [d for d in stored if "rows" in d.columns]
    assert len(chunks) == 1 and chunks[0].agg(F.max(F.octet_length("rows"))).first()[0] <= 4096
    np.testing.assert_allclose(model.shift, [0.1, np.mean(np.arange(20_000) % 7)])
    np.testing.assert_allclose(model.scale, [1.0, np.std(np.arange(20_000) % 7)])
    x, y = np.column_stack([np.full(20_000, 0.1), np.arange(20_000) % 7]), np.arange(20_000)[:, None] % 5
    error = model.run((x - model.shift) / model.scale, None)[1] - (y - y.mean()) / y.std()
    np.testing.assert_allclose(history.first().loss, (error ** 2).mean(), rtol=1e-9)
