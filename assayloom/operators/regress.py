"""Squared-error regression: one output, many outputs, two stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.session import broadcast_limit, materialise

_GRAM = -1           # block number of the feature-by-feature sums
_SQUARES = -2        # block number of the targets' sums of squares
_BLOCK = 1024        # targets per block of the feature-by-target sums
_TREE_ROWS = 1 << 19 # rows of a piece that trees are grown on; the trainer holds some 300 bytes of each


# ---- one output -----------------------------------------------------------

def fit_linear(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    prediction: str = "prediction",
    reg: float = 0.0,
    max_iter: int = 100,
    solver: str = "auto",
) -> PipelineModel:
    """Linear regression on scalar columns. Rows with a missing feature are an error.

    Features are centred and scaled first: a feature with a large mean and a
    small spread, such as an earlier stage's prediction, would otherwise cost
    the solution several digits.
    """
    raw, scaled = f"_{prediction}_in", f"_{prediction}_scaled"
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol=raw, handleInvalid="error"),
        StandardScaler(inputCol=raw, outputCol=scaled, withMean=True, withStd=True),
        LinearRegression(featuresCol=scaled, labelCol=label, predictionCol=prediction,
                         regParam=reg, maxIter=max_iter, solver=solver),
    ]).fit(df)


def linear_coefficients(model: PipelineModel) -> tuple[float, list[float]]:
    """(intercept, coefficients) of ``fit_linear`` in the features' own units."""
    scaler, fitted = model.stages[1], model.stages[2]
    slopes = [float(c / s) if s else 0.0 for c, s in zip(fitted.coefficients, scaler.std)]
    return float(fitted.intercept - sum(b * m for b, m in zip(slopes, scaler.mean))), slopes


def _bounded_pieces(df: DataFrame, most: int) -> DataFrame:
    """``df`` itself, or dealt out evenly if one of its pieces has more than ``most`` rows."""
    sizes = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
    found = sizes.agg(F.max("n").alias("largest"), F.sum("n").alias("n")).first()
    return df.repartition(-(-found["n"] // most)) if (found["largest"] or 0) > most else df


def fit_boosted(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    prediction: str = "prediction",
    rounds: int = 20,
    depth: int = 5,
    seed: int = 0,
) -> PipelineModel:
    """Gradient-boosted trees on scalar columns; missing features stay missing (NaN).

    The trainer keeps its rows in the pieces they come in and reads a whole piece per
    task and step, so rows in pieces of more than ``_TREE_ROWS`` are dealt out anew.
    """
    vector = f"_{prediction}_in"
    df = _bounded_pieces(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*features, label])]), _TREE_ROWS)
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol=vector, handleInvalid="keep"),
        GBTRegressor(featuresCol=vector, labelCol=label, predictionCol=prediction,
                     maxIter=rounds, maxDepth=depth, seed=seed),
    ]).fit(df)


def fit_linear_vector(df: DataFrame, vec: str, label: str, prediction: str = "prediction", reg: float = 0.0):
    """Linear regression on an array column."""
    ready = df.withColumn("_vec", array_to_vector(vec))
    return LinearRegression(featuresCol="_vec", labelCol=label, predictionCol=prediction, regParam=reg).fit(ready)


def score(model, df: DataFrame, keep: Sequence[str], prediction: str = "prediction") -> DataFrame:
    """``keep`` columns plus the prediction."""
    return model.transform(df).select(*[F.col(f"`{c}`") for c in keep], prediction)


def objective_history(spark: SparkSession, stage: str, model: PipelineModel) -> DataFrame:
    """(stage, epoch, loss) of an iterative fit: one line per optimiser step."""
    history = model.stages[-1].summary.objectiveHistory
    rows = [(stage, i, float(v)) for i, v in enumerate(history)]
    return spark.createDataFrame(rows, "stage string, epoch int, loss double")


def stage_losses(df: DataFrame, truth: str, predictions: Sequence[str]) -> DataFrame:
    """(stage, epoch, loss): mean squared error of each stage's prediction, in one pass."""
    def mse(p):
        d = F.col(p).cast("double") - F.col(truth).cast("double")
        return F.avg(d * d)

    one = df.agg(*[mse(p).alias(p) for p in predictions])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(p).alias("stage"), F.lit(i).alias("epoch"), F.col(p).alias("loss"))
        for i, p in enumerate(predictions)
    ])))


# ---- many outputs ---------------------------------------------------------

def all_present(name: str) -> Column:
    """Whether an array column is neither null nor holds a null or NaN."""
    # Whether an array holds a value is null if it holds a null and not the value.
    return F.coalesce(~F.array_contains(F.col(f"`{name}`").cast("array<double>"), F.lit(float("nan"))), F.lit(False))


def ridge_sums(
    df: DataFrame, features: str, targets: str, block: int = _BLOCK, missing: str = "error"
) -> DataFrame:
    """(i, block, sums): feature-by-feature and feature-by-target sums of products.

    Each task adds up its own rows batch by batch and emits one set of sums; a
    second stage adds the sets, each (i, block) in one place. What is shuffled
    and held has the size of the model, never of the data. Row i = 0 belongs to
    the constant term. The targets' own sums of squares come along, with the target
    block in ``i``. A row with a null or NaN in either array, or a null array,
    is an error, or left out with ``missing="drop"``. Arrays of one column that
    differ in length are an error.
    """
    if missing not in ("error", "drop"):
        raise ValueError(f"missing must be 'error' or 'drop', not {missing!r}")

    usable = all_present(features) & all_present(targets)
    if missing == "drop":
        df = df.where(usable)
    else:
        df = df.where(F.when(usable, True).otherwise(F.raise_error(F.lit("a feature or target is missing")).cast("boolean")))

    def partial(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        gram = cross = squares = None
        for batch in batches:
            if not batch.num_rows:
                continue
            for name, c in zip((features, targets), batch.columns):
                lengths = set(pc.unique(pc.list_value_length(c)).to_pylist())
                if len(lengths) > 1:
                    raise ValueError(f"{name} has arrays of different lengths: {sorted(lengths)}")
            if gram is not None and (len(gram) - 1, cross.shape[1]) != tuple(len(c[0]) for c in batch.columns):
                raise ValueError(f"{features} or {targets} has arrays of different lengths")
            x, y = (
                c.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(batch.num_rows, -1)
                for c in batch.columns
            )
            x = np.hstack([np.ones((len(x), 1)), x])
            if gram is None:
                gram = np.zeros((x.shape[1], x.shape[1]))
                cross = np.zeros((x.shape[1], y.shape[1]))
                squares = np.zeros(y.shape[1])
            gram += x.T @ x
            cross += x.T @ y
            squares += (y * y).sum(axis=0)
        if gram is None:
            return
        starts = list(enumerate(range(0, cross.shape[1], block)))
        for i in range(-1, len(gram)):
            if i < 0:
                rows = [(b, _SQUARES, squares[s:s + block]) for b, s in starts] or [(0, _SQUARES, squares)]
            else:
                rows = [(i, _GRAM, gram[i]), *((i, b, cross[i, s:s + block]) for b, s in starts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2].tolist() for r in rows], pa.list_(pa.float64()))],
                names=["i", "block", "sums"],
            )

    def combine(batches):
        import numpy as np
        import pandas as pd

        held = {}
        for pdf in batches:
            for i, b, s in zip(pdf["i"], pdf["block"], pdf["sums"]):
                if (i, b) in held:
                    if len(held[i, b]) != len(s):
                        raise ValueError(f"{features} or {targets} has arrays of different lengths")
                    held[i, b] += s
                else:
                    held[i, b] = np.array(s, dtype="float64")
        yield pd.DataFrame({
            "i": pd.Series([k[0] for k in held], dtype="int32"),
            "block": pd.Series([k[1] for k in held], dtype="int32"),
            "sums": pd.Series(list(held.values()), dtype=object),
        })

    schema = "i int, block int, sums array<double>"
    parts = df.select(features, targets).mapInArrow(partial, schema)
    return parts.repartition("i", "block").mapInPandas(combine, schema)


def _gram(sums: DataFrame):
    """The feature-by-feature sums, constant term first."""
    import numpy as np

    rows = sums.where(F.col("block") == _GRAM).orderBy("i").collect()
    return np.array([r["sums"] for r in rows], dtype="float64")


def fit_ridge(
    df: DataFrame, features: str, targets: str, reg: float = 1.0, block: int = _BLOCK, missing: str = "error"
) -> DataFrame:
    """(target, coef, intercept) of least squares with an L2 penalty on the coefficients.

    Only the feature-by-feature matrix comes to the driver; each block of
    targets is solved by its own task. ``missing`` as in ``ridge_sums``.
    """
    sums = materialise(ridge_sums(df, features, targets, block, missing), "ridge-sums")
    return _solve_ridge(sums, _gram(sums), reg, block)


def _solve_ridge(sums: DataFrame, gram, reg: float, block: int) -> DataFrame:
    """Coefficients on the first len(gram) - 1 features of the sums."""
    import numpy as np

    size = len(gram)
    penalty = np.full(len(gram), float(reg))
    if len(penalty):
        penalty[0] = 0.0
    shared = sums.sparkSession.sparkContext.broadcast(gram + np.diag(penalty))

    def solve(pdf):
        import numpy as np
        import pandas as pd

        cross = np.array(pdf.sort_values("i")["sums"].tolist(), dtype="float64")[:size]
        beta = np.linalg.solve(shared.value, cross)
        start = int(pdf["block"].iloc[0]) * block
        return pd.DataFrame({
            "target": np.arange(start, start + beta.shape[1], dtype="int32"),
            "coef": list(beta[1:].T),
            "intercept": beta[0],
        })

    # A group is (features + 1) rows of one block: bounded by the model.
    blocks = sums.where(F.col("block") > _GRAM)
    return blocks.groupBy("block").applyInPandas(solve, "target int, coef array<double>, intercept double")


def score_ridge(
    df: DataFrame, model: DataFrame, features: str, out: str = "prediction", max_bytes: int | None = None
) -> DataFrame:
    """Add an array of predictions, one per target in target order.

    Coefficients go to the tasks in pieces of at most ``max_bytes`` (by default
    the session's broadcast limit); each piece adds its own stretch of outputs.
    """
    spark = df.sparkSession
    limit = max_bytes or max(broadcast_limit(spark), 1 << 20)
    model = materialise(model, "coefficients")
    head = model.agg(F.count(F.lit(1)).alias("m"), F.max(F.size("coef")).alias("d")).first()
    m, d = head["m"], head["d"] or 0
    per_piece = max(1, int(limit // (8 * (d + 1))))
    pieces = []
    for s in range(0, m, per_piece):
        rows = model.where((F.col("target") >= s) & (F.col("target") < s + per_piece)).orderBy("target").collect()
        df = _score_piece(df, rows, features, f"_piece{len(pieces)}")
        pieces.append(f"_piece{len(pieces)}")
    return df.withColumn(out, F.concat(*pieces)).drop(*pieces)


def _score_piece(df: DataFrame, rows, features: str, out: str) -> DataFrame:
    from assayloom.functions.vectors import affine_many

    return affine_many(df, features, [r["coef"] for r in rows], [r["intercept"] for r in rows], out)


def _conjugate_steps(matrix, right, centred, cross, squares, inner, n: float, steps: int):
    """(unknowns, loss of each target before the first step and after each) of matrix @ v = right, column by column.

    The loss is the mean squared error of the coefficients inner @ v, from the
    centred sums of products ``centred``, ``cross`` and ``squares``.
    """
    import numpy as np

    def loss(v):
        w = inner @ v
        return (squares - 2 * (w * cross).sum(axis=0) + (w * (centred @ w)).sum(axis=0)) / n

    def ratio(a, b):
        return np.divide(a, b, out=np.zeros_like(a), where=b > 0)

    diagonal = np.diag(matrix).copy()
    diagonal[diagonal <= 0] = 1.0
    v, left = np.zeros_like(right), right.copy()
    ready = left / diagonal[:, None]
    way, size = ready.copy(), (left * ready).sum(axis=0)
    still = size * 1e-28
    losses = [loss(v)]
    for _ in range(steps):
        ahead = matrix @ way
        far = np.where(size > still, ratio(size, (way * ahead).sum(axis=0)), 0.0)
        v = v + far * way
        left = left - far * ahead
        ready = left / diagonal[:, None]
        before, size = size, (left * ready).sum(axis=0)
        way = ready + ratio(size, before) * way
        losses.append(loss(v))
    return v, np.array(losses)


def fit_ridge_steps(
    df: DataFrame, features: str, targets: str, reg: float = 1.0, flag: str | None = None, steps: int | None = None,
    block: int = _BLOCK, missing: str = "error",
) -> tuple[list[DataFrame], DataFrame]:
    """The models of ``fit_ridge``, or with a ``flag`` of ``fit_stacked_ridge``, by conjugate gradients, with their losses.

    All steps work on one pass's sums, in a task for each block of targets. The
    second result is (stage, epoch, loss): the mean squared error over all targets
    before the first step and after each. As many steps as there are features
    (the default) reach the closed form up to rounding.
    """
    import numpy as np

    from assayloom.functions.vectors import append_value

    if flag is not None:
        df = df.select(append_value(features, F.col(flag).cast("double")).alias("_u"), F.col(targets).alias("_y"))
        features, targets = "_u", "_y"
    sums = materialise(ridge_sums(df, features, targets, block, missing), "ridge-sums")
    gram = _gram(sums)
    if not len(gram):
        raise ValueError("no rows to fit on")
    n, d = gram[0, 0], len(gram) - 1
    centred = gram[1:, 1:] - np.outer(gram[1:, 0], gram[0, 1:]) / n
    blocks = sums.where(F.col("block") > _GRAM).unionByName(
        sums.where(F.col("block") == _SQUARES).select(F.lit(-1).alias("i"), F.col("i").alias("block"), "sums"))
    models, histories = [], []
    stages = [("base", d if flag is None else d - 1)] + ([("prediction", d)] if flag is not None else [])
    for name, width in stages:
        inner = np.eye(width)
        if name == "prediction":
            inner[:-1, :-1] = _coefficient_products(models[0], d - 1)
        own = centred[:width, :width]
        matrix = inner @ own @ inner + reg * inner
        shared = df.sparkSession.sparkContext.broadcast((inner, own, matrix, gram[0, 1:1 + width]))
        turns = width if steps is None else steps

        def solve(pdf):
            import pandas as pd

            inner, own, matrix, totals = shared.value
            pdf = pdf.sort_values("i")
            squares, cross = np.array(pdf["sums"].iloc[0], float), np.array(pdf["sums"].tolist()[1:2 + len(own)], float)
            mean = cross[0] / n
            centred = cross[1:] - np.outer(totals, mean)
            v, losses = _conjugate_steps(matrix, inner @ centred, own, centred, squares - n * mean * mean, inner, n, turns)
            coef = inner @ v
            start = int(pdf["block"].iloc[0]) * block
            return pd.DataFrame({
                "target": np.arange(start, start + coef.shape[1], dtype="int32"), "coef": list(coef.T),
                "intercept": mean - (totals / n) @ coef, "losses": list(losses.T)})

        found = materialise(blocks.groupBy("block").applyInPandas(
            solve, "target int, coef array<double>, intercept double, losses array<double>"), "coefficients")
        models.append(found.drop("losses"))
        histories.append(found.select(F.posexplode("losses").alias("epoch", "loss")).groupBy("epoch")
                         .agg(F.avg("loss").alias("loss")).select(F.lit(name).alias("stage"), "epoch", "loss"))
    return models, histories[0] if len(histories) == 1 else histories[0].unionByName(histories[1])


# ---- two stages -----------------------------------------------------------

def fit_stacked(
    df: DataFrame, features: Sequence[str], flag: str, label: str, reg: float = 0.0
) -> tuple[PipelineModel, PipelineModel]:
    """Stage one on the features, stage two on (stage-one prediction, group flag)."""
    base = fit_linear(df, features, label, "base_prediction", reg)
    second = fit_linear(base.transform(df), ["base_prediction", flag], label, "prediction", reg)
    return base, second


def score_stacked(models: tuple[PipelineModel, PipelineModel], df: DataFrame) -> DataFrame:
    """Both stages' predictions."""
    base, second = models
    return second.transform(base.transform(df)).drop(
        "_base_prediction_in", "_base_prediction_scaled", "_prediction_in", "_prediction_scaled"
    )


def fit_stacked_ridge(
    df: DataFrame, features: str, flag: str, targets: str, reg: float = 1.0, block: int = _BLOCK, missing: str = "error"
) -> tuple[DataFrame, DataFrame]:
    """Two stages for many outputs: stage two sees all stage-one predictions and the flag.

    Both stages come from one pass. With u the centred features and flag, and A
    the linear map from u to the centred inputs of stage two, its penalised
    coefficients lie in A's range: they are A v with
    (M G M + reg M) v = M C, where M = A'A, G the sums of u u' and C those of u y'.
    So stage two is itself a linear map of the features and the flag, and nothing
    is ever as wide as targets x targets. The second model's ``coef`` is on the
    features, then the flag.
    """
    import numpy as np

    from assayloom.functions.vectors import append_value

    joint = df.select(append_value(features, F.col(flag).cast("double")).alias("_u"), F.col(targets).alias("_y"))
    sums = materialise(ridge_sums(joint, "_u", "_y", block, missing), "ridge-sums")
    gram = _gram(sums)
    base = materialise(_solve_ridge(sums, gram[:-1, :-1], reg, block), "coefficients")
    size = len(gram)
    inner = np.eye(max(0, size - 1))
    if size > 2:
        inner[:-1, :-1] = _coefficient_products(base, size - 2)
    n = gram[0, 0] if size else 1.0
    centred = gram[1:, 1:] - np.outer(gram[1:, 0], gram[0, 1:]) / n
    solve_for = inner @ centred @ inner + reg * inner
    shared = df.sparkSession.sparkContext.broadcast((inner @ np.linalg.pinv(solve_for, hermitian=True) @ inner, gram))

    def second_stage(pdf):
        import pandas as pd

        linear, g = shared.value
        cross = np.array(pdf.sort_values("i")["sums"].tolist(), dtype="float64")
        coef = linear @ (cross[1:] - np.outer(g[1:, 0], cross[0]) / g[0, 0])
        start = int(pdf["block"].iloc[0]) * block
        return pd.DataFrame({
            "target": np.arange(start, start + coef.shape[1], dtype="int32"),
            "coef": list(coef.T),
            "intercept": cross[0] / g[0, 0] - (g[0, 1:] / g[0, 0]) @ coef,
        })

    second = sums.where(F.col("block") > _GRAM).groupBy("block").applyInPandas(
        second_stage, "target int, coef array<double>, intercept double")
    return base, materialise(second, "coefficients")


def _coefficient_products(model: DataFrame, width: int):
    """Sum over the targets of coef x coef: a matrix of the features' size."""
    import numpy as np

    def partial(batches):
        import pandas as pd

        total = np.zeros((width, width))
        for pdf in batches:
            if len(pdf):
                w = np.stack(pdf["coef"].to_numpy())
                total += w.T @ w
        yield pd.DataFrame({"place": np.arange(width * width), "value": total.ravel()})

    cells = (model.select("coef").mapInPandas(partial, "place long, value double")
             .groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").collect())
    return np.array([r["value"] for r in cells]).reshape(width, width)


def score_stacked_ridge(
    models: tuple[DataFrame, DataFrame], df: DataFrame, features: str, flag: str
) -> DataFrame:
    """Adds ``base_prediction`` and ``prediction`` arrays."""
    from assayloom.functions.vectors import append_value

    base, second = models
    scored = score_ridge(df, base, features, "base_prediction")
    staged = scored.withColumn("_with_flag", append_value(features, F.col(flag).cast("double")))
    return score_ridge(staged, second, "_with_flag", "prediction").drop("_with_flag")
