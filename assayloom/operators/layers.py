"""Squared-error regression with hidden layers, one or two stages, by gradient steps over all rows.

Every step is one Spark job: tasks add up loss and gradient of their own rows, and
what they send has the size of the model, never of the data. Weights and the
optimiser's moments stay on the driver, so a model has a byte limit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.operators.regress import all_present
from assayloom.session import materialise

_PIECE = 1 << 16     # numbers in one row of gradient sums
_CELLS = 1 << 16     # numbers of the widest layer that a task holds at a time: within a core's cache
_CHUNK = 1 << 9      # numbers in one stored chunk of rows, at least a row: readers, writers and batches hold thousands of chunks
#: Decay of the two moments, and what keeps a step finite.
_FIRST, _SECOND, _TINY = 0.9, 0.999, 1e-8


@dataclass(frozen=True)
class LayeredModel:
    """Weights (inputs x outputs) and offsets by layer; layers are rectified but the last of each stage.

    ``joint`` is the first layer of stage two, whose last input is the flag; None
    for a single stage. ``shift`` and ``scale`` centre the features, ``out_shift``
    and ``out_scale`` bring outputs back to the targets' units.
    """

    weights: list[np.ndarray]
    offsets: list[np.ndarray]
    joint: int | None
    shift: np.ndarray
    scale: np.ndarray
    out_shift: np.ndarray
    out_scale: np.ndarray

    def plain(self, i: int) -> bool:
        """Whether layer ``i`` is not rectified."""
        return i == len(self.weights) - 1 or (self.joint is not None and i == self.joint - 1)

    def run(self, x: np.ndarray, flag: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
        """(input of each layer, output of the last) for centred features."""
        inputs, a = [], x
        for i, (w, b) in enumerate(zip(self.weights, self.offsets)):
            if i == self.joint:
                a = np.column_stack([a, flag])
            inputs.append(a)
            a = a @ w
            a += b
            if not self.plain(i):
                np.maximum(a, 0.0, out=a)
        return inputs, a

    def gradient(self, x: np.ndarray, flag: np.ndarray | None, y: np.ndarray) -> tuple[float, np.ndarray]:
        """(sum of squared errors, its gradient by all weights and offsets in one row)."""
        inputs, out = self.run(x, flag)
        error = out - y
        back, parts = 2.0 * error, []
        for i in reversed(range(len(self.weights))):
            parts = [(inputs[i].T @ back).ravel(), np.ones(len(back)) @ back, *parts]
            if i:
                back = back @ self.weights[i].T
                if i == self.joint:
                    back = back[:, :-1]
                if not self.plain(i - 1):
                    back *= inputs[i][:, :back.shape[1]] > 0
        return float((error * error).sum()), np.concatenate(parts)

    def flat(self) -> np.ndarray:
        return np.concatenate([p for w, b in zip(self.weights, self.offsets) for p in (w.ravel(), b)])

    def moved(self, flat: np.ndarray) -> LayeredModel:
        """The same layers with other numbers."""
        weights, offsets, at = [], [], 0
        for w, b in zip(self.weights, self.offsets):
            weights.append(flat[at:at + w.size].reshape(w.shape))
            at += w.size
            offsets.append(flat[at:at + b.size])
            at += b.size
        return LayeredModel(weights, offsets, self.joint, self.shift, self.scale, self.out_shift, self.out_scale)


def _sized(width: int, outputs: int, hidden: Sequence[int], second: Sequence[int] | None) -> tuple[list[tuple[int, int]], int | None]:
    """((inputs, outputs) of each layer, first layer of stage two)."""
    sizes = list(zip([width, *hidden], [*hidden, outputs]))
    if second is None:
        return sizes, None
    return sizes + list(zip([outputs + 1, *second], [*second, outputs])), len(sizes)


def _rows_at_once(model: LayeredModel) -> int:
    return max(1, _CELLS // max(max(w.shape) for w in model.weights))


def _matrix(column, width: int) -> np.ndarray:
    """Rows of an Arrow list column."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), width)


def _chunks(rows: DataFrame, features: str, targets: str) -> DataFrame:
    """(features, targets, n, rows): rows (x, flag, y) as chunks of doubles, stored, so that a step only reads numbers."""
    def pack(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            if not batch.num_rows:
                continue
            parts, widths = [], []
            for name, column in ((features, batch["x"]), (targets, batch["y"])):
                lengths = pc.unique(pc.list_value_length(column)).to_pylist()
                if len(lengths) > 1:
                    raise ValueError(f"{name} has arrays of different lengths")
                parts.append(_matrix(column, lengths[0]))
                widths.append(lengths[0])
            block = np.column_stack([parts[0], batch["flag"].to_numpy(zero_copy_only=False), parts[1]])
            at_once = max(1, _CHUNK // block.shape[1])
            chunks = [block[at:at + at_once] for at in range(0, len(block), at_once)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([w] * len(chunks), pa.int32()) for w in widths], pa.array([len(c) for c in chunks], pa.int32()),
                 pa.array([c.tobytes() for c in chunks], pa.binary())], ["features", "targets", "n", "rows"])

    return materialise(rows.mapInArrow(pack, "features int, targets int, n int, rows binary"), "layer-chunks")


def _added(chunks: DataFrame, width: int, at_once: int, of) -> np.ndarray:
    """The numbers that ``of`` gives for at most ``at_once`` rows of ``width`` numbers, added over all rows in the order of the tasks."""
    def partial(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            # A batch's chunks lie behind one another.
            _, offsets, numbers = batch["rows"].cast(pa.large_binary()).buffers()
            first, last = np.frombuffer(offsets, np.int64)[[0, batch.num_rows]]
            block = np.frombuffer(numbers[first:last], float).reshape(-1, width)
            for start in range(0, len(block), at_once):
                sums = of(block[start:start + at_once])
                total = sums if total is None else total + sums
        if total is not None:
            task = TaskContext.get().partitionId()
            for piece, at in enumerate(range(0, len(total), _PIECE)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task], pa.int32()), pa.array([piece], pa.int32()),
                     pa.array([total[at:at + _PIECE].tobytes()], pa.binary())], ["task", "piece", "sums"])

    def added(batches):
        import pyarrow as pa

        now, total = None, None
        for batch in batches:
            for piece, sums in zip(batch["piece"].to_pylist(), batch["sums"].to_pylist()):
                sums = np.frombuffer(sums, float)
                if piece == now:
                    total = total + sums
                    continue
                if now is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["piece", "sums"])
                now, total = piece, sums
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["piece", "sums"])

    pieces = (chunks.select("rows").mapInArrow(partial, "task int, piece int, sums binary").repartition("piece")
              .sortWithinPartitions("piece", "task").select("piece", "sums").mapInArrow(added, "piece int, sums binary"))
    # One set of sums, of the model's size.
    return np.concatenate([np.frombuffer(r["sums"], float) for r in sorted(pieces.collect(), key=lambda r: r["piece"])])


def _moments(chunks: DataFrame, width: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(means, deviations) of the numbers of a row; one without spread has deviation 1."""
    at_once = max(1, _CELLS // width)
    # Counted from some row, so that a number without spread has no deviation by rounding.
    base = np.frombuffer(chunks.select("rows").first()["rows"], float)[:width]
    mean = base + _added(chunks, width, at_once, lambda block: (block - base).sum(axis=0)) / n
    deviation = np.sqrt(_added(chunks, width, at_once, lambda block: np.square(block - mean).sum(axis=0)) / n)
    return mean, np.where(deviation == 0, 1.0, deviation)


def _gradient_sums(model: LayeredModel, chunks: DataFrame) -> tuple[float, np.ndarray]:
    """(sum of squared errors, gradient) over all rows."""
    shared = chunks.sparkSession.sparkContext.broadcast(model)
    width = len(model.shift)

    def of(block):
        held = shared.value
        loss, gradient = held.gradient(
            (block[:, :width] - held.shift) / held.scale, block[:, width], (block[:, width + 1:] - held.out_shift) / held.out_scale)
        return np.append(gradient, loss)

    found = _added(chunks, width + 1 + len(model.out_shift), _rows_at_once(model), of)
    shared.destroy()
    return float(found[-1]), found[:-1]


def fit_layers(
    df: DataFrame,
    features: str,
    targets: str,
    hidden: Sequence[int] = (256, 512),
    flag: str | None = None,
    second: Sequence[int] | None = None,
    epochs: int = 100,
    rate: float = 0.001,
    seed: int = 0,
    missing: str = "error",
    max_bytes: int = 256 << 20,
) -> tuple[LayeredModel, DataFrame]:
    """A network from the ``features`` array to the ``targets`` array, and its loss by epoch.

    ``hidden`` are the sizes of the rectified layers. With ``second``, the outputs
    and the number or boolean in ``flag`` are the inputs of a second stage with
    hidden layers of these sizes; both stages are fitted together on the second's
    error. Each of ``epochs`` steps takes the gradient over every row; step sizes
    are ``rate`` by adaptive moments. Features and targets are centred and scaled.

    The second result is (stage, epoch, loss): the mean squared error of the scaled
    targets (1 for each target's mean alone) before each step, and after the last. A row with a null or
    NaN in an array or with a null flag is an error, or left out with
    ``missing="drop"``; arrays of different lengths are an error, and so is a
    table without rows. Weights above ``max_bytes`` are an error, since the driver
    holds four copies of them. The start hangs on ``seed`` alone and each step on all
    rows, so two runs differ by the rounding of their additions only.
    """
    if missing not in ("error", "drop"):
        raise ValueError(f"missing must be 'error' or 'drop', not {missing!r}")
    if (flag is None) != (second is None):
        raise ValueError("a second stage needs both flag and second")
    spark = df.sparkSession
    flagged = F.lit(0.0) if flag is None else F.col(f"`{flag}`").cast("double")
    usable = all_present(features) & all_present(targets) & flagged.isNotNull() & ~F.isnan(flagged)
    if missing == "error":
        usable = F.when(usable, True).otherwise(F.raise_error(F.lit("a feature, target or flag is missing")).cast("boolean"))
    chunks = _chunks(df.where(usable).select(
        F.col(f"`{features}`").cast("array<double>").alias("x"), F.col(f"`{targets}`").cast("array<double>").alias("y"),
        flagged.alias("flag")), features, targets)
    shapes = chunks.groupBy("features", "targets").agg(F.sum("n").alias("n")).limit(2).collect()
    if len(shapes) > 1:
        raise ValueError(f"{features} or {targets} has arrays of different lengths")
    if not shapes or not shapes[0]["features"] or not shapes[0]["targets"]:
        raise ValueError("no rows, or no features or targets, to fit on")
    width, outputs, n = shapes[0]
    sizes, joint = _sized(width, outputs, hidden, second)
    if 8 * sum(a * b + b for a, b in sizes) > max_bytes:
        raise ValueError(f"the weights take more than {max_bytes} bytes")
    start = np.random.default_rng(seed)
    weights, offsets = [], []
    for a, b in sizes:
        bound = 1.0 / np.sqrt(a)
        weights.append(start.uniform(-bound, bound, (a, b)))
        offsets.append(start.uniform(-bound, bound, b))
    # A task per core sends one set of sums, however many files there are.
    chunks = chunks.coalesce(spark.sparkContext.defaultParallelism)
    mean, deviation = _moments(chunks, width + 1 + outputs, n)
    model = LayeredModel(weights, offsets, joint, mean[:width], deviation[:width], mean[width + 1:], deviation[width + 1:])
    return _descend(spark, model, chunks, n, epochs, rate)


def _descend(spark: SparkSession, model: LayeredModel, chunks: DataFrame, n: int, epochs: int,
             rate: float) -> tuple[LayeredModel, DataFrame]:
    cells = n * len(model.out_shift)
    flat = model.flat()
    first, second, losses = np.zeros(len(flat)), np.zeros(len(flat)), []
    for epoch in range(epochs + 1):
        loss, gradient = _gradient_sums(model, chunks)
        losses.append(("joint" if model.joint is not None else "base", epoch, loss / cells))
        if epoch == epochs:
            break
        gradient = gradient / cells
        first = _FIRST * first + (1 - _FIRST) * gradient
        second = _SECOND * second + (1 - _SECOND) * gradient * gradient
        step = (first / (1 - _FIRST ** (epoch + 1))) / (np.sqrt(second / (1 - _SECOND ** (epoch + 1))) + _TINY)
        flat = flat - rate * step
        model = model.moved(flat)
    return model, spark.createDataFrame(losses, "stage string, epoch int, loss double")


def score_layers(df: DataFrame, model: LayeredModel, features: str, flag: str | None = None, out: str = "prediction") -> DataFrame:
    """Add the array of outputs; null where the features or flag are null or hold a null or NaN."""
    if (flag is None) != (model.joint is None):
        raise ValueError("a model of two stages needs the flag, one of a single stage has none")
    shared, width, at_once = df.sparkSession.sparkContext.broadcast(model), len(model.shift), _rows_at_once(model)
    flagged = F.lit(0.0) if flag is None else F.col(f"`{flag}`").cast("double")
    names = [f"c{k}" for k in range(len(df.columns))]
    given: Column = F.when(all_present(features) & flagged.isNotNull() & ~F.isnan(flagged), F.col(f"`{features}`").cast("array<double>"))

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        held = shared.value
        outputs = len(held.out_shift)
        for batch in batches:
            some = pc.is_valid(batch["_x"])
            lengths = pc.unique(pc.list_value_length(batch["_x"]).drop_null()).to_pylist()
            if any(n != width for n in lengths):
                raise ValueError(f"{lengths} features, {width} were fitted")
            x, f = batch["_x"].filter(some), batch["_flag"].filter(some).to_numpy(zero_copy_only=False)
            x = (_matrix(x, width) - held.shift) / held.scale
            found = np.empty((len(x), outputs))
            for at in range(0, len(x), at_once):
                found[at:at + at_once] = held.run(x[at:at + at_once], f[at:at + at_once])[1]
            ends = np.concatenate(([0], np.cumsum(some.to_numpy(zero_copy_only=False)))) * outputs
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array((found * held.out_scale + held.out_shift).ravel()),
                                             mask=pc.invert(some))
            yield pa.RecordBatch.from_arrays([*[batch[n] for n in names], lists], [*names, "_out"])

    raw = df.toDF(*names)
    schema = T.StructType([*raw.schema.fields, T.StructField("_out", T.ArrayType(T.DoubleType()))])
    ready = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, names)], given.alias("_x"), flagged.alias("_flag"))
    scored = ready.mapInArrow(run, schema)
    kept = [F.col(n).alias(c) for c, n in zip(df.columns, names) if c != out]
    return scored.select(*kept, F.col("_out").alias(out))
