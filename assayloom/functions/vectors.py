"""Array-valued column functions: bits, float vectors, affine maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.functions.names import _c


def bits_to_array(col: Column | str) -> Column:
    """'0110' -> [0, 1, 1, 0]."""
    return F.transform(F.split(_c(col), ""), lambda b: b.cast("int"))


def set_bits(col: Column | str) -> Column:
    """Positions (from 0) of the non-zero entries of an int array."""
    at = F.transform(_c(col), lambda b, i: F.when(b != 0, i))
    return F.filter(at, lambda i: i.isNotNull())


def to_float32(col: Column | str) -> Column:
    """Cast to float; text that is not a number gives null instead of an error."""
    return _c(col).try_cast("float")


def floor_fraction(n: Column | str, fraction: float) -> Column:
    """The whole part of ``fraction`` of a count."""
    return F.floor(F.lit(float(fraction)) * _c(n)).cast("long")


def as_vector(col: Column | str) -> Column:
    """A scalar as a one-element array."""
    return F.array(_c(col))


def append_value(vec: Column | str, value: Column | str) -> Column:
    """A vector with one more entry at its end."""
    return F.concat(_c(vec), F.array(_c(value)))


def concat_vectors(*vecs: Column | str) -> Column:
    """Vectors joined end to end."""
    return F.concat(*[_c(v) for v in vecs])


def relu(vec: Column | str) -> Column:
    """Negative entries become zero; a null entry stays null."""
    return F.transform(_c(vec), lambda x: F.when(x.isNotNull(), F.greatest(x, F.lit(0.0).cast("double"))))


def dot(a: Column | str, b: Column | str) -> Column:
    """Sum of products, in double."""
    products = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def affine(vec: Column | str, weights: Sequence[float], bias: float = 0.0) -> Column:
    """One output of a linear layer: ``w.x + b``."""
    return dot(vec, F.array(*[F.lit(float(w)) for w in weights])) + F.lit(float(bias))


#: Bytes of outputs that ``affine_many`` makes at once.
_OUTPUT_BYTES = 32 << 20


def affine_many(df: DataFrame, vec: str, weights, bias, out: str = "affine") -> DataFrame:
    """Many outputs of a linear layer, ``W x + b``, one matrix product per slice of rows.

    ``weights`` is (outputs, inputs); its size is that of the layer, not of the data.
    A null vector gives a null; one of another length than ``inputs`` is an error.
    Slices hold about ``_OUTPUT_BYTES`` of outputs, however many there are per row.
    """
    import numpy as np

    w = np.asarray(weights, dtype="float64")
    b = np.asarray(bias, dtype="float64")
    shared = df.sparkSession.sparkContext.broadcast((w, b))
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        w, b = shared.value
        step = max(1, _OUTPUT_BYTES // (8 * max(1, w.shape[0])))
        for batch in (whole.slice(s, step) for whole in batches for s in range(0, whole.num_rows, step)):
            column = batch.column(batch.schema.get_field_index(vec))
            known = column.is_valid().to_numpy(zero_copy_only=False)
            lengths = column.value_lengths().to_numpy(zero_copy_only=False)[known]
            if (lengths != w.shape[1]).any():
                raise ValueError(f"{vec} has {int(lengths[lengths != w.shape[1]][0])} entries, not {w.shape[1]}")
            x = column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, w.shape[1])
            y = x @ w.T + b
            ends = np.concatenate([[0], np.cumsum(known) * w.shape[0]]).astype("int32")
            missing = None if known.all() else pa.array(~known)
            made = pa.ListArray.from_arrays(pa.array(ends), pa.array(y.ravel()), mask=missing)
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, out])

    return df.mapInArrow(run, schema)


def squared_error_sum(pred: Column | str, truth: Column | str) -> Column:
    """Sum of squared differences of two arrays, in double."""
    sq = F.zip_with(
        _c(pred), _c(truth),
        lambda p, t: (p.cast("double") - t.cast("double")) * (p.cast("double") - t.cast("double")),
    )
    return F.aggregate(sq, F.lit(0.0), lambda acc, x: acc + x)


def percent_label(share: Column | str) -> Column:
    """12.34 -> '12.3%'."""
    return F.format_string("%.1f%%", _c(share))
