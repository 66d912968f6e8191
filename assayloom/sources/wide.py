"""Wide Parquet files (thousands of numeric columns) as one array column."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.constants import FEATURE_COLUMNS


def pack_columns(df: DataFrame, keep: Sequence[str], out: str = "targets", dtype: str = "float") -> DataFrame:
    """All columns but ``keep`` as one array column, for tables of moderate width."""
    rest = [c for c in df.columns if c not in set(keep)]
    packed = F.array(*[F.col(f"`{c}`").cast(dtype) for c in rest])
    return df.select(*[F.col(f"`{c}`") for c in keep], packed.alias(out))


def wide_column_names(spark: SparkSession, path: str, keep: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """(pos, name) of the packed columns, read from one file's footer."""
    keep = list(keep)
    files = spark.read.format("binaryFile").load(path).select("path")

    def names(batches):
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        import pandas as pd

        for pdf in batches:
            for p in pdf["path"]:
                filesystem, inner = pafs.FileSystem.from_uri(p)
                with filesystem.open_input_file(inner) as handle:
                    schema = pq.read_schema(handle)
                rest = [n for n in schema.names if n not in keep]
                yield pd.DataFrame({"pos": range(len(rest)), "name": rest})

    first = files.agg(F.min("path").alias("path"))
    return first.mapInPandas(names, "pos int, name string")


def read_wide_parquet(
    spark: SparkSession,
    path: str,
    keep: T.StructType,
    out: str = "targets",
    row_id: str | None = "row_id",
    batch_rows: int = 256,
) -> DataFrame:
    """Read wide files straight into ``keep`` columns plus one ``array<float>``.

    The logical plan never holds the wide schema. The unit of work is one row
    group, so a large file spreads over many tasks, and each task holds
    ``batch_rows`` rows at a time. ``row_id`` numbers the rows of all files in
    path order; the numbers come from footers alone, so they are the same on
    every run. Columns are found by name, in the order of the first file; files
    with other names are an error.
    """
    keep_names = keep.fieldNames()
    files = spark.read.format("binaryFile").load(path).select("path")

    def footers(batches):
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        import pandas as pd

        for pdf in batches:
            for p in pdf["path"]:
                filesystem, inner = pafs.FileSystem.from_uri(p)
                with filesystem.open_input_file(inner) as handle:
                    file = pq.ParquetFile(handle)
                    meta, names = file.metadata, file.schema_arrow.names
                rows = [meta.row_group(g).num_rows for g in range(meta.num_row_groups)]
                rest = sorted(n for n in names if n not in keep_names)
                mark = hashlib.sha256("\0".join(rest).encode()).hexdigest()
                yield pd.DataFrame({"path": p, "row_group": range(len(rows)), "n_rows": rows, "mark": mark})

    groups = files.mapInPandas(footers, "path string, row_group int, n_rows long, mark string")
    # One line per row group: bounded by the number of files, like a file listing.
    listing = sorted(groups.collect(), key=lambda r: (r["path"], r["row_group"]))
    if len({r["mark"] for r in listing}) > 1:
        raise ValueError(f"the files of {path} have different columns")
    rest = [r["name"] for r in wide_column_names(spark, path, keep_names).orderBy("pos").collect()] if listing else []
    start, tasks = 0, []
    for r in listing:
        tasks.append((r["path"], r["row_group"], start))
        start += r["n_rows"]
    fields = list(keep.fields) + [T.StructField(out, T.ArrayType(T.FloatType()))]
    if row_id:
        fields = [T.StructField(row_id, T.LongType())] + fields
    schema = T.StructType(fields)
    if not tasks:
        return spark.createDataFrame([], schema)
    work = (
        spark.createDataFrame(tasks, "path string, row_group int, start long")
        .repartitionByRange(len(tasks), "start")
    )

    arrow_names = {
        "string": "string", "bigint": "int64", "int": "int32",
        "double": "double", "float": "float", "boolean": "bool",
    }
    keep_types = {f.name: arrow_names[f.dataType.simpleString()] for f in keep.fields}

    def load(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        for work_batch in batches:
            for task in work_batch.to_pylist():
                filesystem, inner = pafs.FileSystem.from_uri(task["path"])
                with filesystem.open_input_file(inner) as handle:
                    source = pq.ParquetFile(handle)
                    at = task["start"]
                    for batch in source.iter_batches(batch_rows, row_groups=[task["row_group"]]):
                        n, width = batch.num_rows, len(rest)
                        wide = np.empty((n, width), "float32")
                        for j, name in enumerate(rest):
                            wide[:, j] = batch.column(name).to_numpy(zero_copy_only=False)
                        packed = pa.ListArray.from_arrays(
                            pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(wide.ravel())
                        )
                        columns = {k: batch.column(k).cast(t) for k, t in keep_types.items()}
                        if row_id:
                            columns = {row_id: pa.array(np.arange(at, at + n)), **columns}
                        columns[out] = packed
                        at += n
                        yield pa.RecordBatch.from_pydict(columns)

    return work.mapInArrow(load, schema)
