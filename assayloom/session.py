"""Session defaults, the shared scratch folder, and measured table sizes."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def build_session(app_name: str = "assayloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are tuned for.

    ``conf`` keys use ``__`` for dots (``spark__sql__shuffle__partitions=8``).
    Nothing machine-specific is set: memory, executors and shuffle width stay
    with the cluster's own configuration.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A sort-merge join becomes a hash join when every partition turns out this small.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    defaults.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in defaults.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application's own, that all executors share.

    It lies below ``spark.checkpoint.dir``, else below the warehouse folder, on
    whatever file system that names, and goes when the application ends.
    """
    context = spark.sparkContext
    if context.applicationId not in _own_dirs:
        root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
        jvm = context._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/assayloom-{context.applicationId}")
        fs = path.getFileSystem(context._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _own_dirs[context.applicationId] = fs.makeQualified(path).toString()
    return _own_dirs[context.applicationId]


def new_table_path(spark: SparkSession, label: str = "table") -> str:
    """An unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing), keeps
    Parquet pruning and pushdown, and gives Catalyst the true size.
    """
    spark = df.sparkSession
    path = new_table_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread_scan(scan: DataFrame, by: Sequence[str]) -> DataFrame:
    """Deal a stored table out by ``by`` when it lies in fewer pieces than there are cores.

    For heavy work per row on a table of few row groups. A table in enough pieces
    is returned as it is, without a shuffle. Give a plain scan: its pieces are
    known from planning, while those of a shuffled result would have to be run.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, *[F.col(f"`{c}`") for c in by])


def _value_bytes(col: Column, dtype: T.DataType) -> Column:
    """Bytes of data in one value, by type."""
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col).cast("long"), F.lit(0)) + F.lit(8)
    if isinstance(dtype, T.StructType):
        total = F.lit(8)
        for f in dtype.fields:
            total = total + _value_bytes(col.getField(f.name), f.dataType)
        return total
    if isinstance(dtype, T.ArrayType):
        inner = dtype.elementType
        if isinstance(inner, (T.StringType, T.BinaryType, T.StructType, T.ArrayType, T.MapType)):
            body = F.aggregate(
                F.coalesce(col, F.array().cast(dtype)),
                F.lit(0).cast("long"),
                lambda acc, x: acc + _value_bytes(x, inner).cast("long"),
            )
        else:
            body = F.coalesce(F.size(col), F.lit(0)).cast("long") * F.lit(8)
        return body + F.lit(16)
    if isinstance(dtype, T.MapType):
        keys = _value_bytes(F.map_keys(col), T.ArrayType(dtype.keyType))
        return keys + _value_bytes(F.map_values(col), T.ArrayType(dtype.valueType))
    return F.lit(16 if isinstance(dtype, T.DecimalType) else 8)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of data in a row of ``df``."""
    width = F.lit(0).cast("long")
    for f in df.schema.fields:
        width = width + _value_bytes(F.col(f"`{f.name}`"), f.dataType)
    return width.cast("long")


def measured_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes of data) of ``df``, computed by Spark in one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; negative means never."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    m = re.fullmatch(r"(-?\d+)\s*([a-z]*)", text)
    return int(m.group(1)) * _UNITS[m.group(2)]


def fits_broadcast(df: DataFrame) -> bool:
    """True when the measured data of ``df`` is within the broadcast limit."""
    limit = broadcast_limit(df.sparkSession)
    if limit <= 0:
        return False
    return measured_size(df)[1] <= limit
