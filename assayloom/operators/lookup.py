"""Property lookup for distinct names."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.operators.select import last_column_first, not_null
from assayloom.operators.sets import first_match


def lookup_snapshot(
    names: DataFrame, snapshot: DataFrame, key: str, rank: Sequence[str], fields: Sequence[str]
) -> DataFrame:
    """First hit of each distinct name in a property snapshot; names without one are left out.

    Both sides are grouped by the name before they meet, so the join needs no
    further shuffle and no name can be hot in it.
    """
    wanted = not_null(names.select(key), [key]).distinct()
    best = first_match(not_null(snapshot, [key]), key, rank, fields)
    return best.join(wanted, key)


def lookup_provider(
    names: DataFrame,
    key: str,
    provider: Callable[[str], Mapping | None],
    fields: T.StructType,
    partitions: int | None = None,
    tries: int = 1,
    wait: float = 1.0,
) -> DataFrame:
    """Ask ``provider`` once per distinct name.

    Returns (key, fields..., found, error). A name the provider does not know is
    ``found = false``; an exception is reported in ``error`` and does not stop
    the other names. After an exception a name is asked again, up to ``tries``
    times in all, with ``wait`` seconds before the second and twice as long
    before each further one. ``partitions`` sets how many names are asked for at a time,
    by default as many as the session has cores. Keys and fields may be of any
    type that Spark passes through Arrow.
    """
    wanted = not_null(names.select(key), [key]).distinct()
    wanted = wanted.repartition(partitions or wanted.sparkSession.sparkContext.defaultParallelism, key)
    field_names = fields.fieldNames()
    schema = T.StructType([
        T.StructField(key, names.schema[key].dataType), *fields.fields,
        T.StructField("found", T.BooleanType()), T.StructField("error", T.StringType()),
    ])

    def ask(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                record, error = None, None
                for attempt in range(max(1, tries)):
                    if attempt:
                        time.sleep(wait * 2 ** (attempt - 1))
                    try:
                        record, error = provider(name), None
                        break
                    except Exception as e:
                        error = f"{type(e).__name__}: {e}"
                row = {key: name}
                row.update({f: (record or {}).get(f) for f in field_names})
                row.update(found=record is not None, error=error)
                yield row

    def to_batches(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema, timestamp_utc=True)
        held = []
        for row in ask(batches):
            held.append(row)
            if len(held) == 1024:
                yield pa.RecordBatch.from_pylist(held, schema=arrow)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)

    return wanted.mapInArrow(to_batches, schema)


class AnswerTable:
    """Answers of a provider in a catalog table, so that no name is asked twice.

    The table has (key, fields..., found, error, run): hits, unknown names and
    errors alike, with the number of the run that asked; runs that had to ask nobody have none. It is bucketed by the
    key, so names meet it without moving what is stored.
    """

    def __init__(self, spark: SparkSession, table: str, key: str, fields: T.StructType, buckets: int = 64):
        self.spark, self.table, self.key, self.fields, self.buckets = spark, table, key, fields, buckets

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def answers(self) -> DataFrame:
        """The last answer to every name that was ever asked."""
        if not self.exists():
            raise ValueError(f"nothing was asked yet: there is no table {self.table}")
        asked = self.spark.table(self.table)
        rest = [F.col(f"`{c}`") for c in asked.columns if c not in (self.key, "run")]
        last = asked.groupBy(F.col(f"`{self.key}`")).agg(F.max_by(F.struct(*rest, "run"), "run").alias("_last"))
        return last.select(F.col(f"`{self.key}`"), "_last.*")

    def ask(self, names: DataFrame, provider: Callable[[str], Mapping | None], again: bool = True, pieces: int = 1,
            tries: int = 1, wait: float = 1.0) -> DataFrame:
        """Answers to all distinct names of ``names``; only those without an answer are asked, and stored.

        With ``again``, a name whose last answer is an error counts as without one. Names are asked
        in ``pieces`` by their hash, each stored as it is done, so that a run
        that is killed asks at most one piece's names again; within a piece a lost task asks its own
        names again. ``tries`` and ``wait`` as in ``lookup_provider``. Null names are not asked.
        """
        if not set(self.fields.fieldNames()).isdisjoint({self.key, "found", "error", "run"}):
            raise ValueError("fields may not be called like the key, found, error or run")
        key = F.col(f"`{self.key}`")
        wanted = not_null(names.select(key), [self.key]).distinct()
        run = (self.spark.table(self.table).agg(F.max("run")).first()[0] or 0) + 1 if self.exists() else 1
        for piece in range(pieces):
            due = wanted.where(F.pmod(F.xxhash64(key), F.lit(pieces)) == piece) if pieces > 1 else wanted
            if self.exists():
                settled = self.answers()
                settled = settled.where("error IS NULL") if again else settled
                due = due.join(settled.select(key).hint("merge"), self.key, "left_anti")
            # Asked in the table's own buckets: a file for each bucket and piece.
            found = lookup_provider(due, self.key, provider, self.fields, self.buckets, tries, wait)
            (found.withColumn("run", F.lit(run)).write.format("parquet").mode("append")
             .bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(self.table))
        return self.answers().join(wanted, self.key, "left_semi")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def property_table(found: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Found names as a table: the key first, then the properties."""
    return last_column_first(found.select(*[F.col(f"`{f}`") for f in fields], key))
