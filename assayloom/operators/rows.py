"""Row identity, row selection by id, and peeking."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.operators.joins import dimension_join
from assayloom.session import materialise

# monotonically_increasing_id() holds the partition above bit 33, the row below.
_ROW_BITS = 33


def with_row_index(df: DataFrame, order_by: Sequence, name: str = "row_index", ranged: bool = False) -> DataFrame:
    """Number rows 0..n-1 in the order of ``order_by``.

    A range-partitioned sort (many tasks) is written to the shared folder with
    each row's partition and place; the partition sizes then give every
    partition its first number. Nothing passes through a single task, and the
    numbers cannot change when a task is run again. Ties are broken by a hash
    of the row, so that equal keys still spread over partitions.

    ``ranged``: the partitions of ``df`` already are ranges of the first order
    column, with no value of it in two of them, and are sorted where they lie.
    """
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    spot = F.monotonically_increasing_id()
    ordered = df.sortWithinPartitions(*order_by, tie) if ranged else df.orderBy(*order_by, tie)
    placed = materialise(ordered.withColumn("_spot", spot), "ordered")
    part = F.shiftright("_spot", _ROW_BITS).cast("int")
    place = F.col("_spot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One line per partition of the sort, whatever the number of rows.
    sizes = placed.groupBy(part.alias("part")).agg((F.max(place) + 1).alias("n")).collect()
    sizes.sort(key=lambda r: r["part"])
    starts = [0, *accumulate(r["n"] for r in sizes)]
    offsets = df.sparkSession.createDataFrame(
        [(r["part"], s) for r, s in zip(sizes, starts)], "_part int, _start long"
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_start") + place).alias(name))
    )


def ids_where_member(df: DataFrame, col: str, members: Iterable, row_id: str = "row_id") -> DataFrame:
    """Ids of the rows whose ``col`` is one of ``members``."""
    return df.where(F.col(f"`{col}`").isin(list(members))).select(row_id)


def gather(df: DataFrame, ids: DataFrame, row_id: str = "row_id") -> DataFrame:
    """The rows named by a set of ids (an id may be named often; it counts once)."""
    return df.join(ids.select(row_id).distinct(), row_id, "left_semi")


def gather_in_order(df: DataFrame, ids: DataFrame, row_id: str = "row_id", position: str = "position") -> DataFrame:
    """The rows named by an id list, once per mention, with their list position.

    One id may be mentioned very often, so the list is the side that is salted.
    """
    return dimension_join(ids.select(row_id, position), df, [row_id], "inner", spread=[position])


def peek(df: DataFrame, order_by: Sequence, n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order_by).limit(n)


def shape(df: DataFrame) -> DataFrame:
    """One row (n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast("long")
    )


def column_listing(df: DataFrame, table: str) -> DataFrame:
    """(table, pos, column, type, n_rows), one line per column."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    entries = F.array(*[
        F.struct(F.lit(i).cast("int").alias("pos"), F.lit(n).alias("column"), F.lit(t).alias("type"))
        for i, n, t in rows
    ])
    return (
        df.agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(table).alias("table"), F.inline(entries), "n_rows")
    )


def row_at(df: DataFrame, index: int, col: str = "row_index") -> DataFrame:
    """The row with a given index."""
    return df.where(F.col(col) == F.lit(index).cast(T.LongType()))
