"""Set algebra on id tables, appends, first matches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_ids(*parts: DataFrame) -> DataFrame:
    """All ids of all parts, duplicates kept."""
    return reduce(DataFrame.unionByName, parts)


def append_rows(*parts: DataFrame) -> DataFrame:
    """Rows of all parts matched by column name; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def difference_ids(a: DataFrame, b: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Distinct ids of ``a`` that are not in ``b``.

    Both sides are made distinct first, so a repeated id cannot be hot, and the
    join reuses that partitioning.
    """
    return a.select(row_id).distinct().join(b.select(row_id).distinct(), row_id, "left_anti")


def first_match(df: DataFrame, key: str, rank: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Per key, ``fields`` of the row with the lowest ``rank``."""
    best = F.min_by(F.struct(*[F.col(f"`{f}`") for f in fields]), F.struct(*rank)).alias("_best")
    return df.groupBy(key).agg(best).select(key, *[F.col("_best").getField(f).alias(f) for f in fields])
