"""Completeness of a table, by column and by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _present(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return c.isNotNull() & ~F.isnan(c)
    return c.isNotNull()


def completeness(df: DataFrame) -> DataFrame:
    """(column, n_present, n_missing) for every column, from one pass."""
    fields = df.schema.fields
    counts = [F.count(F.when(_present(f), 1)).alias(f"_p{i}") for i, f in enumerate(fields)]
    one = df.agg(F.count(F.lit(1)).alias("_n"), *counts)
    lines = F.array(*[
        F.struct(
            F.lit(f.name).alias("column"),
            F.col(f"_p{i}").alias("n_present"),
            (F.col("_n") - F.col(f"_p{i}")).alias("n_missing"),
        )
        for i, f in enumerate(fields)
    ])
    return one.select(F.inline(lines))


def row_completeness(df: DataFrame) -> DataFrame:
    """(n_present, n_rows): how many rows have how many present cells."""
    present = F.lit(0)
    for f in df.schema.fields:
        present = present + _present(f).cast("int")
    return df.groupBy(present.cast("long").alias("n_present")).agg(F.count(F.lit(1)).alias("n_rows"))
