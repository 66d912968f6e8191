"""A first look at a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.functions.vectors import percent_label
from assayloom.operators.profile import completeness, row_completeness
from assayloom.operators.rows import column_listing, peek
from assayloom.operators.stats import first_seen, value_shares


def profile(df: DataFrame, categories: Sequence[str], row_id: str = "row_id") -> dict[str, DataFrame]:
    """First rows, columns, completeness and category distributions, each a lazy table."""
    parts = {
        "head": peek(df, [row_id]),
        "columns": column_listing(df, "table"),
        "completeness": completeness(df),
        "row_completeness": row_completeness(df),
    }
    for c in categories:
        parts[f"shares_{c}"] = value_shares(df, c).withColumn("label", percent_label(F.col("percent")))
        parts[f"values_{c}"] = first_seen(df, c, row_id)
    return parts


def profile_long(df: DataFrame, categories: Sequence[str]) -> DataFrame:
    """(section, item, value): completeness and category counts as one table."""
    out = completeness(df).select(
        F.lit("n_missing").alias("section"), F.col("column").alias("item"), F.col("n_missing").alias("value")
    )
    rows = row_completeness(df).select(
        F.lit("row_completeness").alias("section"), F.col("n_present").cast("string").alias("item"),
        F.col("n_rows").alias("value"),
    )
    out = out.unionByName(rows)
    for c in categories:
        counts = df.where(F.col(f"`{c}`").isNotNull()).groupBy(F.col(f"`{c}`").cast("string").alias("item")).agg(
            F.count(F.lit(1)).alias("value")
        )
        out = out.unionByName(counts.select(F.lit(f"counts_{c}").alias("section"), "item", "value"))
    return out
