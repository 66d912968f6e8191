"""Grouped statistics under dataframe-library null rules.

Rows with a null key are left out, NaN counts as missing, and the sum of an
all-missing group is 0 while its mean is null. Every aggregate here combines
on the map side, so a key holding a third of the rows costs one partial row
per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.constants import GROUP_STATS, OBSERVATION_STATS
from assayloom.operators.joins import left_lookup
from assayloom.operators.select import not_null


def measure(col: str) -> Column:
    """A measure in double with NaN as null."""
    return F.nanvl(F.col(f"`{col}`").cast("double"), F.lit(None).cast("double"))


def _sum(col: str, exact: tuple[int, int] | None) -> Column:
    m = measure(col)
    if exact:
        m = m.cast(T.DecimalType(*exact))
    return F.coalesce(F.sum(m).cast("double"), F.lit(0.0))


def _mean(col: str, exact: tuple[int, int] | None) -> Column:
    m = measure(col)
    if not exact:
        return F.avg(m)
    n = F.count(m)
    return F.when(n > 0, F.sum(m.cast(T.DecimalType(*exact))).cast("double") / n)


_FUNCTIONS = {"sum": _sum, "mean": _mean}


def agg_stats(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Sequence[str]] = OBSERVATION_STATS,
    exact: tuple[int, int] | None = None,
) -> DataFrame:
    """Several functions of several measures per key, named ``measure_function``.

    ``exact=(precision, scale)`` sums in decimal, so that results do not depend
    on the order in which partial sums arrive.
    """
    out = [_FUNCTIONS[fn](m, exact).alias(f"{m}_{fn}") for m, fns in measures.items() for fn in fns]
    return not_null(df, keys).groupBy(*keys).agg(*out)


def regroup_stats(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str] = GROUP_STATS,
    exact: tuple[int, int] | None = None,
) -> DataFrame:
    """One function per measure, names unchanged: means of means, sums of sums.

    ``exact`` applies to the sums; a mean of means has no fixed scale.
    """
    out = [_FUNCTIONS[fn](m, exact if fn == "sum" else None).alias(m) for m, fn in measures.items()]
    return not_null(df, keys).groupBy(*keys).agg(*out)


def group_summary(
    measurements: DataFrame,
    metadata: DataFrame,
    obs_key: str,
    group_keys: Sequence[str],
    exact: tuple[int, int] | None = None,
) -> DataFrame:
    """Per-observation statistics, then unweighted statistics per metadata group.

    Only the keys and the measures are read. Observations without metadata have
    null group keys and drop out in the second grouping.
    """
    per_obs = agg_stats(measurements, [obs_key], OBSERVATION_STATS, exact)
    meta = metadata.select(obs_key, *group_keys)
    return regroup_stats(left_lookup(per_obs, meta, [obs_key]), group_keys, GROUP_STATS, exact)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, count) of the non-null values, most frequent first, ties by value."""
    return (
        df.where(F.col(f"`{col}`").isNotNull()).groupBy(F.col(f"`{col}`")).agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.col(f"`{col}`"))
    )


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """Value counts with each value's percentage of the total."""
    counts = df.where(F.col(f"`{col}`").isNotNull()).groupBy(F.col(f"`{col}`")).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("percent", F.col("count") * F.lit(100.0) / total)


def first_seen(df: DataFrame, col: str, row_id: str = "row_id") -> DataFrame:
    """Distinct values, null included, in the order of first appearance."""
    return df.groupBy(F.col(f"`{col}`")).agg(F.min(row_id).alias("first_row")).orderBy("first_row")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """The set of values."""
    return df.select(F.col(f"`{col}`")).distinct()


def row_count(df: DataFrame) -> DataFrame:
    """One row (n_rows)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def mean_squared_error(df: DataFrame, pred: str, truth: str) -> DataFrame:
    """One row (mse); arrays are averaged over all outputs of the rows that have both sides whole.

    Arrays of different lengths are an error.
    """
    if isinstance(df.schema[pred].dataType, T.ArrayType):
        from assayloom.functions.vectors import squared_error_sum

        row = F.when(F.size(pred) != F.size(truth), F.raise_error(F.lit("arrays of different lengths"))).otherwise(
            squared_error_sum(pred, truth))
        row = F.when(F.col(pred).isNotNull() & F.col(truth).isNotNull(), row)
        return df.agg((F.sum(row) / F.sum(F.when(row.isNotNull(), F.size(pred)))).alias("mse"))
    diff = F.col(pred).cast("double") - F.col(truth).cast("double")
    return df.agg(F.avg(diff * diff).alias("mse"))
