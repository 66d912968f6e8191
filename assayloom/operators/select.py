"""Column selection and naming."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str):
    """A column by its literal name, dashes and dots included."""
    return F.col(f"`{name}`")


def select_lenient(df: DataFrame, names: Sequence[str], missing_type: str = "double") -> DataFrame:
    """Select by name; a name that does not exist becomes an all-null column."""
    have = set(df.columns)
    return df.select(*[
        quoted(n) if n in have else F.lit(None).cast(missing_type).alias(n) for n in names
    ])


def select_strict(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Select by name; a missing name is an error."""
    return df.select(*[quoted(n) for n in names])


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Everything but ``names``; a missing name is an error."""
    unknown = [n for n in names if n not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    return df.drop(*names)


def slice_columns(df: DataFrame, start: int | None = None, stop: int | None = None) -> DataFrame:
    """Columns by position, as a Python slice."""
    return select_strict(df, df.columns[start:stop])


def last_column_first(df: DataFrame) -> DataFrame:
    """Rotate the last column to the front."""
    return select_strict(df, [df.columns[-1], *df.columns[:-1]])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; unknown names are ignored."""
    return df.withColumnsRenamed(dict(names))


def split_features_targets(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(listed columns, all other columns)."""
    return select_strict(df, features), drop_columns(df, features)


def not_null(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows in which every named column is present.

    Plain ``IS NOT NULL`` conditions, which reach the Parquet scan (``dropna``
    does not). NaN counts as missing.
    """
    for n in names:
        present = quoted(n).isNotNull()
        if isinstance(df.schema[n].dataType, (T.FloatType, T.DoubleType)):
            present = present & ~F.isnan(quoted(n))
        df = df.where(present)
    return df


def keep_found(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` is not null."""
    return df.where(quoted(col).isNotNull())
