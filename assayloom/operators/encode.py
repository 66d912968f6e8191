"""Ordinal encoding and feature assembly."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.operators.joins import skew_join
from assayloom.operators.rows import with_row_index
from assayloom.session import broadcast_limit, materialise, row_bytes


def _present(df: DataFrame, col: str) -> Column:
    c = F.col(f"`{col}`")
    if isinstance(df.schema[col].dataType, (T.FloatType, T.DoubleType)):
        return F.nanvl(c, F.lit(None))
    return c


def ordinal_codes(df: DataFrame, col: str) -> DataFrame:
    """(value, code): distinct present values numbered 0..k-1 in their own order."""
    values = df.select(_present(df, col).alias("value")).where("value is not null").distinct()
    values = materialise(values, "values")
    return with_row_index(values, ["value"], "code")


@dataclass(frozen=True)
class OrdinalEncoder:
    """Codes of several columns in one stored table, and of each column its field, first place, values and bytes."""

    table: DataFrame
    columns: dict[str, tuple[str, int, int, int]]

    def codes(self, col: str) -> DataFrame:
        """(value, code) of one column."""
        place = list(self.columns).index(col)
        field, first, _, _ = self.columns[col]
        return self.table.where(F.col("column") == place).select(F.col(field).alias("value"), (F.col("place") - first).alias("code"))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with each column's values as codes; a missing value, or one not seen when fitting, gets code k.

        Columns whose codes are within the broadcast limit are looked up in one
        pass over ``df``; the others take a shuffled join each, hot values in pieces.
        """
        limit, names = broadcast_limit(df.sparkSession), df.columns
        for col, (_, _, n, size) in self.columns.items():
            side = self.codes(col).toDF("_value", "_code")
            keyed = df.withColumn("_value", _present(df, col))
            met = keyed.join(F.broadcast(side), "_value", "left") if size <= limit else skew_join(keyed, side, ["_value"])
            df = met.select(*[
                F.coalesce("_code", F.lit(n).cast("long")).alias(c) if c == col else F.col(f"`{c}`") for c in names])
        return df


def fit_ordinal(df: DataFrame, cols: Sequence[str]) -> OrdinalEncoder:
    """Number the distinct present values of every column 0..k-1 in their own order.

    One pass over ``df`` makes the (column, value) pairs distinct, one range sort
    places them all, and each column's codes count from its first place: the
    number of passes and stored tables does not grow with the columns.
    """
    cols = list(cols)
    kinds = list(dict.fromkeys(df.schema[c].dataType.simpleString() for c in cols))
    fields = {c: f"v{kinds.index(df.schema[c].dataType.simpleString())}" for c in cols}
    cells = [F.struct(F.lit(i).alias("column"), *[
        (_present(df, c) if fields[c] == f"v{k}" else F.lit(None)).cast(kind).alias(f"v{k}") for k, kind in enumerate(kinds)])
        for i, c in enumerate(cols)]
    values = [f"v{k}" for k in range(len(kinds))]
    present = reduce(or_, [F.col(v).isNotNull() for v in values])
    pairs = df.select(F.inline(F.array(*cells))).where(present).distinct()
    table = with_row_index(materialise(pairs, "values"), ["column", *values], "place")
    seen = {r["column"]: r for r in table.groupBy("column").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n"), F.sum(row_bytes(table)).alias("size")).collect()}
    return OrdinalEncoder(table, {
        c: (fields[c], seen[i]["first"], seen[i]["n"], seen[i]["size"]) if i in seen else (fields[c], 0, 0, 0) for i, c in enumerate(cols)})


def ordinal_encode(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Replace each column by the codes of its values; a missing value gets code k.

    Codes are fitted on ``fit_on`` (``df`` itself by default).
    """
    return fit_ordinal(fit_on if fit_on is not None else df, cols).transform(df) if cols else df


def assemble(df: DataFrame, features: Sequence[str], out: str = "features", missing: float | None = None) -> DataFrame:
    """Feature columns as one array<double>; ``missing`` replaces nulls when given."""
    def cell(name):
        c = F.col(f"`{name}`").cast("double")
        return F.coalesce(c, F.lit(float(missing))) if missing is not None else c

    return df.withColumn(out, F.array(*[cell(f) for f in features]))
