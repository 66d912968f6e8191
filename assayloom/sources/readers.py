"""Table readers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.constants import NULL_TOKENS


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Lazy Parquet scan; columns and filters are pushed into it by Catalyst."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
_BOOLEAN = ("True", "TRUE", "true", "False", "FALSE", "false")


def infer_types(text: DataFrame) -> T.StructType:
    """Types of text columns from their present values, in one pass over the table.

    Whole numbers give bigint (nullable, where others would turn to float because
    of a missing value), other numbers double, truth values boolean, a column with
    no value at all double, and everything else string.
    """
    checks = []
    for i, name in enumerate(text.columns):
        c = F.col(f"`{name}`")
        whole = c.rlike(_INTEGER) & F.trim(c).try_cast("bigint").isNotNull()
        checks += [
            F.count(c).alias(f"n{i}"), F.count_if(whole).alias(f"whole{i}"),
            F.count_if(c.rlike(_NUMBER)).alias(f"number{i}"), F.count_if(c.isin(*_BOOLEAN)).alias(f"truth{i}"),
        ]
    seen = text.agg(*checks).first()
    fields = []
    for i, name in enumerate(text.columns):
        n = seen[f"n{i}"]
        if n == 0 or n == seen[f"number{i}"]:
            kind = T.LongType() if n and n == seen[f"whole{i}"] else T.DoubleType()
        else:
            kind = T.BooleanType() if n == seen[f"truth{i}"] else T.StringType()
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multiline: bool = False,
    null_tokens: Iterable[str] = NULL_TOKENS,
) -> DataFrame:
    """CSV with a header; quotes are doubled inside quoted fields.

    Fields are read as text, every null token becomes null, and the rest is cast
    to ``schema`` (a value that does not parse becomes null; nested types are read
    from JSON text, as ``write_csv`` writes them). A schema's columns are found by
    the header's names; one that the file lacks is an error. Without a schema
    the types are found from the values, at the cost of a pass over the file.
    ``multiline`` allows line breaks inside quoted fields; such files cannot be
    split, so prefer many part files to one large one.
    """
    reader = spark.read.options(
        header=True, quote='"', escape='"', multiLine=multiline,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    raw = reader.csv(path)
    if schema is not None:
        lacking = [n for n in schema.fieldNames() if n not in raw.columns]
        if lacking:
            raise ValueError(f"{path} has no column {lacking}")
        raw = raw.select(*[F.col(f"`{n}`") for n in schema.fieldNames()])
    tokens = list(null_tokens)
    text = raw.select(*[
        F.when(~F.col(f"`{n}`").isin(tokens), F.col(f"`{n}`")).alias(n) for n in raw.columns
    ])
    schema = schema if schema is not None else infer_types(text)
    return text.select(*[_parsed(f).alias(f.name) for f in schema.fields])


def _parsed(field: T.StructField):
    """A text field as its type."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return c
    if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
        return F.from_json(c, field.dataType)
    return F.trim(c).try_cast(field.dataType)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, **csv_options) -> DataFrame:
    """Read by file suffix: ``.parquet`` or ``.csv``."""
    plain = path.rstrip("/")
    if plain.endswith(".parquet"):
        return read_parquet(spark, path, schema)
    if plain.endswith(".csv"):
        return read_csv(spark, path, schema, **csv_options)
    raise ValueError(f"no reader for the suffix of {path!r}")


def rows_to_table(spark: SparkSession, rows: Iterable[Mapping], schema: T.StructType) -> DataFrame:
    """Records with named fields as a table; no records give an empty typed table."""
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
