"""Table writers."""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _path_of(uri: str) -> str:
    return unquote(urlparse(uri).path).rstrip("/")


def _refuse_self_overwrite(df: DataFrame, path: str) -> None:
    target = _path_of(path)
    for source in df.inputFiles():
        source = _path_of(source)
        if source == target or source.startswith(target + "/"):
            raise ValueError(f"{path} is being read by the table to be written")


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet sink; refuses to overwrite a path the table itself reads."""
    if mode == "overwrite":
        _refuse_self_overwrite(df, path)
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with a header and without a row index.

    Array, struct and map columns are written as JSON text, since CSV has no
    nested values. Overwriting a path the table itself reads is refused.
    """
    if mode == "overwrite":
        _refuse_self_overwrite(df, path)
    nested = (T.ArrayType, T.StructType, T.MapType)
    flat = df.select(*[
        F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
    (flat.write.mode(mode)
        .options(header=True, quote='"', escape='"', emptyValue="",
                 ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path))
