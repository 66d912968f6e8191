"""Name cleaning, aliasing and label lookups as single column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayloom.constants import EXEMPT_NAMES, NAME_ALIASES, NAME_CUTS, STRIP_CLASS


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col: Column | str) -> Column:
    """Remove leading and trailing Unicode whitespace (``trim`` removes spaces only)."""
    return F.regexp_replace(_c(col), f"^[{STRIP_CLASS}]+|[{STRIP_CLASS}]+$", "")


def cut_at(col: Column | str, mark: str) -> Column:
    """Text before the first ``mark``, stripped; the whole text when it has none."""
    return strip_ws(F.substring_index(_c(col), mark, 1))


def clean_name(
    col: Column | str,
    exempt: Iterable[str] = EXEMPT_NAMES,
    cuts: Iterable[str] = NAME_CUTS,
) -> Column:
    """Cut at each mark in turn, unless the name is exempt by then; null stays null."""
    out, exempt = _c(col), list(exempt)
    for mark in cuts:
        out = F.when(out.isin(exempt), out).otherwise(cut_at(out, mark)) if exempt else cut_at(out, mark)
    return out


def alias_name(col: Column | str, aliases: Mapping[str, str] = NAME_ALIASES) -> Column:
    """Replace whole values by their alias; others pass through."""
    raw = _c(col)
    if not aliases:
        return raw
    pairs = iter(aliases.items())
    old, new = next(pairs)
    expr = F.when(raw == old, F.lit(new))
    for old, new in pairs:
        expr = expr.when(raw == old, F.lit(new))
    return expr.otherwise(raw)


def alias_from_table(df: DataFrame, col: str, aliases: DataFrame, old: str, new: str) -> DataFrame:
    """Alias by a table of (old, new) pairs, for lists too long for an expression."""
    from assayloom.operators.joins import dimension_join

    pairs = aliases.select(F.col(old).alias(col), F.col(new).alias("_alias_to"))
    joined = dimension_join(df, pairs, [col], how="left")
    return joined.select(*[
        F.coalesce(F.col("_alias_to"), F.col(f"`{c}`")).alias(c) if c == col else F.col(f"`{c}`")
        for c in df.columns
    ])


def map_label(col: Column | str, codes: Mapping[str, int]) -> Column:
    """Look a label up in a fixed map; null for a null or unknown label."""
    flat = []
    for label, code in codes.items():
        flat += [F.lit(label), F.lit(code)]
    return F.try_element_at(F.create_map(*flat), _c(col))


def member_flag(col: Column | str, members: Iterable) -> Column:
    """1 when the value is a member, else 0 (null gives 0)."""
    return F.when(_c(col).isin(list(members)), F.lit(1)).otherwise(F.lit(0))
