"""The compound property table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.constants import COMPOUND_PROPERTIES
from assayloom.functions.names import alias_name, clean_name
from assayloom.operators.lookup import lookup_provider, lookup_snapshot, property_table
from assayloom.operators.select import not_null
from assayloom.plans.enrich import NameRules


def compound_names(rows: DataFrame, rules: NameRules = NameRules()) -> DataFrame:
    """Distinct compound names, aliased and then cleaned.

    Made distinct again after cleaning: two spellings that clean to one name
    must not give the property table two rows for it.
    """
    raw = not_null(rows.select("sm_name"), ["sm_name"]).distinct()
    return raw.select(clean_name(alias_name("sm_name", rules.aliases), rules.exempt).alias("sm_name")).distinct()


def build_compound_dimension(
    rows: DataFrame,
    source: DataFrame | Callable[[str], Mapping | None],
    rules: NameRules = NameRules(),
    rank: Sequence[str] = ("rank",),
    fields: T.StructType = COMPOUND_PROPERTIES,
    partitions: int | None = None,
) -> DataFrame:
    """One row of properties per compound name found in ``source``.

    ``source`` is a property snapshot (first hit by ``rank``) or a function
    asked once per name; names without properties are left out.
    """
    names = compound_names(rows, rules)
    wanted = fields.fieldNames()
    if isinstance(source, DataFrame):
        found = lookup_snapshot(names, source, "sm_name", rank, wanted)
    else:
        found = lookup_provider(names, "sm_name", source, fields, partitions).where(F.col("found"))
    return property_table(found, "sm_name", wanted)
