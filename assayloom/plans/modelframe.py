"""Encoded features, targets and split in one table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame

from assayloom.constants import CELL_TYPE_CODES, MAJORITY_CELL_TYPES, MINORITY_CELL_TYPES
from assayloom.functions.names import map_label
from assayloom.operators.encode import ordinal_encode
from assayloom.operators.select import drop_columns
from assayloom.operators.split import group_holdout


def build_model_frame(
    enriched: DataFrame,
    ids: Sequence[str],
    seed: int | str = 42,
    majority: Iterable = MAJORITY_CELL_TYPES,
    minority: Iterable = MINORITY_CELL_TYPES,
    cell_type_codes: Mapping[str, int] = CELL_TYPE_CODES,
    ordinal: Sequence[str] = ("sm_name", "sm_lincs_id", "control", "donor_id"),
    drop: Sequence[str] = ("SMILES",),
    minority_train: float = 0.1,
    test_fraction: float = 0.0,
    val_fraction: float = 0.0,
) -> DataFrame:
    """Group-aware split, then dropped, mapped and ordinally encoded columns.

    Encodings are fitted on all rows, before rows outside both groups are left
    out. Give a stored table, or one cheap to make from stored tables (``stored`` of
    ``enrich_training``): it is read twice for the first draws, once for the validation
    draw and once for the codes of all encoded columns, each time only the columns needed.
    """
    split = group_holdout(
        enriched, ids, "cell_type", majority, minority, seed, minority_train, test_fraction, val_fraction
    )
    encoded = ordinal_encode(drop_columns(split, list(drop)), list(ordinal), fit_on=enriched)
    return encoded.withColumn("cell_type", map_label("cell_type", cell_type_codes))
