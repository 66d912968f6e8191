"""Enrichment of training rows and of rows to predict."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.constants import EXEMPT_NAMES, FEATURE_COLUMNS, GROUP_STATS, NAME_ALIASES
from assayloom.functions.names import alias_name, clean_name
from assayloom.operators.joins import assert_unique, concat_columns, dimension_join, hot_keys, suffix_join
from assayloom.operators.select import select_lenient, select_strict
from assayloom.operators.stats import group_summary
from assayloom.session import fits_broadcast, materialise, spread_scan

_FANNED = 1 << 19    # fanned-out rows that a task sorts when rows are numbered


@dataclass(frozen=True)
class Assay:
    """A long measurement table and the metadata of its observations.

    ``exact`` sums in decimal(precision, scale) and ``decimals`` rounds the group
    statistics, so that results do not vary with the order of additions.
    """

    measurements: DataFrame
    metadata: DataFrame
    group_keys: Sequence[str]
    obs_key: str = "obs_id"
    exact: tuple[int, int] | None = None
    decimals: int | None = None

    def summary(self) -> DataFrame:
        out = group_summary(self.measurements, self.metadata, self.obs_key, self.group_keys, self.exact)
        if self.decimals is None:
            return out
        return out.withColumns({s: F.round(s, self.decimals) for s in GROUP_STATS})


@dataclass(frozen=True)
class NameRules:
    """How compound names are normalised."""

    exempt: Iterable[str] = EXEMPT_NAMES
    aliases: Mapping[str, str] = field(default_factory=lambda: dict(NAME_ALIASES))


def _refuse_enriched(df: DataFrame, properties: DataFrame, key: str) -> None:
    again = [c for c in properties.columns if c != key and c in df.columns]
    if again:
        raise ValueError(f"already enriched: {again}")


def enrich_training(
    rows: DataFrame,
    first: Assay,
    second: Assay,
    properties: DataFrame,
    rules: NameRules = NameRules(),
    row_id: str = "row_id",
    targets: Sequence[str] = ("targets",),
    align: str = "row_id",
    clean_metadata: bool = False,
    check_properties: bool = False,
    stored: bool = False,
) -> DataFrame:
    """Training features, both assay summaries, compound properties and targets.

    The second summary has one row per (cell type, donor), so a training row
    becomes one row per donor of its cell type. ``align='row_id'`` keeps each
    row's own targets through that; ``align='position'`` puts the n-th target
    row beside the n-th enriched row, as a column-wise concat of two tables
    without a common key does, and pads the shorter side with nulls.

    ``rows`` are fanned out in the pieces they come in: give a small table in as
    many as there are cores (``spread_scan``). Names are cleaned before the summaries are joined and aliased after; the
    first assay's metadata names are cleaned only with ``clean_metadata``.
    ``stored`` is for a result that is read more than once. Rows whose donors are
    broadcast are stored before these are joined: to read a row and fan it out
    again costs less than to store every donor's copy. Other results are stored whole.
    """
    _refuse_enriched(rows, properties, "sm_name")
    if check_properties:
        assert_unique(properties, ["sm_name"])
    if clean_metadata:
        cleaned = first.metadata.withColumn("sm_name", clean_name("sm_name", rules.exempt))
        first = replace(first, metadata=cleaned)
    carried = list(targets) if align == "row_id" else []
    features = select_lenient(rows, [row_id, *FEATURE_COLUMNS, *carried])
    features = features.withColumn("sm_name", clean_name("sm_name", rules.exempt))

    out = dimension_join(features, first.summary(), first.group_keys, freeze=True, spread=[row_id])
    aliased = alias_name("sm_name", rules.aliases)
    out = dimension_join(out.withColumn("sm_name", aliased), properties, ["sm_name"], spread=[row_id],
                         count_on=features.select(aliased.alias("sm_name")))
    # The donors come last: everything before them is done once per row, not once per donor.
    shared = [k for k in second.group_keys if k in features.columns]
    donors = [k for k in second.group_keys if k not in shared]
    summary = materialise(second.summary(), "dimension")
    donors_last = stored and align == "row_id" and fits_broadcast(summary)
    if donors_last:
        out = spread_scan(materialise(out, "enriched"), [row_id])
    # Rows are numbered in the order of their ids and donors: they are dealt out in ranges of ids while they are few, and
    # the broadcast donors leave them there. A hot id would not spread, so such a table is sorted as a whole.
    ranged = align == "position" and fits_broadcast(summary) and hot_keys(features, [row_id]).isEmpty()
    if ranged:
        most = summary.groupBy(*shared).count().agg(F.max("count").alias("n")).first()["n"] or 1
        pieces = max(rows.sparkSession.sparkContext.defaultParallelism, -(-features.count() * most // _FANNED))
        out = out.repartitionByRange(pieces, row_id)
    out = suffix_join(out, summary, shared, spread=[row_id],
                      count_on=features.select(*shared), many=True)

    known = [c for c in properties.columns if c != "sm_name"]
    stats = [c for c in out.columns if c not in {row_id, *FEATURE_COLUMNS, *known, *carried}]
    out = select_strict(out, [row_id, *FEATURE_COLUMNS, *stats, *known, *carried])
    if align == "row_id":
        return materialise(out, "enriched") if stored and not donors_last else out
    wide = rows.select(row_id, *targets)
    donors = [F.col(f"`{d}`") for d in donors]
    side = wide.withColumnRenamed(row_id, "_target_row")
    placed = concat_columns(out, side, "position", row_id, [F.col(row_id), *donors], [F.col("_target_row")],
                            ranged=ranged).drop("_target_row")
    return materialise(placed, "enriched") if stored else placed


def enrich_prediction(
    rows: DataFrame,
    properties: DataFrame,
    rules: NameRules = NameRules(),
    alias_first: bool = True,
    columns: Sequence[str] = ("cell_type", "sm_name"),
    row_id: str | None = None,
) -> DataFrame:
    """Rows to predict with their compound properties.

    Names are aliased and then cleaned; ``alias_first=False`` uses the order of
    ``enrich_training``. Enriching twice is an error.
    """
    _refuse_enriched(rows, properties, "sm_name")
    keep = [*([row_id] if row_id else []), *columns]
    out = select_lenient(rows, keep)
    if alias_first:
        name = clean_name(alias_name("sm_name", rules.aliases), rules.exempt)
    else:
        name = alias_name(clean_name("sm_name", rules.exempt), rules.aliases)
    return dimension_join(out.withColumn("sm_name", name), properties, ["sm_name"]).select(
        *keep, *[F.col(f"`{c}`") for c in properties.columns if c != "sm_name"]
    )
