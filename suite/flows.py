"""Composed flows."""

from pyspark.sql import functions as F

from assayloom.plans import build_compound_dimension, build_model_frame, enrich_prediction, enrich_training
from assayloom.plans.overview import profile, profile_long
from assayloom.session import materialise
from suite.registry import query
from suite.splits import holdout_sql
from suite.tables import (
    CTE_ENRICHED, CTE_PROPERTIES, CTE_ROWS, MAJORITY, MINORITY, PROPERTY_LIST, PROPERTY_NAMES,
    RULES, SEGMENT_CODES, STATS, clean_sql,
)

_IDS = "row_id, cell_type, sm_name, sm_lincs_id, \"SMILES\", control"
_STATS_X = ", ".join(s + "_x" for s in STATS)
_STATS_Y = ", ".join(s + "_y" for s in STATS)
_PROPERTIES = ", ".join(f'"{n}"' for n in PROPERTY_NAMES)


def _enriched(t, **options):
    out = enrich_training(t.rows, t.first_assay, t.second_assay, materialise(t.properties), RULES, **options)
    return out.select(*[F.col(f"`{c}`") for c in out.columns if c != "targets"],
                      F.col("targets")[0].alias("target_0"), F.col("targets")[1].alias("target_1"))


@query(f"WITH {CTE_ENRICHED} SELECT {_IDS}, {_STATS_X}, donor_id, {_STATS_Y}, {_PROPERTIES}, target_0, target_1 FROM enriched")
def enrich_training_rows(t):
    return _enriched(t)


@query(f"""WITH {CTE_ENRICHED},
a AS (SELECT *, ROW_NUMBER() OVER (ORDER BY row_id, donor_id NULLS FIRST) - 1 AS _position FROM enriched),
b AS (SELECT target_0, target_1, ROW_NUMBER() OVER (ORDER BY row_id) - 1 AS _position FROM feats)
SELECT COALESCE(a._position, b._position) AS _position, {_IDS}, {_STATS_X}, donor_id, {_STATS_Y}, {_PROPERTIES},
  b.target_0, b.target_1 FROM a FULL JOIN b ON a._position = b._position""")
def enrich_training_rows_by_position(t):
    return _enriched(t, align="position")


@query(f"""WITH {CTE_PROPERTIES}, n AS (SELECT o_orderkey AS row_id, o_orderstatus AS cell_type,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '4-NONE' ELSE {clean_sql("o_orderpriority || ' ; (x)'")} END AS sm_name FROM orders)
SELECT n.row_id, n.cell_type, n.sm_name, {PROPERTY_LIST} FROM n LEFT JOIN props p ON n.sm_name = p.sm_name""")
def enrich_prediction_rows(t):
    raw = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.col("o_orderpriority")).otherwise(
        F.concat("o_orderpriority", F.lit(" ; (x)"))
    )
    rows = t.orders.select(F.col("o_orderkey").alias("row_id"), F.col("o_orderstatus").alias("cell_type"),
                           raw.alias("sm_name"))
    return enrich_prediction(rows, materialise(t.properties), RULES, row_id="row_id")


@query(f"""WITH {CTE_ROWS}, {CTE_PROPERTIES}
SELECT p.sm_name, {PROPERTY_LIST} FROM props p WHERE sm_name IN (
  SELECT {clean_sql("CASE WHEN sm_raw = '4-NOT SPECIFIED' THEN '4-NONE' ELSE sm_raw END")} FROM raw)""")
def compound_dimension(t):
    return build_compound_dimension(t.rows, t.snapshot, RULES)


@query(f"""WITH {CTE_ENRICHED},
codes AS (SELECT * REPLACE (
  CASE cell_type WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3
    WHEN 'MACHINERY' THEN 4 END AS cell_type,
  DENSE_RANK() OVER (ORDER BY sm_name NULLS LAST) - 1 AS sm_name,
  DENSE_RANK() OVER (ORDER BY sm_lincs_id NULLS LAST) - 1 AS sm_lincs_id,
  DENSE_RANK() OVER (ORDER BY control NULLS LAST) - 1 AS control,
  DENSE_RANK() OVER (ORDER BY donor_id NULLS LAST) - 1 AS donor_id),
  cell_type AS segment, donor_id AS donor FROM enriched),
src AS (SELECT * FROM codes),
{holdout_sql('src', "row_id || ':' || COALESCE(CAST(donor AS VARCHAR), '')", 'segment', 42, 0.2, 0.1)}
SELECT row_id, cell_type, sm_name, sm_lincs_id, control, {_STATS_X}, donor_id, {_STATS_Y}, {_PROPERTIES},
  target_0, target_1, split FROM placed""")
def model_frame(t):
    return build_model_frame(_enriched(t, stored=True), ["row_id", "donor_id"], 42, MAJORITY, MINORITY, SEGMENT_CODES,
                             test_fraction=0.2, val_fraction=0.1)


@query("""WITH j AS (SELECT d.doc_id, d.lang, d.source, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
p AS (SELECT CAST((doc_id IS NOT NULL) AS BIGINT) + CAST((lang IS NOT NULL) AS BIGINT)
  + CAST((source IS NOT NULL) AS BIGINT) + CAST((quality IS NOT NULL) AS BIGINT) AS n FROM j)
SELECT 'n_missing' AS section, 'doc_id' AS item, COUNT(*) - COUNT(doc_id) AS value FROM j
UNION ALL SELECT 'n_missing', 'lang', COUNT(*) - COUNT(lang) FROM j
UNION ALL SELECT 'n_missing', 'source', COUNT(*) - COUNT(source) FROM j
UNION ALL SELECT 'n_missing', 'quality', COUNT(*) - COUNT(quality) FROM j
UNION ALL SELECT 'row_completeness', CAST(n AS VARCHAR), COUNT(*) FROM p GROUP BY n
UNION ALL SELECT 'counts_lang', lang, COUNT(*) FROM j WHERE lang IS NOT NULL GROUP BY lang
UNION ALL SELECT 'counts_source', source, COUNT(*) FROM j WHERE source IS NOT NULL GROUP BY source""")
def table_profile(t):
    table = t.documents.select("doc_id", "lang", "source").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return profile_long(table, ["lang", "source"])


@query("""WITH s AS (SELECT c_mktsegment, MIN(c_custkey) AS first_row, COUNT(*) AS count FROM customer GROUP BY c_mktsegment)
SELECT c_mktsegment, first_row, count, printf('%.1f%%', count * 100.0 / (SELECT COUNT(*) FROM customer)) AS label FROM s""")
def category_profile(t):
    parts = profile(t.customer, ["c_mktsegment"], "c_custkey")
    return parts["values_c_mktsegment"].join(
        parts["shares_c_mktsegment"].select("c_mktsegment", "count", "label"), "c_mktsegment"
    )
