"""Aggregations."""

from pyspark.sql import functions as F

from assayloom.functions.vectors import relu
from assayloom.operators import stats as S
from assayloom.operators.profile import completeness, row_completeness
from assayloom.operators.split import split_summary
from suite.registry import query
from suite.tables import CTE_FIRST, CTE_SECOND, EXACT, STATS, rounded_stats


@query(f"WITH {CTE_FIRST} SELECT obs_id, {', '.join(STATS)} FROM stats1")
def observation_stats(t):
    return S.agg_stats(t.measurements, ["obs_id"], exact=EXACT)


@query(f"WITH {CTE_SECOND} SELECT obs_id, {', '.join(STATS)} FROM stats2")
def second_assay_stats(t):
    return S.agg_stats(t.second_measurements, ["obs_id"], exact=EXACT)


@query(f"WITH {CTE_FIRST} SELECT s.cell_type, s.sm_name, {rounded_stats('s', '')} FROM summary1 s")
def group_stats(t):
    return t.first_assay.summary()


@query(f"WITH {CTE_SECOND} SELECT s.cell_type, s.donor_id, {rounded_stats('s', '')} FROM summary2 s")
def donor_stats(t):
    return t.second_assay.summary()


@query("SELECT o_orderpriority, COUNT(*) AS count FROM orders GROUP BY o_orderpriority")
def value_counts(t):
    return S.value_counts(t.orders, "o_orderpriority")


@query("""SELECT c_mktsegment, COUNT(*) AS count, ROUND(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM customer), 6) AS percent
FROM customer GROUP BY c_mktsegment""")
def value_shares(t):
    return S.value_shares(t.customer, "c_mktsegment").withColumn("percent", F.round("percent", 6))


@query("SELECT l_partkey, MIN(l_orderkey) AS first_row FROM lineitem GROUP BY l_partkey")
def first_seen_values(t):
    return S.first_seen(t.lineitem, "l_partkey", "l_orderkey")


@query("SELECT DISTINCT user_id FROM events")
def distinct_values(t):
    return S.distinct_values(t.events, "user_id")


@query("SELECT COUNT(*) AS n_rows FROM conversations")
def row_counts(t):
    return S.row_count(t.conversations)


def _labelled(t):
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")


_LABELLED = "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


@query(f"""WITH j AS ({_LABELLED})
SELECT 'doc_id' AS "column", COUNT(doc_id) AS n_present, COUNT(*) - COUNT(doc_id) AS n_missing FROM j
UNION ALL SELECT 'lang', COUNT(lang), COUNT(*) - COUNT(lang) FROM j
UNION ALL SELECT 'quality', COUNT(quality), COUNT(*) - COUNT(quality) FROM j
UNION ALL SELECT 'toxic', COUNT(toxic), COUNT(*) - COUNT(toxic) FROM j""")
def column_completeness(t):
    return completeness(_labelled(t))


@query(f"""WITH j AS ({_LABELLED}), p AS (SELECT CAST((doc_id IS NOT NULL) AS BIGINT) + CAST((lang IS NOT NULL) AS BIGINT)
  + CAST((quality IS NOT NULL) AS BIGINT) + CAST((toxic IS NOT NULL) AS BIGINT) AS n_present FROM j)
SELECT n_present, COUNT(*) AS n_rows FROM p GROUP BY n_present""")
def cells_per_row(t):
    return row_completeness(_labelled(t))


@query("""SELECT ROUND(AVG((l_extendedprice - l_quantity * 1000) * (l_extendedprice - l_quantity * 1000)) / 1000000, 4) AS mse
FROM lineitem""")
def squared_error(t):
    scored = t.lineitem.select((F.col("l_quantity") * 1000).alias("pred"), F.col("l_extendedprice").alias("truth"))
    return S.mean_squared_error(scored, "pred", "truth").select(F.round(F.col("mse") / 1000000, 4).alias("mse"))


@query("""WITH e AS (SELECT CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
SELECT ROUND(AVG(CASE WHEN x < 0 THEN x * x ELSE 0 END), 8) AS mse FROM e""")
def squared_error_vectors(t):
    scored = t.embeddings.select(relu("embedding").alias("pred"), F.col("embedding").alias("truth"))
    return S.mean_squared_error(scored, "pred", "truth").select(F.round("mse", 8).alias("mse"))


@query("""SELECT 'n_train' AS label, COUNT(*) AS value FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT'
UNION ALL SELECT 'n_val', COUNT(*) FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT'
UNION ALL SELECT 'n_test', COUNT(*) FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'n_features', MAX(LEN([o_custkey, o_totalprice])) FROM orders
UNION ALL SELECT 'n_targets', MAX(LEN([o_orderkey])) FROM orders""")
def split_sizes(t):
    val = F.col("o_orderpriority") == "1-URGENT"
    split = F.when(F.col("o_orderstatus") == "P", "test").when(val, "val").otherwise("train")
    frame = t.orders.select(
        split.alias("split"), F.array("o_custkey", "o_totalprice").alias("features"), F.array("o_orderkey").alias("targets"))
    return split_summary(frame, "features", "targets")


@query("""WITH e AS (SELECT embedding AS p, CASE WHEN vec_id % 3 = 0 THEN NULL ELSE list_reverse(embedding) END AS t FROM embeddings)
SELECT ROUND(SUM(list_sum([(CAST(p[i] AS DOUBLE) - t[i]) * (CAST(p[i] AS DOUBLE) - t[i]) FOR i IN range(1, 65)])) / (COUNT(t) * 64), 6) AS mse FROM e""")
def squared_error_null_truth(t):
    truth = F.when(F.col("vec_id") % 3 != 0, F.reverse("embedding"))
    scored = t.embeddings.select(F.col("embedding").alias("pred"), truth.alias("truth"))
    return S.mean_squared_error(scored, "pred", "truth").select(F.round("mse", 6).alias("mse"))
