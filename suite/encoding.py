"""Encoding and feature assembly."""

from pyspark.sql import functions as F

from assayloom.functions.names import map_label
from assayloom.operators.encode import assemble, ordinal_codes, ordinal_encode
from assayloom.operators.select import split_features_targets
from suite.registry import query
from suite.tables import SEGMENT_CODES


@query("""SELECT DISTINCT user_id AS value, DENSE_RANK() OVER (ORDER BY user_id) - 1 AS code FROM events""")
def ordinal_code_table(t):
    return ordinal_codes(t.events, "user_id")


@query("""SELECT d.doc_id, DENSE_RANK() OVER (ORDER BY d.source) - 1 AS source,
  DENSE_RANK() OVER (ORDER BY d.lang) - 1 AS lang,
  DENSE_RANK() OVER (ORDER BY l.quality NULLS LAST) - 1 AS quality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def ordinal_encoding(t):
    table = t.documents.select("doc_id", "source", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return ordinal_encode(table, ["source", "lang", "quality"])


@query("""SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2
  WHEN 'HOUSEHOLD' THEN 3 WHEN 'MACHINERY' THEN 4 END AS c_mktsegment FROM customer""")
def fixed_map_encoding(t):
    return t.customer.select("c_custkey", map_label("c_mktsegment", SEGMENT_CODES).alias("c_mktsegment"))


@query("""SELECT o_orderkey, CAST(0 AS INTEGER) AS pos, o_totalprice AS value FROM orders
UNION ALL SELECT o_orderkey, 1, CAST(o_custkey AS DOUBLE) FROM orders
UNION ALL SELECT d.doc_id, 2, CAST(COALESCE(quality, -1) AS DOUBLE) FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def feature_matrix(t):
    orders = assemble(t.orders, ["o_totalprice", "o_custkey"]).select(
        "o_orderkey", F.posexplode("features").alias("pos", "value")
    )
    docs = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    filled = assemble(docs, ["quality"], missing=-1.0).select(
        F.col("doc_id").alias("o_orderkey"), F.lit(2).alias("pos"), F.col("features")[0].alias("value")
    )
    return orders.unionByName(filled)


@query("""SELECT p_partkey, p_size, 'feature' AS side, CAST(NULL AS DOUBLE) AS p_retailprice FROM part
UNION ALL SELECT NULL, NULL, 'target', p_retailprice FROM part""")
def features_and_targets(t):
    table = t.part.select("p_partkey", "p_size", "p_retailprice")
    features, targets = split_features_targets(table, ["p_partkey", "p_size"])
    return features.withColumn("side", F.lit("feature")).unionByName(
        targets.withColumn("side", F.lit("target")), allowMissingColumns=True
    )
