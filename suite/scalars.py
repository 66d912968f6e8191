"""Scalar and vector functions."""

from pyspark.sql import functions as F

from assayloom.functions import vectors as V
from assayloom.functions.names import alias_name, clean_name, cut_at, map_label, member_flag, strip_ws
from suite.registry import query
from suite.tables import SEGMENT_CODES, clean_sql, strip_sql

_LIST = "SELECT vec_id, label, unnest(range(64)) AS i, unnest(embedding) AS x FROM embeddings"


@query(f"SELECT doc_id, {strip_sql("split_part(text, '(', 1)")} AS name FROM documents")
def cut_at_parenthesis(t):
    return t.documents.select("doc_id", cut_at("text", "(").alias("name"))


@query(f"SELECT page_id, {strip_sql("split_part(html, ';', 1)")} AS name FROM pages")
def cut_at_semicolon(t):
    return t.pages.select("page_id", cut_at("html", ";").alias("name"))


@query(f"""WITH n AS (SELECT o_orderkey AS row_id, o_orderpriority || '; ' || o_orderstatus || ' (x)' AS raw FROM orders)
SELECT row_id, CASE WHEN raw IN ('1-URGENT; O (x)', '5-LOW; F (x)') THEN raw ELSE {clean_sql('raw')} END AS sm_name
FROM n""")
def clean_names(t):
    raw = F.concat("o_orderpriority", F.lit("; "), "o_orderstatus", F.lit(" (x)"))
    return t.orders.select(
        F.col("o_orderkey").alias("row_id"),
        clean_name(raw, exempt=["1-URGENT; O (x)", "5-LOW; F (x)"]).alias("sm_name"),
    )


@query(f"SELECT conv_id, turn, {strip_sql('text')} AS text FROM conversations")
def strip_unicode(t):
    padded = F.concat(F.lit("\t\u00a0\u2003 "), "text", F.lit(" \u3000\x1c\r\n"))
    return t.conversations.select("conv_id", "turn", strip_ws(padded).alias("text"))


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '4-NONE' ELSE o_orderpriority END
  AS o_orderpriority FROM orders""")
def alias_values(t):
    return t.orders.select(
        "o_orderkey", alias_name("o_orderpriority", {"4-NOT SPECIFIED": "4-NONE"}).alias("o_orderpriority")
    )


@query("""SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2
  END AS code FROM customer""")
def map_labels(t):
    known = {k: SEGMENT_CODES[k] for k in ("AUTOMOBILE", "BUILDING", "FURNITURE")}
    return t.customer.select("c_custkey", map_label("c_mktsegment", known).alias("code"))


@query("""SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 1 ELSE 0 END AS flag
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def member_flags(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return joined.select("doc_id", member_flag("quality", [1]).alias("flag"))


def _sign_bits(t):
    signs = F.transform("embedding", lambda x: F.when(x > 0, "1").otherwise("0"))
    return t.embeddings.select("vec_id", F.array_join(signs, "").alias("bits"))


@query(f"SELECT vec_id, CAST(i AS INTEGER) AS pos, CASE WHEN x > 0 THEN 1 ELSE 0 END AS bit FROM ({_LIST})")
def bit_string_array(t):
    return _sign_bits(t).select("vec_id", F.posexplode(V.bits_to_array("bits")).alias("pos", "bit"))


@query(f"SELECT vec_id, CAST(i AS INTEGER) AS pos FROM ({_LIST}) WHERE x > 0")
def set_bit_positions(t):
    return _sign_bits(t).select("vec_id", F.explode(V.set_bits(V.bits_to_array("bits"))).alias("pos"))


@query("""SELECT p_partkey, CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS price,
  CAST(TRY_CAST(p_name AS FLOAT) AS DOUBLE) AS name_number FROM part""")
def cast_float32(t):
    return t.part.select(
        "p_partkey", V.to_float32("p_retailprice").cast("double").alias("price"),
        V.to_float32("p_name").cast("double").alias("name_number"),
    )


@query("""SELECT c_mktsegment, COUNT(*) AS n, CAST(FLOOR(CAST(0.1 AS DOUBLE) * COUNT(*)) AS BIGINT) AS tenth
FROM customer GROUP BY c_mktsegment""")
def floor_of_count(t):
    counts = t.customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("tenth", V.floor_fraction("n", 0.1))


@query(f"""SELECT vec_id, CAST(i AS INTEGER) AS pos, CAST(x AS DOUBLE) AS value FROM ({_LIST})
UNION ALL SELECT vec_id, 64, CASE WHEN label IN (0, 1) THEN 1.0 ELSE 0.0 END FROM embeddings""")
def append_flag(t):
    longer = V.append_value(F.col("embedding").cast("array<double>"), member_flag("label", [0, 1]).cast("double"))
    return t.embeddings.select("vec_id", F.posexplode(longer).alias("pos", "value"))


@query("SELECT c_custkey, CAST(0 AS INTEGER) AS pos, c_acctbal AS value FROM customer")
def scalar_vector(t):
    return t.customer.select("c_custkey", F.posexplode(V.as_vector("c_acctbal")).alias("pos", "value"))


@query(f"SELECT vec_id, CAST(i AS INTEGER) AS pos, CASE WHEN x > 0 THEN CAST(x AS DOUBLE) ELSE 0.0 END AS value FROM ({_LIST})")
def relu_vector(t):
    return t.embeddings.select("vec_id", F.posexplode(V.relu("embedding")).alias("pos", "value"))


@query(f"""SELECT vec_id, ROUND(SUM(CAST(x AS DOUBLE) * (i + 1)) / 64 + CAST(0.5 AS DOUBLE), 6) AS value
FROM ({_LIST}) GROUP BY vec_id""")
def affine_one_output(t):
    weights = [(i + 1) / 64 for i in range(64)]
    return t.embeddings.select("vec_id", F.round(V.affine("embedding", weights, 0.5), 6).alias("value"))


@query(f"""SELECT vec_id, CAST(k AS INTEGER) AS pos,
  ROUND(SUM(CAST(x AS DOUBLE) * ((i * (k + 1)) % 7 - 3)) + CAST(k AS DOUBLE) / 2, 6) AS value
FROM ({_LIST}), (SELECT unnest(range(8)) AS k) GROUP BY vec_id, k""")
def affine_many_outputs(t):
    weights = [[(i * (k + 1)) % 7 - 3 for i in range(64)] for k in range(8)]
    scored = V.affine_many(t.embeddings.select("vec_id", "embedding"), "embedding", weights, [k / 2 for k in range(8)])
    return scored.select("vec_id", F.posexplode("affine").alias("pos", "value")).withColumn(
        "value", F.round("value", 6)
    )


@query("""WITH c AS (SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type)
SELECT event_type, printf('%.1f%%', n * 100.0 / (SELECT SUM(n) FROM c)) AS label FROM c""")
def percent_labels(t):
    from assayloom.operators.stats import value_shares

    return value_shares(t.events, "event_type").select("event_type", V.percent_label("percent").alias("label"))
