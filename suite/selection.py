"""Column and row selection."""

from pyspark.sql import functions as F

from assayloom.operators.rows import gather, gather_in_order, ids_where_member, with_row_index
from assayloom.operators.select import (
    drop_columns, keep_found, last_column_first, rename, select_lenient, select_strict, slice_columns,
)
from assayloom.operators.stats import agg_stats
from suite.registry import query
from suite.tables import EXACT


@query("""SELECT c_custkey, CAST(NULL AS DOUBLE) AS c_score, c_mktsegment FROM customer""")
def lenient_select(t):
    return select_lenient(t.customer, ["c_custkey", "c_score", "c_mktsegment"])


@query("SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def drop_listed_columns(t):
    return drop_columns(t.customer, ["c_name", "c_acctbal"])


@query("SELECT s_name, s_suppkey FROM supplier")
def strict_select(t):
    return select_strict(t.supplier, ["s_name", "s_suppkey"])


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part")
def all_but_last_column(t):
    return slice_columns(t.part, None, -1)


@query("SELECT p_retailprice FROM part")
def last_column(t):
    return slice_columns(t.part, -1, None)


@query("SELECT n_regionkey, n_nationkey, n_name FROM nation")
def last_column_to_front(t):
    return last_column_first(t.nation)


@query("SELECT event_id AS obs_id, value AS count, event_type FROM events")
def rename_columns(t):
    return rename(t.events.select("event_id", "value", "event_type"), {"event_id": "obs_id", "value": "count"})


@query("""SELECT l_returnflag, CAST(SUM(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS l_quantity_sum,
  ROUND(CAST(SUM(CAST(l_tax AS DECIMAL(18,4))) AS DOUBLE) / COUNT(l_tax), 6) AS l_tax_mean
FROM lineitem GROUP BY l_returnflag""")
def flat_stat_names(t):
    out = agg_stats(t.lineitem, ["l_returnflag"], {"l_quantity": ["sum"], "l_tax": ["mean"]}, EXACT)
    return out.withColumn("l_tax_mean", F.round("l_tax_mean", 6))


@query("""SELECT o_orderkey AS row_id FROM orders WHERE o_orderpriority = '1-URGENT' OR o_orderpriority = '5-LOW'""")
def member_row_ids(t):
    return ids_where_member(t.orders.withColumnRenamed("o_orderkey", "row_id"), "o_orderpriority",
                            ["1-URGENT", "5-LOW"])


@query("""SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def gather_rows(t):
    ids = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return gather(t.orders.select("o_orderkey", "o_totalprice"), ids, "o_orderkey")


@query("""SELECT event_id AS position, c_custkey, c_name FROM events JOIN customer ON user_id = c_custkey""")
def gather_rows_in_order(t):
    ids = t.events.select(F.col("user_id").alias("c_custkey"), F.col("event_id").alias("position"))
    return gather_in_order(t.customer.select("c_custkey", "c_name"), ids, "c_custkey")


@query("""SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS row_index FROM orders""")
def row_index(t):
    return with_row_index(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"]).select(
        "o_orderkey", "row_index"
    )


@query("""SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE quality IS NOT NULL""")
def not_null_filter(t):
    return keep_found(t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left"),
                      "quality")
