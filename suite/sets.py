"""Set algebra, appends, first matches, positions."""

from pyspark.sql import functions as F

from assayloom.operators import sets as S
from assayloom.operators.rows import row_at, with_row_index
from assayloom.operators.stats import first_seen, value_counts
from suite.registry import query


@query("""SELECT o_orderkey AS row_id FROM orders UNION ALL SELECT l_orderkey FROM lineitem""")
def union_of_ids(t):
    return S.union_ids(
        t.orders.select(F.col("o_orderkey").alias("row_id")), t.lineitem.select(F.col("l_orderkey").alias("row_id")),
    )


@query("""SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""")
def append_rows_by_name(t):
    return S.append_rows(
        t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
                          F.col("c_mktsegment").alias("segment")),
        t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")),
    )


@query("""SELECT o_orderkey AS row_id FROM orders EXCEPT SELECT l_orderkey FROM lineitem""")
def difference_of_ids(t):
    return S.difference_ids(
        t.orders.select(F.col("o_orderkey").alias("row_id")), t.lineitem.select(F.col("l_orderkey").alias("row_id"))
    )


@query("""SELECT p_brand, COUNT(*) AS count, DENSE_RANK() OVER (ORDER BY COUNT(*) DESC, p_brand) - 1 AS place
FROM part GROUP BY p_brand""")
def sorted_counts(t):
    counts = value_counts(t.part, "p_brand")
    return with_row_index(counts, [F.desc("count"), F.col("p_brand")], "place")


@query("""SELECT user_id, event_id, event_type, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def first_match_per_key(t):
    return S.first_match(t.events, "user_id", ["ts", "event_id"], ["event_id", "event_type", "value"])


@query("""WITH s AS (SELECT user_id, MIN(event_id) AS first_row FROM events GROUP BY user_id),
r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY first_row) - 1 AS row_index FROM s)
SELECT user_id, first_row, row_index FROM r WHERE row_index = 14""")
def value_at_position(t):
    seen = first_seen(t.events, "user_id", "event_id")
    return row_at(with_row_index(seen, ["first_row"]), 14)
