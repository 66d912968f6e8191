"""Joins."""

from dataclasses import replace

from pyspark.sql import functions as F

from assayloom.functions.names import clean_name
from assayloom.operators import joins as J
from assayloom.operators.stats import agg_stats
from assayloom.session import materialise
from suite.registry import query
from suite.tables import (
    CTE_FIRST, CTE_PROPERTIES, CTE_ROWS, CTE_SECOND, EXACT, GROUPED, PROPERTY_LIST, STATS, rounded_stats,
)


@query(f"""WITH {CTE_FIRST} SELECT s.obs_id, {', '.join('s.' + s for s in STATS)}, m.cell_type, m.sm_name
FROM stats1 s LEFT JOIN meta1 m ON s.obs_id = m.obs_id""")
def metadata_join(t):
    stats = agg_stats(t.measurements, ["obs_id"], exact=EXACT)
    return J.left_lookup(stats, t.metadata, ["obs_id"])


def _features(t):
    return t.rows.withColumn("sm_name", clean_name("sm_name")).select("row_id", "cell_type", "sm_name")


@query(f"""WITH {CTE_FIRST}, {CTE_ROWS} SELECT f.row_id, f.cell_type, f.sm_name, {rounded_stats('a', '')}
FROM feats f LEFT JOIN summary1 a ON f.cell_type = a.cell_type AND f.sm_name = a.sm_name""")
def two_key_join(t):
    return J.dimension_join(_features(t), t.first_assay.summary(), ["cell_type", "sm_name"], freeze=True)


@query(f"""WITH {CTE_SECOND}, {CTE_ROWS} SELECT f.row_id, f.cell_type, f.sm_name, m.donor_id, {rounded_stats('m', '')}
FROM feats f LEFT JOIN summary2 m ON f.cell_type = m.cell_type""")
def donor_fan_out(t):
    return J.dimension_join(_features(t), t.second_assay.summary(), ["cell_type"], freeze=True)


@query(f"""WITH {CTE_FIRST}, {CTE_SECOND}, types AS (SELECT cell_type, {GROUPED} FROM stats1 LEFT JOIN meta1 USING (obs_id)
  WHERE cell_type IS NOT NULL GROUP BY cell_type)
SELECT a.cell_type, {rounded_stats('a', '_x')}, m.donor_id, {rounded_stats('m', '_y')}
FROM types a LEFT JOIN summary2 m ON a.cell_type = m.cell_type""")
def collision_suffixes(t):
    types = replace(t.first_assay, group_keys=["cell_type"]).summary()
    return J.suffix_join(types, t.second_assay.summary(), ["cell_type"], freeze=True)


@query(f"""WITH {CTE_ROWS}, {CTE_PROPERTIES} SELECT f.row_id, f.cell_type, f.sm_name, {PROPERTY_LIST}
FROM feats f LEFT JOIN props p ON f.sm_name = p.sm_name""")
def property_join(t):
    return J.dimension_join(_features(t), t.properties, ["sm_name"], freeze=True)


@query("""SELECT COALESCE(l.l_orderkey, o.o_orderkey) AS row_id, l.l_linenumber, o.o_totalprice FROM lineitem l
FULL JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def concat_by_row_id(t):
    left = t.lineitem.select(F.col("l_orderkey").alias("row_id"), "l_linenumber")
    right = t.orders.select(F.col("o_orderkey").alias("row_id"), "o_totalprice")
    return J.concat_columns(left, right)


@query("""SELECT COALESCE(l.row_id, o.o_orderkey) AS row_id, l.l_linenumber, l.l_quantity, o.o_totalprice
FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_orderkey END AS row_id, l_linenumber, l_quantity FROM lineitem) l
FULL JOIN orders o ON l.row_id = o.o_orderkey""")
def concat_hot_ids(t):
    """A fan-out of which one id has a third of all rows."""
    own = F.when(F.col("l_orderkey") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("l_orderkey"))
    left = t.lineitem.select(own.alias("row_id"), "l_linenumber", "l_quantity")
    return J.concat_columns(left, t.orders.select(F.col("o_orderkey").alias("row_id"), "o_totalprice"))


@query("""WITH a AS (SELECT event_id, user_id, ROW_NUMBER() OVER (ORDER BY event_id) - 1 AS p FROM events),
b AS (SELECT o_orderkey, o_totalprice, ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS p FROM orders)
SELECT COALESCE(a.p, b.p) AS _position, event_id, user_id, o_orderkey, o_totalprice FROM a FULL JOIN b ON a.p = b.p""")
def concat_by_position(t):
    return J.concat_columns(
        t.events.select("event_id", "user_id"), t.orders.select("o_orderkey", "o_totalprice"), "position",
        left_order=["event_id"], right_order=["o_orderkey"],
    )


@query(f"""WITH {CTE_ROWS}, {CTE_PROPERTIES}, h AS (SELECT f.sm_name, COUNT(*) AS n_rows, COUNT(p.sm_name) > 0 AS found
  FROM feats f LEFT JOIN props p ON f.sm_name = p.sm_name GROUP BY f.sm_name)
SELECT sm_name, n_rows, found FROM h""")
def lookup_hits(t):
    return J.key_hits(_features(t), t.properties, "sm_name")


@query(f"""WITH {CTE_ROWS}, {CTE_PROPERTIES}, h AS (SELECT f.sm_name, COUNT(*) AS n, COUNT(p.sm_name) > 0 AS found
  FROM feats f LEFT JOIN props p ON f.sm_name = p.sm_name GROUP BY f.sm_name)
SELECT found, COUNT(*) AS n_keys, CAST(SUM(n) AS BIGINT) AS n_rows FROM h GROUP BY found""")
def lookup_hit_summary(t):
    return J.hit_summary(_features(t), t.properties, "sm_name")


@query(f"""WITH {CTE_ROWS}, {CTE_PROPERTIES}
SELECT DISTINCT sm_name FROM feats WHERE sm_name NOT IN (SELECT sm_name FROM props)""")
def lookup_misses(t):
    return J.missing_keys(_features(t), t.properties, "sm_name")


@query("""SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, s.s_name, s.s_nationkey FROM lineitem l
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey""")
def salted_join(t):
    left = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    right = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    return J.skew_join(left, right, ["l_suppkey"])


@query(f"""WITH {CTE_SECOND}, {CTE_ROWS} SELECT f.row_id, f.cell_type, m.donor_id, {rounded_stats('m', '')}
FROM feats f LEFT JOIN summary2 m ON f.cell_type = m.cell_type""")
def salted_donor_fan_out(t):
    features = t.rows.select("row_id", "cell_type")
    return J.skew_join(features, materialise(t.second_assay.summary()), ["cell_type"], spread=["row_id"])


@query("""WITH a AS (SELECT c_custkey, c_name AS name, ROW_NUMBER() OVER (ORDER BY c_custkey) - 1 AS p FROM customer),
b AS (SELECT s_suppkey, s_name AS name, ROW_NUMBER() OVER (ORDER BY s_suppkey) - 1 AS p FROM supplier)
SELECT COALESCE(a.p, b.p) AS _position, c_custkey, a.name AS name_x, s_suppkey, b.name AS name_y
FROM a FULL JOIN b ON a.p = b.p""")
def concat_shared_names(t):
    return J.concat_columns(
        t.customer.select("c_custkey", F.col("c_name").alias("name")),
        t.supplier.select("s_suppkey", F.col("s_name").alias("name")), "position",
        left_order=["c_custkey"], right_order=["s_suppkey"],
    )
