"""Sources, sinks and first looks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.constants import NULL_TOKENS
from assayloom.functions.names import alias_from_table
from assayloom.operators.rows import column_listing, peek, shape
from assayloom.session import new_table_path, spread_scan
from assayloom.sources import (
    read_csv, read_parquet, read_table, read_wide_csv, rows_to_table, write_csv, write_parquet, write_wide_csv,
)
from assayloom.sources.wide import pack_columns, read_wide_parquet
from suite.registry import query

_TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)


@query("SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def parquet_scan(t):
    return read_parquet(t.spark, t.path("lineitem")).select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag"
    )


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def csv_round_trip(t):
    path = new_table_path(t.spark, "orders.csv")
    table = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    write_csv(table, path)
    return read_csv(t.spark, path, table.schema)


@query("""SELECT p_partkey, p_name, p_brand, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part""")
def csv_inferred_types(t):
    path = new_table_path(t.spark, "part.csv")
    write_csv(t.part.select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"), path)
    return read_csv(t.spark, path)


@query(f"""SELECT doc_id, CASE WHEN text IN ({_TOKENS}) THEN NULL ELSE text END AS text, lang, source, n_chars
FROM documents""")
def csv_round_trip_texts(t):
    path = new_table_path(t.spark, "documents.csv")
    table = t.documents.select("doc_id", "text", "lang", "source", "n_chars")
    write_csv(table, path)
    return read_csv(t.spark, path, table.schema, multiline=True)


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def read_by_suffix(t):
    stored = read_table(t.spark, t.path("part"))
    path = new_table_path(t.spark, "part") + ".csv"
    write_csv(stored, path)
    return read_table(t.spark, path, schema=stored.schema)


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def parquet_round_trip(t):
    path = new_table_path(t.spark, "supplier")
    write_parquet(t.supplier, path)
    return read_parquet(t.spark, path, t.supplier.schema)


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN '4-NONE' WHEN '1-URGENT' THEN '1-NOW'
  ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def alias_table_from_rows(t):
    schema = T.StructType([T.StructField("old", T.StringType()), T.StructField("new", T.StringType())])
    pairs = rows_to_table(t.spark, [
        {"old": "4-NOT SPECIFIED", "new": "4-NONE"}, {"old": "1-URGENT", "new": "1-NOW"},
    ], schema)
    return alias_from_table(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", pairs, "old", "new")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def peek_first_rows(t):
    return peek(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"])


@query("SELECT COUNT(*) AS n_rows, CAST(11 AS BIGINT) AS n_cols FROM lineitem")
def table_shape(t):
    return shape(t.lineitem)


@query("""WITH n AS (SELECT COUNT(*) AS n_rows FROM customer)
SELECT 'customer' AS "table", CAST(pos AS INTEGER) AS pos, "column", type, n_rows FROM n,
  (VALUES (0, 'c_custkey', 'bigint'), (1, 'c_name', 'string'), (2, 'c_nationkey', 'int'),
          (3, 'c_acctbal', 'double'), (4, 'c_mktsegment', 'string')) v(pos, "column", type)""")
def table_columns(t):
    return column_listing(t.customer, "customer")


@query("""SELECT l_orderkey, l_linenumber, CAST(0 AS INTEGER) AS pos, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 1, l_extendedprice FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 2, l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 3, l_tax FROM lineitem""")
def packed_columns(t):
    keep = ["l_orderkey", "l_linenumber"]
    wide = t.lineitem.select(*keep, "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return pack_columns(wide, keep, dtype="double").select(*keep, F.posexplode("targets").alias("pos", "value"))


@query("""SELECT c_custkey, c_mktsegment, CAST(0 AS INTEGER) AS pos, CAST(CAST(c_acctbal AS FLOAT) AS DOUBLE) AS value
FROM customer
UNION ALL SELECT c_custkey, c_mktsegment, 1, CAST(CAST(c_nationkey AS FLOAT) AS DOUBLE) FROM customer""")
def wide_parquet_scan(t):
    path = new_table_path(t.spark, "wide")
    write_parquet(t.customer.select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey"), path)
    keep = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_mktsegment", T.StringType())])
    packed = read_wide_parquet(t.spark, path, keep)
    return packed.select(
        "c_custkey", "c_mktsegment", F.posexplode("targets").alias("pos", "value")
    ).withColumn("value", F.col("value").cast("double"))


_WIDTH = 18211


@query(f"""SELECT s_suppkey, s_name || ', "x"' || chr(10) || 'y' AS s_name, CAST(COUNT(*) AS INTEGER) AS n_targets,
  SUM(((s_suppkey * 31 + i * 17) % 1000) / 8.0 - 50) AS total,
  SUM(i * (((s_suppkey * 31 + i * 17) % 1000) / 8.0 - 50)) AS by_place
FROM supplier, range({_WIDTH}) r(i) GROUP BY s_suppkey, s_name""")
def wide_csv_round_trip(t):
    """18,211 named columns written and read back; eighths are exact in text and in sums."""
    # Narrow rows of few pieces are dealt out before they are widened, so that all cores write.
    rows = spread_scan(t.supplier.select("s_suppkey", "s_name"), ["s_suppkey"])
    table = rows.select("s_suppkey", F.concat("s_name", F.lit(', "x"\ny')).alias("s_name"), F.expr(
        f"transform(sequence(0, {_WIDTH - 1}), i -> cast(((s_suppkey * 31 + i * 17) % 1000) / 8 - 50 as float))").alias("targets"))
    path = new_table_path(t.spark, "wide.csv")
    write_wide_csv(table, path, [f"target_{i}" for i in range(_WIDTH)])
    keep = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType())])
    back = read_wide_csv(t.spark, path, keep)
    wide = F.col("targets").cast("array<double>")
    return back.select(
        "s_suppkey", "s_name", F.size("targets").alias("n_targets"),
        F.aggregate(wide, F.lit(0.0), lambda a, x: a + x).alias("total"),
        F.aggregate(F.transform(wide, lambda x, i: x * i), F.lit(0.0), lambda a, x: a + x).alias("by_place"))
