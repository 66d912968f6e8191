"""Graphs."""

from pyspark.sql import functions as F

from assayloom.operators import graph as G
from suite.registry import query

_MOL = "mol AS (SELECT doc_id AS graph_id, string_split(text, ' ') AS atoms FROM documents)"
_NODES = f"""{_MOL}, nodes AS (SELECT graph_id, CAST(unnest(range(len(atoms))) AS INTEGER) AS node_id,
  unnest(atoms) AS symbol FROM mol)"""
_EDGES = f"""{_NODES}, edges AS (SELECT graph_id, CAST(unnest(range(len(atoms) - 1)) AS INTEGER) AS src FROM mol)"""


def _hash(x: str) -> str:
    return f"CAST('0x' || substr(md5({x}), 1, 15) AS BIGINT)"


def _round(r: int) -> str:
    return f"""s{r} AS (SELECT e.graph_id, e.node_id, SUM(l.label >> 30) AS high, SUM(l.label & 1073741823) AS low
  FROM ends e JOIN l{r - 1} l ON e.graph_id = l.graph_id AND e.near = l.node_id GROUP BY e.graph_id, e.node_id),
l{r} AS (SELECT l.graph_id, l.node_id,
  {_hash(f"'{r}:' || l.label || ':' || COALESCE(high, 0) || ':' || COALESCE(low, 0)")} AS label
  FROM l{r - 1} l LEFT JOIN s{r} s ON l.graph_id = s.graph_id AND l.node_id = s.node_id)"""


_LABELS = f"""{_EDGES},
ends AS (SELECT graph_id, src AS node_id, src + 1 AS near FROM edges UNION ALL SELECT graph_id, src + 1, src FROM edges),
l0 AS (SELECT graph_id, node_id, {_hash('symbol')} AS label FROM nodes), {_round(1)}, {_round(2)},
labels3 AS (SELECT * FROM l0 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l2)"""

_PARTS = """e AS (SELECT DISTINCT l_orderkey AS graph_id, LEAST(l_partkey, l_suppkey) AS src,
  GREATEST(l_partkey, l_suppkey) AS dst FROM lineitem)"""


def _order_edges(t):
    return t.lineitem.select(
        F.col("l_orderkey").alias("graph_id"), F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst")
    )


@query(f"WITH {_NODES} SELECT graph_id, node_id, symbol FROM nodes")
def graph_node_table(t):
    return G.nodes_of(t.mols)


@query(f"WITH {_EDGES} SELECT graph_id, src, CAST(src + 1 AS INTEGER) AS dst FROM edges")
def graph_edge_table(t):
    return G.edges_of(t.mols)


@query(f"WITH {_PARTS} SELECT graph_id, src, dst FROM e")
def undirected_edges(t):
    return G.simple_edges(_order_edges(t))


@query(f"WITH {_PARTS} SELECT graph_id, src AS node_id FROM e UNION SELECT graph_id, dst FROM e")
def undirected_nodes(t):
    return G.graph_nodes(_order_edges(t))


@query(f"""WITH {_PARTS}, n AS (SELECT graph_id, src AS node_id FROM e UNION SELECT graph_id, dst FROM e),
a AS (SELECT graph_id, COUNT(*) AS n_nodes FROM n GROUP BY graph_id),
b AS (SELECT graph_id, COUNT(*) AS n_edges FROM e GROUP BY graph_id)
SELECT a.graph_id, n_nodes, n_edges FROM a JOIN b ON a.graph_id = b.graph_id""")
def graph_sizes(t):
    edges = G.simple_edges(_order_edges(t))
    return G.graph_size(G.graph_nodes(edges), edges)


@query(f"WITH {_MOL} SELECT graph_id, len(atoms) AS n_nodes, len(atoms) - 1 AS n_edges FROM mol")
def array_graph_sizes(t):
    return G.array_sizes(t.mols)


@query(f"WITH {_LABELS} SELECT DISTINCT graph_id, CAST(label % 2048 AS INTEGER) AS bit FROM labels3")
def fingerprint_positions(t):
    mols = t.stored_mols
    return G.fingerprint_bits(G.neighbourhood_labels(G.nodes_of(mols), G.edges_of(mols), 2))


@query(f"""WITH {_LABELS}, b AS (SELECT DISTINCT graph_id, label % 256 AS bit FROM labels3),
s AS (SELECT graph_id, list(bit) AS bits FROM b GROUP BY graph_id)
SELECT graph_id, list_aggregate(list_transform(range(256), lambda i: CASE WHEN list_contains(bits, i) THEN '1' ELSE '0' END),
  'string_agg', '') AS bits FROM s""")
def fingerprint_bit_strings(t):
    mols = t.stored_mols
    labels = G.neighbourhood_labels(G.nodes_of(mols), G.edges_of(mols), 2)
    return G.fingerprints(labels, 256).select(
        "graph_id", F.array_join(F.col("bits").cast("array<string>"), "").alias("bits")
    )
