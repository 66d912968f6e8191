"""The driver's tables, and the roles they play in the enrichment flows.

Each role is one definition in DataFrame form and one in SQL. All of them read
whole tables; the property snapshot leaves out one priority, so that lookups
have names to miss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.operators.joins import dimension_join
from assayloom.plans.enrich import Assay, NameRules
from assayloom.session import materialise, spread_scan

RULES = NameRules(aliases={"4-NOT SPECIFIED": "4-NONE"})
EXACT = (18, 4)
MAJORITY = ("BUILDING", "HOUSEHOLD", "MACHINERY")
MINORITY = ("AUTOMOBILE", "FURNITURE")
SEGMENT_CODES = {"AUTOMOBILE": 0, "BUILDING": 1, "FURNITURE": 2, "HOUSEHOLD": 3, "MACHINERY": 4}


class Tables:
    """``t.orders`` reads orders.parquet; the other properties are roles."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    @property
    def customer_orders(self) -> DataFrame:
        return self._with_segment(self.orders)

    def _with_segment(self, orders: DataFrame) -> DataFrame:
        """Orders with their customer's segment; customers are broadcast only if measured small."""
        segment = self.customer.select("c_custkey", "c_mktsegment")
        return dimension_join(orders.withColumnRenamed("o_custkey", "c_custkey"), segment, ["c_custkey"], "inner", spread=["o_orderkey"])

    @property
    def measurements(self) -> DataFrame:
        return self.lineitem.select(
            F.col("l_orderkey").alias("obs_id"), F.col("l_quantity").alias("count"),
            F.col("l_extendedprice").alias("normalized_count"),
        )

    @property
    def metadata(self) -> DataFrame:
        return self.customer_orders.select(
            F.col("o_orderkey").alias("obs_id"), F.col("c_mktsegment").alias("cell_type"),
            F.col("o_orderpriority").alias("sm_name"),
        )

    @property
    def second_measurements(self) -> DataFrame:
        return self.events.select(
            F.col("user_id").alias("obs_id"), F.col("value").alias("count"),
            (F.col("value") * 0.1).alias("normalized_count"),
        )

    @property
    def second_metadata(self) -> DataFrame:
        return self.customer.select(
            F.col("c_custkey").alias("obs_id"), F.col("c_mktsegment").alias("cell_type"),
            F.col("c_nationkey").alias("donor_id"),
        )

    @property
    def first_assay(self) -> Assay:
        return Assay(self.measurements, self.metadata, ["cell_type", "sm_name"], exact=EXACT, decimals=4)

    @property
    def second_assay(self) -> Assay:
        return Assay(self.second_measurements, self.second_metadata, ["cell_type", "donor_id"], exact=EXACT, decimals=4)

    @property
    def rows(self) -> DataFrame:
        """Training rows; a scan of fewer pieces than cores is dealt out here, before any fan-out."""
        known = F.when(F.col("o_orderstatus") == "P", "UNKNOWN").otherwise(F.col("o_orderpriority"))
        orders = spread_scan(
            self.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"), ["o_orderkey"])
        return self._with_segment(orders).select(
            F.col("o_orderkey").alias("row_id"),
            F.col("c_mktsegment").alias("cell_type"),
            F.concat(known, F.lit("; "), "o_orderstatus", F.lit(" (x)")).alias("sm_name"),
            F.concat(F.lit("LSM-"), "o_orderpriority").alias("sm_lincs_id"),
            F.concat(F.lit("C"), "o_orderstatus").alias("SMILES"),
            (F.col("o_orderstatus") == "F").alias("control"),
            F.array(F.col("o_totalprice"), F.col("o_totalprice") * 0.5).alias("targets"),
        )

    @property
    def snapshot(self) -> DataFrame:
        """A property snapshot: every order is a hit of its priority's name, ranked by key."""
        name = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "4-NONE").otherwise(F.col("o_orderpriority"))
        price, key = F.col("o_totalprice"), F.col("o_orderkey")

        def digit(n):
            return (key % n).cast("int")

        return self.orders.where("o_orderpriority <> '5-LOW'").select(
            name.alias("sm_name"), key.alias("rank"),
            price.alias("MolecularWeight"), (price * 0.5).alias("XLogP3-AA"),
            digit(3).alias("HydrogenBondDonorCount"), digit(5).alias("HydrogenBondAcceptorCount"),
            digit(7).alias("RotatableBondCount"), (price + 1.0).alias("ExactMass"),
            (price + 2.0).alias("MonoisotopicMass"), (price * 0.25).alias("TopologicalPolarSurfaceArea"),
            digit(50).alias("HeavyAtomCount"), digit(2).alias("FormalCharge"),
            (price * 2.0).alias("Complexity"), digit(4).alias("IsotopeAtomCount"),
            digit(9).alias("CovalentlyBondedUnitCount"),
        )

    @property
    def properties(self) -> DataFrame:
        """The property table: the first hit of every name in the snapshot."""
        from assayloom.constants import COMPOUND_PROPERTIES
        from assayloom.operators.sets import first_match

        return first_match(self.snapshot, "sm_name", ["rank"], COMPOUND_PROPERTIES.fieldNames())

    @property
    def mols(self) -> DataFrame:
        """Every document as a labelled chain: words are atoms, neighbours are bonded."""
        return self._chains(spread_scan(self._texts, ["doc_id"]))

    @property
    def stored_mols(self) -> DataFrame:
        """``mols`` for more than one reading: texts that had to be dealt out are stored, so that they move once."""
        texts = self._texts
        dealt = spread_scan(texts, ["doc_id"])
        return self._chains(texts if dealt is texts else materialise(dealt, "texts"))

    @property
    def _texts(self) -> DataFrame:
        return self.documents.select("doc_id", "text")

    def _chains(self, texts: DataFrame) -> DataFrame:
        atoms, n = F.split("text", " "), F.size("atoms")
        chain = F.arrays_zip(F.sequence(F.lit(0), n - 2).alias("src"), F.sequence(F.lit(1), n - 1).alias("dst"))
        none = F.array().cast("array<struct<src:int,dst:int>>")
        return texts.select(F.col("doc_id").alias("graph_id"), atoms.alias("atoms")).withColumn(
            "bonds", F.when(F.size("atoms") > 1, chain).otherwise(none)
        )


# ---- the same roles in SQL -------------------------------------------------

STRIP = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def strip_sql(text: str) -> str:
    return f"regexp_replace({text}, '^{STRIP}|{STRIP}$', '', 'g')"


def clean_sql(text: str) -> str:
    first = strip_sql(f"split_part({text}, '(', 1)")
    return strip_sql(f"split_part({first}, ';', 1)")


def stats_sql(table: str, key: str, count: str, normalized: str) -> str:
    def total(x):
        return f"CAST(SUM(CAST({x} AS DECIMAL(18,4))) AS DOUBLE)"

    return f"""SELECT {key} AS obs_id,
    {total(count)} / COUNT({count}) AS count_mean, {total(count)} AS count_sum,
    {total(normalized)} / COUNT({normalized}) AS normalized_count_mean, {total(normalized)} AS normalized_count_sum
  FROM {table} WHERE {key} IS NOT NULL GROUP BY {key}"""


GROUPED = """AVG(count_mean) AS count_mean, SUM(count_sum) AS count_sum,
    AVG(normalized_count_mean) AS normalized_count_mean, SUM(normalized_count_sum) AS normalized_count_sum"""

CTE_FIRST = f"""stats1 AS ({stats_sql('lineitem', 'l_orderkey', 'l_quantity', 'l_extendedprice')}),
meta1 AS (SELECT o_orderkey AS obs_id, c_mktsegment AS cell_type, o_orderpriority AS sm_name
  FROM orders JOIN customer ON o_custkey = c_custkey),
summary1 AS (SELECT cell_type, sm_name, {GROUPED} FROM stats1 LEFT JOIN meta1 USING (obs_id)
  WHERE cell_type IS NOT NULL AND sm_name IS NOT NULL GROUP BY cell_type, sm_name)"""

CTE_SECOND = f"""stats2 AS ({stats_sql('events', 'user_id', 'value', 'value * CAST(0.1 AS DOUBLE)')}),
meta2 AS (SELECT c_custkey AS obs_id, c_mktsegment AS cell_type, c_nationkey AS donor_id FROM customer),
summary2 AS (SELECT cell_type, donor_id, {GROUPED} FROM stats2 LEFT JOIN meta2 USING (obs_id)
  WHERE cell_type IS NOT NULL AND donor_id IS NOT NULL GROUP BY cell_type, donor_id)"""

CTE_ROWS = f"""raw AS (SELECT o_orderkey AS row_id, c_mktsegment AS cell_type,
    CASE WHEN o_orderstatus = 'P' THEN 'UNKNOWN' ELSE o_orderpriority END || '; ' || o_orderstatus || ' (x)' AS sm_raw,
    'LSM-' || o_orderpriority AS sm_lincs_id, 'C' || o_orderstatus AS "SMILES", o_orderstatus = 'F' AS control,
    o_totalprice AS target_0, o_totalprice * CAST(0.5 AS DOUBLE) AS target_1
  FROM orders JOIN customer ON o_custkey = c_custkey),
feats AS (SELECT row_id, cell_type, {clean_sql('sm_raw')} AS sm_name, sm_lincs_id, "SMILES", control,
    target_0, target_1 FROM raw)"""

CTE_PROPERTIES = """hits AS (SELECT *, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '4-NONE' ELSE o_orderpriority END AS hit_name
  FROM orders WHERE o_orderpriority <> '5-LOW'),
firsts AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY hit_name ORDER BY o_orderkey) AS rn FROM hits) WHERE rn = 1),
props AS (SELECT hit_name AS sm_name, o_totalprice AS "MolecularWeight", o_totalprice * CAST(0.5 AS DOUBLE) AS "XLogP3-AA",
    CAST(o_orderkey % 3 AS INTEGER) AS "HydrogenBondDonorCount", CAST(o_orderkey % 5 AS INTEGER) AS "HydrogenBondAcceptorCount",
    CAST(o_orderkey % 7 AS INTEGER) AS "RotatableBondCount", o_totalprice + CAST(1 AS DOUBLE) AS "ExactMass",
    o_totalprice + CAST(2 AS DOUBLE) AS "MonoisotopicMass", o_totalprice * CAST(0.25 AS DOUBLE) AS "TopologicalPolarSurfaceArea",
    CAST(o_orderkey % 50 AS INTEGER) AS "HeavyAtomCount", CAST(o_orderkey % 2 AS INTEGER) AS "FormalCharge",
    o_totalprice * CAST(2 AS DOUBLE) AS "Complexity", CAST(o_orderkey % 4 AS INTEGER) AS "IsotopeAtomCount",
    CAST(o_orderkey % 9 AS INTEGER) AS "CovalentlyBondedUnitCount" FROM firsts)"""

ALIASED = "CASE WHEN f.sm_name = '4-NOT SPECIFIED' THEN '4-NONE' ELSE f.sm_name END"
PROPERTY_NAMES = (
    "MolecularWeight", "XLogP3-AA", "HydrogenBondDonorCount", "HydrogenBondAcceptorCount", "RotatableBondCount",
    "ExactMass", "MonoisotopicMass", "TopologicalPolarSurfaceArea", "HeavyAtomCount", "FormalCharge",
    "Complexity", "IsotopeAtomCount", "CovalentlyBondedUnitCount",
)
PROPERTY_LIST = ", ".join(f'p."{n}"' for n in PROPERTY_NAMES)
STATS = ("count_mean", "count_sum", "normalized_count_mean", "normalized_count_sum")


def rounded_stats(prefix: str, suffix: str) -> str:
    return ", ".join(f"ROUND({prefix}.{s}, 4) AS {s}{suffix}" for s in STATS)


CTE_ENRICHED = f"""{CTE_FIRST}, {CTE_SECOND}, {CTE_ROWS}, {CTE_PROPERTIES},
enriched AS (SELECT f.row_id, f.cell_type, {ALIASED} AS sm_name, f.sm_lincs_id, f."SMILES", f.control,
    {rounded_stats('a', '_x')}, m.donor_id, {rounded_stats('m', '_y')}, {PROPERTY_LIST}, f.target_0, f.target_1
  FROM feats f LEFT JOIN summary1 a ON f.cell_type = a.cell_type AND f.sm_name = a.sm_name
  LEFT JOIN summary2 m ON f.cell_type = m.cell_type
  LEFT JOIN props p ON p.sm_name = {ALIASED})"""
