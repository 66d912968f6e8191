"""Property lookup."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.constants import COMPOUND_PROPERTIES
from assayloom.functions.names import clean_name
from assayloom.operators.lookup import AnswerTable, lookup_provider, lookup_snapshot, property_table
from assayloom.session import materialise
from suite.registry import query
from suite.tables import CTE_PROPERTIES, CTE_ROWS, PROPERTY_LIST


@query(f"""WITH {CTE_ROWS}, {CTE_PROPERTIES} SELECT p.sm_name, {PROPERTY_LIST} FROM props p
WHERE p.sm_name IN (SELECT sm_name FROM feats)""")
def snapshot_lookup(t):
    names = t.rows.select(clean_name("sm_name").alias("sm_name"))
    return lookup_snapshot(names, t.snapshot, "sm_name", ["rank"], COMPOUND_PROPERTIES.fieldNames())


@query("""WITH n AS (SELECT DISTINCT p_name FROM part)
SELECT p_name, CASE WHEN p_name LIKE 'red%' OR p_name LIKE 'blue%' THEN NULL ELSE CAST(LENGTH(p_name) AS INTEGER) END AS n_letters,
  NOT (p_name LIKE 'red%' OR p_name LIKE 'blue%') AS found,
  CASE WHEN p_name LIKE 'red%' THEN 'ValueError: no answer for ' || p_name END AS error FROM n""")
def provider_lookup(t):
    def provider(name):
        if name.startswith("red"):
            raise ValueError(f"no answer for {name}")
        return None if name.startswith("blue") else {"n_letters": len(name)}

    fields = T.StructType([T.StructField("n_letters", T.IntegerType())])
    return lookup_provider(t.part, "p_name", provider, fields)


@query("""WITH n AS (SELECT DISTINCT p_name AS name, 2 AS run FROM part UNION SELECT DISTINCT p_type, 1 FROM part),
f AS (SELECT name, MIN(run) AS run FROM n GROUP BY name)
SELECT name, CASE WHEN name LIKE 'red%' OR name LIKE 'SMALL%' THEN NULL ELSE CAST(LENGTH(name) AS INTEGER) END AS n_letters,
  NOT (name LIKE 'red%' OR name LIKE 'SMALL%') AS found, CASE WHEN name LIKE 'red%' THEN 'ValueError: no answer for ' || name END AS error,
  CAST(run AS INTEGER) AS run FROM f""")
def stored_answers(t):
    """A first run asks the types, a second types and names: what the first knows is not asked again."""
    def provider(name):
        if name.startswith("red"):
            raise ValueError(f"no answer for {name}")
        return None if name.startswith("SMALL") else {"n_letters": len(name)}

    store = AnswerTable(t.spark, f"answers_{uuid.uuid4().hex}", "name", T.StructType([T.StructField("n_letters", T.IntegerType())]), 8)
    types, names = t.part.select(F.col("p_type").alias("name")), t.part.select(F.col("p_name").alias("name"))
    try:
        store.ask(types, provider)
        return materialise(store.ask(types.unionByName(names), provider), "answers")
    finally:
        store.drop()


@query(f"""WITH {CTE_PROPERTIES} SELECT p.sm_name, {PROPERTY_LIST} FROM props p""")
def property_table_order(t):
    names = COMPOUND_PROPERTIES.fieldNames()
    return property_table(t.properties.select(*[F.col(f"`{n}`") for n in names], "sm_name"), "sm_name", names)
