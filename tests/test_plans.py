import pytest

from pyspark.sql import functions as F

from assayloom.constants import EXEMPT_NAMES, PROPERTY_TABLE
from assayloom.plans import (
    build_compound_dimension, build_model_frame, enrich_prediction, enrich_training, profile,
)
from assayloom.plans.enrich import Assay

LONG = "obs_id string, count double, normalized_count double"


def _inputs(spark):
    rows = spark.createDataFrame([
        (0, "T cells CD4+", "Drug; x (y)", "L0", "CCO", True, [1.0, 2.0]),
        (1, "B cells", "IN1451 (z)", "L1", "CC", False, [3.0, 4.0]),
        (2, "NK cells", "Unmeasured", "L2", "C", False, [5.0, 6.0]),
    ], "row_id long, cell_type string, sm_name string, sm_lincs_id string, SMILES string, control boolean, targets array<double>")
    first = Assay(
        spark.createDataFrame([("o1", 1.0, 1.0), ("o1", 3.0, 1.0), ("o2", 8.0, 1.0)], LONG),
        spark.createDataFrame([("o1", "T cells CD4+", "Drug"), ("o2", "T cells CD4+", "Drug")],
                              "obs_id string, cell_type string, sm_name string"),
        ["cell_type", "sm_name"])
    second = Assay(
        spark.createDataFrame([("p1", 2.0, 1.0), ("p2", 4.0, 1.0), ("p3", 6.0, 1.0)], LONG),
        spark.createDataFrame([("p1", "T cells CD4+", "d2"), ("p2", "T cells CD4+", "d1"), ("p3", "B cells", "d3")],
                              "obs_id string, cell_type string, donor_id string"),
        ["cell_type", "donor_id"])
    filler = [None] * 12
    properties = spark.createDataFrame([("Drug", 10.0, *filler), (EXEMPT_NAMES[1], 20.0, *filler)], PROPERTY_TABLE)
    return rows, first, second, properties


def test_enrich_training(spark):
    out = enrich_training(*_inputs(spark))
    assert out.columns[:7] == ["row_id", "cell_type", "sm_name", "sm_lincs_id", "SMILES", "control", "count_mean_x"]
    assert len(out.columns) == 1 + 27 + 1
    got = {(r.row_id, r.donor_id): r for r in out.collect()}
    assert set(got) == {(0, "d1"), (0, "d2"), (1, "d3"), (2, None)}
    drug = got[0, "d1"]
    assert (drug.sm_name, drug.count_mean_x, drug.count_sum_x, drug.count_sum_y) == ("Drug", 5.0, 12.0, 4.0)
    assert (drug.MolecularWeight, drug.targets) == (10.0, [1.0, 2.0])
    assert got[1, "d3"].sm_name == EXEMPT_NAMES[1] and got[1, "d3"].MolecularWeight == 20.0
    assert got[1, "d3"].count_mean_x is None and got[2, None].count_mean_y is None


def test_enrich_training_by_position(spark):
    out = enrich_training(*_inputs(spark), align="position").orderBy("_position").collect()
    assert [(r.row_id, r.donor_id, r.targets) for r in out] == [
        (0, "d1", [1.0, 2.0]), (0, "d2", [3.0, 4.0]), (1, "d3", [5.0, 6.0]), (2, None, None)]


def test_large_dimensions_give_the_same_rows(spark, no_broadcast):
    out = enrich_training(*_inputs(spark))
    assert {(r.row_id, r.donor_id) for r in out.collect()} == {(0, "d1"), (0, "d2"), (1, "d3"), (2, None)}


def test_metadata_names_are_cleaned_on_request(spark):
    rows, first, second, properties = _inputs(spark)
    raw = Assay(first.measurements, first.metadata.withColumn("sm_name", F.lit("Drug (raw)")), first.group_keys)
    miss = enrich_training(rows, raw, second, properties).where("row_id = 0").first()
    hit = enrich_training(rows, raw, second, properties, clean_metadata=True).where("row_id = 0").first()
    assert miss.count_mean_x is None and hit.count_mean_x == 5.0


def test_guards(spark):
    rows, first, second, properties = _inputs(spark)
    with pytest.raises(ValueError):
        enrich_training(rows, first, second, properties.unionByName(properties), check_properties=True)
    once = enrich_prediction(rows, properties)
    with pytest.raises(ValueError):
        enrich_prediction(once, properties)


def test_enrichment_stays_out_of_python_and_broadcasts_no_features(spark):
    plan = enrich_training(*_inputs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "ArrowEval" not in plan
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan and "Cartesian" not in plan


def test_enrich_prediction_orders(spark):
    rows, _, _, properties = _inputs(spark)
    default = {r.row_id: r.sm_name for r in enrich_prediction(rows, properties, row_id="row_id").collect()}
    other = {r.row_id: r.sm_name for r in enrich_prediction(rows, properties, alias_first=False, row_id="row_id").collect()}
    assert default[1] == "IN1451" and other[1] == EXEMPT_NAMES[1]


def test_compound_dimension(spark):
    rows, _, _, properties = _inputs(spark)
    snapshot = properties.withColumn("rank", F.lit(1))
    out = build_compound_dimension(rows.unionByName(rows), snapshot)
    assert out.columns == PROPERTY_TABLE.fieldNames() and [r.sm_name for r in out.collect()] == ["Drug"]
    asked = build_compound_dimension(rows, lambda name: {"MolecularWeight": 1.0} if name != "Drug" else None)
    assert sorted(r.sm_name for r in asked.collect()) == ["IN1451", "Unmeasured"]


def test_model_frame(spark):
    enriched = enrich_training(*_inputs(spark))
    frame = build_model_frame(enriched, ["row_id", "donor_id"])
    assert "SMILES" not in frame.columns and frame.columns[-1] == "split"
    got = {r.row_id: r for r in frame.collect()}
    assert got[0].cell_type == 3 and got[1].cell_type == 0 and got[2].cell_type == 2
    assert got[1].split == "test" and got[0].split == "train" and got[2].donor_id == 3
    assert (got[1].sm_name, got[0].sm_name, got[2].sm_name) == (0, 1, 2)


def test_profile(spark):
    rows, *_ = _inputs(spark)
    parts = profile(rows, ["cell_type"])
    assert parts["head"].count() == 3 and parts["columns"].count() == 7
    assert {r.label for r in parts["shares_cell_type"].collect()} == {"33.3%"}
    assert [r.cell_type for r in parts["values_cell_type"].collect()] == ["T cells CD4+", "B cells", "NK cells"]
    assert {r["column"]: r.n_missing for r in parts["completeness"].collect()}["SMILES"] == 0


def test_position_alignment_numbers_rows_where_they_are_fanned_out(spark, monkeypatch):
    """The fanned-out rows are neither sorted as a whole nor joined beyond the targets' number; a repeated id takes the general way."""
    from assayloom.operators import rows as row_operators

    asked = []
    number = row_operators.with_row_index
    monkeypatch.setattr(row_operators, "with_row_index", lambda *a: asked.append(a[3:]) or number(*a))
    _, first, second, properties = _inputs(spark)
    many = spark.range(300).select(
        F.col("id").alias("row_id"), F.lit("T").alias("cell_type"), F.lit("Drug").alias("sm_name"), F.lit("l").alias("sm_lincs_id"),
        F.lit("C").alias("SMILES"), F.lit(False).alias("control"), F.array(F.col("id").cast("float")).alias("targets"))
    for rows, ranged in ((many, True), (many.unionByName(many.where("row_id = 7").withColumn("sm_name", F.lit("x"))), False)):
        asked.clear()
        out = enrich_training(rows, first, second, properties, align="position")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert (True,) in asked if ranged else (True,) not in asked
        assert "FullOuter" not in plan
        got = sorted((r._position, r.row_id, r.donor_id, r.targets[0] if r.targets else None) for r in out.collect())
        fanned = sorted(((r.row_id, r.donor_id) for r in enrich_training(rows, first, second, properties).collect()),
                        key=lambda r: (r[0], r[1] or ""))
        ids = sorted(r.row_id for r in rows.collect())
        assert got == [(i, *f, float(ids[i]) if i < len(ids) else None) for i, f in enumerate(fanned)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_a_stored_enrichment_is_stored_before_its_broadcast_donors(spark, rows, monkeypatch, broadcast):
    from assayloom.plans import enrich

    stored = []

    def store(df, label="table"):
        stored.append((label, df.count()))
        return keep(df, label)

    keep = enrich.materialise
    plain = rows(enrich_training(*_inputs(spark)))
    monkeypatch.setattr(enrich, "materialise", store)
    if not broadcast:
        monkeypatch.setattr(enrich, "fits_broadcast", lambda df: False)
    assert rows(enrich_training(*_inputs(spark), stored=True)) == plain
    assert [n for label, n in stored if label == "enriched"] == [_inputs(spark)[0].count() if broadcast else len(plain)]


def test_the_model_frame_stores_no_fanned_out_rows(spark, tmp_path, monkeypatch):
    """Orders of one segment meet five donors each; what is stored has a row per order at most."""
    from assayloom import session
    from assayloom.plans import enrich
    from suite import QUERIES, flows

    sf, n = str(tmp_path), F.col("id")
    tables = {
        "customer": spark.range(10).select(
            n.alias("c_custkey"), (n % 5).cast("int").alias("c_nationkey"), F.element_at(
                F.array(F.lit("BUILDING"), F.lit("FURNITURE")), (n / 5).cast("int") + 1).alias("c_mktsegment")),
        "orders": spark.range(60).select(
            n.alias("o_orderkey"), (n % 10).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
            F.lit("1-URGENT").alias("o_orderpriority"), n.cast("double").alias("o_totalprice")),
        "lineitem": spark.range(60).select(
            n.alias("l_orderkey"), n.cast("double").alias("l_quantity"), n.cast("double").alias("l_extendedprice")),
        "events": spark.range(10).select(n.alias("user_id"), n.cast("double").alias("value")),
    }
    for name, table in tables.items():
        table.write.parquet(f"{sf}/{name}.parquet")
    stored = []

    def store(df, label="table"):
        out = session.materialise(df, label)
        stored.append(out.count())
        return out

    monkeypatch.setattr(enrich, "materialise", store)
    monkeypatch.setattr(flows, "materialise", store)
    frame = QUERIES["model_frame"](spark, sf)
    assert frame.count() == 300 and max(stored) == 60
    assert {(r["cell_type"], r["split"]): r["count"] for r in frame.groupBy("cell_type", "split").count().collect()} == {
        (1, "test"): 30, (1, "val"): 12, (1, "train"): 108, (2, "train"): 15, (2, "test"): 135}
