import hashlib
import os
import uuid

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.operators import graph as G
from assayloom.operators import lookup as L
from assayloom.session import shared_dir


def _mol(spark):
    return spark.createDataFrame(
        [(1, ["C", "C", "O"], [(0, 1), (1, 2), (1, 0)])],
        "graph_id long, atoms array<string>, bonds array<struct<src:int,dst:int>>")


def test_simple_graph(spark, rows):
    mol = _mol(spark)
    assert rows(G.nodes_of(mol)) == [(1, 0, "C"), (1, 1, "C"), (1, 2, "O")]
    edges = G.edges_of(mol)
    assert edges.count() == 3
    simple = G.simple_edges(edges)
    assert rows(simple) == [(1, 0, 1), (1, 1, 2)]
    assert rows(G.graph_size(G.graph_nodes(simple, G.nodes_of(mol)), simple)) == [(1, 3, 2)]
    assert rows(G.array_sizes(mol)) == [(1, 3, 3)]


def _h(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def _labels(symbols, edges, radius):
    near = {n: set() for n in symbols}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    label = {n: _h(s) for n, s in symbols.items()}
    out = {(n, 0): v for n, v in label.items()}
    for r in range(1, radius + 1):
        label = {
            n: _h(f"{r}:{label[n]}:{sum(label[m] >> 30 for m in near[n])}:{sum(label[m] % 2**30 for m in near[n])}")
            for n in label}
        out.update({(n, r): v for n, v in label.items()})
    return out


def test_labels_equal_brute_force_with_a_hub_and_a_loop(spark, no_broadcast, monkeypatch):
    symbols = {n: "CNO"[n % 3] for n in range(60)}
    edges = [(0, n) for n in range(1, 50)] + [(n, n + 1) for n in range(1, 30)] + [(5, 5), (7, 6)]
    nodes = spark.createDataFrame([(9, n, s) for n, s in symbols.items()], "graph_id long, node_id int, symbol string")
    table = spark.createDataFrame([(9, a, b) for a, b in edges], "graph_id long, src int, dst int")
    got = {(r.node_id, r.round): r.label for r in G.neighbourhood_labels(nodes, table, 2).collect()}
    assert got == _labels(symbols, edges, 2)


@pytest.mark.parametrize("bucket", [1, 12, 1 << 19])
def test_labels_in_buckets_and_by_joins_are_the_same(spark, monkeypatch, bucket):
    """Graphs of all sizes, listed twice, without id or symbol, with loops, repeated, loose and half edges."""
    nodes = [(g, n, None if n == 2 else "CNO"[(g + n) % 3]) for g in range(6) for n in range(2 + 3 * g)]
    nodes += [(3, 1, "C"), (3, 1, "N"), (4, 0, "C"), (None, 0, "C"), (None, 0, "N"), (None, 1, "C"), (5, None, "O")]
    edges = [(g, n, n + 1) for g in range(6) for n in range(2 + 3 * g)] + [(3, 2, 1), (3, 1, 2), (4, 3, 3), (None, 0, 1), (5, 4, None), (9, 0, 1), (5, None, None)]
    nodes = spark.createDataFrame(nodes, "graph_id long, node_id int, symbol string")
    edges = spark.createDataFrame(edges, "graph_id long, src int, dst int")
    monkeypatch.setattr(G, "_BUCKET", bucket)
    monkeypatch.setattr(G, "_PACKED", 7)

    def table(df):
        return sorted(map(repr, df.select("graph_id", "node_id", "round", "label").collect()))

    got = G.neighbourhood_labels(nodes, edges, 2)
    assert got.schema.simpleString() == "struct<graph_id:bigint,node_id:int,round:int,label:bigint>"
    assert table(got) == table(G._joined_labels(nodes, edges, 2, "graph_id"))
    bits = {(r.graph_id, r.label % 100) for r in got.collect()}
    assert sorted(map(repr, map(tuple, G.fingerprint_bits(got, 100).collect()))) == sorted(map(repr, bits))
    arrays = {(r.graph_id, i) for r in G.fingerprints(got, 100).collect() for i, b in enumerate(r.bits) if b}
    assert arrays == bits


def test_fingerprints_neither_store_nor_join_a_row_for_every_label(spark):
    nodes = spark.range(100_000).selectExpr("id div 400 AS graph_id", "cast(id % 400 AS int) AS node_id", "cast(id AS string) AS symbol")
    edges = nodes.selectExpr("graph_id", "node_id AS src", "node_id + 1 AS dst")
    folder = shared_dir(spark).removeprefix("file:")

    def stored():
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)

    before = stored()
    bits = G.fingerprint_bits(G.neighbourhood_labels(nodes, edges, 2), 256)
    assert bits.groupBy("graph_id").count().where("count > 200").count() == 250
    assert stored() - before < 100_000
    assert "Join" not in bits._jdf.queryExecution().executedPlan().toString()


def test_arrays_are_made_once_before_they_are_exploded(spark, rows):
    """A plain explode has Catalyst filter by the array's size, for which the array is made again."""
    texts = spark.createDataFrame([(1, "a b c"), (2, "d"), (3, None)], "graph_id long, text string")
    mols = texts.select("graph_id", F.split("text", " ").alias("atoms"), F.expr(
        "transform(filter(sequence(0, size(split(text, ' ')) - 1), i -> i > 0), i -> struct(i - 1 AS src, i AS dst))").alias("bonds"))
    for df in (G.nodes_of(mols), G.edges_of(mols)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.splitlines() if "Filter" in line and ("split" in line or "size" in line)]
    assert rows(G.nodes_of(mols)) == [(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (2, 0, "d")]
    assert rows(G.edges_of(mols)) == [(1, 0, 1), (1, 1, 2)]
    odd = spark.createDataFrame([(1, [None, "x"], [None, (0, None)]), (2, [], []), (3, None, None)],
                                "graph_id long, atoms array<string>, bonds array<struct<src:int,dst:int>>")
    assert rows(G.nodes_of(odd)) == [(1, 0, None), (1, 1, "x")]
    assert rows(G.edges_of(odd)) == [(1, None, None), (1, 0, None)]


def test_many_texts_are_hashed_as_one_by_one(monkeypatch):
    monkeypatch.setattr(G, "_SLICE", 100)
    texts = ["", "C", "\u00e9" * 27, "x" * 55, "x" * 56, "x" * 200] + [f"w{n}" for n in range(500)]
    assert G._text_hashes(pa.array(texts)).tolist() == [_h(t) for t in texts]
    assert G._text_hashes(pa.array(texts).slice(3, 5)).tolist() == [_h(t) for t in texts[3:8]]
    draw = np.random.default_rng(1)
    columns = [(draw.integers(0, 1 << bits, 500) >> draw.integers(0, bits, 500)).astype(np.int64) for bits in (60, 62, 49)]
    columns[0][:3], columns[1][:3], columns[2][:3] = [0, 10**18, 2**60 - 1], [0, 9, 10], [0, 10**14, 99]
    for r in (1, 10, 1000):
        assert G._number_hashes(r, *columns).tolist() == [_h(f"{r}:{a}:{b}:{c}") for a, b, c in zip(*columns)]
        assert G._number_hashes(r, *[c[:0] for c in columns]).tolist() == []


def test_equal_molecules_have_equal_fingerprints(spark):
    mols = spark.createDataFrame([
        (1, ["C", "C", "O"], [(0, 1), (1, 2)]), (2, ["O", "C", "C"], [(1, 0), (2, 1)]),
        (3, ["C", "O", "C"], [(0, 1), (1, 2)]), (4, ["C"], []),
    ], "graph_id long, atoms array<string>, bonds array<struct<src:int,dst:int>>")
    labels = G.neighbourhood_labels(G.nodes_of(mols), G.edges_of(mols), 2)
    bits = {r.graph_id: r.bits for r in G.fingerprints(labels, 512).collect()}
    assert set(bits) == {1, 2, 3, 4} and all(len(b) == 512 for b in bits.values())
    assert bits[1] == bits[2] != bits[3] and sum(bits[4]) <= 3


def test_snapshot_takes_the_first_hit(spark, rows):
    names = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "sm_name string")
    snap = spark.createDataFrame([("a", 2, 20.0), ("a", 1, 10.0), ("c", 1, 5.0)], "sm_name string, rank int, w double")
    assert rows(L.lookup_snapshot(names, snap, "sm_name", ["rank"], ["w"])) == [("a", 10.0)]


def test_provider_failures_stay_with_their_name(spark):
    calls = spark.sparkContext.accumulator(0)

    def provider(name):
        calls.add(1)
        if name == "bad":
            raise RuntimeError("no route")
        return {"w": 1.5, "n": len(name)} if name != "unknown" else None

    names = spark.createDataFrame([("ok",), ("ok",), ("bad",), ("unknown",), (None,)], "sm_name string")
    fields = T.StructType([T.StructField("w", T.DoubleType()), T.StructField("n", T.IntegerType())])
    got = {r.sm_name: r for r in L.lookup_provider(names, "sm_name", provider, fields, 2).collect()}
    assert set(got) == {"ok", "bad", "unknown"} and calls.value == 3
    assert (got["ok"].w, got["ok"].n, got["ok"].found, got["ok"].error) == (1.5, 2, True, None)
    assert (got["bad"].found, got["bad"].error) == (False, "RuntimeError: no route")
    assert (got["unknown"].found, got["unknown"].error, got["unknown"].w) == (False, None, None)
    table = L.property_table(L.lookup_provider(names, "sm_name", provider, fields), "sm_name", ["w", "n"])
    assert table.columns == ["sm_name", "w", "n"]


def test_provider_takes_and_gives_all_types(spark):
    import datetime as dt
    from decimal import Decimal

    day, at = dt.date(2020, 2, 29), dt.datetime(2021, 3, 4, 5, 6, 7)
    fields = T._parse_datatype_string("at timestamp, price decimal(12,3), tags array<string>, part struct<a:int,b:date>, raw binary, ok boolean")

    def ask(key):
        if key != day:
            return None
        return {"at": at, "price": Decimal("1.500"), "tags": ["a", None], "part": {"a": 1, "b": key}, "raw": b"x", "ok": True}

    names = spark.createDataFrame([(day,), (day,), (dt.date(1999, 1, 1),), (None,)], "day date")
    got = {r.day: r for r in L.lookup_provider(names, "day", ask, fields).collect()}
    r = got[day]
    assert (r.at, r.price, r.tags, tuple(r.part), bytes(r.raw), r.ok, r.found, r.error) == (
        at, Decimal("1.500"), ["a", None], (1, day), b"x", True, True, None)
    assert len(got) == 2 and not got[dt.date(1999, 1, 1)].found
    keys = spark.createDataFrame([(Decimal("2.50"),)], "k decimal(10,2)")
    assert L.lookup_provider(keys, "k", lambda k: {"v": str(k)}, T._parse_datatype_string("v string")).first().v == "2.50"


@pytest.mark.parametrize("pieces", [1, 3])
def test_stored_answers_are_not_asked_again(spark, pieces):
    calls = spark.sparkContext.accumulator(0)
    table = f"answers_{uuid.uuid4().hex}"
    store = L.AnswerTable(spark, table, "name", T._parse_datatype_string("w int"), 4)
    with pytest.raises(ValueError, match="nothing was asked"):
        store.answers()

    def ask(names, down, again=True):
        def provider(name):
            calls.add(1)
            if down and name == "c":
                raise RuntimeError("down")
            return {"w": len(name)} if name != "b" else None

        df = spark.createDataFrame([(n,) for n in names], "name string")
        before = calls.value
        got = {r.name: (r.w, r.found, r.error, r.run) for r in store.ask(df, provider, again, pieces).collect()}
        return got, calls.value - before

    try:
        got, asked = ask(["a", "a", "b", "c", None], down=True)
        assert (got, asked) == ({"a": (1, True, None, 1), "b": (None, False, None, 1), "c": (None, False, "RuntimeError: down", 1)}, 3)
        assert ask(["a", "c"], down=True, again=False) == ({"a": got["a"], "c": got["c"]}, 0)
        assert ask(["c", "dd", "b"], down=False) == ({"b": got["b"], "c": (1, True, None, 2), "dd": (2, True, None, 2)}, 2)
        assert ask([], down=False) == ({}, 0)
        assert {r.name for r in store.answers().collect()} == {"a", "b", "c", "dd"}
        plan = store.answers()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        with pytest.raises(ValueError, match="may not be called"):
            L.AnswerTable(spark, table, "name", T._parse_datatype_string("run int")).ask(spark.createDataFrame([("a",)], "name string"), len)
    finally:
        store.drop()


def test_a_failing_name_is_tried_again(spark):
    calls = spark.sparkContext.accumulator(0)
    seen = {}

    def provider(name):
        calls.add(1)
        seen[name] = seen.get(name, 0) + 1
        if seen[name] < 3:
            raise RuntimeError("busy")
        return {"n": seen[name]}

    names = spark.createDataFrame([("a",), ("b",)], "name string")
    fields = T._parse_datatype_string("n int")
    got = L.lookup_provider(names, "name", provider, fields, 1, tries=3, wait=0.01).collect()
    assert [(r.n, r.error) for r in got] == [(3, None)] * 2 and calls.value == 6
    assert L.lookup_provider(names, "name", provider, fields, 1, tries=2, wait=0.01).first().error == "RuntimeError: busy"
