import pytest

from pyspark.sql import types as T

from assayloom.constants import NULL_TOKENS
from assayloom.session import materialise, shared_dir, spread_scan
from assayloom.sources import read_csv, read_parquet, read_table, rows_to_table, write_csv, write_parquet
from assayloom.sources.wide import pack_columns, read_wide_parquet, wide_column_names

SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("d", T.DoubleType()),
])
HARD = ['a,b', 'say "hi"', ' lead', 'trail ', "it's", 'x;y', '(R) z', 'two\nlines', 'back\\slash', '"', '","', 'tab\t']


def test_csv_round_trip_of_hard_texts(spark, tmp_path):
    df = rows_to_table(spark, [{"name": s, "n": i, "d": i / 7} for i, s in enumerate(HARD)], SCHEMA)
    path = str(tmp_path / "t.csv")
    write_csv(df, path)
    back = read_csv(spark, path, SCHEMA, multiline=True).orderBy("n").collect()
    assert [tuple(r) for r in back] == [(s, i, i / 7) for i, s in enumerate(HARD)]


def test_csv_null_tokens_and_bad_numbers(spark, tmp_path):
    path = tmp_path / "t.csv"
    lines = [f"{t},{t},{t}" for t in NULL_TOKENS] + ["x,1,2.5", "y,two,NaN", "Nan,3,-0.5"]
    path.write_text("name,n,d\n" + "\n".join(lines) + "\n")
    got = [tuple(r) for r in read_csv(spark, str(path), SCHEMA).collect()]
    assert got[:len(NULL_TOKENS)] == [(None, None, None)] * len(NULL_TOKENS)
    assert got[len(NULL_TOKENS):] == [("x", 1, 2.5), ("y", None, None), ("Nan", 3, -0.5)]


def test_csv_with_inferred_types(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        'i,s,d,b,e,m\n1,x,0.5,True,NA,1\n2,"y, z",NA,False,,\nNaN,1,1e-3,,None,x\n12,,-.5,True,null,2.5\n')
    df = read_csv(spark, str(path))
    assert df.dtypes == [("i", "bigint"), ("s", "string"), ("d", "double"), ("b", "boolean"), ("e", "double"), ("m", "string")]
    assert [tuple(r) for r in df.collect()] == [
        (1, "x", 0.5, True, None, "1"), (2, "y, z", None, False, None, None),
        (None, "1", 0.001, None, None, "x"), (12, None, -0.5, True, None, "2.5")]


def test_nested_columns_become_json_in_csv(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    write_csv(spark.createDataFrame([(1, [1.5, 2.0])], "i int, v array<double>"), path)
    text = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", T.StringType())])
    assert read_csv(spark, path, text).first().v == "[1.5,2.0]"


def test_reader_by_suffix(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 0.5)], SCHEMA)
    write_parquet(df, str(tmp_path / "t.parquet"))
    write_csv(df, str(tmp_path / "t.csv"))
    assert read_table(spark, str(tmp_path / "t.parquet")).collect() == df.collect()
    assert read_table(spark, str(tmp_path / "t.csv"), schema=SCHEMA).collect() == df.collect()
    with pytest.raises(ValueError):
        read_table(spark, "t.feather")


def test_a_table_is_not_written_over_itself(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    write_parquet(spark.range(3), path)
    with pytest.raises(ValueError):
        write_parquet(read_parquet(spark, path), path)
    with pytest.raises(ValueError):
        write_csv(read_parquet(spark, path), path)
    assert read_parquet(spark, path).count() == 3
    write_parquet(spark.range(4), path)
    assert read_parquet(spark, path).count() == 4


def test_no_records_give_an_empty_typed_table(spark):
    df = rows_to_table(spark, [], SCHEMA)
    assert df.schema == SCHEMA and df.count() == 0


def test_materialise_uses_the_shared_folder(spark):
    out = materialise(spark.range(5))
    assert all(shared_dir(spark).split(":", 1)[-1].lstrip("/") in f for f in out.inputFiles()) and out.count() == 5


def test_wide_files(spark, tmp_path):
    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "wide"
    folder.mkdir()
    values = np.arange(30 * 1500, dtype="float64").reshape(30, 1500)
    for k in range(3):
        part = values[k * 10:(k + 1) * 10]
        cols = {"sm_name": [f"c{k}-{i}" for i in range(10)], "control": [i % 2 == 0 for i in range(10)]}
        cols.update({f"g{j}": part[:, j] for j in range(1500)})
        pq.write_table(pa.table(cols), folder / f"part-{k}.parquet", row_group_size=4)
    keep = T.StructType([T.StructField("sm_name", T.StringType()), T.StructField("control", T.BooleanType())])
    df = read_wide_parquet(spark, str(folder), keep, batch_rows=3)
    assert df.columns == ["row_id", "sm_name", "control", "targets"]
    got = df.orderBy("row_id").collect()
    assert [r.row_id for r in got] == list(range(30)) and got[13].sm_name == "c1-3" and got[13].control is False
    np.testing.assert_array_equal([r.targets for r in got], values.astype("float32"))
    names = wide_column_names(spark, str(folder), ["sm_name", "control"]).orderBy("pos").collect()
    assert [r.name for r in names] == [f"g{j}" for j in range(1500)]


def test_pack_columns(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "i int, a double, b double")
    out = pack_columns(df, ["i"])
    assert out.dtypes == [("i", "int"), ("targets", "array<float>")] and out.first().targets == [2.0, 3.0]


def test_stored_tables_lie_below_the_shared_or_warehouse_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    assert shared_dir(spark).split(":", 1)[-1].lstrip("/").startswith(root.split(":", 1)[-1].lstrip("/").rstrip("/"))


def test_stored_tables_go_when_the_session_ends(tmp_path):
    import os
    import subprocess
    import sys

    code = (
        "from assayloom import build_session, materialise\n"
        f"s = build_session('gone', 'local[1]', spark__ui__enabled='false', spark__checkpoint__dir='{tmp_path}')\n"
        "print(materialise(s.range(3)).count())\ns.stop()"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("3") and not [f for f in os.listdir(tmp_path) if f.startswith("assayloom")]


def test_csv_is_bound_by_name(spark, tmp_path):
    path = str(tmp_path / "swapped.csv")
    (tmp_path / "swapped.csv").write_text("b,a\n1,x\n2,y\n")
    got = read_csv(spark, path, T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())]))
    assert sorted(map(tuple, got.collect())) == [("x", 1), ("y", 2)]
    with pytest.raises(ValueError, match="no column"):
        read_csv(spark, path, T.StructType([T.StructField("c", T.StringType())]))


def test_csv_nested_and_infinite_values(spark, tmp_path):
    path = str(tmp_path / "nested.csv")
    df = spark.createDataFrame([(1, [1.5, 2.0]), (2, None)], "i int, x array<double>")
    write_csv(df, path)
    assert sorted(map(tuple, read_csv(spark, path, df.schema).collect())) == [(1, [1.5, 2.0]), (2, None)]
    (tmp_path / "inf.csv").write_text("v\n1.5\ninf\n-Infinity\n")
    got = read_csv(spark, str(tmp_path / "inf.csv"))
    assert got.dtypes == [("v", "double")] and sorted(r.v for r in got.collect()) == [float("-inf"), 1.5, float("inf")]


def test_only_a_table_in_few_pieces_is_dealt_out(spark, tmp_path, rows):
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    spark.range(1000).coalesce(1).write.parquet(one)
    spark.range(1000).repartition(40).write.option("maxRecordsPerFile", 10).parquet(many)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        dealt, kept = (spread_scan(spark.read.parquet(p), ["id"]) for p in (one, many))
        assert dealt.rdd.getNumPartitions() == 8
        assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
        assert rows(dealt) == rows(kept) and kept.count() == 1000
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)


def test_wide_files_are_bound_by_name(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "w"
    folder.mkdir()
    pq.write_table(pa.table({"i": ["a"], "g1": [1.0], "g2": [2.0]}), folder / "a.parquet")
    pq.write_table(pa.table({"i": ["b"], "g2": [2.0], "g1": [1.0]}), folder / "b.parquet")
    keep = T.StructType([T.StructField("i", T.StringType())])
    assert [list(r.targets) for r in read_wide_parquet(spark, str(folder), keep).collect()] == [[1.0, 2.0], [1.0, 2.0]]
    pq.write_table(pa.table({"i": ["c"], "g1": [1.0], "g3": [2.0]}), folder / "c.parquet")
    with pytest.raises(ValueError):
        read_wide_parquet(spark, str(folder), keep).collect()
