"""Wide CSV files: byte ranges, quotes across their borders, named columns written and read back."""

import csv
import io
import math
import random

import pytest
from pyspark.sql import types as T

from assayloom.constants import NULL_TOKENS
from assayloom.sources import read_wide_csv, write_wide_csv

KEEP = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.LongType())])


@pytest.fixture
def small_ranges(spark):
    """Splits of a few dozen bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    for k, v in zip(keys, ("37", "1")):
        spark.conf.set(k, v)
    yield
    for k, v in zip(keys, before):
        spark.conf.set(k, v)


def _number(text):
    try:
        return float("nan") if text in NULL_TOKENS else float(text.strip())
    except ValueError:
        return float("nan")


def _brute(texts):
    """Rows of all files in order, by Python's own reader."""
    out = []
    for text in texts:
        lines = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
        names = lines[0]
        for r in lines[1:]:
            row = dict(zip(names, r))
            name = None if row["name"] in NULL_TOKENS else row["name"]
            n = int(row["n"]) if row["n"].strip().lstrip("+-").isdigit() else None
            out.append((len(out), name, n, [_number(v) for k, v in row.items() if k not in ("name", "n")]))
    return out


def _same(got, want):
    assert len(got) == len(want)
    for g, w in zip(sorted(got), want):
        assert tuple(g[:3]) == w[:3]
        assert all((math.isnan(a) and math.isnan(b)) or a == pytest.approx(b, rel=1e-6) for a, b in zip(g[3], w[3])) and len(g[3]) == len(w[3])


def _file(seed, rows):
    rng = random.Random(seed)
    hard = ["plain", "a,b", 'say "hi"', "two\nlines", "\r\n", "\n\n\n", '"', "", "NA", " lead", "é漢字", "x" * 120, "q\n" * 40 + '"' * 7]
    out = io.StringIO(newline="")
    w = csv.writer(out, lineterminator="\n" if seed % 2 else "\r\n")
    w.writerow(["t0", "name", "t,1", "n", "t2"])
    for _ in range(rows):
        w.writerow([rng.choice(["1.5", "-2e3", "", "NaN", "0", "inf"]), rng.choice(hard), rng.choice(["7", "+1.25", "bad", " 3 ", '4"4']),
                    rng.choice(["1", "12", "", "x"]), rng.choice(["0.1", "1e-7"])])
        if rng.random() < 0.1:
            out.write("\n")
    return out.getvalue()


@pytest.mark.parametrize("seed", range(4))
def test_any_byte_range(spark, tmp_path, small_ranges, seed):
    texts = [_file(seed, 30), _file(seed + 10, 0), _file(seed + 20, 12)]
    for k, text in enumerate(texts):
        (tmp_path / f"part-{k}.csv").write_bytes(text.encode())
    df = read_wide_csv(spark, str(tmp_path), KEEP)
    assert df.columns == ["row_id", "name", "n", "targets"] and df.rdd.getNumPartitions() > 20
    _same([tuple(r) for r in df.collect()], _brute(texts))


def test_whole_ranges_and_no_row_ids(spark, tmp_path):
    text = _file(1, 50)
    (tmp_path / "t.csv").write_bytes(b"\xef\xbb\xbf" + text.encode())
    got = read_wide_csv(spark, str(tmp_path / "t.csv"), KEEP, out="v", row_id=None)
    assert got.columns == ["name", "n", "v"]
    assert sorted(map(str, (tuple(r)[:2] for r in got.collect()))) == sorted(str(r[1:3]) for r in _brute([text]))


def test_refusals(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.csv").write_text("name,n,x\na,1,2\n")
    with pytest.raises(ValueError, match="no column"):
        read_wide_csv(spark, str(tmp_path / "a"), T.StructType([T.StructField("other", T.StringType())]))
    (tmp_path / "a" / "2.csv").write_text("name,n,y\na,1,2\n")
    with pytest.raises(ValueError, match="different headers"):
        read_wide_csv(spark, str(tmp_path / "a"), KEEP)
    (tmp_path / "b.csv").write_text("name,n,x\na,1,2,3\n")
    with pytest.raises(Exception, match="columns"):
        read_wide_csv(spark, str(tmp_path / "b.csv"), KEEP).collect()
    (tmp_path / "c.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        read_wide_csv(spark, str(tmp_path / "c.csv"), KEEP)


def test_round_trip_of_names_and_values(spark, tmp_path, small_ranges):
    names = ["t,0", 't"1', "t 2", "t\n3"]
    rows = [(f'r "{i}"\n, {i}', i, [i / 3, None if i % 5 == 0 else -1e30 * i, float("nan"), 1e-40]) for i in range(25)] + [(None, None, None)]
    df = spark.createDataFrame(rows, "name string, n long, targets array<float>").repartition(4)
    path = str(tmp_path / "w")
    write_wide_csv(df, path, spark.createDataFrame(list(enumerate(names))[::-1], "pos int, name string"))
    back = read_wide_csv(spark, path, KEEP, row_id=None)
    want = {r.n: r for r in df.collect()}
    for r in back.collect():
        w = want.pop(r.n)
        assert r.name == w.name
        filled = [float("nan")] * 4 if w.targets is None else [float("nan") if v is None else v for v in w.targets]
        assert all((math.isnan(a) and math.isnan(b)) or a == b for a, b in zip(r.targets, filled))
    assert not want
    with pytest.raises(ValueError, match="being read"):
        write_wide_csv(back, path, names)
    with pytest.raises(ValueError, match="one name"):
        write_wide_csv(df, path, ["a", "a", "b", "c"])
    with pytest.raises(Exception, match="length other than 3"):
        write_wide_csv(df, str(tmp_path / "x"), ["a", "b", "c"])


def test_no_rows_keep_their_header(spark, tmp_path):
    df = spark.createDataFrame([], "name string, n long, targets array<double>")
    write_wide_csv(df, str(tmp_path / "none"), ["a", "b"])
    back = read_wide_csv(spark, str(tmp_path / "none"), KEEP)
    assert back.count() == 0 and back.columns == ["row_id", "name", "n", "targets"]


def test_plans_do_not_grow_with_the_width(spark, tmp_path):
    sizes = []
    for width in (3, 3000):
        path = str(tmp_path / f"w{width}")
        df = spark.range(5).selectExpr("string(id) AS name", "id AS n", f"transform(sequence(1, {width}), i -> float(i + id)) AS targets")
        write_wide_csv(df, path, [f"c{i}" for i in range(width)])
        back = read_wide_csv(spark, path, KEEP)
        sizes.append(len(back._jdf.queryExecution().analyzed().toString().replace(f"w{width}", "w")))
        assert sorted(r.targets[-1] - r.n for r in back.collect()) == [width] * 5
    assert abs(sizes[0] - sizes[1]) < 200


def test_wide_round_trip_is_written_by_all_cores(spark, tmp_path, monkeypatch):
    """A supplier table of one piece still becomes wide in many."""
    from suite import sources
    from suite.tables import Tables

    table = spark.range(40).selectExpr("id AS s_suppkey", "concat('s', id) AS s_name").coalesce(1)
    table.write.parquet(f"{tmp_path}/supplier.parquet")
    rows = []

    def write(df, path, names):
        rows.append(df.select("s_suppkey").rdd.glom().map(len).collect())
        write_wide_csv(df, path, names)

    monkeypatch.setattr(sources, "write_wide_csv", write)
    back = sources.wide_csv_round_trip(Tables(spark, str(tmp_path)))
    assert back.select("s_suppkey", "n_targets").distinct().count() == 40
    assert sum(rows[0]) == 40 and max(rows[0]) < 20
