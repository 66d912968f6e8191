from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from assayloom.constants import CELL_TYPE_CODES, EXEMPT_NAMES, NAME_ALIASES
from assayloom.functions.names import (
    alias_from_table, alias_name, clean_name, map_label, member_flag, strip_ws,
)

CLEANED = [
    ("Foo (bar)", "Foo"),
    ("Foo; bar", "Foo"),
    ("Foo; x (y)", "Foo"),
    ("(R) Foo", ""),
    ("\tFoo (x)", "Foo"),
    (" Foo　; z", "Foo"),
    ("Foo", "Foo"),
    ("", ""),
    (None, None),
    *[(name, name) for name in EXEMPT_NAMES],
]


def test_clean_name(spark):
    df = spark.createDataFrame(list(enumerate(a for a, _ in CLEANED)), "i int, s string")
    got = {r.i: r.c for r in df.select("i", clean_name("s").alias("c")).collect()}
    assert [got[i] for i in range(len(CLEANED))] == [b for _, b in CLEANED]


def test_cleaning_twice_changes_nothing(spark):
    df = spark.createDataFrame([(a,) for a, _ in CLEANED], "s string").withColumn("once", clean_name("s"))
    assert df.where(~clean_name("once").eqNullSafe(F.col("once"))).count() == 0


def test_strip_equals_python_strip(spark):
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    assert len(spaces) == 29
    texts = [s + "a" + s + "b" + s for s in spaces] + ["".join(spaces), "​a​", "a"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    got = {r.i: r.c for r in df.select("i", strip_ws("s").alias("c")).collect()}
    assert [got[i] for i in range(len(texts))] == [s.strip() for s in texts]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab(;) \t\n  ", max_size=12), min_size=1, max_size=40))
def test_clean_name_equals_python(texts):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    got = {r.i: r.c for r in df.select("i", clean_name("s").alias("c")).collect()}
    for i, s in enumerate(texts):
        assert got[i] == s.partition("(")[0].strip().partition(";")[0].strip()


def test_alias_order_matters_for_a_decorated_name(spark):
    df = spark.createDataFrame([("IN1451 (x)",), ("O-Demethylated Adapalene",), ("Other",), (None,)], "s string")
    training = [r[0] for r in df.select(alias_name(clean_name("s"))).collect()]
    prediction = [r[0] for r in df.select(clean_name(alias_name("s"))).collect()]
    assert training == [NAME_ALIASES["IN1451"], "O-Desmethyl Adapalene", "Other", None]
    assert prediction == ["IN1451", "O-Desmethyl Adapalene", "Other", None]


def test_alias_from_table(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, s string")
    pairs = spark.createDataFrame([("a", "z")], "old string, new string")
    out = alias_from_table(df, "s", pairs, "old", "new")
    assert out.columns == ["s", "i"] or out.columns == ["i", "s"]
    assert rows(out, "i", "s") == [(1, "z"), (2, "b"), (3, None)]


def test_map_label_and_flag(spark):
    df = spark.createDataFrame([("NK cells",), ("unseen",), (None,)], "s string")
    assert [r[0] for r in df.select(map_label("s", CELL_TYPE_CODES)).collect()] == [2, None, None]
    assert [r[0] for r in df.select(member_flag("s", ["NK cells"])).collect()] == [1, 0, 0]


def test_exempt_after_the_first_cut(spark):
    df = spark.createDataFrame([("Foo; bar (x)",), ("Foo; baz (x)",), ("Foo; bar",)], "n string")
    got = [r.c for r in df.select(clean_name("n", exempt=["Foo; bar"]).alias("c")).collect()]
    assert got == ["Foo; bar", "Foo", "Foo; bar"]
