import pytest

#: Names that the operators use inside; documents may have them too.
CLASHES = ["n", "tokens", "sig", "block", "held_out", "score", "text_sha256", "size", "lang_pred", "share", "found", "place", "mark"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


@pytest.fixture(scope="session")
def edge_rows():
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000)) + " mail a@b.org"
    rows = [
        (1, None, "en"), (2, "", "en"), (3, " \t\n ", None), (4, "one", "en"), (5, "one two three", "fr"),
        (6, "One  TWO\nthree", "fr"), (7, long, "en"), (8, long, "en"), (8, long, "en"), (9, long + " more", None),
        (10, "1234 5678 !!!", "de"), (11, "x" * 50_000, "de"), (None, "a text without an id", "en"),
        (12, "é ▁ ▁▁  漢字 \x1c\x85 end\x00", "fr"), (13, "the cat sat on the mat today", "en"),
        (14, "the cat sat on the mat today", "en"), (15, "a@b.com 10.0.0.1, 4111 1111 1111 1111, +1 (212) 555-0100", None),
    ]
    return [(i, t, lang, "s", len(t or ""), *["x"] * len(CLASHES)) for i, t, lang in rows]


@pytest.fixture(scope="session")
def edges(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").cache()
