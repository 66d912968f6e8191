import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from assayloom import build_session

    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Dimensions count as too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def rows():
    """Sorted tuples of a DataFrame."""
    def take(df, *cols):
        got = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
        return sorted(got, key=lambda r: tuple((v is not None, str(v)) for v in r))
    return take
