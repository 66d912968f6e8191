"""Compare queries with their SQL: ``python -m tests.check SF_DIR [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def _key(row):
    return tuple((v is not None, str(type(v)), v) for v in row)


def _rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_plain(r[i]) for i in order) for r in records], key=_key)


def compare(df, con, sql: str) -> str | None:
    """None when names, row count and values agree, else what differs."""
    got_names = df.columns
    rel = con.execute(sql)
    want_names = [d[0] for d in rel.description]
    want = _rows(want_names, rel.fetchall())
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    table = df.toArrow()
    got = _rows(got_names, list(zip(*[c.to_pylist() for c in table.columns])) if table.num_columns else [])
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {str(bad[0])[:600]}"
    return None


def compare_stored(df, con, sql: str) -> str | None:
    """As ``compare``, for large results: Spark stores its result and DuckDB subtracts."""
    import tempfile

    path = tempfile.mkdtemp(prefix="run-") + "/out"
    df.write.parquet(path)
    con.execute(f"CREATE OR REPLACE TEMP TABLE _want AS {sql}")
    want = sorted(r[0] for r in con.execute("DESCRIBE _want").fetchall())
    if sorted(df.columns) != want:
        return f"columns {sorted(df.columns)} != {want}"
    names = ", ".join(f'"{n}"' for n in want)
    got = f"SELECT {names} FROM read_parquet('{path}/*.parquet')"
    con.execute(f"CREATE OR REPLACE TEMP TABLE _got AS {got}")
    extra = con.execute(f"SELECT {names} FROM _got EXCEPT ALL SELECT {names} FROM _want").fetchall()
    lacking = con.execute(f"SELECT {names} FROM _want EXCEPT ALL SELECT {names} FROM _got").fetchall()
    if extra or lacking:
        return f"{len(extra)} rows too many, {len(lacking)} lacking, {str(extra[:1])[:300]} {str(lacking[:1])[:300]}"
    return None


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from assayloom import build_session

    sf_dir, only = argv[0], set(argv[1:])
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="12g", spark__driver__maxResultSize="4g")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(sf_dir), 0
    sql = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sql:
                problem = compare_stored(df, con, sql[name])
                note = "ok" if problem is None else f"FAIL {problem}"
            else:
                problem, note = None, f"{df.count()} rows"
        except Exception as e:
            problem, note = e, f"ERROR {type(e).__name__} {str(e)[:1200]}"
        failed += problem is not None
        print(f"{name:36s} {time.time() - start:6.1f}s {note}", flush=True)
    print("failed", failed)


if __name__ == "__main__":
    main(sys.argv[1:])
