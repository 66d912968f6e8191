"""Samples and splits."""

from assayloom.operators import split as S
from suite.registry import query
from suite.tables import MAJORITY, MINORITY

_MAJOR = ", ".join(f"'{m}'" for m in MAJORITY)
_MINOR = ", ".join(f"'{m}'" for m in MINORITY)


def key_sql(seed, ids: str) -> str:
    return f"md5('{seed}:' || {ids})"


def holdout_sql(source: str, ids: str, group: str, seed, test: float, val: float) -> str:
    """CTEs ending in ``placed``: ``source`` with its group-aware split."""
    return f"""major AS (SELECT *, ROW_NUMBER() OVER (ORDER BY {key_sql(f'{seed}-test', ids)}) AS test_place,
  COUNT(*) OVER () AS n FROM {source} WHERE {group} IN ({_MAJOR})),
major_left AS (SELECT *, ROW_NUMBER() OVER (ORDER BY {key_sql(f'{seed}-val', ids)}) AS val_place, COUNT(*) OVER () AS n_left
  FROM major WHERE test_place > CEIL(CAST({test} AS DOUBLE) * n)),
minor AS (SELECT *, ROW_NUMBER() OVER (ORDER BY {key_sql(f'{seed}-minority', ids)}) AS train_place,
  COUNT(*) OVER () AS n FROM {source} WHERE {group} IN ({_MINOR})),
placed AS (
  SELECT * EXCLUDE (test_place, n), 'test' AS split FROM major WHERE test_place <= CEIL(CAST({test} AS DOUBLE) * n)
  UNION ALL SELECT * EXCLUDE (test_place, n, val_place, n_left),
    CASE WHEN val_place <= CEIL(CAST({val} AS DOUBLE) * n_left) THEN 'val' ELSE 'train' END FROM major_left
  UNION ALL SELECT * EXCLUDE (train_place, n),
    CASE WHEN train_place <= FLOOR(CAST(0.1 AS DOUBLE) * n) THEN 'train' ELSE 'test' END FROM minor)"""


@query(f"""WITH k AS (SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY {key_sql('s', 'o_orderkey')}) AS rn,
  COUNT(*) OVER () AS n FROM orders)
SELECT o_orderkey FROM k WHERE rn <= FLOOR(CAST(0.1 AS DOUBLE) * n)""")
def exact_size_sample(t):
    return S.exact_sample(t.orders.select("o_orderkey"), ["o_orderkey"], S.floor_of(0.1), "s")


@query(f"""WITH k AS (SELECT event_id, ROW_NUMBER() OVER (ORDER BY {key_sql(42, 'event_id')}) AS rn,
  COUNT(*) OVER () AS n FROM events)
SELECT event_id, CASE WHEN rn <= CEIL(CAST(0.2 AS DOUBLE) * n) THEN 'test' ELSE 'train' END AS split FROM k""")
def shuffle_split(t):
    return S.two_way_split(t.events.select("event_id"), ["event_id"], 0.2, 42)


@query(f"""WITH a AS (SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY {key_sql('42-test', 'o_orderkey')}) AS r,
  COUNT(*) OVER () AS n FROM orders),
b AS (SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY {key_sql('42-val', 'o_orderkey')}) AS r, COUNT(*) OVER () AS n
  FROM a WHERE a.r > CEIL(CAST(0.2 AS DOUBLE) * a.n))
SELECT o_orderkey, 'test' AS split FROM a WHERE r <= CEIL(CAST(0.2 AS DOUBLE) * n)
UNION ALL SELECT o_orderkey, CASE WHEN r <= CEIL(CAST(0.1 AS DOUBLE) * n) THEN 'val' ELSE 'train' END FROM b""")
def nested_shuffle_split(t):
    return S.nested_split(t.orders.select("o_orderkey"), ["o_orderkey"], 0.2, 0.1, 42)


_SEGMENTS = "SELECT c_custkey, c_mktsegment FROM customer"


@query(f"""WITH src AS ({_SEGMENTS}), {holdout_sql('src', 'c_custkey', 'c_mktsegment', 7, 0.2, 0.1)}
SELECT c_custkey, c_mktsegment, split FROM placed""")
def three_way_holdout(t):
    return S.group_holdout(t.customer.select("c_custkey", "c_mktsegment"), ["c_custkey"], "c_mktsegment",
                           MAJORITY, MINORITY, 7, test_fraction=0.2, val_fraction=0.1)


@query(f"""WITH src AS ({_SEGMENTS}), {holdout_sql('src', 'c_custkey', 'c_mktsegment', 7, 0, 0)}
SELECT c_custkey, c_mktsegment, split FROM placed""")
def two_way_holdout(t):
    return S.group_holdout(t.customer.select("c_custkey", "c_mktsegment"), ["c_custkey"], "c_mktsegment",
                           MAJORITY, MINORITY, 7)
