"""Ranked search against a plain reading of its rules."""

import collections
import math
import re

import numpy as np
import pytest

from assayloom.llm import search
from assayloom.llm.search import best_of_chunk, ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _brute(docs, items, k=10):
    held = [(i, collections.Counter(_terms(t))) for i, t in docs]
    n, total = sum(bool(w) for _, w in held), sum(w.total() for _, w in held)
    df = collections.Counter(term for _, w in held for term in w)
    out = []
    for item, text in items:
        scores = []
        for i, w in held:
            m = 10 + (90 * w.total() * n) // max(1, total)
            score = 0
            for term in set(_terms(text)):
                if tf := w[term]:
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1))) * ((10**9 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, (i is not None, i or 0), i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


ITEMS = [(1, "The CAT, on: the mat"), (2, None), (3, ""), (4, "nowhere-seen zzz"), (5, "é 漢字 \x1c\x85 end"), (5, "One two_three"),
         (None, "word5 and7 today"), (7, " ".join(f"word{i}" for i in range(977)))]


@pytest.mark.parametrize("slice_bytes", [1 << 23, 50])
def test_ranked_equals_brute_force(spark, edges, edge_rows, slice_bytes, monkeypatch):
    monkeypatch.setattr(search, "SLICE_BYTES", slice_bytes)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((tuple(r) for r in ranked(edges, items).collect()), key=str)
    assert got == _brute([r[:2] for r in edge_rows], ITEMS)


def test_items_in_several_blocks(spark, edges, edge_rows, monkeypatch):
    monkeypatch.setattr(search, "_ITEM_BYTES", 100)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").coalesce(1)
    assert len(list(search._blocks(items.toDF("item", "text")))) > 2
    got = sorted((tuple(r) for r in ranked(edges, items, k=3).collect()), key=str)
    assert got == _brute([r[:2] for r in edge_rows], ITEMS, 3)


def test_empty_tables(spark, edges, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for got in (ranked(nothing, items), ranked(edges, items.limit(0)), ranked(nothing, items.limit(0))):
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0


def test_many_documents_of_equal_score(spark):
    """A third of all rows is one text; ties go by id over chunks and tasks."""
    docs = [(i, "same words here" if i % 3 == 0 else f"same thing {i % 11}") for i in range(3000)]
    items = [(1, "same words"), (2, "thing 4")]
    got = ranked(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == _brute(docs, items)


def test_limited_accumulators_keep_the_best():
    rng = np.random.default_rng(5)
    for _ in range(200):
        size, whole, found = 60, np.zeros(60, np.int64), []
        for j in range(rng.integers(1, 12)):
            docs = np.sort(rng.choice(size, rng.integers(1, size), replace=False))
            gain = rng.integers(0, 1000 // (j + 1) ** 2 + 2, len(docs))
            whole[docs] += gain
            found.append((docs, gain))
        docs, score = best_of_chunk(found, 5, size)
        assert (whole[docs] == score).all()
        best = sorted(((-s, d) for d, s in enumerate(whole) if s > 0))[:5]
        assert sorted(zip(-score, docs))[:5] == best


def test_accumulators_stop():
    """A rare term decides; the frequent one makes no accumulators after it."""
    rare = (np.arange(10), np.full(10, 1000))
    frequent = (np.arange(1000), np.full(1000, 3))
    docs, score = best_of_chunk([rare, frequent], 10, 1000)
    assert docs.tolist() == list(range(10)) and (score == 1003).all()
