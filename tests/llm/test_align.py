"""Alignment of two tokenizers against a plain reading of its rules."""

import collections
import hashlib

import numpy as np
import pyarrow as pa
import pytest

from assayloom.llm import align
from assayloom.llm.registry import QUERIES, tokenizer

PATHS = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return align.Tokenizers(*PATHS)


def _groups(both, text):
    """[(A ids, B ids)] of a text, by its whole encodings."""
    found = both.encode(text) if text else None
    if found is None:
        return []
    ends = [np.cumsum([len(table[i]) for i in ids]).tolist() for table, ids in zip((both.a_bytes, both.b_bytes), found)]
    after = [{e: k + 1 for k, e in enumerate(side)} for side in ends]
    out, i, j = [], 0, 0
    for c in sorted(after[0].keys() & after[1].keys()):
        i1, j1 = after[0][c], after[1][c]
        out.append((found[0][i:i1].tolist(), found[1][j:j1].tolist()))
        i, j = i1, j1
    return out


def _brute(both, rows):
    groups = [_groups(both, t) for _, t in rows]
    counts = collections.Counter(p for own in groups for p in {(x, y) for a, b in own for x in a for y in b})
    top = collections.defaultdict(int)
    for (x, _), n in counts.items():
        top[x] = max(top[x], n)
    out = []
    for (i, _), own in zip(rows, groups):
        once = [(collections.Counter(a), collections.Counter(b)) for a, b in own]
        links = [(counts[x, y], top[x], n * m) for a, b in once for x, n in a.items() for y, m in b.items()]
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own)
        out.append((i, sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), sum(m for *_, m in links),
                    sum(m for c, t, m in links if c == t), sum(c * m for c, _, m in links), hashlib.sha256(said.encode()).hexdigest() if own else ""))
    return sorted(out, key=str)


ODD = ["<s> </s> <unk> <|endoftext|>", "tabs\tand\n\nlines \n x", "  two  spaces   three ", " ", "\n", "x " * 40 + " " * 1000 + "y", "a ▁b c",
       "I'm we'll 's 'x", "日本語のテキスト 漢字 🙂🙂 é", " nbsp  　 wide", "tail ", "1234567 89.5%", "<0x41> <0x0A>",
       "\x00 nul \x85 x\x1c y", "a\r\nb {\r\n}\r c", "zero​width   sep", "ﬁ ① Å", "don't  don't don't"]


@pytest.mark.parametrize("sizes", [None, (40, 20, 3, 5)])
def test_alignment_equals_brute_force(spark, both, edges, edge_rows, sizes, monkeypatch):
    if sizes:
        for name, value in zip(("_CHUNK_BYTES", "_CALL_BYTES", "_PIECE", "_BLOCK"), sizes):
            monkeypatch.setattr(align, name, value)
    rows = [r[:2] for r in edge_rows if not sizes or len(r[1] or "") < 60_000] + [(100 + k, t) for k, t in enumerate(ODD)]
    df = edges.where("text IS NULL OR length(text) < 60000") if sizes else edges
    df = df.select("text", "doc_id", "n").unionByName(spark.createDataFrame([(t, 100 + k, "n") for k, t in enumerate(ODD)], "text string, doc_id long, n string"))
    got = align.align(df.repartition(3), *PATHS)
    assert got.columns == align._NAMES
    assert sorted(map(tuple, got.collect()), key=str) == _brute(both, rows)


def test_alignment_of_the_documents(spark, sf, both, documents):
    got = sorted(map(tuple, QUERIES["op12_token_alignment"](spark, sf).collect()), key=str)
    assert got == _brute(both, [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()])


def test_no_rows_and_nothing_to_align(spark, nothing, both):
    assert align.align(nothing, *PATHS).count() == 0
    df = spark.createDataFrame([(1, None), (1, ""), (None, "▁")], "doc_id long, text string")
    got = sorted(map(tuple, align.align(df, *PATHS).collect()), key=str)
    assert got == sorted([(1, *[0] * 6, ""), (1, *[0] * 6, ""), (None, *[0] * 6, "")], key=str)


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1000])
def test_merge_path_pieces_find_all_common_ends(piece):
    rng = np.random.default_rng(piece)
    for _ in range(100):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(0, 40))) for _ in range(2))
        in_a, in_b = align.common_ends(a, b, piece)
        assert (in_a == np.isin(a, b)).all() and (in_b == np.isin(b, a)).all()
        if len(a) and len(b):
            at = align.merge_path(a, b, piece)
            steps = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
            merged = sorted([(v, 0) for v in a] + [(v, 1) for v in b])
            assert at.tolist() == [sum(side == 0 for _, side in merged[:s]) for s in steps]


def test_units_are_the_text():
    texts = pa.array(["a b", "", " lead", "x  y z ", "\n a", "one"])
    offsets, codes, distinct, plain = align.units(texts)
    for k, t in enumerate(texts.to_pylist()):
        own = [distinct[c] for c in codes[offsets[k]:offsets[k + 1]]]
        assert "".join(f" {u}" for u in own) == (f" {t}" if t else "")
    assert {u for u, p in zip(distinct, plain) if p} >= {"a", "b", "one"}
