"""Operators over texts against brute force, on edge cases and the smallest tables."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assayloom.llm import exact_dedup, langid, lm, ngram_join, packing, pieces, pii, toxicity
from assayloom.llm.components import components
from assayloom.llm.registry import QUERIES, tokenizer
from assayloom.llm.text import fold
from assayloom.llm.token_counts import token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def key(row):
    return tuple((v is not None, str(v)) for v in row)


def _ids(text, path="word_bpe_49k.json"):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer(path)).encode(text or "", add_special_tokens=False).ids


# ---- token counts ----

def test_token_counts(edges, edge_rows, nothing):
    got = sorted((tuple(r) for r in token_counts(edges, tokenizer("word_bpe_49k.json")).collect()), key=key)
    want = sorted(((r[0], len((r[1] or "").encode()), len(_ids(r[1])), len(_ids(r[1])) > 2048) for r in edge_rows), key=key)
    assert got == want
    assert token_counts(nothing, tokenizer("word_bpe_49k.json")).count() == 0


def test_merged_words_are_those_of_the_library(documents):
    import json
    import random

    from assayloom.llm import token_counts as tc, word_bpe

    path = tokenizer("word_bpe_49k.json")
    encoder = tc.Encoder(path)
    assert encoder.words is not None
    rng = random.Random(3)
    words = ["aaaaaaa", "banana", "Mississippi", "ÀÉÎÕÜ", "straße", "(don't)", "'tis", "it's", "x'", "--dash--", "a.b", "9lives", "<|endoftext|>",
             "|pipe|", "e\u0301", "İstanbul", "ﬁne", "漢字", "\u00d7", "\\back]", "q" * 300]
    words += ["".join(rng.choices("abestinéüAZ", k=rng.randint(1, 14))) + rng.choice(["", ".", ",", "'", ")."]) for _ in range(3000)]
    words += sorted({w for r in documents.limit(40).collect() for w in (r.text or "").split()})
    ids, counts = encoder.of_units(pa.array(words))
    ends = np.cumsum(counts)
    assert [ids[i:j].tolist() for i, j in zip(ends - counts, ends)] == encoder.encode(words)
    which, parts = word_bpe.parted(pa.array(words))
    assert which.sum() > 3000 and not which[words.index("<|endoftext|>")] and not which[words.index("'tis")]
    assert encoder.of_units(pa.array([], pa.string()))[1].tolist() == []
    definition = json.load(open(path, encoding="utf-8"))
    definition["model"]["merges"].reverse()
    assert not word_bpe.fits(definition)
    assert not word_bpe.fits(json.load(open(tokenizer("byte_bpe_50k.json"), encoding="utf-8")))


def test_token_counts_of_special_strings_and_other_kinds(spark):
    texts = ["a<|endoftext|>b <|startoftext|>", "don't stop!", "Ünï  çödé", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts(df, tokenizer("word_bpe_49k.json")).collect()}
    assert got == {k: len(_ids(t)) for k, t in enumerate(texts)}
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    got = {r.doc_id: r.n_tokens for r in token_counts(df, tokenizer("piece_bpe_32k.model")).collect()}
    assert got == {k: len(model.encode(t or "")) for k, t in enumerate(texts)}
    got = {r.doc_id: r.n_tokens for r in token_counts(df, tokenizer("byte_bpe_50k.json")).collect()}
    assert got == {k: len(_ids(t, "byte_bpe_50k.json")) for k, t in enumerate(texts)}


# ---- exact dedup ----

def _exact(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    out = []
    for i, t in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        top = min(k for k, _ in groups[norm])
        keep = min((j for k, j in groups[norm] if k == top and j is not None), default=None)
        out.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=key)


def test_exact_dedup(edges, edge_rows, nothing):
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, exact_dedup.keepers(edges).select(names).collect()), key=key) == _exact([r[:2] for r in edge_rows])
    assert exact_dedup.keepers(nothing).count() == 0
    index = exact_dedup.DigestIndex(edges.sparkSession, "digest_edges", buckets=4)
    try:
        assert index.admit(nothing).count() == 0
        assert sorted(map(tuple, index.admit(edges).select(names).collect()), key=key) == _exact([r[:2] for r in edge_rows])
    finally:
        index.drop()


def test_index_admits_each_text_once(spark):
    index = exact_dedup.DigestIndex(spark, "digest_test", buckets=4)
    index.drop()
    try:
        schema = "doc_id long, text string"
        index.admit(spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "c")], schema))
        second = index.admit(spark.createDataFrame([(4, "a  b"), (5, "d"), (6, None)], schema))
        assert {(r.doc_id, r.is_new) for r in second.collect()} == {(4, False), (5, True), (6, True)}
        assert spark.table("digest_test").count() == 4
        assert {(r.doc_id, r.keep_id, r.kept) for r in second.collect()} == {(4, 1, False), (5, 5, True), (6, 6, True)}
        probe = index.new_digests(spark.createDataFrame([("x",)], "text_sha256 string"))
        plan = probe._jdf.queryExecution().toString()
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    finally:
        index.drop()


# ---- language ----

def test_language_of_held_out_documents(documents):
    from pyspark.sql import functions as F

    model = langid.fit(documents.where(fold("doc_id", 5) != 0))
    got = langid.identify(documents, model, keep=("lang",)).where(fold("doc_id", 5) == 0)
    assert got.where(F.col("lang_pred") == F.col("lang")).count() >= 0.95 * got.count()
    assert got.where("score < 0 OR score > 1").count() == 0


def test_language_edges(edges, edge_rows, nothing):
    model = langid.fit(edges, min_count=1)
    got = langid.identify(edges, model).collect()
    assert len(got) == len(edge_rows)
    by = {r.doc_id: r for r in got}
    for i in (1, 2, 3, 10):
        assert by[i].lang_pred == "und" and by[i].score == 0
    assert by[13].lang_pred == "en"
    none = langid.fit(nothing)
    assert {r.lang_pred for r in langid.identify(edges, none).collect()} == {"und"}
    assert langid.identify(nothing, model).count() == 0


def test_known_words_are_bounded(documents):
    assert len(langid.fit(documents, max_words=100, min_count=1).known) <= 100


def test_every_word_and_gram_counts_as_itself(documents):
    """All training words are known, all their n-grams seen, and nothing else is."""
    train = documents.where(fold("doc_id", 5) != 0)
    words = {w for r in train.where("lang IS NOT NULL").select("text").collect()
             for w in langid._bare(pa.array([r.text or ""]))[0].as_py().split()}
    model = langid.fit(train)
    assert {r.key for r in model.known.rows.select("key").collect()} == words
    assert {r.key for r in model.grams.rows.select("key").collect()} == {g for w in words for n in (4, 3, 2, 1) for g in langid._grams(w, n)}


def _language_by_hand(train, rows, orders=(4, 3, 2, 1), prior=1.0):
    """{id: (language, score)}, counted and backed off one word at a time."""
    def words_of(text):
        return langid._bare(pa.array([text or ""]))[0].as_py().split()

    langs = sorted({lang for _, lang, text in train if lang is not None and words_of(text)})
    words, grams = collections.Counter(), collections.Counter()
    for _, lang, text in train:
        for w in words_of(text) if lang is not None else ():
            words[w, lang] += 1
            for n in orders:
                for g in langid._grams(w, n):
                    grams[g, lang] += 1

    def rates(counts, key, size):
        own = [counts[key, v] for v in langs]
        return [math.log((c + prior * sum(own) / sum(size) + 1e-12) / (s + prior)) for c, s in zip(own, size)]

    known, seen = {w for w, _ in words}, {g for g, _ in grams}
    total = [sum(n for (_, v), n in words.items() if v == lang) for lang in langs]
    by_order = {k: [sum(n for (g, v), n in grams.items() if v == lang and len(g) == k) for lang in langs] for k in orders}

    def score(word):
        if word in known:
            return rates(words, word, total)
        marked, at, found = f"<{word}>", 0, []
        while at < len(marked):
            n = next((n for n in orders if at + n <= len(marked) and marked[at:at + n] in seen), 0)
            if n:
                found.append(rates(grams, marked[at:at + n], by_order[n]))
            at += max(1, n - 1)
        return [sum(f) / len(found) for f in zip(*found)] if found else [0.0] * len(langs)

    memory, out = {}, {}
    for i, _, text in rows:
        sums = [0.0] * len(langs)
        for w in words_of(text):
            if w not in memory:
                own = score(w)
                memory[w] = [x - max(own) for x in own]
            sums = [a + b for a, b in zip(sums, memory[w])]
        share = [math.exp(x - max(sums)) for x in sums]
        best = max(range(len(langs)), key=lambda k: (share[k], -k))
        lettered = any(c.isalpha() for c in text or "")
        out[i] = (langs[best], share[best] / sum(share)) if lettered else ("und", 0.0)
    return out


@pytest.mark.parametrize("block", [8 << 20, 1 << 12])
def test_language_equals_brute_force(documents, monkeypatch, block):
    """Backoff and score, also where texts lie in finer blocks than the model."""
    train = documents.where((fold("doc_id", 5) != 0) & (F.col("doc_id") % 3 == 0))
    rows = [(r.doc_id, r.lang, r.text) for r in documents.collect()]
    want = _language_by_hand([(r.doc_id, r.lang, r.text) for r in train.collect()], rows)
    model = langid.fit(train)
    monkeypatch.setattr(langid, "_BLOCK_BYTES", block)
    got = {r.doc_id: r for r in langid.identify(documents, model).collect()}
    assert got.keys() == want.keys()
    for i, (lang, score) in want.items():
        assert got[i].lang_pred == lang and abs(got[i].score - score) < 1e-4


def test_language_of_long_words_and_repeats(spark):
    rows = [(1, "en", "the cat sat on the mat"), (2, "de", "die katze sass auf der matte"), (3, None, "x" * 50_000),
            (4, "en", None), (5, None, "\U00020000\U00020001 kat\u0301ze"), (1, "en", "the cat sat on the mat"), (None, "de", "matte 123")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = langid.fit(docs)
    got = sorted((r.doc_id or 0, r.lang_pred) for r in langid.identify(docs, model).collect())
    assert len(got) == len(rows) and got[0] == (0, "de") and got[1:3] == [(1, "en"), (1, "en")]
    assert dict(got)[4] == "und" and dict(got)[2] == "de"


# ---- near duplicates ----

def _shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def _near(rows, k, percent):
    sets = {i: _shingles(t, k) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
            ra, rb = sorted((find(a), find(b)))
            root[rb] = ra
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80)])
def test_near_duplicates(documents, k, percent):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(documents, k=k, percent=percent).collect()}
    assert got == _near(rows, k, percent)


def test_near_duplicates_of_one_large_group(spark):
    """Edited copies of one text: some link to it, some only to each other, some to nothing."""
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(150):
        words = list(base)
        for e in range(d % 9):
            words[(d * 7 + e * 13) % 120] = f"edit{d % 40}x{e}"
        rows.append((d, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect()}
    assert got == _near(rows, 4, 85)


def test_near_duplicate_edges(edges, edge_rows, nothing):
    got = collections.Counter(tuple(r) for r in ngram_join.near_duplicates(edges).collect())
    want = _near([r[:2] for r in edge_rows], 4, 85)
    assert got == collections.Counter(
        (r[0], *want[r[0]]) if r[0] is not None else (None, len(_shingles(r[1], 4)), None) for r in edge_rows)
    assert ngram_join.near_duplicates(nothing).count() == 0


def test_signatures_meet():
    """Any two similar sets share a signature, whatever the frequencies."""
    rng = np.random.default_rng(3)
    for trial in range(300):
        n = int(rng.integers(2, 160))
        x = rng.choice(10_000, n, replace=False)
        change = int(rng.integers(0, max(1, n // 8)))
        y = np.concatenate((x[change:], 20_000 + np.arange(int(rng.integers(0, max(1, n // 8))))))
        a, b = set(x.tolist()), set(y.tolist())
        if not b or 100 * len(a & b) < 85 * len(a | b):
            continue
        freq = {t: int(f) for t, f in zip(sorted(a | b), rng.integers(2, 100, len(a | b)))}
        own = []
        for s in (a, b):
            held = sorted((t for t in s if t in a and t in b), key=lambda t: (freq[t], t))
            own.append(set(ngram_join.signatures(len(s), np.array(held, np.int64), np.array([freq[t] for t in held]), 85)))
        assert own[0] & own[1]


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (7, 8), (8, 9), (9, 10), (10, 11), (11, 12), (4, 4)]
    got = {tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), *((i, 7) for i in range(7, 13))}


# ---- personal data ----

def _base(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


@pytest.mark.parametrize("text", [
    "", "a@b.c", "x@@y.z a@b@c.d.e", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "999.1.1.1 0000255.0.0.1", "4111-1111 11111111",
    "+1(2)3-4.5 678901 +", "++12 3456789012", "é a.b+c@d-e.fr, 10.0.0.1", "@", "a@", "@b.c", "1 2 3 4 5 6 7 8 9 0 1 2 3 4",
])
def test_exact_patterns(text):
    assert pii.base_spans(text) == _base(text)


def test_exact_patterns_on_random_text():
    rng = np.random.default_rng(5)
    for _ in range(3000):
        text = "".join(rng.choice(list("ab.@-+ 0123456789()"), 40))
        assert pii.base_spans(text) == _base(text)


def test_long_runs_take_linear_time():
    for text in ("9" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1 " * 60_000, "@a" * 100_000):
        pii.all_spans(text, {"email": 1.0})


def test_personal_data_query(documents, spark, sf):
    text = {r.doc_id: r.text for r in documents.collect()}
    for r in QUERIES["op2_personal_data"](spark, sf).collect():
        base = _base(text[r.doc_id] or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in base) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base).encode()).hexdigest()
        spans = [s.split(":") for s in r.spans.split(",")] if r.spans else []
        assert {(int(a), pii.KINDS.index(k), int(b)) for k, a, b in spans} >= set(base)


def test_field_finds_rewritten_entities(documents):
    weights = pii.train(documents)
    for text, kind in (("write to jane.roe(at)mail.example.com today", "email"), ("call (212) 555-0147 now", "phone"),
                       ("from 10[.]20[.]30[.]40 on", "ip")):
        assert [pii.KINDS[s[1]] for s in pii.all_spans(text, weights)[1]] == [kind]
    for text in ("in 1999 there were 12 of 345", "a, b and c at noon", "version 3.14 of 2024-01-02"):
        assert pii.all_spans(text, weights)[1] == []


@pytest.mark.parametrize("kind, span", [
    (0, "john.smith at example dot com"), (0, "a at b.org"), (0, "x at y [dot] z"), (0, "l" * 60 + "@example.com"),
    (1, "10[.]0[.]0[.]1"), (1, "192[dot]168[dot]1[dot]20"), (1, "8 . 8 . 8 . 8"), (1, "1(.)1(.)1(.)1"), (1, "127 . 0 . 0 . 1"),
])
def test_windows_open_on_every_loose_form(documents, kind, span):
    text = f"so we say {span} and no more"
    found = {(z.borders[i], k, z.borders[j]) for z in pii.zones(text) for i, j, k, _ in z.segments}
    assert (10, kind, 10 + len(span)) in found


def test_field_finds_short_and_spelled_entities(documents):
    weights = pii.train(documents)
    for span, kind in (("john.smith at example dot com", 0), ("10[.]0[.]0[.]1", 1), ("192[dot]168[dot]1[dot]20", 1),
                       ("8 . 8 . 8 . 8", 1)):
        assert pii.all_spans(f"so we say {span} and no more", weights)[1] == [(10, kind, 10 + len(span))]
    for text in ("we met at noon. Then we left", "look at figure 1.2 of 3", "at example one dot two"):
        assert pii.all_spans(text, weights)[1] == []


def test_personal_data_edges(edges, edge_rows, nothing):
    got = pii.find_spans(edges, {}).collect()
    assert len(got) == len(edge_rows)
    row = next(r for r in got if r.doc_id == 15)
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 1)
    clean = {r.doc_id: r.text for r in pii.redact(edges, {}).collect()}
    assert clean[1] is None and clean[15] == "[EMAIL] [IP], [CARD], [PHONE]"
    assert pii.find_spans(nothing, pii.train(nothing)).count() == 0


# ---- packing ----

def _check_packing(rows, texts):
    want = {i: np.array(_ids(t) + [1], "<u4") for i, t in texts}
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(want)
    for i, parts in by_doc.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == len(want[i])
    used = []
    for parts in by_sequence.values():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        used.append(at)
    assert max(used) <= 2048 and sum(u < 2048 for u in used) <= 1


def test_packing(documents):
    rows = packing.pack(documents, tokenizer("word_bpe_49k.json")).collect()
    _check_packing(rows, [(r.doc_id, r.text) for r in documents.collect()])


def test_packing_edges(edges, edge_rows, nothing):
    once = edges.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = packing.pack(once, tokenizer("word_bpe_49k.json")).collect()
    _check_packing(rows, {r[0]: r[1] for r in edge_rows if r[0] is not None}.items())
    again = packing.pack(edges, tokenizer("word_bpe_49k.json"), carry_ids=True).collect()
    assert sum(r.length for r in again) == sum(len(_ids(r[1])) + 1 for r in edge_rows)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in again)
    assert packing.pack(nothing, tokenizer("word_bpe_49k.json")).count() == 0


def test_hilbert_neighbours_touch():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        order = np.argsort(packing.hilbert_key(cells, bits))
        assert sorted(packing.hilbert_key(cells, bits).tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


# ---- sampled pieces ----

def test_pieces_are_lossless_and_reproducible(edges, edge_rows, nothing):
    path = tokenizer("piece_bpe_32k.model")
    got = pieces.encode(edges, path)
    rows = got.collect()
    assert len(rows) == len(edge_rows) and all(r.restored for r in rows)
    other = {(r.doc_id, r.ids_crc32) for r in pieces.encode(edges.repartition(5), path).collect()}
    assert other == {(r.doc_id, r.ids_crc32) for r in rows}
    assert {r.ids_crc32 for r in pieces.encode(edges, path, seed=2).collect()} != {r.ids_crc32 for r in rows}
    texts = sorted(((r.doc_id, r.text) for r in pieces.decode(got, path).collect()), key=key)
    assert texts == sorted(((r[0], r[1] or "") for r in edge_rows), key=key)
    assert pieces.encode(nothing, path).count() == 0


def test_pieces_follow_the_lattice_distribution():
    import sentencepiece

    path = tokenizer("piece_bpe_32k.model")
    model, p = sentencepiece.SentencePieceProcessor(model_file=path), pieces.load(path)
    ids = {model.id_to_piece(i): i for i in range(model.get_piece_size())}

    def cuts(s):
        if not s:
            yield ()
        for k in range(1, len(s) + 1):
            if s[:k] in ids:
                for rest in cuts(s[k:]):
                    yield (ids[s[:k]], *rest)

    chance = {c: math.exp(sum(p.weight[i] for i in c)) for c in cuts("thing")}
    n = 20_000
    drawn, ends = pieces.encode_slice(pa.array(["thing"] * n), list(range(n)), p, 7)
    seen = collections.Counter(tuple(drawn[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:]))
    assert set(seen) <= set(chance)
    total = sum(chance.values())
    assert max(abs(seen[c] / n - chance[c] / total) for c in chance) < 0.015


# ---- language model ----

def _lm_base(rows, held):
    tokens = {k: WORD.findall((t or "").translate(LOWER)) + [" "] for k, (_, t) in enumerate(rows)}
    count = collections.Counter(w for k, ws in tokens.items() if not held[k] for w in ws)
    n, v = sum(count.values()), len(count)
    return [(i, held[k], len(tokens[k]), sum(count[w] > 0 for w in tokens[k]), n,
             sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens[k])) for k, (i, _) in enumerate(rows)]


def test_lm_scores(documents):
    from pyspark.sql import functions as F

    rows = [(r.doc_id, r.text) for r in documents.collect()]
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    got = sorted(lm.score(documents.withColumn("h", fold("doc_id", 10) == 0), "h").collect(), key=lambda r: r.doc_id)
    for r, w in zip(got, sorted(_lm_base(rows, held))):
        assert tuple(r)[:5] == w[:5] and math.isclose(r.base_score, w[5], rel_tol=1e-9)
        assert r.score < 0
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_lm_prefers_seen_continuations(spark):
    texts = [(0, "a b a c a b"), (1, "a b b c"), (2, "c a b a")]
    df = spark.createDataFrame([(i, t, False) for i, t in texts], "doc_id long, text string, h boolean")
    more = spark.createDataFrame([(10 + k, f"a {w}", True) for k, w in enumerate(("b", "c", "new"))], df.schema)
    got = {r.doc_id: r.score for r in lm.score(df.unionByName(more), "h").collect()}
    assert 0 > got[10] > got[12]


def test_lm_edges(edges, edge_rows, nothing):
    got = lm.score(edges.withColumn("h", fold("doc_id", 2) == 0), "h").collect()
    assert len(got) == len(edge_rows)
    assert all(r.n_tokens == 1 for r in got if r.doc_id in (1, 2, 3))
    assert lm.score(nothing.withColumn("h", fold("doc_id", 2) == 0), "h").count() == 0
    alone = lm.score(edges.withColumn("h", fold("doc_id", 1) == 0), "h").collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in alone)


def _mixed_scores(rows, held):
    """Bigrams mixed with words by the count of the context, weights by expectation-maximisation on leave-one-out counts."""
    streams = [WORD.findall((t or "").translate(LOWER)) + [" end"] for _, t in rows]
    learned = [s for s, h in zip(streams, held) if not h]
    word = collections.Counter(w for s in learned for w in s)
    pair = collections.Counter(p for s in learned for p in zip([" start", *s], s))
    context = collections.Counter(c for s in learned for c in [" start", *s[:-1]])
    n, v = sum(word.values()), len(word)

    def bucket(c):
        return 0 if c <= 0 else min(int(math.log2(c)) + 1, 40)

    deleted = collections.defaultdict(list)
    for s in learned:
        for c, w in zip([" start", *s], s):
            rate = (word[w] - 1 + 0.1) / (n - 1 + 0.1 * (v + 1))
            seen = pair[c, w] - 1
            deleted[bucket(context[c] - 1)].append(seen / (context[c] - 1) / rate if seen else 0.0)
    weight = collections.defaultdict(float)
    for b, ratios in deleted.items():
        x = 0.5 if b else 0.0
        for _ in range(200):
            x = sum(x * r / (x * r + 1 - x) if x < 1 or r else 0.0 for r in ratios) / len(ratios)
        weight[b] = min(x, 1 - 1e-6)
    out = []
    for s in streams:
        total = 0.0
        for c, w in zip([" start", *s], s):
            x, base = weight[bucket(context[c])], (word[w] + 0.1) / (n + 0.1 * (v + 1))
            total += math.log10((x * pair[c, w] / context[c] if context[c] else 0.0) + (1 - x) * base)
        out.append(total)
    return out


def test_lm_mixture_equals_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    got = {r.doc_id: r.score for r in lm.score(documents.withColumn("h", fold("doc_id", 10) == 0), "h").collect()}
    want = dict(zip([i for i, _ in rows], _mixed_scores(rows, held)))
    # The ratios of the deleted estimates are added up in bins of a twentieth, so weights are near, not equal.
    assert got.keys() == want.keys()
    assert max(abs(got[i] - want[i]) / abs(want[i]) for i in want) < 2e-3


# ---- toxicity ----

def _all_maximal(values):
    """Maximal scoring segments by their definition: best first, then left and right of it."""
    if not values:
        return []
    best = max(((sum(values[a:b]), -(b - a), -a, b) for a in range(len(values)) for b in range(a + 1, len(values) + 1)))
    if best[0] <= 0:
        return []
    a, b = -best[2], best[3]
    return ([(x, y, s) for x, y, s in _all_maximal(values[:a])] + [(a, b, best[0])]
            + [(x + b, y + b, s) for x, y, s in _all_maximal(values[b:])])


def test_segments_against_their_definition():
    rng = np.random.default_rng(2)
    for _ in range(400):
        values = [float(v) + 0.001 * k for k, v in enumerate(rng.integers(-4, 5, int(rng.integers(1, 14))))]
        got = toxicity.all_segments(values, 1e-9)
        assert [g[:2] for g in got] == [w[:2] for w in _all_maximal(values)]
        best = toxicity.best_segments(np.array(values), np.array([0, len(values)]))[0]
        assert math.isclose(best, max([0.0] + [g[2] for g in got]), abs_tol=1e-9)


def test_toxicity_of_held_out_documents(spark):
    rows = []
    for d in range(400):
        words = [f"w{(d * 31 + k * 17) % 200}" for k in range(60)]
        if d % 5 == 0:
            words[d % 40:d % 40] = ["awful", f"vile{d % 7}", "awful"]
        rows.append((d, " ".join(words), int(d % 5 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    tokens = toxicity.token_scores(df.where("doc_id < 300"))
    measured = toxicity.measure(df, tokens)
    model = toxicity.calibrate(measured, df.where("doc_id < 300").select("doc_id", "toxic"), tokens)
    got = {r.doc_id: r for r in toxicity.score(measured, model).collect()}
    assert all(got[d].predicted == int(d % 5 == 0) for d in range(300, 400))
    assert {r.doc_id for r in toxicity.passages(df, model).collect()} == {d for d in range(400) if d % 5 == 0}


def _toxicity_by_hand(rows, labels):
    """Scores of texts by the operator's definition, one text at a time."""
    def tokens(t):
        return re.sub(r"[\W_]+", " ", (t or "").lower()).split()

    def forms(w):
        return [(0, w)] + [(k, w[:k]) for k in (8, 7, 6, 5, 4) if len(w) > k]

    count = {c: collections.Counter(f for d, t in rows if labels.get(d) == c for w in set(tokens(t)) for f in forms(w)) for c in (0, 1)}
    words = {c: sum(len(set(tokens(t))) for d, t in rows if labels.get(d) == c) for c in (0, 1)}
    both, score = sum(words.values()), {}
    for f in {*count[0], *count[1]}:
        seen = count[0][f] + count[1][f]
        gain = sum(count[c][f] * math.log(count[c][f] * both / (seen * words[c])) for c in (0, 1) if count[c][f])
        if 2 * gain > 4 * math.log(max(2, len({*count[0], *count[1]}))):
            a = {c: count[c][f] + seen * 2000.0 / both + 0.5 for c in (0, 1)}
            odds = {c: math.log(a[c]) - math.log(max(words[c] + 2000.0 - a[c], 1.0)) for c in (0, 1)}
            score[f] = odds[1] - odds[0]
    values = {d: [next((score[f] for f in forms(w) if f in score), 0.0) - 0.5 for w in tokens(t)] for d, t in rows}
    flat = np.round(np.array([v for vs in values.values() for v in vs]) / 0.05) * 0.05
    low, high = 0.0, 64.0
    while np.exp(np.minimum(high / 2 * flat, 600)).mean() >= 1:
        high /= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if np.exp(np.minimum(middle * flat, 600)).mean() < 1 else (low, middle)
    lam, k = high, float((flat > 0).mean())
    bound = max(0.0, math.log(k / 0.01) / lam)
    found = {d: sorted((s for _, _, s in toxicity.all_segments(vs, 1e-9)), reverse=True) for d, vs in values.items()}
    many = max(k, sum(s >= bound for own in found.values() for s in own) / len(flat) * math.exp(lam * bound))

    def evidence(d):
        own, n = found[d], max(1, len(values[d]))
        if not own:
            return 0.0
        out = -math.log(max(1e-26, -math.expm1(-k * n * math.exp(-lam * own[0]))))
        for r, s in enumerate((s for s in own if s >= bound), 1):
            e = many * n * math.exp(-lam * s)
            if r > 1 and r > e:
                out = max(out, r * math.log(r / e) - r + e - math.log(r * (r + 1) / 2))
        return min(60.0, max(0.0, out))

    return {d: evidence(d) for d in found}


@pytest.mark.parametrize("limit", ["10485760", "-1"])
def test_toxicity_equals_brute_force(spark, limit):
    """The score is a logistic curve of the evidence, whether telling keys are broadcast or joined."""
    rng = np.random.default_rng(6)
    rows = []
    for d in range(300):
        words = [f"w{v}" for v in rng.integers(0, 150, int(rng.integers(5, 120)))]
        if d % 4 == 0:
            for _ in range(int(rng.integers(1, 5))):
                at = int(rng.integers(0, len(words)))
                words[at:at] = ["Awful", f"disgusting{d % 3}", "vile"][:int(rng.integers(1, 4))]
        rows.append((d, " ".join(words)))
    rows += [(300, None), (301, ""), (302, " . "), (303, "vile " * 3000)]
    labels = {d: int(d % 4 == 0) for d in range(300) if d % 5}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    marked = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        tokens = toxicity.token_scores(df.join(marked, "doc_id"))
        assert (tokens.stored is None) == (limit != "-1")
        measured = toxicity.measure(df, tokens).cache()
        model = toxicity.calibrate(measured, marked, tokens)
        got = {r.doc_id: r.score for r in toxicity.score(measured, model).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = _toxicity_by_hand(rows, labels)
    assert got.keys() == want.keys() and len({round(x, 3) for x in want.values()}) > 20
    for d, x in want.items():
        assert math.isclose(got[d], 1 / (1 + math.exp(-(model.slope * x + model.shift))), abs_tol=2e-3), d
    # The curve is that of the labelled texts: its residuals add up to nothing, but for the light shrinking and rounding.
    assert abs(sum(got[d] - y for d, y in labels.items())) < 0.5


def test_token_scores_are_a_words_own(spark):
    """A word's counts are its own among many, and a word never seen has no score."""
    rng = np.random.default_rng(8)
    rows = [(" ".join([f"{v:x}q" for v in rng.integers(1 << 40, 1 << 44, 3000)] + (["vile"] if d % 2 else ["mild"])), d % 2)
            for d in range(400)]
    scores = toxicity.token_scores(spark.createDataFrame(rows, "text string, toxic int").repartition(4))
    want = toxicity.hashes(pa.array(["vile", "mild"]))
    assert set(scores.keys.tolist()) == set(want.tolist())
    unseen = pa.RecordBatch.from_pydict({"text": [" ".join(f"u{v:x}" for v in range(300_000)) + " vile"]})
    values = toxicity._values(unseen, "text", scores)[1]
    assert (values[:-1] == -scores.drift).all() and values[-1] > 0


def test_many_moderate_passages_outweigh_one(spark):
    """A long text of spread-out passages scores higher than one with a single such passage, and than plain text."""
    rng = np.random.default_rng(4)

    def plain(n):
        return [f"w{v}" for v in rng.integers(0, 300, n)]

    rows = [(d, " ".join(plain(120) + (["awful"] if d % 4 == 0 or d % 40 == 1 else []) + plain(120)), int(d % 4 == 0))
            for d in range(400)]
    spread = " ".join(w for _ in range(40) for w in [*plain(60), "awful"])
    rows += [(1000, spread, None), (1001, " ".join([*plain(1200), "awful", *plain(1240)]), None), (1002, " ".join(plain(2440)), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    tokens = toxicity.token_scores(df)
    measured = toxicity.measure(df, tokens)
    assert {r.doc_id: len(r.segments) for r in measured.where("doc_id >= 1000").collect()} == {1000: 40, 1001: 1, 1002: 0}
    model = toxicity.calibrate(measured, df.select("doc_id", "toxic"), tokens)
    got = {r.doc_id: r for r in toxicity.score(measured, model).where("doc_id >= 1000").collect()}
    assert got[1000].predicted == 1 and got[1000].score > got[1001].score + 0.1 and got[1001].score >= got[1002].score


def test_segments_take_linear_time():
    falling = np.where(np.arange(600_000) % 3 == 0, 1.0, -1.0)
    assert len(toxicity.all_segments(falling, 1e-9)) == 200_000


def test_toxicity_edges(edges, edge_rows, nothing):
    tokens = toxicity.token_scores(nothing.selectExpr("text", "cast(null AS int) AS toxic"))
    measured = toxicity.measure(edges, tokens)
    model = toxicity.calibrate(measured, nothing.selectExpr("doc_id", "cast(null AS int) AS toxic"), tokens)
    got = toxicity.score(measured, model).collect()
    assert len(got) == len(edge_rows) and all(r.predicted == 0 and 0 <= r.score <= 1 for r in got)
    assert toxicity.score(toxicity.measure(nothing, tokens), model).count() == 0


def test_stretches_meet_as_every_span_does():
    rng = np.random.default_rng(5)
    for _ in range(300):
        spans = [(int(a), 0, int(a) + int(n)) for a, n in zip(rng.integers(0, 60, 8), rng.integers(1, 9, 8))]
        taken = pii.Stretches(spans)
        for a in range(0, 70, 3):
            for b in range(a + 1, a + 12, 4):
                assert taken.meet(a, b) == any(a < e and s < b for s, _, e in spans)
    assert not pii.Stretches().meet(0, 9)


def test_many_entities_in_one_text_take_linear_time():
    """Look-ups of taken stretches, not comparisons with every span: sixteen times the text, far less than 256 times the work."""
    import time

    class Ones(dict):
        def get(self, feature, default=None):
            return 1.0

    weights = Ones(any=1.0)

    def seconds(n):
        text = " ".join(f"user{k}@site{k}.example.com, 10.0.{k % 256}.{k % 200}" for k in range(n))
        start = time.process_time()
        exact, every = pii.all_spans(text, weights)
        assert len(exact) == 2 * n and set(exact) <= set(every)
        return time.process_time() - start

    seconds(100)
    assert seconds(3200) < 60 * max(seconds(200), 0.002)
