"""Language identification: known words first, character n-grams for the rest."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.llm.text import binaries, bounded_batches, clear_of, coded_words, hashes, slices, texts_of, tidied, width
from assayloom.session import materialise

#: Text bytes of one chunk, and text bytes that one block of the words' hash range stands for.
_CHUNK_BYTES, _BLOCK_BYTES = 8 << 20, 8 << 20


def _packed(data: bytes) -> bytes:
    return np.int64(len(data)).tobytes() + pa.compress(data, "zstd", asbytes=True) if data else b""


def _unpacked(data: bytes) -> bytes:
    return pa.decompress(data[8:], int(np.frombuffer(data[:8], np.int64)[0]), "zstd", asbytes=True) if data else b""


def _packed_numbers(values: np.ndarray, form: str) -> bytes:
    """Numbers with their first bytes together, then their second and so on, which compresses better."""
    values = np.ascontiguousarray(values, form).ravel()
    return _packed(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def _numbers(data: bytes, form: str) -> np.ndarray:
    planes = np.frombuffer(_unpacked(data), np.uint8).reshape(np.dtype(form).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(form)


def _packed_words(words: pa.Array) -> bytes:
    """Words (or n-grams), none of which holds a space."""
    return _packed(" ".join(words.to_pylist()).encode())


def _words(data: bytes) -> pa.Array:
    return pc.split_pattern(pa.array([_unpacked(data).decode()]), " ").flatten() if data else pa.array([], pa.string())


def _by_block(words: pa.Array, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(block, places) of the words in each block of the hash range that has some, in ascending order."""
    block = (hashes(words) >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    some, starts = np.unique(block[order], return_index=True)
    yield from zip(some.tolist(), np.split(order, starts[1:]))


def _bits(size: int, df: DataFrame) -> int:
    """Bits of the hash range that give blocks of a steady size, and every shuffle partition one."""
    return min(31, max(1, math.ceil(math.log2(max(1, size / _BLOCK_BYTES))), math.ceil(math.log2(width(df)))))


class Stored:
    """Scores by key in blocks of the keys' hash range, a packed row each; ``rows`` gives an entry a row."""

    def __init__(self, blocks: DataFrame, langs: int):
        self.blocks, self.langs = blocks, langs

    @property
    def rows(self) -> DataFrame:
        langs = self.langs

        def unpack(batches):
            for batch in batches:
                for keys, scores in zip(batch["keys"].to_pylist(), batch["scores"].to_pylist()):
                    matrix = _numbers(scores, "<f4").reshape(-1, langs)
                    yield pa.RecordBatch.from_arrays(
                        [_words(keys), pa.array(list(matrix), pa.list_(pa.float32()))], ["key", "scores"])

        return self.blocks.select("keys", "scores").mapInArrow(unpack, "key string, scores array<float>")

    def __len__(self) -> int:
        return self.blocks.agg(F.sum("length")).first()[0] or 0


@dataclass(frozen=True)
class LanguageModel:
    """Log frequencies per language, in the order of ``langs``, of words (``known``) and n-grams (``grams``).

    Both hold every key counted, each under its own text, in 2 ** ``bits`` blocks
    of the hash range; n-grams of each of the ``orders`` lie in blocks of their own.
    """

    langs: list[str]
    known: Stored | tuple
    grams: Stored | tuple
    orders: tuple[int, ...] = ()
    bits: int = 1


def _bare(texts: pa.Array) -> pa.Array:
    """Lower case, with all but letters as spaces."""
    return pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}\p{M}]+", " ")


def _grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


class _Letters:
    """The characters of words in a row, each word between < and >."""

    def __init__(self, words: pa.Array):
        self.chars = np.frombuffer("".join(f"<{w}>" for w in words.to_pylist()).encode("utf-32-le"), "<u4")
        lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 2
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.word = np.repeat(np.arange(len(lengths)), lengths)

    def grams(self, orders: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array]]:
        """(n, places, codes, distinct n-grams) for each order: the n-gram at places[i] is distinct[codes[i]]."""
        letter = np.unique(self.chars, return_inverse=True)[1].astype(np.int64)
        letters = int(letter.max()) + 1 if len(letter) else 0
        at, codes = np.arange(len(letter)), np.zeros(len(letter), np.int64)
        for n in range(1, max(orders, default=0) + 1):
            fits = at + n <= self.ends[self.word[at]]
            at = at[fits]
            _, first, codes = np.unique(codes[fits] * letters + letter[at + n - 1], return_index=True, return_inverse=True)
            if n in orders:
                chars = np.ascontiguousarray(self.chars[at[first][:, None] + np.arange(n)])
                yield n, at, codes, pa.array(chars.view(f"<U{n}").ravel().tolist(), pa.string())


_COUNTS = "keys binary, at binary, n binary"


def _added(table: pa.Table, langs: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct keys, places, counts) of packed counts by key and language; place = key's place * langs + language."""
    parts = [_words(k) for k in table["keys"].to_pylist()]
    coded = pa.concat_arrays(parts).dictionary_encode()
    place, offset, found = coded.indices.to_numpy().astype(np.int64), 0, []
    for part, at in zip(parts, table["at"].to_pylist()):
        at = _numbers(at, "<u8").astype(np.int64)
        found.append(place[offset + at // langs] * langs + at % langs)
        offset += len(part)
    at, back = np.unique(np.concatenate(found), return_inverse=True)
    n = np.concatenate([_numbers(n, "<u8") for n in table["n"].to_pylist()])
    total = np.zeros(len(at), np.int64)
    np.add.at(total, back, n.astype(np.int64))
    return coded.dictionary, at, total


def _count_words(docs: DataFrame, text: str, lang: str, langs: list[str], bits: int) -> DataFrame:
    """block, size (0), keys, at, n, totals: counts of every word by language, added up in blocks of the hash range."""
    width = len(langs)

    def send(batches):
        for batch in batches:
            for part in slices(batch, "text", _CHUNK_BYTES):
                offsets, codes, distinct = coded_words(_bare(texts_of(part, "text")))
                of_doc = pc.index_in(part["lang"], value_set=pa.array(langs, pa.string())).to_numpy()
                of_word = np.repeat(of_doc, np.diff(offsets)).astype(np.int64)
                pairs, n = np.unique(codes.astype(np.int64) * width + of_word, return_counts=True)
                rows = []
                starts = np.searchsorted(pairs, np.arange(len(distinct) + 1) * width)
                for block, places in _by_block(distinct, bits):
                    sizes = starts[places + 1] - starts[places]
                    take = np.repeat(starts[places] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                    at = np.repeat(np.arange(len(places)), sizes) * width + pairs[take] % width
                    rows.append((0, block, _packed_words(distinct.take(pa.array(places))),
                                 _packed_numbers(at, "<u8"), _packed_numbers(n[take], "<u8")))
                yield _count_rows(rows)

    raw = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    return _totals(raw.where("lang IS NOT NULL").mapInArrow(tidied(send), f"size int, block long, {_COUNTS}"), width)


def _count_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[2:]]],
        ["size", "block", "keys", "at", "n"])


def _totals(sent: DataFrame, langs: int) -> DataFrame:
    """Counts of each block added up, with their totals by language."""
    def add(table):
        keys, at, n = _added(table, langs)
        totals = np.zeros(langs, np.int64)
        np.add.at(totals, at % langs, n)
        return pa.table([table["size"][:1], table["block"][:1], binaries([_packed_words(keys)]),
                         binaries([_packed_numbers(at, "<u8")]), binaries([_packed_numbers(n, "<u8")]),
                         pa.array([totals.tolist()], pa.list_(pa.int64()))], ["size", "block", "keys", "at", "n", "totals"])

    return sent.groupBy("size", "block").applyInArrow(add, f"size int, block long, {_COUNTS}, totals array<long>")


def _dense(row: dict, langs: int) -> tuple[pa.Array, np.ndarray]:
    """(keys, counts by language) of a packed row."""
    keys = _words(row["keys"])
    counts = np.zeros(len(keys) * langs, np.int64)
    counts[_numbers(row["at"], "<u8").astype(np.int64)] = _numbers(row["n"], "<u8")
    return keys, counts.reshape(-1, langs)


def _count_grams(words: DataFrame, orders: tuple[int, ...], langs: int, bits: int) -> DataFrame:
    """size, block, keys, at, n, totals: counts of every n-gram of every word's occurrences."""
    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = _dense(row, langs)
                letters, rows = _Letters(keys), []
                for n, at, codes, distinct in letters.grams(orders):
                    word = letters.word[at]
                    total = np.stack([np.bincount(codes, counts[word, k], len(distinct)) for k in range(langs)], axis=1)
                    for block, places in _by_block(distinct, bits):
                        own = total[places].ravel()
                        some = np.nonzero(own)[0]
                        rows.append((n, block, _packed_words(distinct.take(pa.array(places))),
                                     _packed_numbers(some, "<u8"), _packed_numbers(own[some], "<u8")))
                yield _count_rows(rows)

    return _totals(words.select("keys", "at", "n").mapInArrow(tidied(send), f"size int, block long, {_COUNTS}"), langs)


def _rated(counted: DataFrame, used: list[int], totals: dict[int, list[int]], langs: int, prior: float,
           least: int = 1, last: tuple[int, str] | None = None) -> DataFrame:
    """size, block, length, keys, scores: log frequency per language.

    ``prior`` occurrences are spread as over all languages together. ``used`` are
    the places of the languages; keys have ``least`` occurrences or more, and come
    no later than ``last`` by falling count, then key.
    """
    def rate(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = _dense(row, langs)
                counts, size = counts[:, used], np.array([totals[row["size"]][k] for k in used], float)
                total = counts.sum(axis=1)
                keep = total >= least
                if last is not None:
                    keep &= (total > last[0]) | ((total == last[0]) & np.array([k <= last[1] for k in keys.to_pylist()], bool))
                shared = prior * total[keep, None] / size.sum()
                scores = np.log((counts[keep] + shared + 1e-12) / (size + prior))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["size"]], pa.int32()), pa.array([row["block"]], pa.int64()), pa.array([int(keep.sum())], pa.int64()),
                     binaries([_packed_words(keys.filter(pa.array(keep)))]), binaries([_packed_numbers(scores, "<f4")])],
                    ["size", "block", "length", "keys", "scores"])

    return counted.select("size", "block", "keys", "at", "n").mapInArrow(
        tidied(rate), "size int, block long, length long, keys binary, scores binary")


def _last_of(counted: DataFrame, langs: int, most: int) -> tuple[int, str] | None:
    """(count, key) of the ``most``-th key by falling count, then key; None if there are no more."""
    def count(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = _dense(row, langs)
                yield pa.RecordBatch.from_arrays([keys, pa.array(counts.sum(axis=1))], ["key", "n"])

    first = counted.select("keys", "at", "n").mapInArrow(count, "key string, n long").orderBy(F.desc("n"), "key").limit(most)
    row = first.orderBy("n", F.desc("key")).first()
    return (int(row["n"]), row["key"]) if row else None


def fit(train: DataFrame, text: str = "text", lang: str = "lang", max_words: int | None = None, min_count: int = 1,
        orders: tuple[int, ...] = (4, 3, 2, 1), prior: float = 1.0) -> LanguageModel:
    """Count words and n-grams over every row of ``train`` whose language is not null; a null text has no words.

    Every word is known and every n-gram seen, unless ``min_count`` or ``max_words``
    (the most frequent) ask for fewer words. N-grams are counted over all words.
    Counts move as one packed row for each chunk and block of the hash range.
    """
    bounded_batches(train.sparkSession)
    sizes = train.where(F.col(f"`{lang}`").isNotNull()).groupBy(F.col(f"`{lang}`").cast("string").alias("lang")).agg(
        F.sum(F.octet_length(F.col(f"`{text}`"))).alias("n")).collect()
    told = sorted(r["lang"] for r in sizes if r["n"])
    if not told:
        return LanguageModel([], (), ())
    bits, count = _bits(sum(r["n"] or 0 for r in sizes), train), len(told)
    learned = train.where(F.col(f"`{lang}`").cast("string").isin(told))

    def added(counted: DataFrame) -> dict[int, list[int]]:
        rows = counted.groupBy("size").agg(*[F.sum(F.get("totals", F.lit(k))).alias(f"n{k}") for k in range(count)]).collect()
        return {r["size"]: [int(r[f"n{k}"]) for k in range(count)] for r in rows}

    words = materialise(_count_words(learned, text, lang, told, bits), "words")
    by_word = added(words)
    used = [k for k in range(count) if by_word and by_word[0][k]]
    if not used:
        return LanguageModel([], (), ())
    grams = materialise(_count_grams(words, orders, count, bits), "grams")
    last = _last_of(words, count, max_words) if max_words is not None else None
    return LanguageModel(
        [told[k] for k in used], Stored(_rated(words, used, by_word, count, prior, min_count, last), len(used)),
        Stored(_rated(grams, used, added(grams), count, prior), len(used)), tuple(orders), bits)


def _finer(blocks: DataFrame, langs: int, coarse: int, bits: int) -> DataFrame:
    """Packed scores in blocks of ``bits`` bits."""
    if bits == coarse:
        return blocks.select("size", "block", "keys", "scores")

    def cut(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys, scores = _words(row["keys"]), _numbers(row["scores"], "<f4").reshape(-1, langs)
                for block, places in _by_block(keys, bits):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["size"]], pa.int32()), pa.array([block], pa.int64()),
                         binaries([_packed_words(keys.take(pa.array(places)))]), binaries([_packed_numbers(scores[places], "<f4")])],
                        ["size", "block", "keys", "scores"])

    return blocks.select("size", "block", "keys", "scores").mapInArrow(
        tidied(cut), "size int, block long, keys binary, scores binary")


def _table(parts: pa.Table, langs: int) -> tuple[pa.Array, np.ndarray]:
    """(keys, scores) of packed rows together."""
    keys = [_words(k) for k in parts["keys"].to_pylist()]
    scores = [_numbers(s, "<f4").reshape(-1, langs) for s in parts["scores"].to_pylist()]
    return (pa.concat_arrays(keys) if keys else pa.array([], pa.string()),
            np.concatenate(scores) if scores else np.zeros((0, langs), "f4"))


def _places(keys: pa.Array, of: pa.Array) -> np.ndarray:
    """Place of each key among ``of``, -1 where it is none of them."""
    return pc.fill_null(pc.index_in(keys, value_set=of), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _rows(names: list[str], types: list[pa.DataType], rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names)


def _backed_off(keys: pa.Array, grams: pa.Array, scores: np.ndarray, orders: tuple[int, ...]) -> tuple[pa.Array, np.ndarray]:
    """(words, scores) of those words that hold a seen n-gram: the mean of their n-grams' scores.

    From left to right, each place is scored by the longest n-gram seen there, and
    the walk goes on so that the next one overlaps it in one character.
    """
    letters = _Letters(keys)
    row, size = np.full(len(letters.chars), -1), np.zeros(len(letters.chars), np.int64)
    for n, at, codes, distinct in letters.grams(orders):
        found = _places(distinct, grams)[codes]
        seen = found >= 0
        row[at[seen]], size[at[seen]] = found[seen], n
    total, used = np.zeros((len(keys), scores.shape[1])), np.zeros(len(keys), np.int64)
    word, at = np.arange(len(keys)), letters.starts.copy()
    while len(word):
        hit = row[at] >= 0
        total[word[hit]] += scores[row[at[hit]]]
        used[word[hit]] += 1
        at = at + np.maximum(size[at] - 1, 1)
        more = at < letters.ends[word]
        word, at = word[more], at[more]
    some = used > 0
    return keys.filter(pa.array(some)), total[some] / used[some, None]


def _word_scores(asked: DataFrame, model: LanguageModel, bits: int) -> DataFrame:
    """block, keys, scores of the words in ``asked`` (chunk, block, keys): a known word's own, else those of its n-grams."""
    langs, orders = len(model.langs), model.orders
    known = _finer(model.known.blocks, langs, model.bits, bits).drop("size")

    def unseen(left, right):
        parts = [_words(k) for k in left["keys"].to_pylist()]
        words = pa.concat_arrays(parts).unique() if parts else pa.array([], pa.string())
        of = _table(right, langs)[0]
        words = words.filter(pa.array(_places(words, of) < 0))
        return _rows(["block", "keys"], [pa.int64(), pa.binary()],
                     [(left["block"][0].as_py(), _packed_words(words))] if len(words) else [])

    unknown = materialise(asked.select("block", "keys").groupBy("block").cogroup(known.groupBy("block"))
                          .applyInArrow(unseen, "block long, keys binary"), "unknown")

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                rows = [(n, block, row["block"], _packed_words(distinct.take(pa.array(places))))
                        for n, _, _, distinct in _Letters(_words(row["keys"])).grams(orders)
                        for block, places in _by_block(distinct, bits)]
                yield from _rows(["size", "block", "asker", "keys"], [pa.int32(), pa.int64(), pa.int64(), pa.binary()],
                                 rows).to_batches()

    def answer(left, right):
        of, scores = _table(right, langs)
        rows = []
        for asker, keys in zip(left["asker"].to_pylist(), left["keys"].to_pylist()):
            keys = _words(keys)
            place = _places(keys, of)
            seen = place >= 0
            if seen.any():
                rows.append((asker, _packed_words(keys.filter(pa.array(seen))), _packed_numbers(scores[place[seen]], "<f4")))
        return _rows(["asker", "keys", "scores"], [pa.int64(), pa.binary(), pa.binary()], rows)

    told = (unknown.mapInArrow(tidied(ask), "size int, block long, asker long, keys binary").groupBy("size", "block")
            .cogroup(_finer(model.grams.blocks, langs, model.bits, bits).groupBy("size", "block"))
            .applyInArrow(answer, "asker long, keys binary, scores binary"))

    def back_off(left, right):
        if not left.num_rows:
            return _rows(["block", "keys", "scores"], [pa.int64(), pa.binary(), pa.binary()], [])
        keys, scores = _backed_off(_words(left["keys"][0].as_py()), *_table(right, langs), orders)
        return _rows(["block", "keys", "scores"], [pa.int64(), pa.binary(), pa.binary()],
                     [(left["block"][0].as_py(), _packed_words(keys), _packed_numbers(scores, "<f4"))])

    return known.unionByName(unknown.groupBy("block").cogroup(told.groupBy("asker"))
                             .applyInArrow(back_off, "block long, keys binary, scores binary"))


def identify(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text",
             keep: tuple[str, ...] = (), results: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """doc_id, the columns ``keep``, lang_pred and score of every row (named by ``results``).

    A document's score per language is the mean over its words of the known
    word's log frequency or of the n-gram backoff, both relative to the best
    language; the answer is the softmax of the sums, ``score`` its share. A text
    that is null or has no letter, or a model of no language, gives ``und`` with
    score 0. Ties go to the first language by name.

    Texts are coded once, as counts of each chunk's distinct words, in a table
    bucketed by chunk that goes when the answer is stored. Every block of the
    words' hash range gets one packed row from each chunk and answers with one, so
    what moves is a chunk's distinct words and their scores. Answers meet rows by
    the text's digest.
    """
    own = list(dict.fromkeys((doc_id, *keep)))
    source = clear_of(docs, *dict.fromkeys((doc_id, text, *keep)))
    if not model.langs:
        return source.select(*[F.col(f"`{c}`") for c in own], F.lit("und").alias(results[0]), F.lit(0.0).alias(results[1]))
    digest = F.unhex(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")))
    size = source.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    name = f"language_chunks_{uuid.uuid4().hex}"
    try:
        told = _told(source.select(digest.alias("mark"), F.col(f"`{text}`").alias("text")), model, name,
                     max(model.bits, _bits(size, docs)))
    finally:
        docs.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    rows = source.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), digest.alias("mark"))
    return rows.join(told.hint("merge"), "mark").select(
        *[F.col("row").getField(c).alias(c) for c in own],
        F.col("told.pred").alias(results[0]), F.col("told.share").alias(results[1]))


def _told(texts: DataFrame, model: LanguageModel, name: str, bits: int) -> DataFrame:
    """mark, told (share, pred) of every text, by way of the bucketed table ``name``."""
    names, langs = np.array([*model.langs, "und"], dtype=object), len(model.langs)

    def code(batches):
        for batch in batches:
            for part in slices(batch, "text", _CHUNK_BYTES):
                lettered = pc.match_substring_regex(texts_of(part, "text"), r"\p{L}")
                offsets, codes, distinct = coded_words(_bare(texts_of(part, "text")))
                parts = list(_by_block(distinct, bits))
                place = np.empty(len(distinct), np.int64)
                if parts:
                    place[np.concatenate([p for _, p in parts])] = np.arange(len(distinct))
                of_doc = np.repeat(np.arange(part.num_rows), np.diff(offsets))
                at, n = np.unique(of_doc * len(distinct) + place[codes], return_counts=True)
                ends, many = pa.array([0, part.num_rows], pa.int32()), pa.array([0, len(parts)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(ends, part["mark"]), pa.ListArray.from_arrays(ends, lettered),
                     pa.array([len(distinct)], pa.int64()), binaries([_packed_numbers(np.diff(at, prepend=0), "<u8")]),
                     binaries([_packed_numbers(n, "<u4")]),
                     pa.ListArray.from_arrays(many, pa.StructArray.from_arrays(
                         [pa.array([b for b, _ in parts], pa.int64()),
                          binaries([_packed_words(distinct.take(pa.array(p))) for _, p in parts])], ["block", "keys"]))],
                    ["marks", "lettered", "words", "at", "n", "asked"])

    (texts.mapInArrow(tidied(code), "marks array<binary>, lettered array<boolean>, words long, at binary, n binary, "
                                    "asked array<struct<block: long, keys: binary>>")
     .withColumn("chunk", F.monotonically_increasing_id())
     .write.format("parquet").bucketBy(width(texts), "chunk").saveAsTable(name))
    chunks = texts.sparkSession.table(name)
    asked = chunks.select("chunk", F.inline("asked"))
    scored = _word_scores(asked, model, bits)

    def answer(left, right):
        of, scores = _table(right, langs)
        scores = scores - scores.max(axis=1, keepdims=True) if len(scores) else scores
        scores = np.concatenate([scores, np.zeros((1, langs), "f4")])
        block = left["block"][0].as_py() if left.num_rows else None
        return _rows(["chunk", "block", "scores"], [pa.int64(), pa.int64(), pa.binary()],
                     [(chunk, block, _packed_numbers(scores[_places(_words(keys), of)], "<f4"))
                      for chunk, keys in zip(left["chunk"].to_pylist(), left["keys"].to_pylist())])

    answers = (asked.groupBy("block").cogroup(scored.groupBy("block"))
               .applyInArrow(answer, "chunk long, block long, scores binary"))

    def rate(left, right):
        row = left.to_pylist()[0]
        docs, words = len(row["marks"]), row["words"]
        scores = np.concatenate([np.zeros((0, langs), "f4")] + [
            _numbers(s, "<f4").reshape(-1, langs) for s in right.sort_by("block")["scores"].to_pylist()]).astype(float)
        at, n = np.cumsum(_numbers(row["at"], "<u8").astype(np.int64)), _numbers(row["n"], "<u4").astype(float)
        of_doc, word = at // max(1, words), at % max(1, words)
        total = np.stack([np.bincount(of_doc, n * scores[word, k], docs) for k in range(langs)], axis=1)
        share = np.exp(total - total.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        none = ~np.array(row["lettered"], bool)
        return pa.table([pa.array(row["marks"], pa.binary()), pa.array(names[np.where(none, langs, best)], pa.string()),
                         pa.array(np.where(none, 0.0, share[np.arange(docs), best]))], ["mark", "pred", "share"])

    return materialise(chunks.drop("asked").groupBy("chunk").cogroup(answers.groupBy("chunk"))
                       .applyInArrow(rate, "mark binary, pred string, share double")
                       .groupBy("mark").agg(F.max(F.struct("share", "pred")).alias("told")), "languages")
