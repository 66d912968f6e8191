"""Language-model scoring by deleted interpolation of bigrams, words and unknown words."""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.llm.text import binaries, coded_words, hashes, mix, slices, texts_of, width
from assayloom.session import materialise

#: N-grams of one block, and text bytes of one chunk.
_BLOCK_GRAMS, _CHUNK_BYTES = 2 << 20, 8 << 20
#: Keys of the end of a text and of its start as a context; words never hold a space.
_END, _START = hashes(pa.array([" end", " start"]))
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Added to every word's count, fixed.
_ADDED = 0.1
#: Width and reach of the histogram bins of log(bigram estimate / word estimate).
_BIN, _REACH = 0.05, 30.0


@dataclass(frozen=True)
class Mixture:
    """Totals of the training tokens and the bigram weight of each bucket of context counts."""

    tokens: int
    distinct: int
    weights: np.ndarray


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), "zstd", asbytes=True) if len(values) else b""


def _unpacked(data: bytes, kind: str, count: int) -> np.ndarray:
    size = count * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data, size, "zstd", asbytes=True) if size else b"", kind)


def _chunks(docs: DataFrame) -> DataFrame:
    """The corpus as chunks of coded tokens: ids, fold and length of each document, codes, hashes of the words."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def code(batches):
        for batch in batches:
            for part in slices(batch, "text", _CHUNK_BYTES):
                offsets, codes, distinct = coded_words(pc.ascii_lower(texts_of(part, "text")))
                ends = pa.array([0, part.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(ends, part["doc_id"]), pa.ListArray.from_arrays(ends, part["held_out"]),
                     pa.ListArray.from_arrays(ends, pa.array(np.diff(offsets))),
                     binaries([_packed(codes.astype("<u4"))]), binaries([hashes(distinct).tobytes()])],
                    ["docs", "held", "sizes", "codes", "words"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(
        code, f"docs array<{kind}>, held array<boolean>, sizes array<long>, codes binary, words binary"
    ).withColumn("chunk", F.monotonically_increasing_id())


class _Chunk:
    """A chunk's tokens, and its distinct words and bigrams in the order of their keys."""

    def __init__(self, sizes, held, codes: bytes, words: bytes, bits: int):
        sizes = np.asarray(sizes, np.int64)
        stream = _unpacked(codes, "<u4", int(sizes.sum())).astype(np.int64)
        keys = np.append(np.frombuffer(words, "<u8"), [_END, _START])
        end, start = len(keys) - 2, len(keys) - 1
        self.lengths = sizes + 1
        last = np.cumsum(self.lengths) - 1
        tokens = np.empty(int(self.lengths.sum()), np.int64)
        inner = np.ones(len(tokens), bool)
        inner[last] = False
        tokens[inner], tokens[last] = stream, end
        before = np.concatenate(([start], tokens[:-1]))
        before[last + 1 - self.lengths] = start
        self.train = np.repeat(~np.asarray(held, bool), self.lengths)
        # A start is counted as often as an end: one context a text.
        own = np.argsort(keys[:-1])
        place = np.empty(len(keys), np.int64)
        place[own] = np.arange(len(own))
        place[start] = place[end]
        self.word_keys, self.words, self.contexts = keys[:-1][own], place[tokens], place[before]
        pair = mix(keys[before] * _ODD + keys[tokens]) >> np.uint64(32 - bits)
        self.pair_keys, self.pairs = np.unique(pair, return_inverse=True)
        self.bits = bits

    def counts(self, which: np.ndarray, size: int) -> np.ndarray:
        """Occurrences in training texts."""
        return np.bincount(which[self.train], minlength=size).astype("<u4")


def _counted(chunks: DataFrame, bits: int) -> DataFrame:
    """chunk, size, block, totals: corpus counts of every chunk's distinct words (size 1) and bigrams (size 2).

    Each block of the key range gets from every chunk its distinct keys as one
    array, adds them up, and answers every chunk in the same order; a frequent
    n-gram is one entry a chunk. Rows with a null chunk hold each word block's
    numbers of distinct training words and of training tokens.
    """
    def send(batches):
        for batch in batches:
            for row in batch.select(["chunk", "sizes", "held", "codes", "words"]).to_pylist():
                c = _Chunk(row["sizes"], row["held"], row["codes"], row["words"], bits)
                for size, keys, which, high in ((1, c.word_keys, c.words, 64), (2, c.pair_keys, c.pairs, 32 + bits)):
                    counts = c.counts(which, len(keys))
                    at = np.searchsorted(keys >> np.uint64(high - bits), np.arange((1 << bits) + 1).astype(np.uint64))
                    some = np.nonzero(np.diff(at))[0]
                    form = "<u8" if size == 1 else "<u4"
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([size] * len(some), pa.int32()), pa.array(some, pa.int64()),
                         pa.array([row["chunk"]] * len(some), pa.int64()),
                         binaries([keys[at[b]:at[b + 1]].astype(form).tobytes() for b in some]),
                         binaries([_packed(counts[at[b]:at[b + 1]]) for b in some])],
                        ["size", "block", "chunk", "keys", "counts"])

    def add(table):
        size = table["size"][0].as_py()
        form = "<u8" if size == 1 else "<u4"
        keys = [np.frombuffer(k, form) for k in table["keys"].to_pylist()]
        counts = [_unpacked(c, "<u4", len(k)) for c, k in zip(table["counts"].to_pylist(), keys)]
        lengths = [len(k) for k in keys]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.int64)
        ends = np.cumsum(lengths)
        answers = [_packed(totals[place[e - n:e]].astype("<u8")) for e, n in zip(ends, lengths)]
        chunk, n = table["chunk"].to_pylist(), len(keys)
        extra = int(size == 1)
        return pa.table(
            [pa.array(chunk + [None] * extra, pa.int64()), pa.array([size] * (n + extra), pa.int32()),
             pa.array([table["block"][0].as_py()] * (n + extra), pa.int64()), pa.array(lengths + [0] * extra, pa.int64()),
             binaries(answers + [b""] * extra),
             pa.array([0] * n + [int((totals > 0).sum())] * extra, pa.int64()),
             pa.array([0] * n + [int(totals.sum())] * extra, pa.int64())],
            ["chunk", "size", "block", "length", "totals", "distinct", "tokens"])

    return (chunks.mapInArrow(send, "size int, block long, chunk long, keys binary, counts binary")
            .groupBy("size", "block").applyInArrow(
                add, "chunk long, size int, block long, length long, totals binary, distinct long, tokens long"))


def _looked_up(left: pa.Table, right: pa.Table, bits: int):
    """(chunk row, chunk, word count, context count, bigram count of each token)."""
    row = left.to_pylist()[0]
    c = _Chunk(row["sizes"], row["held"], row["codes"], row["words"], bits)
    found = {}
    right = right.sort_by([("size", "ascending"), ("block", "ascending")])
    for size in (1, 2):
        own = right.filter(pc.equal(right["size"], size))
        found[size] = np.concatenate([np.zeros(0, "<u8")] + [
            _unpacked(t, "<u8", n) for t, n in zip(own["totals"].to_pylist(), own["length"].to_pylist())]).astype(float)
    return row, c, found[1][c.words], found[1][c.contexts], found[2][c.pairs]


def _bucket(context: np.ndarray) -> np.ndarray:
    """Bucket of a context's count: 0 for none, else one more than its whole log2, 40 at most."""
    return np.where(context > 0, np.minimum(np.floor(np.log2(np.maximum(context, 1))) + 1, 40), 0).astype(np.int64)


def _word_rate(count, tokens: int, distinct: int):
    return (count + _ADDED) / (tokens + _ADDED * (distinct + 1))


def _weights(chunks: DataFrame, counted: DataFrame, bits: int, tokens: int, distinct: int, rounds: int = 200) -> np.ndarray:
    """Bigram weight of each bucket, by expectation-maximisation on deleted counts.

    Every training token is held out of the counts in turn, which takes 1 from its
    word, context and bigram. What its two estimates say of the weight is their
    ratio, so all tokens are added up in fine bins of its logarithm.
    """
    bins = int(2 * _REACH / _BIN) + 2

    def measure(left, right):
        if not left.num_rows:
            return pa.table([pa.array([], pa.int32()), pa.array([], pa.int32()), pa.array([], pa.int64())],
                            ["bucket", "bin", "n"])
        _, c, word, context, pair = _looked_up(left, right, bits)
        word, context, pair = word[c.train] - 1, context[c.train] - 1, pair[c.train] - 1
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.log(pair / context / _word_rate(word, tokens - 1, distinct))
        # The last bin is that of bigrams seen nowhere else.
        place = np.where((pair > 0) & (context > 0),
                         np.rint((np.clip(np.nan_to_num(ratio), -_REACH, _REACH) + _REACH) / _BIN), bins - 1)
        both = np.bincount(_bucket(context) * bins + place.astype(np.int64))
        at = np.nonzero(both)[0]
        return pa.table([pa.array((at // bins).astype(np.int32)), pa.array((at % bins).astype(np.int32)),
                         pa.array(both[at])], ["bucket", "bin", "n"])

    rows = (chunks.groupBy("chunk").cogroup(counted.groupBy("chunk"))
            .applyInArrow(measure, "bucket int, bin int, n long").groupBy("bucket", "bin").agg(F.sum("n").alias("n")).toPandas())
    table = np.zeros((41, bins))
    table[rows["bucket"], rows["bin"]] = rows["n"]
    ratio = np.exp(np.arange(bins) * _BIN - _REACH)
    ratio[-1] = 0.0
    weights = np.full(41, 0.5)
    weights[0] = 0.0
    seen = table.sum(axis=1)
    for _ in range(rounds):
        part = weights[:, None] * ratio / np.maximum(weights[:, None] * ratio + 1 - weights[:, None], 1e-300)
        weights = np.where(seen > 0, (table * part).sum(axis=1) / np.maximum(seen, 1), 0.0)
    weights[0] = 0.0
    return np.minimum(weights, 1 - 1e-6)


def score(docs: DataFrame, held_out: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Tokens are the text's words, A to Z in lower case, then one end; null counts as
    empty. Rows with ``held_out`` true are scored but not learned from. base_score
    adds up log10 of the words' smoothed rates; score mixes them with the bigrams'
    maximum-likelihood rates by weights per bucket of the context's count.

    Nothing is broadcast but the weights: counts live in blocks of the key range,
    and each chunk of documents gets back those of its own n-grams. Words have
    64-bit keys, bigrams 32 bits within their block, of which there are as many as
    the corpus needs to keep their size. The coded corpus is stored once, bucketed by
    chunk, so that only counts move when chunks are looked up; it goes when the
    answer is stored.
    """
    spark, name = docs.sparkSession, f"lm_chunks_{uuid.uuid4().hex}"
    try:
        return _scored(docs, name, held_out, doc_id, text)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _scored(docs: DataFrame, name: str, held_out: str, doc_id: str, text: str) -> DataFrame:
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{held_out}`"), F.lit(False)).alias("held_out"),
                         F.col(f"`{text}`").alias("text"))
    _chunks(source).write.format("parquet").bucketBy(width(docs), "chunk").saveAsTable(name)
    chunks = docs.sparkSession.table(name)
    grams = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    bits = min(31, max(6, math.ceil(math.log2(max(1, grams / _BLOCK_GRAMS))), math.ceil(math.log2(width(docs)))))
    counted = materialise(_counted(chunks, bits), "counted")
    totals = counted.where("chunk IS NULL").agg(F.sum("tokens"), F.sum("distinct")).first()
    tokens, distinct = int(totals[0] or 0), int(totals[1] or 0)
    counted = counted.where("chunk IS NOT NULL").select("chunk", "size", "block", "length", "totals")
    model = Mixture(tokens, distinct, _weights(chunks, counted, bits, tokens, distinct))
    kind = source.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def rate(left, right):
        row, c, word, context, pair = _looked_up(left, right, bits)
        base = _word_rate(word, model.tokens, model.distinct)
        weight = model.weights[_bucket(context)]
        mixed = weight * np.where(context > 0, pair / np.maximum(context, 1), 0) + (1 - weight) * base
        starts = np.cumsum(c.lengths) - c.lengths
        docs_ = left["docs"].combine_chunks().flatten()
        return pa.table(
            [docs_, pa.array(row["held"], pa.bool_()), pa.array(c.lengths), pa.array(np.add.reduceat((word > 0).astype(np.int64), starts)),
             pa.array(np.full(len(starts), model.tokens)), pa.array(np.add.reduceat(np.log10(base), starts)),
             pa.array(np.add.reduceat(np.log10(mixed), starts))], names)

    scores = chunks.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInArrow(
        rate, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return materialise(scores, "scores")
