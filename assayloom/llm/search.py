"""Ranked lexical search: accumulator-limited term-at-a-time over chunks of documents."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayloom.llm.text import SLICE_BYTES, binaries, clear_of, slices
from assayloom.session import materialise

#: Bytes of item texts that one pass over the documents answers.
_ITEM_BYTES = 4 << 20

#: What is left of every byte: ASCII letters in lower case, digits, all bytes of other characters; else a space.
_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(offsets, codes, distinct terms): text i has distinct[codes[offsets[i]:offsets[i + 1]]].

    Terms are runs of letters, digits and characters beyond ASCII, A to Z in lower
    case. A text's borders are borders of terms; null has none.
    """
    # A space behind every text, so that the whole buffer can be cut at once.
    one = [pa.scalar(v, pa.large_string()) for v in ("", " ")]
    closed = pc.binary_join_element_wise(pc.cast(pc.fill_null(texts, ""), pa.large_string()), *one)
    if not len(closed):
        return np.zeros(1, np.int64), np.zeros(0, np.int64), pa.array([], pa.large_string())
    ends = np.frombuffer(closed.buffers()[1], np.int64)[closed.offset:closed.offset + len(closed) + 1]
    data = bytes(memoryview(closed.buffers()[2])[ends[0]:ends[-1]]).translate(_TERM_BYTES)
    ends = ends[1:] - ends[0]
    raw = np.frombuffer(data, np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([False], raw, [False])).astype(np.int8)))
    begins, stops = edge[::2], edge[1::2]
    lengths = stops - begins
    offsets = np.concatenate(([0], np.searchsorted(begins, ends)))
    body = np.frombuffer(data, np.uint8)[raw].tobytes()
    bounds = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    flat = pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(bounds.tobytes()), pa.py_buffer(body))
    coded = flat.dictionary_encode()
    return offsets, coded.indices.to_numpy(), coded.dictionary


@dataclass(frozen=True)
class Items:
    """One block of items: ids, their distinct terms in order, and each item's places among them."""

    ids: pa.Array
    vocabulary: pa.Array
    places: list[np.ndarray]


def _postings(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """Chunks of documents as a small index of the vocabulary's terms.

    docs: ids; sizes: terms of each; terms: places in the vocabulary of those that
    occur; held: how many documents hold each; at, tf: documents and occurrences,
    term by term.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def index(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                offsets, codes, distinct = terms(part["text"])
                place = pc.fill_null(pc.index_in(distinct, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                place = place[codes]
                sizes = np.diff(offsets)
                doc = np.repeat(np.arange(part.num_rows), sizes)[place >= 0]
                both, tf = np.unique(place[place >= 0] * part.num_rows + doc, return_counts=True)
                found, held = np.unique(both // part.num_rows, return_counts=True)
                rows, some = pa.array([0, part.num_rows], pa.int32()), pa.array([0, len(found)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(rows, part["doc_id"]), pa.ListArray.from_arrays(rows, pa.array(sizes.astype(np.int64))),
                     pa.ListArray.from_arrays(some, pa.array(found)), pa.ListArray.from_arrays(some, pa.array(held.astype(np.int64))),
                     binaries([(both % part.num_rows).astype("<u4").tobytes()]), binaries([tf.astype("<u4").tobytes()])],
                    ["docs", "sizes", "terms", "held", "at", "tf"])

    return docs.mapInArrow(
        index, f"docs array<{kind}>, sizes array<long>, terms array<long>, held array<long>, at binary, tf binary")


def weights(held: np.ndarray, n: int) -> np.ndarray:
    """Weight of terms that ``held`` of ``n`` documents hold."""
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in held], np.int64)


def best_of_chunk(found: list[tuple[np.ndarray, np.ndarray]], k: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) that may be among the k best, scores whole.

    ``found`` has each term's documents and what it adds to each, in the order the
    terms are taken. Once the terms to come cannot lift a new document to the k-th
    partial score, no more accumulators are made; those there are go on to their
    whole scores. What can still be in the k best lies in the result, ties included.
    """
    score, open_ = np.zeros(size, np.int64), np.zeros(size, bool)
    rest = np.cumsum([int(gain.max()) for _, gain in found][::-1])[::-1] if found else []
    growing = True
    for (docs, gain), bound in zip(found, rest):
        if growing:
            live = score[open_]
            growing = len(live) < k or bound >= np.partition(live, len(live) - k)[len(live) - k]
        if growing:
            open_[docs] = True
            score[docs] += gain
        else:
            mine = open_[docs]
            score[docs[mine]] += gain[mine]
    docs = np.flatnonzero(open_ & (score > 0))
    if len(docs) > k:
        least = np.partition(score[docs], len(docs) - k)[len(docs) - k]
        docs = docs[score[docs] >= least]
    return docs, score[docs]


def _answers(chunks: DataFrame, items: Items, kind: str, weight: np.ndarray, n: int, total: int, k: int) -> DataFrame:
    """item (its place), item_id, doc_id, score: of every chunk what may be among an item's k best."""
    doc_kind = chunks.schema["docs"].dataType.elementType.simpleString()
    # Rarest first: the greatest weight, then the order of the vocabulary.
    order = [p[np.lexsort((p, -weight[p]))] for p in items.places]

    def ask(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1)
                ids = row["docs"].flatten()
                sizes = row["sizes"].flatten().to_numpy(zero_copy_only=False)
                length = 10 + (90 * sizes * n) // max(1, total)
                at = np.frombuffer(row["at"][0].as_py(), "<u4").astype(np.int64)
                tf = np.frombuffer(row["tf"][0].as_py(), "<u4").astype(np.int64)
                unit = (1_000_000_000 * tf) // (1000 * tf + 8 * length[at])
                places, ends = row["terms"].flatten().to_numpy(zero_copy_only=False), np.cumsum(row["held"].flatten().to_numpy(zero_copy_only=False))
                known = {p: (at[b - h:b], weight[p] * unit[b - h:b]) for p, b, h in zip(places, ends, np.diff(ends, prepend=0)) if weight[p]}
                out = [(np.full(len(docs), item), docs, score) for item, own in enumerate(order)
                       for docs, score in [best_of_chunk([known[p] for p in own if p in known], k, len(sizes))]]
                which, docs, score = (np.concatenate(c).astype(np.int64) for c in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(which), items.ids.take(pa.array(which)), ids.take(pa.array(docs)), pa.array(score)],
                    ["item", "item_id", "doc_id", "score"])

    return chunks.mapInArrow(ask, f"item long, item_id {kind}, doc_id {doc_kind}, score long")


def _blocks(items: DataFrame) -> Iterator[pa.Table]:
    """The items in blocks of bounded text size, each collected by itself."""
    numbered = materialise(items.withColumn("key", F.monotonically_increasing_id()), "items")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + F.lit(64)
    before = F.sum(size).over(Window.partitionBy(F.shiftright("key", 33)).orderBy("key")) - size
    runs = (numbered.withColumn("run", F.floor(before / F.lit(_ITEM_BYTES))).groupBy(F.shiftright("key", 33), "run")
            .agg(F.min("key").alias("low"), F.max("key").alias("high"), F.sum(size).alias("bytes")).orderBy("low").collect())
    start, taken = 0, 0
    for j, run in enumerate(runs):
        taken += run["bytes"]
        if j + 1 == len(runs) or taken + runs[j + 1]["bytes"] > _ITEM_BYTES:
            yield numbered.where(F.col("key").between(runs[start]["low"], run["high"])).orderBy("key").select("item", "text").toArrow()
            start, taken = j + 1, 0


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of highest score above 0 for each row of ``items``.

    With N documents that hold a term, L their terms, n a document's: a term held by
    df documents weighs w = floor(1000 ln((2N + 2) / (2 df + 1))) and adds
    w ((10^9 tf) div (1000 tf + 8 m)), m = 10 + (90 n N) div L. Equal scores stand by
    ascending doc_id, null first. Null texts hold no term; a document or an item
    that is repeated is ranked each time; an item without a match has no row.

    The items go over the documents in blocks of about 4 MB of text (at least one
    item). A block takes one pass over the texts, which stores every chunk's
    postings of the block's terms and nothing else, and one over these postings.
    df, N and L cover all documents; only sums for the block's terms reach the
    driver. Each chunk of documents answers every item term at a time with its own
    k best, ties included, and Spark ranks these.
    """
    source = clear_of(docs, doc_id, text).toDF("doc_id", "text")
    asked = items.select(F.col(f"`{item_id}`").alias("item"), F.col(f"`{item_text}`").alias("text"))
    kind = asked.schema["item"].dataType.simpleString()
    answers = [_ranked_block(source, block, kind, k) for block in _blocks(asked)]
    if not answers:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, {source.schema['doc_id'].simpleString().replace(':', ' ')}, score long")
    return reduce(DataFrame.unionByName, answers)


def _ranked_block(source: DataFrame, block: pa.Table, kind: str, k: int) -> DataFrame:
    texts = block["text"].combine_chunks()
    offsets, codes, vocabulary = terms(texts)
    items = Items(block["item"].combine_chunks(), vocabulary, [np.unique(codes[a:b]) for a, b in zip(offsets[:-1], offsets[1:])])
    chunks = materialise(_postings(source, vocabulary), "postings")
    whole = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    n, length = (int(v or 0) for v in chunks.agg(F.sum(F.size(F.filter("sizes", lambda x: x > 0))), F.sum(whole)).first())
    held = np.zeros(len(vocabulary), np.int64)
    for r in chunks.select(F.inline(F.arrays_zip("terms", "held"))).groupBy("terms").agg(F.sum("held").alias("held")).collect():
        held[r["terms"]] = r["held"]
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
    best = _answers(chunks, items, kind, weights(held, n), n, length, k).withColumn("rank", place).where(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")
