"""Packing along a space-filling curve: neighbours on a Hilbert curve share sequences."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.llm.text import binaries, clear_of, mix, slices, texts_of, tidied, width
from assayloom.llm.token_counts import Encoder, encode_texts
from assayloom.llm.word_bpe import ragged
from assayloom.session import materialise

#: Width of a hashed document vector, and of its projection.
_HASHED, _DIMS, _BITS = 256, 4, 10
#: Text bytes worked on at once.
_SLICE = 4 << 20


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with ``bits``-bit coordinates (rows x dimensions).

    From the highest bit down: a set bit inverts the lower bits of the first
    axis, a clear one swaps them with the axis at hand; a Gray decode follows.
    """
    x = cells.astype(np.uint64).T.copy()
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        low = np.uint64((1 << b) - 1)
        for axis in range(len(x)):
            on = (x[axis] >> np.uint64(b)) & one == one
            swap = np.where(on, np.uint64(0), (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(on, low, swap)
            if axis:
                x[axis] ^= swap
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(b)) & one == one, np.uint64((1 << b) - 1), np.uint64(0))
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for axis in range(len(x)):
            key = (key << one) | ((x[axis] >> np.uint64(b)) & one)
    return key


_SIGNS = np.where(mix(np.arange(1, _HASHED * _DIMS + 1, dtype=np.uint64)).reshape(_HASHED, _DIMS) & np.uint64(1), 1.0, -1.0)


def _project(stream: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashed token vectors of documents (log counts), projected to few dimensions by random signs."""
    slot = (mix(np.arange(int(stream.max(initial=0)) + 1, dtype=np.uint64)) % np.uint64(_HASHED)).astype(np.int64)
    docs = len(ends) - 1
    of = np.repeat(np.arange(docs, dtype=np.int64) * _HASHED, np.diff(ends))
    vectors = np.log1p(np.bincount(of + slot[stream], minlength=docs * _HASHED).reshape(docs, _HASHED))
    norm = np.sqrt((vectors ** 2).sum(axis=1, keepdims=True))
    return (vectors @ _SIGNS) / np.where(norm == 0, 1, norm)


def _stored_as(path: str, end_id: int) -> str:
    """Number type of stored ids: two bytes where every id of the vocabulary fits."""
    if path.endswith(".model"):
        import sentencepiece

        most = sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()
    else:
        from tokenizers import Tokenizer

        most = max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values())
    return "<u2" if max(most, end_id) < 1 << 16 else "<u4"


def _tokenised(docs: DataFrame, path: str, end_id: int, doc_id: str, text: str, stored: str) -> DataFrame:
    """doc_id, n (tokens with the end id), ids (bytes of type ``stored``), at_0.. (projection)."""
    def encode_all(batches):
        encoder = Encoder(path)
        for batch in batches:
            for part in slices(batch, text, _SLICE):
                offsets, codes, ids, counts = encode_texts(texts_of(part, text), encoder)
                # The end is one more unit, behind every document's own.
                codes = np.insert(codes, offsets[1:], len(counts))
                ids, counts = np.append(ids, np.uint32(end_id)).astype(stored), np.append(counts, 1)
                n = counts[codes]
                stream = ragged(ids, (np.cumsum(counts) - counts)[codes], n)
                ends = np.concatenate(([0], np.cumsum(n)))[offsets + np.arange(len(offsets))]
                size = stream.itemsize
                rows = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), part.num_rows, [None, pa.py_buffer((ends * size).tobytes()), pa.py_buffer(stream.tobytes())])
                at = _project(stream, ends)
                yield pa.RecordBatch.from_arrays(
                    [part[doc_id], pa.array(np.diff(ends)), rows.cast(pa.binary())]
                    + [pa.array(at[:, j]) for j in range(_DIMS)],
                    ["doc_id", "n", "ids"] + [f"at_{j}" for j in range(_DIMS)])

    source = clear_of(docs, doc_id, text)
    kind = source.schema[doc_id].dataType.simpleString()
    return source.mapInArrow(tidied(encode_all), f"doc_id {kind}, n long, ids binary, "
                             + ", ".join(f"at_{j} double" for j in range(_DIMS)))


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", length: int = 2048,
         end_id: int = 1, carry_ids: bool = False) -> DataFrame:
    """Cut the ids of all documents into full sequences, neighbours on the curve together.

    Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and ``ids`` with ``carry_ids``). A document is its ids plus ``end_id``; a null
    or empty text is ``end_id`` alone. Every sequence but the last is full.

    Order: hashed token vectors, projected to a few dimensions, standardised over
    the corpus, as a Hilbert key; below it a hash of id and content, so that very
    many equal texts still spread over tasks. Quantiles of that key cut the corpus
    into ranges; the token totals of the ranges give each its first position, and
    each range is then cut on its own, in order. Ids move once.
    """
    stored = _stored_as(path, end_id)
    tokens = materialise(_tokenised(docs, path, end_id, doc_id, text, stored), "tokens")
    at = [f"at_{j}" for j in range(_DIMS)]
    moments = tokens.agg(*[F.avg(c).alias(c) for c in at], *[F.stddev_pop(c).alias(f"{c}_sd") for c in at]).first()
    middle = np.array([moments[c] or 0.0 for c in at])
    spread = np.array([moments[f"{c}_sd"] or 1.0 for c in at])

    def curve(*columns):
        z = np.clip((np.column_stack([c.to_numpy() for c in columns]) - middle) / spread, -20, 20)
        # The logistic curve stands in for the normal distribution: even cells for most documents.
        cells = np.clip((1 << _BITS) / (1 + np.exp(-1.702 * z)), 0, (1 << _BITS) - 1)
        return pd.Series(hilbert_key(cells.astype(np.int64), _BITS).astype(np.int64))

    key = F.pandas_udf(curve, "long")(*at)
    salt = F.pmod(F.xxhash64("doc_id", "n"), F.lit(1 << 22))
    keyed = tokens.select("doc_id", "n", "ids", (F.shiftleft(key, 22) + salt).alias("place"))
    # The curve is read by two jobs and is cheap: places are stored without the ids.
    places = materialise(keyed.select("doc_id", "n", "place"), "places")
    ranges = 4 * width(docs)
    cuts = places.agg(F.percentile_approx(
        "place", F.array(*[F.lit(i / ranges) for i in range(1, ranges)]), F.lit(100_000)).alias("q")).first()["q"]
    cuts = sorted(set(cuts or []))
    borders = np.array(cuts, np.int64)

    def zone_of(place):
        return pd.Series(np.searchsorted(borders, place.to_numpy(), side="right").astype(np.int32))

    zone = F.pandas_udf(zone_of, "int")("place")
    totals = {r["zone"]: int(r["n"]) for r in
              places.groupBy(zone.alias("zone")).agg(F.sum("n").alias("n")).collect()}
    first, so_far = {}, 0
    for z in sorted(totals):
        first[z] = so_far
        so_far += totals[z]

    def cut(batches):
        now, position = None, 0
        for batch in batches:
            out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
            for doc, z, ids in zip(batch["doc_id"].to_pylist(), batch["zone"].to_pylist(), batch["ids"]):
                if z != now:
                    now, position = z, first[z]
                data = np.frombuffer(ids.as_buffer(), stored).astype("<u4")
                n, start = len(data), 0
                while start < n:
                    room = min(n - start, length - position % length)
                    piece = data[start:start + room].tobytes()
                    out["doc_id"].append(doc)
                    out["start"].append(start)
                    out["length"].append(room)
                    out["ids_crc32"].append(zlib.crc32(piece))
                    out["doc_tokens"].append(n)
                    out["sequence_id"].append(position // length)
                    out["offset"].append(position % length)
                    if carry_ids:
                        out["ids"].append(piece)
                    start += room
                    position += room
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], batch.schema.field("doc_id").type)]
                + [pa.array(out[k], pa.int64()) for k in list(out)[1:7]]
                + ([binaries(out["ids"])] if carry_ids else []), list(out)[: 7 + carry_ids])

    kind = keyed.schema["doc_id"].dataType.simpleString()
    ordered = (keyed.withColumn("zone", zone).select("zone", "place", "doc_id", "n", "ids")
               .repartition(width(docs), "zone").sortWithinPartitions("zone", "place", "doc_id", "n", "ids"))
    return ordered.mapInArrow(tidied(cut), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                              "sequence_id long, offset long" + (", ids binary" if carry_ids else ""))
