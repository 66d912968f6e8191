"""Sampled piece segmentation: forward filtering, backward sampling; lossless decoding."""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

from assayloom.llm.text import clear_of, mix, slices, texts_of

#: Text bytes worked on at once.
_SLICE = 2 << 20
#: The sign of a space in pieces, and what stands for that sign in a text: no piece has it.
_SPACE, _LITERAL = 0x2581, 0x110000
_PRIME = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Pieces:
    """Pieces by hash and length, their log weights, and the bytes each id stands for."""

    hashes: np.ndarray
    ids: np.ndarray
    starts: np.ndarray
    weight: np.ndarray
    byte_ids: np.ndarray
    byte_weight: float
    text_at: np.ndarray
    text: np.ndarray
    longest: int


def _prefix_hashes(name: str) -> list[int]:
    """Hash of each beginning of a piece, as the lattice computes it for stretches of text."""
    rolled, h = np.zeros(len(name), np.uint64), 0
    for k, c in enumerate(name):
        h = (h + ord(c) + 1) * int(_PRIME) & 0xFFFFFFFFFFFFFFFF
        rolled[k] = h
    return mix(rolled).tolist()


@lru_cache(maxsize=2)
def load(path: str, temperature: float = 1.0) -> Pieces:
    """The pieces of a model file with byte fallback.

    A merge-based model has ranks for scores; a piece of rank r weighs
    1 / (r + 10) to the power 1 / temperature, as frequencies fall with rank.
    Pieces of several spaces are left out: a unit starts at each space.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(n)]
    byte_ids = np.full(256, -1, np.int64)
    kept = []
    for i, name in enumerate(names):
        if model.is_byte(i):
            byte_ids[int(name[3:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and "▁" not in name[1:]:
            kept.append(i)
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte fallback")
    rank = np.array([max(0.0, -model.get_score(i)) for i in range(n)])
    weight = -np.log(rank + 10) / temperature
    begun = {i: _prefix_hashes(names[i]) for i in kept}
    found = sorted((begun[i][-1], i) for i in kept)
    data = [bytes([int(names[i][3:-1], 16)]) if model.is_byte(i) else names[i].replace("▁", " ").encode()
            if i in set(kept[:0]) or not model.is_control(i) else b"" for i in range(n)]
    hashes = np.array([h for h, _ in found], np.uint64)
    starts = np.zeros(1 << 20, bool)
    starts[[h & ((1 << 20) - 1) for i in kept for h in begun[i]]] = True
    return Pieces(hashes, np.array([i for _, i in found], np.int64), starts, weight, byte_ids,
                  float(weight.min() - 5), np.concatenate(([0], np.cumsum([len(d) for d in data]))),
                  np.frombuffer(b"".join(data), np.uint8), max(len(names[i]) for i in kept))


def _expand(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Indices of runs: starts[i], starts[i] + 1, ... (n[i] of them), one run after the other."""
    at = np.repeat(starts - (np.cumsum(n) - n), n)
    return at + np.arange(len(at))


def _units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """(units before each text, unit of each occurrence, word of each unit, whether a space precedes it)."""
    lists = pc.split_pattern(texts, " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    encoded = lists.flatten().dictionary_encode()
    spaced = np.ones(len(encoded), np.int64)
    spaced[offsets[:-1]] = 0
    distinct, place = np.unique(encoded.indices.to_numpy().astype(np.int64) * 2 + spaced, return_inverse=True)
    words = encoded.dictionary.take(pa.array(distinct // 2)).to_pylist()
    return offsets, place, words, distinct % 2 == 1


class _Lattice:
    """All segmentations of all units of a slice, with the weights to sample them backwards.

    Nodes are character borders, those of a unit in a row; arcs are pieces, or the
    bytes of a character that has no piece of its own.
    """

    def __init__(self, words: list[str], spaced: np.ndarray, p: Pieces):
        chars = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        own = np.array([len(w) for w in words], np.int64)
        size = own + spaced
        first = np.cumsum(size) - size
        codes = np.full(int(size.sum()), _SPACE, np.int64)
        codes[_expand(first + spaced, own)] = np.where(chars == _SPACE, _LITERAL, chars)
        unit = np.repeat(np.arange(len(words)), size)
        place = np.arange(len(codes))
        node, stop = place + unit, (first + size)[unit]
        start, end, piece = [], [], []
        live, h = place, np.zeros(len(codes), np.uint64)
        single = np.zeros(len(codes), bool)
        for n in range(1, p.longest + 1):
            inside = live + n <= stop[live]
            live, h = live[inside], h[inside]
            if not len(live):
                break
            h = (h + codes[live + n - 1].astype(np.uint64) + np.uint64(1)) * _PRIME
            key = mix(h)
            maybe = p.starts[(key & np.uint64(len(p.starts) - 1)).astype(np.int64)]
            live, h, key = live[maybe], h[maybe], key[maybe]
            at = np.minimum(np.searchsorted(p.hashes, key), len(p.hashes) - 1)
            hit = p.hashes[at] == key
            start.append(node[live[hit]])
            end.append(node[live[hit]] + n)
            piece.append(p.ids[at[hit]])
            if n == 1:
                single[live[hit]] = True
        bare = np.nonzero(~single)[0]
        raw = [chr(_SPACE if c == _LITERAL else c).encode() for c in codes[bare].tolist()]
        lengths = np.array([len(b) for b in raw], np.int64)
        start.append(node[bare])
        end.append(node[bare] + 1)
        # A character without a piece points behind the pieces, to its bytes.
        piece.append(len(p.weight) + np.arange(len(bare)))
        start, end, piece = map(np.concatenate, (start, end, piece))
        self.spelled = p.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        self.spelled_at = np.concatenate(([0], np.cumsum(lengths)))
        self.pieces = len(p.weight)
        weight = np.concatenate((p.weight, p.byte_weight * lengths))[piece]

        self.first = first + np.arange(len(words))
        self.last = self.first + size
        nodes = len(codes) + len(words)
        depth = np.zeros(nodes, np.int64)
        depth[node + 1] = place + 1 - first[unit]
        order = np.lexsort((end, depth[end]))
        start, end, piece, weight = start[order], end[order], piece[order], weight[order]
        total = np.zeros(nodes)
        heads = np.nonzero(np.concatenate(([True], end[1:] != end[:-1])))[0] if len(end) else np.zeros(0, np.int64)
        level = depth[end[heads]]
        bounds = np.searchsorted(level, np.arange(1, (level.max() if len(level) else 0) + 2))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            lo, hi = heads[a], heads[b] if b < len(heads) else len(end)
            total[end[heads[a:b]]] = np.logaddexp.reduceat(total[start[lo:hi]] + weight[lo:hi], heads[a:b] - lo)
        # Chances of the arcs into a node, added up behind the node's rank: one sorted array to search.
        rank = np.zeros(nodes, np.int64)
        rank[end[heads]] = np.arange(len(heads))
        chance = np.exp(total[start] + weight - total[end])
        run = np.cumsum(chance)
        before = np.concatenate(([0.0], run))[heads]
        self.chances = rank[end] + np.minimum(run - before[rank[end]], 1.0)
        if len(heads):
            self.chances[np.append(heads[1:], len(end)) - 1] = np.arange(len(heads)) + 1.0
        self.rank, self.start, self.piece = rank, start, piece

    def sample(self, unit: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each occurrence): one segmentation per occurrence, drawn from its own seed."""
        state, goal, who = self.last[unit], self.first[unit], np.arange(len(unit))
        found, owner, step = [], [], np.zeros(1, np.uint64)
        while True:
            go = state > goal[who]
            state, who = state[go], who[go]
            if not len(who):
                break
            u = (mix(seed[who] + step * _PRIME) >> np.uint64(11)).astype(float) * 2.0 ** -53
            arc = np.searchsorted(self.chances, self.rank[state] + u, side="right")
            found.append(self.piece[arc])
            owner.append(who)
            state = self.start[arc]
            step = step + np.uint64(1)
        if not found:
            return np.zeros(0, np.int64), np.zeros(len(unit), np.int64)
        piece, of = np.concatenate(found[::-1]), np.concatenate(owner[::-1])
        order = np.argsort(of, kind="stable")
        piece, of = piece[order], of[order]
        spelled = piece >= self.pieces
        at = np.where(spelled, piece - self.pieces, 0)
        n = np.where(spelled, np.diff(self.spelled_at)[at] if len(self.spelled_at) > 1 else 1, 1)
        ids = np.repeat(piece, n)
        if spelled.any():
            where = np.repeat(spelled, n)
            ids[where] = self.spelled[_expand(self.spelled_at[at[spelled]], n[spelled])]
        return ids, np.bincount(of, n, len(unit)).astype(np.int64)


def encode_slice(texts: pa.Array, keys: list, p: Pieces, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ends): sampled ids of the texts one after the other; the draws hang on seed, key and place only."""
    offsets, unit, words, spaced = _units(texts)
    lattice = _Lattice(words, spaced.astype(np.int64), p)
    own = np.array([xxhash.xxh3_64_intdigest(repr(k), seed) for k in keys], np.uint64)
    n = np.diff(offsets)
    place = np.arange(len(unit)) - np.repeat(offsets[:-1], n)
    ids, many = lattice.sample(unit, mix(np.repeat(own, n) + place.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))
    return ids, np.concatenate(([0], np.cumsum(many)))[offsets]


def decode_ids(ids: np.ndarray, p: Pieces) -> bytes:
    """UTF-8 bytes of a run of ids."""
    n = np.diff(p.text_at)[ids]
    return p.text[_expand(p.text_at[ids], n)].tobytes()


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", seed: int = 1,
           temperature: float = 1.0) -> DataFrame:
    """doc_id, n_bytes, n_pieces, ids, ids_crc32, restored of every row.

    One segmentation of the whole text, drawn with its probability among all of the
    piece lattice: forward sums over the lattice, then pieces drawn from the end.
    The draws depend on ``seed`` and the row's id, so any run gives the same ids.
    ``restored`` tells that decoding them gives the text back byte by byte. A null
    or empty text has no pieces. The lattice of a distinct word is built once per
    slice of texts; one pass, no shuffle.
    """
    def run(batches):
        p = load(path, temperature)
        for batch in batches:
            for part in slices(batch, text, _SLICE):
                texts = texts_of(part, text)
                ids, ends = encode_slice(texts, part[doc_id].to_pylist(), p, seed)
                raw = [t.encode() for t in texts.to_pylist()]
                runs = [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part[doc_id], pa.array([len(t) for t in raw], pa.int64()), pa.array(np.diff(ends)),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32))),
                     pa.array([zlib.crc32(r.astype("<u4").tobytes()) for r in runs], pa.int64()),
                     pa.array([decode_ids(r, p) == t for r, t in zip(runs, raw)], pa.bool_())],
                    ["doc_id", "n_bytes", "n_pieces", "ids", "ids_crc32", "restored"])

    source = clear_of(docs, doc_id, text)
    kind = source.schema[doc_id].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_pieces long, ids array<int>, ids_crc32 long, "
                             "restored boolean")


def decode(encoded: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, text of every row of ids; null ids give an empty text."""
    def run(batches):
        p = load(path)
        for batch in batches:
            texts = [decode_ids(np.asarray(v or [], np.int64), p).decode("utf-8", "replace") for v in batch[ids].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch[doc_id], pa.array(texts, pa.string())], ["doc_id", "text"])

    source = clear_of(encoded, doc_id, ids)
    return source.mapInArrow(run, f"doc_id {source.schema[doc_id].dataType.simpleString()}, text string")
