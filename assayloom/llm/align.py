"""Cross-tokenizer alignment: token ends of two tokenizers merged along a merge path, links counted over the corpus."""

from __future__ import annotations

import hashlib
import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.llm.text import binaries, clear_of, mix, slices, sums, texts_of, tidied, width
from assayloom.llm.word_bpe import byte_letters
from assayloom.session import materialise

#: Text bytes of one chunk, of one call of a library, ends of one piece of the merge path, entries of one block.
_CHUNK_BYTES, _CALL_BYTES, _PIECE, _BLOCK = 4 << 20, 256 << 10, 1 << 16, 2 << 20
#: Flags of (document, pair) that are set at once.
_FLAGS = 32 << 20
#: B's ids take this many bits of a pair's key, A's the rest of 32.
_B_BITS = 15


# ---- the two tokenizers ----

class Tokenizers:
    """A byte-level BPE of the tokenizers library and a sentencepiece model, with the bytes of every id."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        letters = byte_letters()
        for entry, i in vocabulary.items():
            known = all(c in letters for c in entry)
            self.a_bytes[i] = bytes(letters[c] for c in entry) if known else entry.encode()
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        if len(self.b_bytes) > 1 << _B_BITS or len(self.a_bytes) > 1 << (32 - _B_BITS):
            raise ValueError("more ids than a pair's key has room for")
        if any("▁" in p.lstrip("▁") for p in map(self.b.id_to_piece, range(len(self.b_bytes)))):
            raise ValueError("a piece goes beyond a word, so words cannot be encoded alone")
        self.a_length = np.fromiter(map(len, self.a_bytes), np.int64, len(self.a_bytes))
        self.b_length = np.fromiter(map(len, self.b_bytes), np.int64, len(self.b_bytes))

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of space+text by A and of text by B, None unless the bytes of both are space+text."""
        whole = f" {text}"
        a = self.a.encode_batch_fast([whole], add_special_tokens=False)[0].ids
        b = self.b.encode(text, num_threads=1)
        data = whole.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != data or b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)


# ---- units: stretches that both tokenizers encode alone ----

def units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """(offsets, codes, distinct units, plain): space+text i is the units codes[offsets[i]:offsets[i + 1]], a space before each.

    A text is cut at each space between two characters that are not white space:
    both tokenizers start a token there. ``plain`` units neither start nor end with white space.
    An empty text has no units.
    """
    lists = pc.split_pattern(texts, " ")
    coded = lists.flatten().dictionary_encode()
    ends, words, codes = lists.offsets.to_numpy().astype(np.int64), coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    begins_well = np.fromiter((w != "" and not w[0].isspace() for w in words), bool, len(words))
    ends_well = np.fromiter((w != "" and not w[-1].isspace() for w in words), bool, len(words))
    starts = begins_well[codes]
    starts[1:] &= ends_well[codes[:-1]]
    starts[ends[:-1]] = True
    at = np.flatnonzero(starts)
    offsets = np.searchsorted(at, ends)
    out = codes[at]
    lengths = np.diff(np.append(at, len(codes)))
    joined: dict[str, int] = {}
    for j in np.flatnonzero(lengths > 1).tolist():
        unit = " ".join([words[c] for c in codes[at[j]:at[j] + lengths[j]].tolist()])
        out[j] = len(words) + joined.setdefault(unit, len(joined))
    some = np.repeat(pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0, np.diff(offsets))
    offsets = np.concatenate(([0], np.cumsum(some)))[offsets]
    used, out = np.unique(out[some], return_inverse=True)
    all_units = words + list(joined)
    distinct = [all_units[u] for u in used.tolist()]
    plain = np.fromiter((not (u[:1].isspace() or u[-1:].isspace() or u == "") for u in distinct), bool, len(distinct))
    return offsets, out, distinct, plain


@dataclass
class Encoded:
    """Ids of units one after the other, how many each unit has, and whether its bytes are those of the unit."""

    a: np.ndarray
    b: np.ndarray
    a_count: np.ndarray
    b_count: np.ndarray
    good: np.ndarray


def encode_units(both: Tokenizers, distinct: list[str], plain: np.ndarray) -> Encoded:
    """Plain units are encoded many at once and cut at their known lengths, all others one by one."""
    found: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(distinct)

    def alone(which):
        for u in which:
            found[u] = both.encode(distinct[u])

    def together(which):
        got = both.encode(" ".join([distinct[u] for u in which]))
        ends = np.cumsum([len(distinct[u].encode()) + 1 for u in which])
        if got is not None:
            cuts = [np.searchsorted(np.cumsum(length[ids]), ends) + 1 for ids, length in zip(got, (both.a_length, both.b_length))]
            if all((np.cumsum(length[ids])[c - 1] == ends).all() for ids, length, c in zip(got, (both.a_length, both.b_length), cuts)):
                for u, a, b in zip(which, np.split(got[0], cuts[0][:-1]), np.split(got[1], cuts[1][:-1])):
                    found[u] = a, b
                return
        alone(which)

    call, size = [], 0
    for u in np.flatnonzero(plain).tolist():
        call.append(u)
        size += len(distinct[u]) + 1
        if size >= _CALL_BYTES:
            together(call)
            call, size = [], 0
    if call:
        together(call)
    alone(np.flatnonzero(~plain).tolist())
    none = np.zeros(0, np.int64)
    a = [f[0] if f else none for f in found]
    b = [f[1] if f else none for f in found]
    return Encoded(np.concatenate([none, *a]), np.concatenate([none, *b]), np.fromiter(map(len, a), np.int64, len(a)),
                   np.fromiter(map(len, b), np.int64, len(b)), np.fromiter((f is not None for f in found), bool, len(found)))


# ---- merging ----

def merge_path(a: np.ndarray, b: np.ndarray, piece: int) -> np.ndarray:
    """How many of ``a`` lie before every ``piece``-th step of the merge of two ascending arrays, equal ones of ``a`` first.

    All diagonals are searched at once, each by halving; with the step's number they
    give where each array is cut, so that all pieces merge the same number of entries.
    """
    steps = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(0, steps - len(b)), np.minimum(steps, len(a))
    while (low < high).any():
        going = low < high
        middle = (low + high) // 2
        left = a[np.minimum(middle, len(a) - 1)]
        right = b[np.clip(steps - 1 - middle, 0, len(b) - 1)]
        more = going & (left <= right)
        low, high = np.where(more, middle + 1, low), np.where(going & ~more, middle, high)
    return low


def common_ends(a: np.ndarray, b: np.ndarray, piece: int = _PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Which of the ends ``a`` are in ``b``, and which of ``b`` in ``a``: piece by piece, then across their borders."""
    in_a, in_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    if not len(a) or not len(b):
        return in_a, in_b
    at = merge_path(a, b, piece)
    to = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b)) - at
    for i, i1, j, j1 in zip(at[:-1], at[1:], to[:-1], to[1:]):
        _, x, y = np.intersect1d(a[i:i1], b[j:j1], assume_unique=True, return_indices=True)
        in_a[i + x] = True
        in_b[j + y] = True
    # The last end of A in a piece and the first one of B in the next may be the same place.
    edge = (at > 0) & (to < len(b))
    i, j = at[edge] - 1, to[edge]
    same = a[i] == b[j]
    in_a[i[same]] = True
    in_b[j[same]] = True
    return in_a, in_b


@dataclass
class Groups:
    """Groups of the tokens of units: group of each token, tokens of each side, unit of each group."""

    a_group: np.ndarray
    b_group: np.ndarray
    a_size: np.ndarray
    b_size: np.ndarray
    unit: np.ndarray


def group_tokens(both: Tokenizers, e: Encoded) -> Groups:
    """Tokens of a unit between two places where tokens of both sides end are a group."""
    ends_a, ends_b = np.cumsum(both.a_length[e.a]), np.cumsum(both.b_length[e.b])
    in_a, in_b = common_ends(ends_a, ends_b)
    a_group, b_group = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    n = int(in_a.sum())
    return Groups(a_group, b_group, np.bincount(a_group, minlength=n), np.bincount(b_group, minlength=n),
                  np.repeat(np.arange(len(e.a_count)), e.a_count)[in_a])


def written(e: Encoded, g: Groups) -> pa.LargeBinaryArray:
    """Every unit's groups as text, ``a1,a2|b1;`` for each group."""
    n = len(e.a) + len(e.b)
    place_a = np.arange(len(e.a)) + (np.cumsum(g.b_size) - g.b_size)[g.a_group]
    place_b = np.arange(len(e.b)) + np.cumsum(g.a_size)[g.b_group]
    ids, sign = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
    ids[place_a], ids[place_b] = e.a, e.b
    close = np.cumsum(g.a_size + g.b_size) - 1
    sign[close], sign[close - g.b_size] = ord(";"), ord("|")
    signs = pa.array([chr(c) for c in range(128)], pa.large_string()).take(pa.array(sign))
    flat = pc.binary_join_element_wise(pc.cast(pa.array(ids), pa.large_string()), signs, pa.scalar("", pa.large_string()))
    bounds = np.concatenate(([0], np.cumsum(pc.binary_length(flat).to_numpy(zero_copy_only=False)))).astype(np.int64)
    tokens = np.concatenate(([0], np.cumsum(e.a_count + e.b_count)))
    data = flat.buffers()[2] if n else pa.py_buffer(b"")
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(e.a_count), [None, pa.py_buffer(bounds[tokens].tobytes()), data])


def pairs(e: Encoded, g: Groups) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, key, links) of the id pairs of every group, in the order of units; ids that repeat in a group are taken once, with their links."""
    def once(group, ids):
        key, n = np.unique(group.astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64), return_counts=True)
        group = (key >> np.uint64(32)).astype(np.int64)
        return (key & np.uint64(0xFFFFFFFF)).astype(np.int64), n, np.bincount(group, minlength=len(g.unit))

    a, a_links, a_some = once(g.a_group, e.a)
    b, b_links, b_some = once(g.b_group, e.b)
    # Each id of A, as often as its group has ids of B.
    repeat = np.repeat(b_some, a_some)
    left = np.repeat(np.arange(len(a)), repeat)
    first = np.repeat(np.repeat(np.cumsum(b_some) - b_some, a_some), repeat)
    right = first + np.arange(len(left)) - np.repeat(np.cumsum(repeat) - repeat, repeat)
    unit = np.repeat(g.unit, a_some * b_some)
    return unit, (a[left] << _B_BITS | b[right]).astype(np.uint32), a_links[left] * b_links[right]


# ---- chunks ----

def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), "zstd", asbytes=True) if len(values) else b""


def _unpacked(data: bytes, kind: str, count: int) -> np.ndarray:
    size = count * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data, size, "zstd", asbytes=True) if size else b"", kind)


def _coded(both: Tokenizers, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, Encoded]:
    """(offsets, codes, encoded units) of texts; a text with a unit that fails is tried as a whole, and has no units if that fails too."""
    offsets, codes, distinct, plain = units(texts)
    e = encode_units(both, distinct, plain)
    if e.good.all():
        return offsets, codes, e
    failed = np.flatnonzero(sums((~e.good[codes]).astype(np.int64), offsets))
    whole = encode_units(both, [texts[int(d)].as_py() for d in failed], np.zeros(len(failed), bool))
    lists = np.split(codes, offsets[1:-1])
    for k, d in enumerate(failed.tolist()):
        lists[d] = np.array([len(distinct) + k] if whole.good[k] else [], np.int64)
    all_ = Encoded(*(np.concatenate((getattr(e, f), getattr(whole, f))) for f in ("a", "b", "a_count", "b_count", "good")))
    return np.concatenate(([0], np.cumsum([len(x) for x in lists]))), np.concatenate(lists).astype(np.int64), all_


def _documents_with(pair: np.ndarray, first: np.ndarray, some: np.ndarray, offsets: np.ndarray, codes: np.ndarray, distinct: int) -> np.ndarray:
    """How many documents hold each pair: unit u has the pairs pair[first[u]:first[u] + some[u]]."""
    held = np.zeros(distinct, np.int64)
    n = len(offsets) - 1
    step = max(1, _FLAGS // max(1, distinct))
    for d in range(0, n, step):
        stop = min(n, d + step)
        own = codes[offsets[d]:offsets[stop]]
        doc, unit = np.divmod(np.unique(np.repeat(np.arange(stop - d), np.diff(offsets[d:stop + 1])) * len(some) + own), max(1, len(some)))
        flags = np.zeros((stop - d, distinct), bool)
        for part in np.array_split(np.arange(len(unit)), 1 + int(some[unit].sum()) // _BLOCK):
            times = some[unit[part]]
            at = np.repeat(first[unit[part]] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
            flags[np.repeat(doc[part], times), pair[at]] = True
        held += flags.sum(axis=0)
    return held


def _chunks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Chunks of documents: what is known of each document, and the links of its units.

    ids; own: rows of tokens of A, tokens of B, groups, links; digests; sizes: units of
    each; codes; some: pairs of each unit; pair, links: places among the keys; keys:
    the distinct pairs of the chunk, by block order; held: documents that hold each.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def code(batches):
        both = Tokenizers(a_path, b_path)
        for batch in batches:
            for part in slices(batch, "text", _CHUNK_BYTES):
                offsets, codes, e = _coded(both, texts_of(part, "text"))
                g = group_tokens(both, e)
                n = len(e.a_count)
                by_unit = np.stack([e.a_count, e.b_count, np.bincount(g.unit, minlength=n),
                                    sums(g.a_size * g.b_size, np.searchsorted(g.unit, np.arange(n + 1)))], axis=1)
                own = sums(by_unit[codes], offsets)
                text = written(e, g).take(pa.array(codes))
                data = memoryview(text.buffers()[2] or b"")
                ends = np.frombuffer(text.buffers()[1], np.int64)[:len(codes) + 1][offsets] if len(codes) else np.zeros(len(offsets), np.int64)
                digests = [hashlib.sha256(data[i:j - 1]).hexdigest() if j > i else "" for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]
                unit, key, links = pairs(e, g)
                keys, pair = np.unique(key, return_inverse=True)
                order = _order(keys)
                back = np.empty(len(keys), np.int64)
                back[order] = np.arange(len(keys))
                keys, pair = keys[order], back[pair]
                some = np.bincount(unit, minlength=n)
                held = _documents_with(pair, np.cumsum(some) - some, some, offsets, codes, len(keys))
                ends = pa.array([0, part.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(ends, part["doc_id"]), pa.ListArray.from_arrays(ends, pa.array(digests, pa.string())),
                     pa.array([part.num_rows]), pa.array([n]), pa.array([len(codes)]), pa.array([len(pair)]), pa.array([len(keys)]),
                     binaries([_packed(own.astype("<i8"))]), binaries([_packed(np.diff(offsets).astype("<u4"))]),
                     binaries([_packed(codes.astype("<u4"))]), binaries([_packed(some.astype("<u4"))]),
                     binaries([_packed(pair.astype("<u4"))]), binaries([_packed(links.astype("<u4"))]),
                     binaries([_packed(keys)]), binaries([_packed(held.astype("<u4"))])],
                    ["ids", "digests", "n_docs", "n_units", "n_codes", "n_pairs", "n_keys", "own", "sizes", "codes", "some", "pair",
                     "links", "keys", "held"])

    return docs.mapInArrow(
        tidied(code), f"ids array<{kind}>, digests array<string>, n_docs long, n_units long, n_codes long, n_pairs long, n_keys long, "
        "own binary, sizes binary, codes binary, some binary, pair binary, links binary, keys binary, held binary",
    ).withColumn("chunk", F.monotonically_increasing_id())


def _spread(keys: np.ndarray) -> np.ndarray:
    """A number of 32 bits for the A id of each pair."""
    return mix((keys >> np.uint32(_B_BITS)).astype(np.uint64) + np.uint64(1)) >> np.uint64(32)


def _order(keys: np.ndarray) -> np.ndarray:
    """The order in which blocks of any number follow one another."""
    return np.lexsort((keys, _spread(keys)))


def _counted(chunks: DataFrame, bits: int) -> DataFrame:
    """chunk, block, length, totals, best: corpus counts of every chunk's pairs, and whether they are their A id's highest.

    All pairs of an A id lie in one block, which every chunk sends its distinct
    pairs as one array, and which answers in the same order.
    """
    def send(batches):
        for batch in batches:
            for row in batch.select(["chunk", "n_keys", "keys", "held"]).to_pylist():
                keys, held = _unpacked(row["keys"], "<u4", row["n_keys"]), _unpacked(row["held"], "<u4", row["n_keys"])
                at = np.searchsorted(_spread(keys) >> np.uint64(32 - bits), np.arange((1 << bits) + 1).astype(np.uint64))
                some = np.flatnonzero(np.diff(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int64()), pa.array([row["chunk"]] * len(some), pa.int64()), pa.array(np.diff(at)[some]),
                     binaries([_packed(keys[at[b]:at[b + 1]]) for b in some]), binaries([_packed(held[at[b]:at[b + 1]]) for b in some])],
                    ["block", "chunk", "length", "keys", "held"])

    def add(table):
        lengths = table["length"].to_pylist()
        keys = np.concatenate([_unpacked(k, "<u4", n) for k, n in zip(table["keys"].to_pylist(), lengths)])
        held = np.concatenate([_unpacked(k, "<u4", n) for k, n in zip(table["held"].to_pylist(), lengths)])
        distinct, place = np.unique(keys, return_inverse=True)
        totals = np.bincount(place, held, len(distinct)).astype(np.int64)
        first = np.flatnonzero(np.diff(distinct >> np.uint32(_B_BITS), prepend=-1))
        best = totals == np.repeat(np.maximum.reduceat(totals, first), np.diff(np.append(first, len(distinct))))
        ends = np.cumsum(lengths)
        cuts = list(zip((ends - lengths).tolist(), ends.tolist()))
        return pa.table(
            [table["chunk"], table["block"], table["length"], binaries([_packed(totals[place[i:j]].astype("<u8")) for i, j in cuts]),
             binaries([np.packbits(best[place[i:j]]).tobytes() for i, j in cuts])], ["chunk", "block", "length", "totals", "best"])

    return (chunks.mapInArrow(tidied(send), "block long, chunk long, length long, keys binary, held binary")
            .groupBy("block").applyInArrow(add, "chunk long, block long, length long, totals binary, best binary"))


_NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _answers(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of a chunk, given the counts of its pairs."""
    row = left.drop_columns(["ids", "digests"]).to_pylist()[0]
    right = right.sort_by("block")
    lengths = right["length"].to_pylist()
    none = [np.zeros(0, np.int64)]
    totals = np.concatenate(none + [_unpacked(t, "<u8", n).astype(np.int64) for t, n in zip(right["totals"].to_pylist(), lengths)])
    best = np.concatenate(none + [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(right["best"].to_pylist(), lengths)])
    pair, links = _unpacked(row["pair"], "<u4", row["n_pairs"]), _unpacked(row["links"], "<u4", row["n_pairs"]).astype(np.int64)
    some = np.concatenate(([0], np.cumsum(_unpacked(row["some"], "<u4", row["n_units"]).astype(np.int64))))
    by_unit = np.stack([sums(links * best[pair], some), sums(links * totals[pair], some)], axis=1)
    offsets = np.concatenate(([0], np.cumsum(_unpacked(row["sizes"], "<u4", row["n_docs"]).astype(np.int64))))
    more = sums(by_unit[_unpacked(row["codes"], "<u4", row["n_codes"])], offsets)
    own = _unpacked(row["own"], "<i8", row["n_docs"] * 4).reshape(-1, 4)
    numbers = [pa.array(np.ascontiguousarray(c)) for c in (*own.T, *more.T)]
    return pa.table([left["ids"].combine_chunks().flatten(), *numbers, left["digests"].combine_chunks().flatten()], _NAMES)


def align(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    A encodes space+text, B the text, to which it adds the space; special strings
    are plain text. Places where tokens of both end cut the tokens into groups; all
    A-B pairs of a group are links. A pair's count is the number of documents (rows)
    that hold it linked. n_best counts the links whose pair has the highest count of
    its A id, count_sum adds up the counts over the links. A text that is null or
    empty, or that the bytes of either side do not give back, has no tokens: zeros and ''.

    Both sides start a token at a single space between words, so the distinct
    units between such spaces are encoded and aligned once a chunk, and a document
    adds up its units. Ends are merged along a merge path in pieces of 65,536 steps.
    Pairs are counted in blocks of A ids, of which there are as many as the corpus needs;
    chunks are stored once, bucketed, and only distinct pairs and their counts move.
    """
    spark, name = docs.sparkSession, f"align_chunks_{uuid.uuid4().hex}"
    source = clear_of(docs, doc_id, text).toDF("doc_id", "text")
    try:
        _chunks(source, a_path, b_path).write.format("parquet").bucketBy(width(docs), "chunk").saveAsTable(name)
        chunks = spark.table(name)
        entries = chunks.agg(F.sum("n_keys")).first()[0] or 0
        bits = min(16, max(6, math.ceil(math.log2(max(1, entries / _BLOCK))), math.ceil(math.log2(width(docs)))))
        kind = source.schema["doc_id"].dataType.simpleString()
        return materialise(chunks.groupBy("chunk").cogroup(materialise(_counted(chunks, bits), "counted").groupBy("chunk")).applyInArrow(
            _answers, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"), "aligned")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
