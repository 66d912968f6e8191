"""N-gram Jaccard join by token-combination prefixes."""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayloom.llm.components import components
from assayloom.llm.text import binaries, clear_of, coded_words, hashes, mix, slices, texts_of, tidied, width
from assayloom.session import materialise

#: Tokens of one block when all tokens of the corpus are counted.
_BLOCK_TOKENS = 4 << 20
#: Sets that hold a token before its class is the one of pairs.
_FREQUENT = 32
#: Longs of a parity sketch.
_SKETCH = 16
_ODD = [np.uint64(v) for v in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                               0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles; fewer words are one shingle."""
    offsets, codes, distinct = coded_words(pc.ascii_lower(texts))
    w = hashes(distinct)[codes]
    rolled = np.zeros(max(0, len(w) - k + 1), np.uint64)
    for j in range(k):
        rolled = mix(rolled + w[j:len(w) - k + 1 + j] * _ODD[j % 8]) if len(rolled) else rolled
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(rolled[a:b - k + 1]))
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for v in w[a:b]:
                whole = mix(whole * _ODD[1] + v)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _set_hash(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _sizes(source: DataFrame, k: int) -> DataFrame:
    """doc_id, n (size of the set), set_hash of every row."""
    def measure(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(texts_of(part, "text"), k)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array([len(s) for s in sets], pa.int64()), binaries([_set_hash(s) for s in sets])],
                    ["doc_id", "n", "set_hash"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(tidied(measure), f"doc_id {kind}, n long, set_hash binary")


def _repeated(source: DataFrame, k: int, tokens: int) -> DataFrame:
    """doc_id, repeated: how many of a document's shingles occur in another document too.

    Every shingle of the corpus is counted. A slice of documents sends each block
    of the hash range its values as one array; a value that several documents of
    the slice hold goes once, so that no shingle is hot. Blocks are as many as the
    corpus needs for their size to stay the same. 32 bits within a block stand for
    a shingle: a clash makes a document a candidate too many, never too few.
    """
    bits = max(6, math.ceil(math.log2(max(1, tokens / _BLOCK_TOKENS))), math.ceil(math.log2(width(source))))
    kind = source.schema["doc_id"].dataType.simpleString()

    def send(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(texts_of(part, "text"), k)
                values = np.concatenate(sets)
                of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                order = np.argsort(values, kind="stable")
                values, of = values[order], of[order]
                same = np.concatenate((values[1:] == values[:-1], [False])) if len(values) else np.zeros(0, bool)
                several = same | np.concatenate(([False], same[:-1])) if len(values) else same
                once_v, once_d = values[~several], of[~several]
                shared = np.unique(values[several])
                shift = np.uint64(64 - bits)
                block_once, block_shared = (once_v >> shift).astype(np.int64), (shared >> shift).astype(np.int64)
                order = np.lexsort((once_d, block_once))
                once_v, once_d, block_once = once_v[order], once_d[order], block_once[order]
                at = np.searchsorted(block_once, np.arange((1 << bits) + 1))
                at_shared = np.searchsorted(block_shared, np.arange((1 << bits) + 1))
                keys, docs, counts, vals, multi = [], [], [], [], []
                ids = part["doc_id"]
                local = np.bincount(of[several], minlength=len(sets))
                if len(shared):
                    held = np.nonzero(local)[0]
                    keys.append(-1 - zlib.crc32(repr(ids[0].as_py()).encode()) % 65536)
                    docs.append(held)
                    counts.append(local[held])
                    vals.append(b"")
                    multi.append(b"")
                low = np.uint64(bits)
                for b in range(1 << bits):
                    i, j = at[b], at[b + 1]
                    if j > i or at_shared[b + 1] > at_shared[b]:
                        held, n = np.unique(once_d[i:j], return_counts=True)
                        keys.append(b)
                        docs.append(held)
                        counts.append(n)
                        vals.append(((once_v[i:j] << low) >> np.uint64(32)).astype("<u4").tobytes())
                        multi.append(((shared[at_shared[b]:at_shared[b + 1]] << low) >> np.uint64(32)).astype("<u4").tobytes())
                if not keys:
                    continue
                ends = pa.array(np.concatenate(([0], np.cumsum([len(d) for d in docs]))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()),
                     pa.ListArray.from_arrays(ends, ids.take(pa.array(np.concatenate(docs).astype(np.int64)))),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate(counts).astype(np.int32))),
                     binaries(vals), binaries(multi)], ["block", "docs", "counts", "vals", "multi"])

    def answer(table):
        docs = pc.list_flatten(table["docs"]).combine_chunks()
        counts = pc.list_flatten(table["counts"]).combine_chunks().to_numpy(zero_copy_only=False)
        if table["block"][0].as_py() < 0:
            got = counts
        else:
            vals = np.frombuffer(b"".join(table["vals"].to_pylist()), "<u4")
            multi = np.frombuffer(b"".join(table["multi"].to_pylist()), "<u4")
            order = np.sort(vals)
            again = np.union1d(order[1:][order[1:] == order[:-1]], multi)
            hit = np.concatenate(([0], np.cumsum(np.isin(vals, again))))
            ends = np.cumsum(counts)
            got = hit[ends] - hit[ends - counts]
        some = got > 0
        return pa.table([docs.filter(pa.array(some)), pa.array(got[some].astype(np.int64))], ["doc_id", "repeated"])

    rows = source.mapInArrow(tidied(send), f"block long, docs array<{kind}>, counts array<int>, vals binary, multi binary")
    return (rows.groupBy("block").applyInArrow(answer, f"doc_id {kind}, repeated long")
            .groupBy("doc_id").agg(F.sum("repeated").alias("repeated")))


def _tokens(source: DataFrame, k: int) -> DataFrame:
    """doc_id, n, tokens and a parity sketch of each set.

    Each token flips one bit of the sketch. Bits in which two sketches differ come
    from tokens that only one set has, so they bound the difference from below.
    """
    def make(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(texts_of(part, "text"), k)
                sketches = []
                for s in sets:
                    place = mix(s) % np.uint64(64 * _SKETCH)
                    odd = np.bincount(place.astype(np.int64), minlength=64 * _SKETCH) % 2
                    sketches.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
                cells = np.array(sketches, np.int64).reshape(len(sets), _SKETCH)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]
                    + [pa.array(cells[:, j]) for j in range(_SKETCH)],
                    ["doc_id", "n", "tokens"] + [f"s{j}" for j in range(_SKETCH)])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(tidied(make), f"doc_id {kind}, n long, tokens array<long>, "
                             + ", ".join(f"s{j} long" for j in range(_SKETCH)))


def signatures(n: int, tokens: np.ndarray, freq: np.ndarray, percent: int) -> list[int]:
    """Signatures of a set of ``n`` tokens, given those that other sets hold too, rarest first.

    A partner misses at most tau of the tokens, so any tau + 1 of them hold a
    common one. Tokens held by no other set cover without a signature. A rare
    token covers one and is a signature alone. Frequent tokens are dealt to
    classes; only pairs within a class are signatures, so the first token of each
    class covers nothing and the prefix goes on until tau + 1 are covered. The
    number of classes follows the size, in powers of two; a set uses the scheme of
    its own size and that of the smallest partner, so that any two share one.
    """
    need = n - -(-percent * n // 100) + 1 - (n - len(tokens))
    if need <= 0 or n < 2:
        return []
    out: set[int] = set()
    for scheme in {n.bit_length(), (-(-percent * n // 100)).bit_length()}:
        classes = max(1, (1 << scheme) // 40)
        covered, members = 0, {}
        for t, f in zip(tokens.tolist(), freq.tolist()):
            if f <= _FREQUENT:
                covered += 1
                out.add(t)
            else:
                own = members.setdefault((t >> 20) % classes, [])
                covered += bool(own)
                for other in own:
                    out.add(hash((scheme, min(t, other), max(t, other))))
                own.append(t)
            if covered >= need:
                break
    return sorted(out)


def _signature_rows(sets: DataFrame, percent: int) -> DataFrame:
    """sig, doc_id, n, central: every signature of every set; ``central`` is the mean frequency of its tokens."""
    kind = sets.schema["doc_id"].dataType.simpleString()
    tokens = sets.select("doc_id", F.explode("tokens").alias("token"))
    freq = tokens.groupBy("token").agg(F.count(F.lit(1)).cast("int").alias("freq")).where("freq > 1")
    shared = (tokens.join(freq, "token").groupBy("doc_id").agg(F.collect_list(F.struct("freq", "token")).alias("shared"))
              .join(sets.select("doc_id", "n"), "doc_id"))

    def make(batches):
        for batch in batches:
            ids, sizes, sigs, central = [], [], [], []
            for i, (n, row) in enumerate(zip(batch["n"].to_pylist(), batch["shared"])):
                inner = row.values
                freq_ = pc.struct_field(inner, 0).to_numpy(zero_copy_only=False)
                token = pc.struct_field(inner, 1).to_numpy(zero_copy_only=False)
                order = np.lexsort((token, freq_))
                own = signatures(n, token[order], freq_[order], percent)
                ids += [i] * len(own)
                sizes += [n] * len(own)
                sigs += own
                central += [int(freq_.sum() * 16 // n)] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sigs, pa.int64()), batch["doc_id"].take(pa.array(ids, pa.int64())), pa.array(sizes, pa.int64()),
                 pa.array(central, pa.int64())], ["sig", "doc_id", "n", "central"])

    return shared.mapInArrow(tidied(make), f"sig long, doc_id {kind}, n long, central long")


def _close(a: str, b: str, percent: int) -> Column:
    """Whether sizes and sketches of two sides allow the similarity."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = sum((F.bit_count(F.col(f"{a}.s{j}").bitwiseXOR(F.col(f"{b}.s{j}"))) for j in range(_SKETCH)), F.lit(0))
    # Jaccard >= p exactly when (1 + p) * difference <= (1 - p) * (sum of the sizes).
    return ((100 * F.least(na, nb) >= percent * F.greatest(na, nb))
            & ((100 + percent) * differ <= (100 - percent) * (na + nb)))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar, by their tokens."""
    full = sets.select("doc_id", "tokens")
    both = (pairs.join(full.select(F.col("doc_id").alias("a"), F.col("tokens").alias("ta")), "a")
            .join(full.select(F.col("doc_id").alias("b"), F.col("tokens").alias("tb")), "b"))

    def test(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch["ta"], batch["tb"]):
                x, y = x.values.to_numpy(zero_copy_only=False), y.values.to_numpy(zero_copy_only=False)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = sets.schema["doc_id"].dataType.simpleString()
    return both.select("a", "b", "ta", "tb").mapInArrow(tidied(test), f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 4,
                    percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    Two documents link when the Jaccard similarity of their sets of ``k``-word
    shingles is ``percent`` or more; component_id is the smallest id reachable by
    links. A null or empty text has no shingle and no link. Ids are taken to be
    unique, but for rows that repeat a document as a whole, which get one answer
    each; a null id gets a null component. Nothing is capped.

    1. Equal sets become one, that of the smallest id.
    2. Every shingle of the corpus is counted. A set of which a partner could not
       hold ``percent`` of the tokens is done; what is left, near copies mostly,
       goes on with its tokens.
    3. Prefix signatures (see ``signatures``).
    4. Each signature's most central set is compared with its other holders, which
       links groups of near copies with one row per holder; components follow.
    5. Signatures whose holders lie in several components pair sets of different
       components that sizes and sketches allow; these are compared too.
    """
    source = clear_of(docs, doc_id, text).toDF("doc_id", "text")
    sizes = materialise(_sizes(source, k), "sizes")
    firsts = (sizes.where("n > 0 AND doc_id IS NOT NULL").groupBy("set_hash", "n").agg(F.min("doc_id").alias("first")))
    firsts = materialise(firsts, "firsts")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    repeated = _repeated(source.where("doc_id IS NOT NULL"), k, total)
    open_ = (firsts.join(repeated.withColumnRenamed("doc_id", "first"), "first")
             .where(F.col("repeated") * 100 >= percent * F.col("n")).select(F.col("first").alias("doc_id")))
    sets = materialise(_tokens(source.join(open_.hint("merge"), "doc_id", "left_semi"), k).dropDuplicates(["doc_id"]), "sets")
    rows = materialise(_signature_rows(sets, percent), "signatures")
    sketches = materialise(sets.drop("tokens"), "sketches")

    centre = (rows.groupBy("sig").agg(F.max(F.struct("central", "doc_id")).alias("top"), F.count(F.lit(1)).alias("holders"))
              .where("holders > 1").select("sig", F.col("top.doc_id").alias("centre")))
    spokes = (rows.join(centre, "sig").where("doc_id <> centre")
              .select(F.least("doc_id", "centre").alias("a"), F.greatest("doc_id", "centre").alias("b")).distinct())
    allowed = (spokes.join(sketches.alias("x"), F.col("a") == F.col("x.doc_id"))
               .join(sketches.alias("y"), F.col("b") == F.col("y.doc_id")).where(_close("x", "y", percent)).select("a", "b"))
    links = materialise(_verified(allowed, sets, percent), "links")
    part = materialise(components(links), "parts")

    placed = (rows.select("sig", "doc_id").join(part.withColumnRenamed("node", "doc_id"), "doc_id", "left")
              .withColumn("component", F.coalesce("component", "doc_id")))
    placed = materialise(placed, "placed")
    mixed = (placed.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low < high").select("sig"))
    rest = materialise(placed.join(mixed, "sig").join(sketches, "doc_id"), "rest")
    across = (rest.alias("x").join(rest.alias("y"), (F.col("x.sig") == F.col("y.sig"))
                                   & (F.col("x.component") < F.col("y.component")) & _close("x", "y", percent))
              .select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"),
                      F.col("x.component").alias("ca"), F.col("y.component").alias("cb")).distinct())
    across = materialise(across, "across")
    more = across.join(_verified(across.select("a", "b"), sets, percent), ["a", "b"]).select(
        F.col("ca").alias("a"), F.col("cb").alias("b"))
    merged = components(more)
    part = (part.join(merged.toDF("component", "final"), "component", "left")
            .select("node", F.coalesce("final", "component").alias("component"))
            .unionByName(merged.join(part, merged["node"] == part["node"], "left_anti").select("node", "component")))
    reach = firsts.join(part.withColumnRenamed("node", "first"), "first", "left").select(
        "set_hash", "n", F.coalesce("component", "first").alias("component"))
    return (sizes.join(reach, ["set_hash", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")))
