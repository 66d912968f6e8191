"""Molecule graphs as node and edge tables."""

from __future__ import annotations

from hashlib import md5
from math import sin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.operators.joins import hot_keys, skew_join
from assayloom.session import materialise

_BUCKET = 1 << 19    # nodes and edges that a bucket of graphs has on average, and the most of a graph in one
_PACKED = 1 << 21    # nodes and edges that a task deals to the buckets at once


def nodes_of(mols: DataFrame, atoms: str = "atoms", graph: str = "graph_id") -> DataFrame:
    """(graph_id, node_id, symbol) from atom arrays."""
    # Before a plain explode Catalyst filters by the array's size, for which it makes the array once more or twice.
    return mols.select(graph, F.posexplode_outer(atoms).alias("node_id", "symbol")).where("node_id is not null")


def edges_of(mols: DataFrame, bonds: str = "bonds", graph: str = "graph_id") -> DataFrame:
    """(graph_id, src, dst) from bond arrays."""
    ends = mols.select(graph, F.posexplode_outer(bonds).alias("_place", "_bond")).where("_place is not null")
    return ends.select(graph, "_bond.*")


def simple_edges(edges: DataFrame, graph: str = "graph_id") -> DataFrame:
    """Undirected edges: each pair once, lower end first."""
    return edges.select(
        graph, F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")
    ).distinct()


def graph_nodes(edges: DataFrame, nodes: DataFrame | None = None, graph: str = "graph_id") -> DataFrame:
    """All node ids: listed nodes and edge ends."""
    ends = edges.select(graph, F.explode(F.array("src", "dst")).alias("node_id"))
    if nodes is not None:
        ends = ends.unionByName(nodes.select(graph, "node_id"))
    return ends.distinct()


def graph_size(nodes: DataFrame, edges: DataFrame, graph: str = "graph_id") -> DataFrame:
    """(graph_id, n_nodes, n_edges), from one grouped pass over both tables."""
    marks = nodes.select(graph, F.lit(1).alias("n"), F.lit(0).alias("e")).unionByName(
        edges.select(graph, F.lit(0).alias("n"), F.lit(1).alias("e"))
    )
    return marks.groupBy(graph).agg(F.sum("n").alias("n_nodes"), F.sum("e").alias("n_edges"))


def array_sizes(mols: DataFrame, atoms: str = "atoms", bonds: str = "bonds", graph: str = "graph_id") -> DataFrame:
    """(graph_id, n_nodes, n_edges) of graphs still held as arrays."""
    return mols.select(graph, F.size(atoms).cast("long").alias("n_nodes"), F.size(bonds).cast("long").alias("n_edges"))


def _hash60(text: Column) -> Column:
    """The first 60 bits of a text's md5 as a whole number."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


_HALF = 30          # a label is summed as two halves of this many bits, so sums stay within a long


def neighbourhood_labels(
    nodes: DataFrame, edges: DataFrame, radius: int = 2, graph: str = "graph_id"
) -> DataFrame:
    """(graph_id, node_id, round, label) for rounds 0..radius.

    Round 0 hashes a node's symbol. Each further round hashes the node's label
    with the sum of its neighbours' labels. Graphs are dealt whole to buckets of
    about ``_BUCKET`` nodes and edges, which move once, compressed, and go through
    all rounds in their bucket. A graph that is larger by itself, or has no id, is
    never gathered: its rounds are joins and groupings (``_joined_labels``).
    """
    ends = edges.select(graph, F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
    marks = nodes.select(graph, F.col("node_id").alias("a"), F.coalesce(F.col("symbol").cast("string"), F.lit("")).alias("symbol"))
    ends = ends.where("a is not null")
    both = marks.select(graph, "a").unionByName(ends.select(graph, "a"))
    sizes = materialise(both.groupBy(graph).agg(F.count(F.lit(1)).alias("n")), "graph-sizes")
    wide = sizes.where((F.col("n") > _BUCKET) | F.col(graph).isNull()).select(F.col(graph).alias("_wide"))
    apart = not wide.isEmpty()
    if apart:
        # At most one graph for every _BUCKET rows.
        met = F.col(graph).eqNullSafe(F.col("_wide"))
        marks, ends = [df.join(F.broadcast(wide), met, "left_anti") for df in (marks, ends)]
    total = sizes.where(F.col("n") <= _BUCKET).agg(F.sum("n").alias("n")).first()["n"] or 0
    out = _bucketed_labels(marks, ends, both.schema, radius, graph, -(-total // _BUCKET) or 1)
    if not apart:
        return out
    large = [df.join(F.broadcast(wide), met, "left_semi") for df in (nodes, edges)]
    return out.unionByName(_joined_labels(*large, radius, graph))


def _bucketed_labels(nodes: DataFrame, ends: DataFrame, kinds: T.StructType, radius: int, graph: str, buckets: int) -> DataFrame:
    """Labels of graphs that fit a bucket, from nodes (a, symbol) and edges (a, b).

    Nodes and edges go to the buckets as tables of their own: Spark weighs every column of every row on its way to Python.
    """
    schema = T.StructType([
        T.StructField(graph, kinds[graph].dataType), T.StructField("node_id", kinds["a"].dataType),
        T.StructField("round", T.IntegerType()), T.StructField("label", T.LongType())])

    def label(table):
        return _label_bucket(table["rows"], radius, graph)

    def packed(df, *columns):
        own = F.col(graph).cast(kinds[graph].dataType)
        bucket = F.pmod(F.xxhash64(own), F.lit(buckets)).cast("int").alias("bucket")
        return df.select(bucket, own.alias(graph), *columns).mapInArrow(_packed, "bucket int, rows binary")

    a, b = (F.col(c).cast(kinds["a"].dataType).alias(c) for c in "ab")
    return (packed(nodes, a, "symbol").unionByName(packed(ends, a, b))
            .repartition(buckets, "bucket").groupBy("bucket").applyInArrow(label, schema))


def _packed(batches):
    """Rows by bucket, each bucket's as one compressed Arrow stream for every ``_PACKED`` rows read."""
    import numpy as np
    import pyarrow as pa

    def streams(held):
        table = pa.Table.from_batches(held)
        bucket = table["bucket"].to_numpy()
        # Small numbers are sorted by digits.
        order = np.argsort(bucket.astype(np.int16) if bucket.max() < 1 << 15 else bucket, kind="stable")
        table, bucket = table.drop_columns("bucket").take(order).combine_chunks(), bucket[order]
        cuts = np.concatenate(([0], np.nonzero(np.diff(bucket))[0] + 1, [len(bucket)]))
        for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(table.slice(start, stop - start))
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket[start]], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["bucket", "rows"])

    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= _PACKED:
            yield from streams(held)
            held, n = [], 0
    if held:
        yield from streams(held)


_SINES = [int(abs(sin(i + 1)) * 2**32) for i in range(64)]
_TURNS = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_BLOCK = 64         # bytes of a block of md5; a text of up to 55 bytes is one block
_SLICE = 1 << 14    # texts hashed at a time: their numbers stay within a core's cache


def _block_hashes(blocks, sizes):
    """``_hash60`` of texts of up to 55 bytes, each in a row of ``_BLOCK`` bytes with zeros behind it; md5 for many texts at once."""
    import numpy as np

    most = sizes.max(initial=0)
    blocks[np.arange(len(blocks)), sizes] = 0x80
    words = blocks.view("<u4")
    words[:, 14] = sizes << 3
    used = [4 * k <= most or k == 14 for k in range(16)]
    out = np.empty(len(blocks), np.int64)
    sines, turns = np.array(_SINES, np.uint32), np.arange(33, dtype=np.uint32)
    begin = np.array([0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476], np.uint32)
    for start in range(0, len(blocks), _SLICE):
        part = np.ascontiguousarray(words[start:start + _SLICE].T)
        a, b, c, d = (np.full(part.shape[1], x) for x in begin)
        f, g = np.empty_like(a), np.empty_like(a)
        for i in range(64):
            if i < 16:
                k = i
                np.bitwise_xor(c, d, out=f)
                f &= b
                f ^= d
            elif i < 32:
                k = (5 * i + 1) % 16
                np.bitwise_xor(b, c, out=f)
                f &= d
                f ^= c
            elif i < 48:
                k = (3 * i + 5) % 16
                np.bitwise_xor(b, c, out=f)
                f ^= d
            else:
                k = 7 * i % 16
                np.invert(d, out=f)
                f |= b
                f ^= c
            f += a
            f += sines[i]
            if used[k]:
                f += part[k]
            turn = _TURNS[i // 16][i % 4]
            np.right_shift(f, turns[32 - turn], out=g)
            f <<= turns[turn]
            f |= g
            f += b
            a, b, c, d, f = d, f, b, c, a
        a += begin[0]
        b += begin[1]
        out[start:start + _SLICE] = a.byteswap().astype(np.int64) << 28 | b.byteswap() >> np.uint32(4)
    return out


def _text_hashes(texts):
    """``_hash60`` of an Arrow array of texts."""
    import numpy as np
    import pyarrow as pa

    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    out, starts, sizes = np.empty(len(texts), np.int64), offsets[:-1], np.diff(offsets)
    for i in np.nonzero(sizes > 55)[0].tolist():
        out[i] = int.from_bytes(md5(data[starts[i]:offsets[i + 1]]).digest()[:8], "big") >> 4
    for size in np.unique(sizes[sizes <= 55]).tolist():
        rows = np.nonzero(sizes == size)[0]
        blocks = np.zeros((len(rows), _BLOCK), np.uint8)
        blocks[:, :size] = data[starts[rows, None] + np.arange(size)]
        out[rows] = _block_hashes(blocks, np.full(len(rows), size))
    return out


def _number_hashes(r: int, label, high, low):
    """``_hash60`` of the texts "r:label:high:low"."""
    import numpy as np

    fours = np.array([b"%04d" % i for i in range(10_000)]).view(np.uint32)
    tens = 10 ** np.arange(1, 19)
    columns, prefix = (label, high, low), np.frombuffer(b"%d:" % r, np.uint8)
    widths = [np.searchsorted(tens, x, "right") + 1 for x in columns]
    # Texts of like widths lie together, so that each of their parts is one copy.
    kinds = (widths[0] * 20 + widths[1]) * 20 + widths[2]
    order = np.argsort(kinds.astype(np.int16), kind="stable")
    kinds = kinds[order]
    digits = []
    for x in columns:
        rest, places = x[order], np.empty((len(x), 5), np.uint32)
        for k in range(4, -1, -1):
            left = rest // 10_000
            places[:, k] = fours[rest - left * 10_000]
            rest = left
        digits.append(places.view(np.uint8))
    found = np.empty(len(label), np.int64)
    blocks, sizes, fits = np.zeros((len(label), _BLOCK), np.uint8), np.zeros(len(label), np.int64), np.ones(len(label), bool)
    cuts = np.concatenate(([0], np.nonzero(np.diff(kinds))[0] + 1, [len(kinds)])) if len(kinds) else np.zeros(1, np.int64)
    for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        kind = int(kinds[start])
        parts = kind // 400, kind // 20 % 20, kind % 20
        size = len(prefix) + sum(parts) + 2
        if size > 55:
            texts = [b"%d:%d:%d:%d" % (r, *t) for t in zip(*(x[order[start:stop]].tolist() for x in columns))]
            found[order[start:stop]] = [int.from_bytes(md5(t).digest()[:8], "big") >> 4 for t in texts]
            fits[start:stop] = False
            continue
        block, at = blocks[start:stop], len(prefix)
        block[:, :at] = prefix
        for k, (width, places) in enumerate(zip(parts, digits)):
            if k:
                block[:, at] = ord(":")
                at += 1
            block[:, at:at + width] = places[start:stop, 20 - width:]
            at += width
        sizes[start:stop] = size
    if fits.all():
        found[order] = _block_hashes(blocks, sizes)
    else:
        found[order[fits]] = _block_hashes(blocks[fits], sizes[fits])
    return found


def _label_bucket(streams, radius: int, graph: str):
    """All rounds' labels of the whole graphs in a bucket; what ``_joined_labels`` gives for them."""
    import numpy as np
    import pyarrow as pa

    def whole(column):
        return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column

    def numbers(column):
        return whole(column).indices.to_numpy(zero_copy_only=False).astype(np.int64)

    tables = [pa.ipc.open_stream(s.as_buffer()).read_all() for s in streams]
    none = tables[0].select([graph, "a"]).slice(0, 0)
    nodes, edges = (pa.concat_tables([t for t in tables if name in t.column_names] or [none.append_column(name, empty)])
                    for name, empty in (("symbol", pa.array([], pa.string())), ("b", none["a"])))
    graphs = pa.concat_arrays([whole(nodes[graph]), whole(edges[graph])]).dictionary_encode(null_encoding="encode")
    owner = numbers(graphs)
    n, m = nodes.num_rows, edges.num_rows
    ids = pa.concat_arrays([whole(nodes["a"]), whole(edges["a"]), whole(edges["b"])]).dictionary_encode(null_encoding="encode")
    places, ids = numbers(ids), len(ids.dictionary)
    # A node is known by its graph's and its own number; nodes may be listed more than once.
    listed, first, own = np.unique(owner[:n] * ids + places[:n], return_index=True, return_inverse=True)
    symbols = whole(nodes["symbol"]).dictionary_encode()
    given = _text_hashes(symbols.dictionary)[symbols.indices.to_numpy()] if n else np.zeros(0, np.int64)
    label, high, low = (np.zeros(len(listed), np.int64) for _ in range(3))
    np.maximum.at(label, own, given)
    np.add.at(high, own, given >> _HALF)
    np.add.at(low, own, given & ((1 << _HALF) - 1))

    of = owner[n:] * ids
    a, b = of + places[n:n + m], of + places[n + m:]
    at_a, at_b, last = np.searchsorted(listed, a), np.searchsorted(listed, b), max(0, len(listed) - 1)
    known = (listed[np.minimum(at_a, last)] == a) & (listed[np.minimum(at_b, last)] == b) if len(listed) else np.zeros(m, bool)
    pairs = np.sort(at_a[known] * (last + 1) + at_b[known])
    a, b = np.divmod(pairs[np.diff(pairs, prepend=-1) > 0], last + 1)
    bent = a != b
    node, near = np.concatenate([a, b[bent]]), np.concatenate([b, a[bent]])

    found, at = [given], [np.arange(n)]
    for r in range(1, radius + 1):
        sums = np.zeros((2, len(listed)), np.int64)
        np.add.at(sums[0], node, high[near])
        np.add.at(sums[1], node, low[near])
        label = _number_hashes(r, label, *sums)
        high, low = label >> _HALF, label & ((1 << _HALF) - 1)
        found.append(label)
        at.append(first)
    named = nodes.select([graph, "a"]).take(np.concatenate(at))
    rounds = np.repeat(np.arange(radius + 1, dtype=np.int32), [len(f) for f in found])
    return pa.Table.from_arrays([named[graph], named["a"], pa.array(rounds), pa.array(np.concatenate(found))],
                                [graph, "node_id", "round", "label"])


def _joined_labels(nodes: DataFrame, edges: DataFrame, radius: int, graph: str) -> DataFrame:
    """Labels of graphs of any size.

    A sum does not depend on order and
    combines on the map side, so a hub with a third of all edges is never
    gathered in one place; the join that brings labels to edges salts such hubs.
    A round is one such join and one grouping, in which a node's own label and
    its neighbours' labels arrive together.
    """
    back = F.struct(F.col("dst").alias("node_id"), F.col("src").alias("near"))
    there = F.struct(F.col("src").alias("node_id"), F.col("dst").alias("near"))
    ends = materialise(
        simple_edges(edges, graph).select(
            graph, F.inline(F.when(F.col("src") == F.col("dst"), F.array(there)).otherwise(F.array(there, back)))
        ),
        "edges",
    )
    hubs = hot_keys(ends.select(graph, "near"), [graph, "near"])
    labels = materialise(
        nodes.select(graph, "node_id", _hash60(F.coalesce("symbol", F.lit(""))).alias("label")), "labels"
    )
    rounds = [labels.withColumn("round", F.lit(0))]
    for r in range(1, radius + 1):
        near = labels.select(graph, F.col("node_id").alias("near"), F.col("label").alias("h"))
        seen = skew_join(ends, near, [graph, "near"], "inner", spread=[graph, "node_id"], hot=hubs)
        own = labels.select(graph, "node_id", "label", F.lit(0).cast("long").alias("h"))
        both = own.unionByName(seen.select(graph, "node_id", F.lit(None).cast("long").alias("label"), "h"))
        sums = both.groupBy(graph, "node_id").agg(
            F.max("label").alias("label"),
            F.sum(F.shiftright("h", _HALF)).alias("high"),
            F.sum(F.col("h").bitwiseAND(F.lit((1 << _HALF) - 1))).alias("low"),
        )
        text = F.concat_ws(":", F.lit(str(r)), F.col("label").cast("string"),
                           F.col("high").cast("string"), F.col("low").cast("string"))
        labels = materialise(
            sums.where(F.col("label").isNotNull()).select(graph, "node_id", _hash60(text).alias("label")), "labels"
        )
        rounds.append(labels.withColumn("round", F.lit(r)))
    out = rounds[0]
    for part in rounds[1:]:
        out = out.unionByName(part)
    return out.select(graph, "node_id", "round", "label")


def _words(labels: DataFrame, n_bits: int, graph: str) -> DataFrame:
    """(graph_id, word, mask): set positions, 64 to a number, combined on the map side."""
    return labels.select(graph, F.pmod(F.col("label"), F.lit(n_bits)).cast("int").alias("bit")).select(
        graph, F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, bit & 63)").alias("mask")
    ).groupBy(graph, "word").agg(F.bit_or("mask").alias("mask"))


def fingerprint_bits(labels: DataFrame, n_bits: int = 2048, graph: str = "graph_id") -> DataFrame:
    """(graph_id, bit): the set positions of each graph's fingerprint."""
    places = _words(labels, n_bits, graph).withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(63))))
    return places.where(F.getbit("mask", "place") == 1).select(graph, (F.col("word") * 64 + F.col("place")).alias("bit"))


def fingerprints(labels: DataFrame, n_bits: int = 2048, graph: str = "graph_id") -> DataFrame:
    """(graph_id, bits) with bits an int array of length ``n_bits``.

    Positions are combined, 64 to a number, before they are gathered, so a graph of
    any size brings at most ``n_bits / 64`` numbers together.
    """
    words = F.map_from_entries(F.collect_list(F.struct("word", "mask")))
    on = _words(labels, n_bits, graph).groupBy(graph).agg(words.alias("words"))
    bits = F.transform(F.sequence(F.lit(0), F.lit(n_bits - 1)), lambda i: F.coalesce(
        F.getbit(F.col("words")[F.shiftright(i, 6)], i.bitwiseAND(F.lit(63))).cast("int"), F.lit(0)))
    return on.select(graph, bits.alias("bits"))
