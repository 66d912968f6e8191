"""Approximate nearest neighbours: an inverted multi-index over two vector halves."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.session import materialise


@dataclass(frozen=True)
class MultiIndex:
    """Centroids of both halves, entries per cell (centroid pair), and the share of entries to visit."""

    first: np.ndarray
    second: np.ndarray
    entries: np.ndarray
    share: float
    least: int
    sample: np.ndarray
    sample_ids: np.ndarray
    sample_cells: np.ndarray


def usable(vector: Column, size: int | None = None) -> Column:
    """Neither null nor zero, every component a finite number, and of length ``size`` if given."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    ok = vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)
    return ok if size is None else ok & (F.size(vector) == size)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.stack([((points - c) ** 2).sum(axis=1) for c in centres], axis=1)


def _centroids(points: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Plain k-means from evenly spaced starting points."""
    centres = points[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)].copy()
    for _ in range(rounds):
        near = _squared(points, centres).argmin(axis=1)
        for j in range(len(centres)):
            own = points[near == j]
            if len(own):
                centres[j] = own.mean(axis=0)
    return centres


def cells_by_distance(d1: np.ndarray, d2: np.ndarray, entries: np.ndarray, wanted: float) -> list[int]:
    """Non-empty cells in order of summed distance until ``wanted`` entries are reached.

    A heap holds the border of the visited part of the two sorted distance lists;
    a pair enters once both its predecessors have left.
    """
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    s1, s2, one, two = d1[o1].tolist(), d2[o2].tolist(), o1.tolist(), o2.tolist()
    heap, out, got = [(s1[0] + s2[0], 0, 0)], [], 0
    reached = [0] * len(two)  # how many first-half places have left, per second-half place
    while heap and got < wanted:
        _, i, j = heapq.heappop(heap)
        n = int(entries[one[i], two[j]])
        if n:
            out.append(one[i] * len(two) + two[j])
            got += n
        reached[j] = i + 1
        if i + 1 < len(one) and (j == 0 or reached[j - 1] > i + 1):
            heapq.heappush(heap, (s1[i + 1] + s2[j], i + 1, j))
        if j + 1 < len(two) and reached[j + 1] == i:
            heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))
    return out


def build(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = 32, sample: int = 8192,
          recall: float = 0.95, neighbours: int = 10, least: int = 2000) -> tuple[MultiIndex | None, DataFrame | None]:
    """(index, entries): codebooks from a sample, every usable vector assigned to its cell.

    The sample (about ``sample`` vectors of the smallest id hash) fits the centroids
    and the share of entries a search visits: that which reaches ``recall`` among
    the sample's own neighbours, whose distances exceed those in the whole table.
    ``least`` entries are visited in any case, so small tables are searched whole.
    """
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector")).where(
        usable(F.col("vector")) & F.col("vec_id").isNotNull())
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if sizes is None:
        return None, None
    size, total = sizes["size"], sizes["count"]
    rows = rows.where(F.size("vector") == size)
    span = 1 << 30
    picked = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(span)) < int(span * min(1.0, sample / total)) + 1).toPandas()
    if not len(picked):
        picked = rows.limit(1).toPandas()
    picked = picked.sort_values("vec_id")
    points = np.stack([np.asarray(v, np.float64) for v in picked["vector"]])
    half = max(1, size // 2)
    first = _centroids(points[:, :half], k)
    second = _centroids(points[:, half:], k) if size > 1 else np.zeros((1, 0))
    columns = len(second)

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                m = _matrix(batch["vector"], size)
                cell = _squared(m[:, :half], first).argmin(axis=1) * columns + _squared(m[:, half:], second).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.LongType())])
    placed = materialise(rows.mapInArrow(assign, schema), "cells")
    entries = np.zeros(len(first) * columns, np.int64)
    for r in placed.groupBy("cell").count().collect():
        entries[r["cell"]] = r["count"]
    entries = entries.reshape(len(first), columns)

    probes = points[np.linspace(0, len(points) - 1, min(200, len(points))).astype(int)]
    d1, d2 = _squared(probes[:, :half], first), _squared(probes[:, half:], second)
    own = _squared(points[:, :half], first).argmin(axis=1) * columns + _squared(points[:, half:], second).argmin(axis=1)
    needed = []
    for p, a, b in zip(probes, d1, d2):
        d = ((points - p) ** 2).sum(axis=1)
        near = np.argsort(d, kind="stable")[1:neighbours + 1]
        order = np.argsort((a[:, None] + b[None]).ravel(), kind="stable")
        behind = np.empty(len(order), np.int64)
        behind[order] = np.cumsum(entries.ravel()[order])
        needed += behind[own[near]].tolist()
    share = float(np.quantile(needed, recall)) / total if needed else 1.0
    return MultiIndex(first, second, entries, min(1.0, share), least, points, picked["vec_id"].to_numpy(), own), placed


def search(queries: DataFrame, index: MultiIndex, entries: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
           neighbours: int = 10, block: int = 2048) -> DataFrame:
    """query_id, rank, vec_id, score: nearest entries of each query, those of its own id left out.

    Score is the Euclidean distance in double precision; ties go to the smaller id.
    Queries go to the cells they visit; a cell of many entries is dealt to parts
    of about ``block``, and so are a cell's queries, so no task meets an unbounded
    cell. A part passes on at most ``neighbours`` entries a query, and none beyond the
    query's bound: the distance of its last neighbour among the sample's entries in
    the cells it visits, which will be found.
    """
    size = index.first.shape[1] + index.second.shape[1]
    half, columns = index.first.shape[1], len(index.second)
    total = int(index.entries.sum())
    wanted = min(total, max(index.least, index.share * total))
    asked = (queries.select(F.col(f"`{vec_id}`").alias("query_id"), F.col(f"`{vector}`").alias("vector"))
             .where(usable(F.col("vector"), size) & F.col("query_id").isNotNull()).dropDuplicates(["query_id"]))
    many = np.maximum(1, -(-index.entries.ravel() // block))
    parts = max(1, -(-asked.count() // block))
    id_kind = asked.schema["query_id"].dataType.simpleString()

    def visit(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(batch["vector"], size)
            ids = batch["query_id"].to_pylist()
            d1, d2 = _squared(m[:, :half], index.first), _squared(m[:, half:], index.second)
            take, cells, part, bounds = [], [], [], []
            for i, q in enumerate(m):
                visited = cells_by_distance(d1[i], d2[i], index.entries, wanted)
                sure = np.isin(index.sample_cells, visited) & (index.sample_ids != ids[i])
                near = np.sort(((index.sample[sure] - q) ** 2).sum(axis=1))
                bound = float(np.sqrt(near[neighbours - 1])) * (1 + 1e-9) if len(near) >= neighbours else float("inf")
                for c in visited:
                    for s in range(int(many[c])):
                        take.append(i)
                        cells.append(c)
                        part.append(s)
                        bounds.append(bound)
            yield pa.RecordBatch.from_arrays(
                [*[c.take(pa.array(take, pa.int64())) for c in batch.columns], pa.array(cells, pa.int64()),
                 pa.array(part, pa.int64()), pa.array(bounds, pa.float64())],
                [*batch.schema.names, "cell", "part", "bound"])

    visits = asked.mapInArrow(visit, T.StructType([
        *asked.schema.fields, T.StructField("cell", T.LongType()), T.StructField("part", T.LongType()),
        T.StructField("bound", T.DoubleType())]))
    visits = visits.withColumn("side", F.pmod(F.xxhash64("query_id"), F.lit(parts)))
    dealt = F.element_at(F.array(*[F.lit(int(v)) for v in many]), (F.col("cell") + 1).cast("int")) if many.max() > 1 else F.lit(1)
    held = (entries.withColumn("part", F.pmod(F.xxhash64("vec_id"), dealt.cast("long")))
            .withColumn("side", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))))

    def compare(left, right):
        out = ([], [], [])
        if left.num_rows and right.num_rows:
            m = _matrix(right["vector"].combine_chunks(), size)
            ids = right["vec_id"].combine_chunks().to_numpy(zero_copy_only=False)
            asked_ = left["query_id"].to_pylist()
            for q, v, bound in zip(asked_, _matrix(left["vector"].combine_chunks(), size), left["bound"].to_pylist()):
                d = np.sqrt(((m - v) ** 2).sum(axis=1))
                near = np.nonzero((d <= bound) & (ids != q))[0]
                near = near[np.lexsort((ids[near], d[near]))][:neighbours]
                out[0].extend([q] * len(near))
                out[1].extend(ids[near].tolist())
                out[2].extend(d[near].tolist())
        return pa.table([pa.array(out[0], left.schema.field("query_id").type), pa.array(out[1], right.schema.field("vec_id").type),
                         pa.array(out[2], pa.float64())], ["query_id", "vec_id", "score"])

    found = (visits.groupBy("cell", "part", "side").cogroup(held.groupBy("cell", "part", "side"))
             .applyInArrow(compare, f"query_id {id_kind}, vec_id {id_kind}, score double"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")


def brute_force(queries: DataFrame, vectors: DataFrame, neighbours: int = 10) -> DataFrame:
    """Exact neighbours of a few queries (held in memory), for measuring recall."""
    asked = [(r[0], np.asarray(r[1], np.float64)) for r in queries.select("vec_id", "embedding").collect()]

    def compare(batches):
        best: dict = {q: [] for q, _ in asked}
        for batch in batches:
            m = _matrix(batch["embedding"], len(asked[0][1]))
            ids = batch["vec_id"].to_numpy(zero_copy_only=False)
            for q, v in asked:
                d = np.sqrt(((m - v) ** 2).sum(axis=1))
                best[q] = sorted(best[q] + [(x, i) for x, i in zip(d.tolist(), ids.tolist()) if i != q])[:neighbours]
        rows = [(q, i, x) for q, near in best.items() for x, i in near]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                          pa.array([r[2] for r in rows], pa.float64())], ["query_id", "vec_id", "score"])

    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return (vectors.select("vec_id", "embedding").mapInArrow(compare, "query_id long, vec_id long, score double")
            .withColumn("rank", rank).where(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score"))
