"""Exact top-k inner products by KD-trees over shards of the vectors."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import stage

#: Vectors of a shard, so of a tree, on average.
SHARD_ROWS = 8192
#: Queries of a block on average.
BLOCK_QUERIES = 4096
LEAF_ROWS = 256
FOUND_DDL = "query_id long, vec_id long, score long"
LONG = (1 << 63) - 1


def _as_long(scores: np.ndarray) -> np.ndarray:
    """Whole numbers of any size stop at the greatest long; doubles here are far below it."""
    return np.clip(scores, -LONG, LONG) if scores.dtype == object else scores


class Tree:
    """Median splits of the widest dimension; every node has a tight box and its least id.

    A node of equal vectors has a box of no width and stays one leaf, whatever its size.
    """

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.vectors, self.ids = vectors, ids
        self.low, self.high, self.least, self.children, self.rows = [], [], [], [], []
        open_nodes = [(self._add(np.arange(len(ids))))]
        while open_nodes:
            node = open_nodes.pop()
            rows = self.rows[node]
            width = self.high[node] - self.low[node]
            if len(rows) <= LEAF_ROWS or not len(width) or not width.max():
                continue
            values = vectors[rows, int(np.argmax(width))]
            middle = np.sort(values)[len(values) // 2]
            below = values < middle if (values < middle).any() else values <= middle
            self.children[node] = (self._add(rows[below]), self._add(rows[~below]))
            self.rows[node] = None
            open_nodes.extend(self.children[node])
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _add(self, rows: np.ndarray) -> int:
        inside = self.vectors[rows]
        self.low.append(inside.min(axis=0))
        self.high.append(inside.max(axis=0))
        self.least.append(self.ids[rows].min())
        self.children.append(None)
        self.rows.append(rows)
        return len(self.rows) - 1

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and node, what no vector of the box exceeds."""
        zero = queries * 0
        return _as_long(np.maximum(queries, zero) @ self.high.T + np.minimum(queries, zero) @ self.low.T)

    def search(self, query: np.ndarray, own: int, bounds: np.ndarray, k: int, worst: tuple | None) -> list[tuple]:
        """Up to k (score, -id) better than ``worst``, nodes with the greatest bound first."""
        best: list[tuple] = []
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if worst is not None and (-bound, -self.least[node]) <= worst:
                if -bound < worst[0]:
                    break  # no box left reaches it
                continue
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(heap, (-bounds[child], child))
                continue
            rows = self.rows[node]
            scores, ids = _as_long(self.vectors[rows] @ query), self.ids[rows]
            fits = ids != own if worst is None else (ids != own) & (scores >= worst[0])
            scores, ids = scores[fits], ids[fits]
            order = np.lexsort((ids, -scores))[:k]
            for score, vec_id in zip(scores[order], ids[order]):
                found = (score, -vec_id)
                if worst is not None and found <= worst:
                    break
                heapq.heappush(best, found)
                if len(best) > k:
                    heapq.heappop(best)
                if len(best) == k and (worst is None or best[0] > worst):
                    worst = best[0]
        return best


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    values = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.floor(values.astype(np.float64) * 256).reshape(len(column), size)


def _by_size(found: pa.Table) -> dict[int, np.ndarray]:
    sizes = np.array([len(v) for v in found["vector"]], np.int64)
    return {int(size): np.flatnonzero(sizes == size) for size in np.unique(sizes)}


def _search_cell(k: int):
    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        held = _by_size(rows)
        for size, at in _by_size(queries).items():
            if size not in held:
                continue
            asked, some = queries.take(at), rows.take(held[size])
            points, wanted = _matrix(some["vector"], size), _matrix(asked["vector"], size)
            largest = float(np.abs(points).max(initial=0)) * float(np.abs(wanted).max(initial=0)) * max(size, 1)
            if largest >= 2.0**52:  # beyond what doubles hold exactly: Python's whole numbers
                points, wanted = (np.vectorize(int, otypes=[object])(m) for m in (points, wanted))
            tree = Tree(points, some["vec_id"].to_numpy())
            for query, own, score, vec_id in zip(
                wanted, asked["vec_id"].to_pylist(), asked["worst_score"].to_pylist(), asked["worst_id"].to_pylist()
            ):
                worst = None if score is None else (score, -vec_id)
                for value, negative in tree.search(query, own, tree.bounds(query[None, :])[0], k, worst):
                    found.append((own, -int(negative), int(value)))
        columns = list(zip(*found)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    return search


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k greatest inner products.

    Both have (vec_id, embedding). Components count as floor(256 * x). A query meets every vector but
    those of its own id; vectors of another length do not count. Ties go to the smaller id. Null ids
    and vectors that are null or hold null or non-finite components take no part; repeated rows count
    once. A query without candidates gives no row. Scores beyond 64 bits stop at the greatest long.

    Vectors are dealt to shards, queries to blocks, both by a hash of the id and of bounded size. A
    query first searches the shard of its own id; its k-th score then bounds the search in all other
    shards, where whole boxes below it are skipped.
    """
    vectors, queries = (_usable(v) for v in (vectors, queries))
    vectors = stage(vectors.dropDuplicates(), "vectors")
    queries = stage(queries.dropDuplicates(), "queries")
    shards, blocks = vectors.count() // SHARD_ROWS + 1, queries.count() // BLOCK_QUERIES + 1
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    dealt = vectors.select(
        "vec_id", "vector", shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    )
    asked = queries.select(
        "vec_id", "vector", shard.alias("home"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"),
    )
    none = F.lit(None).cast("long")

    def meet(wanted: DataFrame) -> DataFrame:
        cells = wanted.groupBy("block", "shard").cogroup(dealt.groupBy("block", "shard"))
        return stage(cells.applyInArrow(_search_cell(k), FOUND_DDL), "found")

    first = meet(asked.select("vec_id", "vector", "block", F.col("home").alias("shard"), none.alias("worst_score"), none.alias("worst_id")))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") == k).select(
        F.col("query_id").alias("vec_id"), F.col("score").alias("worst_score"), F.col("vec_id").alias("worst_id")
    )
    others = asked.join(kth, "vec_id", "left").select(
        "vec_id", "vector", "block", "worst_score", "worst_id", "home",
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
    ).where("shard <> home")
    found = first.unionByName(meet(others))
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _usable(vectors: DataFrame) -> DataFrame:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    vector = F.col("embedding").cast("array<double>")
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", finite)
    )
