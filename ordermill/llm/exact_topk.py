"""Exact top-k by integer inner product: KD-trees per shard, searched best first.

Components x become floor(scale * x) as whole numbers.  Candidates are dealt
into shards of bounded size by a hash of their id, queries into blocks of
bounded size, and each (shard, block) is one task's work.  In a shard, a
KD-tree splits at the median of the widest side and keeps a tight box around
each node; over a box, the largest product with a query is the sum over
dimensions of the larger of q*low and q*high, and nodes are visited in the
order of that bound until it falls below the kth score found.

The kth score is propagated in two rounds.  First each query searches the
shard that its own id falls into; the kth score from there goes along to all
other shards, where everything below it is pruned from the start, so these
return few rows.

Defined results: vectors that are null, or hold null or non-finite components,
take no part.  Vectors of different lengths don't meet.  Ties go to the smaller
id.  Rows with the query's own id are not its candidates; of query rows with
one id the smallest vector asks.  Null ids take no part.  With fewer than k
candidates all are returned; an empty table gives an empty result.  Scores
beyond 64 bits are held at the limits of long.  Other columns are not read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.session import materialize

LEAF = 64
_LONG = np.iinfo(np.int64)


def quantised(vector: Column, scale: int) -> Column:
    """array<bigint> of floor(scale * x), or null where the vector takes no part."""
    finite = F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.when(vector.isNotNull() & finite, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


class KDTree:
    """Points in leaf order, and for each node its range of rows, children and tight box."""

    def __init__(self, points: np.ndarray, ids: np.ndarray) -> None:
        order = np.lexsort((ids,))
        self.begin: list[int] = []
        self.end: list[int] = []
        self.children: list[tuple[int, int] | None] = []
        low, high = [], []
        waiting = [(0, len(ids), -1, 0)]
        while waiting:
            a, b, parent, side = waiting.pop()
            node = len(self.begin)
            if parent >= 0:
                pair = list(self.children[parent])
                pair[side] = node
                self.children[parent] = tuple(pair)
            own = points[order[a:b]]
            low.append(own.min(axis=0))
            high.append(own.max(axis=0))
            self.begin.append(a)
            self.end.append(b)
            if b - a <= LEAF or (low[-1] == high[-1]).all():
                self.children.append(None)
                continue
            self.children.append((-1, -1))
            side_to_cut = int(np.argmax(high[-1] - low[-1]))
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(own[:, side_to_cut], middle)]
            waiting += [(a, a + middle, node, 0), (a + middle, b, node, 1)]
        self.points, self.ids = points[order], ids[order]
        self.low, self.high = np.array(low), np.array(high)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest product that each query (rows) can have in each node (columns)."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query: np.ndarray, own_id: int, bounds: np.ndarray, k: int, at_least: float) -> list[tuple[int, int]]:
        """Up to k (score, id), best first, of scores not below ``at_least``."""
        best: list[tuple[int, int]] = []  # a heap of (score, -id): the worst kept on top
        frontier = [(-bounds[0], 0)]
        while frontier:
            bound, node = heapq.heappop(frontier)
            floor = max(at_least, best[0][0]) if len(best) == k else at_least
            if -bound < floor:
                break
            if self.children[node]:
                for child in self.children[node]:
                    if bounds[child] >= floor:
                        heapq.heappush(frontier, (-bounds[child], child))
                continue
            a, b = self.begin[node], self.end[node]
            scores = self.points[a:b] @ query
            for i in np.flatnonzero(scores >= floor):
                found = (int(scores[i]), -int(self.ids[a + i]))
                if -found[1] == own_id:
                    continue
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        return [(score, -other) for score, other in sorted(best, reverse=True)]


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(len(column), dims)


def _exact(candidates: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if every product and sum is exact in them, else as Python's whole numbers."""
    largest = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (candidates, queries)]
    kind = np.float64 if largest[0] * largest[1] * max(1, candidates.shape[1]) < 2**53 else object
    return candidates.astype(kind), queries.astype(kind)


def search_shard(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """Rows (query_id, vec_id, score) of the queries' best candidates of one shard."""
    found: list[tuple[int, int, int]] = []
    if queries.num_rows and candidates.num_rows:
        dims = len(candidates["vector"][0])
        points, asked = _exact(_matrix(candidates["vector"], dims), _matrix(queries["vector"], dims))
        tree = KDTree(points, candidates["id"].to_numpy())
        bounds = tree.bounds(asked)
        floors = [-math.inf if x is None else x for x in queries["at_least"].to_pylist()]
        for i, own in enumerate(queries["id"].to_pylist()):
            found += [(own, other, min(max(score, _LONG.min), _LONG.max))
                      for score, other in tree.search(asked[i], own, bounds[i], k, floors[i])]
    columns = zip(*found, strict=True) if found else ((), (), ())
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])


def exact_topk(rows: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id",
               vector_col: str = "embedding", shard_rows: int = 16_384, block_rows: int = 4_096) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best candidates of each query."""
    vectors = rows.select(F.col(id_col).cast("bigint").alias("id"), quantised(F.col(vector_col), scale).alias("vector"),
                          F.coalesce(is_query, F.lit(False)).alias("asks"))
    vectors = vectors.filter("id IS NOT NULL AND vector IS NOT NULL").withColumn("dims", F.size("vector"))
    vectors = materialize(vectors, "vectors")
    queries = vectors.filter("asks").groupBy("id", "dims").agg(F.min("vector").alias("vector"))
    queries = queries.groupBy("id").agg(F.min(F.struct("vector", "dims")).alias("q")).select("id", "q.vector", "q.dims")
    queries = materialize(queries, "queries")
    shards = max(1, math.ceil(vectors.count() / shard_rows))
    blocks = max(1, math.ceil(queries.count() / block_rows))

    def home(of: Column) -> Column:
        return F.pmod(F.xxhash64(of), F.lit(shards)).cast("int")

    def block(of: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(7), of), F.lit(blocks)).cast("int")

    # Copies of one row would fall into one shard by their id alone.
    dealt = vectors.select("id", "vector", "dims", F.pmod(F.xxhash64("id", "vector"), F.lit(shards)).cast("int").alias("shard"))
    blocked = queries.withColumn("block", block(F.col("id")))

    def searched(asking: DataFrame, blocks_of_shard: Column) -> DataFrame:
        keys = ["dims", "shard", "block"]
        found_in = dealt.withColumn("block", F.explode(blocks_of_shard))
        return asking.groupBy(*keys).cogroup(found_in.groupBy(*keys)).applyInArrow(
            lambda left, right: search_shard(left, right, k), "query_id bigint, vec_id bigint, score bigint")

    every_block = F.sequence(F.lit(0), F.lit(blocks - 1))
    own = materialize(searched(
        blocked.withColumns({"shard": home(F.col("id")), "at_least": F.lit(None).cast("bigint")}), every_block), "top-own")
    kth = own.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).select(
        F.col("query_id").alias("id"), F.when(F.col("n") >= k, F.col("least")).alias("at_least"))
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != home(F.col("id")))
    abroad = searched(
        blocked.join(kth, "id", "left").withColumn("shard", F.explode(others)), every_block)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return own.unionByName(abroad).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
