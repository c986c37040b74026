"""Exact top-k search by inner product with KD-trees per shard.

Vectors are dealt evenly over tasks, once, and then stay where they are; a task cuts its rows into
shards of bounded size. A shard builds a KD-tree: median splits along the widest dimension down to
leaves, every node with the tight bounding box of its vectors. A query goes through the tree best
first: the largest inner product that a box allows, the sum over dimensions of the larger of query *
low and query * high, orders the open nodes, and the search ends once no box can reach the k-th score.

Queries go to the vectors in blocks of bounded size, in two rounds. Every query first searches the shard
of its own row; its k-th score there is the bound from which it starts in all shards. Within a task the
k-th score so far goes on from shard to shard. A task returns at most k rows per query, so the merge by
query is small.

Defined cases: vectors that are null, or hold a null or a non-finite component, take no part, nor
do rows without an id; vectors only meet vectors of their own length; rows that share an id are
the query's own to each other, and each of them asks and is a candidate; equal rows are kept.
Scores beyond 64 bits are cut to the nearest 64-bit number. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webloom.llm import common

K = 5
SCALE = 256
EVERY = 50  # the ids divisible by this ask
# A shard is closed at so many rows or numbers, a block of queries at so many bytes.
SHARD_ROWS = 16_384
SHARD_NUMBERS = 1 << 22
QUERY_BYTES = 32 << 20
LEAF = 256

_LOW, _HIGH = -(2**63), 2**63 - 1


class Best:
    """The k best (score, id) of one query so far."""

    def __init__(self, k: int, least: float):
        self.k, self.least, self.heap = k, least, []  # (score, -id), the worst first

    @property
    def worst(self) -> float:
        return max(self.least, self.heap[0][0]) if len(self.heap) == self.k else self.least

    def add(self, score: int, i: int) -> None:
        entry = (score, -i)
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)


class KdTree:
    """Vectors as rows of a float matrix of whole numbers, in the order of the leaves.

    Node n holds the rows ``begin[n]`` to ``end[n]`` within the box ``low[n]``, ``high[n]``; its children
    are ``child[n]`` and the one after that, or it is a leaf and ``child[n]`` is 0.
    """

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        order, begin, end, self.child = np.arange(len(vectors)), [0], [len(vectors)], [0]
        low, high = [vectors.min(0)], [vectors.max(0)]
        n = 0
        while n < len(begin):
            at = order[begin[n] : end[n]]
            spread = high[n] - low[n]
            if len(at) > leaf and len(spread):
                middle = len(at) // 2
                at = at[np.argpartition(vectors[at, spread.argmax()], middle)]
                order[begin[n] : end[n]] = at
                self.child[n] = len(begin)
                for a, z in ((0, middle), (middle, len(at))):
                    own = vectors[at[a:z]]
                    begin.append(begin[n] + a)
                    end.append(begin[n] + z)
                    low.append(own.min(0))
                    high.append(own.max(0))
                    self.child.append(0)
            n += 1
        self.begin, self.end, self.low, self.high = begin, end, np.array(low), np.array(high)
        self.vectors, self.ids = vectors[order], ids[order]
        self.largest = float(np.abs(vectors).max(initial=0.0))

    @property
    def leaves(self) -> int:
        return self.child.count(0)

    def search(self, query: np.ndarray, own: int, best: Best) -> int:
        """Adds to ``best`` what belongs there; the number of leaves that were opened."""
        # sums of whole numbers below 2**53 are exact in any order; above, bounds get slack
        exact = float(np.abs(query).max(initial=0.0)) * self.largest * max(1, len(query)) < 2**53

        def bounds(nodes: slice) -> np.ndarray:
            # an overflow gives an infinite or undefined bound, and then nothing is ruled out
            with np.errstate(over="ignore", invalid="ignore"):
                bound = np.maximum(self.low[nodes] * query, self.high[nodes] * query).sum(1)
                if not exact:
                    bound = bound + np.abs(bound) * 1e-9 + self.largest * np.abs(query).sum() * 1e-9
            return np.clip(np.where(np.isnan(bound), np.inf, bound), _LOW, _HIGH)  # as scores are cut

        opened = 0
        waiting = [(-float(bounds(slice(0, 1))[0]), 0)]
        while waiting:
            bound, n = heapq.heappop(waiting)
            if -bound < best.worst:
                break
            if c := self.child[n]:
                for i, x in enumerate(bounds(slice(c, c + 2)).tolist()):
                    if x >= best.worst:
                        heapq.heappush(waiting, (-x, c + i))
                continue
            opened += 1
            rows = slice(self.begin[n], self.end[n])
            vectors, ids = self.vectors[rows], self.ids[rows]
            if exact:
                scores = vectors @ query
                likely = np.flatnonzero((scores >= best.worst) & (ids != own))
                for score, i in zip(scores[likely].astype(np.int64).tolist(), ids[likely].tolist()):
                    best.add(score, i)
            else:
                whole = [int(x) for x in query]
                for v, i in zip(vectors, ids.tolist()):
                    if i != own:
                        best.add(min(max(sum(int(a) * b for a, b in zip(v, whole)), _LOW), _HIGH), i)
        return opened


def whole_numbers(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, v, dim) of the rows that take part, components scaled and rounded down."""
    # floor() of a double gives a long: beyond that range a scaled component is whole already
    v = F.transform(
        F.col(vector_column),
        lambda x: F.when(F.abs(x.cast("double")) < 2.0**50, F.floor(x.cast("double") * SCALE).cast("double"))
        .otherwise(x.cast("double") * SCALE),
    )
    sound = F.forall(
        F.col(vector_column),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    return vectors.where(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull() & sound).select(
        F.col(id_column).cast("long").alias("id"), v.alias("v"), F.size(vector_column).alias("dim")
    )


def _shards(
    batches: Iterator[pa.RecordBatch], most_rows: int, most_numbers: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, id, matrix) of rows (row, id, v, dim), gathered by length to a bounded size."""
    held: dict[int, list] = {}
    for batch in batches:
        rows, ids, dims = (batch.column(k).to_numpy() for k in (0, 1, 3))
        values, starts = batch.column(2).flatten().to_numpy(), np.cumsum(dims) - dims
        for dim in np.unique(dims).tolist():
            most = max(1, min(most_rows, most_numbers // max(1, dim)))
            every = np.flatnonzero(dims == dim)
            for at in np.array_split(every, -(-len(every) // most)):
                own = held.setdefault(dim, [])
                if own and sum(len(x[0]) for x in own) + len(at) > most:
                    yield tuple(map(np.concatenate, zip(*held.pop(dim))))
                    own = held.setdefault(dim, [])
                own.append((rows[at], ids[at], values[starts[at][:, None] + np.arange(dim)[None, :]]))
    for own in held.values():
        yield tuple(map(np.concatenate, zip(*own)))


def _meet(rows: DataFrame, queries: dict, k: int, home: bool) -> DataFrame:
    """(ask, score, id) of the k best a task has for each query; with ``home`` only in the shard of its own row.

    ``queries`` are those of a block by length: arrays ask, row, id, least and a matrix.
    """
    sent = rows.sparkSession.sparkContext.broadcast(queries)
    bounds, leaf = (SHARD_ROWS, SHARD_NUMBERS), LEAF

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, Best] = {}
        for numbers, ids, matrix in _shards(batches, *bounds):
            if matrix.shape[1] not in sent.value:
                continue
            asks, own_rows, own_ids, least, vectors = sent.value[matrix.shape[1]]
            some = np.flatnonzero(np.isin(own_rows, numbers)) if home else np.arange(len(asks))
            tree = KdTree(matrix, ids, leaf) if len(some) else None
            for q in some.tolist():
                mine = best.setdefault(int(asks[q]), Best(k, least[q]))
                tree.search(vectors[q], int(own_ids[q]), mine)
        found = [(ask, score, -i) for ask, b in best.items() for score, i in b.heap]
        columns = list(zip(*found)) if found else [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["ask", "score", "id"])

    return rows.select("row", "id", "v", "dim").mapInArrow(run, "ask bigint, score bigint, id bigint")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("ask").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(asked: DataFrame) -> dict:
    """The queries of a block, whose size is bounded, by length."""
    by_dim: dict[int, list] = {}
    for r in asked.collect():
        by_dim.setdefault(r["dim"], []).append(r)
    return {
        dim: [*(np.array([r[c] for r in own], np.int64) for c in ("ask", "row", "id")),
              np.full(len(own), -np.inf), np.array([r["v"] for r in own], float).reshape(len(own), dim)]
        for dim, own in by_dim.items()
    }


def top_k(vectors: DataFrame, asks: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows ``id, v, dim`` where ``asks`` holds."""
    given = common.stored(vectors, "vectors")
    size = given.agg(F.count("*"), F.sum("dim")).first()
    shards = max(1, -(-size[0] // SHARD_ROWS), -(-(size[1] or 0) // SHARD_NUMBERS))
    # dealt in turn whatever the ids and vectors are; the number is written with the row, so it stays the same
    dealt = given.repartition(shards).withColumn("row", F.monotonically_increasing_id())
    rows = common.stored(dealt, "dealt")
    asked = common.stored(rows.where(asks).withColumn("ask", F.monotonically_increasing_id()), "queries")
    taken = asked.agg(F.sum(F.col("dim") * 8 + 64)).first()[0] or 0
    blocks = max(1, -(-taken // QUERY_BYTES))
    found = []
    for b in range(blocks):
        block = _block(asked.where(F.pmod(F.xxhash64("ask"), F.lit(blocks)) == b))
        if shards > 1:
            # the k-th score at home, where there are k; rounded down to a double
            kth = F.when(F.count("*") >= k, F.min("score").cast("double") - F.lit(0.5))
            home = _first(_meet(rows, block, k, True), k).groupBy("ask").agg(kth.alias("least")).collect()
            least = {r["ask"]: r["least"] for r in home if r["least"] is not None}
            for q in block.values():
                q[3] = np.array([least.get(a, -np.inf) for a in q[0].tolist()])
        found.append(common.stored(_first(_meet(rows, block, k, False), k), "found"))
    names = asked.select("ask", F.col("id").alias("query_id"))
    return (
        reduce(DataFrame.unionByName, found)
        .withColumnRenamed("id", "vec_id")
        .join(names, "ask")
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def op9_kd_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of all vectors for every fiftieth."""
    vectors = whole_numbers(common.table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(vectors, F.col("id") % EVERY == 0)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.c, d.c), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v d ON len(q.c) = len(d.c) AND q.vec_id <> d.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
