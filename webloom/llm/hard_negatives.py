"""Hard negatives: for an anchor and its positives, the closest rows of other labels.

Scores are exact integer inner products, made by Kronecker-packed products (``kronecker``). An
anchor's positives are its best rows of the same label; the negatives of a positive are the best
rows of other labels whose score lies between ``LEAST_PERCENT`` of the positive's and the positive's.

Vectors never move: they are written once and read where they lie. Anchors go to them in blocks of
at most ``ANCHOR_BYTES``, each in two passes: the first gives the positives, the second, with their
scores, the negatives. A task keeps the best so far of every anchor while it reads, so it returns at most
``POSITIVES`` rows an anchor in the first pass and ``NEGATIVES`` rows a positive in the second, and the
merge by anchor is small. Anchors are a stated set of queries, met by all rows in blocks.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take
no part; vectors only meet vectors of their own length; rows that share an id are the anchor's own
to each other, and each of them asks and is a candidate; equal rows are kept. Scores beyond 64 bits
are cut to the nearest 64-bit number. A negative score has no hard negatives. Empty tables give an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webloom.llm import common
from webloom.llm.kronecker import LOW, products

SCALE = 256
EVERY = 100  # the ids divisible by this are anchors
SHIFTED = 7  # the ids divisible by this have the next of LABELS labels
LABELS = 10
POSITIVES = 5
NEGATIVES = 5
LEAST_PERCENT = 80

ANCHOR_BYTES = 32 << 20
# Numbers that a task gathers before it multiplies, and scores that it looks at together.
GATHERED = 1 << 20
TILE = 1 << 21


def labelled(vectors: DataFrame) -> DataFrame:
    """(id, label, v, dim) of the rows that take part; components scaled and rounded down."""
    # floor() of a double gives a long: beyond that range a scaled component is whole already
    v = F.transform(
        "embedding",
        lambda x: F.when(F.abs(x.cast("double")) < 2.0**50, F.floor(x.cast("double") * SCALE).cast("double"))
        .otherwise(x.cast("double") * SCALE),
    )
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % SHIFTED == 0, (label + 1) % LABELS).otherwise(label)
    given = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    return vectors.where(given & sound).select(
        F.col("vec_id").cast("long").alias("id"), moved.alias("label"), v.alias("v"), F.size("embedding").alias("dim")
    )


class Best:
    """The ``k`` best (score, id) of each of many slots: higher scores first, then smaller ids."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.score = np.full((slots, k), LOW, np.int64)
        self.id = np.zeros((slots, k), np.int64)
        self.filled = np.zeros((slots, k), bool)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Take what is among the best; hits below the worst of a full slot are no use, but do no harm."""
        last = self.k - 1
        worst = self.score[slot, last]
        use = ~self.filled[slot, last] | (score > worst) | ((score == worst) & (ids < self.id[slot, last]))
        slot, score, ids = slot[use], score[use], ids[use]
        if not len(slot):
            return
        touched = np.unique(slot)
        held = self.filled[touched]
        slot = np.concatenate([np.repeat(touched, self.k)[held.ravel()], slot])
        score = np.concatenate([self.score[touched][held], score])
        ids = np.concatenate([self.id[touched][held], ids])
        order = np.lexsort((ids, ~score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        keep = place < self.k
        at = slot[keep], place[keep]
        self.score[at], self.id[at], self.filled[at] = score[keep], ids[keep], True

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slot, score, id) of all that is held."""
        slot = np.nonzero(self.filled)[0]
        return slot, self.score[self.filled], self.id[self.filled]


class Anchors:
    """A block of anchors of one length, with the scores of their positives in the second pass."""

    def __init__(self, ask: np.ndarray, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray):
        self.ask, self.ids, self.labels, self.matrix = ask, ids, labels, matrix
        self.positive = np.full((len(ids), POSITIVES), -1, np.int64)  # below zero: no such positive

    @property
    def dim(self) -> int:
        return self.matrix.shape[1]

    def tiles(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray):
        """(first anchor, scores, whether labels agree, whether ids differ) for some anchors at a time."""
        step = max(1, TILE // max(1, len(ids)))
        for a in range(0, len(self.ids), step):
            some = slice(a, a + step)
            same = self.labels[some, None] == labels[None, :]
            yield a, products(self.matrix[some], matrix), same, self.ids[some, None] != ids[None, :]

    def find_positives(self, best: Best, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray) -> None:
        for a, scores, same, other in self.tiles(ids, labels, matrix):
            worst = best.score[a : a + len(scores), -1]
            i, j = np.nonzero(same & other & (scores >= worst[:, None]))
            best.add(a + i, scores[i, j], ids[j])

    def find_negatives(self, best: Best, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray) -> None:
        """``best`` has a slot for every anchor and positive."""
        none = self.positive < 0
        # ceil of so many hundredths, without a product that leaves 64 bits
        least = self.positive // 100 * LEAST_PERCENT - (-(self.positive % 100) * LEAST_PERCENT // 100)
        for a, scores, same, _ in self.tiles(ids, labels, matrix):
            some = slice(a, a + len(scores))
            worst = np.maximum(least[some], best.score[:, -1].reshape(-1, POSITIVES)[some])
            worst[none[some]] = np.iinfo(np.int64).max
            low, high = worst.min(1, initial=np.iinfo(np.int64).max), self.positive[some].max(1, initial=-1)
            i, j = np.nonzero(~same & (scores >= low[:, None]) & (scores <= high[:, None]))
            found = scores[i, j]
            for p in range(POSITIVES):
                use = (found <= self.positive[some][i, p]) & (found >= worst[i, p])
                best.add((a + i[use]) * POSITIVES + p, found[use], ids[j[use]])


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(id, label, matrix) of rows (id, label, v, dim), gathered by length to a bounded size."""
    held: dict[int, list] = {}
    for batch in batches:
        ids, labels, dims = (batch.column(k).to_numpy() for k in (0, 1, 3))
        values, starts = batch.column(2).flatten().to_numpy(), np.cumsum(dims) - dims
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            matrix = values[starts[at][:, None] + np.arange(dim)[None, :]]
            own = held.setdefault(dim, [])
            own.append((ids[at], labels[at], matrix))
            if sum(len(x[0]) for x in own) * max(dim, 1) >= GATHERED:
                yield tuple(map(np.concatenate, zip(*held.pop(dim))))
    for own in held.values():
        yield tuple(map(np.concatenate, zip(*own)))


def _pass(rows: DataFrame, anchors: list[Anchors], negatives: bool) -> DataFrame:
    """(ask, p, score, id): what the tasks hold as best; p is the positive, 0 in the first pass."""
    sent = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = {a.dim: a for a in sent.value}
        per = POSITIVES if negatives else 1
        best = {d: Best(len(a.ids) * per, NEGATIVES if negatives else POSITIVES) for d, a in blocks.items()}
        for ids, labels, matrix in _arrays(batches):
            if a := blocks.get(matrix.shape[1]):
                (a.find_negatives if negatives else a.find_positives)(best[a.dim], ids, labels, matrix)
        for d, a in blocks.items():
            slot, score, ids = best[d].rows()
            columns = a.ask[slot // per], slot % per, score, ids
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["ask", "p", "score", "id"])

    return rows.select("id", "label", "v", "dim").mapInArrow(run, "ask bigint, p bigint, score bigint, id bigint")


def _first(found: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("ask", "p").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _block(asked: DataFrame) -> list[Anchors]:
    """Anchors of a block whose size is bounded, by length."""
    out: dict[int, list] = {}
    for r in asked.collect():
        out.setdefault(r["dim"], []).append(r)
    return [
        Anchors(
            *(np.array([r[c] for r in own], np.int64) for c in ("ask", "id", "label")),
            np.array([r["v"] for r in own], float).reshape(len(own), dim),
        )
        for dim, own in out.items()
    ]


def mined(vectors: DataFrame, asks: Column) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows where ``asks`` holds.

    ``vectors`` has the columns of ``labelled``.
    """
    rows = common.stored(vectors, "vectors")
    asked = common.stored(rows.where(asks).withColumn("ask", F.monotonically_increasing_id()), "anchors")
    size = asked.agg(F.sum(F.col("dim") * 8 + 64)).first()[0] or 0
    blocks = max(1, -(-size // ANCHOR_BYTES))
    found = []
    for b in range(blocks):
        anchors = _block(asked.where(F.pmod(F.xxhash64("ask"), F.lit(blocks)) == b))
        positives = common.stored(_first(_pass(rows, anchors, False), POSITIVES), "positives")
        scores = {(r["ask"], r["rank"] - 1): r["score"] for r in positives.select("ask", "rank", "score").collect()}
        for a in anchors:
            for i, ask in enumerate(a.ask.tolist()):
                a.positive[i] = [scores.get((ask, p), -1) for p in range(POSITIVES)]
        negatives = _first(_pass(rows, anchors, True), NEGATIVES)
        own = positives.select(
            "ask", (F.col("rank") - 1).cast("long").alias("p"),
            F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        )
        found.append(common.stored(negatives.join(own, ["ask", "p"]), "negatives"))
    names = asked.select("ask", F.col("id").alias("anchor_id"))
    return (
        reduce(DataFrame.unionByName, found)
        .withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
        .join(names, "ask")
        .select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
            "negative_id", "positive_score", "negative_score",
        )
    )


def op11_kronecker_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector."""
    return mined(labelled(common.table(spark, sf_dir, "embeddings")), F.col("id") % EVERY == 0)


OP11_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS MATERIALIZED (
  SELECT a.r AS ask, a.vec_id AS anchor_id, d.r AS r, d.vec_id AS vec_id, a.label = d.label AS same,
         CAST(coalesce(list_sum(list_transform(list_zip(a.c, d.c), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v a JOIN v d ON len(a.c) = len(d.c) AND a.vec_id <> d.vec_id
  WHERE a.vec_id % 100 = 0
), p AS (
  SELECT *, row_number() OVER (PARTITION BY ask ORDER BY score DESC, vec_id) AS k FROM s WHERE same
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
         s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.ask, p.k ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.ask = p.ask AND NOT s.same
   AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
  WHERE p.k <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
