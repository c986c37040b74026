"""Importance resampling towards a target: documents drawn as if they came from the benchmark.

Features are the words and word pairs of a text, hashed to buckets. The share of every bucket in the
corpus and in the target, each over all texts, gives the bucket a gain, the logarithm of their
ratio; the mean gain of a document is its weight. With Gumbel noise from a hash of its id, the
highest scores are a draw without replacement in proportion to the exponential of the weights.

1. A task adds up its buckets in one array; the arrays of all tasks are summed by bucket.
2. Gains are an array of ``BUCKETS`` numbers, so a document is scored by looking its buckets up.
3. The documents that may be drawn are ranked by a distributed LSD radix sort over the digits of
   (score, id); see ``radix``.

Defined cases: a null text has no words; a null id has an empty text form and comes after all others
at equal scores; rows of equal id and score come in any order; repeated rows are drawn one by one;
an empty table gives an empty result, an empty target the same gain for all unseen buckets; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import common, radix

BUCKETS = 10_000
SCALE = 1000
LEAST_WORDS = 20
DRAWN_PERCENT = 25
SEED = 7

# A-Z in lower case; letters, digits and all bytes beyond ASCII stay, the rest parts words
_KEPT = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_KEPT).split()


def buckets(found: list[bytes]) -> np.ndarray:
    """The buckets of all words, then of all pairs of neighbours."""
    single = list(map(zlib.crc32, found))
    # a checksum goes on from that of the first word
    pairs = map(zlib.crc32, map(b" ".__add__, found[1:]), single)
    return np.fromiter(chain(single, pairs), np.int64, max(0, 2 * len(found) - 1)) % BUCKETS


def counts(texts: DataFrame) -> np.ndarray:
    """Number of features in each bucket over all rows of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                own += np.bincount(buckets(words(text)), minlength=BUCKETS)
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(own[at])], names=["bucket", "n"])

    rows = texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "bucket int, n bigint")
    out = np.zeros(BUCKETS, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket says for the target, in thousandths, rounded down."""
    s, t = float(corpus.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array(
        [math.floor(SCALE * math.log((b + 1.0) * s / ((a + 1.0) * t))) for a, b in zip(corpus.tolist(), target.tolist())],
        np.int64,
    )


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, from a hash of the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = words(text)
                own = buckets(found)
                weight = int(gain[own].sum()) // len(own) if len(own) else 0
                rows.append((doc_id, len(found), len(own), weight, weight + noise(doc_id, seed)))
            columns = zip(*rows) if rows else [()] * 5
            names = ["doc_id", "n_words", "n_features", "weight", "score"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


def drawn(
    docs: DataFrame,
    target: DataFrame,
    percent: int = DRAWN_PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of all documents; rank where it is drawn."""
    rows = common.stored(scored(docs, gains(counts(docs), counts(target)), seed), "scored")
    able = rows.where(F.col("n_words") >= least_words)
    number = able.count() * percent // 100
    i = F.coalesce("doc_id", F.lit(0))
    keys = [
        -F.col("score"),
        F.col("doc_id").isNull().cast("long"),
        F.shiftright(i, 32),
        i.bitwiseAND(F.lit(0xFFFFFFFF)),
    ]
    order = radix.ranked(able, keys)
    rank = F.when(F.col("rank") <= number, F.col("rank"))
    rest = rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return order.withColumn("rank", rank).unionByName(rest)


def op12_radix_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and score of every document, and the rank of the quarter drawn towards the benchmark."""
    docs, target = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")
    return drawn(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


# The checksum is written out: a table of 256 entries by the rule, then a step per byte.
OP12_SQL = r"""
WITH crc AS MATERIALIZED (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)),
             lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(b))
), texts AS (
  SELECT row_number() OVER () AS r, doc_id, text, 0 AS target FROM documents
  UNION ALL SELECT row_number() OVER (), NULL, text, 1 FROM benchmark
), worded AS MATERIALIZED (
  SELECT r, doc_id, target, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
), features AS MATERIALIZED (
  SELECT r, target, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)),
           lambda i: w[i] || ' ' || w[i + 1]))) AS f
  FROM worded
), bytes AS (
  SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)
), hashed AS MATERIALIZED (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(h), 2), lambda i:
             CAST(16 * (instr('0123456789ABCDEF', h[i]) - 1) + instr('0123456789ABCDEF', h[i + 1]) - 1 AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, crc
), counted AS (
  SELECT bucket, count(*) FILTER (target = 0) AS s, count(*) FILTER (target = 1) AS t
  FROM features JOIN hashed USING (f) GROUP BY bucket
), totals AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counted
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE
                                      / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE))) AS BIGINT) AS g
  FROM counted, totals
), weighed AS (
  SELECT r, CAST(floor(sum(g)::DOUBLE / count(*)) AS BIGINT) AS weight
  FROM features JOIN hashed USING (f) JOIN gain USING (bucket) WHERE target = 0 GROUP BY r
), noised AS (
  SELECT r, doc_id, len(w) AS n, coalesce(weight, 0) AS weight,
         ('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT AS h
  FROM worded LEFT JOIN weighed USING (r) WHERE target = 0
), scores AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM noised
), ranked AS (
  SELECT *, CASE WHEN n >= 20 THEN row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id NULLS LAST) END AS k,
         count(*) FILTER (n >= 20) OVER () AS able
  FROM scores
)
SELECT doc_id, CAST(greatest(2 * n - 1, 0) AS BIGINT) AS n_features, weight, score,
       CASE WHEN k <= 25 * able // 100 THEN k END AS rank
FROM ranked
"""
