"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; all documents of the learning folds, labelled or not,
are the unlabelled set. The risk of calling a clean document toxic cannot be read off the data, so
it is estimated as (risk on unlabelled) - prior * (risk on positives as negatives), and held at
zero from below: where a step would push it under zero, the step undoes that instead of using it.

The classifier is linear over the distinct words of a text and the stems they begin with, which
carry over to forms of a word that were not seen. These have a weight if they are seen in at least ``LEAST_DOCS`` sampled documents and their shares among the positives and the unlabelled
differ by at least ``SIGNIFICANT`` standard errors. It is fitted on at most about POSITIVES + UNLABELLED
documents (bounds on fitting only), and scores every row. Tasks take the sampled texts apart and Spark counts
their features; the driver gets which of them have a weight and, of each text, only those, and fits in numpy.

Defined cases: a null text is an empty one and gets the score of no words; labels that repeat for
an id count as toxic if any is; a null label is no label; without a positive every score is 0.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import common

POSITIVES = 6_000
UNLABELLED = 12_000
STEMS = (4, 5, 6)
LEAST_DOCS = 5
PRIOR = 0.1  # where the labels don't show one
SIGNIFICANT = 5.0
STEPS = 400
RATE = 0.1
SHRINK = 1e-5
REJECT = 0.7
WORDS_KEPT = 500_000

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def of_word(word: str) -> list[int]:
    """Hashes of the features of a word: itself, and its first letters if it has more."""
    stems = [word[:n] + "*" for n in STEMS if len(word) > n]
    return [zlib.crc32(f.encode()) for f in (word, *stems)]


class _Known(dict):
    """Word -> its features that have a weight; a full table is emptied."""

    def __init__(self, weighted: set[int]):
        super().__init__()
        self.weighted = weighted

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = out = tuple(h for h in of_word(word) if h in self.weighted)
        return out


def features(text: str | None) -> np.ndarray:
    """All features of a text, as sorted hashes of 32 bits."""
    return np.array(sorted(set(chain.from_iterable(map(of_word, words(text))))), "<u4")


class Classifier:
    def __init__(self, hashes: np.ndarray, weights: np.ndarray, bias: float):
        self.hashes, self.weights, self.bias = hashes, weights, bias

    def scorer(self):
        weights = dict(zip(self.hashes.tolist(), self.weights.tolist()))
        known = _Known(set(weights))

        def score(text: str | None) -> float:
            own = sorted(set(chain.from_iterable(map(known.__getitem__, words(text)))))
            z = self.bias + sum(weights[h] for h in own)
            return float(1 / (1 + np.exp(-min(max(z, -700.0), 700.0))))

        return score


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def _places(features: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Where in the sorted ``features`` those of ``own`` are that it holds."""
    at = np.searchsorted(features, own)
    return at[at < np.searchsorted(features, own, "right")]


class _Rows:
    """Documents as index lists into the features, back to back."""

    def __init__(self, docs: list[np.ndarray], features: np.ndarray):
        at = [_places(features, d) for d in docs]
        self.size = np.array([len(i) for i in at], dtype=np.int64)
        self.row = np.repeat(np.arange(len(at)), self.size)
        self.index = np.concatenate(at) if at else np.zeros(0, np.int64)

    def sums(self, w: np.ndarray) -> np.ndarray:
        return w[-1] + np.bincount(self.row, w[self.index], len(self.size))

    def back(self, gradient: np.ndarray, n: int) -> np.ndarray:
        """Gradient by weight from the gradient by document."""
        out = np.bincount(self.index, gradient[self.row], n)
        out[-1] = gradient.sum()
        return out


def telling(inside: np.ndarray, docs: np.ndarray, n: int, m: int) -> np.ndarray:
    """Which features are in significantly different shares of ``n`` positive and ``m`` unlabelled documents.

    They are in ``docs`` of all these documents, ``inside`` of them positive.
    """
    share = docs / (n + m)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n + 1 / m))
    return (docs >= LEAST_DOCS) & (np.abs(inside / n - (docs - inside) / m) >= SIGNIFICANT * error)


def _weighted(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Hashes of the telling features; the others of a document have no say in which they are."""
    hashes, docs = np.unique(np.concatenate([*positive, *unlabelled]), return_counts=True)
    own, counts = np.unique(np.concatenate(positive), return_counts=True)
    inside = np.zeros(len(hashes), np.int64)
    inside[np.searchsorted(hashes, own)] = counts
    return hashes[telling(inside, docs, len(positive), len(unlabelled))]


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Classifier:
    """Minimise the non-negative risk with the logistic loss by Adam steps over the whole sample."""
    weighted = _weighted(positive, unlabelled) if positive and unlabelled else np.zeros(0, np.uint32)
    if not len(weighted):
        return Classifier(weighted, np.zeros(0), -20.0)
    p, u = _Rows(positive, weighted), _Rows(unlabelled, weighted)
    w = np.zeros(len(weighted) + 1)  # the last one is the bias
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        zp, zu = p.sums(w), u.sums(w)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        # d/dz of log(1 + e^z) is sigmoid(z); of log(1 + e^-z) it is sigmoid(z) - 1
        gp = -prior * _sigmoid(zp) / len(zp)
        gu = _sigmoid(zu) / len(zu)
        if negative < 0:
            gp, gu = -gp, -gu
        else:
            gp = gp + prior * (_sigmoid(zp) - 1) / len(zp)
        grad = p.back(gp, len(w)) + u.back(gu, len(w)) + SHRINK * w
        mean += 0.1 * (grad - mean)
        square += 0.01 * (grad**2 - square)
        w -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return Classifier(weighted, w[:-1], float(w[-1]))


def _features(docs: DataFrame, positive: bool) -> DataFrame:
    """(positive, f): the features of every text of a bounded set of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t).view("<i4") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], names=["f"])

    # copies count once: they are no further evidence, and the sample stays bounded
    text = docs.select(F.col("text").cast("string")).distinct()
    return text.mapInArrow(run, "f array<int>").select(F.lit(positive).alias("positive"), "f")


def _telling_hashes(sample: DataFrame, n: int, m: int) -> np.ndarray:
    """The hashes that have a weight, counted by Spark over rows (positive, f)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, inside, docs = (c.to_numpy() for c in batch.columns)
            yield batch.select(["h"]).filter(pa.array(telling(inside, docs, n, m)))

    each = sample.select("positive", F.explode("f").alias("h")).groupBy("h")
    counts = each.agg(F.count_if("positive").alias("inside"), F.count("*").alias("docs"))
    found = counts.where(F.col("docs") >= LEAST_DOCS).mapInArrow(run, "h int").collect()
    return np.sort(np.array([r.h for r in found], "<i4").view("<u4"))


def _reduced(sample: DataFrame, weighted: np.ndarray) -> dict[bool, list[np.ndarray]]:
    """What rows (positive, f) have of the ``weighted`` features, in an order of its own; equal rows travel once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [x.values.to_numpy().view("<u4") for x in batch.column(1)]
            kept = [weighted[_places(weighted, f)].tobytes() for f in own]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary())], names=["positive", "f"])

    rows = sample.select("positive", "f").mapInArrow(run, "positive boolean, f binary")
    out: dict[bool, list[np.ndarray]] = {True: [], False: []}
    for r in sorted(rows.groupBy("positive", "f").count().collect()):
        out[r["positive"]] += [np.frombuffer(r["f"], "<u4")] * r["count"]
    return out


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Fit on the rows of ``docs`` that may be learned from."""
    known = (
        labels.where(common.is_learned("doc_id") & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max("toxic").alias("_toxic"))
    )
    seen, toxic = known.agg(F.count("*"), F.sum((F.col("_toxic") == 1).cast("int"))).first()
    prior = min(max((toxic or 0) / seen, 0.01), 0.5) if seen > (toxic or 0) else PRIOR
    learned = docs.where(common.is_learned("doc_id"))
    # bounded: about POSITIVES ids
    confirmed = common.sampled(known.where("_toxic = 1").select("_id"), POSITIVES, "_id")
    chosen = [r[0] for r in confirmed.collect()]
    few = docs.sparkSession.createDataFrame([(i,) for i in chosen], "_id bigint")
    positive = learned.join(F.broadcast(few), F.col("doc_id") == F.col("_id"), "left_semi")
    sample = _features(common.sampled(positive, POSITIVES, "doc_id", "text"), True).unionByName(
        _features(common.sampled(learned, UNLABELLED, "doc_id", "text"), False)
    )
    sample = common.stored(sample, "toxicity-sample")
    size = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    if len(size) < 2:
        return fit([], [], prior)
    rows = _reduced(sample, _telling_hashes(sample, size[True], size[False]))
    return fit(rows[True], rows[False], prior)


def scored(docs: DataFrame, model: Classifier, *keep: str) -> DataFrame:
    """The columns ``keep`` with ``score``, from the text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = sent.value.scorer()
        for batch in batches:
            found = pa.array(map(score, batch.column(batch.num_columns - 1).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], names=[*keep, "score"])

    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.col("text").cast("string").alias("_text"))
    ddl = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[:-1])
    return rows.mapInArrow(run, f"{ddl}, score double")


def op2_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and decision for every document."""
    docs = common.table(spark, sf_dir, "documents")
    model = train(docs, common.table(spark, sf_dir, "labels"))
    return scored(docs, model, "doc_id").select(
        "doc_id",
        common.is_held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= REJECT).cast("int").alias("predicted"),
    )
