"""Quality by compression: a text is good if a dictionary of good text makes it smaller than one of bad text.

Two zstandard dictionaries are trained, on pieces of good and of bad labelled documents. A text is
cut into pieces of ``PIECE`` bytes, all of them are compressed with either dictionary, and
(bad - good) / (bad + good), from the summed sizes, is its difference. Pieces start from the
dictionary alone, so the difference of a long text does not fade as it would if the compressor learned from the text itself.

A logistic curve, fitted on labelled documents that the dictionaries have not seen, makes the score of
the difference and of how small the text gets at all: text that repeats itself is small under either dictionary.
Rows count in that fit so that both classes have the share they have among the labels.

Only fitting is bounded: about ``DOCS`` documents of each class, and of their pieces about ``PIECES`` for
a dictionary. Every whole text is scored.

Defined cases: a null text is an empty one, with difference zero; labels that repeat for an id count
by their majority, good in a draw; a null label is no label; a null id is never learned from nor held
out; with labels of one class only, or none, every score is the share of good labels (one half without labels).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import common

FOLDS = 5
PIECE = 1024
DICTIONARY = 32_768
LEVEL = 3
DOCS = 6_000
PIECES = 8_000
CALIBRATING = 4  # one in so many of the chosen documents calibrates, the others fill the dictionaries
GOOD = 0.3
RIDGE = 1e-3
STEPS = 60


def fold(doc_id: Column | str) -> Column:
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % FOLDS


def is_held_out(doc_id: Column | str) -> Column:
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def is_learned(doc_id: Column | str) -> Column:
    return F.coalesce(fold(doc_id) != 0, F.lit(False))


def pieces(text: bytes | None) -> list[bytes]:
    text = text or b""
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)]


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; with too little text to train one, the text itself."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    plain = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0
    )
    if not content:
        return zstandard.ZstdCompressor(compression_params=plain)
    return zstandard.ZstdCompressor(compression_params=plain, dict_data=zstandard.ZstdCompressionDict(content))


class Measure:
    """Difference and size of texts under two dictionaries; made where it is used, as compressors cannot travel."""

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = _compressor(good), _compressor(bad)

    def __call__(self, text: bytes | None) -> tuple[float, float]:
        if not text:
            return 0.0, 0.0
        good = bad = 0
        for piece in pieces(text):
            good += len(self.good.compress(piece))
            bad += len(self.bad.compress(piece))
        return (bad - good) / (bad + good), math.log((bad + good) / (2 * len(text)))


@dataclass(frozen=True)
class Classifier:
    good: bytes
    bad: bytes
    weights: tuple[float, float, float]  # of difference and size; the last stands alone

    def scorer(self):
        measure, (a, b, c) = Measure(self.good, self.bad), self.weights

        def score(text: bytes | None) -> float:
            difference, size = measure(text)
            return 1 / (1 + math.exp(-min(max(a * difference + b * size + c, -700.0), 700.0)))

        return score


def calibrate(measures: np.ndarray, good: np.ndarray, counts: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps; ``counts`` says how many documents a row stands for."""
    x = np.column_stack([measures, np.ones(len(measures))])
    weight = counts / counts.mean()
    w = np.zeros(3)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - good)) + RIDGE * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(3)
        step = np.linalg.solve(curve, gradient)
        w -= step * min(1.0, 10 / max(np.abs(step).max(), 1e-9))
    return tuple(map(float, w))


def _constant(share: float) -> Classifier:
    share = min(max(share, 1e-9), 1 - 1e-9)
    return Classifier(b"", b"", (0.0, 0.0, math.log(share / (1 - share))))


def _pieces(docs: DataFrame) -> DataFrame:
    """(good, piece) of rows (good, text), equal texts of a class once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for good, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = pieces(text)
                columns = [pa.array([good] * len(own), pa.int32()), pa.array(own, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["good", "piece"])

    return docs.select("good", "text").distinct().mapInArrow(run, "good int, piece binary")


def measured(docs: DataFrame, good: bytes, bad: bytes, *keep: str) -> DataFrame:
    """The columns ``keep`` with the measures of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Measure(good, bad)
        for batch in batches:
            both = [measure(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [pa.array([x[k] for x in both], pa.float64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*keep, "difference", "size"])

    rows = docs.select(*keep, F.col("text").cast("binary").alias("text"))
    ddl = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[:-1])
    return rows.mapInArrow(run, f"{ddl}, difference double, size double")


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Fit on the labelled rows of ``docs`` that may be learned from."""
    known = (
        labels.where(is_learned("doc_id") & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("_id"))
        .agg((F.avg((F.col("quality") == 1).cast("int")) >= 0.5).cast("int").alias("good"))
    )
    seen = {r["good"]: r["count"] for r in known.groupBy("good").count().collect()}
    total = sum(seen.values())
    if len(seen) < 2:
        return _constant(seen.get(1, 0) / total if total else 0.5)
    chosen = [common.sampled(known.where(F.col("good") == g), DOCS, "_id") for g in (0, 1)]
    # bounded: about DOCS ids of each class
    few = [(r["_id"], r["good"]) for c in chosen for r in c.collect()]
    few = docs.sparkSession.createDataFrame(few, "_id bigint, good int")
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    hit = texts.join(F.broadcast(few), F.col("doc_id") == F.col("_id")).select("doc_id", "good", "text")
    # an id may have many rows: they are bounded as well
    hit = common.stored(common.sampled(hit, 4 * DOCS, "doc_id", "text"), "labelled")
    calibrates = F.pmod(F.xxhash64("doc_id", F.lit("calibrates")), F.lit(CALIBRATING)) == 0
    parts = common.stored(_pieces(hit.where(~calibrates)), "pieces")
    content = {}
    for g in (0, 1):
        some = common.sampled(parts.where(F.col("good") == g), PIECES, "piece")
        content[g] = dictionary(sorted(bytes(r["piece"]) for r in some.select("piece").collect()))
    slice_ = hit.where(calibrates).select("good", "text").distinct()
    rows = measured(slice_, content[1], content[0], "good").collect()
    good = np.array([r["good"] for r in rows], float)
    if not 0 < good.sum() < len(good):
        return _constant(seen.get(1, 0) / total)
    counts = np.where(good == 1, seen[1] / good.sum(), seen[0] / (len(good) - good.sum()))
    return Classifier(content[1], content[0], calibrate(np.array([[r["difference"], r["size"]] for r in rows]), good, counts))


def scored(docs: DataFrame, model: Classifier, *keep: str) -> DataFrame:
    """The columns ``keep`` with ``score``, from the text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = sent.value.scorer()
        for batch in batches:
            found = pa.array(map(score, batch.column(batch.num_columns - 1).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], names=[*keep, "score"])

    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.col("text").cast("binary").alias("_text"))
    ddl = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[:-1])
    return rows.mapInArrow(run, f"{ddl}, score double")


def op13_zstd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and decision for every document."""
    docs = common.table(spark, sf_dir, "documents")
    model = train(docs, common.table(spark, sf_dir, "labels"))
    return scored(docs, model, "doc_id").select(
        "doc_id",
        is_held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )
