"""Near-duplicates by SimHash fingerprints, searched with vantage-point trees.

1. One fingerprint per document, from the whole text. Equal fingerprints form a class, with the
   smallest id in it; from here on there is one row per class, however many copies it has.
2. The top of a vantage-point tree is grown over a bounded sample of the classes. Every class goes
   to the shards that the triangle bound cannot rule out, and each shard is searched on its own
   with the rest of the tree. A shard returns a star per group, never its pairs.
3. The stars of all shards are joined to components; the smallest id names a component.

Defined cases: a null text is an empty one, and texts without a word have fingerprint zero and
are linked like any others; repeated rows fall into one class; a null id takes part but names a
component only if there is no other id; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import common
from webloom.llm.components import connected
from webloom.llm.vantage import VantageTree, linked

SHINGLE = 3
SEED = 42
REACH = 2
# Classes that a shard should hold, and how many of the sample stand for them.
SHARD_CLASSES = 16_384
SAMPLE_PER_SHARD = 64
SAMPLE_MOST = 1_000_000
_HASHES_AT_ONCE = 1 << 16


def shingle_hashes(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """The hashes of all shingles of a text in UTF-8, repeats included."""
    words = (text or b"").lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return np.zeros(0, "<u8")
    runs = [words[i:] for i in range(shingle)] if len(words) >= shingle else [[b" ".join(words)]]
    return np.fromiter((xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(*runs)), dtype="<u8")


def fingerprint_of(hashes: np.ndarray) -> int:
    """The SimHash of shingle hashes, as a signed 64-bit number."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _HASHES_AT_ONCE):
        octets = hashes[i : i + _HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    return fingerprint_of(shingle_hashes(text, shingle))


def with_fingerprints(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` with the fingerprint ``fp`` of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            found = pa.array(map(fingerprint, texts), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], names=[*keep, "fp"])

    rows = docs.select(*keep, F.col("text").cast("binary").alias("_text"))
    ddl = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[:-1])
    return rows.mapInArrow(run, f"{ddl}, fp bigint")


def components(fingerprints: DataFrame, reach: int = REACH) -> DataFrame:
    """(fp, root) for the distinct values of ``fp``; classes without a link are their own root."""
    classes = common.stored(fingerprints.select("fp").distinct(), "classes")
    n = classes.count()
    shards = -(-n // SHARD_CLASSES)
    sample = common.sampled(classes, min(SAMPLE_MOST, max(1, shards) * SAMPLE_PER_SHARD), "fp")
    points = np.array(sorted(r.fp for r in sample.collect()), "i8").view(np.uint64)
    top = VantageTree.grow(points, SAMPLE_PER_SHARD if shards > 1 else len(points) + 1, reach)
    tree = fingerprints.sparkSession.sparkContext.broadcast(top)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            at, shard = tree.value.route(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), pa.array(fps[at], pa.int64())], names=["shard", "fp"]
            )

    def search(group: pd.DataFrame) -> pd.DataFrame:
        fps = group["fp"].to_numpy()
        member, centre = linked(fps.view(np.uint64), reach)
        return pd.DataFrame({"u": fps[member], "v": fps[centre]})

    stars = (
        classes.mapInArrow(route, "shard int, fp bigint")
        .groupBy("shard")
        .applyInPandas(search, "u bigint, v bigint")
    )
    found = connected(stars)
    return classes.join(found, classes.fp == found.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(fingerprints: DataFrame, reach: int = REACH) -> DataFrame:
    """(fp, root, component_id) for rows (doc_id, fp): the smallest id in the component of each fp."""
    least = fingerprints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = common.stored(components(fingerprints, reach).join(least, "fp"), "roots")
    names = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    return common.stored(roots.join(names, "root").select("fp", "root", "component_id"), "components")


def hex64(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op10_vantage_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = common.table(spark, sf_dir, "documents")
    rows = common.stored(with_fingerprints(docs, "doc_id"), "fingerprints")
    found = near_duplicates(rows)
    return rows.join(found, "fp").select(
        "doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id"
    )


def first_rows(slim: DataFrame, named: DataFrame) -> DataFrame:
    """One row of every ``root``: the one with the smallest id.

    ``slim`` has (doc_id, _mark) and others, ``named`` has (doc_id, _mark, root) of all its rows. Rows that share
    that id are told apart by ``_mark``, a hash of their text, and equal rows are kept once. Only rows that may go,
    or stay once of several, are shuffled.
    """
    keys = named.groupBy("doc_id", "_mark").agg(F.min("root").alias("root"), F.count("*").alias("n"))
    keys = common.stored(keys, "keys")
    # the first row of each component by (id, text); nulls last, as in the name of a component
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("_mark").alias("m"))
    first = common.stored(keys.groupBy("root").agg(F.min(order).alias("w")), "first")
    wins = F.col("doc_id").eqNullSafe(F.col("w.i")) & (F.col("_mark") == F.col("w.m"))
    told = keys.join(first, "root").select("doc_id", "_mark", "n", wins.alias("wins"))
    odd = common.stored(told.where("n > 1 or not wins").select("doc_id", "_mark", "wins"), "odd")
    looked = common.may_hold(slim, odd, "doc_id", "_mark")
    plain = looked.where("not _may").select(*slim.columns)
    named_odd = odd.select(F.col("doc_id").alias("_i"), F.col("_mark").alias("_m"), F.col("wins").alias("_wins"))
    same = F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("_mark") == F.col("_m"))
    met = looked.where("_may").join(named_odd, same, "left")
    once = met.where("_wins is null").select(*slim.columns)
    repeated = met.where("_wins").dropDuplicates(["doc_id", "_mark"]).select(*slim.columns)
    return plain.unionByName(once).unionByName(repeated)
