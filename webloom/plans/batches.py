"""Builds in batches: each batch of containers is one generation of the index."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from webloom import schema as S
from webloom.functions.language import LanguageModel
from webloom.operators import merge
from webloom.plans import index_build as B
from webloom.session import Scratch
from webloom.sinks.generations import ANCHORS, DOCUMENTS, Generation, Index, attempt
from webloom.sources.containers import Batch

# Anchors of an id beyond one part in so many of an average bucket, and this many, are dealt to several buckets.
PIECES = 4
LEAST_PIECE = 64

RecordsOf = Callable[[Batch], DataFrame]


def batches(number_of: int, partitions: int, strict: bool = False) -> list[Batch]:
    return [Batch(n, number_of, partitions, strict) for n in range(1, number_of + 1)]


def build_tables(
    records_of: RecordsOf,
    inputs: B.Inputs,
    model: LanguageModel,
    uuid_prefix: str,
    slices: list[Batch],
) -> tuple[DataFrame, DataFrame | None]:
    """Documents and flat anchors after all batches, later batches replacing documents.

    The pages of all batches are merged in one shuffle, and the sides are joined once.
    """
    sides = B.read_sides(inputs, model)
    pages = merge.merge_builds([B.extract_pages(records_of(b), model, uuid_prefix) for b in slices])
    documents = B.attach_ranks(pages, sides)
    return documents, None if sides.anchors is None else B.index_anchors(documents, sides)


def build_all(
    records_of: RecordsOf,
    inputs: B.Inputs,
    model: LanguageModel,
    uuid_prefix: str,
    slices: list[Batch],
) -> DataFrame:
    """``build_tables`` as one frame of documents with nested anchors: all of them, or an error."""
    pages = merge.merge_builds([B.extract_pages(records_of(b), model, uuid_prefix) for b in slices])
    return B.attach_sides(pages, B.read_sides(inputs, model))


@dataclass
class StoredSides:
    """Side inputs written once for many batches; ``drop`` removes what was written."""

    sides: B.Sides
    tables: list[str]
    scratch: Scratch

    def drop(self, spark: SparkSession) -> None:
        for table in self.tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.scratch.drop()


def heavy_ids(ids: DataFrame, buckets: int) -> DataFrame | None:
    """``id, salts`` of the ids with more rows than a quarter of an average bucket; None without any.

    A row of ``ids`` is a row of its id. There are at most four such ids a bucket, so the list is small.
    """
    per_id = ids.groupBy("id").count()
    total = per_id.agg(F.sum("count")).first()[0] or 0
    piece = max(LEAST_PIECE, -(-total // (PIECES * buckets)))
    found = per_id.where(F.col("count") > piece).select("id", F.ceil(F.col("count") / piece).cast("int").alias("salts"))
    rows = found.collect()
    return ids.sparkSession.createDataFrame(rows, "id string, salts int") if rows else None


def store_sides(spark: SparkSession, sides: B.Sides, folder: str | None = None) -> StoredSides:
    """Write the prepared side inputs once, to be read by every batch.

    They go to ``folder``, else to the shared checkpoint folder, so batches survive the loss of
    executors without parsing the side inputs again. Inputs joined by id are bucketed by it, into
    as many buckets as a shuffle has partitions: no batch has to shuffle or sort them. Anchors of heavy
    ids are dealt to several buckets by a salt, of which every other id has one.
    """
    scratch = Scratch(spark, folder)
    run = scratch.path.rpartition("/")[2].replace("webloom_", "webloom_sides_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables: list[str] = []

    def bucketed(frame: DataFrame | None, name: str, *keys: str) -> DataFrame | None:
        if frame is None:
            return None
        # one task per bucket, so that each bucket is one sorted file
        writer = frame.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
        writer.option("path", f"{scratch.path}/{name}").saveAsTable(f"{run}_{name}")
        tables.append(f"{run}_{name}")
        return spark.table(f"{run}_{name}")

    heavy = anchors = ids = None
    if sides.anchors is not None:
        heavy = heavy_ids(sides.anchor_ids, buckets)
        if heavy is None:
            anchors = bucketed(sides.anchors, "anchors", "id")
        else:
            dealt = F.pmod(F.xxhash64("anchor"), F.coalesce("salts", F.lit(1))).cast("int")
            salted = sides.anchors.join(heavy, "id", "left").withColumn("salt", dealt).drop("salts")
            anchors = bucketed(salted, "anchors", "id", "salt")
        ids = bucketed(anchors.select("id").distinct(), "anchor_ids", "id")
    stored = replace(
        sides,
        spam=bucketed(sides.spam, "spam", "id"),
        page_ranks=bucketed(sides.page_ranks, "page_ranks", "id"),
        anchors=anchors,
        anchor_ids=ids,
        heavy=heavy,
    )
    return StoredSides(stored, tables, scratch)


def fingerprint(model: LanguageModel, uuid_prefix: str, batch: Batch) -> str:
    """Names what a batch is made from, as far as this job decides it."""
    known = hashlib.sha256(repr((model.langs, uuid_prefix, batch)).encode())
    for table in (model.alphabet, model.grams, model.weights):
        known.update(table.tobytes())
    return known.hexdigest()


def write_all(
    records_of: RecordsOf,
    inputs: B.Inputs,
    model: LanguageModel,
    uuid_prefix: str,
    slices: list[Batch],
    path: str,
    folder: str | None = None,
    run_name: str | None = None,
) -> list[dict[str, int]]:
    """Run the batches one after the other, as one run of the index at ``path``; see ``Index`` to read it.

    A batch is one generation: its documents and, as flat rows, their anchors appear together when it is
    committed. A run with a name can be resumed: called again with that name, it skips the batches that are done.
    The name stands for the inputs, so name a run anew when they change. Without a name, every call is a
    new run, which replaces what it brings again.

    Returns the counters of each batch. They are counted in what its tasks have committed, so they are
    exact also where tasks or whole stages had to be run again.
    """
    spark = inputs.records.sparkSession
    index = Index(spark, path)
    run = index.start_run(run_name)
    todo = {b: fingerprint(model, uuid_prefix, b) for b in slices}
    reports = {b: run.done[f] for b, f in todo.items() if f in run.done}
    if len(reports) < len(todo):
        stored = store_sides(spark, B.read_sides(inputs, None), folder)
        try:
            for b, name in todo.items():
                if b not in reports:
                    reports[b] = _write_batch(index, run.number, b, name, records_of(b), stored.sides, model, uuid_prefix, folder)
        finally:
            stored.drop(spark)
    return [reports[b] for b in slices]


def _write_batch(
    index: Index,
    run: int,
    batch: Batch,
    name: str,
    records: DataFrame,
    sides: B.Sides,
    model: LanguageModel,
    uuid_prefix: str,
    folder: str | None,
) -> dict[str, int]:
    kinds = (DOCUMENTS,) if sides.anchors is None else (DOCUMENTS, ANCHORS)
    generation = Generation(run, batch.number, attempt(), kinds)
    scratch = Scratch(index.spark, folder)
    try:
        staged = B.stage_records(records, model, uuid_prefix, scratch)
        documents = index.write(DOCUMENTS, B.staged_documents(staged, sides, scratch), generation)
        if sides.anchors is not None:
            index.write(ANCHORS, B.index_anchors(documents, sides, model), generation)
        counters = {
            **B.staged_counters(staged),
            S.HTML_PARSE_ERRORS: 0,
            S.GENERATED_DOCS: documents.count(),
            S.NO_CONTENT: B.orphan_count(documents, sides),
        }
        index.add(generation, name, counters)
    finally:
        scratch.drop()
    return counters
