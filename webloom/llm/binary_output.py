"""Token ids of a corpus as Re-Pair shards in document order.

Documents are sorted by id over the whole corpus, encoded, and written in blocks of bounded size,
each a grammar shard of its own (``grammar.py``). A block is one row of a Parquet table, so any
store that Spark reaches can hold it and a lost executor only repeats its own blocks.

Defined cases: a null text is an empty one and still gets the end id; rows of one id, and rows
without an id (first), are documents of their own, ordered by a hash of the text, and equal rows are dealt
to tasks by row number; an empty table gives no block; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webloom.llm import common, grammar, tokens

END_ID = 2
# A block is closed once it holds so many ids; a longer document is a block of its own.
IDS_PER_BLOCK = 2_000_000

BLOCK_DDL = (
    "part int, block int, doc_id array<bigint>, n_tokens bigint, n_symbols bigint, shard binary"
)
BLOCK_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("doc_id", pa.list_(pa.int64())),
        ("n_tokens", pa.int64()),
        ("n_symbols", pa.int64()),
        ("shard", pa.binary()),
    ]
)


def blocks(docs: DataFrame, tokenizer: str, spaced: bool, end_id: int = END_ID) -> DataFrame:
    """One row per block, BLOCK_DDL; blocks in (part, block) order hold the documents in id order."""
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer, spaced)
        vocabulary = encoder.tokenizer.get_vocab_size()
        part, done = TaskContext.get().partitionId(), 0
        ids, sizes, names, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(ids), "<u4")
            shard = grammar.compress(flat, np.asarray(sizes, np.int64), vocabulary)
            n_symbols = int(np.frombuffer(shard, "<u4", 1, 20)[0])
            row = [[part], [done], [names], [len(flat)], [n_symbols], [shard]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(row, BLOCK_ARROW)], schema=BLOCK_ARROW
            )

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = encoder.encode(text) + end
                ids.append(own)
                sizes.append(len(own) // 4)
                names.append(name)
                held += sizes[-1]
                if held >= IDS_PER_BLOCK:
                    yield block()
                    done += 1
                    ids, sizes, names, held = [], [], [], 0
        if ids:
            yield block()

    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.monotonically_increasing_id().alias("_row")
    )
    # the order of equal rows changes nothing, so the row number only parts them
    order = ["doc_id", F.xxhash64("text"), "_row"]
    return (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_row")
        .mapInArrow(encode, BLOCK_DDL)
    )


def write(docs: DataFrame, path: str, tokenizer: str, spaced: bool, end_id: int = END_ID) -> None:
    blocks(docs, tokenizer, spaced, end_id).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCK_DDL).parquet(path)


DECODED_DDL = "part int, block int, place int, doc_id bigint, inner bigint, n_tokens bigint, ids binary"


def decoded(shards: DataFrame, digest: bool = False) -> DataFrame:
    """One row per document with its ids (uint32 bytes), or with ``ids_crc32`` in their stead."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = grammar.Shard.read(row["shard"])
                start = np.cumsum(shard.doc_ids) - shard.doc_ids
                n = len(start)
                flat = shard.expand(shard.symbols).astype("<u4")
                raw = (flat[a : a + m].tobytes() for a, m in zip(start, shard.doc_ids))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * n, pa.int32()),
                        pa.array([row["block"]] * n, pa.int32()),
                        pa.array(range(n), pa.int32()),
                        pa.array(row["doc_id"], pa.int64()),
                        pa.array(start, pa.int64()),
                        pa.array(shard.doc_ids, pa.int64()),
                        pa.array(map(zlib.crc32, raw), pa.int64()) if digest else pa.array(raw, pa.binary()),
                    ],
                    names=[*_DECODED[:-1], "ids_crc32" if digest else "ids"],
                )

    ddl = DECODED_DDL.replace("ids binary", "ids_crc32 bigint") if digest else DECODED_DDL
    return shards.select("part", "block", "doc_id", "shard").mapInArrow(decode, ddl)


_DECODED = ["part", "block", "place", "doc_id", "inner", "n_tokens", "ids"]


def placed(shards: DataFrame, digest: bool = False) -> DataFrame:
    """``decoded`` with ``start``: the ids of all documents before.

    Sums run over the blocks of each part, and over one number per part.
    """
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", F.sum("n").over(earlier(Window.orderBy("part"))).alias("parts_before"))
    inner = F.sum("n_tokens").over(earlier(Window.partitionBy("part").orderBy("block")))
    before = (
        shards.select("part", "block", inner.alias("blocks_before"))
        .join(parts, "part")
        .select("part", "block", (F.coalesce("parts_before", F.lit(0)) + F.coalesce("blocks_before", F.lit(0))).alias("before"))
    )
    return decoded(shards, digest).join(before, ["part", "block"]).withColumn(
        "start", F.col("before") + F.col("inner")
    )


def op7_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, write the shards, read them back and locate every document."""
    docs = common.table(spark, sf_dir, "documents")
    made = blocks(docs, common.tokenizer_path("word_bpe_49k.json"), spaced=False)
    files = common.stored(made, "op7")
    return placed(files, digest=True).select("doc_id", "start", "n_tokens", "ids_crc32")
