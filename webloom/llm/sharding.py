"""Placing rows on shards through a permutation-filled lookup table.

Every shard has a preference order of the slots of a prime-sized table: a start and a step drawn
from hashes of its name. The shards take turns, each claiming the first slot of its order that is
free, until the table is full; so shards differ by at most one slot per turn, and if a shard joins
or leaves few slots change hands. A row goes to the slot of its hashed key, then to the shard that
owns it: one array look-up, whose array has ``slots`` entries whatever the size of the data.

Defined cases: null keys share one slot, as do equal keys; extra columns are kept; an empty table
stays empty. A key that holds many rows sits on one shard by design; ``write`` splits the rows of a
shard over files by a salt, so no task writes them alone.
"""

from __future__ import annotations

import json
import uuid
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import common
from webloom.session import checkpoint_dir

SLOTS = 65_537
SHARDS = 64


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def lookup(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The owner of every slot, as an index into ``shards``."""
    if not is_prime(slots) or not 0 < len(set(shards)) == len(shards) <= slots:
        raise ValueError("a prime number of slots, and distinct shards, no more than slots")
    start = [zlib.crc32(f"start:{s}".encode()) % slots for s in shards]
    step = [zlib.crc32(f"step:{s}".encode()) % (slots - 1) + 1 for s in shards]
    asked = [0] * len(shards)
    owner = [-1] * slots
    filled = 0
    while True:
        for s in range(len(shards)):
            slot = (start[s] + asked[s] * step[s]) % slots
            while owner[slot] >= 0:
                asked[s] += 1
                slot = (start[s] + asked[s] * step[s]) % slots
            owner[slot] = s
            asked[s] += 1
            filled += 1
            if filled == slots:
                return owner


def slot(keys: list[str], slots: int = SLOTS) -> Column:
    """The slot of a row: its keys as text, hashed."""
    return F.pmod(F.xxhash64(*(F.col(k).cast("string") for k in keys)), F.lit(slots))


def placed(docs: DataFrame, keys: list[str], shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``docs`` with ``slot`` and ``shard``, the index of its shard."""
    # an array of ``slots`` numbers, part of the plan that every task gets
    table = F.from_json(F.lit(json.dumps(lookup(shards, slots))), "array<int>")
    with_slot = docs.withColumn("slot", slot(keys, slots))
    return with_slot.withColumn("shard", F.get(table, F.col("slot").cast("int")))


def write(placed_docs: DataFrame, path: str, files_per_shard: int = 8) -> None:
    """One folder per shard; its rows are dealt to ``files_per_shard`` tasks in turn, equal rows too."""
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(files_per_shard))
    placed_docs.repartition("shard", salt).write.partitionBy("shard").parquet(path)


def op6_permutation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document, as read back from the folders of the shards."""
    docs = common.table(spark, sf_dir, "documents")
    names = [f"shard-{i:04d}" for i in range(SHARDS)]
    whole = placed(docs, ["doc_id"], names)
    path = f"{checkpoint_dir(spark)}/webloom-shards-{uuid.uuid4().hex}"
    write(whole, path)
    return spark.read.schema(whole.schema).parquet(path).select("doc_id", "slot", "shard")
