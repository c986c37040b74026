"""What several training-data operators share: tables, stored steps, the held-out rule."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.session import checkpoint_dir

# Whole texts travel in Arrow batches, so a batch is limited by rows.
ROWS_PER_BATCH = 512


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: their workers import it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="webloom-")) / "webloom-package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for f in sorted(package.rglob("*.py")):
            out.write(f, f.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, with the batch size that whole texts need."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it back: computed once, lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/webloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Bits to a number and numbers of a ``may_hold`` table: 16 million bits, so the table has a bound.
_WORDS_LOG2 = 18


def may_hold(df: DataFrame, keys: DataFrame, *by: str) -> DataFrame:
    """``df`` with a column ``_may``, false only where no row of ``keys`` has the same values in the columns ``by``.

    For a join of a few keys with wide rows: rows that are out for certain need not be shuffled, those that
    may be in still need the join. A bit is set for the hash of every key, in at most 2 ** 18 numbers of 64 bits, which
    are sent to all tasks. With very many keys most bits are set and most rows stay; none is ever lost.
    """
    hashed = F.xxhash64(*by)
    word, bit = F.shiftrightunsigned(hashed, 64 - _WORDS_LOG2), hashed.bitwiseAND(F.lit(63)).cast("int")
    words = keys.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word")
    words = stored(words.agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits")), "words")
    found = df.withColumn("_at", word).join(F.broadcast(words), F.col("_at") == F.col("_word"), "left")
    may = F.coalesce(F.getbit("_bits", bit) == 1, F.lit(False))
    return found.withColumn("_may", may).drop("_at", "_word", "_bits")


def fold(doc_id: Column | str) -> Column:
    """crc32 of the id as text, modulo 3; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 3


def is_held_out(doc_id: Column | str) -> Column:
    """Rows nothing is learned from: fold 1. A null id is not held out, and not learned from either."""
    return F.coalesce(fold(doc_id) == 1, F.lit(False))


def is_learned(doc_id: Column | str) -> Column:
    return F.coalesce(fold(doc_id) != 1, F.lit(False))


def sampled(df: DataFrame, bound: int, *keys: str) -> DataFrame:
    """About ``bound`` rows of ``df``, chosen by a hash of ``keys``: for fitting models only.

    All rows if there are no more than that. The share kept is ``bound / rows``, so the expected
    size does not grow with the input.
    """
    rows = df.count()
    if rows <= bound:
        return df
    slices = 1 << 30
    return df.where(F.pmod(F.xxhash64(*keys), F.lit(slices)) < int(slices * bound / rows))


def tokenizer_path(name: str) -> str:
    return public_tokenizers.path(name)
