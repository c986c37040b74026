"""Record containers: sequence files ``<dir>/data-r-NNNNN/data`` of (key, JSON) texts."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from webloom.schema import RECORDS_DDL
from webloom.sinks import files

# Container naming and defaults.
ALL_CONTAINERS = "data-r-*/data"
CONTAINER = "data-r-{:05d}/data"
DEFAULT_PARTITIONS = 100
# Fixed value: the share of containers that may be unreadable.
TOLERATED = 0.02
# Containers that are converted at the same time where each is a job of its own.
JOBS = 16
TEXT_CLASS = "org.apache.hadoop.io.Text"


@dataclass(frozen=True)
class Batch:
    """Slice ``number`` (from 1) of ``batches`` over the numbered containers.

    Slices have ``partitions // batches`` containers. The containers left over belong to the
    last batch; with ``strict`` they belong to none.
    """

    number: int = 1
    batches: int = 1
    partitions: int = DEFAULT_PARTITIONS
    strict: bool = False

    @property
    def bounds(self) -> tuple[int, int]:
        size = self.partitions // self.batches
        at = max(0, self.number - 1)
        rest = not self.strict and at == self.batches - 1
        return size * at, self.partitions if rest else size * (at + 1)

    def paths(self, folder: str) -> list[str]:
        """Containers to read; a single batch takes whatever the folder holds."""
        base = folder if folder.endswith("/") else folder + "/"
        if self.batches == 1:
            return [base + ALL_CONTAINERS]
        return [base + CONTAINER.format(i) for i in range(*self.bounds)]

    def contains(self, partition: Column) -> Column:
        """The same slice as a filter on a partition number."""
        if self.batches == 1:
            return F.lit(True)
        first, end = self.bounds
        return (partition >= first) & (partition < end)


def batch_number(partition: Column, batches: int, partitions: int, strict: bool = False) -> Column:
    """Number of the batch that covers a partition; NULL when none does."""
    size = partitions // batches
    number = F.floor(partition / size) + 1
    inside = F.when(partition < size * batches, number)
    return (inside if strict else F.coalesce(inside, F.lit(batches))).cast("bigint")


def _pairs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Key and value of sequence files of texts, read within the JVM."""
    jvm, context = spark._jvm, spark.sparkContext._jsc.sc()
    text = jvm.org.apache.spark.WritableConverter.stringWritableConverterFn()
    kind = jvm.scala.reflect.ClassTag.apply(jvm.java.lang.Class.forName("java.lang.String"))
    least = spark.sparkContext.defaultMinPartitions
    rows = context.sequenceFile(",".join(paths), least, kind, kind, text, text)
    encoders = jvm.org.apache.spark.sql.Encoders
    pair = encoders.tuple(encoders.STRING(), encoders.STRING())
    return DataFrame(spark._jsparkSession.createDataset(rows, pair).toDF(), spark).toDF("key", "value")


def read_records(spark: SparkSession, folder: str, batch: Batch = Batch()) -> DataFrame:
    """``key, value`` of the containers in a batch; only their files are opened.

    A batch without containers gives no rows. Sequence files have no reader in the DataFrame API,
    so classic sessions reach it through the JVM; others take them through Python workers.
    """
    paths = batch.paths(folder)
    if not paths:
        return spark.createDataFrame([], RECORDS_DDL)
    if hasattr(spark, "_jsparkSession"):
        return _pairs(spark, paths)
    pairs = spark.sparkContext.sequenceFile(",".join(paths), TEXT_CLASS, TEXT_CLASS)
    return spark.createDataFrame(pairs, RECORDS_DDL)


def to_parquet(spark: SparkSession, folder: str, target: str, batch: Batch = Batch()) -> None:
    """Convert containers to Parquet partitioned by container number, as one job.

    A batch then becomes a partition filter, ``Batch.contains(col("container"))``, that
    prunes folders. A single batch converts whatever containers the folder holds: their numbers
    come from the paths. No rows are shuffled: a task reads a part of one container and writes to
    the folder of that container.
    """
    paths = batch.paths(folder)
    if not paths:
        return
    number = F.regexp_extract(F.input_file_name(), r"data-r-(\d+)/data", 1).cast("int")
    frame = _pairs(spark, paths).select(number.alias("container"), "key", "value")
    frame.write.mode("overwrite").partitionBy("container").parquet(target)


class DamagedContainers(Exception):
    """More containers than tolerated could not be read; ``damaged`` says which and why."""

    def __init__(self, damaged: dict[str, str], of: int):
        names = ", ".join(sorted(damaged)[:10])
        super().__init__(f"{len(damaged)} of {of} containers are damaged: {names}")
        self.damaged = damaged


def to_parquet_tolerant(
    spark: SparkSession, folder: str, target: str, batch: Batch = Batch(), tolerated: float = TOLERATED
) -> dict[str, str]:
    """As ``to_parquet``, but a container that cannot be read to its end is left out whole and named.

    Each container is a job of its own, so a damaged one takes no other with it and leaves no part of its
    rows; Spark has tried its tasks as often as the cluster says. Containers are read once. Returns path and
    reason of the damaged ones, and raises where they are more than the tolerated share.
    """
    found = [p for pattern in batch.paths(folder) for p, _ in files.matching(spark, pattern)]

    def convert(path: str) -> str | None:
        goal = f"{target.rstrip('/')}/container={int(re.search(r'data-r-([0-9]+)/data', path)[1])}"
        try:
            _pairs(spark, [path]).write.mode("overwrite").parquet(goal)
        except (PySparkException, Py4JJavaError) as failed:
            files.delete(spark, goal)
            return str(failed).strip().split("\n")[0][:300]

    with ThreadPoolExecutor(JOBS) as pool:
        reasons = dict(zip(found, pool.map(convert, found)))
    damaged = {p: r for p, r in reasons.items() if r is not None}
    if len(damaged) > tolerated * len(found):
        raise DamagedContainers(damaged, len(found))
    return damaged
