"""Session settings the build relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# An Arrow batch holds whole pages of up to 1 MiB, so it is limited by rows.
PAGES_PER_ARROW_BATCH = 256

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(PAGES_PER_ARROW_BATCH),
    # a join whose one side is slim hashes that side; the page texts on the other are not sorted
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Waves of tasks from which the last one, with fewer tasks than cores, no longer matters.
WAVES = 4


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores to the end on an input of few partitions; else leave it alone.

    Text extraction is bound by CPU, so a file that fits one partition is worth a shuffle, and so are
    files that are a few more than cores: most cores would wait for those of the last wave. They are dealt
    evenly to whole waves, two at least. Inputs of ``WAVES`` partitions a core or more are never moved.
    """
    cores, parts = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    if parts < cores:
        return df.repartition(cores, *keys)
    if parts < WAVES * cores:
        return df.repartition(max(2, -(-parts // cores)) * cores, *keys)
    return df


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a scratch folder only where none is named."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="webloom-")


class Scratch:
    """A folder for the steps of one job, in ``folder`` or else in the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.path = f"{(folder or checkpoint_dir(spark)).rstrip('/')}/webloom_{uuid.uuid4().hex}"

    def store(self, frame: DataFrame, name: str) -> DataFrame:
        """Write a step and read it back: computed once, whatever executors are lost later."""
        frame.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(frame.schema).parquet(f"{self.path}/{name}")

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("webloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # no stack walk for each of the many column expressions of a plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    return prepare(builder.getOrCreate())
