"""The corpus pipeline: filters and packs the documents with five of the operators of webloom.llm.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last
return the columns of ``docs``, whatever else they are called: while a stage works, the row travels
in one column of its own, so extra columns cannot clash with a stage's. Null texts, repeated rows
and empty tables are as the operators define them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import common, decontamination, near_copies, packing, secret_scan, toxicity


def _held(docs: DataFrame) -> DataFrame:
    """The row as one column, beside what the operators read."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "doc_id", "text")


def _released(held: DataFrame, docs: DataFrame) -> DataFrame:
    return held.select(*(F.col(f"row.`{c}`") for c in docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = toxicity.train(docs, common.table(spark, sf_dir, "labels"))
    return _released(toxicity.scored(_held(docs), model, "row").where(F.col("score") < toxicity.REJECT), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return _released(near_copies.one_of_each(_held(docs)), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no item of the benchmark."""
    found = decontamination.with_leaks(_held(docs), common.table(spark, sf_dir, "benchmark"), "row")
    return _released(found.where(F.size("leaks") == 0), docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark; the length follows the text."""
    found = secret_scan.scanned(_held(docs), secret_scan.train(docs))
    text = F.when(F.size("spans") > 0, secret_scan.redacted(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    changed = found.withColumn("clean", text)
    size = F.when(F.size("spans") > 0, F.length("clean")).otherwise(F.col("row.n_chars"))
    new = {"text": F.col("clean")} | (
        {"n_chars": size.cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    )
    return changed.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 1024 ids over all that is kept: one row per piece."""
    path = common.tokenizer_path("byte_bpe_50k.json")
    return packing.packed(docs, path, spaced=True).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: SQL can express neither the trained nor the hashed stages; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written and reread by the next one."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
