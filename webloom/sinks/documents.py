"""Finished documents: stored form, JSON, keyed writes and merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

KEY = "uuid"
PLAIN_FIELDS = [
    "warc_trec_id",
    "warc_record_id",
    "warc_target_uri",
    "warc_target_hostname",
    "warc_target_path",
    "warc_target_query_string",
    "content_type",
    "date",
    "lang",
    "body_length",
    "meta_keywords",
    "spam_rank",
    "page_rank",
]
# Field families that carry the language in their name, and their source.
LANGUAGE_FIELDS = {
    "title_lang": "title",
    "meta_desc_lang": "meta_desc",
    "headings_lang": "headings",
    "body_lang": "body",
    "full_body_lang": "full_body",
}
ANCHOR_FIELD = "anchor_texts_lang"

# Connector options and their defaults; callers override all but the first two.
STORE_KEYS = {"es.mapping.id": KEY, "es.mapping.exclude": KEY}
STORE_DEFAULTS = {
    "es.index.auto.create": "yes",
    "es.http.timeout": "1m",
    "es.http.retries": "5",
    "es.batch.size.entries": "5000",
    "es.batch.size.bytes": "2mb",
    "es.batch.write.retry.count": "5",
    "es.batch.write.retry.wait": "30s",
    "es.batch.write.refresh": "false",
}
STORE_FORMAT = "org.elasticsearch.spark.sql"
ROWS_PER_FILE = 5000


def language_field(value: str) -> Column:
    """``{<language>: value}``: the field ``<family>.<language>`` of a document."""
    return F.when(F.col(value).isNotNull(), F.create_map("lang", value))


def stored_form(documents: DataFrame) -> DataFrame:
    """Documents with fields named by language; fields without a value stay NULL.

    Documents whose anchors are kept as flat rows have no anchor field.
    """
    anchors = F.map_from_entries(
        F.transform("anchors", lambda a: F.struct(a["lang"], a["texts"]))
    )
    return documents.select(
        KEY,
        *PLAIN_FIELDS,
        *(language_field(v).alias(k) for k, v in LANGUAGE_FIELDS.items()),
        *([anchors.alias(ANCHOR_FIELD)] if "anchors" in documents.columns else []),
    )


def as_json(stored: DataFrame) -> DataFrame:
    """``uuid, document``: the key stays outside the JSON, absent fields are left out."""
    fields = [c for c in stored.columns if c != KEY]
    return stored.select(KEY, F.to_json(F.struct(*fields)).alias("document"))


def upsert(existing: DataFrame, new: DataFrame) -> DataFrame:
    """``existing`` with every document of ``new`` added or replaced whole.

    Reads ``new`` twice, once for its keys: meant for stored documents.
    """
    return existing.join(new.select(KEY), KEY, "left_anti").unionByName(new)


def latest(*builds: DataFrame) -> DataFrame:
    """Documents of all builds, the last build that has a key winning it.

    Same result as a chain of ``upsert``, but every build is computed once: use it on lazy
    builds and ``upsert`` on stored ones. One row per key and task reaches the shuffle.
    """
    numbered = [b.withColumn("build", F.lit(i)) for i, b in enumerate(builds)]
    rank = F.row_number().over(Window.partitionBy(KEY).orderBy(F.desc("build")))
    rows = reduce(DataFrame.unionByName, numbered).withColumn("rank", rank)
    return rows.where(F.col("rank") == 1).drop("rank", "build")


def no_speculation(spark: SparkSession) -> None:
    """A second attempt of a write task would write its documents twice."""
    if spark.sparkContext.getConf().get("spark.speculation", "false").lower() == "true":
        raise ValueError("switch off spark.speculation to write documents")


def store_options(index: str, overrides: dict[str, str] | None = None) -> dict[str, str]:
    """Connector options for an index; the document key cannot be overridden."""
    return {"es.resource": f"{index}/_doc", **STORE_DEFAULTS, **(overrides or {}), **STORE_KEYS}


def write_store(documents: DataFrame, index: str, overrides: dict[str, str] | None = None) -> None:
    """Write to the search store through its connector, where that package is installed."""
    no_speculation(documents.sparkSession)
    writer = stored_form(documents).write.format(STORE_FORMAT).mode("append")
    writer.options(**store_options(index, overrides)).save()


def write_json(
    stored: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, anchors: DataFrame | None = None
) -> None:
    """JSON documents as Parquet rows ``uuid, document`` in ``<path>/documents``.

    Flat ``anchors`` become rows ``uuid, document`` of their own in ``<path>/anchors``, one per
    distinct text, with its language and number of lines.
    """
    no_speculation(stored.sparkSession)
    frames = {"documents": stored} | ({} if anchors is None else {"anchors": anchors})
    for name, frame in frames.items():
        writer = as_json(frame).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
        writer.parquet(f"{path.rstrip('/')}/{name}")
