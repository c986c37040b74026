"""Record envelopes: parse, read headers, classify."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from webloom import schema as S
from webloom.functions import headers as H, ids


def _evaluated_once(df: DataFrame, *columns: Column) -> DataFrame:
    """Select through a one-row ``inline``, so that filters above cannot repeat the work.

    Catalyst pushes a filter below a plain select by copying the selected expression into
    it; for the JSON parse that would mean parsing every record twice.
    """
    return df.select(F.inline_outer(F.array(F.struct(*columns))))


def _member(path: str) -> Column:
    return F.try_variant_get("doc", path, "variant")


def _members(path: str) -> Column:
    """The object at ``path`` as a map; NULL for any other type."""
    return F.expr(f"try_cast(try_variant_get(doc, '{path}', 'variant') AS MAP<STRING, VARIANT>)")


def parse_envelope(records: DataFrame) -> DataFrame:
    """``key, n_bytes`` and the five members of the JSON envelope.

    Oversized values are not parsed. ``encoding`` and ``body`` are NULL unless they are JSON
    strings, ``metadata`` and ``headers`` unless they are objects.
    """
    size = F.octet_length("value")
    parsed = _evaluated_once(
        records,
        F.col("key").alias("key"),
        size.cast("bigint").alias("n_bytes"),
        F.when(size <= S.MAX_RECORD_BYTES, F.try_parse_json("value")).alias("doc"),
    )

    def text(path: str) -> Column:
        return F.when(H.is_text(_member(path)), F.try_variant_get("doc", path, "string"))

    return parsed.select(
        "key",
        "n_bytes",
        _members("$.metadata").alias("metadata"),
        _members("$.payload.headers").alias("headers"),
        text("$.payload.encoding").alias("encoding"),
        text("$.payload.body").alias("body"),
    )


def classify(envelope: DataFrame) -> DataFrame:
    """Read the headers and give each record its ``status``; NULL means it passed.

    Structure errors come before the encoding test, mistyped WARC headers after it and
    mistyped HTTP headers last, in the order in which the values are needed.
    """
    md, http = F.col("metadata"), F.col("headers")
    read = envelope.select(
        "key",
        "n_bytes",
        "encoding",
        "body",
        F.when(md.isNull() | http.isNull(), True).otherwise(False).alias("incomplete"),
        H.any_not_text(
            md, S.WARC_TYPE, S.WARC_RECORD_ID, S.WARC_TREC_ID, S.WARC_TARGET_URI
        ).alias("bad_warc_header"),
        H.any_not_text(http, S.HTTP_CONTENT_TYPE, S.HTTP_DATE).alias("bad_http_header"),
        F.exists(
            H.header_values(md, S.WARC_TYPE),
            lambda v: F.try_variant_get(v, "$", "string") != S.RESPONSE_TYPE,
        ).alias("other_type"),
        H.header(md, S.WARC_TREC_ID).alias("warc_trec_id"),
        H.header(md, S.WARC_RECORD_ID).alias("warc_record_id"),
        H.header(md, S.WARC_TARGET_URI).alias("warc_target_uri"),
        H.header(http, S.HTTP_CONTENT_TYPE).alias("content_type_header"),
        H.header(http, S.HTTP_DATE).alias("date_header"),
    )
    no_id = F.coalesce("warc_record_id", "warc_trec_id").isNull()
    broken = F.col("incomplete") | F.col("encoding").isNull() | F.col("body").isNull()
    return read.select(
        "key",
        F.when(F.col("n_bytes") > S.MAX_RECORD_BYTES, S.TOO_LARGE)
        .when(broken, S.JSON_PARSE_ERROR)
        .when(F.col("encoding") != S.PLAIN_ENCODING, S.BINARY)
        .when(F.col("bad_warc_header"), S.JSON_PARSE_ERROR)
        .when(F.col("other_type"), S.NO_RESPONSE_RECORD)
        .when(no_id, S.NO_ID)
        .when(F.col("bad_http_header"), S.JSON_PARSE_ERROR)
        .alias("status"),
        "warc_trec_id",
        "warc_record_id",
        "warc_target_uri",
        "content_type_header",
        "date_header",
        "body",
    )


def with_ids(classified: DataFrame, uuid_prefix: str) -> DataFrame:
    """Add the join key, the document UUID, the URI parts and the HTTP fields."""
    keyed = classified.withColumn(
        "id", ids.join_key(F.col("warc_trec_id"), F.col("warc_record_id"))
    )
    uri = F.col("warc_target_uri")
    return keyed.select(
        "key",
        "status",
        "id",
        ids.document_uuid(uuid_prefix, F.col("id")).alias("uuid"),
        "warc_trec_id",
        "warc_record_id",
        "warc_target_uri",
        ids.uri_host(uri).alias("warc_target_hostname"),
        ids.uri_path(uri).alias("warc_target_path"),
        ids.uri_query(uri).alias("warc_target_query_string"),
        H.content_type(F.col("content_type_header")).alias("content_type"),
        H.http_date(F.col("date_header")).alias("date"),
        "body",
    )


def passed(classified: DataFrame) -> DataFrame:
    """Records that no record filter dropped."""
    return classified.where(F.col("status").isNull())
