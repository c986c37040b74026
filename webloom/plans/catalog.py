"""Every operator and query of the engine on the sample tables, by name.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from webloom import schema as S
from webloom.functions import headers as H, text as X
from webloom.functions.language import LanguageModel, profile
from webloom.operators import anchors as A, content as C, merge, ranks, records as R
from webloom.plans import batches, index_build as B
from webloom.session import Scratch, checkpoint_dir, prepare
from webloom.sinks import documents as D
from webloom.sinks.generations import Index
from webloom.sources import containers, demo

Query = Callable[[SparkSession, str], DataFrame]
PREFIX = demo.UUID_PREFIX
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(prepare(spark), sf_dir)

    QUERIES[run.__name__] = prepared
    return run


# ---- shared inputs -------------------------------------------------------------------


@lru_cache(maxsize=8)
def _fitted(application: str, sf_dir: str) -> LanguageModel:
    spark = SparkSession.getActiveSession()
    return LanguageModel.fit(demo.documents(spark, sf_dir))


def model(spark: SparkSession, sf_dir: str) -> LanguageModel:
    """The model of this table, fitted once per application."""
    return _fitted(spark.sparkContext.applicationId, sf_dir)


def inputs(spark: SparkSession, sf_dir: str, visit: int = 1) -> B.Inputs:
    return B.Inputs(
        demo.records(spark, sf_dir, visit),
        demo.spam_lines(spark, sf_dir),
        demo.page_rank_lines(spark, sf_dir),
        demo.anchor_lines(spark, sf_dir),
    )


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.classify(R.parse_envelope(demo.records(spark, sf_dir)))


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.with_ids(R.passed(classified(spark, sf_dir)), PREFIX)


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.extract_text(keyed(spark, sf_dir), model(spark, sf_dir))


def pages(spark: SparkSession, sf_dir: str, visit: int = 1) -> DataFrame:
    return B.extract_pages(demo.records(spark, sf_dir, visit), model(spark, sf_dir), PREFIX)


def parsed_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.parse_anchors(demo.anchor_lines(spark, sf_dir))


def detected_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.with_anchor_langs(A.cut_anchors(parsed_anchors(spark, sf_dir)), model(spark, sf_dir))


def scored_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.scored_anchors(A.cut_anchors(parsed_anchors(spark, sf_dir)), model(spark, sf_dir))


def spam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.highest(ranks.parse_spam(demo.spam_lines(spark, sf_dir)))


def page_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.highest(ranks.parse_page_ranks(demo.page_rank_lines(spark, sf_dir)))


def _rounded(rank: str = "page_rank") -> Column:
    return F.round(F.col(rank).cast("double"), 6).alias(rank)


def flat(documents: DataFrame) -> DataFrame:
    """Index documents with anchors as one text: ``lang: text | text`` per language."""
    texts = F.transform(
        "anchors", lambda a: F.concat(a["lang"], F.lit(": "), F.array_join(a["texts"], " | "))
    )
    return documents.withColumn("anchors", F.array_join(texts, "\n")).withColumn(
        "page_rank", _rounded()
    )


# ---- scans ---------------------------------------------------------------------------


@query
def scan_records(spark, sf_dir):
    return demo.records(spark, sf_dir)


@query
def batch_slice(spark, sf_dir):
    container = demo.container_of(F.col("key"))
    return demo.records(spark, sf_dir).select(
        "key",
        container.alias("container"),
        containers.batch_number(container, 3, demo.CONTAINERS).alias("batch"),
        containers.batch_number(container, 3, demo.CONTAINERS, strict=True).alias("strict_batch"),
    )


@query
def scan_spam_ranks(spark, sf_dir):
    return demo.spam_lines(spark, sf_dir)


@query
def scan_page_ranks(spark, sf_dir):
    return demo.page_rank_lines(spark, sf_dir)


@query
def scan_anchors(spark, sf_dir):
    return demo.anchor_lines(spark, sf_dir)


# ---- record filters: the records left after each rule ----------------------------------


def _left_after(spark, sf_dir, *dropped: str) -> DataFrame:
    status = F.col("status")
    return classified(spark, sf_dir).where(status.isNull() | ~status.isin(*dropped)).select("key")


FILTER_ORDER = [S.TOO_LARGE, S.JSON_PARSE_ERROR, S.BINARY, S.NO_RESPONSE_RECORD, S.NO_ID]


@query
def filter_oversize(spark, sf_dir):
    return _left_after(spark, sf_dir, *FILTER_ORDER[:1])


@query
def filter_json_error(spark, sf_dir):
    return _left_after(spark, sf_dir, *FILTER_ORDER[:2])


@query
def filter_binary(spark, sf_dir):
    return _left_after(spark, sf_dir, *FILTER_ORDER[:3])


@query
def filter_response(spark, sf_dir):
    return _left_after(spark, sf_dir, *FILTER_ORDER[:4])


@query
def filter_no_id(spark, sf_dir):
    return _left_after(spark, sf_dir, *FILTER_ORDER)


@query
def filter_too_small(spark, sf_dir):
    return (
        extracted(spark, sf_dir)
        .where(~C.is_too_small())
        .select("key", F.octet_length("main_text").cast("bigint").alias("main_bytes"))
    )


@query
def filter_no_content(spark, sf_dir):
    return extracted(spark, sf_dir).where(~C.is_too_small() & C.has_content()).select("id")


# ---- record fields ---------------------------------------------------------------------


@query
def parse_envelope(spark, sf_dir):
    return R.parse_envelope(demo.records(spark, sf_dir)).select(
        "key",
        "n_bytes",
        F.size("metadata").cast("bigint").alias("n_metadata"),
        F.size("headers").cast("bigint").alias("n_headers"),
        "encoding",
        "body",
    )


@query
def header_lookup(spark, sf_dir):
    envelope = R.parse_envelope(demo.records(spark, sf_dir))
    return envelope.select(
        "key",
        H.header(F.col("metadata"), S.WARC_TYPE).alias("warc_type"),
        H.header(F.col("metadata"), S.WARC_TARGET_URI).alias("warc_target_uri"),
        H.header(F.col("headers"), S.HTTP_CONTENT_TYPE).alias("content_type"),
        H.header(F.col("headers"), S.HTTP_DATE).alias("date"),
    )


@query
def record_ids(spark, sf_dir):
    return classified(spark, sf_dir).select("key", "warc_trec_id", "warc_record_id")


@query
def join_key(spark, sf_dir):
    return keyed(spark, sf_dir).select("key", "id")


@query
def doc_uuid(spark, sf_dir):
    return keyed(spark, sf_dir).select("id", "uuid")


@query
def uri_host(spark, sf_dir):
    return keyed(spark, sf_dir).select("key", "warc_target_uri", "warc_target_hostname")


@query
def uri_path(spark, sf_dir):
    return keyed(spark, sf_dir).select("key", "warc_target_uri", "warc_target_path")


@query
def uri_query(spark, sf_dir):
    return keyed(spark, sf_dir).select("key", "warc_target_uri", "warc_target_query_string")


@query
def content_type(spark, sf_dir):
    return keyed(spark, sf_dir).select("key", "content_type")


@query
def http_date(spark, sf_dir):
    return keyed(spark, sf_dir).select("key", "date")


# ---- page texts ------------------------------------------------------------------------


@query
def full_text(spark, sf_dir):
    return C.with_texts(C.with_markup(keyed(spark, sf_dir))).select("key", "full_body")


@query
def lang_profile(spark, sf_dir):
    return profile(demo.documents(spark, sf_dir))


@query
def detect_lang(spark, sf_dir):
    return extracted(spark, sf_dir).select("key", "lang")


@query
def paragraphs(spark, sf_dir):
    texts = C.with_texts(C.with_markup(keyed(spark, sf_dir)))
    detected = C.with_languages(texts, model(spark, sf_dir))
    zipped = F.arrays_zip("paragraphs", "paragraph_langs")
    return detected.select("key", F.posexplode(zipped).alias("pos", "p")).select(
        "key",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("p.paragraphs").alias("text"),
        F.col("p.paragraph_langs").alias("lang"),
    )


@query
def main_content(spark, sf_dir):
    return extracted(spark, sf_dir).select("key", "lang", "main_text")


@query
def body_length(spark, sf_dir):
    return pages(spark, sf_dir).select("id", "body_length")


def _head_fields(spark, sf_dir) -> DataFrame:
    return C.with_head_fields(C.with_markup(keyed(spark, sf_dir)))


@query
def headings(spark, sf_dir):
    return _head_fields(spark, sf_dir).select("key", "headings")


@query
def doc_title(spark, sf_dir):
    return _head_fields(spark, sf_dir).select("key", "title")


@query
def meta_description(spark, sf_dir):
    return _head_fields(spark, sf_dir).select("key", "meta_desc")


@query
def meta_keywords(spark, sf_dir):
    return _head_fields(spark, sf_dir).select("key", "meta_keywords")


@query
def truncate_snippet(spark, sf_dir):
    text = F.col("text")
    return demo.table(spark, sf_dir, "documents").select(
        "doc_id",
        X.truncate_snippet(text, 20).alias("snippet_20"),
        X.truncate_snippet(text, S.TITLE_CHARS).alias("snippet_90"),
        X.truncate_snippet(text, S.META_CHARS).alias("snippet_400"),
    )


@query
def lang_fields(spark, sf_dir):
    return pages(spark, sf_dir).select(
        "uuid",
        *(F.to_json(D.language_field(v)).alias(k) for k, v in D.LANGUAGE_FIELDS.items()),
    )


# ---- side inputs -----------------------------------------------------------------------


@query
def spam_parse(spark, sf_dir):
    return ranks.parse_spam(demo.spam_lines(spark, sf_dir))


@query
def page_rank_parse(spark, sf_dir):
    return ranks.parse_page_ranks(demo.page_rank_lines(spark, sf_dir)).select("id", _rounded())


@query
def side_line_drops(spark, sf_dir):
    """Lines kept and dropped, by reason, where either rank input holds the other's lines as well."""
    spam_like, rank_like = demo.spam_lines(spark, sf_dir), demo.page_rank_lines(spark, sf_dir)
    both = spam_like.unionByName(rank_like)
    counted = {
        "spam": ranks.spam_outcomes(both),
        "page_ranks": ranks.page_rank_outcomes(both),
        "anchors": A.anchor_outcomes(demo.anchor_lines(spark, sf_dir)),
    }
    named = [ranks.line_counts(o).withColumn("input", F.lit(i)) for i, o in counted.items()]
    return reduce(DataFrame.unionByName, named).withColumn("reason", F.coalesce("reason", F.lit("kept")))


@query
def anchor_parse(spark, sf_dir):
    return parsed_anchors(spark, sf_dir)


@query
def anchor_cut(spark, sf_dir):
    return A.cut_anchors(parsed_anchors(spark, sf_dir))


@query
def anchor_lang(spark, sf_dir):
    return detected_anchors(spark, sf_dir)


@query
def live_anchors(spark, sf_dir):
    return A.live_anchors(A.cut_anchors(parsed_anchors(spark, sf_dir)), pages(spark, sf_dir))


@query
def anchors_by_lang(spark, sf_dir):
    nested = A.nested_anchors(scored_anchors(spark, sf_dir))
    return nested.select("id", F.inline("anchors")).select(
        "id",
        "lang",
        F.size("texts").cast("bigint").alias("n_texts"),
        F.array_join("texts", " | ").alias("texts"),
    )


# ---- joins, merges, counters -------------------------------------------------------------


@query
def join_spam(spark, sf_dir):
    joined = merge.join_side(keyed(spark, sf_dir), spam(spark, sf_dir), "spam_rank", "bigint")
    return joined.select("id", "spam_rank")


@query
def join_page_rank(spark, sf_dir):
    joined = merge.join_side(keyed(spark, sf_dir), page_ranks(spark, sf_dir), "page_rank", "float")
    return joined.select("id", _rounded())


@query
def join_anchors(spark, sf_dir):
    nested = A.nested_anchors(scored_anchors(spark, sf_dir))
    joined = keyed(spark, sf_dir).select("id").join(nested, "id", "left")
    return joined.select(
        "id",
        F.coalesce(F.size("anchors"), F.lit(0)).cast("bigint").alias("n_langs"),
        F.aggregate("anchors", F.lit(0).cast("bigint"), lambda n, a: n + F.size(a["texts"])).alias(
            "n_texts"
        ),
    )


@query
def join_all(spark, sf_dir):
    sides = B.read_sides(inputs(spark, sf_dir), model(spark, sf_dir))
    joined = B.attach_sides(keyed(spark, sf_dir).select("id", "uuid"), sides)
    return flat(joined)


@query
def orphan_ids(spark, sf_dir):
    sides = B.read_sides(inputs(spark, sf_dir), model(spark, sf_dir))
    return merge.orphan_ids(pages(spark, sf_dir), *sides.id_frames)


@query
def merge_duplicates(spark, sf_dir):
    scratch = Scratch(spark)
    both = pages(spark, sf_dir, 1).unionByName(pages(spark, sf_dir, 2))
    stored = scratch.store(both.withColumn("row", F.monotonically_increasing_id()), "pages")
    return stored.join(merge.winners(stored, scratch).drop("id"), "row").drop("row")


@query
def record_status(spark, sf_dir):
    return B.record_status(demo.records(spark, sf_dir), model(spark, sf_dir))


@query
def job_counters(spark, sf_dir):
    return B.job_counters(inputs(spark, sf_dir), model(spark, sf_dir))


@query
def job_summary(spark, sf_dir):
    return B.job_summary(inputs(spark, sf_dir), model(spark, sf_dir))


# ---- whole builds --------------------------------------------------------------------------


@query
def index_documents(spark, sf_dir):
    return flat(B.index_documents(inputs(spark, sf_dir), model(spark, sf_dir), PREFIX))


@query
def index_anchors(spark, sf_dir):
    return B.index_tables(inputs(spark, sf_dir), model(spark, sf_dir), PREFIX)[1]


@query
def index_documents_batch(spark, sf_dir):
    given = inputs(spark, sf_dir)

    def slice_of(batch: containers.Batch) -> DataFrame:
        return given.records.where(batch.contains(demo.container_of(F.col("key"))))

    slices = batches.batches(3, demo.CONTAINERS)
    return flat(batches.build_all(slice_of, given, model(spark, sf_dir), PREFIX, slices))


@query
def index_json(spark, sf_dir):
    built = B.index_documents(inputs(spark, sf_dir), model(spark, sf_dir), PREFIX)
    return D.as_json(D.stored_form(built))


@query
def upsert_runs(spark, sf_dir):
    """Two crawls written to one index by the sink, in batches of different number; the second replaces pages."""
    given = [inputs(spark, sf_dir, visit) for visit in (1, 2)]
    fitted, path = model(spark, sf_dir), f"{checkpoint_dir(spark)}/webloom_index_{uuid.uuid4().hex}"
    container = demo.container_of(F.col("key"))
    for run, number_of in zip(given, (2, 1)):
        records = run.records if number_of == 2 else run.records.where(container % 3 != 0)
        of = lambda b, r=records: r.where(b.contains(container))
        batches.write_all(of, run, fitted, PREFIX, batches.batches(number_of, demo.CONTAINERS), path)
    index = Index(spark, path)
    now = index.snapshot()
    texts = index.anchors(now).groupBy("uuid").agg(F.count("*").alias("n_anchors"), F.sum("n").alias("n_lines"))
    return (
        index.documents(now)
        .join(texts, "uuid", "left")
        .select(*S.PAGE_COLUMNS, "spam_rank", _rounded(), "n_anchors", "n_lines")
    )


@query
def upsert_documents(spark, sf_dir):
    return merge.merge_builds([pages(spark, sf_dir, 1), pages(spark, sf_dir, 2)])
