"""The index build: pages and side inputs to one document per id."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from webloom import schema as S
from webloom.functions.language import LanguageModel
from webloom.operators import anchors as A, content, counters, merge, ranks, records as R
from webloom.operators.live import IdFilter
from webloom.session import Scratch


@dataclass(frozen=True)
class Inputs:
    """Everything one build reads. Side inputs are lines and may be missing."""

    records: DataFrame
    spam: DataFrame | None = None
    page_ranks: DataFrame | None = None
    anchors: DataFrame | None = None


@dataclass(frozen=True)
class Sides:
    """Parsed side inputs and the ids they mention.

    ``spam`` and ``page_ranks`` are unique on ``id``, ``anchors`` on ``id`` and text. Anchors that
    are not scored have no ``lang`` yet. Where ``heavy`` is given, the ids in it have their anchors dealt
    to ``salts`` groups by a column ``salt``, and all others have salt 0.
    """

    spam: DataFrame | None = None
    page_ranks: DataFrame | None = None
    anchors: DataFrame | None = None
    anchor_ids: DataFrame | None = None
    heavy: DataFrame | None = None

    @property
    def id_frames(self) -> list[DataFrame]:
        return [f for f in (self.spam, self.page_ranks, self.anchor_ids) if f is not None]


def read_sides(
    inputs: Inputs, model: LanguageModel | None, mode: str = "permissive", live: IdFilter | None = None
) -> Sides:
    """Parse the side inputs. Every step before the grouping by id is narrow.

    Without a model the anchors stay without their languages, to be scored after they have met their
    documents. ``live`` drops most anchors of other ids before anything is done with them.
    """
    spam = pr = found = anchor_ids = None
    if inputs.spam is not None:
        spam = ranks.highest(ranks.parse_spam(inputs.spam, mode))
    if inputs.page_ranks is not None:
        pr = ranks.highest(ranks.parse_page_ranks(inputs.page_ranks, mode))
    if inputs.anchors is not None:
        parsed = A.parse_anchors(inputs.anchors)
        anchor_ids = parsed.select("id")
        cut = A.cut_anchors(parsed if live is None else live.keep(parsed))
        found = A.distinct_anchors(cut) if model is None else A.scored_anchors(cut, model)
    return Sides(spam, pr, found, anchor_ids)


class Watch:
    """Counts the outcomes of a build while its documents are written.

    Attach it to one build, run one write, then read ``counters``. The records are not read
    a second time for their counts. Rows of a stage that Spark has to run again, because an
    executor was lost, count again; ``job_counters`` is exact in that case too.
    """

    def __init__(self) -> None:
        self._records, self._texts, self._documents = (Observation() for _ in range(3))

    def records(self, classified: DataFrame) -> DataFrame:
        status = F.col("status")
        names = [n for n, s in S.STATUS_COUNTERS.items() if s not in (S.TOO_SMALL, S.RECORD)]
        counts = [F.count_if(status == S.STATUS_COUNTERS[n]).alias(n) for n in names]
        total = F.count(F.lit(1)).alias(S.TOTAL_RECORDS)
        return classified.observe(self._records, total, *counts)

    def texts(self, extracted: DataFrame) -> DataFrame:
        return extracted.observe(
            self._texts,
            F.count_if(F.col("lang") == S.UNKNOWN_LANG).alias(S.LANGDETECT_FAILED),
            F.count_if(content.is_too_small()).alias("SKIPPED_RECORDS_TOO_SMALL"),
            F.count_if(~content.is_too_small()).alias("RECORDS"),
        )

    def finish(self, documents: DataFrame) -> DataFrame:
        return documents.observe(self._documents, F.count(F.lit(1)).alias(S.GENERATED_DOCS))

    def counters(self, orphans: int) -> dict[str, int]:
        """All counters, once the write is done."""
        seen = {**self._records.get, **self._texts.get, **self._documents.get}
        return {**seen, S.HTML_PARSE_ERRORS: 0, S.NO_CONTENT: orphans}


def orphan_count(documents: DataFrame, sides: Sides) -> int:
    """Ids known to a side input only; main text is never blank, so no other id lacks content."""
    return merge.orphan_ids(documents, *sides.id_frames).count() if sides.id_frames else 0


def extract_pages(
    records: DataFrame, model: LanguageModel, uuid_prefix: str, watch: Watch | None = None
) -> DataFrame:
    """One row per record that becomes a page with content; a single narrow stage.

    The cheap record filters run before the markup is touched, the main-text filters before
    headings, title and meta tags are read.
    """
    classified = R.classify(R.parse_envelope(records))
    if watch is not None:
        classified = watch.records(classified)
    extracted = content.extract_text(R.with_ids(R.passed(classified), uuid_prefix), model)
    if watch is not None:
        extracted = watch.texts(extracted)
    return content.with_page_fields(
        extracted.where(~content.is_too_small() & content.has_content())
    )


def attach_ranks(pages: DataFrame, sides: Sides) -> DataFrame:
    """Left-join the ranks on ``id``.

    Pages arrive hash-partitioned by id from the duplicate merge and every side is unique on
    id, so the joins reuse that partitioning: the page texts cross the network once.
    """
    joined = merge.join_side(pages, sides.spam, "spam_rank", "bigint")
    return merge.join_side(joined, sides.page_ranks, "page_rank", "float")


def with_anchors(documents: DataFrame, anchors: DataFrame | None) -> DataFrame:
    """``documents`` with all their anchors nested in one column; an error if one has too many."""
    nested = None if anchors is None else A.nested_anchors(anchors)
    return merge.join_side(
        documents, nested, "anchors", "array<struct<lang:string,texts:array<string>>>"
    )


def attach_sides(pages: DataFrame, sides: Sides) -> DataFrame:
    """Ranks and nested anchors."""
    return with_anchors(attach_ranks(pages, sides), sides.anchors)


def index_anchors(documents: DataFrame, sides: Sides, model: LanguageModel | None = None) -> DataFrame:
    """``uuid, lang, anchor, n``: the anchors of all documents as flat rows, whatever their number.

    Anchors that are not scored yet are scored here with ``model``: those of documents, and no others.
    The key of a heavy id goes to each of its groups, so that no task has to take all of its anchors.
    """
    keys, on = documents.select("id", "uuid"), ["id"]
    if sides.heavy is not None:
        salts = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
        keys = keys.join(sides.heavy, "id", "left").select("id", "uuid", F.explode(salts).alias("salt"))
        on = ["id", "salt"]
    joined = keys.join(sides.anchors, on)
    if "lang" not in sides.anchors.columns:
        joined = A.with_anchor_langs(joined, model)
    return joined.select("uuid", "lang", "anchor", "n")


def build_pages(
    records: DataFrame, model: LanguageModel, uuid_prefix: str, watch: Watch | None = None
) -> DataFrame:
    """Pages with content, one per id."""
    return merge.merge_duplicates(extract_pages(records, model, uuid_prefix, watch))


def index_documents(inputs: Inputs, model: LanguageModel, uuid_prefix: str) -> DataFrame:
    """The index documents of one build, anchors nested: whole documents, or an error.

    Where a document may have more anchor texts than fit one row, take ``index_tables``.
    """
    pages = build_pages(inputs.records, model, uuid_prefix)
    return attach_sides(pages, read_sides(inputs, model))


def stage_records(
    records: DataFrame, model: LanguageModel, uuid_prefix: str, scratch: Scratch
) -> DataFrame:
    """Write the outcome of every record, with the page where it becomes one (``is_page``); read it back.

    The texts are extracted once, in one narrow stage, and survive the loss of executors. A task that
    is run again leaves one set of rows, so counts of these rows are exact. ``row`` names a row.
    """
    classified = R.classify(R.parse_envelope(records))
    # a dropped record carries no body through the text steps, a small page none through the head fields
    body = F.when(F.col("status").isNull(), F.col("body"))
    read = content.extract_text(R.with_ids(classified.withColumn("body", body), uuid_prefix), model)
    alive = F.col("status").isNull()
    status = F.coalesce("status", F.when(content.is_too_small(), S.TOO_SMALL).otherwise(S.RECORD))
    is_page = F.coalesce(alive & ~content.is_too_small() & content.has_content(), F.lit(False))
    found = read.select(
        *(c for c in read.columns if c != "status"), status.alias("status"), is_page.alias("is_page")
    )
    kept = {c: F.when(F.col("is_page"), F.col(c)) for c in ("clean", "marked", "full_body", "main_text")}
    pages = content.with_page_fields(found.withColumns(kept), "status", "is_page")
    return scratch.store(pages.withColumn("row", F.monotonically_increasing_id()), "pages")


def staged_counters(staged: DataFrame) -> dict[str, int]:
    """The record counters of staged records, exact whatever tasks were run again."""
    status = F.col("status")
    counts = [F.count_if(status == s).alias(n) for n, s in S.STATUS_COUNTERS.items()]
    unknown = status.isin(S.TOO_SMALL, S.RECORD) & (F.col("lang") == S.UNKNOWN_LANG)
    total = F.count(F.lit(1)).alias(S.TOTAL_RECORDS)
    return staged.agg(total, *counts, F.count_if(unknown).alias(S.LANGDETECT_FAILED)).first().asDict()


def staged_documents(staged: DataFrame, sides: Sides, scratch: Scratch) -> DataFrame:
    """Documents of staged pages with their ranks.

    Winners are chosen, and ranks joined, on rows of id and row number; the texts of the winners are
    fetched last. Texts are moved at most once and never sorted.
    """
    pages = staged.where("is_page").drop("status", "is_page")
    won = attach_ranks(merge.winners(pages, scratch), sides)
    return pages.join(won.drop("id"), "row").drop("row")


def index_tables(
    inputs: Inputs, model: LanguageModel, uuid_prefix: str, folder: str | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Documents with their ranks, and their anchors as flat rows: works at any size.

    The pages are staged first. Anchor lines of other ids are then mostly dropped where they are
    read, and only anchors that meet a document are scored.
    """
    scratch = Scratch(inputs.records.sparkSession, folder)
    staged = stage_records(inputs.records, model, uuid_prefix, scratch)
    live = None if inputs.anchors is None else IdFilter.of(staged.where("is_page").select("id"))
    sides = read_sides(inputs, None, live=live)
    documents = staged_documents(staged, sides, scratch)
    if sides.anchors is None:
        return documents, None
    keys = scratch.store(documents.select("id", "uuid"), "keys")
    return documents, index_anchors(keys, sides, model)


def record_outcomes(records: DataFrame, model: LanguageModel) -> DataFrame:
    """``key, id, status, lang, has_content`` of every input record.

    Dropped records carry a NULL body through the text steps, which costs nothing there.
    """
    classified = R.classify(R.parse_envelope(records))
    body = F.when(F.col("status").isNull(), F.col("body"))
    texts = content.extract_text(
        classified.select(
            "key",
            F.coalesce("warc_trec_id", "warc_record_id").alias("id"),
            "status",
            body.alias("body"),
        ),
        model,
    )
    alive = F.col("status").isNull()
    status = F.coalesce(
        "status",
        F.when(content.is_too_small(), S.TOO_SMALL).otherwise(S.RECORD),
    )
    return texts.select(
        "key",
        "id",
        F.when(alive, F.col("lang")).alias("lang"),
        (alive & ~content.is_too_small() & content.has_content()).alias("has_content"),
        status.alias("status"),
    )


def record_status(records: DataFrame, model: LanguageModel) -> DataFrame:
    """``key, status`` of every input record."""
    return record_outcomes(records, model).select("key", "status")


def job_counters(inputs: Inputs, model: LanguageModel) -> DataFrame:
    sides = read_sides(inputs, model)
    return counters.job_counters(record_outcomes(inputs.records, model), *sides.id_frames)


def job_summary(inputs: Inputs, model: LanguageModel) -> DataFrame:
    sides = read_sides(inputs, model)
    return counters.job_summary(record_outcomes(inputs.records, model), *sides.id_frames)
