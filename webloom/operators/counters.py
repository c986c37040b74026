"""Job counters and summary in one pass over slim rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from webloom import schema as S


def _flag(condition: Column) -> Column:
    return F.count_if(condition)


def counter_row(outcomes: DataFrame, *sides: DataFrame | None) -> DataFrame:
    """All counters as one row.

    ``outcomes`` has ``id, status, lang, has_content`` per input record. Records and side
    rows meet in one aggregation by id, so ids are counted without a join and the pages are
    read once. Dropped records have a NULL id and collapse on the map side.
    """
    record = outcomes.select("id", "status", "lang", "has_content")
    no_record = [F.lit(None).cast("string").alias(c) for c in ("status", "lang")]
    rows = reduce(
        DataFrame.unionByName,
        [
            s.select("id", *no_record, F.lit(False).alias("has_content"))
            for s in sides
            if s is not None
        ],
        record,
    )
    kept = F.when(F.col("status") == S.RECORD, F.col("id")).when(
        F.col("status").isNull(), F.col("id")
    )
    counts = {name: _flag(F.col("status") == value) for name, value in S.STATUS_COUNTERS.items()}
    counts[S.TOTAL_RECORDS] = _flag(F.col("status").isNotNull())
    counts[S.LANGDETECT_FAILED] = _flag(F.col("lang") == S.UNKNOWN_LANG)
    per_id = (
        rows.withColumn("id", kept)
        .groupBy("id")
        .agg(*(c.alias(n) for n, c in counts.items()), F.bool_or("has_content").alias("content"))
    )
    known = F.col("id").isNotNull()
    content = F.coalesce("content", F.lit(False))
    return per_id.agg(
        *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts),
        F.lit(0).cast("bigint").alias(S.HTML_PARSE_ERRORS),
        _flag(known & content).alias(S.GENERATED_DOCS),
        _flag(known & ~content).alias(S.NO_CONTENT),
    )


def job_counters(outcomes: DataFrame, *sides: DataFrame | None) -> DataFrame:
    """The counters as ``counter, value`` rows."""
    row = counter_row(outcomes, *sides)
    return row.unpivot([], row.columns, "counter", "value")


def job_summary(outcomes: DataFrame, *sides: DataFrame | None) -> DataFrame:
    """The figures of the final job report as one row."""
    return counter_row(outcomes, *sides).select(
        F.col(S.TOTAL_RECORDS).alias("total_records"),
        F.col("RECORDS").alias("records"),
        F.col("SKIPPED_RECORDS_TOO_LARGE").alias("skipped_too_large"),
        F.col(S.HTML_PARSE_ERRORS).alias("skipped_html_parse_error"),
        F.col(S.GENERATED_DOCS).alias("generated"),
        F.col(S.NO_CONTENT).alias("no_content"),
    )
