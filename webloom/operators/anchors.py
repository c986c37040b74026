"""Anchor lines: parse, detect languages, gather per document."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from webloom import schema as S
from webloom.functions.language import LanguageModel

# Fixed value: the id shape of anchor lines.
ANCHOR_ID = r"clueweb\d{2}-\w{2}\d{4}-\d{2}-\d{5}"

# Why a line is dropped.
OTHER_LINE = "no id and text"

# Largest amount of anchor text, in bytes, that may be nested into one document.
NESTED_BYTES = 64 << 20


def parse_anchors(lines: DataFrame, id_pattern: str = ANCHOR_ID) -> DataFrame:
    """``<id> <text>`` lines as ``id, anchor``; other lines are dropped.

    The whole line must match, so a line break inside it drops the line.
    """
    line = rf"\A(?:{id_pattern})[ \t\x0B\f\r\n]+.*\z"
    matched = lines.where(F.col("value").rlike(line)).select(
        F.regexp_extract("value", rf"\A({id_pattern})\s", 1).alias("id"), "value"
    )
    rest = F.substr("value", F.char_length("id") + 1)
    return matched.select("id", F.ltrim(rest, F.lit(" \t\x0b\f\r\n")).alias("anchor"))


def anchor_outcomes(lines: DataFrame, id_pattern: str = ANCHOR_ID) -> DataFrame:
    """``value, reason`` of every line: NULL where ``parse_anchors`` keeps it."""
    line = rf"\A(?:{id_pattern})[ \t\x0B\f\r\n]+.*\z"
    kept = F.coalesce(F.col("value").rlike(line), F.lit(False))
    return lines.select("value", F.when(~kept, F.lit(OTHER_LINE)).alias("reason"))


def cut_anchors(anchors: DataFrame) -> DataFrame:
    """Hard cut of the anchor text, without regard to words."""
    return anchors.withColumn("anchor", F.substring("anchor", 1, S.ANCHOR_CHARS))


def live_anchors(anchors: DataFrame, documents: DataFrame) -> DataFrame:
    """Anchors that point to one of ``documents``: keeps the result, saves work before it."""
    return anchors.join(documents.select("id"), "id", "left_semi")


def with_anchor_langs(anchors: DataFrame, model: LanguageModel) -> DataFrame:
    return anchors.withColumn("lang", model.detect(F.col("anchor")))


def distinct_anchors(anchors: DataFrame) -> DataFrame:
    """``id, anchor, n``: every text of an id once, with its number of lines.

    Equal texts merge on the map side, and texts spread an id over all tasks, so neither a hot id
    nor a hot text gathers anywhere.
    """
    known = anchors.where(F.col("id").isNotNull() & F.col("anchor").isNotNull())
    return known.groupBy("id", "anchor").agg(F.count(F.lit(1)).alias("n"))


def scored_anchors(anchors: DataFrame, model: LanguageModel) -> DataFrame:
    """``id, lang, anchor, n``, one row per text of an id: the one layout of anchors, at any size.

    Each distinct text of an id is scored once.
    """
    return with_anchor_langs(distinct_anchors(anchors), model).select("id", "lang", "anchor", "n")


def nested_anchors(scored: DataFrame, most_bytes: int = NESTED_BYTES) -> DataFrame:
    """``id, anchors ARRAY<STRUCT<lang, texts>>``, sorted by language and text: all or an error.

    The size of every id is known before anything is gathered. An id beyond ``most_bytes`` stops
    the query: its texts would not fit one row, and leaving some out would go unnoticed. Such ids
    are read from the flat rows instead.
    """
    size = (F.octet_length("anchor") + 16) * F.col("n")
    large = (
        scored.groupBy("id")
        .agg(F.sum(size).alias("bytes"))
        .where(F.col("bytes") > most_bytes)
        .select("id", F.col("bytes").alias("too_large"))
    )
    message = F.concat(
        F.lit("anchor texts of "), F.col("id"), F.lit(" exceed the bound for one row: use the flat anchors")
    )
    checked = scored.join(large, "id", "left").withColumn(
        "anchor", F.when(F.col("too_large").isNull(), F.col("anchor")).otherwise(F.raise_error(message))
    )
    by_lang = checked.groupBy("id", "lang").agg(
        F.array_sort(F.collect_list(F.struct("anchor", "n"))).alias("texts")
    )
    repeated = F.flatten(
        F.transform("texts", lambda t: F.array_repeat(t["anchor"], t["n"].cast("int")))
    )
    return (
        by_lang.select("id", "lang", repeated.alias("texts"))
        .groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("lang", "texts"))).alias("anchors"))
    )
