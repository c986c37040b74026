"""Rank lines: parse and reduce to one value per id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _fields() -> Column:
    return F.split("value", r"\s+")


def _ranked(lines: DataFrame, id_at: int, rank_at: int, name: str, kind: str, mode: str) -> DataFrame:
    if mode not in ("permissive", "failfast"):
        raise ValueError(f"unknown mode {mode!r}")
    parts = lines.select(_fields().alias("parts"))
    if mode == "failfast":
        text = F.element_at("parts", rank_at)
        return parts.select(
            F.element_at("parts", id_at).alias("id"), text.cast(kind).alias(name)
        )
    text = F.try_element_at("parts", F.lit(rank_at))
    rows = parts.select(
        F.try_element_at("parts", F.lit(id_at)).alias("id"), text.try_cast(kind).alias(name)
    )
    return rows.where((F.col("id") != "") & F.col(name).isNotNull())


# Why a line is dropped.
NO_ID, NO_RANK, NO_NUMBER = "no id", "no rank", "rank is no number"
SAMPLE_CHARS = 200


def line_outcomes(lines: DataFrame, id_at: int, rank_at: int, kind: str) -> DataFrame:
    """``value, reason`` of every line: why ``permissive`` drops it, NULL where it is kept."""
    parts = lines.select("value", _fields().alias("parts"))
    given = F.try_element_at("parts", F.lit(rank_at))
    reason = (
        F.when(F.coalesce(F.try_element_at("parts", F.lit(id_at)), F.lit("")) == "", NO_ID)
        .when(F.coalesce(given, F.lit("")) == "", NO_RANK)
        .when(given.try_cast(kind).isNull(), NO_NUMBER)
    )
    return parts.select("value", reason.alias("reason"))


def spam_outcomes(lines: DataFrame) -> DataFrame:
    return line_outcomes(lines, 2, 1, "bigint")


def page_rank_outcomes(lines: DataFrame) -> DataFrame:
    return line_outcomes(lines, 1, 2, "float")


def line_counts(outcomes: DataFrame) -> DataFrame:
    """``reason, n, first, last``: number of lines by reason, and two of them, cut, to look at.

    One aggregation with a map-side part, so a task that is run again counts once, and a file that is all bad
    costs as little as a good one.
    """
    cut = F.substring("value", 1, SAMPLE_CHARS)
    return outcomes.groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"), F.min(cut).alias("first"), F.max(cut).alias("last")
    )


def parse_spam(lines: DataFrame, mode: str = "permissive") -> DataFrame:
    """``<rank> <id>`` lines. ``failfast`` raises on a bad line, ``permissive`` drops it."""
    return _ranked(lines, 2, 1, "spam_rank", "bigint", mode)


def parse_page_ranks(lines: DataFrame, mode: str = "permissive") -> DataFrame:
    """``<id> <rank>`` lines; modes as for spam ranks."""
    return _ranked(lines, 1, 2, "page_rank", "float", mode)


def highest(ranks: DataFrame) -> DataFrame:
    """One row per id: the highest value if an id is listed more than once."""
    name = next(c for c in ranks.columns if c != "id")
    return ranks.groupBy("id").agg(F.max(name).alias(name))
