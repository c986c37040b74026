"""One document per id: duplicate pages, left joins with the side inputs, orphans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from webloom.session import Scratch

TEXTS = ["body", "full_body", "headings", "title", "meta_desc", "meta_keywords"]


BUILD = "build"


def merge_duplicates(pages: DataFrame) -> DataFrame:
    """Keep one whole page per id: the latest date, ties broken by stable columns.

    Pages of several builds carry the number of theirs in ``build``: the last build that has an
    id wins it, and the date decides within that build.

    Catalyst turns the rank filter into a per-task limit of one row per id before the
    shuffle, so even an id with a third of all pages sends one row per task.
    """
    order = [F.desc(BUILD)] if BUILD in pages.columns else []
    order += [
        F.desc_nulls_last("date"),
        F.desc_nulls_last("warc_record_id"),
        F.desc_nulls_last("warc_target_uri"),
        F.desc("texts_md5"),
    ]
    rank = F.row_number().over(Window.partitionBy("id").orderBy(*order))
    return (
        pages.withColumn("texts_md5", F.md5(F.concat_ws("\x1f", *TEXTS)))
        .withColumn("rank", rank)
        .where(F.col("rank") == 1)
        .drop("rank", "texts_md5", BUILD)
    )


def merge_builds(builds: list[DataFrame]) -> DataFrame:
    """Pages of several builds to one page per id, through a single shuffle of their texts."""
    numbered = [b.withColumn(BUILD, F.lit(i)) for i, b in enumerate(builds)]
    return merge_duplicates(reduce(DataFrame.unionByName, numbered))


# What decides between the pages of an id, after the build; the texts decide what these leave open.
DECIDING = ["date", "warc_record_id", "warc_target_uri"]


def winners(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """``id, row`` of the page that ``merge_duplicates`` keeps, for stored pages with a unique ``row``.

    Only slim rows are grouped and shuffled, with a map-side part, so an id with a third of all pages
    sends one row per task. Texts are read, and hashed, of pages that agree in all slim columns.
    """
    keys = [*([BUILD] if BUILD in pages.columns else []), *DECIDING]
    alike = pages.groupBy("id", *keys).agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("row"))
    # nulls are smallest, and the keys of an id differ, so the number and the row decide nothing
    best = alike.groupBy("id").agg(F.max(F.struct(*keys, "n", "row")).alias("best"))
    best = scratch.store(best.select("id", "best.*"), "winners")
    tied = best.where("n > 1")
    if tied.isEmpty():
        return best.select("id", "row")
    rivals = tied.select(F.col("id").alias("of"), *(F.col(k).alias(f"of_{k}") for k in keys))
    same = [F.col("id") == F.col("of"), *(F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys)]
    texts = F.md5(F.concat_ws("\x1f", *TEXTS))
    by_text = (
        pages.join(rivals, same)
        .groupBy("id")
        .agg(F.max(F.struct(texts.alias("texts"), (-F.col("row")).alias("minus"))).alias("best"))
        .select("id", (-F.col("best.minus")).alias("row"))
    )
    return best.where("n = 1").select("id", "row").unionByName(by_text)


def join_side(pages: DataFrame, side: DataFrame | None, column: str, kind: str) -> DataFrame:
    """Left join with a side input unique on ``id``; a missing input gives NULLs."""
    if side is None:
        return pages.withColumn(column, F.lit(None).cast(kind))
    return pages.join(side, "id", "left")


def orphan_ids(documents: DataFrame, *sides: DataFrame | None) -> DataFrame:
    """Ids of side rows that no document carries.

    One aggregation over slim rows. An anti join would be pushed below the union of the
    sides, and the documents would be built once for each of them.
    """
    rows = reduce(
        DataFrame.unionByName,
        [s.select("id", F.lit(False).alias("built")) for s in sides if s is not None],
        documents.select("id", F.lit(True).alias("built")),
    )
    per_id = rows.groupBy("id").agg(F.bool_or("built").alias("built"))
    return per_id.where(~F.col("built")).select("id")
