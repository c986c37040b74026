"""A crawl derived from the sample tables: records, ranks and anchors.

All rows of ``pages`` and ``documents`` take part. The page number decides which defect or
variation a record shows, so that every rule of the build meets matching rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from webloom.schema import MAX_RECORD_BYTES
from webloom.session import spread

UUID_PREFIX = "demo-crawl"
CONTAINERS = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"), "page_id")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "text", "lang"]
    return spread(table(spark, sf_dir, "documents").select(*columns), "doc_id")


def _digits(n: str, width: int) -> str:
    return f"lpad(cast({n} AS STRING), {width}, '0')"


def _collection_id(n: str) -> str:
    """SQL for a collection id; the number fills the groups from the right."""
    return (
        f"concat('clueweb12-en', {_digits(f'({n}) div 10000000', 4)}, '-', "
        f"{_digits(f'({n}) div 100000 % 100', 2)}, '-', {_digits(f'({n}) % 100000', 5)})"
    )


# One visit per crawl; the second visit is the same pages, unedited, a day before or after.
DATES = {
    1: "'Tue, 02 Jan 2024 03:04:'",
    2: "CASE WHEN page_id % 2 = 0 THEN 'Wed, 03 Jan 2024 03:04:' ELSE 'Mon, 01 Jan 2024 03:04:' END",
}


def _edited_html() -> Column:
    """The page with the title, meta tags, headings, alt text and padding the rules need."""
    title = F.when(
        F.expr("page_id % 6 = 5"),
        F.regexp_replace("html", "<title>[^<]*</title>", "<title></title>"),
    ).otherwise(F.col("html"))
    metas = F.expr(
        """concat('<meta name="keywords" content="k', cast(page_id % 5 AS STRING), ',  z">',
        '<meta name="description" content="', repeat(concat('word', cast(page_id % 10 AS STRING), ' '),
        cast(page_id % 200 AS INT)), CASE WHEN page_id % 5 = 4 THEN ' > more' ELSE '' END, '"><style>')"""
    )
    extra = F.expr(
        """concat('<h3>Third ', page_id, '</h3><h2> Second  ', page_id,
        '</h2><img src="i.png" alt="pic ', page_id, CASE WHEN page_id % 4 = 3 THEN ' > next' ELSE '' END,
        '"><p>The picture above shows what this page is about<a title="up > down" href=x>',
        CASE WHEN page_id % 3 = 1 THEN ' 😀' ELSE '' END, ' and the link</a></p></article>')"""
    )
    s = F.replace(title, F.lit("<style>"), metas)
    s = F.replace(s, F.lit("</article>"), extra)
    # the end of the head and the start of the body are optional; text may stand between them
    s = (
        F.when(F.expr("page_id % 17 = 16"), F.replace(s, F.lit("</head><body>"), F.lit("")))
        .when(
            F.expr("page_id % 19 = 18"),
            F.replace(s, F.lit("</head><body>"), F.lit("</head><div>Banner before the body</div><body>")),
        )
        .otherwise(s)
    )
    padding = F.repeat(F.lit("<!-- pad -->"), MAX_RECORD_BYTES // 12 + 1)
    return (
        F.when(F.expr("page_id % 31 = 30"), F.lit("<html><body>x</body></html>"))
        .when(F.expr("page_id % 97 = 96"), F.concat(s, padding))
        .otherwise(s)
    )


def record_fields(spark: SparkSession, sf_dir: str, visit: int = 1) -> DataFrame:
    """The members of each record before they are packed into an envelope."""
    null = F.lit(None).cast("string")
    body = _edited_html() if visit == 1 else F.col("html")
    return pages(spark, sf_dir).select(
        "page_id",
        F.when(F.expr("page_id % 7 = 6"), null)
        .otherwise(F.expr(_collection_id("page_id")))
        .alias("trec_id"),
        F.when(F.expr("page_id % 14 = 13 OR page_id % 9 = 8"), null)
        .otherwise(
            F.expr(f"concat('<urn:uuid:00000000-0000-4000-8000-', {_digits('page_id', 12)}, '>')")
        )
        .alias("record_id"),
        F.when(F.expr("page_id % 23 = 22"), null)
        .when(F.expr("page_id % 11 = 10"), F.lit("request"))
        .when(F.expr("page_id % 29 = 28"), F.lit("Response"))
        .otherwise(F.lit("response"))
        .alias("warc_type"),
        F.when(F.expr("page_id % 13 = 12"), F.lit("base64")).otherwise(F.lit("plain")).alias("encoding"),
        F.when(F.expr("page_id % 15 = 14"), F.concat("url", F.lit(" x")))
        .otherwise(F.col("url"))
        .alias("target_uri"),
        F.when(F.expr("page_id % 10 = 9"), null)
        .when(F.expr("page_id % 21 = 20"), F.lit("text/html\t; charset=x"))
        .when(F.expr("page_id % 3 = 0"), F.lit("text/html; charset=UTF-8"))
        .otherwise(F.lit(" text/html "))
        .alias("content_type"),
        F.when(F.expr("page_id % 12 = 11"), null)
        .when(F.expr("page_id % 8 = 7"), F.lit("not a date"))
        .when(F.expr("page_id % 25 = 24"), F.lit("Tuesday, 2 January 2024 03:04:05 GMT, or so"))
        .when(F.expr("page_id % 25 = 23"), F.lit("Thu, 32 Jan 2024 25:04:05 +0100"))
        .otherwise(F.expr(f"concat({DATES[visit]}, {_digits('page_id % 60', 2)}, ' GMT')"))
        .alias("http_date"),
        body.alias("body"),
    )


def records(spark: SparkSession, sf_dir: str, visit: int = 1) -> DataFrame:
    """``key, value`` records; the header spelling alternates and some JSON is cut off."""
    odd = F.expr("page_id % 2 = 1")
    value = F.to_json(
        F.struct(
            F.struct(
                F.when(~odd, F.col("warc_type")).alias("WARC-Type"),
                F.when(odd, F.col("warc_type")).alias("warc-type"),
                F.col("record_id").alias("WARC-Record-ID"),
                F.col("trec_id").alias("WARC-TREC-ID"),
                F.col("target_uri").alias("WARC-Target-URI"),
            ).alias("metadata"),
            F.struct(
                F.struct(
                    F.col("content_type").alias("Content-Type"), F.col("http_date").alias("Date")
                ).alias("headers"),
                "encoding",
                "body",
            ).alias("payload"),
        )
    )
    cut_off = F.expr("page_id % 37 = 36")
    return record_fields(spark, sf_dir, visit).select(
        F.col("page_id").cast("string").alias("key"),
        F.when(cut_off, F.substring(value, 1, 100)).otherwise(value).alias("value"),
    )


def container_of(key: Column) -> Column:
    """Container number of a demo record."""
    return F.pmod(key.cast("bigint"), F.lit(CONTAINERS))


def spam_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``<rank> <id>`` per page; every fourth id belongs to no page."""
    shifted = "page_id + CASE WHEN page_id % 4 = 3 THEN 90000000 ELSE 0 END"
    return table(spark, sf_dir, "pages").select(
        F.expr(f"concat((page_id * 7) % 100, ' ', {_collection_id(shifted)})").alias("value")
    )


def page_rank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``<id>  <rank>`` per page; every fifth id belongs to no page."""
    shifted = "page_id + CASE WHEN page_id % 5 = 4 THEN 90000000 ELSE 0 END"
    rank = _digits("(page_id * 37) % 10000", 4)
    return table(spark, sf_dir, "pages").select(
        F.expr(f"concat({_collection_id(shifted)}, '  0.', {rank})").alias("value")
    )


def anchor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``<id> <text>`` per document; some ids have another shape or belong to no page."""
    target = _collection_id("(doc_id * doc_id) % 300")
    return documents(spark, sf_dir).select(
        F.expr(
            f"""concat(CASE WHEN doc_id % 13 = 12 THEN concat('<urn:uuid:', doc_id, '>')
            ELSE {target} END, ' ', replace(text, chr(10), ' '))"""
        ).alias("value")
    )
