"""Text fields of a page: full text, language, main text, headings, title, meta tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from webloom import schema as S
from webloom.functions import html
from webloom.functions.language import LanguageModel
from webloom.functions.text import strip_controls, truncate_snippet, utf16_length


def with_markup(pages: DataFrame, body: str = "body") -> DataFrame:
    """Replace the raw HTML by ``clean`` markup and its ``marked`` body."""
    cleaned = pages.withColumn("clean", html.clean_markup(F.col(body))).drop(body)
    marked = cleaned.withColumn("marked", html.marked_body(F.col("clean")))
    return marked.withColumn("marked", html.decode_entities(F.col("marked")))


def with_texts(marked: DataFrame) -> DataFrame:
    """Add ``full_body`` and the candidate ``paragraphs``."""
    return marked.withColumns(
        {
            "full_body": html.full_text(F.col("marked")),
            "paragraphs": html.paragraphs(F.col("marked")),
        }
    )


def with_languages(texts: DataFrame, model: LanguageModel) -> DataFrame:
    """Add ``lang`` of the full text and ``paragraph_langs``: one narrow Arrow step.

    The page and its paragraphs are scored where they are. Nothing is exploded, so page
    bodies do not have to be joined back to their languages.
    """
    every_text = F.concat(F.array("full_body"), F.col("paragraphs"))
    found = texts.withColumn("langs", model.detect_each(every_text))
    return found.withColumns(
        {
            "lang": F.get("langs", 0),
            "paragraph_langs": F.slice("langs", 2, F.size("paragraphs")),
        }
    ).drop("langs")


def with_main_text(detected: DataFrame) -> DataFrame:
    """Add ``main_text``: the paragraphs in the page's language or in English."""
    langs = F.col("paragraph_langs")
    kept = F.filter(
        "paragraphs",
        lambda p, i: langs[i].isin(S.ALWAYS_KEPT_LANG) | (langs[i] == F.col("lang")),
    )
    return detected.withColumn("main_text", F.array_join(kept, " "))


def extract_text(pages: DataFrame, model: LanguageModel) -> DataFrame:
    """From raw ``body`` to ``full_body``, ``lang`` and ``main_text``."""
    return with_main_text(with_languages(with_texts(with_markup(pages)), model)).drop(
        "paragraphs", "paragraph_langs"
    )


def is_too_small():
    return F.octet_length("main_text") < S.MIN_MAIN_TEXT_BYTES


def has_content():
    """Some text remains after a trim: the last test before a document is emitted."""
    return strip_controls(F.col("main_text")) != ""


def with_head_fields(extracted: DataFrame, heading_separator: str = "") -> DataFrame:
    """Headings, title and meta tags. Each text exists as a column before it is cut."""
    clean, metas = F.col("clean"), F.col("metas")
    single = F.array(
        html.raw_title(clean), html.raw_meta(metas, "description"), html.raw_meta(metas, "keywords")
    )
    fragments = F.concat(single, html.heading_fragments(F.col("heading_parts")))
    tagged = extracted.withColumns(
        {"metas": html.meta_tags(clean), "heading_parts": html.heading_parts(clean)}
    )
    read = tagged.withColumn("head", html.decoded(fragments)).drop("metas", "heading_parts")
    title, n = F.get("head", 0), F.size("head")
    named = read.withColumns(
        {
            "title": F.when(title != "", title).otherwise(html.body_text(F.col("marked"))),
            "meta_desc": F.get("head", 1),
            "meta_keywords": F.get("head", 2),
            "headings": F.array_join(F.slice("head", 4, n), heading_separator),
        }
    ).drop("head")
    return named.withColumns(
        {
            "title": truncate_snippet(F.col("title"), S.TITLE_CHARS),
            "meta_desc": truncate_snippet(F.col("meta_desc"), S.META_CHARS),
            "meta_keywords": truncate_snippet(F.col("meta_keywords"), S.META_CHARS),
        }
    )


def with_page_fields(extracted: DataFrame, *keep: str) -> DataFrame:
    """The page columns of the index document, and ``keep``; run it after the text filters."""
    filled = with_head_fields(extracted).withColumn(
        "body_length", utf16_length(F.col("main_text"))
    )
    return filled.withColumnRenamed("main_text", "body").select(*keep, *S.PAGE_COLUMNS)
