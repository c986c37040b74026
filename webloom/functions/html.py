"""Text, headings, title and meta tags of HTML pages, as native column expressions.

A page runs through three forms, each meant to be a materialised column of its own select:

* ``clean_markup``   blanks collapsed, comments gone, script and style emptied;
* ``marked_body``    tags gone, their places held by the control characters below;
* the results        ``full_text``, ``paragraphs``, ``body_text`` from the marked body;
                     titles, headings and meta tags from the clean markup.

Spark repeats an expression that is used several times inside another one, so the results
are meant to be cut to length in a later select. Every pattern runs in linear time. A tag ends at
the first ``>`` outside quoted attribute values; where a quote is left open, at the first ``>``.
Loops over attributes are possessive: they never step back, and need no stack.
"""

from __future__ import annotations

from collections.abc import Iterable
from html.entities import html5, name2codepoint

from pyspark.sql import Column, functions as F

from webloom.functions.text import squeeze, strip_controls
from webloom.schema import HEADING_LEVELS, MIN_PARAGRAPH_CHARS

# Markers in a marked body. A block start is OPEN CLOSE, a block end is OPEN / CLOSE.
OPEN, CLOSE, ALT_START, ALT_END, BREAK = "\x01", "\x02", "\x03", "\x04", "\x05"

# Element names that begin a new block of text.
BLOCK_ELEMENTS = (
    "address article aside blockquote body canvas caption center col colgroup dd del details "
    "div dl dt fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head "
    "header hgroup hr html ins li link main math menu meta nav noframes noscript ol p "
    "plaintext pre script section style svg table tbody td template tfoot th thead title tr "
    "ul video audio"
).split()

UNIT = r"""(?:[^<>"']++|"[^"<]*+"|'[^'<]*+')"""  # a stretch of a tag, or a quoted value
END = rf"(?:{UNIT}*+>|[^<>]*+>)"
TAIL = rf"(?:>|[\s/]{END})"  # what follows a tag name
VALUE = r"""\s*=\s*(?:"([^"<]*)"|'([^'<]*)'|([^\s"'>]+))"""
RAW_BLANKS = r"[ \t\n\f\r\x01-\x05]+"
UNSEEN = (
    rf"(?is)(<script{TAIL}).*?(?:</script[^<>]*>|\z)"
    rf"|(<style{TAIL}).*?(?:</style[^<>]*>|\z)"
    r"|<!--.*?(?:-->|\z)"
)
BEFORE_BODY = r"(?is)\A(.*?)<body[\s/>]"
TITLE_ELEMENT = rf"(?is)<title{TAIL}.*?(?:</title\s*>|\z)"
NO_ALT = r"""(?:(?!(?<=[\s"'/])alt\s*=)(?:[^<>"']|"[^"<]*+"|'[^'<]*+'))*+"""
ALT = rf"(?i)<[a-z]{NO_ALT}alt{VALUE}{END}"
BLOCK = rf"(?i)<(/?)(?:{'|'.join(BLOCK_ELEMENTS)}){TAIL}"
LINE_BREAK = rf"(?i)</?br{TAIL}"
TAG = rf"<(?:/?[a-zA-Z]|[!?]){END}"
TITLE = rf"(?is)<title{TAIL}(.*?)(?:</title\s*>|\z)"
HEADING = rf"(?i)<(/?)h([1-6]){TAIL}"
META = rf"(?i)<meta[\s/]{END}"
META_CONTENT = rf"""(?i)[\s"'/]content(?:{VALUE}|[\s/>])"""
REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*)"


def meta_name_pattern(name: str) -> str:
    return rf"""[\s"'/](?i:name)\s*=\s*(?:"{name}"|'{name}'|{name}[\s/>])"""


def entities(names: Iterable[str]) -> dict[str, str]:
    """Characters of named references, from the standard table."""
    return {n: html5[n + ";"] for n in names}


def all_names() -> list[str]:
    return [n[:-1] for n in html5 if n.endswith(";")]


def bare_names() -> list[str]:
    """Names that are understood without a semicolon."""
    return [n for n in html5 if not n.endswith(";")]


def _literal_map(pairs: dict[str, str]) -> Column:
    """One literal, folded to a constant map when the query is optimised."""
    text = "\x1e".join(f"{k}\x1f{v}" for k, v in pairs.items())
    return F.str_to_map(F.lit(text), F.lit("\x1e"), F.lit("\x1f"))


def _character(code: Column) -> Column:
    """Text of one code point; blanks become a blank, other controls vanish."""
    legal = (code < 0x110000) & ~code.between(0xD800, 0xDFFF) & (code > 0)
    encoded = F.unhex(F.lpad(F.hex(code), 8, "0"))
    return (
        F.when(code.isin(9, 10, 12, 13), F.lit(" "))
        .when(code.between(1, 31), F.lit(""))
        .when(legal, F.decode(encoded, "UTF-32"))
        .otherwise(F.lit("�"))
    )


def decode_entities(s: Column) -> Column:
    """Resolve character references in one pass over the text between ampersands."""
    # a map is searched from its start, so the few hundred common names come first
    common = _literal_map(entities(name2codepoint))
    rare = _literal_map(entities(sorted(set(all_names()) - set(name2codepoint))))
    bare = F.split(F.lit(" ".join(bare_names())), " ")

    def named(ref: Column) -> Column:
        return F.coalesce(F.try_element_at(common, ref), F.try_element_at(rare, ref))

    def resolve(part: Column) -> Column:
        text, ref = part["text"], part["ref"]
        closed = F.substr(text, F.length(ref) + 1, F.lit(1)) == ";"
        rest = F.substr(text, F.length(ref) + F.when(closed, 2).otherwise(1))
        hex_code = F.conv(F.substr(ref, F.lit(3)), 16, 10).try_cast("bigint")
        dec_code = F.substr(ref, F.lit(2)).try_cast("bigint")
        char = (
            F.when(F.lower(F.left(ref, F.lit(2))) == "#x", _character(hex_code))
            .when(F.left(ref, F.lit(1)) == "#", _character(dec_code))
            .when(closed | F.array_contains(bare, ref), named(ref))
        )
        return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), text))

    parts = F.transform(
        F.split(s, "&"),
        lambda p: F.struct(p.alias("text"), F.regexp_extract(p, REFERENCE, 1).alias("ref")),
    )
    joined = F.transform(parts, lambda p, i: F.when(i == 0, p["text"]).otherwise(resolve(p)))
    return F.when(F.contains(s, F.lit("&")), F.array_join(joined, "")).otherwise(s)


def clean_markup(html: Column) -> Column:
    """Collapse blanks, then drop comments and the contents of script and style.

    Blanks go first, so that text on both sides of a comment keeps its own blanks.
    """
    return F.regexp_replace(F.regexp_replace(html, RAW_BLANKS, " "), UNSEEN, "$1$2")


def marked_body(clean: Column) -> Column:
    """The body with every tag replaced by a marker or by nothing.

    Neither a head nor a body has to be written out: a head shows no text but its title, so only
    title elements before the body go, and what stands there by mistake belongs to the body.
    """
    before = F.regexp_extract(clean, BEFORE_BODY, 1)
    after = F.substr(clean, F.char_length(before) + 1)
    body = F.when(
        clean.rlike(r"(?i)<body[\s/>]"), F.concat(F.regexp_replace(before, TITLE_ELEMENT, ""), after)
    ).otherwise(F.regexp_replace(clean, TITLE_ELEMENT, ""))
    s = F.regexp_replace(body, ALT, f"{ALT_START}$1$2$3{ALT_END}")
    s = F.regexp_replace(s, BLOCK, f"{OPEN}$1{CLOSE}")
    s = F.regexp_replace(s, LINE_BREAK, BREAK)
    return F.regexp_replace(s, TAG, "")


def _without(s: Column, *markers: str) -> Column:
    for m in markers:
        s = F.replace(s, F.lit(m), F.lit(""))
    return s


def full_text(marked: Column) -> Column:
    """All text of the body with alt texts; one blank before each block.

    Double blanks are legal: each run of text keeps its own collapsed blanks.
    """
    s = _without(marked, f"{OPEN}/{CLOSE}", ALT_START)
    spaces = f" ?[{OPEN}{ALT_END}{BREAK}][{OPEN}{CLOSE}{ALT_END}{BREAK}]*"
    return strip_controls(F.regexp_replace(s, spaces, " "))


def _without_alt(marked: Column) -> Column:
    return F.regexp_replace(marked, f"{ALT_START}[^{ALT_END}]*{ALT_END}", "")


def _single_blanks(s: Column) -> Column:
    """``squeeze`` for text of a marked body, which has no white space but blanks."""
    return strip_controls(F.regexp_replace(s, "  +", " "))


def body_text(marked: Column) -> Column:
    """Body text without alt texts and double blanks: the stand-in for a missing title."""
    s = _without(_without_alt(marked), f"{OPEN}/{CLOSE}")
    return strip_controls(F.regexp_replace(s, f"[ {OPEN}{CLOSE}{BREAK}]+", " "))


def paragraphs(marked: Column, min_chars: int = MIN_PARAGRAPH_CHARS) -> Column:
    """Text blocks of at least ``min_chars`` characters, in page order, without alt texts."""
    s = F.replace(_without_alt(marked), F.lit(BREAK), F.lit(" "))

    def long_enough(b: Column) -> Column:
        return F.char_length(b) >= min_chars

    # most blocks are short as they are and need no cleaning
    candidates = F.filter(F.split(s, f"{OPEN}/?{CLOSE}"), long_enough)
    return F.filter(F.transform(candidates, _single_blanks), long_enough)


def heading_parts(clean: Column) -> Column:
    """The page cut at every heading tag; a part that opens a heading starts with its level.

    A heading ends at the next heading tag of any level, opening or closing.
    """
    parts = F.split(F.regexp_replace(clean, HEADING, f"{OPEN}$1$2{CLOSE}"), OPEN)
    return F.filter(parts, lambda p: F.substring(p, 2, 1) == CLOSE)


def heading_fragments(parts: Column, max_level: int = HEADING_LEVELS) -> Column:
    """Text source of h1 to ``h<max_level>``, level by level, each in page order."""
    levels = range(1, min(max(max_level, 1), 6) + 1)
    found = F.concat(*(F.filter(parts, lambda p: F.startswith(p, F.lit(str(n)))) for n in levels))
    breaks = rf"{LINE_BREAK}|{BLOCK}"

    def plain(part: Column) -> Column:
        inner = F.substr(part, F.lit(3))
        return F.regexp_replace(F.regexp_replace(inner, breaks, " "), TAG, "")

    return F.transform(found, plain)


def raw_title(clean: Column) -> Column:
    """Source of the first title element, empty when there is none."""
    return F.regexp_extract(clean, TITLE, 1)


def meta_tags(clean: Column) -> Column:
    return F.regexp_extract_all(clean, F.lit(META), F.lit(0))


def raw_meta(tags: Column, name: str) -> Column:
    """Source of the content of the first meta tag with exactly this name and a content."""
    named = F.filter(
        tags, lambda t: t.rlike(meta_name_pattern(name)) & t.rlike(META_CONTENT)
    )
    contents = F.transform(
        F.slice(named, 1, 1),
        lambda t: F.concat(*(F.regexp_extract(t, META_CONTENT, g) for g in (1, 2, 3))),
    )
    return F.coalesce(F.get(contents, 0), F.lit(""))


def decoded(fragments: Column) -> Column:
    """Text of tag-free fragments: entities resolved, blanks squeezed."""
    return F.transform(fragments, lambda f: squeeze(decode_entities(f)))
