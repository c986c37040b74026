"""Whitespace and length helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from webloom.schema import TRUNCATE_WORD_SHARE

# Control characters and the blank: what a trim removes at both ends.
TRIMMED = "".join(chr(c) for c in range(0x21))
BLANKS = r"[ \t\n\f\r]+"


def strip_controls(s: Column) -> Column:
    """Remove blanks and control characters at both ends (linear, no regex)."""
    return F.btrim(s, F.lit(TRIMMED))


def squeeze(s: Column) -> Column:
    """Turn every run of white space into one blank and strip the ends."""
    return strip_controls(F.regexp_replace(s, BLANKS, " "))


def truncate_snippet(s: Column, n: int) -> Column:
    """Cut to ``n`` characters, at the last blank unless that loses too much.

    ``n = -1`` means no limit. A cut that already falls on a word end stays as it is; a cut
    inside a word moves back to the last blank if at least 60 % of ``n`` remains.
    """
    if n == -1:
        return s
    cut = F.substring(s, 1, n)
    from_end = F.instr(F.reverse(cut), " ")
    last_blank = F.lit(n) - from_end
    keep_word = (
        (F.substring(s, n + 1, 1) != " ")
        & (from_end > 0)
        & (last_blank >= int(TRUNCATE_WORD_SHARE * n))
    )
    short = F.when(keep_word, F.left(cut, last_blank)).otherwise(cut)
    return strip_controls(F.when(F.char_length(s) <= n, s).otherwise(short))


def utf16_length(s: Column) -> Column:
    """Length in UTF-16 units; differs from ``length`` outside the basic plane."""
    return (F.octet_length(F.encode(s, "UTF-16BE")) / 2).cast("bigint")
