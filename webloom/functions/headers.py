"""Lookups in header objects held as MAP<STRING, VARIANT>."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from webloom.functions.text import strip_controls


def header_values(headers: Column, name: str) -> Column:
    """All values whose header name equals ``name`` (lower case) in any spelling."""
    return F.map_values(F.map_filter(headers, lambda k, v: F.lower(k) == name))


def header(headers: Column, name: str) -> Column:
    """First value of a header as text, NULL when the header is absent."""
    return F.try_variant_get(
        F.try_element_at(header_values(headers, name), F.lit(1)), "$", "string"
    )


def is_text(v: Column) -> Column:
    """True for a JSON string, false for any other JSON type, null or nothing."""
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def any_not_text(headers: Column, *names: str) -> Column:
    """True when one of the named headers holds something other than a string."""
    read = F.map_values(F.map_filter(headers, lambda k, v: F.lower(k).isin(*names)))
    return F.exists(read, lambda v: ~is_text(v))


def content_type(value: Column) -> Column:
    """Media type without its parameters."""
    return strip_controls(F.split_part(value, F.lit(";"), F.lit(1)))


# The parts of an HTTP date in their order, and the layout of the index field.
HTTP_DATE = (
    r"(?i)^\s*(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*, *(\d{1,4}) +"
    r"((?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec))[a-z]* +(\d{1,9}) +"
    r"(\d{1,4}):(\d{1,4}):(\d{1,4}) *"
    r"((?:GMT|UTC)?[+-]\d{1,2}:?\d{2}|[A-Z]{3,4})"
)
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
INDEX_LAYOUT = "yyyy-MM-dd'T'HH:mm:ssXXX"


def http_date(value: Column) -> Column:
    """HTTP date as ISO-8601 text in the session zone; NULL when it cannot be read.

    Read leniently: text after the date does not matter, months may be written out, and a day,
    hour, minute or second past its end counts on into the next.
    """

    def part(group: int) -> Column:
        return F.regexp_extract(value, HTTP_DATE, group)

    month = F.floor((F.instr(F.lit(MONTHS), F.lower(part(2))) - 1) / 3) + 1
    year, day, hour, minute, second = (part(g).try_cast("int") for g in (3, 1, 4, 5, 6))
    first = F.when(year.between(1, 9999), F.make_date(year, month.cast("int"), F.lit(1)))
    wall = F.unix_date(F.date_add(first, day - 1)).cast("bigint") * 86400 + hour * 3600 + minute * 60 + second
    zone = F.regexp_replace(F.upper(part(7)), "^(?:GMT|UTC)([+-])", "$1")
    sign = F.when(F.startswith(zone, F.lit("-")), -1).otherwise(1)
    figures = F.regexp_replace(zone, "[^0-9]", "")
    minutes = F.right(figures, F.lit(2)).try_cast("int") + 60 * F.left(
        figures, F.char_length(figures) - 2
    ).try_cast("int")
    offset = F.when(zone.rlike("^[+-]"), sign * minutes * 60).otherwise(_named_zone(zone))
    moment = F.timestamp_seconds(wall - offset)
    return F.when(value.rlike(HTTP_DATE), F.date_format(moment, INDEX_LAYOUT))


# Zones written by name, in hours from UTC.
ZONES = {
    "GMT": 0, "UTC": 0, "UCT": 0, "WET": 0, "CET": 1, "MET": 1, "CEST": 2, "EET": 2, "EEST": 3,
    "MSK": 3, "JST": 9, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6,
    "PST": -8, "PDT": -7, "HST": -10,
}


def _named_zone(zone: Column) -> Column:
    """Seconds from UTC; NULL for a name that is not known."""
    hours = F.create_map(*(F.lit(x) for pair in ZONES.items() for x in pair))
    return F.try_element_at(hours, zone) * 3600
