"""Join keys, document UUIDs and URI parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the RFC 4122 URL namespace.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def join_key(trec_id: Column, record_id: Column) -> Column:
    """The id all inputs meet on: the collection id if there is one, else the record id."""
    return F.coalesce(trec_id, record_id)


def document_uuid(prefix: str, key: Column) -> Column:
    """Name-based (version 5) UUID of ``prefix:key`` in the URL namespace."""
    name = F.encode(F.concat(F.lit(f"{prefix}:"), key), "UTF-8")
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), name))
    # the two top bits of the ninth byte carry the RFC variant
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def uri_is_valid(uri: Column) -> Column:
    """A URI parses when it yields a scheme or a path."""
    return (
        F.try_parse_url(uri, F.lit("PROTOCOL")).isNotNull()
        | F.try_parse_url(uri, F.lit("PATH")).isNotNull()
    )


def _present(uri: Column, part: Column) -> Column:
    """Empty text for a part a valid URI lacks, NULL for an invalid URI."""
    return F.when(uri_is_valid(uri), F.coalesce(part, F.lit("")))


def _unescaped(raw: Column) -> Column:
    """Resolve percent escapes; a plus sign stays a plus sign."""
    return F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw)


def uri_host(uri: Column) -> Column:
    return _present(uri, F.try_parse_url(uri, F.lit("HOST")))


def uri_path(uri: Column) -> Column:
    return _present(uri, _unescaped(F.try_parse_url(uri, F.lit("PATH"))))


def uri_query(uri: Column) -> Column:
    return _present(uri, _unescaped(F.try_parse_url(uri, F.lit("QUERY"))))
