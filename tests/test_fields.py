import uuid

import pytest
from hypothesis import given, settings, strategies as st

from webloom.functions import headers as H, ids, text as X

URIS = {
    # uri: host, path, query
    "http://x.com/a/b?q=1#f": ("x.com", "/a/b", "q=1"),
    "http://x.com": ("x.com", "", ""),
    "http://x.com/a%2Fb%20c+d?e=%C3%A9+f": ("x.com", "/a/b c+d", "e=é+f"),
    "http://a_b.com/p": ("", "/p", ""),
    "mailto:a@b": ("", "", ""),
    "//h/p": ("h", "/p", ""),
    "/rel?x=1": ("", "/rel", "x=1"),
    "": ("", "", ""),
    "http://x.com/a b": (None, None, None),
    "http://x.com/%zz": (None, None, None),
    None: (None, None, None),
}


@pytest.mark.parametrize("place, function", list(enumerate([ids.uri_host, ids.uri_path, ids.uri_query])))
def test_uri_parts(apply, place, function):
    assert apply(function, list(URIS)) == [v[place] for v in URIS.values()]


def test_uuid_is_version_five(apply):
    names = ["clueweb12-en0000-00-00001", "<urn:uuid:1>", "ü€😀", ""]
    want = [str(uuid.uuid5(uuid.NAMESPACE_URL, f"crawl:{n}")) for n in names]
    assert apply(lambda c: ids.document_uuid("crawl", c), names) == want


def test_content_type(apply):
    values = ["text/html; charset=x", " text/html\t; charset=x", ";", "; x", "", None]
    assert apply(H.content_type, values) == ["text/html", "text/html", "", "", "", None]


def test_http_date(apply):
    cases = {
        "Tue, 02 Jan 2024 03:04:05 GMT": "2024-01-02T03:04:05Z",
        "Tue, 2 Jan 2024 03:04:05 GMT": "2024-01-02T03:04:05Z",
        "Tuesday, 02 Jan 2024 03:04:05 GMT": "2024-01-02T03:04:05Z",
        "Tue, 02 Jan 2024 03:04:05 PST": "2024-01-02T11:04:05Z",
        "Tue, 02 Jan 2024 03:04:05 +0100": "2024-01-02T02:04:05Z",
        "Tue, 02 Jan 2024 03:04:05 GMT+01:00": "2024-01-02T02:04:05Z",
        "02 Jan 2024 03:04:05 GMT": None,
        "Tue, 32 Jan 2024 03:04:05 GMT": "2024-02-01T03:04:05Z",
        "Tue, 02 January 2024 03:04:05 GMT": "2024-01-02T03:04:05Z",
        "Tue, 02 Jan 2024 03:04:05 GMT; and more": "2024-01-02T03:04:05Z",
        "Tue, 30 Feb 2024 25:61:61 -0230": "2024-03-02T04:32:01Z",
        "Tue, 02 Jan 2024 03:04:05": None,
        "Tue, 02 Jan 2024 03:04:05 XYZ": None,
        "Tue, 02 Foo 2024 03:04:05 GMT": None,
        "2024-01-02": None,
        "": None,
        None: None,
    }
    assert apply(H.http_date, list(cases)) == list(cases.values())


def cut_by_hand(s, n):
    if len(s) > n:
        inside_word = s[n] != " "
        s = s[:n]
        at = s.rfind(" ")
        if inside_word and at >= int(0.6 * n):
            s = s[:at]
    return s.strip("".join(map(chr, range(33))))


def test_truncate_edges(apply):
    values = [
        "x" * 6 + " " + "y" * 20,  # last blank exactly at 60 %
        "x" * 5 + " " + "y" * 20,  # one before it
        "aaaa bbbbb cccc",  # the cut falls on a blank
        "a" * 30,
        "abc \t",
        "",
        " lead and trail ",
    ]
    got = apply(lambda c: X.truncate_snippet(c, 10), values)
    assert got == [cut_by_hand(v, 10) for v in values]
    assert apply(lambda c: X.truncate_snippet(c, -1), ["a  b "]) == ["a  b "]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab \té😀", max_size=60), min_size=50, max_size=200))
def test_truncate_property(apply, values):
    got = apply(lambda c: X.truncate_snippet(c, 20), values)
    assert got == [cut_by_hand(v, 20) for v in values]
    assert all(len(g) <= 20 for g in got)


def test_lengths(apply):
    assert apply(X.utf16_length, ["a😀", "", "é"]) == [3, 0, 1]
