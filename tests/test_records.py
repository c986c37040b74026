import json

import pytest
from pyspark.sql import functions as F

from webloom import schema as S
from webloom.operators import records as R


def envelope(metadata=None, headers=None, encoding="plain", body="<p>x</p>"):
    metadata = {"WARC-Record-ID": "<r>"} if metadata is None else metadata
    return {
        "metadata": metadata,
        "payload": {"headers": headers or {}, "encoding": encoding, "body": body},
    }


def without(member):
    e = envelope()
    (e if member in e else e["payload"]).pop(member)
    return e


def padded(size):
    e = envelope(body="")
    e["payload"]["body"] = "x" * (size - len(json.dumps(e)))
    return json.dumps(e)


CASES = {
    "good": (envelope(), None),
    "exactly the limit": (padded(S.MAX_RECORD_BYTES), None),
    "one byte more": (padded(S.MAX_RECORD_BYTES + 1), S.TOO_LARGE),
    "not json": ("{", S.JSON_PARSE_ERROR),
    "empty": ("", S.JSON_PARSE_ERROR),
    "array": ("[1]", S.JSON_PARSE_ERROR),
    "duplicate keys": ('{"metadata":{},"metadata":{}}', S.JSON_PARSE_ERROR),
    "text after the object": (json.dumps(envelope()) + " tail", None),
    "no metadata": (without("metadata"), S.JSON_PARSE_ERROR),
    "no payload": (without("payload"), S.JSON_PARSE_ERROR),
    "no headers": (without("headers"), S.JSON_PARSE_ERROR),
    "no encoding": (without("encoding"), S.JSON_PARSE_ERROR),
    "no body": (without("body"), S.JSON_PARSE_ERROR),
    "metadata not an object": ({**envelope(), "metadata": 3}, S.JSON_PARSE_ERROR),
    "body a number": (envelope(body=5), S.JSON_PARSE_ERROR),
    "body null": ({**envelope(), "payload": {"headers": {}, "encoding": "plain", "body": None}}, S.JSON_PARSE_ERROR),
    "binary": (envelope(encoding="base64"), S.BINARY),
    "encoding in capitals": (envelope(encoding="Plain"), S.BINARY),
    "binary and request": (envelope({"WARC-Type": "request"}, encoding="base64"), S.BINARY),
    "binary with bad header": (envelope({"WARC-Record-ID": 5}, encoding="base64"), S.BINARY),
    "request": (envelope({"WARC-Type": "request", "WARC-Record-ID": "r"}), S.NO_RESPONSE_RECORD),
    "response in capitals": (envelope({"WARC-Type": "Response", "WARC-Record-ID": "r"}), S.NO_RESPONSE_RECORD),
    "type header in lower case": (envelope({"warc-type": "request", "WARC-Record-ID": "r"}), S.NO_RESPONSE_RECORD),
    "two type headers": (
        envelope({"WARC-Type": "response", "warc-type": "request", "WARC-Record-ID": "r"}),
        S.NO_RESPONSE_RECORD,
    ),
    "no type header": (envelope({"WARC-Record-ID": "r"}), None),
    "no id": (envelope({"WARC-Type": "response"}), S.NO_ID),
    "collection id only": (envelope({"WARC-TREC-ID": "t"}), None),
    "id a number": (envelope({"WARC-Record-ID": 5}), S.JSON_PARSE_ERROR),
    "id null": (envelope({"WARC-Record-ID": None}), S.JSON_PARSE_ERROR),
    "unread header a number": (envelope({"WARC-Record-ID": "r", "Other": 5}), None),
    "http date a number": (envelope(headers={"Date": 5}), S.JSON_PARSE_ERROR),
    "no id and bad http header": (envelope({}, {"Date": 5}), S.NO_ID),
    "unread http header a number": (envelope(headers={"Length": 5}), None),
}


@pytest.fixture(scope="module")
def classified(spark):
    rows = [(k, v if isinstance(v, str) else json.dumps(v)) for k, (v, _) in CASES.items()]
    df = spark.createDataFrame(rows, S.RECORDS_DDL)
    return {r["key"]: r for r in R.classify(R.parse_envelope(df)).collect()}


@pytest.mark.parametrize("case", CASES)
def test_status(classified, case):
    assert classified[case]["status"] == CASES[case][1]


def test_ids_and_null_rules(spark):
    rows = [
        ("both", envelope({"WARC-Record-ID": "<r>", "WARC-TREC-ID": "t", "WARC-Target-URI": "http://a.b/c%20d?x=1%262"})),
        ("trec", envelope({"warc-trec-id": "t", "WARC-Target-URI": "http://a b"})),
        ("record", envelope({"WARC-RECORD-ID": "<r>"}, {"content-type": " a/b ; c", "DATE": "Tue, 2 Jan 2024 03:04:05 GMT"})),
    ]
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in rows], S.RECORDS_DDL)
    out = {r["key"]: r for r in R.with_ids(R.passed(R.classify(R.parse_envelope(df))), "p").collect()}
    assert (out["both"]["id"], out["trec"]["id"], out["record"]["id"]) == ("t", "t", "<r>")
    assert out["trec"]["warc_record_id"] is None
    assert out["both"]["uuid"] == out["trec"]["uuid"] != out["record"]["uuid"]
    assert out["both"]["warc_target_path"] == "/c d"
    assert out["both"]["warc_target_query_string"] == "x=1&2"
    assert out["trec"]["warc_target_uri"] == "http://a b"
    assert out["trec"]["warc_target_hostname"] is None
    assert out["record"]["warc_target_uri"] is None
    assert out["record"]["content_type"] == "a/b"
    assert out["record"]["date"] == "2024-01-02T03:04:05Z"
    assert out["both"]["content_type"] is None and out["both"]["date"] is None


def test_large_record_is_not_parsed(spark):
    df = spark.createDataFrame([("k", padded(S.MAX_RECORD_BYTES + 1))], S.RECORDS_DDL)
    assert R.parse_envelope(df).select(F.col("body").isNull()).first()[0]
