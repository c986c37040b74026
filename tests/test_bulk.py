"""Bulk requests to a store that is a folder: borders, refusals, retries, repeated writes, flat anchors."""

import json

import pytest
from pyspark.sql import functions as F

from tests.test_build import crawl, cw  # noqa: F401
from webloom.plans import index_build as B
from webloom.sinks import bulk
from webloom.sinks.documents import STORE_DEFAULTS


def rows(n, size=10):
    return [{"uuid": f"u{i:04d}", "op": "index", "document": "x" * size} for i in range(n)]


def test_requests_are_cut_by_entries_and_by_bytes():
    cut = lambda given, entries, size: [len(r) for r in bulk.requests(iter(given), entries, size)]
    assert cut(rows(12001), 5000, 1 << 30) == [5000, 5000, 2001]
    assert cut(rows(10, 95), 5000, 300) == [3, 3, 3, 1]  # 100 bytes each, the key included
    assert cut(rows(2, 400), 5000, 300) == [1, 1]
    assert cut([], 5000, 300) == []
    default = bulk.BulkWriter(None, {"es.resource": "w/_doc", **STORE_DEFAULTS})
    assert (default.entries, default.size, default.retries, default.wait) == (5000, 2 << 20, 5, 30)
    with pytest.raises(ValueError):
        bulk.amount("2 miles")


def test_only_what_was_refused_is_sent_again():
    seen = []

    def client(index, actions):
        seen.append([a["id"] for a in actions])
        if len(seen) == 1:
            raise OSError("down")
        return [1] if len(seen) == 2 else []

    options = {"es.resource": "w/_doc", **STORE_DEFAULTS, "es.batch.write.retry.wait": "0s"}
    sent = bulk.BulkWriter(client, options).write(iter(rows(3)))
    assert (sent.actions, sent.requests, sent.repeated) == (3, 1, 2)
    assert seen == [["u0000", "u0001", "u0002"]] * 2 + [["u0001"]]
    never = bulk.BulkWriter(lambda i, a: range(len(a)), {**options, "es.batch.write.retry.count": "2"})
    with pytest.raises(RuntimeError, match="3 actions refused after 2 retries"):
        never.write(iter(rows(3)))


def folder_client(folder):
    """A store of one file per document and one per added text; every task's first request fails once."""

    def client(index, actions):
        import hashlib
        import os

        os.makedirs(folder, exist_ok=True)
        mark = f"{folder}/.failed-{hashlib.md5(actions[0]['document'].encode()).hexdigest()}"
        if not os.path.exists(mark):
            open(mark, "w").close()
            raise OSError("first request")
        for a in actions:
            name = a["id"] + ("" if a["op"] == "index" else "+" + hashlib.md5(a["document"].encode()).hexdigest())
            with open(f"{folder}/{name}", "w") as out:
                out.write(json.dumps([index, a["op"], json.loads(a["document"])]))
        return []

    return client


def test_documents_and_flat_anchors_reach_the_store(crawl, model, tmp_path):  # noqa: F811
    documents, anchors = B.index_tables(crawl, model, "p", str(tmp_path))
    folder = str(tmp_path / "store")
    quick = {"es.batch.write.retry.wait": "0s", "es.batch.size.entries": "1"}
    state = lambda: {p.name: p.read_text() for p in (tmp_path / "store").iterdir() if not p.name.startswith(".")}
    bulk.write_bulk(documents, "web", folder_client(folder), quick, anchors)
    first = state()
    assert len(first) == 4
    keys = {r["warc_trec_id"]: r["uuid"] for r in documents.collect()}
    index, op, body = json.loads(first[keys[cw(1)]])
    assert (index, op, body["warc_record_id"]) == ("web/_doc", "index", "<new>") and "uuid" not in body
    added = sorted(json.loads(t)[2].items() for n, t in first.items() if "+" in n)
    assert [dict(a)["field"] for a in added] == ["anchor_texts_lang.en", "anchor_texts_lang.unknown"]
    assert {n.split("+")[0] for n in first if "+" in n} == {keys[cw(1)]}
    bulk.write_bulk(documents, "web", folder_client(folder), quick, anchors)  # the same state again
    assert state() == first


def test_a_store_that_stays_down_fails_the_write(spark):
    def down(index, actions):
        raise OSError("down")

    docs = spark.range(1).select(F.lit("u").alias("uuid"), F.lit("index").alias("op"), F.lit("{}").alias("document"))
    spark.dataSource.register(bulk.source(down))
    options = {"es.resource": "w/_doc", **STORE_DEFAULTS, "es.batch.write.retry.wait": "0s"}
    with pytest.raises(Exception, match="refused after 5 retries"):
        docs.write.format(bulk.FORMAT).mode("append").options(**options).save()
