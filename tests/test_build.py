"""The build as a whole: duplicates, joins, counters, batches, writes, plans."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import MEDIUM, SMALL
from webloom import schema as S
from webloom.operators import anchors as A, counters, merge
from webloom.plans import batches as BT, catalog, index_build as B
from webloom.session import checkpoint_dir, spread
from webloom.sinks import documents as D
from webloom.sinks.generations import Index
from webloom.sources import containers, demo

LONG = "the cat and the dog of the house are in the garden of the other man"


def record(key, body=f"<p>{LONG}", headers=None, **metadata):
    value = {
        "metadata": {k.replace("_", "-"): v for k, v in metadata.items()},
        "payload": {"headers": headers or {}, "encoding": "plain", "body": body},
    }
    return key, json.dumps(value)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def cw(n):
    return f"clueweb12-en0000-00-{n:05d}"


@pytest.fixture(scope="module")
def crawl(spark):
    date = lambda d: {"Date": f"Tue, {d:02d} Jan 2024 00:00:00 GMT"}
    rows = [
        record("old", headers=date(1), WARC_TREC_ID=cw(1), WARC_Record_ID="<old>"),
        record("new", headers=date(2), WARC_TREC_ID=cw(1), WARC_Record_ID="<new>"),
        record("undated", WARC_TREC_ID=cw(1), WARC_Record_ID="<undated>"),
        record("plain", WARC_Record_ID="<r2>"),
        record("four bytes", body="<p>abcd", WARC_TREC_ID=cw(3)),
        record("five blanks", body="<p>     ", WARC_TREC_ID=cw(4)),
        record("request", WARC_Type="request", WARC_TREC_ID=cw(5)),
        record("no id"),
        ("broken", "{"),
    ]
    return B.Inputs(
        spark.createDataFrame(rows, S.RECORDS_DDL),
        lines(spark, f"5 {cw(1)}", f"9 {cw(1)}", f"1 {cw(8)}"),
        lines(spark, f"{cw(1)} 0.5", f"{cw(9)} 0.1"),
        lines(spark, f"{cw(1)} the link and the page", f"{cw(1)} 12", f"{cw(7)} x", "bad line"),
    )


def test_small_crawl(crawl, model):
    docs = {r["id"]: r for r in B.index_documents(crawl, model, "p").collect()}
    assert set(docs) == {cw(1), "<r2>"}
    first = docs[cw(1)]
    assert first["warc_record_id"] == "<new>"
    assert (first["spam_rank"], first["page_rank"]) == (9, 0.5)
    assert {a["lang"]: a["texts"] for a in first["anchors"]} == {
        "en": ["the link and the page"],
        "unknown": ["12"],
    }
    assert first["body"] == first["full_body"] == LONG
    assert first["body_length"] == len(LONG)
    second = docs["<r2>"]
    assert second["spam_rank"] is second["page_rank"] is second["anchors"] is None


def test_missing_side_inputs(crawl, model):
    built = B.index_documents(B.Inputs(crawl.records), model, "p")
    assert {r["spam_rank"] for r in built.collect()} == {None}
    assert built.count() == 2
    row = B.job_counters(B.Inputs(crawl.records), model)
    assert {r["counter"]: r["value"] for r in row.collect()}["NO_CONTENT"] == 0


def test_counters(crawl, model):
    got = {r["counter"]: r["value"] for r in B.job_counters(crawl, model).collect()}
    assert got == {
        "TOTAL_RECORDS": 9,
        "RECORDS": 4,
        "SKIPPED_RECORDS_TOO_LARGE": 0,
        "SKIPPED_RECORDS_JSON_PARSE_ERROR": 1,
        "SKIPPED_RECORDS_BINARY": 0,
        "SKIPPED_RECORDS_NO_RESPONSE_RECORD": 1,
        "SKIPPED_RECORDS_NO_ID": 1,
        "SKIPPED_RECORDS_TOO_SMALL": 2,
        "SKIPPED_RECORDS_HTML_PARSE_ERROR": 0,
        "LANGDETECT_FAILED": 2,
        "GENERATED_DOCS": 2,
        "NO_CONTENT": 3,
    }
    summary = B.job_summary(crawl, model).first()
    assert summary.asDict() == {
        "total_records": 9,
        "records": 4,
        "skipped_too_large": 0,
        "skipped_html_parse_error": 0,
        "generated": 2,
        "no_content": 3,
    }


def test_blank_content_counts_as_no_content(spark):
    rows = [("a", S.RECORD, "en", False), ("b", S.RECORD, "en", True), ("b", S.RECORD, "en", False)]
    outcomes = spark.createDataFrame(rows, "id string, status string, lang string, has_content boolean")
    row = counters.counter_row(outcomes).first()
    assert (row["GENERATED_DOCS"], row["NO_CONTENT"], row["RECORDS"]) == (1, 1, 3)


def test_every_record_has_one_outcome(spark, model):
    got = {r["counter"]: r["value"] for r in B.job_counters(catalog.inputs(spark, MEDIUM), model).collect()}
    assert got["TOTAL_RECORDS"] == sum(got[n] for n in S.STATUS_COUNTERS) == 250
    built = B.index_documents(catalog.inputs(spark, MEDIUM), model, "p")
    assert built.count() == got["GENERATED_DOCS"]


def test_orphans(spark):
    docs = spark.createDataFrame([("a",)], "id string")
    sides = [spark.createDataFrame([(i,) for i in ids], "id string") for ids in ("ab", "bbc")]
    assert sorted(r["id"] for r in merge.orphan_ids(docs, None, *sides).collect()) == ["b", "c"]


def test_flagship_sends_page_texts_through_one_exchange(spark, model):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = B.index_documents(catalog.inputs(spark, SMALL), model, "p")
        plan = built._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("VariantExpressionEvalUtils.parseJson") == 1
    assert plan.count("<script") == 1  # the markup is cleaned once
    assert plan.count("WindowGroupLimit") == 2
    by_id = [l for l in plan.split("\n") if "Exchange hashpartitioning(id" in l and "anchor" not in l]
    # pages, spam, page ranks, scored anchors, their sizes: one each
    assert 1 <= len(by_id) <= 5
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


@pytest.mark.parametrize("name", ["orphan_ids", "job_counters", "live_anchors", "record_status"])
def test_pages_are_built_once(spark, name):
    plan = catalog.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("VariantExpressionEvalUtils.parseJson") == 1


def test_scans_read_only_needed_columns(spark):
    plan = catalog.QUERIES["scan_anchors"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_spread_leaves_large_inputs_alone(spark):
    assert spread(spark.range(0, 100, 1, 16)).rdd.getNumPartitions() == 16
    assert spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == 8


def test_counters_of_a_running_write_equal_the_counting_query(spark, model, crawl, tmp_path):
    for inputs in (crawl, catalog.inputs(spark, SMALL)):
        want = {r["counter"]: r["value"] for r in B.job_counters(inputs, model).collect()}
        sides = B.read_sides(inputs, model)
        watch = B.Watch()
        built = B.attach_sides(B.build_pages(inputs.records, model, "p", watch), sides)
        watch.finish(built).write.format("noop").mode("overwrite").save()
        assert watch.counters(B.orphan_count(built, sides)) == want


# ---- batches -----------------------------------------------------------------------------


@pytest.mark.parametrize("number_of, partitions", [(1, 100), (3, 100), (4, 100), (7, 7), (3, 2)])
def test_batches_cover_all_containers_once(number_of, partitions):
    slices = BT.batches(number_of, partitions)
    if number_of == 1:
        assert slices[0].paths("d") == slices[0].paths("d/") == ["d/data-r-*/data"]
        return
    paths = [p for b in slices for p in b.paths("d")]
    assert paths == [f"d/data-r-{i:05d}/data" for i in range(partitions)]


def test_strict_batches_leave_the_rest_out():
    slices = BT.batches(3, 100, strict=True)
    paths = [p for b in slices for p in b.paths("/d/")]
    assert len(paths) == 99 and paths[-1] == "/d/data-r-00098/data"
    assert containers.Batch(0, 3).bounds == containers.Batch(1, 3).bounds


def test_batch_number_agrees_with_bounds(spark):
    df = spark.range(100)
    for strict in (False, True):
        numbered = df.select("id", containers.batch_number(F.col("id"), 3, 100, strict).alias("b"))
        got = {r["id"]: r["b"] for r in numbered.collect()}
        for b in BT.batches(3, 100, strict):
            inside = {r["id"] for r in df.where(b.contains(F.col("id"))).collect()}
            assert inside == {i for i, n in got.items() if n == b.number}


@pytest.fixture(scope="module")
def container_folder(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("crawl")
    rows = demo.records(spark, SMALL).collect()
    for n in range(4):
        part = [(r["key"], r["value"]) for r in rows if int(r["key"]) % 4 == n]
        rdd = spark.sparkContext.parallelize(part, 2)
        rdd.saveAsSequenceFile(f"{folder}/data-r-{n:05d}/data")
    return str(folder), sorted((r["key"], r["value"]) for r in rows)


def test_containers(spark, container_folder, tmp_path):
    folder, rows = container_folder
    read = containers.read_records(spark, folder)
    assert sorted(map(tuple, read.collect())) == rows
    half = containers.read_records(spark, folder, containers.Batch(2, 2, 4))
    assert sorted(map(tuple, half.collect())) == [r for r in rows if int(r[0]) % 4 >= 2]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "PythonRDD" not in read._jdf.queryExecution().toRdd().toDebugString()
    assert containers.read_records(spark, folder, containers.Batch(1, 200, 100)).collect() == []
    containers.to_parquet(spark, folder, str(tmp_path / "p"))
    converted = spark.read.parquet(str(tmp_path / "p"))
    batch = converted.where(containers.Batch(2, 2, 4).contains(F.col("container")))
    assert sorted(map(tuple, batch.select("key", "value").collect())) == sorted(map(tuple, half.collect()))
    assert "PartitionFilters: [isnotnull(container" in batch._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [3, 102])
def test_all_containers_are_converted(spark, tmp_path, n):
    for i in range(n):
        rdd = spark.sparkContext.parallelize([(f"k{i}", f"v{i}")], 1)
        rdd.saveAsSequenceFile(f"{tmp_path}/c/data-r-{i:05d}/data")
    containers.to_parquet(spark, f"{tmp_path}/c", f"{tmp_path}/p")
    rows = spark.read.parquet(f"{tmp_path}/p").collect()
    assert {(r["container"], r["key"], r["value"]) for r in rows} == {(i, f"k{i}", f"v{i}") for i in range(n)}


def test_more_batches_than_partitions(spark, model, container_folder, tmp_path):
    folder, _ = container_folder
    inputs = catalog.inputs(spark, SMALL)
    records_of = lambda b: containers.read_records(spark, folder, b)
    BT.write_all(records_of, inputs, model, "p", BT.batches(6, 4), str(tmp_path))
    whole = B.index_documents(inputs, model, "p")
    assert Index(spark, str(tmp_path)).documents().count() == whole.count()


def comparable(df):
    return sorted(map(str, catalog.flat(df).collect()))


def test_written_batches_equal_one_build(spark, model, container_folder, tmp_path):
    folder, _ = container_folder
    inputs = catalog.inputs(spark, SMALL)
    slices = BT.batches(2, 4)
    out = str(tmp_path / "index")
    records_of = lambda b: containers.read_records(spark, folder, b)
    want = {r["counter"]: r["value"] for r in B.job_counters(inputs, model).collect()}
    for _ in range(2):  # a repeated run changes nothing
        reports = BT.write_all(records_of, inputs, model, "p", slices, out)
        for counter in set(want) - {"NO_CONTENT"}:  # a batch has all ids of other batches without content
            assert sum(r[counter] for r in reports) == want[counter], counter
        stored = Index(spark, out).documents()
        whole, anchors = B.index_tables(inputs, model, "p")
        assert sorted(map(str, stored.select(whole.columns).collect())) == sorted(map(str, whole.collect()))
        found = Index(spark, out).anchors().select(anchors.columns)
        assert sorted(map(str, found.collect())) == sorted(map(str, anchors.collect()))
    lazy = BT.build_all(records_of, inputs, model, "p", slices)
    assert comparable(lazy) == comparable(B.index_documents(inputs, model, "p"))


def test_stored_sides_are_joined_without_a_shuffle(spark, model, crawl):
    stored = BT.store_sides(spark, B.read_sides(crawl, model))
    pages = B.build_pages(crawl.records, model, "p")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = B.attach_ranks(pages, stored.sides)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert len(joined.collect()) == 2
        anchors = stored.sides.anchors.join(stored.sides.spam, "id")
        assert "Exchange" not in anchors._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        stored.drop(spark)
    assert plan.count("SortMergeJoin") == 2
    assert plan.count("Exchange") == 1  # the pages, for the duplicate merge


def test_every_anchor_line_is_delivered_at_any_size(spark, model, crawl, tmp_path):
    """One page with far more anchor text than fits a document, in several languages."""
    texts = [f"the link {i} and the page" for i in range(3000)] + [str(i) for i in range(500)] + ["twice"] * 2
    many = lines(spark, *(f"{cw(1)} {t}" for t in texts))
    inputs = B.Inputs(crawl.records, crawl.spam, crawl.page_ranks, many)
    want = Counter(texts)
    documents, anchors = B.index_tables(inputs, model, "p")
    key = next(r["uuid"] for r in documents.collect() if r["warc_trec_id"] == cw(1))

    def delivered(rows):
        assert {r["uuid"] for r in rows} == {key}
        return Counter({r["anchor"]: r["n"] for r in rows})

    assert delivered(anchors.collect()) == want
    D.write_json(D.stored_form(documents), str(tmp_path / "json"), anchors=anchors)
    rows = spark.read.parquet(str(tmp_path / "json/anchors")).collect()
    assert delivered([{"uuid": r["uuid"], **json.loads(r["document"])} for r in rows]) == want
    slices = BT.batches(1, 1)
    lazy = BT.build_tables(lambda b: crawl.records, inputs, model, "p", slices)[1]
    assert delivered(lazy.collect()) == want
    BT.write_all(lambda b: crawl.records, inputs, model, "p", slices, str(tmp_path / "i"), str(tmp_path / "s"))
    assert delivered(Index(spark, str(tmp_path / "i")).anchors().collect()) == want
    assert not any((tmp_path / "s").glob("*"))  # the stored sides are gone
    nested = B.index_documents(inputs, model, "p").where(F.col("uuid") == key).first()["anchors"]
    assert Counter(t for a in nested for t in a["texts"]) == want


@pytest.mark.parametrize("builds", [2, 4])
def test_many_builds_share_one_exchange(spark, model, builds):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        slices = BT.batches(builds, demo.CONTAINERS)
        given = catalog.inputs(spark, SMALL)
        of = lambda b: given.records.where(b.contains(demo.container_of(F.col("key"))))
        built = BT.build_all(of, given, model, "p", slices)
        plan = built._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # pages, spam, page ranks, anchors by text, scored and by size; the demo source deals out its own
    assert plan.count("ENSURE_REQUIREMENTS") <= 9
    assert plan.count("Window [") == 1


# ---- sinks -------------------------------------------------------------------------------


def test_json_documents(crawl, model, tmp_path, spark):
    stored = D.stored_form(B.index_documents(crawl, model, "p"))
    rows = {r["uuid"]: json.loads(r["document"]) for r in D.as_json(stored).collect()}
    by_id = {d.get("warc_trec_id") or d["warc_record_id"]: d for d in rows.values()}
    doc = by_id[cw(1)]
    assert "uuid" not in doc
    assert doc["body_lang"] == doc["full_body_lang"] == doc["title_lang"] == {"en": LONG}
    assert doc["anchor_texts_lang"] == {"en": ["the link and the page"], "unknown": ["12"]}
    assert doc["meta_desc_lang"] == {"en": ""} and doc["meta_keywords"] == ""
    absent = {"warc_trec_id", "spam_rank", "page_rank", "date", "content_type", "anchor_texts_lang"}
    assert not absent & set(by_id["<r2>"])
    D.write_json(stored, str(tmp_path / "json"), rows_per_file=1)
    assert spark.read.parquet(str(tmp_path / "json/documents")).count() == 2


def test_upsert_replaces_and_repeats(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "uuid string, v int")
    new = spark.createDataFrame([("b", 2), ("c", 2)], "uuid string, v int")
    want = [("a", 1), ("b", 2), ("c", 2)]
    once = D.upsert(old, new)
    assert sorted(map(tuple, once.collect())) == want
    assert sorted(map(tuple, D.upsert(once, new).collect())) == want
    assert sorted(map(tuple, D.latest(old, new).collect())) == want
    assert sorted(map(tuple, D.latest(old, new, new).collect())) == want


def test_store_options():
    options = D.store_options("web", {"es.batch.size.entries": "700", "es.mapping.id": "other"})
    assert options["es.resource"] == "web/_doc"
    assert options["es.batch.size.entries"] == "700" and options["es.batch.write.retry.count"] == "5"
    assert options["es.mapping.id"] == options["es.mapping.exclude"] == "uuid"
    assert D.store_options("web", {"es.resource": "x/_doc"})["es.resource"] == "x/_doc"


class Conf:
    """Stand-in for a session with given settings."""

    def __init__(self, master="local[1]", **settings):
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}
        self.sparkContext, self.conf, self.master = self, self, master

    def getConf(self):
        return self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_speculation_is_refused():
    D.no_speculation(Conf())
    with pytest.raises(ValueError):
        D.no_speculation(Conf(spark_speculation="true"))


def test_checkpoint_folder_comes_from_the_session():
    assert checkpoint_dir(Conf("yarn", spark_checkpoint_dir="hdfs:///c")) == "hdfs:///c"
    with pytest.raises(ValueError):
        checkpoint_dir(Conf("yarn"))
    assert checkpoint_dir(Conf())


# ---- skew --------------------------------------------------------------------------------


def test_one_id_with_a_third_of_all_pages(spark):
    """The pages of a hot id shrink to one row per task before they are shuffled."""
    texts = ["body", "full_body", "headings", "title", "meta_desc", "meta_keywords"]
    rows = spark.range(0, 3000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id") % 500)).alias("id"),
        F.concat(F.lit("2024-01-"), F.lpad((F.col("id") * 7 % 29).cast("string"), 2, "0")).alias("date"),
        F.col("id").cast("string").alias("warc_record_id"),
        F.lit("u").alias("warc_target_uri"),
        *(F.concat(F.lit(c), F.col("id")).alias(c) for c in texts),
    )
    best = {}
    for r in rows.collect():
        key = (r["date"], r["warc_record_id"])
        if r["id"] not in best or key > (best[r["id"]]["date"], best[r["id"]]["warc_record_id"]):
            best[r["id"]] = r
    merged = merge.merge_duplicates(rows)
    assert {r["id"]: r for r in merged.collect()} == best
    plan = merged._jdf.queryExecution().executedPlan().toString()
    lines_of = plan.split("\n")
    shuffle = next(i for i, l in enumerate(lines_of) if "Exchange hashpartitioning(id" in l)
    assert any("WindowGroupLimit" in l for l in lines_of[shuffle + 1 :])


def test_counters_with_a_hot_side_id(spark):
    outcomes = spark.createDataFrame(
        [("a", S.RECORD, "en", True), (None, S.BINARY, None, False)],
        "id string, status string, lang string, has_content boolean",
    )
    side = spark.range(2000).select(F.when(F.col("id") < 1000, "a").otherwise("b").alias("id"))
    row = counters.counter_row(outcomes, side, None).first()
    assert (row["GENERATED_DOCS"], row["NO_CONTENT"], row["TOTAL_RECORDS"]) == (1, 1, 2)
