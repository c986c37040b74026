"""The compression classifier: a plain version, held-out accuracy, odd rows."""

import math

import pytest
import zstandard

from tests.conftest import MEDIUM
from tests.llm.conftest import EDGE_TEXTS
from webloom.llm import common, quality


@pytest.fixture(scope="module")
def tables(llm_spark):
    return common.table(llm_spark, MEDIUM, "documents"), common.table(llm_spark, MEDIUM, "labels")


@pytest.fixture(scope="module")
def model(tables):
    return quality.train(*tables)


def test_held_out_rows(tables, model, llm_spark):
    got = quality.op13_zstd_quality(llm_spark, MEDIUM).toPandas()
    labels = tables[1].toPandas().dropna(subset=["quality"])
    held = got[got.held_out].merge(labels, on="doc_id")
    assert len(got) == tables[0].count() and got.score.between(0, 1).all()
    good, bad = held[held.quality == 1], held[held.quality == 0]
    assert (good.predicted == 1).mean() >= 0.97
    assert (bad.predicted == 0).mean() >= 0.6
    assert (good.score.mean() - bad.score.mean()) >= 0.5


def test_scores_equal_a_plain_computation(tables, model):
    rows = tables[0].select("doc_id", "text").limit(40).collect()
    texts = [r["text"] for r in rows] + [None, "", "x", "é" * 3000]

    def size(text, content):
        raw = text.encode()
        level = zstandard.ZstdCompressionParameters.from_level(
            3, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_dict_id=0
        )
        # a fresh compressor for every piece
        make = lambda: zstandard.ZstdCompressor(
            compression_params=level, dict_data=zstandard.ZstdCompressionDict(content)
        )
        return sum(len(make().compress(raw[i : i + 1024])) for i in range(0, len(raw), 1024))

    score = model.scorer()
    for t in texts:
        d = s = 0.0
        if t:
            good, bad = size(t, model.good), size(t, model.bad)
            d, s = (bad - good) / (bad + good), math.log((bad + good) / 2 / len(t.encode()))
        z = model.weights[0] * d + model.weights[1] * s + model.weights[2]
        assert score((t or "").encode()) == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


def test_nothing_is_learned_from_held_out_rows(tables, model):
    docs, labels = tables
    held = quality.is_held_out("doc_id")
    turned = labels.withColumn("quality", quality.F.when(held, 1 - labels.quality).otherwise(labels.quality))
    assert quality.train(docs, turned) == model


def test_one_class_no_labels_odd_rows(edge_docs, no_docs, llm_spark, model):
    schema = "doc_id bigint, quality int, toxic int"
    none = llm_spark.createDataFrame([], schema)
    good = llm_spark.createDataFrame([(i, 1, 0) for i in range(9)] + [(None, 0, 0), (3, None, 0)], schema)
    both = llm_spark.createDataFrame([(i, i % 2, 0) for i in range(9)], schema)
    for labels in (none, good, both):
        got = quality.scored(edge_docs, quality.train(edge_docs, labels), "doc_id", "spans").collect()
        assert len(got) == len(EDGE_TEXTS) + 2 and all(0 <= r["score"] <= 1 for r in got)
    assert quality.train(edge_docs, none).scorer()(b"x") == pytest.approx(0.5)
    assert quality.train(edge_docs, good).scorer()(b"x") > 0.99
    assert quality.train(no_docs, both).scorer()(b"x") == pytest.approx(0.5, abs=0.2)
    assert quality.scored(no_docs, model, "doc_id").count() == 0
    empty = model.scorer()
    assert empty(None) == empty(b"")


def test_copies_of_one_text_do_not_fill_the_dictionary(docs_of, llm_spark):
    rows = [(i, "copy of one text " * 5) for i in range(300)] + [(300 + i, f"good words number {i} here") for i in range(60)]
    rows += [(400 + i, f"### junk *** {i} %%%") for i in range(60)]
    labels = [(i, int(i < 400), 0) for i, _ in rows]
    model = quality.train(docs_of(rows), llm_spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert model.good.count(b"copy of one text copy") <= 5
