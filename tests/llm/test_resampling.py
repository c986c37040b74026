"""Importance resampling and its radix sort against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import MEDIUM
from tests.llm.conftest import EDGE_TEXTS
from tools.check_oracle import connect, difference
from webloom.llm import radix, resampling
from webloom.llm.queries import ORACLE_SQL, QUERIES


def test_query_equals_its_sql(llm_spark):
    name = "op12_radix_resampling"
    assert difference(QUERIES[name](llm_spark, MEDIUM), connect(MEDIUM), ORACLE_SQL[name]) is None


@pytest.mark.parametrize("kind", ["spread", "ties", "third", "extreme", "none", "one"])
def test_sort_is_stable_at_any_keys(llm_spark, kind):
    rng = random.Random(4)
    key = {
        "spread": lambda i: (rng.randrange(-900, 9000), rng.randrange(1 << 40)),
        "ties": lambda i: (rng.randrange(3), 7),
        "third": lambda i: (0 if i % 3 else i, rng.randrange(50)),
        "extreme": lambda i: (rng.choice([0, (1 << 62)]), rng.choice([-(1 << 61), 5])),
        "none": lambda i: (1, 1),
        "one": lambda i: (1, 1),
    }[kind]
    n = {"none": 0, "one": 1}.get(kind, 9_500)
    rows = [(*key(i), i, None if i % 5 else f"t{i}") for i in range(n)]
    given = llm_spark.createDataFrame(rows, "a bigint, b bigint, i bigint, note string").coalesce(1)
    got = radix.ranked(given, [F.col("a"), F.col("b")])
    assert got.columns == ["a", "b", "i", "note", "rank"]
    want = [(*r, k + 1) for k, r in enumerate(sorted(rows, key=lambda r: r[:2]))]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[-1]) == want


def test_no_block_takes_more_than_its_places(llm_spark):
    rows = llm_spark.range(20_000).select(F.lit(5).cast("long").alias("k"), "id")
    got = radix.ranked(rows, [F.col("k")])
    size = got.groupBy(F.shiftright(F.col("rank") - 1, radix.BLOCK_BITS).alias("b")).count().agg(F.max("count"))
    assert size.first()[0] == 1 << radix.BLOCK_BITS
    assert got.select("rank").distinct().count() == 20_000


def test_words_and_buckets_follow_the_contract():
    import re
    import zlib

    text = "Ab3 é_CÖ\x85d 's\x00T" + "İ" + " x" * 30
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    assert [w.decode() for w in resampling.words(text.encode())] == found
    runs = found + [f"{a} {b}" for a, b in zip(found, found[1:])]
    want = [zlib.crc32(r.encode()) % 10000 for r in runs]
    assert resampling.buckets(resampling.words(text.encode())).tolist() == want


def test_odd_rows(edge_docs, no_docs, llm_spark):
    target = llm_spark.createDataFrame([(1, "same text"), (None, None)], "item_id bigint, text string")
    got = resampling.drawn(edge_docs, target, percent=100).collect()
    assert len(got) == len(EDGE_TEXTS) + 2
    able = [r for r in got if r["n_words"] >= 20]
    assert [r["rank"] for r in able] == [1] and able[0]["n_features"] == 59_999
    assert all(r["weight"] == 0 for r in got if not r["n_features"])
    assert resampling.drawn(no_docs, target).count() == 0
    assert resampling.drawn(edge_docs, target.where("false")).count() == len(got)


def test_ties_and_nulls_go_to_the_smaller_id(docs_of, llm_spark):
    text = " ".join(["word"] * 25)
    docs = docs_of([(i, text) for i in (5, 5, None, -3, 1 << 40)])
    got = resampling.drawn(docs, docs, percent=100, seed=1).collect()
    want = sorted(got, key=lambda r: (-r["score"], r["doc_id"] is None, r["doc_id"] or 0))
    assert [r["rank"] for r in want] == [1, 2, 3, 4, 5]
