from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import MEDIUM
from webloom.functions.language import LanguageModel, counted_grams, normal_form, profile, trigrams
from webloom.schema import UNKNOWN_LANG
from webloom.session import spread
from webloom.sources import demo


def test_normal_form(apply):
    values = ["Ab, c-D 12 é!", "", "  ", "123", "a"]
    assert apply(normal_form, values) == [" ab c d é ", " ", " ", " ", " a "]


def test_trigrams_are_complete(apply):
    values = [" abc de ", " ", "ab", "", " ñandú x "]
    got = apply(trigrams, values)
    for text, grams in zip(values, got):
        assert Counter(grams) == Counter(text[i : i + 3] for i in range(len(text) - 2))


def test_scores_equal_a_plain_count(spark, model):
    weights = {}
    for r in profile(demo.documents(spark, MEDIUM)).collect():
        weights.setdefault(r["gram"], {})[r["lang"]] = r["weight"]
    df = demo.documents(spark, MEDIUM).select("text", normal_form(F.col("text")).alias("n"))
    rows = df.withColumn("found", model.detect(F.col("text"))).collect()
    for r in rows:
        total = Counter()
        for i in range(len(r["n"]) - 2):
            total.update(weights.get(r["n"][i : i + 3], {}))
        best = min(total, key=lambda k: (-total[k], k)) if total else UNKNOWN_LANG
        assert r["found"] == best


def test_texts_without_letters_are_unknown(spark, model):
    df = spark.createDataFrame([("",), ("  ",), ("12 34",), (None,), ("日本",)], "t string")
    assert {r[0] for r in df.select(model.detect(F.col("t"))).collect()} == {UNKNOWN_LANG}


@pytest.mark.parametrize("bound", ["_SLICE_CHARS", "_SLICE_CELLS", "_DENSE_CELLS"])
def test_array_bounds_do_not_change_results(model, monkeypatch, bound):
    texts = ["the of and", "der die und", " ", "", "le la les", "x\0the", "ñandú 日本 the"] * 5
    whole = model.best(texts)
    single = [model.best([t])[0] for t in texts]
    monkeypatch.setattr(f"webloom.functions.language.{bound}", 10)
    assert model.best(texts) == whole == single


def test_held_out_accuracy(spark):
    docs = demo.documents(spark, MEDIUM)
    trained = LanguageModel.fit(docs.where("doc_id % 2 = 0"))
    held_out = docs.where("doc_id % 2 = 1").withColumn("found", trained.detect(F.col("text")))
    right, total = held_out.select(F.count_if(F.col("found") == F.col("lang")), F.count("*")).first()
    assert right / total >= 0.99


def test_ties_go_to_the_first_code(spark):
    df = spark.createDataFrame([("xx", "abc"), ("aa", "abc")], "lang string, text string")
    assert LanguageModel.fit(df).best(["abc"]) == ["aa"]


def test_empty_model(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert LanguageModel.fit(empty).best(["abc"]) == [UNKNOWN_LANG]


def test_profile_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr("webloom.functions.language.MAX_LANGUAGES", 0)
    df = spark.createDataFrame([("xx", "abc")], "lang string, text string")
    with pytest.raises(ValueError):
        LanguageModel.fit(df)


ODD = ["The the\rTHE\x0bthe o'clock", "ΟΔΟΣ ΣΑΣ aΣ.Σb İx", "𝒜𝒷c 𐐀𐐁𐐂 😀 日本語", "", " \n", "7", "a", None]


@pytest.mark.parametrize("bound", [None, "_CHARS_AT_ONCE", "_PIECE_CHARS", "_GRAMS_HELD", "_DENSE_CELLS"])
def test_grams_equal_those_of_words(spark, monkeypatch, bound):
    if bound:
        monkeypatch.setattr(f"webloom.functions.language.{bound}", 3)
    df = spark.createDataFrame([(code, t) for code in ("xx", "yy") for t in ODD] + [(None, "abc")], "lang string, text string")
    words = df.where("lang IS NOT NULL").select("lang", F.explode(F.split(F.trim(normal_form(F.col("text"))), " ")).alias("w"))
    grams = words.where("w <> ''").select("lang", F.explode(trigrams(F.concat(F.lit(" "), "w", F.lit(" ")))).alias("gram"))
    plain = {(r[0], r[1]): r[2] for r in grams.groupBy("lang", "gram").count().collect()}
    got = Counter()
    for r in counted_grams(df).collect():
        got[r["lang"], r["gram"]] += r["n"]
    assert got == plain


def test_a_task_hands_on_each_gram_once(spark):
    """Neither words nor the vocabulary become rows: what leaves a task is as small as its trigrams."""
    rows = [("xx", f"ab{'a' * (i % 50)}b ab") for i in range(2000)]
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    found = counted_grams(df).collect()
    assert len(found) == len({r["gram"] for r in found}) < 10


def test_few_partitions_are_dealt_to_whole_waves(spark):
    cores = spark.sparkContext.defaultParallelism
    parts = lambda n: spread(spark.range(1000).repartition(n), "id").rdd.getNumPartitions()
    assert [parts(1), parts(cores + 1), parts(3 * cores + 1), parts(4 * cores)] == [cores, 2 * cores, 4 * cores, 4 * cores]
