from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from webloom.operators import anchors as A, ranks
from webloom.plans import batches as BT, index_build as B
from webloom.sources.lines import read_lines

ID = "clueweb12-en0000-00-00001"


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_spam_lines(spark):
    df = lines(spark, f"7 {ID}", "12\t x  y", " 5 lead", "one", "n id", "")
    assert {tuple(r) for r in ranks.parse_spam(df).collect()} == {(ID, 7), ("x", 12)}


def test_page_rank_lines(spark):
    df = lines(spark, "a 0.5", "b  1.5e-8", "c NaN", "d", "e x", " 5 lead")
    got = {r["id"]: r["page_rank"] for r in ranks.parse_page_ranks(df).collect()}
    assert set(got) == {"a", "b", "c"} and got["a"] == 0.5 and got["c"] != got["c"]


@pytest.mark.parametrize(
    "parse, good, bad",
    [(ranks.parse_spam, "1 a", b) for b in ("one", "x y", " 5 lead")]
    + [(ranks.parse_page_ranks, "a 1", b) for b in ("one", "x y", " lead 5")],
)
def test_failfast(spark, parse, good, bad):
    assert parse(lines(spark, good), "failfast").count() == 1
    with pytest.raises(PySparkException):
        parse(lines(spark, good, bad), "failfast").collect()
    with pytest.raises(ValueError):
        parse(lines(spark, good), "other")


def test_highest_rank_wins(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "id string, spam_rank bigint")
    assert {tuple(r) for r in ranks.highest(df).collect()} == {("a", 3), ("b", 2)}


def test_anchor_lines(spark):
    df = lines(
        spark,
        f"{ID} text  here ",
        f"{ID}\t\tx",
        f"{ID} ",
        ID,
        f" {ID} lead",
        "other text",
        f"{ID} a\nb",
        f"{ID} end\n",
        f"{ID}x y",
    )
    got = Counter(r["anchor"] for r in A.parse_anchors(df).collect())
    assert got == Counter(["text  here ", "x", ""])


def test_anchor_id_pattern(spark):
    df = A.parse_anchors(lines(spark, "<r1> a b", f"{ID} c"), id_pattern=r"<[^>]+>")
    assert [tuple(r) for r in df.collect()] == [("<r1>", "a b")]


def test_anchor_cut(spark):
    df = spark.createDataFrame([("a", "x" * 401), ("b", "y" * 400)], "id string, anchor string")
    assert {len(r["anchor"]) for r in A.cut_anchors(df).collect()} == {400}


def skewed(spark):
    """One id holds a third of all lines, with repeated and with distinct texts."""
    hot = [("hot", "en", f"text {i % 700}") for i in range(1000)]
    rest = [(f"id{i % 400}", "de" if i % 3 else "en", f"t{i % 7}") for i in range(2000)]
    return spark.createDataFrame(hot + rest, "id string, lang string, anchor string"), hot + rest


class OneLanguage:
    """Stand-in for a model: short texts are German."""

    def detect(self, text):
        return F.when(F.length(text) < 4, "de").otherwise("en")


def test_scored_anchors_hold_every_line(spark):
    df, rows = skewed(spark)
    found = Counter()
    for r in A.scored_anchors(df.drop("lang"), OneLanguage()).collect():
        found[(r["id"], r["lang"], r["anchor"])] += r["n"]
    assert found == Counter((i, "de" if len(t) < 4 else "en", t) for i, _, t in rows)


def test_nested_anchors_hold_every_line_or_fail(spark):
    df, rows = skewed(spark)
    flat = df.groupBy("id", "lang", "anchor").agg(F.count("*").alias("n"))
    found, per_doc = Counter(), A.nested_anchors(flat).collect()
    assert len(per_doc) == len({r[0] for r in rows})
    for r in per_doc:
        langs = [a["lang"] for a in r["anchors"]]
        assert langs == sorted(set(langs))
        for a in r["anchors"]:
            assert a["texts"] == sorted(a["texts"])
            found.update((r["id"], a["lang"], t) for t in a["texts"])
    assert found == Counter(rows)
    with pytest.raises(PySparkException, match="anchor texts of hot"):
        A.nested_anchors(flat, most_bytes=5000).collect()


def test_live_anchors(spark):
    anchors = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "id string, anchor string")
    docs = spark.createDataFrame([("a",), ("c",)], "id string")
    assert A.live_anchors(anchors, docs).count() == 2


def test_lines_read_plain_and_compressed(spark, tmp_path):
    import bz2

    (tmp_path / "a.txt").write_text("1 a\n2 b\n")
    (tmp_path / "b.txt.bz2").write_bytes(bz2.compress(b"3 c\n"))
    assert read_lines(spark, f"{tmp_path}/*").count() == 3
    assert read_lines(spark, None) is None


def test_dropped_lines_are_counted_by_reason(spark):
    spam = lines(spark, "5 a", "x a", "7", "", " 5 a", "5  ", "99999999999999999999 a", "x b")
    got = {r["reason"]: (r["n"], r["first"], r["last"]) for r in ranks.line_counts(ranks.spam_outcomes(spam)).collect()}
    # a line that begins with a blank has an empty rank
    assert got == {
        None: (1, "5 a", "5 a"),
        ranks.NO_NUMBER: (3, "99999999999999999999 a", "x b"),
        ranks.NO_ID: (3, "", "7"),
        ranks.NO_RANK: (1, " 5 a", " 5 a"),
    }
    assert ranks.parse_spam(spam).count() == got[None][0]
    rank = lines(spark, "a 0.5", "a", "a x", "a NaN", "")
    assert ranks.page_rank_outcomes(rank).where("reason IS NULL").count() == ranks.parse_page_ranks(rank).count() == 2
    anchors = lines(spark, f"{ID} text", f"{ID}", "other text", f"{ID} a\nb")
    assert A.anchor_outcomes(anchors).where("reason IS NULL").count() == A.parse_anchors(anchors).count()


def counting(spark):
    """A model that counts the texts it is given, and its accumulator."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(v):
        seen.add(1)
        return "en"

    class Counting:
        detect = staticmethod(lambda text: counted(text))

    return Counting(), seen


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_each_distinct_anchor_is_scored_once(spark, threshold):
    """100 lines of 20 distinct texts: for nested documents and for stored sides as a whole."""
    lines_df = lines(spark, *(f"{ID[:-1]}{i % 10} the text of {i % 20}" for i in range(100)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        model, seen = counting(spark)
        scored = A.scored_anchors(A.parse_anchors(lines_df), model)
        assert len(A.nested_anchors(scored).collect()) == 10
        assert seen.value == 20
        model, seen = counting(spark)
        inputs = B.Inputs(spark.createDataFrame([], "key string, value string"), anchors=lines_df)
        stored = BT.store_sides(spark, B.read_sides(inputs, model))
        assert stored.sides.anchors.count() == 20 and stored.sides.anchor_ids.count() == 10
        assert seen.value == 20
        stored.drop(spark)
        assert not spark.sql("SHOW TABLES LIKE 'webloom_sides_*'").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
