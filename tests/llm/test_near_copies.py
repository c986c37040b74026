"""Near copies by five-word shingles against a comparison of all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import MEDIUM
from tests.llm.test_search import roots
from webloom.llm import common, near_copies


def plain_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def similar(a, b):
    return a == b or 10 * len(a & b) >= 8 * len(a | b)


def plain_kept(rows):
    """Smallest id of every component of similar texts."""
    rows = sorted(rows)
    sets = [plain_set(t) for _, t in rows]
    holders = {}
    for k, s in enumerate(sets):
        for x in s or [None]:
            holders.setdefault(x, []).append(k)
    pairs = {p for h in holders.values() for p in combinations(h, 2)}
    links = [(a, b) for a, b in pairs if similar(sets[a], sets[b])]
    root = roots(len(rows), links)
    return {rows[r][0] for r in root}, links, sets


def test_the_sample_table(llm_spark):
    docs = common.table(llm_spark, MEDIUM, "documents").select("doc_id", "text")
    want, links, sets = plain_kept([tuple(r) for r in docs.collect()])
    assert sum(sets[a] != sets[b] for a, b in links) >= 12  # near copies that are not the same set
    got = [r.doc_id for r in near_copies.one_of_each(docs).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_near_copies_of_all_degrees(docs_of):
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(60)]
    rows = []
    for base in range(12):
        text = [word() for _ in range(150)]
        for copy in range(20):
            own = list(text)
            for _ in range(rng.randrange(0, 12)):  # every changed word takes five shingles
                own[rng.randrange(len(own))] = word()
            rows.append(" ".join(own))
        rows.append(" ".join(passage + text[:90]))  # shares a passage with others
    rows += ["A b", "a B ", "a b c", "", "  ", "\t"]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    want, _, sets = plain_kept(rows)
    kept = {r.doc_id for r in near_copies.one_of_each(docs_of(rows)).collect()}
    # a group that hangs together only by texts that lead nowhere may stay two
    assert want <= kept and len(kept) <= len(want) + 2
    by_id = [s for (i, _), s in zip(rows, sets) if i in kept]
    assert not any(similar(a, b) for a, b in combinations(by_id, 2))


def test_a_large_group_and_a_hot_passage(docs_of):
    rng = np.random.default_rng(2)
    base = [f"b{i}" for i in range(80)]
    rows = [(i, " ".join([*base[: 79], f"x{i}"])) for i in range(400)]  # all near copies of each other
    own = lambda i: [f"o{i}-{k}" for k in rng.integers(0, 9, 30)]
    rows += [(1000 + i, " ".join([*base[:40], *own(i)])) for i in range(200)]  # half is a common passage
    kept = {r.doc_id for r in near_copies.one_of_each(docs_of(rows)).collect()}
    assert kept == {0, *range(1000, 1200)}


def test_a_group_is_not_compared_pair_by_pair(docs_of, monkeypatch):
    """Copies that differ from each other but not from a text between them: one group, a few comparisons each."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(100)]
    rows = [(0, " ".join(base))]
    for i in range(1, 200):
        own = list(base)
        for at in rng.sample(range(10, 90), 2):  # every changed word takes five shingles
            own[at] = f"x{i}-{at}"
        rows.append((i, " ".join(own)))
    counts, measured = [], near_copies._measured

    def watched(pairs, sets):
        counts.append(pairs.count())
        return measured(pairs, sets)

    monkeypatch.setattr(near_copies, "_measured", watched)
    assert [r.doc_id for r in near_copies.one_of_each(docs_of(rows)).collect()] == [0]
    assert sum(counts) < near_copies.BANDS * len(rows)


def test_texts_that_are_similar_to_none_are_not_compared_with_a_whole_bucket(docs_of, monkeypatch):
    """Most share bands with the others, as half of their shingles are the same, but are too far apart."""
    rng = random.Random(6)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(250):
        own = list(base)
        for at in rng.sample(range(5, 145), rng.choice([2, 5, 6])):
            own[at] = f"x{rng.randrange(3)}-{at}"  # so that other texts have the changed shingles as well
        rows.append((i, " ".join(own)))
    counts, measured = [], near_copies._measured

    def watched(pairs, sets):
        counts.append(pairs.count())
        return measured(pairs, sets)

    monkeypatch.setattr(near_copies, "_measured", watched)
    kept = {r.doc_id for r in near_copies.one_of_each(docs_of(rows)).collect()}
    want, links, sets = plain_kept(rows)
    assert want <= kept and len(kept) > 100
    assert not any(similar(sets[a], sets[b]) for a, b in combinations(sorted(kept), 2))
    assert sum(counts[1:]) < len(links) + len(rows)


def test_bits_rule_out_no_similar_pair(llm_spark):
    rng = random.Random(8)
    texts = ["", "one", "one two"]
    for n in (6, 12, 24, 104, 704):  # a changed end takes one shingle, a changed word five
        base = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        texts.append(" ".join(base))
        texts += [" ".join([*base[:-k], *(f"e{j}" for j in range(k))]) for k in (1, n // 12 or 1, n // 9 or 1, n // 6 or 1)]
        for k in (1, 2, 4, n // 40 or 1):
            own = list(base)
            for at in rng.sample(range(n), min(k, n)):
                own[at] = f"x{at}"
            texts.append(" ".join(own))
    known = near_copies._sets(llm_spark.createDataFrame(list(enumerate(texts)), "c bigint, text string"))
    own = known.select("c", "n", "odd")
    its = known.select(F.col("c").alias("leader"), F.col("n").alias("m"), F.col("odd").alias("its"))
    may = {(r.c, r.leader) for r in own.crossJoin(its).where(near_copies._may_be_similar()).collect()}
    sets = [plain_set(t) for t in texts]
    near = {(a, b) for a, x in enumerate(sets) for b, y in enumerate(sets) if similar(x, y)}
    assert near <= may and len(near) > 2 * len(texts)
    assert len(may) < len(near) + len(texts)


def test_rows_that_may_be_among_keys(llm_spark):
    rows = llm_spark.createDataFrame([(i if i % 50 else None, f"t{i}") for i in range(4000)], "i bigint, t string")
    keys = rows.where("t like '%7' or i is null")
    found = common.may_hold(rows, keys, "i", "t")
    assert found.columns == ["i", "t", "_may"] and found.count() == 4000
    may = found.where("_may").drop("_may")
    assert keys.exceptAll(may).count() == 0
    assert may.count() < keys.count() + 20
    assert common.may_hold(rows, rows.limit(0), "i", "t").where("_may").count() == 0


def test_bands_find_pairs_at_the_border():
    rng = np.random.default_rng(3)
    found = 0
    for _ in range(300):
        shared = rng.integers(0, 2**63, 160).astype(np.uint64)
        a, b = (np.unique(np.concatenate([shared, rng.integers(0, 2**63, 20).astype(np.uint64)])) for _ in "ab")
        found += any(x == y for x, y in zip(near_copies.bands(a), near_copies.bands(b)))
    assert found == 300
    assert near_copies.bands(np.zeros(0, np.uint64)) == []


@pytest.mark.parametrize("again", [1, 2])
def test_odd_rows(edge_docs, no_docs, docs_of, again):
    docs = edge_docs if again == 1 else edge_docs.union(edge_docs)
    got = near_copies.one_of_each(docs)
    assert got.columns == edge_docs.columns
    kept = sorted((r.doc_id for r in got.collect()), key=lambda i: -1 if i is None else i)
    assert kept == [None, 0, 3, 4, 5, 6, 7]  # null, empty and blank are one; so are 7 and 8
    assert near_copies.one_of_each(no_docs).count() == 0
