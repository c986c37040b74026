"""Near-duplicates, top-k, shards and the pipeline against plain versions."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.conftest import EDGE_TEXTS
from tools.check_oracle import connect, difference
from webloom.llm import common, components, decontamination, near_copies, sharding, simhash, topk, vantage
from webloom.llm.queries import ORACLE_SQL, QUERIES


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    grams = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words]
    hashes = [xxhash.xxh64(" ".join(g).encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) > len(hashes) / 2)


def plain_components(fps):
    a = np.array(fps, dtype=np.uint64)
    links = np.argwhere(np.triu(np.bitwise_count(a[:, None] ^ a[None, :]) <= 2, 1))
    return roots(len(fps), links.tolist())


def plain_kept(rows):
    from tests.llm.test_near_copies import plain_kept as kept

    return kept(rows)


def near(rng, n):
    """Fingerprints in clusters of all sizes, chains included."""
    out = [0, 1, 3, 7, 15]
    while len(out) < n:
        x = int(rng.integers(0, 2**63))
        for _ in range(int(rng.integers(1, 30))):
            out.append(x)
            for _ in range(int(rng.integers(0, 5))):
                x ^= 1 << int(rng.integers(0, 64))
    return np.unique(np.array(out, dtype=np.uint64))


def test_trees_lose_no_link():
    rng = np.random.default_rng(5)
    points = near(rng, 3000)
    want = plain_components(points)
    member, centre = vantage.linked(points, 2)
    assert roots(len(points), zip(member.tolist(), centre.tolist())) == want
    tree = vantage.VantageTree.grow(points[::5], 64, 2)
    at, shard = tree.route(points)
    assert tree.leaves > 4
    links = []
    for s in range(tree.leaves):
        own = at[shard == s]
        a, b = vantage.linked(points[own], 2)
        links += zip(own[a].tolist(), own[b].tolist())
    assert roots(len(points), links) == want


def test_a_ball_that_no_vantage_parts():
    ball = np.array([0] + [1 << i for i in range(64)] + [1 << i | 1 << j for i in range(64) for j in range(i)], np.uint64)
    member, centre = vantage.linked(ball, 2)
    assert set(roots(len(ball), zip(member.tolist(), centre.tolist()))) == {0}


def test_near_duplicates_equal_a_comparison_of_all(llm_spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_CLASSES", 50)
    docs = common.table(llm_spark, SMALL, "documents").collect()
    fps = [plain_fingerprint(d.text) for d in docs]
    least = {}
    for d, r in zip(docs, plain_components(fps)):
        least[r] = min(least.get(r, d.doc_id), d.doc_id)
    want = {d.doc_id: (f"{f:016x}", least[r]) for d, f, r in zip(docs, fps, plain_components(fps))}
    rows = QUERIES["op10_vantage_near_dedup"](llm_spark, SMALL).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == want
    assert len(set(least.values())) < len(docs)


@pytest.mark.parametrize("size", [10, 700])
def test_components_of_chains_and_hubs(llm_spark, size):
    links = [(i, i + 1) for i in range(0, 40)] + [(100 + size, 101 + i) for i in range(size)] + [(9, 9), (5, 4)]
    df = llm_spark.createDataFrame(links, "u bigint, v bigint")
    got = {r.node: r.root for r in components.connected(df).collect()}
    want = roots(1000, links)
    assert got == {i: want[i] for i in {x for pair in links if pair[0] != pair[1] for x in pair}}
    assert components.connected(df.limit(0)).count() == 0


def test_fingerprints_of_odd_rows(edge_docs, no_docs, docs_of):
    for t in EDGE_TEXTS + ["É É É x", "a b", "a\x0bb\x0cc\x1cd"]:
        value = simhash.fingerprint(None if t is None else t.encode())
        assert value % 2**64 == plain_fingerprint(t)
    rows = simhash.with_fingerprints(edge_docs.drop("fp"), "doc_id")
    named = rows.join(simhash.near_duplicates(rows), "fp").collect()
    assert len(named) == edge_docs.count()
    by_id = {r.doc_id: r.component_id for r in named}
    assert by_id[0] == by_id[1] == by_id[2] == 0 and by_id[7] == by_id[8] == 7
    assert by_id[None] is None
    tied = docs_of([(None, "a b c d"), (None, "a b c d"), (1, "x y z"), (1, "p q r")])
    assert sorted(str(r.doc_id) for r in near_copies.one_of_each(tied).collect()) == ["1", "1", "None"]


# ---- top-k -------------------------------------------------------------------------------------


def plain_top_k(rows, k=5):
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows]
    out = set()
    for q, v in whole:
        if q % 50 == 0:
            product = lambda w: min(max(sum(a * b for a, b in zip(v, w)), -(2**63)), 2**63 - 1)
            scores = [(-product(w), i) for i, w in whole if i != q and len(w) == len(v)]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])}
    return out


@pytest.mark.parametrize("shard_rows, query_bytes, leaf", [(16_384, 32 << 20, 256), (60, 3 * 600, 7)])
def test_top_k_equals_all_products(llm_spark, monkeypatch, shard_rows, query_bytes, leaf):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(topk, "QUERY_BYTES", query_bytes)
    monkeypatch.setattr(topk, "LEAF", leaf)
    rows = common.table(llm_spark, SMALL, "embeddings").collect()
    got = QUERIES["op9_kd_topk"](llm_spark, SMALL).collect()
    want = plain_top_k([(r.vec_id, r.embedding) for r in rows])
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want


def test_top_k_sql(llm_spark):
    sql = ORACLE_SQL["op9_kd_topk"]
    assert difference(QUERIES["op9_kd_topk"](llm_spark, SMALL), connect(SMALL), sql) is None


def test_top_k_of_odd_rows(llm_spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 3)
    good = [(0, [1.0, -0.5]), (1, [0.1, 0.1]), (2, [0.1, 0.1]), (50, [-1.0, 2.0]), (3, [3e37, 3e37]), (4, [1.0]), (100, [-3e37, 1.0])]
    bad = [(5, None), (6, [None, 1.0]), (7, [float("nan"), 1.0]), (8, [float("inf"), 0.0]), (None, [1.0, 1.0])]
    ddl = "vec_id bigint, embedding array<float>, score int, rank string"
    make = lambda rows: llm_spark.createDataFrame([(i, v, 1, "x") for i, v in rows], ddl)
    search = lambda df: topk.top_k(topk.whole_numbers(df, "vec_id", "embedding"), F.col("id") % 50 == 0)
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in search(make(good + bad)).collect()}
    assert got == plain_top_k(good)
    assert search(make([])).count() == 0
    twice = search(make([(0, [1.0]), (1, [0.5]), (1, [0.5]), (2, [0.25])])).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in twice) == [(1, 1, 32768), (2, 1, 32768), (3, 2, 16384)]


def test_trees_open_few_leaves_where_boxes_tell_vectors_apart():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(64, 8)) * 4000
    vectors = np.floor(np.repeat(centres, 200, 0) + rng.normal(size=(12_800, 8)) * 50)
    ids = rng.permutation(len(vectors))
    tree, opened = topk.KdTree(vectors, ids), 0
    assert sorted(tree.ids) == list(range(len(ids))) and max(np.subtract(tree.end, tree.begin)[np.array(tree.child) == 0]) <= topk.LEAF
    for q in range(0, len(vectors), 400):
        best = topk.Best(5, -np.inf)
        opened += tree.search(vectors[q], ids[q], best)
        scores = vectors @ vectors[q]
        want = sorted(((int(s), -int(i)) for s, i in zip(scores, ids) if i != ids[q]), reverse=True)[:5]
        assert sorted(best.heap, reverse=True) == want
    assert opened < 0.2 * tree.leaves * 32


def test_a_hot_id_spreads_over_shards(llm_spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 100)
    rng = np.random.default_rng(3)
    rows = [(7 if i % 3 == 0 else i, rng.normal(size=4).tolist()) for i in range(1, 1800)]
    tree = topk.KdTree

    def watched(vectors, ids, leaf):
        if len(vectors) > 100:
            raise ValueError(f"{len(vectors)} rows in a shard of 100")
        return tree(vectors, ids, leaf)

    monkeypatch.setattr(topk, "KdTree", watched)
    df = llm_spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = topk.top_k(topk.whole_numbers(df, "vec_id", "embedding"), F.col("id") % 50 == 0).collect()
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in found} == plain_top_k(rows)


# ---- shards --------------------------------------------------------------------------------------


def test_lookup_table():
    names = [f"s{i}" for i in range(7)]
    table = sharding.lookup(names, 997)
    sizes = Counter(table)
    assert set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    fewer = sharding.lookup(names[:-1], 997)
    assert sum(a != b for a, b in zip(table, fewer)) < 2.5 * 997 / 7
    # turn by turn with whole preference lists
    orders = []
    for s in names:
        start = __import__("zlib").crc32(f"start:{s}".encode()) % 997
        step = __import__("zlib").crc32(f"step:{s}".encode()) % 996 + 1
        orders.append(iter([(start + k * step) % 997 for k in range(997)]))
    owner, free = {}, set(range(997))
    while free:
        for s, order in enumerate(orders):
            slot = next((x for x in order if x in free), None)
            if slot is not None:
                owner[slot] = s
                free.discard(slot)
    assert [owner[i] for i in range(997)] == table
    for bad in ((names, 1000), ([], 997), (["a", "a"], 997), (names, 5)):
        with pytest.raises(ValueError):
            sharding.lookup(*bad)


def test_placement(llm_spark, edge_docs, no_docs, tmp_path):
    table = sharding.lookup([f"shard-{i:04d}" for i in range(sharding.SHARDS)])
    rows = QUERIES["op6_permutation_shards"](llm_spark, SMALL).collect()
    assert len(rows) == common.table(llm_spark, SMALL, "documents").count()
    for r in rows:
        value = xxhash.xxh64(str(r.doc_id).encode(), seed=42).intdigest()
        signed = value - 2**64 if value >= 2**63 else value
        assert r.slot == signed % sharding.SLOTS and r.shard == table[r.slot]
    placed = sharding.placed(edge_docs, ["doc_id"], ["a", "b", "c"], 13)
    assert placed.count() == edge_docs.count()
    sharding.write(placed, str(tmp_path / "s"), 2)
    assert llm_spark.read.parquet(str(tmp_path / "s")).count() == edge_docs.count()
    assert sharding.placed(no_docs, ["doc_id"], ["a"], 13).count() == 0


# ---- pipeline ---------------------------------------------------------------------------------------


def test_pipeline_stages(llm_spark):
    docs = common.table(llm_spark, SMALL, "documents").withColumn("score", F.lit("kept")).withColumn("row", F.lit(1))
    columns, seen = docs.columns, docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = common.stored(stage(llm_spark, seen, SMALL), "test")
        kept[name] = out
        if name != "packing":
            assert out.columns == columns
            assert {r.score for r in out.select("score").distinct().collect()} == {"kept"}
            seen = out
    ids = lambda name: {r.doc_id for r in kept[name].select("doc_id").collect()}
    before = {r.doc_id: r.text for r in kept["toxicity"].collect()}
    assert ids("near_duplicates") == plain_kept(list(before.items()))[0]
    bench = common.table(llm_spark, SMALL, "benchmark").collect()
    index = decontamination.Index([(b.item_id, b.text) for b in bench])
    assert ids("decontamination") == {i for i in ids("near_duplicates") if not index.leaks(before[i])}
    after = {r.doc_id: r for r in kept["secrets"].collect()}
    assert set(after) == ids("decontamination")
    for i, r in after.items():
        assert r.n_chars == len(r.text) if "[secret]" in r.text else r.text == before[i]
    assert ids("packing") == set(after)


def test_pipeline_of_odd_rows(llm_spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = common.stored(stage(llm_spark, docs, SMALL), "test")
            assert docs.columns == edge_docs.columns
        packed = corpus_pipeline.pack(llm_spark, docs, SMALL)
        assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_equal_rows_of_a_shard_are_dealt_to_all_its_tasks(docs_of, llm_spark, tmp_path):
    docs = docs_of([(7, "the same text")] * 3000)
    llm_spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sharding.write(sharding.placed(docs, ["doc_id"], ["a", "b"], 13), str(tmp_path / "s"), 32)
    finally:
        llm_spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r[1] for r in llm_spark.read.parquet(str(tmp_path / "s")).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 3000 and len(sizes) == 4 and max(sizes) <= 1500
