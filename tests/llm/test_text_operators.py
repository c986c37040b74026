"""Decontamination, toxicity, secrets, licences and languages against plain versions."""

import hashlib
import pickle
import random
import re
import string
from collections import Counter
from types import SimpleNamespace
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import MEDIUM, SMALL
from webloom.llm import common, decontamination as D, language_id as L, licences, secret_scan as S, toxicity as T
from webloom.llm.queries import QUERIES

# ---- decontamination -------------------------------------------------------------------------


def plain_leaks(index, text):
    """Every window against every item."""
    ids, out = [index.vocabulary.get(w, -1) for w in D.words(text)], {}
    for s in range(0, max(1, -(-len(ids) // index.stride) - 1) * index.stride, index.stride):
        passage = ids[s : s + 2 * index.stride]
        grams, there = D.shingles(passage), set(passage)
        for k, (item, wanted, question, answer, _) in enumerate(index.items):
            overlap = len(wanted & grams) / len(wanted)
            parts = [len(p & there) / len(p) if p else 1.0 for p in (question, answer)]
            if overlap >= D.OVERLAP - 1e-9 and min(parts) >= D.PART_OVERLAP:
                out[item] = max(out.get(item, 0), overlap)
    return out


def test_leaks_equal_a_comparison_of_all(llm_spark):
    docs, bench = (common.table(llm_spark, SMALL, t).collect() for t in ("documents", "benchmark"))
    index = D.Index([(b.item_id, b.text) for b in bench])
    rng = np.random.default_rng(1)
    texts = [d.text for d in docs]
    for b in bench:  # planted with every twentieth word lost
        words = [w for w in b.text.split() if rng.random() > 0.05]
        host = texts[rng.integers(len(docs))].split()
        place = rng.integers(len(host) + 1)
        texts.append(" ".join(host[:place] + words + host[place:]))
    found = 0
    for t in texts:
        got = {x["item_id"]: x["overlap"] for x in index.leaks(t)}
        assert got == plain_leaks(index, t)
        found += len(got)
    assert found > len(bench) / 2
    rows = QUERIES["op1_bm25_decontamination"](llm_spark, SMALL).collect()
    want = {(d.doc_id, i) for d in docs for i in plain_leaks(index, d.text)}
    assert {(r.doc_id, r.item_id) for r in rows} == want and want


def test_retrieval_is_complete():
    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary, rng.integers(5, 30)))) for i in range(100)]
    index = D.Index(items)
    for _ in range(50):
        own = " ".join(rng.choice(vocabulary, 80))
        ids = np.array([index.vocabulary.get(w, -1) for w in own.split()])
        windows = max(1, -(-len(ids) // index.stride) - 1)
        got = {
            (w, k) for w, b, terms in index.open_blocks(ids, windows) for k, _ in index.retrieve(b, terms)
        }
        want = set()
        for w in range(windows):
            terms = set(ids[w * index.stride : (w + 2) * index.stride].tolist()) - {-1}
            score = {}
            for t in terms:
                for _, run in index.runs[t]:
                    for k, s in run:
                        score[k] = score.get(k, 0) + s
            want |= {(w, k) for k, s in score.items() if s >= 1 + 1e-9}
        assert want <= got


def test_many_index_shards_give_the_same(llm_spark, monkeypatch):
    docs, bench = (common.table(llm_spark, SMALL, t) for t in ("documents", "benchmark"))
    one = {(r.doc_id, x.item_id) for r in D.with_leaks(docs, bench, "doc_id").collect() for x in r.leaks}
    monkeypatch.setattr(D, "INDEX_WORDS", 400)
    many = {(r.doc_id, x.item_id) for r in D.with_leaks(docs, bench, "doc_id").collect() for x in r.leaks}
    assert one == many and one


@pytest.mark.parametrize("words_of_a_shard", [D.INDEX_WORDS, 400])
def test_repeated_items_and_clashing_names(llm_spark, monkeypatch, words_of_a_shard):
    monkeypatch.setattr(D, "INDEX_WORDS", words_of_a_shard)
    names = ["key", "leaks", "kept", "shard", "a: b"]
    docs = common.table(llm_spark, SMALL, "documents").withColumns({c: F.col("doc_id") for c in names})
    bench = common.table(llm_spark, SMALL, "benchmark")
    keep = ["doc_id", "key", "kept", "shard", "a: b"]
    once = D.with_leaks(docs, bench, *keep).collect()
    assert len(once) == docs.count() and all(r.doc_id == r.key == r.kept == r.shard for r in once)
    thrice = D.with_leaks(docs, bench.union(bench).union(bench), *keep).collect()
    items = lambda rows, n: {r.doc_id: sorted(n * [x.item_id for x in r.leaks]) for r in rows}
    assert items(thrice, 1) == items(once, 3) and any(r.leaks for r in once)


def test_no_task_holds_two_shards(llm_spark, monkeypatch):
    monkeypatch.setattr(D, "INDEX_WORDS", 400)
    bench = common.table(llm_spark, SMALL, "benchmark")
    shards, n = D.index_shards(bench)
    sizes = [sum(len(x[4]) for x in pickle.loads(r["index"]).items) for r in shards.collect()]
    assert n > 3 and max(sizes) < 3 * 400
    D._OPEN.clear()
    for r in shards.collect():
        D.opened(str(r["shard"]), SimpleNamespace(value=bytes(r["index"])))
        assert list(D._OPEN) == [str(r["shard"])]
    D._OPEN.clear()


def test_decontamination_of_odd_rows(llm_spark, edge_docs, no_docs):
    ddl = "item_id bigint, text string"
    bench = llm_spark.createDataFrame(
        [(1, None), (2, ""), (3, "too few words"), (None, "x x x x x x"), (4, "x x x x x x")], ddl
    )
    rows = D.with_leaks(edge_docs, bench, "doc_id").collect()
    assert len(rows) == edge_docs.count()
    assert {r.doc_id: {x.item_id for x in r.leaks} for r in rows if r.leaks} == {5: {None, 4}}
    assert D.with_leaks(no_docs, bench, "doc_id").count() == 0
    none = D.with_leaks(edge_docs, llm_spark.createDataFrame([], ddl), "doc_id").collect()
    assert {len(r.leaks) for r in none} == {0}


# ---- toxicity ----------------------------------------------------------------------------------


def test_toxicity_on_held_out_rows(llm_spark):
    labels = common.table(llm_spark, MEDIUM, "labels")
    rows = QUERIES["op2_pu_toxicity"](llm_spark, MEDIUM).join(labels, "doc_id").where("held_out").collect()
    bad, good = ([r.predicted for r in rows if r.toxic == t] for t in (1, 0))
    assert np.mean(bad) > 0.5 and np.mean(good) < 0.05
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)


def test_risk_is_held_at_zero_and_separates():
    rng = np.random.default_rng(0)
    clean = lambda: rng.choice(np.arange(100, 1100, dtype=np.uint32), 30, replace=False)
    toxic = lambda: np.concatenate([clean(), rng.choice(np.arange(10, dtype=np.uint32), 2, replace=False)])
    make = lambda n, kind: [np.sort(kind()) for _ in range(n)]
    unlabelled = make(900, clean) + make(100, toxic)
    model = T.fit(make(200, toxic), unlabelled, 0.1)
    assert set(range(10)) <= set(model.hashes.tolist())
    weights = dict(zip(model.hashes.tolist(), model.weights.tolist()))
    z = lambda d: model.bias + sum(weights.get(int(h), 0.0) for h in d)
    assert np.mean([z(d) > 0 for d in make(300, toxic)]) > 0.95
    assert np.mean([z(d) > 0 for d in make(300, clean)]) < 0.05


def test_training_sends_the_driver_only_what_has_a_weight(llm_spark, docs_of, monkeypatch):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices(string.ascii_lowercase, k=9))
    toxic = {i for i in range(240) if i % 4 == 0}
    texts = {i: " ".join([word() for _ in range(1500)] + ["vile"] * (i in toxic)) for i in range(240)}
    texts[244] = texts[0]  # a copy counts once
    labels = llm_spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(240)], "doc_id bigint, quality int, toxic int")
    docs, sent, collect = docs_of(texts.items()), [], type(labels).collect

    def counted(frame):
        rows = collect(frame)
        sent.append(sum(len(x) * 4 if isinstance(x, (bytes, list)) else 8 for r in rows for x in r))
        return rows

    monkeypatch.setattr(type(labels), "collect", counted)
    model = T.train(docs, labels)
    assert sum(sent) < 10_000  # the features of the sample are more than 2 MB
    learned = [i for i in range(240) if zlib.crc32(str(i).encode()) % 3 != 1]
    made = {i: T.features(texts[i]) for i in learned}
    known = [i for i in learned if i in toxic]
    plain = T.fit([made[i] for i in known], list(made.values()), len(known) / len(learned))
    assert zlib.crc32(b"vile") in model.hashes and model.hashes.tolist() == plain.hashes.tolist()
    assert np.allclose([*model.weights, model.bias], [*plain.weights, plain.bias], rtol=0, atol=1e-9)


def test_toxicity_of_odd_rows(llm_spark, edge_docs, no_docs):
    labels = llm_spark.createDataFrame(
        [(1, 1, 1), (1, 1, 0), (None, 1, 1), (2, None, None)], "doc_id bigint, quality int, toxic int"
    )
    for docs in (edge_docs, no_docs):
        for known in (labels, labels.limit(0)):
            rows = T.scored(docs, T.train(docs, known), "doc_id").collect()
            assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    by_text = {}
    for r in T.scored(edge_docs, T.train(edge_docs, labels), "doc_id", "text").collect():
        assert by_text.setdefault(r.text or "", r.score) == r.score


# ---- secrets -------------------------------------------------------------------------------------

SECRETS = [
    "password=secret:abcdefghij token: 'abcdefgh' é😀 AKIA" + "A1" * 6 + " x AKIA1234 " + "ab12" * 8 + "g" + "f" * 33,
    None, "", 'PASSWD = "x.y-z_/+=AAAA" apikey:12345678 Api_Key=1234567 secret   =  q token=token=tttttttt',
    "zz Zk9qX2mV7bT4nR8wL1pQ5sYc zz Xq7Rt9PwL2mNb4VcZ8kJ3hGf averyveryverylonglowercaseidentifiername",
    "secret=aaaaaaaaaaaa\nsecret=bbbbbbbbbbbb", "ſecret=aaaaaaaaaaaa toKen=bbbbbbbbbbb", "AKIA" * 5, "a" * 31, "0" * 32,
]


def plain_base(text):
    text, out = text or "", []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text, re.I | re.A):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def plain_markov(text, base, table):
    out = []
    for m in re.finditer(S.RUN, text or ""):
        ratio, before = 0.0, 0
        for c in m[0]:
            place = S.ALPHABET.index(c) + 1
            ratio, before = ratio + table[before * S._SIDE + place], place
        free = not any(b[0] < m.end() and m.start() < b[2] for b in base)
        if free and ratio >= max(S.LEAST_RATIO, S.LEAST_PER_CHARACTER * len(m[0])):
            out.append((m.start(), 3, m.end(), "markov"))
    return out


def test_secrets_equal_a_plain_scan(llm_spark):
    docs = common.table(llm_spark, SMALL, "documents").select("doc_id", "text")
    table = S.train(common.table(llm_spark, MEDIUM, "documents"))
    odd = llm_spark.createDataFrame([(-i, t) for i, t in enumerate(SECRETS)], "doc_id bigint, text string")
    text = F.coalesce("text", F.lit(""))
    found = S.scanned(docs.unionByName(odd), table).withColumn("clean", S.redacted(text, F.col("spans")))
    kinds = set()
    for r in found.collect():
        base = plain_base(r.text)
        spans = sorted(base + plain_markov(r.text, base, table))
        assert [(s.start, s.rank, s.end, s.kind) for s in r.base] == base
        assert [(s.start, s.rank, s.end, s.kind) for s in r.spans] == spans
        kinds |= {s[3] for s in spans}
        clean, at = "", 0
        for start, _, end, _ in spans:
            clean += ((r.text or "")[at:start] + "[secret]") if start >= at else ""
            at = max(at, end)
        assert r.clean == clean + (r.text or "")[at:]
    assert kinds == {"assign", "access", "hex", "markov"}


def test_secret_query(llm_spark):
    texts = {r.doc_id: r.text for r in common.table(llm_spark, SMALL, "documents").collect()}
    query = QUERIES["op3_markov_secrets"](llm_spark, SMALL)
    for r in query.collect():
        base = plain_base(texts[r.doc_id])
        line = ",".join(f"{k}:{s}:{e}" for s, _, e, k in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(b[3] == k for b in base) for k in S.BASE)
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def plain_shapes(text, words):
    h = hashlib.md5(text.encode()).hexdigest()
    d = int(h[:8], 16)
    if not words:
        return
    w = [words[(d + i) % len(words)].lower() for i in range(4)]
    date = f"{1990 + d % 40}-{1 + d // 40 % 12:02}-{1 + d // 480 % 28:02}"
    yield 2, "".join(x[0].upper() + x[1:] for x in w)
    yield 3, "".join(f"/{x}" for x in w) + str(d % 10)
    yield 4, f"{date}T{d % 24:02}-{d % 60:02}-{d // 60 % 60:02}-{d % 10**9:09}"
    yield 5, "-".join([h[:8], h[8:12], h[12:16], h[16:20], h[20:]])
    yield 6, "-".join([*w[:3], date])


ORDINARY = [
    "550e8400-e29b-41d4-a716-446655440000", "/usr/local/lib/python3/dist-packages/numpy", "internationalization",
    "customer-order-2024-12-31-backup", "2024-01-15T10-30-00-123456789", "HttpServletRequestWrapperFactory",
    "3f2504e0-4f89-11d3-9a0c-0305e82c3301", "/home/user/projects/data-pipeline/src/main", "0123456789012345678901234",
    "org_apache_hadoop_mapreduce_lib", "release-candidate-2023-11-05-build-42", "getElementsByTagName_withNamespace",
]


@pytest.mark.parametrize("sf_dir", [SMALL, MEDIUM])
def test_ordinary_identifiers_are_no_secrets_and_random_ones_are(llm_spark, sf_dir):
    rng = random.Random(5)
    letters = string.ascii_letters + string.digits
    runs = ["".join(rng.choice(letters) for _ in range(20 + i % 21)) for i in range(400)]
    table = S.train(common.table(llm_spark, sf_dir, "documents"))
    rows = [(i, f"see {run} here") for i, run in enumerate(ORDINARY + runs)]
    found = S.scanned(llm_spark.createDataFrame(rows, "doc_id bigint, text string"), table).collect()
    hit = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in found}
    assert [run for i, run in enumerate(ORDINARY) if hit[i]] == []
    caught = [hit[len(ORDINARY) + i] == [(4, 4 + len(run))] for i, run in enumerate(runs)]
    assert sum(caught) >= 0.95 * len(runs)


def test_secret_models_count_every_document(docs_of):
    texts = [f"an identifier like common_name{'abcdefghijklmnop'[i % 16]} is here" for i in range(1500)]
    texts[::300] = [f"token=Zk9qX2mV7bT4nR8w{i} some ordinary words" for i in range(5)]
    counts = Counter()
    for t in texts:
        base = [m for m in re.finditer(S.ASSIGN, t) if len(m[2]) >= S.ASSIGN_LEAST]
        rest = re.sub(S.ASSIGN, " ", t)
        words = list(dict.fromkeys(re.findall(S.IDENTIFIER, rest)))
        runs = {(1, m[2]) for m in base} | {(0, r) for r in words} | set(plain_shapes(t, words))
        for label, run in runs:
            places = [0] + [S.ALPHABET.index(c) + 1 for c in run]
            counts.update((label, b * S._SIDE + a + 1) for b, a in zip(places, places[1:]))
    assert S.train(docs_of(list(enumerate(texts)))) == pytest.approx(S.ratios(counts))


def test_many_secrets_in_one_text(llm_spark):
    rng = random.Random(2)
    parts = [rng.choice(["%032x" % rng.getrandbits(128), "AKIA" + "Q7" * 8, f"token={'ab1' * rng.randint(1, 9)}", "x" * 25, "und", "ü"]) for _ in range(3000)]
    text = "".join(p + rng.choice(["", " ", "\n"]) for p in parts)
    table = [0.1 * (i % 40) for i in range(S._SIDE * S._SIDE)]
    docs = llm_spark.createDataFrame([(1, text), (2, text[:100])], "doc_id bigint, text string")
    for r in S.scanned(docs, table).withColumn("clean", S.redacted(F.col("text"), F.col("spans"))).collect():
        base = plain_base(r.text)
        spans = sorted(base + plain_markov(r.text, base, table))
        assert [(s.start, s.rank, s.end, s.kind) for s in r.spans] == spans
        clean, at = "", 0
        for start, _, end, _ in spans:
            clean += (r.text[at:start] + "[secret]") if start >= at else ""
            at = max(at, end)
        assert r.clean == clean + r.text[at:]


def test_secrets_of_odd_rows(edge_docs, no_docs):
    rows = S.scanned(edge_docs.drop("spans"), S.train(edge_docs)).collect()
    assert len(rows) == edge_docs.count() and not any(r.spans for r in rows)
    assert S.scanned(no_docs.drop("spans"), S.train(no_docs)).count() == 0
    assert set(S.ratios({})) == {0.0}


# ---- licences --------------------------------------------------------------------------------------


def test_licences_and_inheritance(llm_spark):
    notice = {"MIT": "Released under the MIT License.", "GPL-3.0": "licensed under the GNU General Public License, version 3."}
    rows = [
        ("LICENSE", "Licensed under the Apache License, Version 2.0."),
        ("a/COPYING.txt", notice["GPL-3.0"]),
        ("a/b/c/x.py", "no words on it"),
        ("a/b/c/y.py", f"text before\n{notice['MIT']}\nand after"),
        ("a/licensed.py", None),
        ("z/x.py", ""),
        ("z/x.py", ""),
        (None, "nothing"),
        ("d/LICENSE", "a licence of our own making that no one knows"),
        ("d/x.py", "x"),
        ("e/x.py", "My driving licence expired. " + "word " * 5000),
    ]
    files = llm_spark.createDataFrame(rows, "path string, text string").withColumn("licence_score", F.lit(1))
    got = {(r.path, r.licence, r.origin, r.inherited_from) for r in licences.inventory(files, "path").collect()}
    assert got == {
        ("LICENSE", "Apache-2.0", "file", None),
        ("a/COPYING.txt", "GPL-3.0", "file", None),
        ("a/b/c/x.py", "GPL-3.0", "inherited", "a"),
        ("a/b/c/y.py", "MIT", "header", None),
        ("a/licensed.py", "GPL-3.0", "inherited", "a"),
        ("z/x.py", "Apache-2.0", "inherited", ""),
        (None, "Apache-2.0", "inherited", ""),
        ("d/LICENSE", "Apache-2.0", "inherited", ""),
        ("d/x.py", "Apache-2.0", "inherited", ""),
        ("e/x.py", "Apache-2.0", "inherited", ""),
    }
    assert licences.inventory(files, "path").count() == len(rows)


def plain_licence(text, all_sentences):
    """TF-IDF cosine of each sentence to each template in plain Python."""
    seen, n = Counter(t for s in all_sentences for t in set(licences.tokens(s))), len(all_sentences)
    idf = lambda t, known: np.log((1 + n) / (1 + (seen[t] if known else 0))) + 1
    known = {t for _, x in licences.TEMPLATES for t in licences.tokens(x)}.union(*licences.MARKS.values())
    vector = lambda x: {t: (1 + np.log(f)) * idf(t, t in known) for t, f in Counter(licences.tokens(x)).items()}
    cosine = lambda a, b: sum(w * b.get(t, 0) for t, w in a.items()) / np.sqrt(sum(w * w for w in a.values()) * sum(w * w for w in b.values()))
    best = []
    for s in re.split(licences.SENTENCE, text):
        own = set(licences.tokens(s))
        if not re.search(licences.CUE, s) or not own:
            continue
        scores = {}
        for k, x in licences.TEMPLATES:
            if own >= set(licences.decisive(x)) and licences.marks(own) == licences.marks(set(licences.tokens(x))):
                scores[k] = max(scores.get(k, 0), round(float(cosine(vector(s), vector(x))), 9))
        top = sorted(((-v, k) for k, v in scores.items()))[:2]
        if top and -top[0][0] >= licences.LEAST and (len(top) < 2 or top[1][0] - top[0][0] >= licences.MARGIN):
            best.append((top[0][1] == licences.PROPRIETARY, *top[0]))
    return min(best)[2] if best else None


NOTICES = {
    "SPDX-License-Identifier: GPL-2.0-only": "GPL-2.0", "licensed under the GNU General Public License, version 2": "GPL-2.0",
    "SPDX-License-Identifier: AGPL-3.0-only": "AGPL-3.0", "Licensed under the BSD 2-Clause License.": "BSD-2-Clause",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0", "Licensed under CC BY-NC-ND 4.0": "CC-BY-NC-ND-4.0",
    "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "CC-BY-SA-4.0",
    "Licensed under the ISC License": "ISC", "This work is in the public domain.": "public-domain",
    "licensed under the GNU Lesser General Public License, version 2.1": "LGPL-2.1",
    "The Apache Software License, Version 1.1": "Apache-1.1", "Licensed under the Apache License, Version 2.0": "Apache-2.0",
    "SPDX-License-Identifier: LGPL-3.0-or-later": "LGPL-3.0", "Licensed under CC BY 3.0": None,
    "Redistribution and use in source and binary forms, with or without modification, are permitted": None,
    "Licensed under the Foo License": None, "Copyright 2020 Foo. All rights reserved.": "proprietary",
    "Copyright 2020 Foo. All rights reserved.\nReleased under the MIT License.": "MIT",
    "you can redistribute it under the terms of the GNU General Public License": None,
}


def test_versions_and_variants_of_licences(llm_spark):
    rows = [(f"{i}/x.py", text, "kept", i) for i, text in enumerate(NOTICES)]
    files = llm_spark.createDataFrame(rows, "path string, text string, score string, n int")
    got = licences.inventory(files, "n", "score").collect()
    every = [s for t in NOTICES for s in re.split(licences.SENTENCE, t) if re.search(licences.CUE, s)]
    assert {r.n: r.licence for r in got} == {i: plain_licence(t, every) for i, t in enumerate(NOTICES)}
    assert {list(NOTICES)[r.n]: r.licence for r in got} == NOTICES
    assert {r.given_score for r in got} == {"kept"}


def test_licence_query(llm_spark, no_docs, edge_docs):
    query = QUERIES["op5_tfidf_licences"](llm_spark, MEDIUM)
    texts = {r.doc_id: r.text for r in common.table(llm_spark, MEDIUM, "documents").collect()}
    lines = {
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Released under the MIT License.": "MIT",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    }
    rows = query.collect()
    assert len(rows) == len(texts)
    for r in rows:
        known = {v for k, v in lines.items() if k in texts[r.doc_id]}
        assert not known or r.licence in known and r.origin in ("file", "header")
    assert not re.search("Python|Pandas|Arrow", query._jdf.queryExecution().executedPlan().toString())
    assert licences.inventory(licences.as_files(no_docs), "doc_id").count() == 0
    assert licences.inventory(licences.as_files(edge_docs), "doc_id").count() == edge_docs.count()


# ---- languages ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def models():
    texts = {"en": "the cat and the hat that the man had at hand", "de": "der hut und die hand die der mann hat"}
    counts = {}
    for lang, text in texts.items():
        own = counts.setdefault(lang, {})
        for w in text.split():
            for g in L.grams(w):
                own[g] = own.get(g, 0) + 1
    return L.Models(counts), counts


def test_tables_give_the_interpolated_probabilities(models):
    model, counts = models
    alphabet = len({c for own in counts.values() for g in own for c in g}) + 1
    plain = [L._OneLanguage(counts[lang], L.ORDER, alphabet) for lang in model.languages]
    words = ["the", "hand", "mann", "x", "thehand", "ñandú"]
    got = model.word_scores(words)
    for w, row in zip(words, got):
        want = [-sum(np.log(m.probability(g)) for g in L.grams(w)) for m in plain]
        assert np.allclose(row, want, rtol=1e-4)


def test_probabilities_sum_to_one(models):
    model, counts = models
    letters = sorted({c for own in counts.values() for g in own for c in g})
    plain = L._OneLanguage(counts["en"], L.ORDER, len(letters) + 1)
    for context in ("", "t", "th", "^", "^t", "zz"):
        assert sum(plain.probability(context + c) for c in [*letters, "中"]) == pytest.approx(1, abs=1e-6)


def test_languages_of_held_out_rows(llm_spark):
    docs = common.table(llm_spark, MEDIUM, "documents").select("doc_id", "lang", "text")
    rows = QUERIES["op8_kneser_ney_language"](llm_spark, MEDIUM).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    accepted = [r for r in held if r.accepted]
    assert np.mean([r.lang_pred == r.lang for r in accepted]) > 0.98 and len(accepted) > 0.8 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_rare_strings_and_rows_of_small_languages_are_learned(docs_of):
    rows = [(i, f"the words of the text x number {i}") for i in range(100, 140)]
    one = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 3 != 1][:6]
    for i in one:
        docs = docs_of(rows + [(i, "jeder wagt zu springen")])
        docs = docs.withColumn("lang", F.when(F.col("doc_id") == i, "de").otherwise("en"))
        model = L.train(docs)
        assert model.languages == ["de", "en"]
    own = Counter(g for w in L.words("jeder wagt zu springen") for g in L.grams(w))
    texts = [r.text for r in L._sample(docs).where("lang = 'en' and slice <> 0").collect()]
    other = Counter(g for t in texts for w in L.words(t) for g in L.grams(w))
    want = L.Models({"de": own, "en": other}).word_scores(["jeder", "springen", "number"])
    assert np.allclose(model.word_scores(["jeder", "springen", "number"]), want)


def test_languages_of_odd_rows(edge_docs, no_docs, docs_of):
    known = docs_of([(100 + i, f"the words of the text x number {i}") for i in range(40)])
    rows = {r.doc_id: r for r in L.predicted(edge_docs, L.train(known), "doc_id").collect()}
    assert {rows[i].lang_pred for i in (0, 1, 2)} == {"und"} and {rows[i].score for i in (0, 1, 2)} == {0.0}
    assert rows[5].lang_pred == "en" and rows[5].score == 1.0
    assert L.train(no_docs) is None
    nothing = L.predicted(edge_docs, None, "doc_id").collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_only_letters_make_words():
    assert L.words("½ ² Ⅷ ٣ _ 12") == []
    assert L.words("x²y Ⅷtes straße ß1é") == ["x", "y", "tes", "straße", "ß", "é"]
    assert L.words("ªb Ǆ 語") == ["ªb", "ǆ", "語"]
