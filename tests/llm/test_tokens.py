"""Token ids, the grammar shards and the packing."""

import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tests.llm.conftest import EDGE_TEXTS
from webloom.llm import binary_output as O, common, grammar, packing, tokens

BYTES, WORDS = common.tokenizer_path("byte_bpe_50k.json"), common.tokenizer_path("word_bpe_49k.json")
ODD = [
    "  a", "a   b  \n c ", "x\n\n y\tz", "a\x1cb \x1c c", " ́ é", "İ ΣΑΣ ς Ⅷa ß ﬁ", "don't 's  'S",
    "<|endoftext|> a", " " * 50 + "x", "word.\nNext,\nthird", "no-break space \u0085 y", "1.5 a1 2b",
]


whole_tokenizer = cache(Tokenizer.from_file)


def plain(path, text, end):
    return whole_tokenizer(path).encode(text or "", add_special_tokens=False).ids + [end]


@pytest.mark.parametrize("path, spaced", [(BYTES, True), (WORDS, False)])
def test_chunks_give_the_ids_of_the_whole_text(path, spaced):
    encoder, whole = tokens.encoder(path, spaced), Tokenizer.from_file(path)

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet="aB.é ,'\n\t1́ǅ中<|>", max_size=40))
    def same(text):
        want = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want

    same()
    for text in ODD + [t or "" for t in EDGE_TEXTS]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path, spaced", [(BYTES, True), (WORDS, False)])
def test_every_letter_that_takes_the_short_cut(path, spaced):
    encoder, whole = tokens.encoder(path, spaced), Tokenizer.from_file(path)
    for c in filter(str.isalpha, map(chr, range(0x250))):
        for text in (c, f"a{c}b {c}{c} x{c}."):
            want = whole.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want, hex(ord(c))


def test_a_full_chunk_table_changes_nothing(monkeypatch):
    encoder = tokens.TextEncoder(WORDS, False)
    text = "a few words and a few more words, twice: a few words"
    want = encoder.encode(text)
    monkeypatch.setattr(tokens, "CHUNKS_KEPT", 2)
    assert tokens.TextEncoder(WORDS, False).encode(text) == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), max_size=60), max_size=8))
def test_grammar_round_trip(docs):
    flat = np.array([i for d in docs for i in d], np.uint32)
    blob = grammar.compress(flat, np.array([len(d) for d in docs], np.int64), 5, least=2)
    shard = grammar.Shard.read(blob)
    for k, d in enumerate(docs):
        assert shard.document(k).tolist() == d
        for a in range(0, len(d) + 1, 7):
            for b in (a, a + 1, len(d)):
                if a <= b <= len(d):
                    assert shard.part(k, a, b).tolist() == d[a:b]


def recounted(docs, known, least, share):
    """Rules and symbols of the documents with all pairs counted anew in every round."""
    docs, rules = [list(d) for d in docs], []
    while True:
        counts = Counter(p for d in docs for p in zip(d, d[1:]))
        most = max(counts.values(), default=0)
        chosen = sorted(p for p, n in counts.items() if n >= max(least, most / share))
        if not chosen:
            return rules, docs
        names = {p: known + len(rules) + k for k, p in enumerate(chosen)}
        rules += chosen
        for d in docs:
            k = 0
            while k < len(d) - 1:
                if (d[k], d[k + 1]) in names:
                    d[k : k + 2] = [names[d[k], d[k + 1]]]
                k += 1


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 3), max_size=80), max_size=6), st.integers(2, 4), st.sampled_from([1, 2, 64])
)
def test_grammar_is_that_of_a_full_recount(docs, least, share):
    flat = np.array([i for d in docs for i in d], np.uint32)
    made = grammar.Shard.read(grammar.compress(flat, np.array([len(d) for d in docs], np.int64), 4, least, share))
    rules, left = recounted(docs, 4, least, share)
    assert [tuple(r) for r in made.rules.tolist()] == rules
    assert made.symbols.tolist() == [i for d in left for i in d]


@pytest.mark.parametrize("bits", [1, 3])
def test_keys_that_share_a_bucket(monkeypatch, bits):
    monkeypatch.setattr(grammar, "_BUCKETS", bits)
    docs = [[int(i) for i in np.random.default_rng(n).integers(0, 6, 300)] for n in range(5)]
    flat, sizes = np.array(sum(docs, []), np.uint32), np.full(5, 300, np.int64)
    made = grammar.Shard.read(grammar.compress(flat, sizes, 6, 3))
    rules, left = recounted(docs, 6, 3, grammar.SHARE)
    assert [tuple(r) for r in made.rules.tolist()] == rules
    assert made.symbols.tolist() == sum(left, [])


def test_grammar_makes_repeats_small():
    flat = np.tile(np.arange(16, dtype=np.uint32), 1000)
    shard = grammar.Shard.read(grammar.compress(flat, np.array([len(flat)]), 50_000))
    assert len(shard.symbols) < len(flat) / 10 and shard.lengths.max() >= 16
    with pytest.raises(ValueError):
        grammar.Shard.read(b"other")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=60), max_size=6), st.sampled_from([1, 4, 64]))
def test_no_frequent_pair_is_left(docs, share):
    flat = np.array([i for d in docs for i in d], np.uint32)
    shard = grammar.Shard.read(grammar.compress(flat, np.array([len(d) for d in docs], np.int64), 4, 3, share))
    assert [shard.document(i).tolist() for i in range(len(docs))] == docs
    pairs = defaultdict(int)
    for i in range(len(docs)):
        own = shard.symbols[shard.symbol_start[i] : shard.symbol_start[i + 1]].tolist()
        for pair in zip(own, own[1:]):
            pairs[pair] += 1
    assert max(pairs.values(), default=0) < 3


def test_equal_rows_are_dealt_to_all_tasks(docs_of):
    rows = [(i, f"text {i}") for i in range(2000)] + [(700, "the same row again")] * 1000
    made = O.blocks(docs_of(rows), common.tokenizer_path("word_bpe_49k.json"), False).cache()
    parts = [r.n for r in made.selectExpr("size(doc_id) AS n").collect()]  # each part is one block here
    assert sum(parts) == 3000 and len(parts) > 1 and max(parts) <= 2 * sorted(parts)[len(parts) // 2]
    starts = sorted((r.start, r.n_tokens) for r in O.placed(made).collect())
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_shards_hold_documents_in_id_order(llm_spark, monkeypatch):
    monkeypatch.setattr(O, "IDS_PER_BLOCK", 3000)
    docs = common.table(llm_spark, SMALL, "documents")
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in O.op7_repair_ids(llm_spark, SMALL).collect()}
    start = 0
    for r in docs.orderBy("doc_id").collect():
        ids = plain(WORDS, r.text, 2)
        assert got[r.doc_id] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == docs.count()


def test_shards_of_odd_rows(edge_docs, no_docs, tmp_path, llm_spark):
    O.write(edge_docs, str(tmp_path / "s"), WORDS, False)
    rows = O.placed(O.read(llm_spark, str(tmp_path / "s"))).collect()
    want = sorted(str(plain(WORDS, r.text, 2)) for r in edge_docs.collect())
    assert sorted(str(np.frombuffer(r.ids, "<u4").tolist()) for r in rows) == want
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i))
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]
    assert O.blocks(no_docs, WORDS, False).count() == 0


def check_pieces(pieces, docs, window, slack):
    """Every id of every document in exactly one piece, sequences gapless, little padding."""
    of, at = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length and zlib.crc32(p.ids) == p.ids_crc32
        of[p.doc_id].append((p.start, ids, p.doc_tokens))
        at[p.sequence_id].append((p.offset, p.length))
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(plain(BYTES, r.text, 0))
    for doc_id, own in texts.items():
        got = sorted(i for _, ids, _ in of.pop(doc_id) for i in ids)
        assert got == sorted(i for ids in own for i in ids)
    assert not of
    short = 0
    for own in at.values():
        own.sort()
        ends = [0]
        for offset, length in own:
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= window
        short += ends[-1] < window - slack
    assert short <= 1  # only the last sequence


@pytest.mark.parametrize("window", [64, 1024])
def test_packing_sample(llm_spark, window):
    docs = common.table(llm_spark, SMALL, "documents")
    check_pieces(packing.packed(docs, BYTES, True, window).collect(), docs, window, window // 128)


def test_packing_odd_rows(edge_docs, no_docs, docs_of):
    check_pieces(packing.packed(edge_docs, BYTES, True, 64).collect(), edge_docs, 64, 0)
    assert packing.packed(no_docs, BYTES, True).count() == 0
    hot = docs_of([(i, "the same words " * 15) for i in range(60)])  # one length that pairs with none
    check_pieces(packing.packed(hot, BYTES, True, 64).collect(), hot, 64, 0)


def test_least_squares_meets_its_conditions():
    rng = np.random.default_rng(3)
    columns = packing.recipes(32)
    assert (columns.sum(1) == 32).all()
    histogram = rng.integers(0, 50, 32).astype(float)
    histogram[0] = 0
    x = packing.non_negative_least_squares(histogram, columns)
    a = np.zeros((32, len(columns)))
    for k, c in enumerate(columns):
        for n in c[c > 0]:
            a[n, k] += 1
    gradient = a.T @ (a @ x - histogram)
    assert (x >= 0).all() and gradient.min() > -1.0 and np.abs(gradient[x > 1e-6]).max() < 1.0
    chosen, left = packing.plan(histogram.astype(int), 32, 0)
    used = np.zeros(32, int)
    for lengths, times in chosen:
        assert sum(lengths) == 32 and times > 0
        for n in lengths:
            used[n] += times
    assert (used + left == histogram).all() and left.min() >= 0


def test_padding_rule():
    assert [packing.padded_length(n) for n in (1, 3, 512, 513, 1024)] == [1, 1024, 512, 1024, 1024]
