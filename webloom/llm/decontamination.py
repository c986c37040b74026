"""Benchmark decontamination: a BM25 index of the test items, asked by every training passage.

The test items are the indexed side. An item counts as leaked where a passage holds at least
``OVERLAP`` of its five-word shingles, and at least ``PART_OVERLAP`` of the words of its question
and of its answer (its last sentence; an item of one sentence has no answer to look for). To get
there without comparing every passage with every item:

1. Passages are windows of whole texts, twice as long as the longest item and half overlapping, so
   whatever repeats an item lies within one. Its distinct words are a BM25 query.
2. An item's threshold is what is left of its own BM25 score without the rarest words that a
   passage with enough shingles may lack. So no leak is below its threshold. Scores are kept as
   multiples of it, which makes the threshold 1 for all items.
3. Postings are cut into blocks of items that are alike, and a word has its highest score in each.
   Summed over the words of a passage these bound the score of every item of a block, and blocks
   that cannot reach 1 are skipped, for all passages of a text at once. Within the other blocks
   WAND goes from pivot to pivot over the postings and skips items that cannot reach 1.

An index shard holds about INDEX_WORDS words of distinct items. Tasks build the shards and write them to
the shared folder; one shard at a time is broadcast, asked by all documents and given up again, and
only its leaks are kept, so memory does not grow with the benchmark. Defined cases: null texts are
empty ones; items with fewer than five words have no shingle and match nothing; repeated items are
indexed once, but each of them and of the documents counts; a null item id is kept; an empty table on
either side gives no leak; columns of the documents are kept, whatever they are called.
"""

from __future__ import annotations

import math
import pickle
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import groupby, repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from webloom.llm import common
from webloom.session import checkpoint_dir

SHINGLE = 5
OVERLAP = 0.8
PART_OVERLAP = 0.5
LEAST_STRIDE = 64
K1, B = 1.2, 0.75
BLOCK = 8
INDEX_WORDS = 500_000

_WORD = re.compile(r"\w+")
_SENTENCE_END = re.compile(r"[.?!]\s+(?=\S)")

LEAKS = (
    "array<struct<item_id:bigint,score:double,overlap:double,question_overlap:double,"
    "answer_overlap:double,first_word:int>>"
)


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The words of all sentences but the last, and of the last; no answer if there is only one."""
    ends = [m.end() for m in _SENTENCE_END.finditer(text)]
    if not ends:
        return words(text), []
    return words(text[: ends[-1]]), words(text[ends[-1] :])


def shingles(ids: list) -> set[tuple]:
    return set(zip(*(ids[i:] for i in range(SHINGLE))))


class Index:
    """The items of one shard; ``copies`` tells how often each stands in the benchmark."""

    def __init__(self, items: list[tuple[int | None, str | None]], copies: list[int] | None = None):
        parts = [
            (i, *question_and_answer(t or ""), n) for (i, t), n in zip(items, copies or repeat(1))
        ]
        parts = [x for x in parts if len(x[1]) + len(x[2]) >= SHINGLE]
        self.vocabulary: dict[str, int] = {}
        # alike: items that share the words of most items stand together, as those of one language do
        common_words = Counter(w for _, q, a, _ in parts for w in set(q + a))
        parts.sort(key=lambda x: sorted(((-common_words[w], w) for w in {*x[1], *x[2]}))[:3])
        self.items, self.copies = [], [x[3] for x in parts]
        for i, q, a, _ in parts:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in q + a]
            self.items.append((i, shingles(ids), set(ids[: len(q)]), set(ids[len(q) :]), ids))
        sizes = [len(x[4]) for x in self.items]
        self.stride = max([LEAST_STRIDE, *sizes])
        mean = sum(sizes) / max(1, len(sizes))
        seen = Counter(t for x in self.items for t in set(x[4]))
        n = len(self.items)
        lists: list[list[tuple[int, float]]] = [[] for _ in self.vocabulary]
        for k, (_, grams, _, _, ids) in enumerate(self.items):
            norm = K1 * (1 - B + B * len(ids) / mean)
            own = {
                t: math.log(1 + (n - seen[t] + 0.5) / (seen[t] + 0.5)) * f * (K1 + 1) / (f + norm)
                for t, f in Counter(ids).items()
            }
            # with so many shingles missing, at most as many places of the item are not covered
            lacking = math.floor((1 - OVERLAP) * len(grams) + 1e-9)
            if len(grams) < len(ids) - SHINGLE + 1:  # repeated shingles: one may stand for many places
                lacking = len(own)
            ranked = sorted(own.values(), reverse=True)
            threshold = max(sum(ranked[lacking:]), ranked[-1]) * (1 - 1e-9)
            for t, s in own.items():
                lists[t].append((k, s / threshold))
        # the part of the postings of term t in block b is a run; term t has runs first[t] : first[t + 1]
        self.blocks = -(-n // BLOCK)
        self.runs = [[(b, list(own)) for b, own in groupby(p, key=lambda x: x[0] // BLOCK)] for p in lists]
        self.first = np.concatenate([[0], np.cumsum([len(r) for r in self.runs], dtype=np.int64)])
        self.run_block = np.array([b for r in self.runs for b, _ in r], dtype=np.int64)
        self.run_most = np.array([max(s for _, s in own) for r in self.runs for _, own in r])

    def open_blocks(self, ids: np.ndarray, windows: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """(window, block, distinct terms of the window) wherever an item of the block may reach 1."""
        at = np.flatnonzero(ids >= 0)
        n, step = len(self.first) - 1, at // self.stride
        # window w covers steps w and w + 1
        keys = np.concatenate([step * n, (step - 1) * n]) + np.tile(ids[at], 2)
        keys = np.unique(keys[(keys >= 0) & (keys < windows * n)])
        window, term = keys // n, keys % n
        size = self.first[term + 1] - self.first[term]
        inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        run = np.repeat(self.first[term], size) + inner
        place = np.repeat(window, size) * self.blocks + self.run_block[run]
        bound = np.bincount(place, self.run_most[run], windows * self.blocks)
        border = np.searchsorted(window, np.arange(windows + 1))
        for k in np.flatnonzero(bound >= 1 - 1e-9):
            w, b = divmod(int(k), self.blocks)
            yield w, b, term[border[w] : border[w + 1]]

    def retrieve(self, block: int, terms: np.ndarray) -> list[tuple[int, float]]:
        """(item, score) of all items of a block that reach 1: WAND."""
        lists = [own for t in terms.tolist() for b, own in self.runs[t] if b == block]
        most = [max(s for _, s in own) for own in lists]
        at = [0] * len(lists)
        live = list(range(len(lists)))
        found = []
        while live:
            live.sort(key=lambda j: lists[j][at[j]])
            bound, pivot = 0.0, -1
            for n, j in enumerate(live):
                bound += most[j]
                if bound >= 1:
                    pivot = n
                    break
            if pivot < 0:
                break
            item = lists[live[pivot]][at[live[pivot]]][0]
            target = item
            if lists[live[0]][at[live[0]]][0] == item:
                score = 0.0
                for j in live:
                    if lists[j][at[j]][0] != item:
                        break
                    score += lists[j][at[j]][1]
                if score >= 1:
                    found.append((item, score))
                target = item + 1
            for j in live:
                if lists[j][at[j]][0] >= target:
                    break
                while at[j] < len(lists[j]) and lists[j][at[j]][0] < target:
                    at[j] += 1
            live = [j for j in live if at[j] < len(lists[j])]
        return found

    def leaks(self, text: str | None) -> list[dict]:
        """Items that a text leaks, each with its best passage."""
        own = words(text)
        if not own or not self.items:
            return []
        ids = np.fromiter(map(self.vocabulary.get, own, repeat(-1)), np.int64, len(own))
        windows = max(1, -(-len(own) // self.stride) - 1)
        best: dict[int, dict] = {}
        grams: dict[int, set] = {}
        for w, block, terms in self.open_blocks(ids, windows):
            for k, score in self.retrieve(block, terms):
                s = w * self.stride
                if w not in grams:
                    grams = {w: shingles(ids[s : s + 2 * self.stride].tolist())}
                there = set(terms.tolist())
                item_id, wanted, question, answer, _ = self.items[k]
                overlap = len(wanted & grams[w]) / len(wanted)
                parts = [len(p & there) / len(p) if p else 1.0 for p in (question, answer)]
                if overlap >= OVERLAP - 1e-9 and min(parts) >= PART_OVERLAP:
                    if k not in best or overlap > best[k]["overlap"]:
                        best[k] = {
                            "item_id": item_id,
                            "score": score,
                            "overlap": overlap,
                            "question_overlap": parts[0],
                            "answer_overlap": parts[1],
                            "first_word": s,
                        }
        return [best[k] for k in sorted(best) for _ in range(self.copies[k])]


def index_shards(benchmark: DataFrame) -> tuple[DataFrame, int]:
    """The pickled indexes, built in tasks and stored: shard, index; and the number of shards."""
    items = (
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        .where("text is not null")
        .groupBy("item_id", "text")
        .count()
    )
    size = items.agg(F.sum(F.size(F.split("text", r"\W+")))).first()[0] or 0
    shards = -(-size // INDEX_WORDS)

    def build(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        index = Index([(r["item_id"], r["text"]) for r in rows], [r["count"] for r in rows])
        return pa.table({"shard": pa.array([rows[0]["shard"]], pa.int64()), "index": [pickle.dumps(index)]})

    built = (
        items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, shards))))
        .groupBy("shard")
        .applyInArrow(build, "shard bigint, index binary")
    )
    return common.stored(built, "benchmark-index"), shards


_OPEN: dict[str, Index] = {}


def opened(name: str, sent: Broadcast) -> Index:
    """The index of a shard in this Python worker; opening one closes the one before."""
    if name not in _OPEN:
        _OPEN.clear()
        _OPEN[name] = pickle.loads(sent.value)
    return _OPEN[name]


_LEAKS_ARROW = pa.list_(
    pa.struct(
        [
            ("item_id", pa.int64()),
            *((c, pa.float64()) for c in ("score", "overlap", "question_overlap", "answer_overlap")),
            ("first_word", pa.int32()),
        ]
    )
)


def _asked(rows: DataFrame, sent: Broadcast, all_rows: bool) -> DataFrame:
    """Columns key and leaks from key and text, for all rows or for those with leaks."""
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = opened(name, sent)
        for batch in batches:
            found = pa.array(map(index.leaks, batch.column(1).to_pylist()), _LEAKS_ARROW)
            out = pa.RecordBatch.from_arrays([batch.column(0), found], names=["key", "leaks"])
            yield out if all_rows else out.filter(pa.array([len(x) > 0 for x in found]))

    schema = StructType([rows.schema["key"], *StructType.fromDDL(f"leaks {LEAKS}").fields])
    return rows.select("key", "text").mapInArrow(run, schema)


def with_leaks(docs: DataFrame, benchmark: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` with ``leaks``: the leaked items of each document, an empty array if none."""
    spark, none = docs.sparkSession, F.array().cast(LEAKS)
    kept = F.struct(*(F.col(f"`{c}`") for c in keep))
    rows = docs.select(kept.alias("key"), F.col("text").cast("string").alias("text"))
    released = [F.col(f"key.`{c}`") for c in keep]
    shards, n = index_shards(benchmark)

    def send(shard: int) -> Broadcast:
        blob = shards.where(F.col("shard") == shard).select("index").first()
        return spark.sparkContext.broadcast(bytes(blob[0]) if blob else pickle.dumps(Index([])))

    if n == 0:
        return rows.select(*released, none.alias("leaks"))
    if n == 1:
        return _asked(rows, send(0), all_rows=True).select(*released, "leaks")
    # the leaks of every shard are written before the next one is sent
    rows = common.stored(
        rows.select(F.col("key").alias("kept"), "text", F.monotonically_increasing_id().alias("key")),
        "decontamination-documents",
    )
    path = f"{checkpoint_dir(spark)}/webloom-leaks-{uuid.uuid4().hex}"
    for shard in range(n):
        sent = send(shard)
        _asked(rows, sent, all_rows=False).withColumn("shard", F.lit(shard)).write.mode("append").parquet(path)
        sent.destroy()
    found = spark.read.schema(f"key bigint, leaks {LEAKS}, shard int").parquet(path)
    found = found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("shard", "leaks"))).alias("by_shard"))
    found = found.select("key", F.flatten(F.transform("by_shard", lambda x: x["leaks"])).alias("found"))
    joined = rows.select("key", "kept").join(found, "key", "left")
    return joined.select(*(F.col(f"kept.`{c}`") for c in keep), F.coalesce("found", none).alias("leaks"))


def op1_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for every document and item that it leaks."""
    docs = common.table(spark, sf_dir, "documents")
    found = with_leaks(docs, common.table(spark, sf_dir, "benchmark"), "doc_id")
    return found.select("doc_id", F.inline("leaks"))
