"""Near copies by five-word shingles: one document of each group of texts with a similarity of 0.8 or more.

Two texts are linked if the Jaccard similarity of their sets of distinct shingles is at least 0.8, checked
exactly on the sets. Candidates for that check come from buckets:

* components of SimHash fingerprints at most two bits apart, found by ``simhash`` with vantage-point trees. Texts
  at a similarity of 0.8 differ in 3 to 11 bits, where such trees rule out almost nothing, so there are also
* bands of ``ROWS`` minimal hashes. Of pairs at exactly 0.8 some 0.99998 share one of ``BANDS`` bands, of more similar ones more.

Texts with the same set of shingles form a class, and only classes go on. All classes of a bucket are
compared with the first one, then with the first few that are not similar to it, and so on until each is
a leader or similar to one. After each such round the links are joined to groups, and texts of one group are
not compared any more, so a large group of near copies costs a few comparisons a text, not its square. The
sizes and 1 024 bits of each set are looked at first: they tell of almost all pairs of
texts of some hundred words that they differ too much, so texts that are similar to none, in a bucket of many, make no
rows either. Neither the pairs of a bucket nor its members are ever gathered. Two texts that stay and share a
bucket are different: their sets, sizes or bits were compared. Groups that hang together only by links between texts
of which neither leads in any bucket stay two groups.

Defined cases: a null text is an empty one, and texts without a word are equal; a text of fewer than five
words is one shingle; a null id comes after all others; equal rows are one text; an empty table stays empty; extra columns
are kept unless their name starts with an underscore.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm import common, simhash
from webloom.llm.components import connected

SHINGLE = 5
SIMILAR = (8, 10)  # as a fraction, so that the check is exact
BANDS = 36
ROWS = 6
WORDS = 16  # of 64 bits, for the bound on the shingles that only one of two sets has
_AT_ONCE = 1 << 12

_rng = np.random.default_rng(11)
_FACTOR = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_SHIFT = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


def bands(shingles: np.ndarray) -> list[int]:
    """A number for each band of the minimal hashes of a set; none for an empty set."""
    if not len(shingles):
        return []
    small = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    low = (shingles ^ shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(low), _AT_ONCE):
        hashed = low[i : i + _AT_ONCE, None] * _FACTOR + _SHIFT
        np.minimum(small, (hashed ^ hashed >> np.uint32(15)).min(0), out=small)
    rows = small.reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(r.tobytes(), k) - (1 << 63) for k, r in enumerate(rows)]


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, _mark, k1, k2, fp, n, bands): the set's own 128 bits, fingerprint, size and bands of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = []
            for text in batch.column(2).to_pylist():
                hashes = simhash.shingle_hashes(text, SHINGLE)
                distinct = np.unique(hashes)
                key = np.frombuffer(xxhash.xxh3_128_digest(distinct.tobytes()), "<i8").tolist()
                own.append((*key, simhash.fingerprint_of(hashes), len(distinct), bands(distinct)))
            columns = list(zip(*own)) if own else [()] * 5
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())]
            made = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *made], names=["doc_id", "_mark", "k1", "k2", "fp", "n", "bands"])

    rows = docs.select("doc_id", "_mark", F.col("text").cast("binary").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, _mark bigint, k1 bigint, k2 bigint, fp bigint, n bigint, bands array<bigint>")


def _sets(rows: DataFrame) -> DataFrame:
    """(c, n, shingles, odd) of rows (c, text): the set, its size, and bits for a bound on how far sets are apart.

    A shingle turns one of ``64 * WORDS`` bits. Bits that differ between two sets stem from shingles that are in one
    of them only, so there are at least as many such shingles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.unique(simhash.shingle_hashes(t, SHINGLE)) for t in batch.column(1).to_pylist()]
            at = [(s % np.uint64(64 * WORDS)).astype(np.int64) for s in own]
            odd = [np.packbits(np.bincount(a, minlength=64 * WORDS) % 2 == 1).view("<i8") for a in at]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(map(len, own), pa.int64()),
                    pa.array([s.view(np.int64) for s in own], pa.list_(pa.int64())),
                    pa.array(odd, pa.list_(pa.int64())),
                ],
                names=["c", "n", "shingles", "odd"],
            )

    texts = rows.select("c", F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "c bigint, n bigint, shingles array<bigint>, odd array<bigint>")


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) and whether they are ``similar``."""
    ends = pairs.select(F.col("u").alias("c")).unionByName(pairs.select(F.col("v").alias("c")))
    needed = common.may_hold(sets, ends, "c").where("_may")
    of = lambda key, name: needed.select(F.col("c").alias(key), F.col("shingles").alias(name))
    both = pairs.join(of("v", "a"), "v").join(of("u", "b"), "u")
    shared = F.size(F.array_intersect("a", "b"))
    counted = both.select("u", "v", shared.alias("shared"), (F.size("a") + F.size("b") - shared).alias("union"))
    return counted.select("u", "v", (SIMILAR[1] * F.col("shared") >= SIMILAR[0] * F.col("union")).alias("similar"))


def _contracted(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (c, root) after the links (u, v) between its classes."""
    of = lambda key: roots.select(F.col("c").alias(key), F.col("root").alias(f"{key}_root"))
    between = links.join(of("u"), "u").join(of("v"), "v").select(F.col("u_root").alias("u"), F.col("v_root").alias("v"))
    groups = connected(between).select("node", F.col("root").alias("now"))
    moved = roots.join(groups, F.col("root") == F.col("node"), "left")
    return common.stored(moved.select("c", F.coalesce("now", "root").alias("root")), "roots")


def _may_be_similar() -> Column:
    """False only for a class (n, odd) and a leader (m, its) that are not similar, by two bounds on what one has alone."""
    bits = [F.bit_count(F.col("odd")[i].bitwiseXOR(F.col("its")[i])) for i in range(WORDS)]
    apart = F.greatest(F.abs(F.col("n") - F.col("m")), sum(bits[1:], bits[0]))
    # shared >= s * union, where shared = (n + m - apart) / 2 and union = (n + m + apart) / 2
    return (SIMILAR[1] + SIMILAR[0]) * apart <= (SIMILAR[1] - SIMILAR[0]) * (F.col("n") + F.col("m"))


def linked_roots(sets: DataFrame, members: DataFrame) -> DataFrame:
    """(c, root) of the classes in ``members``, rows (band, value, c) of buckets of two or more.

    A round takes some leaders of each bucket, the first classes that are neither leaders nor similar to one, and
    compares them with the classes of the bucket. The number of leaders grows by rounds, so there are few rounds
    also where many texts of a bucket differ. Left out are only pairs whose answer is known: both are of one
    group already, or their sizes or the bits of their shingles show more shingles that only one of them has than
    similar texts may have. A bucket of one group is done.
    """
    roots = common.stored(members.select("c").distinct().withColumn("root", F.col("c")), "roots")
    now = members.withColumns({"root": F.col("c"), "free": F.lit(True)})
    known = sets.select("c", "n", "odd")
    checked: list[DataFrame] = []
    most = 1
    bucket = ["band", "value"]
    first = Window.partitionBy(*bucket).orderBy("c")
    while True:
        # stored, so that both sides of each join are plain exchanges that can be split at a hot bucket
        leaders = now.where("free").withColumn("k", F.row_number().over(first)).where(F.col("k") <= most)
        own = [F.col("n").alias("m"), F.col("odd").alias("its")] if checked else []
        leaders = leaders.select(*bucket, F.col("c").alias("leader"), F.col("root").alias("of"), *own)
        leaders = common.stored(leaders, "leaders")
        if leaders.isEmpty():
            return roots
        # in the first round there is one leader, so there is no more than a row for each member
        met = now.join(leaders, bucket).where(F.col("root") != F.col("of")).where(_may_be_similar() if checked else F.lit(True))
        met = met.select(*bucket, "c", F.greatest("c", "leader").alias("u"), F.least("c", "leader").alias("v"))
        met = common.stored(met, "met")
        pairs = met.select("u", "v").distinct()
        if checked:
            pairs = pairs.join(reduce(DataFrame.unionByName, checked).select("u", "v"), ["u", "v"], "left_anti")
        else:
            of_u, of_v = known.toDF("u", "n", "odd"), known.toDF("v", "m", "its")
            pairs = pairs.join(of_u, "u").join(of_v, "v").where(_may_be_similar()).select("u", "v")
        checked.append(common.stored(_measured(common.stored(pairs, "pairs"), sets), "measured"))
        links = checked[-1].where("similar").select("u", "v")
        if not links.isEmpty():
            roots = _contracted(roots, links)
        similar = reduce(DataFrame.unionByName, checked).where("similar").select("u", "v")
        told = met.join(similar, ["u", "v"]).select(*bucket, "c")
        told = told.unionByName(leaders.select(*bucket, F.col("leader").alias("c"))).distinct().withColumn("told", F.lit(True))
        left = now.drop("root").join(told, [*bucket, "c"], "left").join(roots, "c")
        left = left.withColumn("free", F.col("free") & F.col("told").isNull()).drop("told")
        left = common.stored(left, "members")
        mixed = left.groupBy(*bucket).agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
        now = left.join(mixed.select(*bucket), bucket)
        if len(checked) == 1:
            now = now.join(known, "c")
        now = common.stored(now, "members")
        most *= 4


def grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, _mark, root) for rows (doc_id, _mark, text): ``root`` names the group of near copies."""
    rows = common.stored(sketched(docs), "sketches")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("_mark").alias("m"))
    distinct = rows.groupBy("k1", "k2").agg(
        F.min(order).alias("rep"), F.min("fp").alias("fp"), F.min("n").alias("n"), F.min("bands").alias("bands")
    )
    # numbered in the order of their first rows, so the smallest number of a group is its first row
    classes = common.stored(distinct.orderBy("rep").withColumn("c", F.monotonically_increasing_id()), "classes")
    components = simhash.components(classes.select("fp"))
    by_band = classes.select(F.posexplode("bands").alias("band", "value"), "c")
    by_print = classes.join(components, "fp").select(F.lit(-1).alias("band"), F.col("root").alias("value"), "c")
    buckets = by_band.unionByName(common.stored(by_print, "prints"))
    shared = common.stored(
        buckets.groupBy("band", "value").agg(F.count("*").alias("size")).where("size > 1").drop("size"), "shared"
    )
    maybe = common.may_hold(buckets, shared, "band", "value").where("_may")
    members = common.stored(maybe.join(shared, ["band", "value"]).select("band", "value", "c"), "members")
    involved = members.select("c").distinct()
    reps = common.stored(
        classes.join(involved, "c").select("c", F.col("rep.i").alias("_i"), F.col("rep.m").alias("_m")), "reps"
    )
    maybe = common.may_hold(docs, reps.select(F.col("_i").alias("doc_id"), F.col("_m").alias("_mark")), "doc_id", "_mark")
    texts = maybe.where("_may").join(reps, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("_mark") == F.col("_m")))
    # equal rows have equal texts: one of each class is enough
    once = texts.groupBy("c").agg(F.min("text").alias("text"))
    sets = common.stored(_sets(once), "sets")
    groups = linked_roots(sets, members)
    named = classes.join(groups, "c", "left").select("k1", "k2", F.coalesce("root", "c").alias("root"))
    roots = common.stored(named, "roots")
    return rows.join(roots, ["k1", "k2"]).select("doc_id", "_mark", "root")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and others) with one row of every group: the one with the smallest id."""
    slim = docs.withColumn("_mark", F.xxhash64("text"))
    return simhash.first_rows(slim, grouped(slim)).select(*docs.columns)
