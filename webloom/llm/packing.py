"""Packing documents into training windows by non-negative least squares over lengths.

1. Every document, closed by an end id, is cut into whole windows and one rest shorter than a
   window. A whole window is a sequence of its own.
2. The rests are counted by length: a histogram of at most ``window - 1`` numbers, whatever the
   size of the corpus. Recipes are the combinations of two or three lengths that fill a window
   exactly. Non-negative least squares finds how often to use each so that together they use up
   the histogram; the counts are rounded down and never exceed what is there.
3. What is left is packed greedily, longest first, still by counts of lengths, as long as a
   window is filled but for ``slack`` ids. The remaining rests are laid end to end and cut at
   window borders, so that only the last sequence of all has more padding than that.

Which rest gets which place follows from its rank among the rests of its length, and the rank
from counts per task, so no task sees more than its own pieces and the driver sees the histogram
only. Defined cases: null text is empty (one sequence piece holding the end id); repeated rows
and null ids are documents of their own; an empty table gives no piece; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webloom.llm import common, tokens

WINDOW = 1024
END_ID = 0
# Lengths of the shorter parts of a recipe of three are multiples of this.
TRIPLE_STEP = 16
SWEEPS = 30


def recipes(window: int) -> np.ndarray:
    """All pairs, and the triples on a grid, that sum to the window; pairs have a 0 in third place."""
    pairs = [(window - a, a, 0) for a in range(1, window // 2 + 1)]
    grid = range(TRIPLE_STEP, window // 2 + 1, TRIPLE_STEP)
    triples = [
        (window - a - b, a, b) for b in grid for a in grid if b <= a <= window - a - b
    ]
    return np.array(pairs + triples, dtype=np.int64)


def non_negative_least_squares(histogram: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """x >= 0 minimising |A x - histogram|, A having a one for each part of a recipe.

    Coordinate descent: with the other counts fixed the best count of one recipe is a quotient,
    and each step reads two or three residuals.
    """
    x = np.zeros(len(columns))
    rest = histogram.astype(float).copy()
    parts = []
    for c in columns:
        lengths, times = np.unique(c[c > 0], return_counts=True)
        parts.append((lengths.tolist(), times.tolist(), float((times**2).sum())))
    left = rest.tolist()
    for _ in range(SWEEPS):
        moved = 0.0
        for k, (lengths, times, norm) in enumerate(parts):
            step = sum(t * left[n] for n, t in zip(lengths, times)) / norm
            step = max(step, -x[k])
            if step:
                x[k] += step
                for n, t in zip(lengths, times):
                    left[n] -= step * t
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return x


def plan(histogram: np.ndarray, window: int, slack: int) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """(lengths, repeats) of all recipes used, and how many rests of each length are left over."""
    left = histogram.astype(np.int64).copy()
    chosen: list[tuple[tuple[int, ...], int]] = []

    def use(lengths: tuple[int, ...], times: int) -> None:
        chosen.append((lengths, times))
        for n in lengths:
            left[n] -= times

    def possible(lengths: tuple[int, ...]) -> int:
        kinds, need = np.unique(lengths, return_counts=True)
        return int((left[kinds] // need).min())

    columns = recipes(window)
    counts = np.floor(non_negative_least_squares(histogram, columns) + 0.5).astype(np.int64)
    for k in np.argsort(-counts, kind="stable"):
        if not counts[k]:
            break
        lengths = tuple(int(n) for n in columns[k] if n)
        times = min(int(counts[k]), possible(lengths))
        if times:
            use(lengths, times)

    # greedy: the longest rest first, then always the longest that still fits; a filling is
    # repeated as often as the counts allow
    skipped = np.zeros(window, dtype=bool)
    while True:
        open_lengths = np.flatnonzero((left > 0) & ~skipped)
        if not len(open_lengths):
            break
        first = int(open_lengths[-1])
        filling, room = [first], window - first
        spare = left.copy()
        spare[first] -= 1
        while room:
            fits = np.flatnonzero(spare[: room + 1] > 0)
            if not len(fits):
                break
            n = int(fits[-1])
            filling.append(n)
            spare[n] -= 1
            room -= n
        if room <= slack:
            use(tuple(filling), possible(tuple(filling)))
        else:
            skipped[first] = True  # its rests go end to end
    return chosen, left


class Layout:
    """Where the rest of a given length and rank goes; arrays of at most a few per recipe."""

    def __init__(self, histogram: np.ndarray, window: int, slack: int, first_sequence: int):
        chosen, left = plan(histogram, window, slack)
        used = np.zeros(window, np.int64)
        slots: list[list[tuple[int, int, int]]] = [[] for _ in range(window)]
        sequence = first_sequence
        for lengths, times in chosen:
            offset = 0
            for n in lengths:
                slots[n].append((int(used[n]), sequence, offset))
                used[n] += times
                offset += n
            sequence += times
        self.slots = [np.array(s, np.int64).reshape(-1, 3) for s in slots]
        self.window, self.used, self.stream = window, used, sequence
        amount = left * np.arange(window)
        self.stream_start = np.cumsum(amount) - amount

    def place(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(from, length, sequence, offset) of the one or two pieces of a rest."""
        if rank < self.used[length]:
            slots = self.slots[length]
            base, sequence, offset = slots[np.searchsorted(slots[:, 0], rank, "right") - 1]
            return [(0, length, int(sequence + rank - base), int(offset))]
        at = int(self.stream_start[length]) + (rank - int(self.used[length])) * length
        sequence, offset = self.stream + at // self.window, at % self.window
        fits = min(length, self.window - offset)
        out = [(0, fits, sequence, offset)]
        if fits < length:
            out.append((fits, length - fits, sequence + 1, 0))
        return out


ENCODED_DDL = (
    "part int, length int, rank bigint, doc_id bigint, start bigint, doc_tokens bigint, ids binary"
)
_ENCODED = pa.schema(
    [
        ("part", pa.int32()),
        ("length", pa.int32()),
        ("rank", pa.int64()),
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("ids", pa.binary()),
    ]
)


def encoded(docs: DataFrame, tokenizer: str, spaced: bool, window: int, end_id: int) -> DataFrame:
    """Whole windows and rests of all documents, ranked by length within the task; ids as uint16
    where the vocabulary allows."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer, spaced)
        kind = _kind(encoder.tokenizer.get_vocab_size())
        part, seen = TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        for batch in batches:
            out: list[tuple] = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(encoder.encode(text) + end, "<u4").astype(kind)
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    n = len(piece)
                    out.append((part, n, int(seen[n]), name, start, len(ids), piece.tobytes()))
                    seen[n] += 1
            columns = zip(*out) if out else [[] for _ in _ENCODED]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _ENCODED)], schema=_ENCODED
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, ENCODED_DDL)


def _kind(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


PIECES_DDL = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, ids binary"
)


def packed(
    docs: DataFrame, tokenizer: str, spaced: bool, window: int = WINDOW, end_id: int = END_ID,
    slack: int | None = None,
) -> DataFrame:
    """One row per piece, PIECES_DDL: the ids themselves (uint32 bytes) and their place."""
    slack = window // 128 if slack is None else slack
    steps = common.stored(encoded(docs, tokenizer, spaced, window, end_id), "packing")
    counts = common.stored(
        steps.groupBy("length", "part").agg(F.count("*").alias("n")), "packing-counts"
    )
    # rests: at most window - 1 rows reach the driver
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    histogram = np.array([totals.get(n, 0) for n in range(window)], dtype=np.int64)
    whole = totals.get(window, 0)
    layout = docs.sparkSession.sparkContext.broadcast(Layout(histogram, window, slack, whole))
    # the rank of a piece among all of its length: those of earlier tasks come first
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    kind = _kind(tokens.encoder(tokenizer, spaced).tokenizer.get_vocab_size())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = layout.value
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                length, rank, base, doc_id, start, doc_tokens, ids = row
                rank += base
                ids = np.frombuffer(ids, kind).astype("<u4")
                where = [(0, window, rank, 0)] if length == window else at.place(length, rank)
                for skip, n, sequence, offset in where:
                    raw = ids[skip : skip + n].tobytes()
                    out.append((doc_id, start + skip, n, zlib.crc32(raw), doc_tokens, sequence, offset, raw))
            columns = list(zip(*out)) if out else [[] for _ in range(8)]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:7]), pa.array(columns[7], pa.binary())],
                names=[f.split()[0] for f in PIECES_DDL.split(", ")],
            )

    return (
        steps.join(bases, ["length", "part"])
        .select("length", "rank", "base", "doc_id", "start", "doc_tokens", "ids")
        .mapInArrow(place, PIECES_DDL)
    )


def padded_length(filled: int, window: int = WINDOW) -> int:
    """Sequences are padded to the window, except at a power of two."""
    return filled if filled & (filled - 1) == 0 else window


def op4_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 1024 ids: one row per piece."""
    docs = common.table(spark, sf_dir, "documents")
    pieces = packed(docs, common.tokenizer_path("byte_bpe_50k.json"), spaced=True)
    return pieces.drop("ids")
