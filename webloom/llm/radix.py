"""Distributed LSD radix sort: rows get their rank by stable counting-sort passes over key digits.

Rows carry their place in ``at`` and are dealt to blocks of ``2**BLOCK_BITS`` places. A pass takes
one digit, the least significant first:

1. counts of each digit in each block, combined on the map side;
2. global offsets: rows with smaller digits, plus rows with the same digit in earlier blocks;
3. each block is counting-sorted on its own, and the offsets give every row its new place.

The places after one pass are the blocks of the next, so the order within equal digits is kept,
and after the last pass ``at`` is the final rank. A block has a bounded number of rows whatever
the keys are: equal keys and hot digits spread like any others. The driver sees the totals of one
digit, at most ``2**DIGIT_BITS`` numbers. Every pass is written to the shared folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm import common

BLOCK_BITS = 12
DIGIT_BITS = 9


def digits(bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the digits of a key of so many bits, the least significant first."""
    n = -(-bits // DIGIT_BITS)
    width = -(-bits // n) if n else 0
    return [(i * width, min(width, bits - i * width)) for i in range(n)]


def _place(key_column: str, shift: int, width: int, starts: np.ndarray):
    """The counting sort of one block; ``starts``: rows with smaller digits, by digit."""

    def run(rows: pa.Table, offsets: pa.Table) -> pa.Table:
        at = rows["at"].to_numpy()
        order = np.empty(len(at), np.int64)
        order[at & ((1 << BLOCK_BITS) - 1)] = np.arange(len(at))  # places in a block have no gaps
        digit = (rows[key_column].to_numpy() >> shift) & ((1 << width) - 1)
        counts = np.bincount(digit, minlength=1 << width)
        first = np.cumsum(counts) - counts
        sort = order[np.argsort(digit[order].astype(np.uint16), kind="stable")]  # of 16 bits: by counting
        base = starts.copy()
        base[offsets["digit"].to_numpy()] += offsets["before"].to_numpy()
        own = digit[sort]
        to = pa.array(base[own] + np.arange(len(sort)) - first[own])
        out = rows.take(pa.array(sort))
        return out.set_column(out.schema.get_field_index("at"), "at", to).drop_columns(["block"])

    return run


def _pass(rows: DataFrame, key: str, shift: int, width: int) -> DataFrame:
    digit = F.shiftright(key, shift).bitwiseAND(F.lit((1 << width) - 1))
    block = F.shiftright("at", BLOCK_BITS)
    slim = rows.select(block.alias("block"), digit.alias("digit"))
    totals = np.zeros(1 << width, np.int64)
    for r in slim.groupBy("digit").count().collect():
        totals[r["digit"]] = r["count"]
    earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slim.groupBy("block", "digit")
        .agg(F.count("*").alias("n"))
        .select("block", "digit", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    ddl = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    return (
        rows.withColumn("block", block)
        .groupBy("block")
        .cogroup(offsets.groupBy("block"))
        .applyInArrow(_place(key, shift, width, np.cumsum(totals) - totals), ddl)
    )


def ranked(rows: DataFrame, keys: list[Column]) -> DataFrame:
    """``rows`` with ``rank``, from 1, by ``keys``: long, never null, the most significant first.

    Rows with equal keys keep the order in which they were stored. No other column is named at, rank,
    block or starts with ``_key``. An empty table stays empty.
    """
    columns = rows.columns
    named = [f"_key{i}" for i in range(len(keys))]
    bounds = rows.agg(*(f(k).alias(f"{n}_{f.__name__}") for k, n in zip(keys, named) for f in (F.min, F.max))).first()
    keyed, todo = rows, []
    for k, n in reversed(list(zip(keys, named))):
        low, high = bounds[f"{n}_min"] or 0, bounds[f"{n}_max"] or 0
        if high - low >= 1 << 63:
            raise ValueError("a key of more than 63 bits has to be cut into two")
        keyed = keyed.withColumn(n, k - F.lit(low))
        todo += [(n, *d) for d in digits((high - low).bit_length())]
    # written with the row, so it stays the same wherever the row is read again
    now = common.stored(keyed.withColumn("at", F.monotonically_increasing_id()), "radix")
    for n, shift, width in todo:
        now = common.stored(_pass(now, n, shift, width), "radix")
    if not todo:  # one key for all rows: any constant digit turns the first places into ranks
        now = common.stored(_pass(now.withColumn("_key", F.lit(0).cast("long")), "_key", 0, 1), "radix")
    return now.select(*columns, (F.col("at") + 1).alias("rank"))
