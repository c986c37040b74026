"""Secret scans with character Markov models, in DataFrame functions only.

Three patterns find secrets by their form (``BASE``). A fourth kind of span needs no keyword: long
runs of token characters whose characters follow each other as in random strings rather than as in
ordinary identifiers. Two first-order Markov models are counted over all documents. The values that
the patterns find are the random strings. Ordinary are the identifiers outside them and, as prose has
few with digits and slashes, identifiers of the usual shapes (``SHAPES``) that every document yields:
names in camel case, paths and dashed names of words drawn from its text by a hash of it, times and
UUIDs made of that hash. Each shape weighs as much as the plain identifiers. A run is a secret if the
log-likelihood ratio of the two reaches ``LEAST_RATIO`` and ``LEAST_PER_CHARACTER`` times its length. A
model is one row of numbers per pair of characters of a fixed alphabet, so its size is fixed.

Spans count code points, end exclusive, and cover the whole match. Defined cases: null texts are
empty ones and have no span; repeated rows are scanned each; an empty table gives an empty result;
with nothing to learn from the models are uniform and add no span; extra columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import common

# The patterns of the base scan, the letters of the keywords in either case.
_KEYWORD = (
    "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
    "|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"
)
ASSIGN = rf"""({_KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 8
# A match below the least length fails; none can start within one, so the length is in the pattern.
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
BASE = ("assign", "access", "hex")
MARKOV = "markov"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_SIDE = len(ALPHABET) + 1  # the first place stands for the start of a run
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = r"(?<![A-Za-z0-9+/_=-])[A-Za-z_-]{6,}(?![A-Za-z0-9+/_=-])"
LEAST_RATIO = 20.0
LEAST_PER_CHARACTER = 1.4
# What a counted run is labelled with: a random string, a plain identifier, or one of the shapes.
ORDINARY, RANDOM = 0, 1
SHAPES = {2: "camel case", 3: "path", 4: "time", 5: "uuid", 6: "dashed"}

SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string,value:string>>"
_FAR = 2**62  # behind every text


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, not wherever ``use`` names it within a loop."""
    return F.transform(F.array(value), use)[0]


def _blocks(items: Column, use) -> Column:
    """``use`` of each block of about the square root of ``size(items)`` items, as an array."""
    held = F.struct(items.alias("items"), F.ceil(F.sqrt(F.size(items))).cast("int").alias("b"))
    return _let(
        held,
        lambda h: F.when(
            F.size(h["items"]) > 0,
            F.transform(
                F.sequence(F.lit(1), F.size(h["items"]), F.greatest(h["b"], F.lit(1))),
                lambda at: use(F.slice(h["items"], at, h["b"])),
            ),
        ),
    )


def _before(items: Column, first: int, join) -> Column:
    """What ``join`` makes of all numbers before each of ``items``, null for no items.

    An array cannot be appended to without a copy, so numbers are joined block by block: the work grows with
    ``size * sqrt(size)`` at most.
    """
    numbers = "array<bigint>"
    start = F.lit(first).cast("bigint")
    none = F.array().cast(numbers)

    def running(block: Column, head: Column) -> Column:
        state = F.struct(head.alias("at"), none.alias("out"))
        return F.aggregate(
            block,
            state,
            lambda done, x: F.struct(
                join(done["at"], x).cast("bigint").alias("at"), F.concat(done["out"], F.array(done["at"])).alias("out")
            ),
            lambda done: done["out"],
        )

    def flat(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, start, lambda t, x: join(t, x).cast("bigint")))
        return F.flatten(F.zip_with(blocks, running(sums, start), running))

    return _let(_blocks(items.cast(numbers), lambda b: b), flat)


def _found(text: Column, pattern: str, kind: str, rank: int, group: int = 0, least: int = 0) -> Column:
    """Spans of a pattern: the pieces between the matches give the places of the matches."""
    p = F.lit(pattern)
    gaps, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, p, F.lit(0))
    values = F.regexp_extract_all(text, p, F.lit(group)) if group else matches
    empty = F.array().cast(SPAN)
    # zipped first: what stands within the loop would be matched again in every step of it
    both = F.zip_with(
        matches, values, lambda m, v: F.struct(F.length(m).alias("size"), v.alias("value"))
    )
    # the piece after the last match has no match, so its size is null
    steps = F.zip_with(
        gaps, both, lambda g, m: F.struct(F.length(g).alias("gap"), m["size"].alias("size"), m["value"].alias("value"))
    )

    def span(step: Column, at: Column) -> Column:
        start = at + step["gap"]
        return F.struct(
            start.cast("bigint").alias("start"),
            F.lit(rank).alias("rank"),
            (start + step["size"]).cast("bigint").alias("end"),
            F.lit(kind).alias("kind"),
            step["value"].alias("value"),
        )

    def placed(steps: Column) -> Column:
        sizes = F.transform(steps, lambda s: s["gap"] + F.coalesce(s["size"], F.lit(0)))
        return F.zip_with(steps, _before(sizes, 0, lambda a, b: a + b), span)

    spans = F.filter(_let(steps, placed), lambda s: F.length(s["value"]) >= least)
    return F.when(text.rlike(pattern), spans).otherwise(empty)


def base_spans(text: Column) -> Column:
    """The spans of all three patterns, by start, then kind as listed."""
    return F.array_sort(
        F.concat(
            _found(text, ASSIGN, "assign", 0, 2, ASSIGN_LEAST),
            _found(text, ACCESS, "access", 1),
            _found(text, HEX, "hex", 2),
        )
    )


def _steps(run: Column) -> Column:
    """1-based places of all (previous, next) pairs of a run in a flat table."""
    characters = F.filter(F.split(run, ""), lambda c: c != "")
    before = F.concat(F.array(F.lit("~")), characters)  # not in the alphabet: place 0

    def step(b: Column, c: Column) -> Column:
        alphabet = F.lit(ALPHABET)
        return F.instr(alphabet, b) * F.lit(_SIDE) + F.instr(alphabet, c) + F.lit(1)

    return F.array_compact(F.zip_with(before, characters, step))


def shapes(words: str, digest: str) -> dict[int, Column]:
    """An identifier of each shape, of words drawn by the number that begins the hexadecimal ``digest``."""
    d = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")

    def word(i: int) -> Column:
        return F.lower(F.element_at(words, (F.pmod(d + i, F.size(words)) + 1).cast("int")))

    def part(by: int, n: int, width: int, first: int = 0) -> Column:
        return F.lpad((F.pmod(F.floor(d / by), F.lit(n)) + first).cast("string"), width, "0")

    date = F.concat_ws("-", part(1, 40, 4, 1990), part(40, 12, 2, 1), part(480, 28, 2, 1))
    time = F.concat_ws("-", part(1, 24, 2), part(1, 60, 2), part(60, 60, 2), part(1, 10**9, 9))
    groups = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    made = [
        F.concat(*(F.concat(F.upper(F.substring(word(i), 1, 1)), F.substr(word(i), F.lit(2))) for i in range(4))),
        F.concat(*(F.concat(F.lit("/"), word(i)) for i in range(4)), part(1, 10, 1)),
        F.concat(date, F.lit("T"), time),
        F.concat_ws("-", *(F.substring(digest, at, n) for at, n in groups)),
        F.concat_ws("-", *(word(i) for i in range(3)), date),
    ]
    return dict(zip(SHAPES, made))


def train(docs: DataFrame) -> list[float]:
    """Log-likelihood ratios of all pairs of characters, random against ordinary."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    some = docs.select(text.alias("text")).withColumn("spans", base_spans(F.col("text")))
    rest = F.col("text")
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.regexp_replace(rest, pattern, " ")
    rest = F.when(F.size("spans") > 0, rest).otherwise(F.col("text"))
    words = F.array_distinct(F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(0)))
    values = F.array_distinct(F.expr("transform(spans, s -> s.value)"))
    both = some.select(values.alias("values"), words.alias("words"), F.md5("text").alias("hash"))

    def labelled(runs: str, label: int) -> Column:
        return F.transform(runs, lambda r: F.struct(F.lit(label).alias("label"), r.alias("run")))

    shaped = [F.struct(F.lit(k).alias("label"), run.alias("run")) for k, run in shapes("words", "hash").items()]
    runs = F.concat(
        labelled("values", RANDOM),
        labelled("words", ORDINARY),
        F.when(F.size("words") > 0, F.array(*shaped)).otherwise(F.array().cast("array<struct<label:int,run:string>>")),
    )
    # equal runs are counted first, on the map side too, so each is taken apart once
    counted = (
        both.select(F.inline(runs))
        .groupBy("label", "run")
        .agg(F.count("*").alias("n"))
        .select("label", "n", F.explode(_steps(F.col("run"))).alias("step"))
        .groupBy("label", "step")
        .agg(F.sum("n").alias("n"))
    )
    # at most 7 * 68 * 68 rows
    return ratios({(r.label, r.step): r.n for r in counted.collect()})


def ratios(counts: dict[tuple[int, int], int]) -> list[float]:
    """Both models smoothed by the same share of a uniform one, as a flat table of log-ratios.

    The counts of each shape are brought to the sum of the plain identifiers and added to those.
    """
    plain = sum(n for (label, _), n in counts.items() if label == ORDINARY)
    weight = {k: plain / max(1, sum(n for (label, _), n in counts.items() if label == k)) for k in SHAPES}
    mixed: dict[tuple[int, int], float] = {}
    for (label, s), n in counts.items():
        at = (RANDOM if label == RANDOM else ORDINARY, s)
        mixed[at] = mixed.get(at, 0) + n * weight.get(label, 1)
    counts = mixed
    out = [0.0] * (_SIDE * _SIDE)
    for before in range(_SIDE):
        steps = [before * _SIDE + after + 1 for after in range(1, _SIDE)]
        sums = [sum(counts.get((label, s), 0) for s in steps) for label in (0, 1)]
        for s in steps:
            ordinary, random = (
                (counts.get((label, s), 0) + 0.5) / (sums[label] + 0.5 * (_SIDE - 1)) for label in (0, 1)
            )
            out[s - 1] = math.log(random / ordinary)
    return out


def markov_spans(text: Column, base: Column, table: list[float]) -> Column:
    """Long runs outside the base spans that look random."""
    model = F.from_json(F.lit(json.dumps(table)), "array<double>")

    def ratio(run: Column) -> Column:
        return F.aggregate(_steps(run), F.lit(0.0), lambda total, s: total + F.element_at(model, s))

    def likely(r: Column) -> Column:
        return ratio(r["value"]) >= F.greatest(F.lit(LEAST_RATIO), F.length(r["value"]) * LEAST_PER_CHARACTER)

    runs = F.filter(_found(text, RUN, MARKOV, 3), likely)
    return F.when(F.size(base) > 0, _free(runs, base)).otherwise(runs)


def _free(runs: Column, base: Column) -> Column:
    """The ``runs`` that overlap no span of ``base``; in order of their starts they meet the spans before and after."""

    def clear(spans: Column) -> Column:
        is_base = lambda s: s["kind"] != MARKOV
        ends = F.transform(spans, lambda s: F.when(is_base(s), s["end"]).otherwise(F.lit(0)))
        starts = F.transform(F.reverse(spans), lambda s: F.when(is_base(s), s["start"]).otherwise(F.lit(_FAR)))
        last_end = _before(ends, 0, F.greatest)
        next_start = F.reverse(_before(starts, _FAR, F.least))
        around = F.arrays_zip(spans.alias("span"), last_end.alias("last"), next_start.alias("next"))
        kept = F.filter(
            around,
            lambda x: ~is_base(x["span"]) & (x["last"] <= x["span"]["start"]) & (x["next"] >= x["span"]["end"]),
        )
        return F.transform(kept, lambda x: x["span"])

    # of spans that start together, those of the base come first: their rank is lower
    return _let(F.array_sort(F.concat(base, runs)), clear)


def scanned(docs: DataFrame, table: list[float]) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of start, rank, end, kind, value in order."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    based = docs.withColumn("base", base_spans(text))
    return based.withColumn(
        "spans", F.array_sort(F.concat("base", markov_spans(text, F.col("base"), table)))
    )


def joined(spans: str) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(
        F.transform(F.col(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by ``mark``."""

    def cut(spans: Column) -> Column:
        """The pieces that stay: (at, end), each up to a span that starts behind all spans before it."""
        ends = F.transform(spans, lambda s: s["end"])
        pieces = F.zip_with(
            spans, _before(ends, 0, F.greatest), lambda s, at: F.struct(at.alias("at"), s["start"].alias("end"))
        )
        rest = F.struct(F.array_max(ends).alias("at"), F.length(text).cast("bigint").alias("end"))
        return F.concat(F.filter(pieces, lambda p: p["at"] <= p["end"]), F.array(rest))

    def joined_block(pieces: Column) -> Column:
        # places are counted from the start of a text, so a block's own text is taken out first
        head = pieces[0]["at"]
        whole = F.substr(text, (head + 1).cast("int"), (F.element_at(pieces, -1)["end"] - head).cast("int"))
        return _let(
            F.struct(whole.alias("text"), head.alias("head")),
            lambda b: F.array_join(
                F.transform(
                    pieces,
                    lambda p: F.substr(b["text"], (p["at"] - b["head"] + 1).cast("int"), (p["end"] - p["at"]).cast("int")),
                ),
                mark,
            ),
        )

    changed = F.array_join(_blocks(_let(spans, cut), joined_block), mark)
    return F.when(F.size(spans) > 0, changed).otherwise(text)


def op3_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of all documents."""
    docs = common.table(spark, sf_dir, "documents")
    found = scanned(docs, train(docs))

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )
