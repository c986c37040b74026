"""Language identification by interpolated Kneser-Ney character models.

A model per language gives the probability of every character of a word after up to four before
it. Counts of the longest strings of characters are absolute-discounted and interpolated with the
next shorter ones, which count in how many places a string occurs instead of how often. All
languages share one table per length: sorted hashes of the strings, and a row of probabilities.
The language with the lowest cross-entropy per character wins. How far it is ahead, times the root
of the number of characters, is turned into a probability of being right by a logistic curve that
is fitted on sampled documents the models have not seen; ``accepted`` tells whether that
probability reaches the level at which ``PRECISION`` of those documents were right.

The models are fitted on at most about DOCS_PER_LANGUAGE labelled documents of each language (a
bound on fitting only); every row is scored over its whole text.

Defined cases: null texts, and texts without a letter, are ``und`` with score 0, as is everything
when nothing can be learned from; with one learned language its score is 1; ties go to the
language first in order; repeated rows are scored each; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import common

ORDER = 5
DOCS_PER_LANGUAGE = 2_000
MOST_LANGUAGES = 1_000
CALIBRATION_SLICES = 5  # one of so many sampled documents is kept from the models ...
LEARNED_SLICE = -1  # ... but none of a language with fewer of them, or with none in other slices
PRECISION = 0.99
UNKNOWN = "und"
WORDS_KEPT = 500_000
START, END = "^", "$"

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    """Runs of letters, that is of characters of the categories L*: no number forms, fractions or marks."""
    found = _WORD.findall((text or "").lower())
    if all(map(str.isalpha, found)):
        return found
    return "".join(c if c.isalpha() else " " for w in found for c in (*w, " ")).split()


def grams(word: str, order: int = ORDER) -> list[str]:
    """For each character and the end of the word: itself after up to ``order - 1`` before it."""
    padded = START + word + END
    return [padded[max(0, i - order + 1) : i + 1] for i in range(1, len(padded))]


def _hashes(points: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A 64-bit hash of points[start : start + length] for each pair."""
    h = length.astype(np.uint64) + np.uint64(0x51)
    for k in range(int(length.max(initial=0))):
        at = np.minimum(start + k, len(points) - 1)
        mixed = (h ^ points[at]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        h = np.where(k < length, mixed, h)
    return h


def _hash_strings(strings: list[str]) -> np.ndarray:
    points = np.array([ord(c) for c in "".join(strings)] or [0], dtype=np.uint64)
    length = np.array([len(s) for s in strings], dtype=np.int64)
    return _hashes(points, np.cumsum(length) - length, length)


class _Table:
    """Sorted hashes with a row each, and a default row."""

    def __init__(self, rows: dict[str, np.ndarray], default: np.ndarray):
        keys = sorted(rows)
        h = _hash_strings(keys)
        order = np.argsort(h)
        self.hashes = h[order]
        values = np.array([rows[k] for k in keys], dtype=np.float32).reshape(len(keys), len(default))
        self.rows = np.concatenate([values[order], np.asarray(default, np.float32)[None]])

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows, and whether each was there."""
        at = np.searchsorted(self.hashes, h)
        at[at == len(self.hashes)] = 0
        there = self.hashes[at] == h if len(self.hashes) else np.zeros(len(h), bool)
        return self.rows[np.where(there, at, len(self.hashes))], there


class _OneLanguage:
    """Interpolated Kneser-Ney over the counts of one language."""

    def __init__(self, longest: dict[str, int], order: int, alphabet: int):
        levels: list[dict[str, int]] = [{} for _ in range(order + 1)]
        for g, n in longest.items():
            levels[len(g)][g] = levels[len(g)].get(g, 0) + n
        for k in range(order, 1, -1):  # a shorter string counts the places in which it occurs
            for g in levels[k]:
                levels[k - 1][g[1:]] = levels[k - 1].get(g[1:], 0) + 1
        self.alphabet = alphabet
        self.discount, self.total, self.kinds = [0.0], {}, {}
        for level in levels[1:]:
            counts = Counter(level.values())
            once, twice = counts[1], counts[2]
            self.discount.append(min(0.9, max(0.1, once / (once + 2 * twice) if once else 0.1)))
            for g, n in level.items():
                self.total[g[:-1]] = self.total.get(g[:-1], 0) + n
                self.kinds[g[:-1]] = self.kinds.get(g[:-1], 0) + 1
        self.levels = levels

    def share(self, context: str) -> float:
        """What a context leaves to the shorter one; all of it if it was never seen."""
        n = self.total.get(context)
        return 1.0 if not n else self.discount[len(context) + 1] * self.kinds[context] / n

    def probability(self, gram: str) -> float:
        if not gram:
            return 1.0 / self.alphabet
        context = gram[:-1]
        n = self.total.get(context, 0)
        # after a start mark the shorter context is the one without the mark
        shorter = self.probability(gram[1:])
        if not n:
            return shorter
        own = max(self.levels[len(gram)].get(gram, 0) - self.discount[len(gram)], 0.0)
        return own / n + self.share(context) * shorter


class Models:
    """All languages: per length a table of log-probabilities and one of what contexts leave over."""

    def __init__(self, counts: dict[str, dict[str, int]], order: int = ORDER):
        self.languages, self.order = sorted(counts), order
        alphabet = len({c for grams in counts.values() for g in grams for c in g}) + 1
        own = [_OneLanguage(counts[lang], order, alphabet) for lang in self.languages]
        self.floor = np.full(len(own), np.log(1.0 / alphabet), np.float32)
        self.known, self.left = [], []
        for k in range(1, order + 1):
            strings = {g for m in own for g in m.levels[k]}
            self.known.append(
                _Table({g: np.log([m.probability(g) for m in own]) for g in strings}, self.floor)
            )
            contexts = {g[:-1] for g in strings}
            self.left.append(
                _Table({c: np.log([m.share(c) for m in own]) for c in contexts}, np.zeros(len(own)))
            )
        self.curve, self.least = (0.0, 0.0), 0.0

    def word_scores(self, distinct: list[str]) -> np.ndarray:
        """Per word the summed negative log-probabilities of its characters and its end."""
        sizes = np.array([len(w) for w in distinct], dtype=np.int64) + 2
        points = np.array(
            [ord(c) for c in "".join(START + w + END for w in distinct)], dtype=np.uint64
        )
        first = np.repeat(np.cumsum(sizes) - sizes, sizes - 1)
        at = np.arange(len(first)) + np.repeat(np.arange(len(sizes)) + 1, sizes - 1)
        out = np.zeros((len(at), len(self.languages)), np.float32)
        todo = np.arange(len(at))
        for k in range(self.order, 0, -1):
            start = np.maximum(first[todo], at[todo] - k + 1)
            length = at[todo] + 1 - start
            whole = length == k  # the others are shorter than k: their turn is still to come
            mine = todo[whole]
            rows, there = self.known[k - 1].find(_hashes(points, start[whole], length[whole]))
            out[mine[there]] += rows[there]
            missed = mine[~there]
            s = at[missed] - k + 1
            out[missed] += self.left[k - 1].find(_hashes(points, s, np.full(len(s), k - 1)))[0]
            todo = np.concatenate([todo[~whole], missed])
            if not len(todo):
                break
        out[todo] += self.floor
        ends = np.cumsum(sizes - 1) - (sizes - 1)
        return -np.add.reduceat(out, ends, axis=0) if len(ends) else out[:0]

    def confidence(self, entropy: np.ndarray, characters: np.ndarray) -> np.ndarray:
        """Calibrated probability that the lowest cross-entropy names the language."""
        if entropy.shape[1] < 2:
            return np.ones(len(entropy))
        two = np.sort(entropy, axis=1)[:, :2]
        a, b = self.curve
        return 1 / (1 + np.exp(-(a * _lead(two, characters) + b)))

    def calibrate(self, lead: np.ndarray, right: np.ndarray) -> None:
        """Fit the logistic curve, and the level from which PRECISION of the documents are right."""
        a, b = 1.0, 0.0
        # one mistaken and one right pseudo-document keep a clean sample from an infinite slope
        x, y = np.append(lead, [0.0, 0.0]), np.append(right.astype(float), [0.0, 1.0])
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -50, 50)))
            g, h = p - y, np.maximum(p * (1 - p), 1e-9)
            hess = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-3]])
            step = np.linalg.solve(hess, [(g * x).sum() + 1e-3 * a, g.sum() + 1e-3 * b])
            a, b = a - step[0], b - step[1]
        self.curve = (float(a), float(b))
        p = 1 / (1 + np.exp(-(a * lead + b)))
        order = np.argsort(-p)
        good = np.flatnonzero(np.cumsum(right[order]) >= PRECISION * np.arange(1, len(order) + 1))
        self.least = float(p[order[good[-1]]]) if len(good) else 1.0


def _lead(two: np.ndarray, characters: np.ndarray) -> np.ndarray:
    return np.minimum((two[:, 1] - two[:, 0]) * np.sqrt(np.maximum(characters, 1)), 30.0)


class Scorer:
    """Cross-entropies of texts; words are scored once while they are kept."""

    def __init__(self, models: Models):
        self.models = models
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.models.languages)), np.float32)

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Per text: nats per character in each language, and the number of characters."""
        split = [words(t) for t in texts]
        if len(self.place) > WORDS_KEPT:
            self._clear()
        new = list({w for own in split for w in own if w not in self.place})
        if new:
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.rows = np.concatenate([self.rows, self.models.word_scores(new)])
        sums = np.zeros((len(split), len(self.models.languages)))
        characters = np.zeros(len(split), np.int64)
        for i, own in enumerate(split):
            if own:
                at = np.fromiter(map(self.place.__getitem__, own), np.int64, len(own))
                sums[i] = self.rows[at].sum(0, dtype=np.float64)
                characters[i] = sum(map(len, own)) + len(own)
        return sums / np.maximum(characters, 1)[:, None], characters


def _sample(docs: DataFrame) -> DataFrame:
    """About DOCS_PER_LANGUAGE learnable documents of each language: lang, text, slice."""
    learned = docs.where(common.is_learned("doc_id") & F.col("lang").isNotNull())
    sizes = {r.lang: r["count"] for r in learned.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: lang does not hold languages")
    slices = 1 << 30
    cut = docs.sparkSession.createDataFrame(
        [(k, min(slices, int(slices * DOCS_PER_LANGUAGE / n))) for k, n in sizes.items()],
        "lang string, _cut bigint",
    )
    # an id or a text may hold many rows: equal rows count once, so the sample stays bounded
    mark = F.xxhash64("doc_id", "text")
    return (
        learned.join(F.broadcast(cut), "lang")
        .where(F.pmod(mark, F.lit(slices)) < F.col("_cut"))
        .select("lang", "text", F.pmod(mark, F.lit(CALIBRATION_SLICES)).alias("slice"))
        .distinct()
    )


def train(docs: DataFrame) -> Models | None:
    """Models and calibration from the rows that may be learned from; None if there are none."""
    sample = common.stored(_sample(docs), "language-sample")
    # at most MOST_LANGUAGES rows
    sizes = sample.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("slice") != 0).alias("learned"))
    small = [r.lang for r in sizes.where(f"n < {CALIBRATION_SLICES} or learned = 0").collect()]
    if small:
        kept = F.when(F.col("lang").isin(small), F.lit(LEARNED_SLICE)).otherwise(F.col("slice"))
        sample = sample.withColumn("slice", kept)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter[tuple[str, str]] = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in Counter(words(text)).items():
                    for g in grams(word):
                        seen[lang, g] += n
            langs, strings = zip(*seen) if seen else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(strings, pa.string()), pa.array(seen.values(), pa.int64())],
                names=["lang", "gram", "n"],
            )

    counted = (
        sample.where("slice <> 0")
        .select("lang", F.col("text").cast("string"))
        .mapInArrow(count, "lang string, gram string, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    counts: dict[str, dict[str, int]] = {}
    for lang, gram, n in counted.toLocalIterator(prefetchPartitions=True):
        counts.setdefault(lang, {})[gram] = n
    if not counts:
        return None
    models = Models(counts)
    if len(models.languages) > 1:
        _calibrate(models, sample.where("slice = 0"))
    return models


def _calibrate(models: Models, sample: DataFrame) -> None:
    sent = sample.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            entropy, characters = scorer.entropies(batch.column(1).to_pylist())
            best = np.array(sent.value.languages)[entropy.argmin(1)]
            right = best == np.array(batch.column(0).to_pylist())
            lead = _lead(np.sort(entropy, axis=1)[:, :2], characters)
            keep = characters > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(lead[keep]), pa.array(right[keep])], names=["lead", "right"]
            )

    text = sample.select("lang", F.col("text").cast("string"))
    rows = text.mapInArrow(run, "lead double, right boolean").collect()
    if rows:
        models.calibrate(np.array([r.lead for r in rows]), np.array([r.right for r in rows]))


def predicted(docs: DataFrame, models: Models | None, *keep: str) -> DataFrame:
    """The columns ``keep`` with lang_pred, score, cross_entropy and accepted."""
    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.col("text").cast("string").alias("_text"))
    if models is None:
        return rows.drop("_text").withColumns(
            {
                "lang_pred": F.lit(UNKNOWN),
                "score": F.lit(0.0),
                "cross_entropy": F.lit(None).cast("double"),
                "accepted": F.lit(False),
            }
        )
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = sent.value
        scorer, names = Scorer(models), np.array(models.languages, dtype=object)
        for batch in batches:
            entropy, characters = scorer.entropies(batch.column(batch.num_columns - 1).to_pylist())
            some = characters > 0
            score = np.where(some, models.confidence(entropy, characters), 0.0)
            best = np.where(some, names[entropy.argmin(1)], UNKNOWN)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(best.tolist(), pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(entropy.min(1), pa.float64(), mask=~some),
                    pa.array(some & (score >= models.least)),
                ],
                names=[*keep, "lang_pred", "score", "cross_entropy", "accepted"],
            )

    ddl = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[:-1])
    return rows.mapInArrow(
        run, f"{ddl}, lang_pred string, score double, cross_entropy double, accepted boolean"
    )


def op8_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = common.table(spark, sf_dir, "documents")
    return predicted(docs, train(docs), "doc_id").withColumn(
        "held_out", common.is_held_out("doc_id")
    )
