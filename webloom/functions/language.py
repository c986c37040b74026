"""Trigram language model: normal form, fitting on Spark, scoring in Arrow batches."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from webloom.schema import UNKNOWN_LANG

PROFILE_GRAMS = 300
# Language codes are a closed vocabulary; more than this means the label column is wrong.
MAX_LANGUAGES = 1000
# Bounds of the arrays used while scoring.
_SLICE_CHARS = 1 << 18
_SLICE_CELLS = 1 << 22
_DENSE_CELLS = 1 << 22
# Characters that are counted at once while fitting, and distinct trigrams that a task holds.
_CHARS_AT_ONCE = 1 << 22
_PIECE_CHARS = 1 << 17
_GRAMS_HELD = 1 << 20
_CODE_BITS = 21


def normal_form(text: Column) -> Column:
    """Lower case, letters only, one blank between words and one at either end."""
    padded = F.concat(F.lit(" "), F.lower(text), F.lit(" "))
    return F.regexp_replace(padded, r"[^\p{L}\p{M}]+", " ")


def trigrams(normal: Column) -> Column:
    """All overlapping trigrams of a normal form, from three passes of disjoint ones."""
    shifted = (F.substring(normal, start, 2**31 - 1) for start in (1, 2, 3))
    return F.concat(*(F.regexp_extract_all(s, F.lit("..."), F.lit(0)) for s in shifted))


def _count_grams(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams of code points around each that is no blank, packed in one number, and their counts."""
    present = np.zeros(sys.maxunicode + 1, dtype=bool)
    present[points] = True
    letters = np.flatnonzero(present)
    size = len(letters)
    dense = size**3 <= _DENSE_CELLS
    place = np.zeros(sys.maxunicode + 1, dtype=np.int32 if dense else np.int64)
    place[letters] = np.arange(size)
    if dense:
        counts = np.zeros(size**3, np.int64)
        for i in range(0, len(points) - 2, _PIECE_CHARS):
            ids = place[points[i : i + _PIECE_CHARS + 2]]
            counts += np.bincount((ids[:-2] * size + ids[1:-1]) * size + ids[2:], minlength=len(counts))
        numbers = np.flatnonzero(counts)
        counts = counts[numbers]
    else:
        ids = place[points]
        numbers, counts = np.unique((ids[:-2] * size + ids[1:-1]) * size + ids[2:], return_counts=True)
    first, rest = np.divmod(numbers, size * size)
    second, third = np.divmod(rest, size)
    keys = (letters[first] << _CODE_BITS | letters[second]) << _CODE_BITS | letters[third]
    within = letters[second] != ord(" ")
    return keys[within], counts[within]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def _gram_texts(keys: np.ndarray) -> list[str]:
    points = np.stack([keys >> 2 * _CODE_BITS, keys >> _CODE_BITS, keys], axis=1) & ((1 << _CODE_BITS) - 1)
    text = points.astype("<u4").tobytes().decode("utf-32-le")
    return [text[i : i + 3] for i in range(0, len(text), 3)]


def counted_grams(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, gram, n``: trigrams within words and their two blanks, counted within each task.

    One narrow Arrow step over normal forms. A task hands on its counts at its end, and whenever it
    holds ``_GRAMS_HELD`` trigrams, so a trigram may come in several rows.
    """
    at_once, held = _CHARS_AT_ONCE, _GRAMS_HELD

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[str]] = {}
        found: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        chars = 0

        def settle() -> None:
            # every form has a blank at either end, so no trigram reaches from one into the next
            for code, forms in waiting.items():
                points = np.frombuffer("".join(forms).encode("utf-32-le"), dtype="<u4")
                fresh = _count_grams(points)
                found[code] = _merged([found[code], fresh]) if code in found else fresh
            waiting.clear()

        def handed_on() -> Iterator[pa.RecordBatch]:
            for code, (keys, counts) in found.items():
                columns = [pa.repeat(code, len(keys)), pa.array(_gram_texts(keys), pa.string()), pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])
            found.clear()

        for batch in batches:
            for code, form in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                waiting.setdefault(code, []).append(form)
                chars += len(form)
                if chars >= at_once:
                    settle()
                    chars = 0
                    if sum(len(keys) for keys, _ in found.values()) >= held:
                        yield from handed_on()
        settle()
        yield from handed_on()

    forms = labelled.select(F.col(lang).alias("lang"), normal_form(F.col(text)).alias("form")).dropna()
    return forms.mapInArrow(count, "lang string, gram string, n bigint")


def profile(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The ``PROFILE_GRAMS`` most frequent trigrams of each language, with their weights.

    Trigrams stay within one word and its two blanks. Tasks count them as numbers and hand on each
    once, so no word is ever a row and the vocabulary does not matter; the rank filter is applied per
    task before the ranking shuffle.
    """
    grams = counted_grams(labelled, text, lang)
    counts = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    ranked = counts.withColumn("rank", rank).where(F.col("rank") <= PROFILE_GRAMS)
    return ranked.select(
        "lang",
        "gram",
        F.col("rank").cast("bigint").alias("rank"),
        (F.lit(PROFILE_GRAMS + 1) - F.col("rank")).cast("bigint").alias("weight"),
    )


# Ids of characters while scoring; the letters of a profile follow.
_OTHER_LETTER, _BLANK, _FIRST_LETTER = 0, 1, 2


def _alphabet(letters: list[str]) -> np.ndarray:
    """Character id per code point. Everything that is no letter or mark is a blank."""
    ids = np.fromiter(
        (
            _OTHER_LETTER if unicodedata.category(chr(c))[0] in "LM" else _BLANK
            for c in range(sys.maxunicode + 1)
        ),
        dtype=np.int32,
    )
    for i, letter in enumerate(letters):
        ids[ord(letter)] = _FIRST_LETTER + i
    return ids


@dataclass(frozen=True)
class LanguageModel:
    """A fitted profile, laid out for scoring.

    ``alphabet``  character id per code point
    ``grams``     sorted trigram numbers, formed from three character ids
    ``weights``   one row per trigram, one column per language
    """

    langs: tuple[str, ...]
    alphabet: np.ndarray
    size: int
    grams: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, labelled: DataFrame, text: str = "text", lang: str = "lang") -> "LanguageModel":
        return cls.of(profile(labelled, text, lang))

    @classmethod
    def of(cls, profile_rows: DataFrame) -> "LanguageModel":
        """Bring a profile to the driver; its size is bounded and checked."""
        bound = PROFILE_GRAMS * MAX_LANGUAGES
        table = profile_rows.select("lang", "gram", "weight").limit(bound + 1).toPandas()
        if len(table) > bound:
            raise ValueError(f"language profile has more than {bound} rows")
        langs = sorted(table["lang"].unique())
        letters = sorted(set("".join(table["gram"])) - {" "})
        alphabet, size = _alphabet(letters), _FIRST_LETTER + len(letters)
        ids = alphabet[[[ord(c) for c in g] for g in table["gram"]] or np.empty((0, 3), int)]
        numbers = (ids.astype(np.int64) @ [size * size, size, 1]).astype(np.int64)
        grams, row = np.unique(numbers, return_inverse=True)
        weights = np.zeros((len(grams), len(langs)))
        weights[row, np.searchsorted(langs, table["lang"].tolist())] = table["weight"]
        return cls(tuple(langs), alphabet, size, grams, weights)

    @cached_property
    def _direct(self) -> np.ndarray:
        """Row in ``grams`` by trigram number, for alphabets small enough."""
        direct = np.full(self.size**3, -1, dtype=np.int32)
        direct[self.grams] = np.arange(len(self.grams))
        return direct

    def _gram_rows(self, ids: np.ndarray) -> np.ndarray:
        """Row of each trigram in ``grams``, -1 for a trigram outside the profile."""
        ids = ids.astype(np.int64) if self.size**3 > np.iinfo(np.int32).max else ids
        numbers = (ids[:-2] * self.size + ids[1:-1]) * self.size + ids[2:]
        if self.size**3 <= _DENSE_CELLS:
            return self._direct[numbers]
        row = np.minimum(np.searchsorted(self.grams, numbers), len(self.grams) - 1)
        return np.where(self.grams[row] == numbers, row, -1)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Sum of trigram weights per text and language, for lower-case texts.

        All texts run through as one sequence of character ids: each with a blank at either
        end, runs of blanks made one, and a letter of no trigram between two texts.
        """
        sizes = np.array([len(t) + 3 for t in texts])
        joined = " " + "   ".join(texts) + "  "
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ids = self.alphabet[points]
        ids[np.cumsum(sizes) - 1] = _OTHER_LETTER
        kept = np.ones(len(ids), dtype=bool)
        kept[1:] = (ids[1:] != _BLANK) | (ids[:-1] != _BLANK)
        rows = self._gram_rows(ids[kept])
        owner = np.repeat(np.arange(len(texts)), sizes)[kept][: len(rows)]
        hit = rows >= 0
        width = len(self.grams)
        counts = np.bincount(owner[hit] * width + rows[hit], minlength=len(texts) * width)
        return counts.reshape(len(texts), width) @ self.weights

    def _best_of(self, texts: list[str]) -> list[str]:
        scores = self.scores(texts)
        names = np.array(self.langs, dtype=object)[scores.argmax(axis=1)]
        names[scores.max(axis=1) == 0] = UNKNOWN_LANG
        return names.tolist()

    def best(self, texts: list[str]) -> list[str]:
        """Highest score wins, ties go to the first code; no match means unknown.

        Works on slices, so that the arrays of one step stay small.
        """
        if not self.langs:
            return [UNKNOWN_LANG] * len(texts)
        most = max(1, _SLICE_CELLS // len(self.grams))
        found, batch, size = [], [], 0
        for t in texts:
            batch.append(t)
            size += len(t) + 3
            if size >= _SLICE_CHARS or len(batch) == most:
                found += self._best_of(batch)
                batch, size = [], 0
        return found + self._best_of(batch) if batch else found

    def detect_each(self, texts: Column) -> Column:
        """Languages of an ARRAY<STRING> of texts, one per element."""
        model = self

        @F.arrow_udf("array<string>")
        def languages(batch: pa.Array) -> pa.Array:
            sizes = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            found = pa.array(model.best(batch.flatten().to_pylist()), pa.string())
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found)

        # Scoring is deterministic. Declared otherwise, it keeps filters on its result from
        # being copied below it, where they would run the whole text extraction again.
        scored = languages.asNondeterministic()
        return scored(F.transform(texts, lambda t: F.lower(F.coalesce(t, F.lit("")))))

    def detect(self, text: Column) -> Column:
        """Language of a raw text; NULL and texts without a known trigram are unknown."""
        return F.element_at(self.detect_each(F.array(text)), 1)


# Ship this module inside its UDF, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
