"""Operator 10, language identification with hyperdimensional profiles.

Each letter, by code point and without case, has a random vector of +1 and -1 of its own. A trigram's vector binds (multiplies) the letters' vectors, each permuted
(rotated) by its place; a text's vector bundles (adds) those of its trigrams. A language's prototype bundles the texts known
to be in it, and a text gets the language whose prototype has the greatest cosine with it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspire.llm.common import free_name, map_arrow

#: Length of the vectors, and the seed of the letters'.
DIMENSIONS, SEED = 1024, 7
#: At most about so many labelled rows are learned from (a hash of doc_id picks them).
TRAIN_ROWS = 20_000
#: The code of a gap between words; a letter's is its code point. Bits of a code in a trigram.
GAP, CODE_BITS = 0, 21
#: In a filtering stage, a text under this cosine with every language goes: three standard deviations of the cosine of
#: random vectors; for texts of less than SHORT code points, whose few trigrams may all be rare ones, one.
LEAST_COSINE, LEAST_COSINE_SHORT, SHORT = 3 / DIMENSIONS**0.5, 1 / DIMENSIONS**0.5, 64


def _code(point: int) -> int:
    if 0xD800 <= point < 0xE000 or not chr(point).isalpha():
        return GAP
    return ord(chr(point).lower()[0])


_TABLE: list[np.ndarray] = []


def codes_of(text: str) -> np.ndarray:
    """Letter codes of a text, lower-cased, with each run of other characters as one gap, and gaps at both ends."""
    if not _TABLE:
        _TABLE.append(np.array([_code(c) for c in range(1 << 16)], np.int64))
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _TABLE[0][np.minimum(points, 0xFFFF)]
    for i in np.flatnonzero(points > 0xFFFF):
        codes[i] = _code(int(points[i]))
    codes = np.concatenate([[GAP], codes, [GAP]])
    return codes[np.concatenate([[True], (codes[1:] != GAP) | (codes[:-1] != GAP)])]


def grams_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct trigrams of a text and how often each occurs; none if it has no letter."""
    c = codes_of(text)
    if len(c) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.unique((c[:-2] << (2 * CODE_BITS)) | (c[1:-1] << CODE_BITS) | c[2:], return_counts=True)


class Bundler:
    """Sums of trigram vectors. The vectors of trigrams met so far are kept, up to ``most`` rows; others are bound anew."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED, most: int = 12_000):
        self.dimensions, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}
        self.known, self.place = np.zeros(0, np.int64), np.zeros(0, np.int64)  # kept trigrams, sorted, and their rows
        self.kept = np.zeros((most, dimensions), np.float32)

    def letter(self, code: int) -> np.ndarray:
        """The vector of a code: drawn from the seed and the code alone, so every task has the same."""
        got = self.letters.get(code)
        if got is None:
            got = self.letters[code] = np.random.default_rng([self.seed, code]).integers(0, 2, self.dimensions).astype(np.float32) * 2 - 1
        return got

    def bind(self, grams: np.ndarray) -> np.ndarray:
        mask = (1 << CODE_BITS) - 1
        codes, at = np.unique(np.concatenate([grams >> (2 * CODE_BITS), (grams >> CODE_BITS) & mask, grams & mask]), return_inverse=True)
        letters = np.array([self.letter(int(c)) for c in codes], np.float32).reshape(len(codes), self.dimensions)
        first, second, third = at.reshape(3, -1)
        return np.roll(letters, 2, axis=1)[first] * np.roll(letters, 1, axis=1)[second] * letters[third]

    def _rows(self, grams: np.ndarray) -> np.ndarray:
        """The kept row of each trigram, -1 where there is none."""
        if not len(self.known):
            return np.full(len(grams), -1)
        at = np.minimum(np.searchsorted(self.known, grams), len(self.known) - 1)
        return np.where(self.known[at] == grams, self.place[at], -1)

    def bundle(self, text: str) -> np.ndarray:
        grams, n = grams_of(text)
        rows, used = self._rows(grams), len(self.known)
        new = grams[rows < 0][: len(self.kept) - used]
        if len(new):
            self.kept[used : used + len(new)] = self.bind(new)
            at = np.searchsorted(self.known, new)
            self.known, self.place = np.insert(self.known, at, new), np.insert(self.place, at, np.arange(used, used + len(new)))
            rows = self._rows(grams)
        known = rows >= 0
        out = n[known].astype(np.float32) @ self.kept[rows[known]]
        return out if known.all() else out + n[~known].astype(np.float32) @ self.bind(grams[~known])


def has_letter(text: str | None) -> bool:
    return text is not None and any(unicodedata.category(x)[0] == "L" for x in text)


def in_training(doc_id: str = "doc_id"):
    """False for the held-out quarter: crc32 of doc_id as text leaves 2 by 4. A null doc_id is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 != 2, F.lit(False))


def learn(docs: DataFrame, most_rows: int = TRAIN_ROWS) -> dict[str, np.ndarray]:
    """The prototype of each language, of unit length, from about ``most_rows`` rows of the training part of ``docs``.

    Each task returns one vector a language; the driver adds them.
    """
    labelled = docs.where(in_training() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    n = labelled.select("doc_id").count()
    if n > most_rows:
        labelled = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1_000_000)) < int(1_000_000 * most_rows / n))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        bundler = Bundler()
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                v = bundler.bundle(text)
                if norm := np.linalg.norm(v):
                    total[lang] = total.get(lang, np.zeros(DIMENSIONS)) + v / norm
        if total:
            yield pa.RecordBatch.from_pydict({"lang": pa.array(list(total), pa.string()), "v": pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))})

    got = map_arrow(labelled.select("text", "lang"), sums, "lang string, v array<double>")
    by_place = got.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x")).collect()
    out: dict[str, np.ndarray] = {}
    for lang, i, x in by_place:
        out.setdefault(lang, np.zeros(DIMENSIONS))[i] = x
    return {lang: v / np.linalg.norm(v) for lang, v in sorted(out.items()) if np.linalg.norm(v)}


def with_language(docs: DataFrame, prototypes: dict[str, np.ndarray], lang_column: str, score_column: str) -> DataFrame:
    """``docs`` with the two columns of ``identify`` under free names."""
    names, matrix = list(prototypes), np.array(list(prototypes.values()), np.float32).reshape(len(prototypes), DIMENSIONS)
    at = docs.columns.index("text")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler = Bundler()
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(at).to_pylist():
                lang, score = "und", 0.0
                if names and has_letter(text):
                    v = bundler.bundle(text)
                    cosines = matrix @ v / max(float(np.linalg.norm(v)), 1e-9)
                    lang, score = names[int(cosines.argmax())], float(min(1, max(0, cosines.max())))
                langs.append(lang)
                scores.append(score)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, lang_column, score_column])

    return map_arrow(docs, predict, docs.select("*", F.lit("").cast("string").alias(lang_column), F.lit(0.0).alias(score_column)).schema)


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> DataFrame:
    """``docs`` with lang_pred and score, the cosine with that language's prototype cut to 0..1. Text null or without a letter, or nothing learned: ``und`` and 0. Ties go to the language first in the alphabet. Columns of these names are replaced."""
    return with_language(docs.drop("lang_pred", "score"), prototypes, "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = LEAST_COSINE, least_short: float = LEAST_COSINE_SHORT) -> DataFrame:
    """The filtering stage: only documents with a language, known with a cosine of at least ``least`` (``least_short``, if shorter than SHORT); columns as in ``docs``."""
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "score")
    known = with_language(docs, learn(docs), lang, score)
    return known.where((F.col(lang) != "und") & (F.col(score) >= F.when(F.length("text") < SHORT, least_short).otherwise(least))).select(*docs.columns)


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    """The predicted language of each document. A null doc_id counts as not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", (~in_training() & F.col("doc_id").isNotNull()).alias("held_out"), "lang_pred", "score")


QUERIES = {"op10_language_id": op10_language_id}
SQL: dict[str, str] = {}
