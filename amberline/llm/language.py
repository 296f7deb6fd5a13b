"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  An n-gram binds its letters: the element-wise product of their vectors, each
rotated by its place.  A document is the sum (bundle) of its n-gram vectors, a language the sum of the unit vectors of its
documents, and the answer is the language with the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vec
from .common import checkpointed, map_arrow, small_side

DIMENSIONS = 1024
N = 3
#: About so many documents of each language are bundled into its profile.
FIT_PER_LANGUAGE = 1_000
UNKNOWN = "und"
SPACE = 32
CACHED_GRAMS = 16_384


@lru_cache(maxsize=1)
def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: is it a letter, and its lower case (where that is one letter)."""
    letter = np.zeros(0x110000, dtype=bool)
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            letter[i] = True
            low = c.lower()
            if low != c and len(low) == 1:
                lower[i] = ord(low)
    return letter, lower


class Grams:
    """Vectors of n-grams, given as codes of 21 bits a letter; the first ones met are kept."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.rows = np.zeros((CACHED_GRAMS, dimensions), dtype=np.int8)
        self.at: dict[int, int] = {}

    def letters(self, points: np.ndarray) -> np.ndarray:
        """Random vectors, drawn by hashing the code point."""
        words = self.dimensions // 64
        seeds = points.astype(np.uint64)[:, None] * vec.U64(words) + np.arange(words, dtype=np.uint64)
        bits = np.unpackbits(vec.mix(seeds * vec.U64(0x9E3779B97F4A7C15) + vec.U64(1)).view(np.uint8), axis=1)
        return bits.astype(np.int8) * np.int8(2) - np.int8(1)

    def bind(self, codes: np.ndarray) -> np.ndarray:
        out = np.ones((len(codes), self.dimensions), dtype=np.int8)
        for place in range(N):
            points = (codes >> vec.U64(21 * (N - 1 - place))) & vec.U64(0x1FFFFF)
            out *= np.roll(self.letters(points), N - 1 - place, axis=1)
        return out

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        listed = codes.tolist()
        at = np.array([self.at.get(c, -1) for c in listed])
        missing = np.flatnonzero(at < 0)
        total = np.zeros(self.dimensions, dtype=np.float32)
        for first in range(0, len(missing), 4096):
            part = missing[first:first + 4096]
            bound = self.bind(codes[part])
            room = min(len(part), CACHED_GRAMS - len(self.at))
            for i, j in enumerate(part[:room].tolist()):
                self.rows[len(self.at)] = bound[i]
                self.at[listed[j]] = len(self.at)
            total += counts[part].astype(np.float32) @ bound.astype(np.float32)
        known = np.flatnonzero(at >= 0)
        for first in range(0, len(known), 4096):
            part = known[first:first + 4096]
            total += counts[part].astype(np.float32) @ self.rows[at[part]].astype(np.float32)
        return total


@lru_cache(maxsize=1)
def grams(dimensions: int) -> Grams:
    return Grams(dimensions)


def profiles(buf: np.ndarray, offsets: np.ndarray, dimensions: int = DIMENSIONS) -> Iterator[np.ndarray | None]:
    """The bundle of each text of a block, None without a letter.  Whatever is no letter counts as one space; spaces frame the text."""
    letter, lower = letter_tables()
    points = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    starts = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))[offsets]
    points = lower[points]
    is_letter = letter[points]
    points = np.where(is_letter, points, SPACE).astype(np.uint64)
    source = grams(dimensions)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        here = is_letter[a:b]
        if not here.any():
            yield None
            continue
        keep = here.copy()
        keep[1:] |= here[:-1]
        x = np.concatenate(([vec.U64(SPACE)], points[a:b][keep], [vec.U64(SPACE)]))
        x = x[:-1] if x[-2] == SPACE else x
        codes, counts = np.unique(x[:-2] << vec.U64(42) | x[1:-1] << vec.U64(21) | x[2:], return_counts=True)
        yield source.bundle(codes, counts)


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for first, _, buf, offsets in vec.blocks(batch.column("text")):
            for i, v in enumerate(profiles(buf, offsets), first):
                if v is not None and (size := np.linalg.norm(v)):
                    total[langs[i]] = total.get(langs[i], 0) + v / size
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([v.astype(float).tolist() for v in total.values()])],
                                         names=["lang", "profile"])


def learn(docs: DataFrame, fit_per_language: int = FIT_PER_LANGUAGE) -> dict[str, np.ndarray]:
    """Unit profiles by language, from documents that are not held out and have a language.

    ``fit_per_language`` bounds how many documents of a language are taken, about: by a hash of the id below a share of its
    count.  The driver gets one vector per task and language that has any of these.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    shares = checkpointed(rows.groupBy("lang").count().select(F.col("lang").alias("_lang"), (F.lit(float(fit_per_language)) / F.col("count")).alias("_share")))
    draw = F.pmod(F.xxhash64(F.lit("language"), F.col("doc_id")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.join(small_side(shares), F.col("lang") == F.col("_lang")).where(draw < F.col("_share")).select("lang", "text")
    total: dict[str, np.ndarray] = {}
    for r in sorted(map_arrow(chosen, _sums, "lang string, profile array<double>").collect(), key=lambda r: (r.lang, r.profile)):
        total[r.lang] = total.get(r.lang, 0) + np.array(r.profile)
    return {lang: v / np.linalg.norm(v) for lang, v in sorted(total.items()) if np.linalg.norm(v)}


def _predict(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = block.value
        for batch in batches:
            answers, scores = [], []
            for _, _, buf, offsets in vec.blocks(batch.column("_text")):
                for v in profiles(buf, offsets):
                    if v is None or not names:
                        answers.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    cosine = matrix @ v / max(float(np.linalg.norm(v)), 1e-9)
                    best = int(np.argmax(cosine))
                    answers.append(names[best])
                    scores.append(min(1.0, max(0.0, float(cosine[best]))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(answers, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, languages: dict[str, np.ndarray]) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of ``docs``; the cosine, cut to 0..1, is the score.

    A text that is null or has no letter is ``und`` with score 0, as is every text if no language is known.  Of equally near languages
    the first by name wins.  Null and repeated ids are kept; an empty table gives no rows; other columns do not matter.
    """
    sc = docs.sparkSession.sparkContext
    matrix = np.array(list(languages.values()), dtype=np.float32)
    rows = docs.select("doc_id", held_out().alias("held_out"), F.col("text").alias("_text"))
    schema = rows.drop("_text").schema.add("lang_pred", "string").add("score", "double")
    return map_arrow(rows, _predict(sc.broadcast((list(languages), matrix))), schema)
