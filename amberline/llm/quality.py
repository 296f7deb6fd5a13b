"""Quality rules: a linear-chain CRF labels the lines of a text as content or boilerplate.

A line with a word is a step of the chain; its features are shares of kinds of characters and word statistics.  Viterbi
decoding gives the labels, and a document stays if enough of its words are in content lines and it passes the base rules.
Weights are fitted on the lines of at most ``fit_docs`` documents with a quality label, and of each on at most ``fit_lines`` lines in a row.  A line's training
label is that of its document, but for lines that several of these documents have: nearly all of them good ones, it is content in each of them; nearly all
bad ones, boilerplate.  So labels change inside documents, which is what the transitions are fitted on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec
from .common import map_arrow
from .line_dedup import line_spans, stripped

SYMBOLS = vec.byte_class(b"#*$%&|<>")
UPPERCASE = vec.byte_class(bytes(range(65, 91)))
DIGITS = vec.byte_class(bytes(range(48, 58)))
MARKS = vec.byte_class(bytes([*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]))
FEATURES = ("symbols", "marks", "capitals", "digits", "word_length", "words", "repeated_line", "repeated_words", "echoes", "bare_words")
WINDOW = 8
#: Bounds on what the weights are fitted on: documents, and lines of each.
FIT_DOCS, FIT_LINES = 2_000, 256
#: A line of so many fitted documents has a label of its own if this share of them, or more, has it.
COMMON_DOCS, COMMON_SHARE = 3, 0.8
CONTENT_SHARE = 0.5


@dataclass(frozen=True)
class Crf:
    """Scores: ``emit`` (features + 1 by 2 labels), ``step`` (from, to), ``begin``.  Label 0 is content, 1 boilerplate."""

    emit: np.ndarray
    step: np.ndarray
    begin: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        return features @ self.emit[:-1] + self.emit[-1]


#: Used where no labels of both kinds are given: many symbols, capitals or repeated words make boilerplate.
DEFAULT = Crf(np.array([[-8., 8.], [-2., 2.], [-2., 2.], [-1., 1.], [0., 0.], [0., 0.], [-.5, .5], [-1., 1.], [-4., 4.], [-4., 4.], [2., -2.]]),
              np.array([[.5, -.5], [-.5, .5]]), np.zeros(2))


def viterbi(crf: Crf, scores: np.ndarray) -> np.ndarray:
    """The best label sequence of one chain; content where scores are equal."""
    n = len(scores)
    rows = scores.tolist()
    (aa, ab), (ba, bb) = crf.step.tolist()
    a, b = rows[0][0] + float(crf.begin[0]), rows[0][1] + float(crf.begin[1])
    back = []
    for x, y in rows[1:]:
        to_a, to_b = (a + aa >= b + ba), (a + ab >= b + bb)
        back.append((to_a, to_b))
        a, b = (a + aa if to_a else b + ba) + x, (a + ab if to_b else b + bb) + y
    labels = np.zeros(n, dtype=np.int8)
    label = 0 if a >= b else 1
    labels[n - 1] = label
    for i in range(n - 2, -1, -1):
        label = 0 if back[i][label] else 1
        labels[i] = label
    return labels


def fit(chains: list[tuple[np.ndarray, int | np.ndarray]], rounds: int = 500, rate: float = 1.0, ridge: float = 1e-4) -> Crf:
    """Maximum likelihood by gradient ascent with forward-backward sums over all chains at once, sorted by length.

    A chain is the features of its lines and their labels, or one label for all.  Chains of a single label give ``DEFAULT``.
    """
    chains = sorted(((x, np.broadcast_to(np.asarray(y, dtype=np.int64), len(x))) for x, y in chains), key=lambda c: -len(c[0]))
    gold = np.concatenate([y for _, y in chains]) if chains else np.zeros(0, np.int64)
    if len(np.unique(gold)) < 2:
        return DEFAULT
    lengths = np.array([len(x) for x, _ in chains])
    width = chains[0][0].shape[1] + 1
    x = np.concatenate([np.c_[f, np.ones(len(f))] for f, _ in chains])
    first = np.r_[0, np.cumsum(lengths)[:-1]]
    weight = 1 / lengths / len(lengths)  # every document weighs as much
    alive = [int((lengths > t).sum()) for t in range(int(lengths[0]))]
    emit, step, begin = np.zeros((width, 2)), np.zeros((2, 2)), np.zeros(2)
    moments = [np.zeros_like(p) for p in (emit, step, begin)]
    gold_one = np.eye(2)[gold] * np.repeat(weight, lengths)[:, None]
    for _ in range(rounds):
        s = x @ emit
        forward, backward = np.empty_like(s), np.zeros_like(s)
        forward[first] = s[first] + begin
        for t in range(1, len(alive)):
            k = first[:alive[t]] + t
            forward[k] = s[k] + np.logaddexp(forward[k - 1, :1] + step[0], forward[k - 1, 1:] + step[1])
        for t in range(len(alive) - 1, 0, -1):
            k = first[:alive[t]] + t
            after = s[k] + backward[k]
            backward[k - 1] = np.logaddexp(after[:, :1] + step[:, 0], after[:, 1:] + step[:, 1])
        last = first + lengths - 1
        total = np.logaddexp(forward[last, 0], forward[last, 1])
        z = np.repeat(total, lengths)[:, None]
        marginal = np.exp(forward + backward - z) * np.repeat(weight, lengths)[:, None]
        pairs = np.zeros((2, 2))
        inner = np.ones(len(x), dtype=bool)
        inner[first] = False
        k = np.flatnonzero(inner)
        joint = np.exp(forward[k - 1][:, :, None] + step + (s[k] + backward[k])[:, None, :] - z[k][:, :, None])
        w = np.repeat(weight, lengths)[k]
        pairs = (joint * w[:, None, None]).sum(0)
        same = np.zeros((2, 2))
        np.add.at(same, (gold[k], gold[k]), w)
        gradients = (x.T @ (gold_one - marginal) - ridge * emit, same - pairs - ridge * step,
                     gold_one[first].sum(0) - marginal[first].sum(0) - ridge * begin)
        for p, g, m in zip((emit, step, begin), gradients, moments):
            m += g * g
            p += rate * g / np.sqrt(m + 1e-12)
    return Crf(emit, step, begin)


# --- statistics of a block of texts ----------------------------------------------------------

def _sum(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    upto = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return upto[ends] - upto[starts]


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags: has an equal key anywhere; has an equal key before it."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = k[1:] == k[:-1]
    either, later = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    later[order[1:][same]] = True
    either[order[1:][same]] = True
    either[order[:-1][same]] = True
    return either, later


class Block:
    """Counts for each text, and features of lines with words."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        a, b = offsets[:-1], offsets[1:]
        starts, ends, firsts = vec.word_spans(buf, offsets)
        solid, point = vec.NOT_SPACE[buf], (buf & 0xC0) != 0x80
        self.n_words = np.diff(firsts)
        self.word_chars = _sum(solid & point, a, b)
        self.n_symbols = _sum(SYMBOLS[buf], a, b)
        text_of_word = np.repeat(np.arange(len(a)), self.n_words)
        # words in windows that the same text has twice
        codes = vec.word_codes(buf, starts, ends)
        in_repeat = np.zeros(len(starts) + 1, dtype=np.int64)
        n = len(starts) - WINDOW + 1
        if n > 0:
            at = np.flatnonzero(text_of_word[:n] == text_of_word[WINDOW - 1:])
            keys = vec.mix(vec.Sums(codes).grams(WINDOW)[at] + text_of_word[at].astype(np.uint64) * vec.U64(0x9E3779B97F4A7C15))
            twice = at[_repeats(keys)[0]]
            np.add.at(in_repeat, twice, 1)
            np.add.at(in_repeat, twice + WINDOW, -1)
        repeated = np.cumsum(in_repeat)[:-1] > 0
        self.n_repeat_words = _sum(repeated, firsts[:-1], firsts[1:])
        echo = np.r_[False, codes[1:] == codes[:-1]][:len(codes)]
        bare = _sum(solid & ~MARKS[buf], starts, ends) == 0
        # lines
        ls, le, lf = line_spans(buf, offsets)
        p, q = stripped(buf, ls, le)
        lines = np.flatnonzero(q > p)
        text = np.searchsorted(lf, lines, side="right") - 1
        whole = vec.Sums(vec.BYTE_TABLES[0][buf]).slices(ls[lines], le[lines])
        self.line_keys = whole
        again = _repeats(vec.mix(whole + text.astype(np.uint64) * vec.U64(0x9E3779B97F4A7C15)))[1]
        self.n_dup_lines = np.bincount(text[again], minlength=len(a))
        self.line_firsts = np.searchsorted(text, np.arange(len(a) + 1))
        x, y = ls[lines], le[lines]
        w0, w1 = np.searchsorted(starts, x), np.searchsorted(starts, y)
        self.line_words = w1 - w0
        chars = np.maximum(_sum(solid & point, x, y), 1)
        self.features = np.stack([
            _sum(SYMBOLS[buf], x, y) / chars, _sum(MARKS[buf], x, y) / chars, _sum(UPPERCASE[buf], x, y) / chars, _sum(DIGITS[buf], x, y) / chars,
            np.minimum(chars / self.line_words, 20) / 10, np.log1p(self.line_words) / 5, again.astype(float),
            _sum(repeated, w0, w1) / self.line_words, _sum(echo, w0, w1) / self.line_words, _sum(bare, w0, w1) / self.line_words], axis=1)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _chains(fit_lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, keys = [], []
            for _, _, buf, offsets in vec.blocks(batch.column("text")):
                block = Block(buf, offsets)
                for a, b in zip(block.line_firsts.tolist(), block.line_firsts[1:].tolist()):
                    if b - a > fit_lines:  # lines in a row from a place that the text itself draws
                        a += int(block.line_keys[a:b].sum(dtype=np.uint64)) % (b - a - fit_lines + 1)
                        b = a + fit_lines
                    features.append(block.features[a:b].ravel().tolist())
                    keys.append(block.line_keys[a:b].view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(features, pa.list_(pa.float64())), pa.array(keys, pa.list_(pa.int64()))],
                                             names=["quality", "features", "keys"])

    return run


def line_labels(documents: list[tuple[int, list[int]]], docs: int = COMMON_DOCS, share: float = COMMON_SHARE) -> list[np.ndarray]:
    """Labels of the lines of (label, line keys) documents: the document's, or for a line of ``docs`` or more of them what a ``share`` of these has."""
    held = [np.unique(np.array(keys, dtype=np.int64)) for _, keys in documents]
    every = np.concatenate(held) if held else np.zeros(0, np.int64)
    kinds, place, counts = np.unique(every, return_inverse=True, return_counts=True)
    bad = np.bincount(place, weights=np.repeat([label for label, _ in documents], [len(h) for h in held]), minlength=len(kinds)) / np.maximum(counts, 1)
    common, least = counts >= docs, share - 1e-9
    own = np.where(common & (bad >= least), 1, np.where(common & (1 - bad >= least), 0, -1))
    out = []
    for label, keys in documents:
        said = own[np.searchsorted(kinds, np.array(keys, dtype=np.int64))] if keys else np.zeros(0, np.int64)
        out.append(np.where(said < 0, label, said))
    return out


def fit_on_labels(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, fit_lines: int = FIT_LINES) -> Crf:
    """A CRF from the documents of the ``fit_docs`` labels with the smallest hashed ids, at most ``fit_lines`` lines of each.

    Of an id's labels the smallest counts, and of its texts the first in their order.
    """
    key = F.xxhash64(F.lit("quality"), F.col("doc_id"))
    chosen = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
              .orderBy(key, "doc_id").limit(fit_docs))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = map_arrow(texts.select("quality", "text"), _chains(fit_lines), "quality int, features array<double>, keys array<long>")
    found = sorted((0 if r.quality else 1, list(r.keys), list(r.features)) for r in rows.collect() if r.features)  # at most fit_docs times fit_lines lines
    lines = line_labels([(label, keys) for label, keys, _ in found])
    return fit([(np.array(features).reshape(-1, len(FEATURES)), y) for (_, _, features), y in zip(found, lines)])


def _judge(block, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf: Crf = block.value
        for batch in batches:
            columns: dict[str, list] = {c: [] for c in (*COUNTS, "content_words", "base_failed", "kept")}
            for first, end, buf, offsets in vec.blocks(batch.column("_text")):
                b = Block(buf, offsets)
                scores = crf.scores(b.features)
                content = np.zeros(end - first, dtype=np.int64)
                for i, (x, y) in enumerate(zip(b.line_firsts[:-1].tolist(), b.line_firsts[1:].tolist())):
                    if y > x:
                        content[i] = b.line_words[x:y][viterbi(crf, scores[x:y]) == 0].sum()
                for c in COUNTS:
                    columns[c].append(getattr(b, c).astype(np.int64))
                failed = (b.n_words < 20) | (100 * b.n_repeat_words > 30 * b.n_words)
                columns["content_words"].append(content)
                columns["base_failed"].append(failed)
                columns["kept"].append(~failed & (content >= share * b.n_words))
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array(np.concatenate(v) if v else []) for v in columns.values()]],
                                             names=[*[f"c{i}" for i in range(len(kept))], *columns])

    return run


def judge(docs: DataFrame, crf: Crf, content_share: float = CONTENT_SHARE, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and counts, content_words, base_failed, kept for each row of ``docs``.

    A null text is an empty one: no words, so it fails the base rules.  Null and repeated ids are kept, one result per row; an
    empty table gives no rows; other columns, whatever their names, do not matter.
    """
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    schema = rows.drop("_text").schema
    for c in (*COUNTS, "content_words"):
        schema = schema.add(c, "long")
    schema = schema.add("base_failed", "boolean").add("kept", "boolean")
    spark = docs.sparkSession
    out = map_arrow(rows, _judge(spark.sparkContext.broadcast(crf), content_share), schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], *COUNTS, "content_words", "base_failed", "kept")
