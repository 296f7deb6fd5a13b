"""Benchmark decontamination with a generalised suffix automaton of test items.

The automaton holds every run of consecutive words of the normalised items.  Documents stream through it
word by word; at each word it knows the longest run ending there that some item holds.  A window is ``min_words``
consecutive words of an item, or a whole shorter item.  Words whose pair with the next word is in no item
reset the automaton, so only stretches of known pairs are stepped through.

Items are read in blocks of at most ``block_words`` words, one automaton each, so what an executor holds has a fixed
bound however many items there are; every document passes every block.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec
from .common import map_arrow

MIN_WORDS = 10
BLOCK_WORDS = 500_000
#: Bytes of words after lower-casing: digits, a-z and everything beyond ASCII.
WORD_BYTES = vec.byte_class(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))


def words_of(text: str | None) -> list[bytes]:
    buf = vec.LOWER[np.frombuffer((text or "").encode(), dtype=np.uint8)]
    starts, ends, _ = vec.word_spans(buf, np.array([0, len(buf)]), WORD_BYTES)
    data = buf.tobytes()
    return [data[a:b] for a, b in zip(starts, ends)]


class Automaton:
    """Generalised suffix automaton over word numbers, with the windows that end in each state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], min_words: int = MIN_WORDS):
        self.min_words = min_words
        self.vocabulary: dict[bytes, int] = {}
        texts = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for name, words in items if words]
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, ids in texts:
            last = 0
            for w in ids:
                last = self._extend(last, w)
        self.shortest = min([min(min_words, len(ids)) for _, ids in texts], default=0)
        self._mark_windows(texts)
        spelled = list(self.vocabulary)
        codes = np.array([], dtype=np.uint64)
        if spelled:
            lengths = np.array([len(w) for w in spelled])
            ends = np.cumsum(lengths)
            codes = vec.word_codes(np.frombuffer(b"".join(spelled), dtype=np.uint8), ends - lengths, ends)
        order = np.argsort(codes, kind="stable")
        self.codes, self.numbers, self.spelled = codes[order], order, spelled
        pairs = {a * len(spelled) + b for _, ids in texts for a, b in zip(ids, ids[1:])}
        self.pairs = np.array(sorted(pairs), dtype=np.int64)

    def _new(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.step) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        clone = self._new(self.length[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        q = self.step[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        new = self._new(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.step[p]:
            self.step[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new

    def _mark_windows(self, texts: list[tuple[str, list[int]]]) -> None:
        """For each state, the items with a window of ``min_words`` there, and the short items that end there."""
        self.windows: dict[int, list[str]] = {}
        self.shorts: dict[int, list[tuple[int, str]]] = {}
        for name, ids in texts:
            state = n = 0
            for at, w in enumerate(ids):
                state, n = self.advance(state, n, w)
                if n >= self.min_words:
                    held = self.windows.setdefault(self.up_to(state, self.min_words), [])
                    if not held or held[-1] != name:
                        held.append(name)
            if len(ids) < self.min_words:
                self.shorts.setdefault(self.up_to(state, len(ids)), []).append((len(ids), name))
        self.short_above = [0] * len(self.step)  # nearest state by links, itself included, with short items
        for state in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            self.short_above[state] = state if state in self.shorts else self.short_above[self.link[state]]

    def up_to(self, state: int, n: int) -> int:
        """The state of the last n words of a state's string."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def advance(self, state: int, n: int, w: int) -> tuple[int, int]:
        """The longest run of item words that ends with w."""
        while state and w not in self.step[state]:
            state = self.link[state]
            n = self.length[state]
        to = self.step[state].get(w)
        return (to, n + 1) if to is not None else (0, 0)

    def hits(self, ids: list[int]) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, word after the last, items) of the windows that end at each word."""
        state = n = 0
        for at, w in enumerate(ids):
            state, n = self.advance(state, n, w)
            if n >= self.min_words:
                yield at + 1 - self.min_words, at + 1, self.windows[self.up_to(state, self.min_words)]
            short = self.short_above[state] if n else 0
            while short:
                for m, name in self.shorts[short]:
                    if m <= n:
                        yield at + 1 - m, at + 1, [name]
                short = self.short_above[self.link[short]] if self.link[short] > 0 else 0

    def scan(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, firsts: np.ndarray) -> dict[int, tuple[list, set]]:
        """By text: its hit stretches as (first word, end word) counted in the block, and the items."""
        found: dict[int, tuple[list, set]] = {}
        if not len(starts) or not len(self.codes):
            return found
        codes = vec.word_codes(buf, starts, ends)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        known = self.codes[at] == codes
        ids = np.where(known, self.numbers[at], -1)
        pair = np.where(known[:-1] & known[1:], ids[:-1] * len(self.spelled) + ids[1:], -1)
        joined = np.zeros(len(ids) + 1, dtype=bool)  # a word and the one before it, in the same text
        if len(self.pairs) and len(pair):
            p = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joined[1:-1] = self.pairs[p] == pair
        joined[firsts[:-1]] = False
        joined[len(ids)] = False
        begin = np.flatnonzero(known & ~joined[:-1])
        if not len(begin):
            return found
        stop = np.flatnonzero(known & ~joined[1:]) + 1
        long_enough = stop - begin >= self.shortest
        begin, stop = begin[long_enough], stop[long_enough]
        text = np.searchsorted(firsts, begin, side="right") - 1
        data = None
        for a, b, t in zip(begin.tolist(), stop.tolist(), text.tolist()):
            run = ids[a:b].tolist()
            for x, y, names in self.hits(run):
                data = data if data is not None else buf.tobytes()
                if all(data[starts[a + i]:ends[a + i]] == self.spelled[run[i]] for i in range(x, y)):  # not only equal hashes
                    spans, items = found.setdefault(t, ([], set()))
                    if spans and spans[-1][1] >= a + x:
                        spans[-1][0], spans[-1][1] = min(spans[-1][0], a + x), max(spans[-1][1], a + y)
                    else:
                        spans.append([a + x, a + y])
                    items.update(names)
        return found


_built: OrderedDict[tuple, Automaton] = OrderedDict()


def _automaton(block, min_words: int) -> Automaton:
    """The automaton of a broadcast block, by the block's name; a worker keeps the two used last."""
    name, items = block.value
    key = (name, min_words)
    if key not in _built:
        while len(_built) > 1:
            _built.popitem(last=False)
        _built[key] = Automaton([(item, words_of(text)) for item, text in items], min_words)
    _built.move_to_end(key)
    return _built[key]


def item_blocks(items: DataFrame, key: str, text: str, block_words: int) -> list:
    """Broadcast blocks (unique name, [(item id, text), ...]).  Items stream to the driver, which holds one block at a time."""
    sc = items.sparkSession.sparkContext
    out, block, size = [], [], 0
    for name, body in items.select(F.col(key).cast("string"), F.col(text)).where(F.col(text).isNotNull()).toLocalIterator():
        n = len(words_of(body))
        if block and size + n > block_words:
            out.append(sc.broadcast((uuid4().hex, block)))
            block, size = [], 0
        block.append((name if name is not None else "null", body))
        size += n
    return [*out, sc.broadcast((uuid4().hex, block))] if block else out


def match_items(docs: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, block_words: int = BLOCK_WORDS, key: str = "doc_id",
                text: str = "text", item_key: str = "item_id", item_text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, spans) and the columns ``keep`` for each row of ``docs``.

    ``spans`` are the byte ranges from the first to behind the last word of each hit stretch.  Null and empty texts have no words;
    null items and items without words are in nothing; items with the same id count once, a null id reads "null".
    Null and repeated keys are kept, one result per row.  Empty tables: no rows, or no hits.
    """
    blocks = item_blocks(items, item_key, item_text, block_words)
    base = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)])
    schema = base.drop("_text").schema
    for name, kind in (("n_words", "long"), ("n_hit", "long"), ("n_items", "long"), ("items_sha256", "string"),
                       ("spans", "array<struct<first:int,end:int>>")):
        schema = schema.add(name, kind if "<" not in kind else _span_type())
    base = base.select("_key", *[f"_k{i}" for i in range(len(keep))], "_text")
    found = map_arrow(base, _matcher(blocks, min_words), schema)
    return found.select(F.col("_key").alias(key), *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
                        "n_words", "n_hit", "n_items", "items_sha256", "spans")


def _span_type():
    from pyspark.sql import types as T

    return T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def _matcher(blocks: list, min_words: int):
    span_type = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = []
            for first, end, buf, offsets in vec.blocks(batch.column("_text")):
                buf = vec.LOWER[buf]
                pieces.append((end - first, offsets, buf, *vec.word_spans(buf, offsets, WORD_BYTES), {}, {}))
            for block in blocks:  # an automaton is needed once for all pieces of a batch
                automaton = _automaton(block, min_words) if pieces else None
                for _, _, buf, starts, ends, firsts, covered, names in pieces:
                    for t, (ranges, items) in automaton.scan(buf, starts, ends, firsts).items():
                        covered.setdefault(t, []).extend(ranges)
                        names.setdefault(t, set()).update(items)
            n_words, n_hit, n_items, digests, spans = [], [], [], [], []
            for size, offsets, _, starts, ends, firsts, covered, names in pieces:
                n_words.extend(np.diff(firsts).tolist())
                for t in range(size):
                    merged: list[list[int]] = []
                    for a, b in sorted(covered.get(t, ())):
                        if merged and a <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], b)
                        else:
                            merged.append([a, b])
                    n_hit.append(sum(b - a for a, b in merged))
                    found = sorted(names.get(t, ()))
                    n_items.append(len(found))
                    digests.append(hashlib.sha256(",".join(found).encode()).hexdigest())
                    spans.append([{"first": int(starts[a] - offsets[t]), "end": int(ends[b - 1] - offsets[t])} for a, b in merged])
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()),
                 pa.array(digests, pa.string()), pa.array(spans, span_type)],
                names=[*[batch.schema.field(i).name for i in range(batch.num_columns - 1)], "n_words", "n_hit", "n_items",
                       "items_sha256", "spans"])

    return run


def decontaminate(docs: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, max_coverage: float = 0.5, key: str = "doc_id",
                  text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the words that are in windows of items; documents with a larger hit share than ``max_coverage`` go.

    A hit stretch is replaced by a line break.  Words that meet there could make a new window, so cutting is repeated
    until there is none.  All columns are kept (``n_chars`` as it was); rows without hits are not changed.
    """
    blocks = item_blocks(items, "item_id", "text", block_words)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = _matcher(blocks, min_words)
        for batch in batches:
            texts, todo = batch.column(at), np.arange(batch.num_rows)
            keep = np.ones(batch.num_rows, dtype=bool)
            changed: dict[int, str] = {}
            while len(todo):
                part = pa.array([changed.get(i, None) if i in changed else texts[i].as_py() for i in todo.tolist()], pa.string()) \
                    if changed else texts
                found = next(match(iter([pa.RecordBatch.from_arrays([part], names=["_text"])])))
                hit = np.flatnonzero(np.asarray(found.column("n_hit")) > 0)
                again = []
                for j in hit.tolist():
                    i = int(todo[j])
                    if i not in changed and found.column("n_hit")[j].as_py() > max_coverage * found.column("n_words")[j].as_py():
                        keep[i] = False
                        continue
                    data, out, last = part[j].as_py().encode(), [], 0
                    for span in found.column("spans")[j].as_py():
                        out.append(data[last:span["first"]])
                        last = span["end"]
                    changed[i] = b"\n".join([*out, data[last:]]).decode()
                    again.append(i)
                todo = np.array(again, dtype=np.int64)
            if changed:
                texts = pa.array([changed[i] if i in changed else texts[i].as_py() for i in range(batch.num_rows)], batch.schema.field(at).type)
            columns = [texts if c == at else batch.column(c) for c in range(batch.num_columns)]
            out = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield out if keep.all() else out.filter(pa.array(keep))

    return map_arrow(docs, run, docs.schema)
