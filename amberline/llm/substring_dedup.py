"""Substring dedup by seed and extension: repeated passages of words, wherever they are, same document included.

Seeds are winnowed anchors, a few words chosen so that every window of ``length`` words holds one.  Documents meet at equal seeds, first with
the whole context of the seed, by hash: equal contexts match as a whole.  Where contexts of a seed differ, the matches are extended from it word by word, to the left
and to the right, all occurrences of a seed at once: occurrences that agree so far are a class, the next word splits it, and who is alone
goes no further.  A window is a repeat if, with its words left of the seed and its words right of it, it still has company.  No pair of
occurrences is ever formed.  Windows that are anywhere else too are merged into maximal repeats.  Occurrences arrive sorted by seed in blocks of
bounded size; only what a seed too common for one block has left goes through one more grouping, by 128-bit hashes of windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats, vec
from .common import checkpointed, doc_key, free_shuffles, map_arrow, text_mark

LENGTH = 35
SEED = 12
BLOCK = 1 << 22


def _word_codes(buf: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, firsts = vec.word_spans(buf, offsets)
    return [vec.word_codes(buf, starts, ends, i) for i in (0, 1)], firsts, starts, ends


CONTEXTS = "key long, doc long, mark long, loc long, place int, body binary"


def _contexts(length: int, seed: int):
    """The word codes of the contexts that are left to compare, with their seeds and the place of the seed in the context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, mark = np.asarray(batch.column("doc")), np.asarray(batch.column("mark"))
            left, at = batch.column("left").values, batch.column("left").offsets.to_numpy()
            locs, keys = left.field("loc").to_numpy(), left.field("key").to_numpy()
            for first, end, buf, offsets in vec.blocks(batch.column("text")):
                text = np.repeat(np.arange(end - first), np.diff(at[first:end + 1]))
                if not len(text):
                    continue
                starts, ends, firsts = vec.word_spans(buf, offsets)
                codes = vec.word_codes(buf, starts, ends)
                loc, key = locs[at[first]:at[end]], keys[at[first]:at[end]]
                lo, count, _ = repeats.unpack(loc)
                begin, sizes = firsts[text] + lo, count + length - 1
                # the seed is the first of its kind in the context: a window takes the leftmost one
                sums, place = vec.Sums(codes), np.full(len(text), -1)
                for i in range(length - seed, -1, -1):
                    a = np.minimum(begin + i, len(codes) - seed)
                    place[(sums.slices(a, a + seed).view(np.int64) == key) & (a == begin + i)] = i
                total = np.concatenate(([0], np.cumsum(sizes)))
                body = codes[np.repeat(begin - total[:-1], sizes) + np.arange(total[-1])]
                bodies = pa.Array.from_buffers(pa.large_binary(), len(text), [None, pa.py_buffer(total.astype(np.int64) * 8), pa.py_buffer(body)])
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc[first + text]), pa.array(mark[first + text]), pa.array(loc),
                                                  pa.array(place.astype(np.int32)), bodies.cast(pa.binary())], names=["key", "doc", "mark", "loc", "place", "body"])

    return run


def _split(classes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Classes by (class, word); -1 for who is in a class (-1) no more, or alone in it."""
    out = np.full(len(classes), -1)
    live = np.flatnonzero(classes >= 0)
    order = live[np.lexsort((words[live], classes[live]))]
    c, w = classes[order], words[order]
    new = np.r_[True, (c[1:] != c[:-1]) | (w[1:] != w[:-1])][:len(order)]
    group = np.cumsum(new) - 1
    several = np.bincount(group)[group] > 1 if len(order) else np.zeros(0, bool)
    out[order[several]] = group[several]
    return out


def extend(key: np.ndarray, place: np.ndarray, count: np.ndarray, offsets: np.ndarray, codes: np.ndarray, length: int, seed: int) -> list[np.ndarray]:
    """For each number of words left of the seed, the occurrences whose window with so many is also that of another one.

    Occurrence i has the words ``codes[offsets[i]:offsets[i + 1]]``, its seed ``place[i]`` words into them, and ``count[i]`` windows.
    """
    reach, at = length - seed, offsets[:-1] + place
    room_left, room_right = place, offsets[1:] - at - seed
    start = _split(np.zeros(len(key), np.int64), key)
    right = [start]
    for r in range(1, reach + 1):
        inside = room_right >= r
        word = codes[np.where(inside, at + seed + r - 1, 0)]
        right.append(_split(np.where(inside, right[-1], -1), word))
    left, out = start, []
    for n in range(reach + 1):
        if n:
            inside = room_left >= n
            left = _split(np.where(inside, left, -1), codes[np.where(inside, at - n, 0)])
        begins = place - n  # the window's place in the context
        both = np.where((right[reach - n] >= 0) & (begins >= 0) & (begins < count), left, -1)
        out.append(np.flatnonzero(_split(both, right[reach - n]) >= 0))
    return out


def _compare(length: int, seed: int):
    """Rows for ``repeats.settle`` from a block of contexts: runs of repeated windows and, if the block has not all of a seed, its windows one by one."""

    def run(table: pa.Table, whole: bool) -> Iterator[pa.RecordBatch]:
        key, doc, mark, loc, place = (table.column(c).to_numpy() for c in ("key", "doc", "mark", "loc", "place"))
        bodies = table.column("body").combine_chunks().cast(pa.large_binary())
        offsets = np.frombuffer(bodies.buffers()[1], dtype=np.int64)[bodies.offset:bodies.offset + len(bodies) + 1]
        codes = np.frombuffer(bodies.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]].view(np.uint64)
        offsets = (offsets - offsets[0]) // 8
        lo, count, kind = repeats.unpack(loc)
        found = extend(key, place, count, offsets, codes, length, seed)
        owner = np.concatenate(found)
        window = np.concatenate([place[f] - n for n, f in enumerate(found)])
        order = np.lexsort((window, owner))
        owner, window = owner[order], window[order]
        begin = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (window[1:] != window[:-1] + 1)][:len(owner)])
        runs, of = np.diff(np.append(begin, len(owner))), owner[begin]
        settled = repeats.pack(lo[of] + window[begin], runs, repeats.SETTLED)
        spread = vec.mix(doc[of].view(np.uint64) + settled.view(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (spread, spread * 0, doc[of], mark[of], settled)], names=repeats.FIELDS)
        if whole:
            return
        every = np.repeat(np.arange(len(key)), count)
        step = np.arange(len(every)) - np.repeat(np.cumsum(count) - count, count)
        known = kind[every] == repeats.KNOWN
        known[(np.cumsum(count) - count)[owner] + window] = True
        a = offsets[every] + step
        hashes = [vec.Sums(c, i).slices(a, a + length).view(np.int64) for i, c in enumerate((codes, vec.mix(codes)))]
        rest = repeats.Collapse(False)
        yield from rest.add(*hashes, doc[every], mark[every], repeats.pack(lo[every] + step, np.ones(len(every), np.int64), np.where(known, repeats.KNOWN, repeats.OPEN)))
        yield from rest.flush()

    return run


def repeated_words(docs: DataFrame, length: int = LENGTH, seed: int = SEED, block: int = BLOCK, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, mark, spans): maximal ranges of words, first and end in turn, covered by windows that also start anywhere else.

    The result does not depend on ``block``, the bytes of contexts that are extended together.
    """
    texts = docs.select(doc_key(key).alias("doc"), text_mark(text).alias("mark"), F.col(text).alias("text"))

    def cut(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        codes, firsts, _, _ = _word_codes(buf, offsets)
        return repeats.runs(codes, firsts, seed, length, length - seed + 1)

    found = checkpointed(repeats.per_document(repeats.settle(repeats.run_rows(texts, cut, False), False, True)))
    free_shuffles(found)
    beside = repeats.beside_text(texts, found.select("doc", "mark", "left").where(F.size("left") > 0), "left", "inner")
    contexts = map_arrow(beside.select("doc", "mark", "text", "left"), _contexts(length, seed), CONTEXTS)
    ordered = contexts.repartition("key").sortWithinPartitions("key", "doc", "mark", "loc")
    extended = map_arrow(ordered, repeats.in_blocks(_compare(length, seed), block), repeats.ROWS)
    return repeats.spans_of(repeats.settled_of(found, repeats.per_document(repeats.settle(extended, False, False))), length)


def _apply(width: int, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, total, removed, digests = [], [], [], []
            lists = batch.column(width).to_pylist()
            for first, end, buf, offsets in vec.blocks(batch.column(at)):
                starts, ends, firsts = vec.word_spans(buf, offsets)
                data = buf.tobytes()
                for i, (a, b) in enumerate(zip(firsts[:-1].tolist(), firsts[1:].tolist())):
                    keep = np.ones(b - a, dtype=bool)
                    spans = lists[first + i] or ()
                    for x, y in zip(spans[::2], spans[1::2]):
                        keep[x:y] = False
                    x, y = starts[a:b][keep].tolist(), ends[a:b][keep].tolist()
                    kept = b" ".join([data[p:q] for p, q in zip(x, y)])
                    out.append(kept.decode())
                    total.append(b - a)
                    removed.append(b - a - len(x))
                    digests.append(hashlib.sha256(kept).hexdigest())
            columns = [pa.array(out, batch.schema.field(at).type) if c == at else batch.column(c) for c in range(width)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                                             names=[*[f"c{i}" for i in range(width)], "n_words", "n_removed", "kept_sha256"])

    return run


def drop_repeated_words(docs: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with texts cut to the kept words, joined by one space, and n_words, n_removed, kept_sha256.

    Null and empty texts become empty.  Rows with the same id are judged by their own texts, and identical rows are repeats of each
    other; rows with null ids are documents too.  Empty table: no rows.  Other columns, whatever their names, are carried along.
    """
    names = docs.columns
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], doc_key(key).alias("doc"), text_mark(text).alias("mark"))
    joined = repeats.beside_text(rows, spans, "spans", "left").select(*[f"c{i}" for i in range(len(names))], "spans")
    schema = joined.drop("spans").schema.add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string")
    out = map_arrow(joined, _apply(len(names), names.index(text)), schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "n_words", "n_removed", "kept_sha256")
