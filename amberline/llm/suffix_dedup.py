"""Suffix-array dedup: bytes covered by long strings that also start in a document with a smaller id.

Suffix arrays (``suffix_array``) decide which 50-byte strings are equal.  Sorting all suffixes in Python would cost microseconds a byte, so
what needs no comparison is taken out first: winnowed anchors that occur once, and whole contexts of an
anchor that are copies of each other (see ``repeats``).  The contexts that share an anchor but differ meet in blocks; strings that are
nowhere twice by their hashes are left out, and the rest of a block is sorted.  Only blocks of an anchor that is too common for
one block need strings of several blocks compared; these go through one more grouping by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import repeats, vec
from .common import checkpointed, doc_key, free_shuffles, map_arrow, text_mark
from .suffix_array import equal_windows

LENGTH = 50
#: Anchors are chosen by 12 bytes and told apart by 31 bytes around them.
SEED, REACH = 12, 20
#: Bits of the bitmap of repeated anchors (16 MB at any input size), used for inputs of at most so many partitions.
BITMAP_BITS = 27
BITMAP_PARTITIONS = 256
BLOCK = 1 << 21
#: The lists beside the texts grow with them: only those of small tables are broadcast, so that disk grows in proportion from there on.
LIST_BYTES = 1 << 20


def _cutter(length: int, seed: int, reach: int, contexts: bool = True):
    def cut(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        return repeats.runs([vec.BYTE_TABLES[i][buf] for i in ((0, 1) if contexts else (0,))], offsets, seed, length, reach, contexts)

    return cut


def repeated_anchors(texts: DataFrame, length: int, seed: int, reach: int) -> np.ndarray:
    """A bitmap with a bit set for every anchor hash (its leading bits) that occurs twice."""
    cut = _cutter(length, seed, reach, contexts=False)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            k = np.sort(np.concatenate(held))
            thrice = np.r_[False, False, k[2:] == k[:-2]][:len(k)]  # two of a kind say enough
            return pa.RecordBatch.from_arrays([pa.array(k[~thrice])], names=["key"])

        for batch in batches:
            for _, _, buf, offsets in vec.blocks(batch.column("text")):
                held.append(cut(buf, offsets)[3])
                size += len(held[-1])
                if size >= 4 * repeats.FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = np.sort(np.concatenate([np.zeros(0, np.int64), *[np.asarray(b.column("key")) for b in batches]]))
        again = np.unique(k[1:][k[1:] == k[:-1]].view(np.uint64) >> vec.U64(64 - BITMAP_BITS))
        yield pa.RecordBatch.from_arrays([pa.array(again.astype(np.int64) + 1)], names=["bit"])

    met = map_arrow(map_arrow(texts.select("text"), keys, "key long").repartition("key"), twice, "bit long")
    pages = (met.groupBy(F.bitmap_bucket_number("bit").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
             .collect())  # at most 2 ** BITMAP_BITS bits
    out = np.zeros(1 << BITMAP_BITS >> 3, dtype=np.uint8)
    for r in pages:  # numbers count from 1: page p holds 1 + (p - 1) * 32768 and the following ones
        out[(r.page - 1) * 4096:r.page * 4096] = np.frombuffer(bytes(r.bits), dtype=np.uint8)
    return out


def _filtered(cut, block):
    def run(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        text, lo, count, key, ctx = cut(buf, offsets)
        bit = key.view(np.uint64) >> vec.U64(64 - BITMAP_BITS)
        keep = (block.value[(bit >> vec.U64(3)).astype(np.int64)] >> (bit & vec.U64(7)).astype(np.uint8)) & 1 > 0
        return text[keep], lo[keep], count[keep], key[keep], ctx[keep]

    return run


CONTEXTS = "key long, doc long, mark long, loc long, body binary"


def _contexts(length: int):
    """The bytes of the contexts that are left to compare, with their anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, mark = np.asarray(batch.column("doc")), np.asarray(batch.column("mark"))
            left, at = batch.column("left").values, batch.column("left").offsets.to_numpy()
            locs, keys = left.field("loc").to_numpy(), left.field("key").to_numpy()
            for first, end, buf, offsets in vec.blocks(batch.column("text")):
                text = np.repeat(np.arange(end - first), np.diff(at[first:end + 1]))
                if not len(text):
                    continue
                loc = locs[at[first]:at[end]]
                lo, count, _ = repeats.unpack(loc)
                begin = offsets[text] + lo
                sizes = count + length - 1
                total = np.concatenate(([0], np.cumsum(sizes)))
                body = buf[np.repeat(begin - total[:-1], sizes) + np.arange(total[-1])]
                bodies = pa.Array.from_buffers(pa.large_binary(), len(text), [None, pa.py_buffer(total.astype(np.int64)), pa.py_buffer(body)])
                yield pa.RecordBatch.from_arrays([pa.array(keys[at[first]:at[end]]), pa.array(doc[first + text]), pa.array(mark[first + text]),
                                                  pa.array(loc), bodies.cast(pa.binary())], names=["key", "doc", "mark", "loc", "body"])

    return run


def compare(doc: np.ndarray, mark: np.ndarray, loc: np.ndarray, bodies: pa.Array, length: int, whole: bool) -> pa.RecordBatch:
    """Rows for ``repeats.settle``: settled runs of a block and, if it is not ``whole``, its other windows."""
    bodies = bodies.cast(pa.large_binary())
    offsets = np.frombuffer(bodies.buffers()[1], dtype=np.int64)[bodies.offset:bodies.offset + len(bodies) + 1]
    data = np.frombuffer(bodies.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    lo, count, _ = repeats.unpack(loc)
    owner = np.repeat(np.arange(len(loc)), count)
    at = offsets[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    sums = vec.Sums(vec.BYTE_TABLES[0][data])
    h = sums.slices(at, at + length)
    # windows that may be in two documents
    order = np.argsort(h, kind="stable")
    starts = np.flatnonzero(np.r_[True, h[order][1:] != h[order][:-1]])
    of = doc[owner[order]]
    spread = np.minimum.reduceat(of, starts) < np.maximum.reduceat(of, starts) if len(starts) else np.zeros(0, bool)
    maybe = np.zeros(len(at), dtype=bool)
    maybe[order] = np.repeat(spread, np.diff(np.append(starts, len(order))))
    settled = np.zeros(len(at), dtype=bool)
    if maybe.any():
        m = np.flatnonzero(maybe)
        fresh = np.r_[True, (m[1:] != m[:-1] + 1) | (owner[m[1:]] != owner[m[:-1]])]
        begin = np.flatnonzero(fresh)
        last = np.append(begin[1:] - 1, len(m) - 1)
        start, end = at[m[begin]], at[m[last]] + length
        # equal strings are sorted once
        raw, seen = data.tobytes(), {}
        same_as = np.array([seen.setdefault(raw[x:y], i) for i, (x, y) in enumerate(zip(start.tolist(), end.tolist()))])
        once = np.flatnonzero(same_as == np.arange(len(same_as)))
        position, kind = equal_windows(data, start[once], end[once], length)
        class_at = np.zeros(len(data), dtype=np.int64)
        class_at[position] = kind
        piece = np.cumsum(fresh) - 1
        kind = class_at[at[m] - start[piece] + start[same_as[piece]]]
        docs = doc[owner[m]]
        least = np.full(int(kind.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, kind, docs)
        settled[m[docs > least[kind]]] = True
    first = lo[owner] + at - offsets[owner]
    s = np.flatnonzero(settled)
    fresh = np.r_[True, (s[1:] != s[:-1] + 1) | (owner[s[1:]] != owner[s[:-1]])][:len(s)]
    begin = np.flatnonzero(fresh)
    runs = np.diff(np.append(begin, len(s)))
    rows = [(np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64), doc[owner[s[begin]]], mark[owner[s[begin]]],
             repeats.pack(first[s[begin]], runs, repeats.SETTLED))]
    rows[0] = (vec.mix(rows[0][2].view(np.uint64) + rows[0][4].view(np.uint64)).view(np.int64), *rows[0][1:])
    if not whole:
        o = np.flatnonzero(~settled)
        h2 = vec.Sums(vec.BYTE_TABLES[1][data], 1).slices(at[o], at[o] + length)
        rows.append((h[o].view(np.int64), h2.view(np.int64), doc[owner[o]], mark[owner[o]], repeats.pack(first[o], np.ones(len(o), np.int64), repeats.OPEN)))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows)], names=repeats.FIELDS)


def _compared(length: int):
    def run(table: pa.Table, whole: bool) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        doc, mark, loc = (table.column(c).to_numpy() for c in ("doc", "mark", "loc"))
        yield compare(doc, mark, loc, table.column("body").chunk(0), length, whole)

    return run


def removed_bytes(docs: DataFrame, length: int = LENGTH, seed: int = SEED, reach: int = REACH, block: int = BLOCK, bitmap: bool | None = None,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, mark, spans): maximal byte ranges, first and end in turn, covered by strings that also start in a smaller document.

    ``bitmap`` says whether anchors that occur once are found in a pass of their own before rows are shuffled; by default that depends on
    the number of input partitions.  The result does not depend on it, nor on ``block``.
    """
    texts = docs.select(doc_key(key).alias("doc"), text_mark(text).alias("mark"), F.col(text).alias("text"))
    cut = _cutter(length, seed, reach)
    if bitmap if bitmap is not None else texts.rdd.getNumPartitions() <= BITMAP_PARTITIONS:
        cut = _filtered(cut, docs.sparkSession.sparkContext.broadcast(repeated_anchors(texts, length, seed, reach)))
        free_shuffles(texts)
    found = checkpointed(repeats.per_document(repeats.settle(repeats.run_rows(texts, cut, True), True, True)))
    free_shuffles(found)
    spans = checkpointed(_spans(texts, found, length, block))
    free_shuffles(spans)  # the contexts and the texts beside them are gone before the texts move again
    return spans


def _spans(texts: DataFrame, found: DataFrame, length: int, block: int) -> DataFrame:
    """The ranges after what ``found`` left to compare has been compared; a function of its own, so that nothing here is held afterwards."""
    beside = repeats.beside_text(texts, found.select("doc", "mark", "left").where(F.size("left") > 0), "left", "inner", LIST_BYTES, stored=True)
    contexts = map_arrow(beside.select("doc", "mark", "text", "left"), _contexts(length), CONTEXTS)
    ordered = contexts.repartition("key").sortWithinPartitions("key", "doc", "mark", "loc")
    more = repeats.per_document(repeats.settle(map_arrow(ordered, repeats.in_blocks(_compared(length), block), repeats.ROWS), True, False))
    return repeats.spans_of(repeats.settled_of(found, more), length)


def _apply(width: int, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, spans, kept, digests = [], [], [], [], []
            texts, lists = batch.column(at), batch.column(width).to_pylist()
            for i in range(batch.num_rows):
                data = (texts[i].as_py() or "").encode()
                ranges = lists[i] or ()
                total.append(len(data))
                spans.append(len(ranges) // 2)
                if ranges:
                    parts = [data[a:b] for a, b in zip([0, *ranges[1::2]], [*ranges[::2], len(data)])]
                    removed.append(sum(ranges[1::2]) - sum(ranges[::2]))
                    data = b"".join(parts)
                else:
                    removed.append(0)
                kept.append(data)
                digests.append(hashlib.sha256(data).hexdigest())
            columns = [pa.array(kept, pa.binary()) if c == at else batch.column(c) for c in range(width)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                                              pa.array(digests, pa.string())],
                                             names=[*[f"c{i}" for i in range(width)], "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def drop_bytes(docs: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``text`` as the kept bytes (binary: a cut may split a character), and n_bytes, n_removed, n_spans, kept_sha256.

    ``spans``, as ``removed_bytes`` returns them, should be stored: they are read twice.

    Null and empty texts have no bytes.  Rows with the same id never remove each other's bytes; null ids sort last.  Empty
    table: no rows.  Other columns, whatever their names, are carried along.
    """
    names = docs.columns
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], doc_key(key).alias("doc"), text_mark(text).alias("mark"))
    joined = repeats.beside_text(rows, spans, "spans", "left", LIST_BYTES, stored=True).select(*[f"c{i}" for i in range(len(names))], "spans")
    schema = joined.drop("spans").schema
    schema[names.index(text)].dataType = T.BinaryType()
    schema = schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")
    out = map_arrow(joined, _apply(len(names), names.index(text)), schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "n_bytes", "n_removed", "n_spans", "kept_sha256")
