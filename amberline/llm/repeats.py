"""Finding repeated windows of a fixed length: winnowed anchors, contexts, and a stream over sorted rows.

Every window of L symbols chooses one of its k-grams, the anchor, by its contents.  Consecutive windows with the same anchor are a run, whose
context is all they cover.  Two equal windows have the same anchor, so rows of runs meet by anchor hash.  Where
whole contexts are equal, so are all their windows: these are settled at once, first inside a task, before
anything is shuffled, then in a stream over rows sorted by (anchor, context, document).  Only anchors with several contexts leave work: one
row per context, to be compared window by window.

A row is (key, ctx, doc, mark, loc), loc packing the first window, the number of windows and a kind.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec
from .common import checkpointed, map_arrow

OPEN, SETTLED, LEFT, KNOWN = 0, 1, 2, 3  # undecided; its windows are repeats; left to compare; repeated, and others may equal it
FIELDS = ["key", "ctx", "doc", "mark", "loc"]
ROWS = "key long, ctx long, doc long, mark long, loc long"
FOUND = "key long, doc long, mark long, loc long"
FLUSH = 400_000
#: Lists per document up to this many bytes are broadcast to the texts; larger ones are joined by a shuffle.
BROADCAST_BYTES = 64 << 20


def pack(first: np.ndarray, count: np.ndarray, kind) -> np.ndarray:
    return (first.astype(np.int64) << 16) | (count.astype(np.int64) << 4) | kind


def unpack(loc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return loc >> 16, (loc >> 4) & 0xFFF, loc & 15


def runs(codes: list[np.ndarray], offsets: np.ndarray, k: int, length: int, reach: int, contexts: bool = True) -> tuple[np.ndarray, ...]:
    """(text, first window in it, number of windows, key, context) of all runs; windows lie inside one text.

    A run is cut where the distance from its windows to the anchor passes a multiple of ``reach``: all windows of a piece hold a core
    around the anchor, at least ``length - reach + 1`` long, whose hash is the key.
    """
    sums = vec.Sums(codes[0])
    at, first, last = vec.winnow(sums.raw_grams(k), length - k + 1)
    if not len(at):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    # windows that lie in one text: those of the text of the run's first window, else those of the text of its last one
    text = np.searchsorted(offsets, first, side="right") - 1
    outside = first + length > offsets[text + 1]
    text[outside] = np.searchsorted(offsets, last[outside], side="right") - 1
    first, last = np.maximum(first, offsets[text]), np.minimum(last, offsets[text + 1] - length)
    inside = first <= last
    at, first, last, text = at[inside], first[inside], last[inside], text[inside]
    near, far = (at - last) // reach, (at - first) // reach
    pieces = far - near + 1
    which = np.repeat(np.arange(len(at)), pieces)
    step = near[which] + np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at, text = at[which], text[which]
    first, last = np.maximum(first[which], at - (step + 1) * reach + 1), np.minimum(last[which], at - step * reach)
    key = sums.slices(at - step * reach, at - (step + 1) * reach + 1 + length) + step.astype(np.uint64) * vec.U64(vec.BASES[1])
    ctx = vec.Sums(codes[1], 1).slices(first, last + length) if contexts else key
    return text, first - offsets[text], last - first + 1, key.view(np.int64), ctx.view(np.int64)


class Collapse:
    """Gathers rows of a task and settles copies among them before they are shuffled."""

    def __init__(self, smaller_only: bool):
        self.smaller_only, self.parts, self.size = smaller_only, [], 0

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(columns)
        self.size += len(columns[0])
        if self.size >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        key, ctx, doc, mark, loc = (np.concatenate(c) for c in zip(*self.parts))
        self.parts, self.size = [], 0
        order = np.lexsort((loc, mark, doc, ctx, key))
        key, ctx, doc, mark, loc = (c[order] for c in (key, ctx, doc, mark, loc))
        new = np.r_[True, (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1])]
        group = np.cumsum(new) - 1
        if self.smaller_only:
            settled = doc > doc[new][group]
        else:
            several = (np.bincount(group) > 1)[group]
            settled = several & ~new
            loc = np.where(several & new & (loc & 15 == OPEN), loc | KNOWN, loc)
            settled &= loc & 15 == OPEN  # a known row that is no first one only repeats what the first says
            gone = several & ~new & (loc & 15 == KNOWN)
        loc = np.where(settled, loc | SETTLED, loc)
        # settled rows only travel on to their documents: any key will do, so a hot one does not gather them
        key = np.where(settled, vec.mix(doc.view(np.uint64) * vec.U64(vec.BASES[1]) + loc.view(np.uint64)).view(np.int64), key)
        columns = [key, np.where(settled, 0, ctx), doc, mark, loc]
        if not self.smaller_only and gone.any():
            columns = [c[~gone] for c in columns]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=FIELDS)


class _Stream:
    """Settles rows sorted by (key, ctx, doc, mark, loc), batch by batch; only the last class is held.

    ``smaller_only``: a row is settled if its class has a smaller document; else if its class has another row.  With ``leave``, classes
    of a key with several are left to be compared.
    """

    def __init__(self, smaller_only: bool, leave: bool):
        self.smaller_only, self.leave = smaller_only, leave
        self.held = [np.zeros(0, np.int64)] * 5
        self.closed = None  # key of the last closed class

    def feed(self, batch: list[np.ndarray], last: bool = False) -> list[np.ndarray]:
        through = batch[4] & 15 == SETTLED
        out = [[batch[0][through] * 0, *[c[through] for c in batch[2:]]]]
        key, ctx, doc, mark, loc = (np.concatenate((h, c[~through])) for h, c in zip(self.held, batch))
        n = len(key)
        if n:
            new_key = np.r_[True, key[1:] != key[:-1]]
            new = new_key | np.r_[True, ctx[1:] != ctx[:-1]]
            starts = np.flatnonzero(new)
            cut = n if last else starts[-1]
            self.held = [c[cut:] for c in (key, ctx, doc, mark, loc)]
            group, anchor = np.cumsum(new) - 1, np.cumsum(new_key) - 1
            contexts = np.bincount(anchor[starts])
            if self.closed is not None and self.closed == key[0]:
                contexts[0] += 1
            several = self.leave & (contexts > 1)[anchor]
            self.closed = key[cut - 1] if cut else self.closed
            kind = loc & 15
            if self.smaller_only:
                settled = doc > doc[starts][group]
                left, as_kind = several & ~settled, LEFT
            else:
                settled = (np.bincount(group) + np.bincount(group, weights=kind == KNOWN) > 1)[group]
                left, as_kind = several & new, np.where(settled, KNOWN, LEFT)
            done = np.arange(n) < cut
            plain = loc & ~15
            for flag, mark_as in ((settled & done, SETTLED), (left & done, as_kind)):
                out.append([key[flag] if mark_as is not SETTLED else np.zeros(int(flag.sum()), np.int64), doc[flag], mark[flag], (plain | mark_as)[flag]])
        return [np.concatenate(c) for c in zip(*out)]


def settle(rows: DataFrame, smaller_only: bool, leave: bool) -> DataFrame:
    """(key, doc, mark, loc) of settled rows, with key 0, and of those left to compare."""
    ordered = rows.repartition("key").sortWithinPartitions(*FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _Stream(smaller_only, leave)
        names = ["key", "doc", "mark", "loc"]
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in stream.feed([np.asarray(batch.column(c)) for c in FIELDS])], names=names)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in stream.feed([np.zeros(0, np.int64)] * 5, last=True)], names=names)

    return map_arrow(ordered, run, FOUND)


def per_document(found: DataFrame) -> DataFrame:
    """(doc, mark, locs, left): each document's settled rows, and those left to compare as (loc, key); repeated rows of a table count once."""
    settled = F.col("loc").bitwiseAND(F.lit(15)) == SETTLED
    return found.groupBy("doc", "mark").agg(F.collect_set(F.when(settled, F.col("loc"))).alias("locs"),
                                            F.collect_set(F.when(~settled, F.struct("loc", "key"))).alias("left"))


def settled_of(found: DataFrame, more: DataFrame) -> DataFrame:
    """(doc, mark, locs) with the rows settled by comparing."""
    lists = found.join(more.select("doc", "mark", F.col("locs").alias("more")), ["doc", "mark"], "left")
    return lists.select("doc", "mark", F.concat("locs", F.coalesce("more", F.array().cast("array<long>"))).alias("locs"))


def merged(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint, not touching ranges that cover the same as the given ones."""
    if not len(first):
        return first, end
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(end[order])
    new = np.r_[True, first[1:] > reach[:-1]]
    return first[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


def spans_of(lists: DataFrame, length: int) -> DataFrame:
    """(doc, mark, spans): the symbols covered by settled windows, as first, end, first, end, ..."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, at = batch.column("locs").values.to_numpy(), batch.column("locs").offsets.to_numpy()
            spans = []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                first, count, _ = unpack(values[a:b])
                x, y = merged(first, first + count + length - 1)
                spans.append(np.stack((x, y), 1).ravel())
            lengths = np.array([len(s) for s in spans], dtype=np.int32)
            joined = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)),
                                              pa.array(np.concatenate(spans) if spans else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("mark"), joined], names=["doc", "mark", "spans"])

    return map_arrow(lists, run, "doc long, mark long, spans array<long>").where(F.size("spans") > 0)


def beside_text(texts: DataFrame, lists: DataFrame, column: str, how: str, limit: int = BROADCAST_BYTES, stored: bool = False) -> DataFrame:
    """``texts`` (with doc, mark) joined with per-document lists, which are broadcast up to ``limit`` bytes and joined by a shuffle beyond that.

    They are read twice, and checkpointed for that unless ``stored`` says that they are read from a copy already.
    """
    lists = lists if stored else checkpointed(lists)
    element = 8 if lists.schema[column].dataType.elementType.simpleString() == "bigint" else 32  # a struct of two longs
    size = lists.agg(F.coalesce(F.sum(F.lit(64) + F.size(column) * element), F.lit(0))).first()[0]
    return texts.join(F.broadcast(lists) if size <= limit else lists.hint("merge"), ["doc", "mark"], how)


def run_rows(texts: DataFrame, cut: Callable, smaller_only: bool) -> DataFrame:
    """Rows of all runs of ``texts`` (doc, mark, text); ``cut`` gives runs of a block of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Collapse(smaller_only)
        for batch in batches:
            doc, mark = np.asarray(batch.column("doc")), np.asarray(batch.column("mark"))
            for first, _, buf, offsets in vec.blocks(batch.column("text")):
                text, lo, count, key, ctx = cut(buf, offsets)
                if len(text):
                    yield from rows.add(key, ctx, doc[first + text], mark[first + text], pack(lo, count, OPEN))
        yield from rows.flush()

    return map_arrow(texts, run, ROWS)


def in_blocks(compare: Callable[[pa.Table, bool], Iterator[pa.RecordBatch]], block: int) -> Callable:
    """Feeds rows sorted by key to ``compare`` in blocks of about ``block`` bytes, of whole keys or of a part of a very common one.

    ``compare`` gets a block and whether all rows of its keys are in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size, part_of = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            size += batch.nbytes
            if size < block:
                continue
            table = pa.concat_tables(held)
            key = table.column("key").to_numpy()
            if part_of is not None:  # the rest of a key that has been cut
                own = int(np.searchsorted(key != part_of, True))
                if own:
                    yield from compare(table.slice(0, own), False)
                table, key = table.slice(own), key[own:]
                part_of = part_of if not len(key) else None
            if len(key):
                cut = int(np.flatnonzero(np.r_[True, key[1:] != key[:-1]])[-1])
                if cut:
                    yield from compare(table.slice(0, cut), True)
                    table = table.slice(cut)
                if table.nbytes >= 2 * block:
                    part_of = key[-1]
                    yield from compare(table, False)
                    table = table.slice(0, 0)
            held, size = [table] if table.num_rows else [], table.nbytes
        if held:
            table = pa.concat_tables(held)
            key = table.column("key").to_numpy()
            own = 0
            if part_of is not None:
                own = int((key == part_of).sum())
                if own:
                    yield from compare(table.slice(0, own), False)
            if own < len(key):
                yield from compare(table.slice(own), True)

    return run
