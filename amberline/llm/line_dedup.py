"""Line dedup: hashed lines in range partitions, streamed in (hash, document, position) order, answered by bitmaps.

Only 128-bit line hashes, document keys and positions are shuffled, never text.  Range partitions split a line that
a third of all documents hold; a run of equal hashes that touches the edge of a partition is left undecided there
and settled by one small aggregation.  What comes back is, per document with dropped lines, a compressed bitmap.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec
from .common import checkpointed, doc_key, map_arrow, text_mark

MIN_DOCS = 10


def line_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the lines between line breaks, and for each text the index of its first line."""
    breaks = np.flatnonzero(buf == 10)
    starts = np.sort(np.concatenate((offsets[:-1], breaks + 1)), kind="stable")
    # a break belongs to the text that holds it, so its following line sorts into that text even at the text's end
    per_text = np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1]) + 1
    firsts = np.concatenate(([0], np.cumsum(per_text)))
    ends = np.empty(len(starts), dtype=np.int64)
    ends[:-1] = starts[1:] - 1
    ends[firsts[1:] - 1] = offsets[1:]
    return starts, ends, firsts


def stripped(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans without white space at both ends; an empty span where nothing is left."""
    solid = np.flatnonzero(vec.NOT_SPACE[buf])
    lo, hi = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    filled = hi > lo
    a, b = starts.copy(), starts.copy()
    a[filled], b[filled] = solid[lo[filled]], solid[hi[filled] - 1] + 1
    return a, b


def _hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, mark = np.asarray(batch.column("doc")), np.asarray(batch.column("mark"))
        for first, end, buf, offsets in vec.blocks(batch.column("text")):
            starts, ends, firsts = line_spans(buf, offsets)
            a, b = stripped(buf, starts, ends)
            lines = np.flatnonzero(b > a)
            if not len(lines):
                continue
            lower = vec.LOWER[buf]
            h = [vec.Sums(vec.BYTE_TABLES[i][lower], i).slices(a[lines], b[lines]).view(np.int64) for i in (0, 1)]
            text = np.searchsorted(firsts, lines, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[0]), pa.array(h[1]), pa.array(doc[first + text]), pa.array(mark[first + text]), pa.array(lines - firsts[text])],
                names=["h1", "h2", "doc", "mark", "line"])


FIELDS = ["h1", "h2", "doc", "mark", "line"]


class _Stream:
    """Sorted rows of one partition, batch by batch; emits (h1, h2, doc, mark, line, sure).

    A run is the rows of one hash.  Rows of inner runs are sure to be dropped or left out.  Runs at an edge of the partition may
    go on in the next one: their rows come out unsure, or, if they have enough documents already, sure and with a marker
    (line -1).  Only the open run is held, and only until it has enough documents.
    """

    def __init__(self, min_docs: int, keep_first: bool):
        self.min_docs, self.keep_first = min_docs, keep_first
        self.rows = [np.zeros(0, np.int64)] * 5  # of the open run, while it is undecided
        self.decided = None  # the key of the open run once it is decided
        self.at_start = True

    def feed(self, batch: list[np.ndarray], last: bool = False) -> list[np.ndarray]:
        rows = [np.concatenate(pair) for pair in zip(self.rows, batch)]
        h1, h2, doc = rows[:3]
        n = len(h1)
        if not n:
            return [np.zeros(0, np.int64)] * 6
        new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        run = np.cumsum(new) - 1
        begins = np.flatnonzero(new)
        new_doc = new | np.r_[True, doc[1:] != doc[:-1]]
        enough = np.bincount(run, weights=new_doc) >= self.min_docs
        first = new.copy()  # the first row of a run that begins here
        if self.decided == (h1[0], h2[0]):
            enough[0], first[0] = True, False
        edge = np.zeros(len(begins), dtype=bool)
        edge[0] |= self.at_start
        edge[-1] |= last
        open_run = run == len(begins) - 1
        hold = not last and not enough[-1]
        out = enough[run] | (edge[run] & ~(open_run & hold))
        sure = enough[run]
        if self.keep_first:
            if not last and enough[-1]:
                edge[-1] = True  # it may go on to the end of the partition
            out &= ~(first & enough[run] & ~edge[run])
            sure &= ~(first & edge[run])
        marked = begins[enough & (edge | (np.arange(len(begins)) == len(begins) - 1))]
        self.decided = (h1[-1], h2[-1]) if enough[-1] else None
        self.rows = [r[open_run] if hold else r[:0] for r in rows]
        self.at_start &= len(begins) == 1
        emitted = [np.concatenate((r[out], r[marked])) for r in rows]
        emitted[4][len(emitted[4]) - len(marked):] = -1
        return [*emitted, np.concatenate((sure[out], np.zeros(len(marked), dtype=bool))).astype(np.int64)]


def _streamer(min_docs: int, keep_first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _Stream(min_docs, keep_first)
        for batch in batches:
            yield _record(stream.feed([np.asarray(batch.column(c)) for c in FIELDS]))
        yield _record(stream.feed([np.zeros(0, np.int64)] * 5, last=True))

    return run


def _record(columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[*FIELDS, "sure"])


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines, ends = batch.column("lines").values.to_numpy(), batch.column("lines").offsets.to_numpy()
        maps = []
        for a, b in zip(ends[:-1], ends[1:]):
            keep = np.ones((int(lines[a:b].max()) // 8 + 1) * 8, dtype=bool)
            keep[lines[a:b]] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("mark"), pa.array((ends[1:] - ends[:-1]).astype(np.int64)),
                                          pa.array(maps, pa.binary())], names=["doc", "mark", "n_dropped", "keep"])


def line_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, keep_first: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, mark, n_dropped, keep) for each document that loses lines.

    Lines are equal without white space at their ends and with A-Z lower-cased; blank lines are never dropped.  Lines in at least
    ``min_docs`` documents (distinct doc_id; all null ids together are one) are dropped everywhere, or, with ``keep_first``, but for the
    first occurrence by (doc_id, text mark, line).  ``keep`` is a zlib-compressed bitmap, one bit per line; lines beyond its end
    are kept.  ``mark`` tells rows apart that share a doc_id; identical rows share one bitmap.  An empty table gives no rows.
    """
    rows = docs.select(doc_key(key).alias("doc"), text_mark(text).alias("mark"), F.col(text).alias("text"))
    hashed = checkpointed(map_arrow(rows, _hash_lines, "h1 long, h2 long, doc long, mark long, line long"))
    ranged = hashed.repartitionByRange(*FIELDS).sortWithinPartitions(*FIELDS)
    found = checkpointed(map_arrow(ranged, _streamer(min_docs, keep_first), "h1 long, h2 long, doc long, mark long, line long, sure long"))
    unsure = found.where("sure = 0")  # at most the edges of the partitions
    settled = unsure.groupBy("h1", "h2").agg(
        (F.max((F.col("line") < 0).cast("int")) + F.when(F.count_distinct(F.when(F.col("line") >= 0, F.col("doc"))) >= min_docs, 1).otherwise(0))
        .alias("enough"),
        F.min(F.when(F.col("line") >= 0, F.struct("doc", "mark", "line"))).alias("first")).where("enough > 0")
    more = unsure.where("line >= 0").join(settled, ["h1", "h2"])
    if keep_first:
        more = more.where(F.struct("doc", "mark", "line") != F.col("first"))
    dropped = found.where("sure = 1").select("doc", "mark", "line").unionByName(more.select("doc", "mark", "line"))
    per_doc = dropped.groupBy("doc", "mark").agg(F.collect_set("line").alias("lines"))
    return map_arrow(per_doc, _bitmaps, "doc long, mark long, n_dropped long, keep binary")


def _apply(width: int, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, maps = batch.column(at), batch.column(width)
            dropped = maps.is_valid().to_numpy(zero_copy_only=False)
            total, lost, digests = [], [], []
            out = texts.to_pylist()
            for i, text in enumerate(out):
                lines = (text or "").split("\n")
                total.append(len(lines))
                gone = 0
                if dropped[i]:
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(maps[i].as_py()), dtype=np.uint8))[:len(lines)].tolist()
                    kept = [x for x, keep in zip(lines, bits) if keep] + lines[len(bits):]
                    gone = len(lines) - len(kept)
                    out[i] = "\n".join(kept)
                lost.append(gone)
                digests.append(hashlib.sha256((out[i] or "").encode()).hexdigest())
            columns = [pa.array(out, batch.schema.field(at).type) if c == at else batch.column(c) for c in range(width)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(lost, pa.int64()), pa.array(digests)],
                                             names=[*[f"c{i}" for i in range(width)], "n_lines", "n_dropped", "kept_sha256"])

    return run


def drop_lines(docs: DataFrame, bitmaps: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the lines dropped from their texts, and n_lines (before), n_dropped, kept_sha256 behind their columns.

    Null texts count as one empty line and stay null; further columns, whatever their names, are carried along.
    """
    names = docs.columns
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], doc_key(key).alias("_doc"), text_mark(text).alias("_mark"))
    maps = bitmaps.select(F.col("doc").alias("_doc"), F.col("mark").alias("_mark"), F.col("keep").alias("_keep"))
    joined = rows.join(maps, ["_doc", "_mark"], "left").select(*[f"c{i}" for i in range(len(names))], "_keep")
    schema = joined.drop("_keep").schema.add("n_lines", "long").add("n_dropped", "long").add("kept_sha256", "string")
    out = map_arrow(joined, _apply(len(names), names.index(text)), schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "n_lines", "n_dropped", "kept_sha256")
