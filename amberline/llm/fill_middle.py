"""Fill-in-middle: texts cut into prefix, middle and suffix, put together in a new order, and taken back.

Texts are cut into pieces of some thousand units where they are read.  A piece is keyed by its document and its position in the output;
Spark's shuffle by document with a secondary sort by position (repartition, then sort within partitions) brings the pieces of a document
one after the other past an incremental digest, so that no task holds more than a piece of an output.  For restoration the output is read like a stream, its
control strings are found, also where they lie across two pieces, and its pieces are sorted again, by document and position in the text: the
rows are where they have to be already, so that nothing is shuffled a second time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec
from .common import NO_ID, doc_key, map_arrow, text_mark

#: Control strings before prefix, suffix and middle.  The first character of each occurs in it once, so that none can begin inside another.
MARKERS = ("<P>", "<S>", "<M>")
SEED = "1"
FIM_PERCENT, SPM_PERCENT = 90, 20
CHUNK_UNITS = 8_192
#: A unit is a run of letters, so that it can be of any length; pieces are cut here at the latest.
PIECE_BYTES = 1 << 19
FLUSH_BYTES = 1 << 21
PREFIX, MIDDLE, SUFFIX, END = 0, 1, 2, 3
#: Order of the parts in the output.
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

_LETTER = vec.byte_class(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
KEY = ["doc", "mark", "part"]
FACTS = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
PIECES = pa.schema([("doc", pa.int64()), ("mark", pa.int64()), ("part", pa.int32()), ("place", pa.int64()), *FACTS, ("piece", pa.binary())])
PIECES_DDL = "doc long, mark long, part int, place long, n long, form string, prefix_chars long, middle_chars long, piece binary"
RETURNED = pa.schema([("doc", pa.int64()), ("mark", pa.int64()), ("part", pa.int32()), ("segment", pa.int32()), ("place", pa.int64()), *FACTS,
                      ("copies", pa.int64()), ("output_sha256", pa.string()), ("piece", pa.binary())])
RETURNED_DDL = ("doc long, mark long, part int, segment int, place long, n long, form string, prefix_chars long, middle_chars long, copies long, "
                "output_sha256 string, piece binary")


class _Out:
    """Rows on their way into record batches of a few MB."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int) -> None:
        self.rows.append(row)
        self.size += size + 100

    def full(self) -> bool:
        return self.size >= FLUSH_BYTES

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(self.schema)
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)


def unit_starts(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of the units (a run of ASCII letters, or one other code point), and for each text the index of its first unit."""
    start = (buf & 0xC0) != 0x80
    letter = _LETTER[buf]
    start[1:] &= ~(letter[1:] & letter[:-1])
    start[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    starts = np.flatnonzero(start)
    return starts, np.searchsorted(starts, offsets)


def draws(seed: str, doc: int) -> tuple[int, int, int, int]:
    """h1 to h4 of a document: 32 bits each of a hash of seed and id; a null id is the empty text."""
    h = hashlib.sha256(f"{seed}:{'' if doc == NO_ID else doc}".encode()).digest()
    return tuple(int.from_bytes(h[i:i + 4], "big") for i in (0, 4, 8, 12))


def _cutter(seed: str, fim_percent: int, spm_percent: int, markers: tuple[str, str, str], chunk_units: int) -> Callable:
    marks = dict(zip((PREFIX, SUFFIX, MIDDLE), [m.encode() for m in markers]))

    def pieces(text: bytes, bounds: np.ndarray, h: tuple[int, int, int, int], chars: np.ndarray) -> Iterator[tuple]:
        """(facts, piece) of one text; bounds are the unit starts and the end."""
        n = len(bounds) - 1

        def chunks(a: int, b: int) -> Iterator[bytes]:
            for i in range(a, b, chunk_units):
                x, y = int(bounds[i]), int(bounds[min(i + chunk_units, b)])
                for s in range(x, y, PIECE_BYTES):
                    yield text[s:min(s + PIECE_BYTES, y)]

        if not n or any(m in text for m in marks.values()) or h[2] % 100 >= fim_percent:
            facts = (n, "plain", None, None)
            for piece in chunks(0, n) if n else (b"",):
                yield facts, piece
            return
        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        form = "spm" if h[3] % 100 < spm_percent else "psm"
        facts = (n, form, int(chars[bounds[a]] - chars[bounds[0]]), int(chars[bounds[b]] - chars[bounds[a]]))
        ranges = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, n)}
        for segment in ORDERS[form]:
            lead = marks[segment]
            for piece in chunks(*ranges[segment]):
                yield facts, lead + piece
                lead = b""
            if lead:
                yield facts, lead

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(PIECES)
        for batch in batches:
            keys = list(zip(*[batch.column(c).to_pylist() for c in KEY]))
            for first, end, buf, offsets in vec.blocks(batch.column("text")):
                starts, firsts = unit_starts(buf, offsets)
                chars = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
                for i in range(end - first):
                    at = int(offsets[i])
                    text = buf[at:offsets[i + 1]].tobytes()
                    bounds = np.append(starts[firsts[i]:firsts[i + 1]], offsets[i + 1]) - at
                    key = keys[first + i]
                    for place, (facts, piece) in enumerate(pieces(text, bounds, draws(seed, key[0]), chars[at:offsets[i + 1] + 1])):
                        out.add((*key, place, *facts, piece), len(piece))
                        if out.full():
                            yield out.batch()
        yield out.batch()

    return run


def fill_in_middle(docs: DataFrame, seed: str = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
                   markers: tuple[str, str, str] = MARKERS, chunk_units: int = CHUNK_UNITS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The outputs as pieces (doc, mark, part, place, n, form, prefix_chars, middle_chars, piece), in order of place inside their partitions.

    A text is cut into n units, runs of ASCII letters or single other code points.  The prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1)
    units, the middle after the larger.  ``form`` is plain, the text as it is, if the text is empty or null, has one of the control strings or if
    h3 % 100 >= fim_percent; else spm if h4 % 100 < spm_percent, and psm otherwise.  h1 to h4 come from a hash of ``seed`` and the id, a null
    id being the empty text.  The first character of a control string may occur in it only once and must be the same in all.
    Repeated rows give one output each: ``part`` is the partition a row was read from, and equal rows of one part give equal pieces, which stand side by
    side.  So a third of all rows may be alike; they meet only as far as they were in one task before.  An empty table gives no rows; other columns
    do not matter.
    """
    if len({m[:1] for m in markers}) != 1 or any(m.count(m[:1]) != 1 for m in markers) or len(set(markers)) != 3 or not all(markers):
        raise ValueError("three different control strings are needed that begin with one character, which they have only there")
    rows = docs.select(doc_key(key).alias("doc"), text_mark(text).alias("mark"), F.spark_partition_id().alias("part"), F.col(text).alias("text"))
    cut = map_arrow(rows, _cutter(seed, fim_percent, spm_percent, markers, chunk_units), PIECES_DDL)
    return cut.repartition(*KEY).sortWithinPartitions(*KEY, "place")


def _outputs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[bytes], Callable[[], int]]]:
    """(key and facts, the pieces, the number of equal outputs once they are read) of one output after the other."""
    rows = (row for b in batches for row in zip(*[c.to_pylist() for c in b.columns]))
    state = {"row": next(rows, None)}

    def pieces(key: tuple) -> Iterator[bytes]:
        last = -1
        while (row := state["row"]) is not None and row[:3] == key:
            state["copies"] += row[3] == 0
            state["row"] = next(rows, None)
            if row[3] != last:  # the same piece of an equal row is left out
                last = row[3]
                yield row[-1]

    while (row := state["row"]) is not None:
        state["copies"] = 0
        yield (*row[:3], *row[4:8]), pieces(row[:3]), lambda: state["copies"]


class Splitter:
    """Parts of an output that arrives in pieces: the control strings come in the order of the form and belong to no part."""

    def __init__(self, form: str, markers: tuple[str, str, str] = MARKERS):
        names = dict(zip((PREFIX, SUFFIX, MIDDLE), [m.encode() for m in markers]))
        self.todo = [(s, names[s]) for s in ORDERS.get(form, ())]
        self.segment, self.rest = None if self.todo else PREFIX, b""

    def feed(self, piece: bytes, last: bool = False) -> Iterator[tuple[int, bytes]]:
        data = self.rest + piece
        self.rest = b""
        while self.todo and (at := data.find(self.todo[0][1])) >= 0:
            yield from self._part(data[:at])
            self.segment, marker = self.todo.pop(0)
            data = data[at + len(marker):]
        if self.todo and not last:
            keep = min(len(data), len(self.todo[0][1]) - 1)  # it may begin a control string
            data, self.rest = data[:len(data) - keep], data[len(data) - keep:]
        if last and self.todo:
            raise ValueError("an output ends before its last control string")
        yield from self._part(data)

    def _part(self, data: bytes) -> Iterator[tuple[int, bytes]]:
        if data and self.segment is None:
            raise ValueError("an output must begin with a control string")
        if data:
            yield self.segment, data


def _taker(markers: tuple[str, str, str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(RETURNED)
        none = (None,) * len(FACTS)
        for (doc, mark, part, *facts), pieces, copies in _outputs(batches):
            digest, parts, place = hashlib.sha256(), Splitter(facts[1], markers), 0
            for piece in pieces:
                digest.update(piece)
                for segment, data in parts.feed(piece):
                    out.add((doc, mark, part, segment, place, *none, None, None, data), len(data))
                    place += 1
                    if out.full():
                        yield out.batch()
            for segment, data in parts.feed(b"", last=True):
                out.add((doc, mark, part, segment, place, *none, None, None, data), len(data))
                place += 1
            out.add((doc, mark, part, END, place, *facts, copies(), digest.hexdigest(), None), 200)
        yield out.batch()

    return run


def taken_back(outputs: DataFrame, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """The texts again, as pieces in order of (segment, place) inside the partitions of ``fill_in_middle``, from outputs and forms alone.

    A row of segment 3 closes each text; it has the number of equal rows, the digest of the output and the facts.
    """
    return map_arrow(outputs, _taker(markers), RETURNED_DDL).sortWithinPartitions(*KEY, "segment", "place")


DIGESTS = pa.schema([("doc", pa.int64()), *FACTS, ("output_sha256", pa.string()), ("restored_sha256", pa.string())])


def _digester(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, digest = _Out(DIGESTS), hashlib.sha256()
    for batch in batches:
        for doc, _, _, segment, _, n, form, prefix, middle, copies, sha, piece in zip(*[c.to_pylist() for c in batch.columns]):
            if segment != END:
                digest.update(piece)
                continue
            for _ in range(copies):
                out.add((doc, n, form, prefix, middle, sha, digest.hexdigest()), 200)
                if out.full():
                    yield out.batch()
            digest = hashlib.sha256()
    yield out.batch()


def digests(texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) from the partitions of ``taken_back``, a row per row of the documents.

    prefix_chars and middle_chars are in code points, null where the form is plain; digests are of UTF-8 bytes.
    """
    out = map_arrow(texts, _digester, "doc long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias(key), "n", "form", "prefix_chars", "middle_chars", "output_sha256",
                      "restored_sha256")


WHOLE = pa.schema([("doc", pa.int64()), ("form", pa.string()), ("output", pa.string())])


def _joiner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Out(WHOLE)
    for (doc, _, _, _, form, _, _), pieces, copies in _outputs(batches):
        text = b"".join(pieces).decode()
        for _ in range(copies()):
            out.add((doc, form, text), len(text))
            if out.full():
                yield out.batch()
    yield out.batch()


def whole_outputs(outputs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, form, output) with each output in one row, as long as the text it came from, from the partitions of ``fill_in_middle``."""
    out = map_arrow(outputs, _joiner, "doc long, form string, output string")
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias(key), "form", "output")
