"""Embedding whitening: exact integer statistics, a distributed covariance and refined eigenvectors.

Vectors become vectors of integers, packed into the narrowest integers that hold them.  Each distinct one counts once: packed vectors are grouped by
Spark, equal ones of a map task first.  Tasks centre their vectors and multiply them in blocks; their partial matrices are added up row by row in
as many tasks as there are dimensions, so that only one matrix of the dimension squared reaches the driver, whatever the number of rows.
There ``eigen`` finds the components; what they make of the fitted vectors is measured by one more pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, map_arrow
from .eigen import refined_eigenvectors

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Entries of a block of vectors in a task: 8 MB of doubles.
BLOCK = 1 << 20
#: A component whose share of the largest eigenvalue is not above this, times the dimension, cannot be told from none in double precision.
LEAST_SHARE = 2.0 ** -40
WIDTHS = (np.int8, np.int16, np.int32, np.int64)


def _encode(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            begins = np.cumsum(sizes) - sizes
            flat = lists.flatten().to_numpy(zero_copy_only=False)  # a null entry is NaN
            rows, codes = [], []
            for d in np.unique(sizes[sizes > 0]):
                members = np.flatnonzero(sizes == d)
                step = max(1, BLOCK // int(d))
                for at in range(0, len(members), step):
                    some = members[at:at + step]
                    x = np.floor(scale * flat[begins[some][:, None] + np.arange(d)])
                    fits = (np.abs(x) < 2.0 ** 62).all(axis=1)
                    some, x = some[fits], x[fits].astype(np.int64)
                    top = np.maximum(x.max(axis=1), ~x.min(axis=1)) if len(x) else np.zeros(0, np.int64)
                    width = np.searchsorted([127, 32767, 2**31 - 1], top, side="left")
                    for w in np.unique(width):
                        here = width == w
                        packed = x[here].astype(WIDTHS[w])
                        codes += [bytes([w]) + p.tobytes() for p in packed]
                        rows.append(some[here])
            order = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(order)), pa.array(sizes[order].astype(np.int32)), pa.array(codes, pa.binary())],
                                             names=["id", "d", "code"])

    return run


def encoded(embeddings: DataFrame, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, d, code) of the vectors that are not null or empty and have finite entries alone: floor(scale * c) of each entry, packed.

    A vector with an entry of 2 ** 62 or more after scaling goes too: no long holds its statistics.
    """
    rows = embeddings.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(F.col("v").isNotNull())
    return map_arrow(rows, _encode(scale), "id long, d int, code binary")


def decoded(codes: pa.Array, d: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix of their integers) in blocks of bounded size."""
    codes = codes.to_pylist()
    width = np.array([c[0] for c in codes], dtype=np.int64)
    step = max(1, BLOCK // d)
    for w in np.unique(width):
        members = np.flatnonzero(width == w)
        for at in range(0, len(members), step):
            some = members[at:at + step]
            yield some, np.frombuffer(b"".join([codes[i][1:] for i in some]), dtype=WIDTHS[w]).reshape(len(some), d).astype(np.int64)


def _sums(d: int):
    """Exact sums per dimension: the two halves of an entry are added up apart, so that nothing overflows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            for _, x in decoded(batch.column("code"), d):
                high, low = (x >> 31).sum(axis=0), (x & (2**31 - 1)).sum(axis=0)
                total = [t + (int(h) << 31) + int(w) for t, h, w in zip(total, high, low)]
                n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([str(t) for t in total]), pa.array([n] * d, pa.int64())],
                                             names=["i", "s", "n"])

    return run


@dataclass(frozen=True)
class Centre:
    """Sums of n vectors of integers."""

    n: int
    sums: tuple[int, ...]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: the whole part is taken off in integers, so that large entries lose no digits."""
        whole = [s // self.n for s in self.sums]
        part = [(s - w * self.n) / self.n for s, w in zip(self.sums, whole)]
        return (x - np.array(whole, dtype=np.int64)).astype(np.float64) - np.array(part)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - S) ** 2, exact; None where that is beyond a long."""
        most = max(abs(int(x.max())), abs(int(x.min()))) * self.n + max(map(abs, self.sums)) if len(x) else 0
        if most ** 2 * x.shape[1] < 2**63:
            t = x * self.n - np.array(self.sums, dtype=np.int64)
            return (t * t).sum(axis=1).tolist()
        exact = (sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist())
        return [v if v < 2**63 else None for v in exact]


def _products(centre: Centre, d: int, weights: np.ndarray | None):
    """Partial matrices of the products of centred vectors (or of what ``weights`` make of them), with the plain sums in a last row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = d if weights is None else weights.shape[1]
        total, seen = np.zeros((k + 1, k)), False
        for batch in batches:
            for _, x in decoded(batch.column("code"), d):
                y = centre.centred(x)
                if weights is not None:
                    y = y @ weights
                total[:k] += y.T @ y
                total[k] += y.sum(axis=0)
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(range(k + 1), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], names=["i", "row"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the rows with one number; a task holds one sum for each number that it has."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, row in zip(batch.column("i").to_pylist(), batch.column("row").to_pylist()):
            values = np.frombuffer(row)
            sums[i] = sums[i] + values if i in sums else values
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["i", "row"])


def covariance(codes: DataFrame, centre: Centre, d: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Covariance (divisor n) of the vectors, centred before they are multiplied, or of their products with ``weights``."""
    partial = map_arrow(codes.select("code"), _products(centre, d, weights), "i int, row binary")
    rows = map_arrow(partial.repartition("i"), _added, "i int, row binary").collect()
    total = np.array([np.frombuffer(r.row) for r in sorted(rows, key=lambda r: r.i)])
    mean = total[-1] / centre.n  # of centred values: zero but for rounding
    return total[:-1] / centre.n - np.outer(mean, mean)


@dataclass(frozen=True)
class Whitening:
    """What is fitted: sums, the leading eigenvalues and unit eigenvectors (columns), the trace, and how far the result is from white."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    scale: int = SCALE

    @property
    def weights(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)

    @property
    def explained(self) -> list[float]:
        return (self.values / self.trace).tolist()


def fit(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding") -> Whitening | None:
    """The whitening of all distinct vectors of integers, for vectors of the length that most of them have (the longer of two).

    Has up to ``components`` components: those whose eigenvalue can be told from zero (``LEAST_SHARE``).  None if there are no vectors, or none
    that differ.  Other columns, and repeated rows, do not matter.
    """
    distinct = checkpointed(encoded(embeddings, scale, key, vector).select("d", "code").distinct())
    lengths = distinct.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return None
    d = lengths.d
    codes = distinct.where(F.col("d") == d).select("code")
    parts = map_arrow(codes, _sums(d), "i int, s string, n long")
    sums = parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect()
    centre = Centre(sums[0].n, tuple(int(r.s) for r in sorted(sums, key=lambda r: r.i)))
    v = covariance(codes, centre, d)
    values, vectors = refined_eigenvectors(v)
    k = min(components, int((values > values[0] * d * LEAST_SHARE).sum()))
    if not k or not values[0] > 0:
        return None
    found = Whitening(centre, values[:k], vectors[:, :k], float(np.trace(v)), 0.0, scale)
    white = covariance(codes, centre, d, found.weights)
    return Whitening(centre, values[:k], vectors[:, :k], found.trace, float(np.abs(white - np.eye(k)).max()), scale)


def _applied(centre: Centre, weights: np.ndarray) -> Callable:
    d, k = weights.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, x in decoded(batch.column("code"), d):
                white = centre.centred(x) @ weights
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * k), pa.array(white.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(places)), pa.array(centre.deviations(x), pa.int64()), lists],
                                                 names=["id", "deviation", "whitened"])

    return run


def whiten(embeddings: DataFrame, fitted: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, deviation, whitened) for each vector that ``encoded`` keeps and that has the fitted length; the others give no row.

    ``whitened`` is an array, an entry per component; ``deviation`` is null where it is beyond a long.  Nothing fitted, no rows.
    """
    if fitted is None:
        return embeddings.select(F.col(key).cast("long").alias(key), F.lit(None).cast("long").alias("deviation"),
                                 F.lit(None).cast("array<double>").alias("whitened")).where(F.lit(False))
    rows = encoded(embeddings, fitted.scale, key, vector).where(F.col("d") == fitted.weights.shape[0]).select("id", "code")
    out = map_arrow(rows, _applied(fitted.centre, fitted.weights), "id long, deviation long, whitened array<double>")
    return out.withColumnRenamed("id", key)


def by_component(white: DataFrame, fitted: Whitening | None, key: str = "vec_id") -> DataFrame:
    """(key, component from 1, n, deviation, whitened, explained, identity_error): a row per vector and component."""
    each = white.select(key, "deviation", F.posexplode("whitened").alias("place", "whitened"))
    explained = F.array(*[F.lit(e) for e in fitted.explained]) if fitted else F.array(F.lit(0.0))
    return each.select(key, (F.col("place") + 1).alias("component"), F.lit(fitted.centre.n if fitted else 0).cast("long").alias("n"), "deviation", "whitened",
                       explained[F.col("place")].alias("explained"), F.lit(fitted.identity_error if fitted else 0.0).alias("identity_error"))
