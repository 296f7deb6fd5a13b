"""Fixed-size samples, exact stratified splits and folds, class weights.

Rows are ordered by a hash of their key, which must identify a row.  The rank
at which a sample or a class is cut is turned into the hash value found there
(``exact_cuts``), so membership is a comparison on each row: no window over a
class, no join, no shuffle of the data.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import draws
from .order_stats import exact_cuts

MAX_CLASSES = 10_000
ROWS_PER_SLICE = 250_000
MIN_SLICES = 32
MAX_TIES = 1000


# --- class counts -----------------------------------------------------------------

def class_counts(df: DataFrame, label: str, max_classes: int = MAX_CLASSES) -> dict[object, int]:
    """Rows per class, in label order.  Refuses a column that is no class label."""
    found = (df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
             .limit(max_classes + 1).collect())
    if len(found) > max_classes:
        raise ValueError(f"{label} has more than {max_classes} classes")
    return dict(sorted((r[0], r[1]) for r in found))


def balanced_weights(counts: Mapping[object, int]) -> dict[object, float]:
    """``rows / (classes * rows of the class)``."""
    total, k = sum(counts.values()), len(counts)
    return {c: total / (k * n) for c, n in counts.items()}


def per_class(label: str, table: Mapping) -> Column:
    """Value of ``table`` for the row's class; NULL for a class that is not in it."""
    out = None
    for key, value in table.items():
        test = F.col(label) == F.lit(key)
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    return out


def with_balanced_weights(df: DataFrame, label: str, out: str = "w") -> DataFrame:
    return df.withColumn(out, per_class(label, balanced_weights(class_counts(df, label))))


# --- cuts ---------------------------------------------------------------------------

def _expected_ranges(ranks: Mapping[object, Sequence[int]], totals: Mapping[object, int]) -> dict[object, list[tuple]]:
    """Hash ranges that hold the wanted ranks almost surely: uniform hashes, eight deviations each way."""
    out = {}
    for g, rs in ranks.items():
        n = totals[g]
        out[g] = []
        for r in rs:
            p = (r + 0.5) / n
            margin = 8 * math.sqrt(p * (1 - p) / n) + 8 / n
            lo, hi = max(0.0, p - margin), min(1.0, p + margin)
            out[g].append((int(lo * draws.RANK_SPAN), min(int(hi * draws.RANK_SPAN), draws.RANK_SPAN - 1)))
    return out


def _cut_points(df: DataFrame, hashed: Column, key: str, ranks: Mapping[object, Sequence[int]],
                label: str | None, totals: Mapping[object, int]) -> dict[tuple, tuple]:
    """Per (class, rank) the hash found there; equal hashes at a cut are settled by the key."""
    work = df.select(*([label] if label else []), F.col(key).alias("_k"), hashed.alias("_h"))
    ties: dict = {}
    ranks = {g: rs for g, rs in ranks.items() if rs}
    cuts = exact_cuts(work, "_h", ranks, label, {g: (0, draws.RANK_SPAN - 1) for g in ranks},
                      _expected_ranges(ranks, totals), ties=ties)
    out = {}
    for (g, rank), h in cuts.items():
        rows, below = ties[(g, rank)]
        if rows == 1:
            out[(g, rank)] = (h, None)
            continue
        at_cut = work.where((F.col("_h") == F.lit(h)) & (F.col(label) == F.lit(g) if label else F.lit(True)))
        keys = sorted(r["_k"] for r in at_cut.select("_k").limit(MAX_TIES).collect())
        if len(set(keys)) < rows:
            raise ValueError(f"{key} does not identify rows: {rows} rows share one hash, e.g. key {keys[0]!r}")
        out[(g, rank)] = (h, keys[rank - below])
    return out


def _up_to(hashed: Column, key: str, cut: tuple) -> Column:
    h, k = cut
    if k is None:
        return hashed <= F.lit(h)
    return (hashed < F.lit(h)) | ((hashed == F.lit(h)) & (F.col(key) <= F.lit(k)))


def sample_rows(df: DataFrame, key: str, k: int, seed: int, method: str = "xxhash64", total: int | None = None) -> DataFrame:
    """Exactly ``k`` rows (all rows if there are fewer) without replacement."""
    return with_sample_group(df, key, [k], seed, "_group", method, total).where(F.col("_group") == 0).drop("_group")


def with_sample_group(df: DataFrame, key: str, sizes: Sequence[int], seed: int, out: str,
                      method: str = "xxhash64", total: int | None = None) -> DataFrame:
    """Number of the group a row was sampled into, NULL for the rest.

    One sample without replacement is cut by sample position into consecutive
    groups of the given sizes; the groups are ranges of the row's hash.
    ``total``, the number of rows, is counted if it is not given.
    """
    hashed = draws.rank_hash(seed, key, method)
    total = df.count() if total is None else total
    ends, at = [], 0
    for size in sizes:
        at += size
        ends.append(min(at, total))
    cuts = _cut_points(df, hashed, key, {None: [e - 1 for e in ends if e > 0]}, None, {None: total})
    group = F.lit(None).cast("int")
    for i in reversed(range(len(ends))):
        if ends[i] > 0:
            group = F.when(_up_to(F.col("_h"), key, cuts[(None, ends[i] - 1)]), F.lit(i)).otherwise(group)
    return df.withColumn("_h", hashed).withColumn(out, group).drop("_h")


# --- split and folds ----------------------------------------------------------------

def allocate_test(counts: Mapping[object, int], test_share: float) -> dict[object, int]:
    """Test rows per class: ``ceil(share * n)`` in total, spread by largest remainder.

    Equal remainders go to the larger class first, then by label.
    """
    total = sum(counts.values())
    n_test = -int(-(total * round(test_share * 10**9)) // 10**9)
    if min(counts.values()) < 2:
        raise ValueError("a class with fewer than 2 rows cannot be split")
    if n_test < len(counts) or total - n_test < len(counts):
        raise ValueError("fewer train or test rows than classes")
    share = {c: divmod(n_test * n, total) for c, n in counts.items()}
    given = {c: q for c, (q, _) in share.items()}
    by_remainder = sorted(counts, key=lambda c: (-share[c][1], -counts[c], c))
    for c in by_remainder[:n_test - sum(given.values())]:
        given[c] += 1
    return given


def stratified_split(df: DataFrame, key: str, label: str, test_share: float = 0.2, seed: int = 42,
                     out: str = "is_test", method: str = "xxhash64") -> DataFrame:
    """Adds a boolean test mark with exact sizes per class; rows without a label get NULL."""
    counts = class_counts(df, label)
    n_test = allocate_test(counts, test_share)
    hashed = draws.rank_hash(seed, key, method)
    cuts = _cut_points(df, hashed, key, {c: [n - 1] for c, n in n_test.items() if n > 0}, label, counts)
    mark = None
    for c, n in n_test.items():
        test = _up_to(F.col("_h"), key, cuts[(c, n - 1)]) if n > 0 else F.lit(False)
        hit = F.col(label) == F.lit(c)
        mark = F.when(hit, test) if mark is None else mark.when(hit, test)
    return df.withColumn("_h", hashed).withColumn(out, mark).drop("_h")


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42, out: str = "fold",
                     method: str = "xxhash64", rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Shuffled stratified folds: one round-robin over the rows sorted by (class, hash, key).

    The rank inside a class is the number of rows in lower hash slices plus the
    position inside the slice.  Hashes are uniform, so slices are even however
    unbalanced the classes are.
    """
    counts = class_counts(df, label)
    if min(counts.values()) < k:
        raise ValueError(f"a class has fewer than {k} rows")
    start, at = {}, 0
    for c, n in counts.items():
        start[c] = at
        at += n
    slices = max(MIN_SLICES, -(-at // rows_per_slice))
    work = df.withColumn("_h", draws.rank_hash(seed, key, method)).withColumn(
        "_slice", F.floor(F.col("_h") / F.lit(draws.RANK_SPAN / slices)))
    sizes = work.where(F.col(label).isNotNull()).groupBy(label, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy(label).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(label).alias("_l"), F.col("_slice").alias("_s"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_below"))
    here = W.partitionBy(label, "_slice").orderBy("_h", key)
    twice = F.col(key) == F.lag(key).over(here)  # equal keys have equal hashes, so they are neighbours
    place = F.when(twice, F.raise_error(F.lit(f"{key} does not identify rows"))).otherwise(F.row_number().over(here))
    rank = F.col("_below") + place - 1 + per_class(label, start)
    return (work.join(offsets, (F.col(label) == F.col("_l")) & (F.col("_slice") == F.col("_s")), "left")
            .withColumn(out, F.when(F.col(label).isNotNull(), (rank % k).cast("int")))
            .select(*df.columns, out))


def block_folds(df: DataFrame, order: str, label: str, k: int = 3, out: str = "fold") -> DataFrame:
    """Unshuffled stratified folds: each class goes to folds in contiguous blocks of the input order.

    ``order`` is a whole number that identifies rows.  Fold sizes per class come
    from dealing the class-sorted rows round-robin, classes taken in the order
    in which they first appear.
    """
    found = (df.where(F.col(label).isNotNull()).groupBy(label)
             .agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("lo"), F.max(order).alias("hi"))
             .limit(MAX_CLASSES + 1).collect())
    if len(found) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    ends, spans, at = {}, {}, 0
    for r in sorted(found, key=lambda r: r["lo"]):
        if r["n"] < k:
            raise ValueError(f"class {r[0]!r} has fewer than {k} rows")
        size = [len(range(at + (f - at) % k, at + r["n"], k)) for f in range(k)]
        ends[r[0]] = [sum(size[:f + 1]) for f in range(k - 1)]
        spans[r[0]] = (r["lo"], r["hi"])
        at += r["n"]
    cuts = exact_cuts(df, order, {c: [e - 1 for e in es] for c, es in ends.items()}, label, spans)
    fold = None
    for c, es in ends.items():
        f = None
        for i, e in enumerate(es):
            test = F.col(order) <= F.lit(cuts[(c, e - 1)])
            f = F.when(test, F.lit(i)) if f is None else f.when(test, F.lit(i))
        f = f.otherwise(F.lit(k - 1))
        hit = F.col(label) == F.lit(c)
        fold = F.when(hit, f) if fold is None else fold.when(hit, f)
    return df.withColumn(out, fold)


def bernoulli_mask(key: str, p: float, seed: int, salt: str = "mask", method: str = "xxhash64") -> Column:
    return draws.uniform(seed, salt, key, method) < F.lit(float(p))
