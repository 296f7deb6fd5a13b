"""Exact order statistics and prefix sums with bounded state per task.

Spark's exact ``median``/``percentile`` keeps every distinct value of a group
in one aggregation buffer, and an unpartitioned window pulls all rows into one
task.  Neither holds for a continuous column at scale, so:

* ``exact_cuts`` narrows a bracket around each wanted rank with histograms of a
  fixed number of bins.  Each pass is one map-side combined aggregate; only the
  bins reach the driver, and a pass divides the candidates by about the number
  of bins.
* ``quantiles`` starts ``exact_cuts`` with ranges from a quantile sketch, so that the
  first histogram is already fine where the answers lie.
* ``prefix_sums`` range-partitions, so that no window covers a whole group.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import number
from ..sources.tables import stage

BINS = 2048
SMALL_BRACKET = 4096
LARGEST = sys.float_info.max
#: Ranks are guessed from a sketch as accurate as one part in this many, with twice the margin.
SKETCH_ACCURACY = 2000


def exact_cuts(df: DataFrame, value: str, ranks: Mapping[object, Sequence[int]], group: str | None = None,
               spans: Mapping[object, tuple] | None = None, guesses: Mapping[object, Sequence[tuple]] | None = None,
               bins: int = BINS, small: int = SMALL_BRACKET, ties: dict | None = None) -> dict[tuple, object]:
    """Exact value at each 0-based rank (ascending, missing values left out) of each group.

    ``ranks`` maps a group to its wanted ranks; without ``group`` use the key
    ``None``.  ``spans`` gives bounds per group, tight or not, and saves a pass.
    ``guesses`` gives ranges per group that probably hold the answers; a wrong
    guess costs a pass, never the result.
    Returns ``{(group, rank): value}``; ``ties`` receives, per key, how many rows
    have the value and how many rows of the group are below it.
    """
    src = df.select((F.col(group) if group else F.lit(None).cast("string")).alias("_g"),
                    F.col(value).alias("_v"))
    open_ranks = {g: sorted(set(rs)) for g, rs in ranks.items() if len(rs)}
    if not open_ranks:
        return {}
    if spans is None:
        found = src.where(_member(open_ranks)).groupBy("_g").agg(F.min("_v"), F.max("_v")).collect()
        spans = {r[0]: (r[1], r[2]) for r in found}
    whole = dict(src.dtypes)["_v"] in ("bigint", "int", "smallint", "tinyint")
    ties = {} if ties is None else ties
    done: dict[tuple, object] = {}

    # first pass: the guessed ranges are cut finely, the stretches between them are only counted
    segments = []
    for g in open_ranks:
        lo, hi = spans[g]
        infinite = [x for x in (-math.inf, math.inf) if not whole and x in (lo, hi)]  # these have no place among bins
        segments += [Segment(g, x, x, fine=False, closed=True) for x in infinite if x < 0]
        above = [Segment(g, x, x, fine=False, closed=True) for x in infinite if x > 0]
        if not whole:
            lo, hi = max(lo, -LARGEST), min(hi, LARGEST)
        at = lo
        for a, b in _merged((guesses or {}).get(g) or [(lo, hi)]):
            a, b = max(a, at), min(b, hi)
            if a > b:
                continue
            if a > at:
                segments.append(Segment(g, at, a, fine=False, closed=False))
            segments.append(Segment(g, a, b, fine=True, closed=True))
            at = b
        if at < hi:
            segments.append(Segment(g, at, hi, fine=False, closed=True))
        segments += above
    targets = {g: [(r, 0) for r in rs] for g, rs in open_ranks.items()}
    counted = _histogram(src, segments, bins, whole)
    brackets = _locate(targets, {g: [r for k, s in enumerate(segments) if s.group == g for r in counted.get(k, [])]
                                 for g in open_ranks}, done, ties)

    # later passes: one bracket per undecided bin
    while brackets:
        if all(n <= small for n, _ in brackets.values()):
            done.update(_finish(src, brackets, ties))
            break
        segments = [Segment(g, lo, hi, fine=True, closed=True) for g, lo, hi in brackets]
        counted = _histogram(src, segments, bins, whole)
        narrower: dict = {}
        for k, ((g, _, _), (_, wanted)) in enumerate(brackets.items()):
            narrower.update(_locate({g: wanted}, {g: counted.get(k, [])}, done, ties))
        if narrower.keys() == brackets.keys():
            raise RuntimeError(f"the values of {value} change from one reading to the next")
        brackets = narrower
    return done


@dataclass(frozen=True)
class Segment:
    """A stretch of one group's values; ``fine`` ones are cut into bins."""

    group: object
    lo: object
    hi: object
    fine: bool
    closed: bool

    def test(self) -> Column:
        upper = F.col("_v") <= F.lit(self.hi) if self.closed else F.col("_v") < F.lit(self.hi)
        return F.col("_g").eqNullSafe(F.lit(self.group)) & (F.col("_v") >= F.lit(self.lo)) & upper

    def position(self, bins: int, whole: bool) -> Column:
        if not self.fine or self.lo == self.hi:
            return F.lit(0).cast("long")
        if whole:
            width = max(1, -(-(self.hi - self.lo + 1) // bins))
            at = F.floor((F.col("_v") - F.lit(self.lo)) / F.lit(float(width)))
        elif math.isfinite(self.hi - self.lo):
            at = F.floor((F.col("_v") - F.lit(self.lo)) / F.lit(self.hi - self.lo) * F.lit(float(bins)))
        else:
            at = F.floor((F.col("_v") / 2 - F.lit(self.lo / 2)) / F.lit(self.hi / 2 - self.lo / 2) * F.lit(float(bins)))
        return F.least(at, F.lit(bins - 1))


def _member(groups) -> Column:
    test = F.lit(False)
    for g in groups:
        test = test | F.col("_g").eqNullSafe(F.lit(g))
    return test


def _merged(ranges: Sequence[tuple]) -> list[tuple]:
    out: list[tuple] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _histogram(src: DataFrame, segments: Sequence[Segment], bins: int, whole: bool) -> dict[int, list]:
    """Rows, smallest and largest value per bin of each segment, in value order.  One aggregate.

    Rows outside all segments form one more group that is left out at the end;
    a filter would be pushed down and compute the value again in every test.
    """
    which = position = None
    for k, segment in enumerate(segments):
        test, at = segment.test(), segment.position(bins, whole)
        which = F.when(test, F.lit(k)) if which is None else which.when(test, F.lit(k))
        position = F.when(F.col("_b") == k, at) if position is None else position.when(F.col("_b") == k, at)
    binned = src.withColumn("_b", which).select("_b", position.alias("_i"), "_v")
    rows = binned.groupBy("_b", "_i").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"),
                                          F.max("_v").alias("hi")).collect()
    out: dict[int, list] = {}
    for r in sorted((r for r in rows if r["_b"] is not None), key=lambda r: (r["_b"], r["_i"])):
        out.setdefault(r["_b"], []).append(r)
    return out


def _locate(targets: Mapping[object, Sequence[tuple]], counted: Mapping[object, Sequence], done: dict,
            ties: dict) -> dict[tuple, tuple]:
    """Find the bin of each wanted rank: a single value settles it, else the bin becomes a bracket.

    Brackets map (group, lo, hi) to (rows, [(rank, rows below lo)]).
    """
    brackets: dict[tuple, tuple] = {}
    for g, wanted in targets.items():
        for rank, below in wanted:
            at = below
            for r in counted[g]:
                if rank < at + r["n"]:
                    if r["lo"] == r["hi"]:
                        done[(g, rank)] = r["lo"]
                        ties[(g, rank)] = (r["n"], at)
                    else:
                        brackets.setdefault((g, r["lo"], r["hi"]), (r["n"], []))[1].append((rank, at))
                    break
                at += r["n"]
            else:
                raise ValueError(f"rank {rank} is beyond the rows of group {g!r}")
    return brackets


def _finish(src: DataFrame, brackets: Mapping, ties: dict) -> dict:
    """Read the few values left in each bracket, as value and count."""
    which = None
    for k, (g, lo, hi) in enumerate(brackets):
        test = Segment(g, lo, hi, fine=True, closed=True).test()
        which = F.when(test, F.lit(k)) if which is None else which.when(test, F.lit(k))
    near = src.withColumn("_b", which).select("_b", F.when(F.col("_b").isNotNull(), F.col("_v")).alias("_v"))
    left = near.groupBy("_b", "_v").agg(F.count(F.lit(1)).alias("n")).collect()
    found = {}
    for k, ((g, _, _), (_, targets)) in enumerate(brackets.items()):
        ordered = sorted((r["_v"], r["n"]) for r in left if r["_b"] == k)
        for rank, below in targets:
            at = below
            for v, n in ordered:
                at += n
                if rank < at:
                    found[(g, rank)] = v
                    ties[(g, rank)] = (n, at - n)
                    break
    return found


@dataclass(frozen=True)
class ColumnFacts:
    """How many values a column has, between which bounds, and where a sketch sees the wanted quantiles."""

    values: int
    low: float | None
    high: float | None
    ranges: Mapping[float, tuple] = field(default_factory=dict)


def column_facts(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float] = (0.5,)) -> dict[str, ColumnFacts]:
    """Facts of all columns in one pass."""
    if not columns:
        return {}
    margin = 2 / SKETCH_ACCURACY
    wanted = [min(1.0, max(0.0, p + d)) for p in probabilities for d in (-margin, margin)]
    row = df.agg(*[a for i, c in enumerate(columns) for a in (
        F.count(number(c)).alias(f"n{i}"), F.min(number(c)).alias(f"l{i}"), F.max(number(c)).alias(f"h{i}"),
        F.percentile_approx(number(c), wanted, SKETCH_ACCURACY).alias(f"q{i}"))]).first()
    return {c: ColumnFacts(row[f"n{i}"], row[f"l{i}"], row[f"h{i}"],
                           {p: tuple(row[f"q{i}"][2 * j:2 * j + 2]) for j, p in enumerate(probabilities)} if row[f"q{i}"] else {})
            for i, c in enumerate(columns)}


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], approx: bool = False,
              facts: Mapping[str, ColumnFacts] | None = None, also: Mapping[str, Column] | None = None) -> dict[str, dict]:
    """Interpolated quantiles per column, missing values skipped.

    Exact by default.  ``approx=True`` uses ``percentile_approx``: one pass, no
    interpolation, for when an existing value close to the quantile will do.
    ``facts`` saves the counting pass; its bounds and ranges may be off.  ``also`` names further aggregates to
    read along; they come back under their names.
    """
    probabilities = [float(p) for p in probabilities]
    extra = [c.alias(f"also:{name}") for name, c in (also or {}).items()]
    out: dict[str, dict] = {c: dict.fromkeys(probabilities) for c in columns}
    aggregates = [F.percentile_approx(number(c), probabilities, 10000).alias(c) for c in columns] if approx else []
    if aggregates or extra:
        row = df.agg(*aggregates, *extra).first()
        out.update({c: dict(zip(probabilities, row[c])) for c in (columns if approx else ()) if row[c]})
        out.update({name: row[f"also:{name}"] for name in also or {}})
    if approx:
        return out
    facts = facts or column_facts(df, columns, probabilities)
    present = [c for c in columns if facts[c].values > 0]
    if not present:
        return out
    long_form = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("_c"), number(c).alias("_x")) for c in present])).alias("_s")).select("_s.*")
    places = {c: [(facts[c].values - 1) * p for p in probabilities] for c in present}
    guesses = {c: [r for r in facts[c].ranges.values() if all(map(math.isfinite, r))] for c in present}
    cuts = exact_cuts(long_form, "_x", {c: [k for at in ats for k in (math.floor(at), math.ceil(at))]
                                        for c, ats in places.items()}, "_c",
                      {c: (facts[c].low, facts[c].high) for c in present}, guesses)
    for c, ats in places.items():
        for p, at in zip(probabilities, ats):
            a, b = cuts[(c, math.floor(at))], cuts[(c, math.ceil(at))]
            out[c][p] = a if a == b else (math.ceil(at) - at) * a + (at - math.floor(at)) * b
    return out


def medians(df: DataFrame, columns: Sequence[str], **options) -> dict[str, float | None]:
    found = quantiles(df, columns, [0.5], **options)
    return {c: found[c][0.5] for c in columns}


def prefix_sums(df: DataFrame, part: Sequence[str], order: Sequence[str], sums: Mapping[str, str],
                name: str = "prefix") -> DataFrame:
    """Exclusive running sums: ``sums`` maps a new column to the column it accumulates.

    The rows are range-partitioned by (part, order) and staged, so the slice a
    row belongs to is a stored fact; totals per slice are then accumulated over
    the (few) slices and added to a running sum inside each slice.  Rows with
    equal (part, order) share a slice, so aggregate ties first.
    """
    keys = [*part, *order]
    sliced = stage(df.repartitionByRange(*keys).withColumn("_slice", F.spark_partition_id()), name)
    totals = sliced.groupBy(*part, "_slice").agg(*[F.sum(src).alias(f"_t_{new}") for new, src in sums.items()])
    earlier = W.partitionBy(*part).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(*part, "_slice", *[
        F.coalesce(F.sum(f"_t_{new}").over(earlier), F.lit(0)).alias(f"_o_{new}") for new in sums])
    inside = W.partitionBy(*part, "_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    joined = sliced.join(offsets, [*part, "_slice"])
    return joined.select(*df.columns, *[
        (F.col(f"_o_{new}") + F.coalesce(F.sum(src).over(inside), F.lit(0))).alias(new)
        for new, src in sums.items()])
