"""Scalar expressions: rounding, binning, lookups, dates, rule scores.

Each function takes and returns Spark Columns, so everything stays inside
whole-stage code generation and Catalyst can push and prune through it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: ColumnOrName) -> Column:
    """Double with NaN turned into NULL, the only spelling of "missing" used here."""
    return F.nanvl(as_col(c).cast("double"), F.lit(None).cast("double"))


def round_half_even(c: ColumnOrName, dp: int = 0) -> Column:
    """Round by scaling, rounding half to even and scaling back, as NumPy and pandas do."""
    if dp == 0:
        return F.rint(as_col(c))
    scale = F.lit(10.0**dp)
    return F.rint(as_col(c) * scale) / scale


def round_decimal(c: ColumnOrName, dp: int = 2) -> Column:
    """Round as Python's ``round`` does: by the exact binary value, ties to even.

    Scaling may round a value onto a tie (2.675 * 100 gives 267.5 although 2.675
    is stored a little below).  The scaling error is exact in two halves of the
    value, and on a tie its sign decides.  Give it a plain column: the value is
    used many times over.
    """
    x, scale = as_col(c), F.lit(10.0**dp)
    split = x * F.lit(134217729.0)
    high = split - (split - x)
    product = x * scale
    error = (high * scale - product) + (x - high) * scale
    tie = F.abs(product - F.rint(product)) == F.lit(0.5)
    units = F.when(tie & (error > 0), F.ceil(product).cast("double")).when(
        tie & (error < 0), F.floor(product).cast("double")).otherwise(F.rint(product))
    return units / scale


def clip(c: ColumnOrName, lo, hi) -> Column:
    """Clamp into [lo, hi].  NULL stays NULL (``least``/``greatest`` alone would skip it)."""
    c = as_col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def capped(c: ColumnOrName, cap) -> Column:
    c = as_col(c)
    return F.when(c > F.lit(cap), F.lit(cap)).otherwise(c)


def floored(c: ColumnOrName, floor) -> Column:
    c = as_col(c)
    return F.when(c < F.lit(floor), F.lit(floor)).otherwise(c)


def out_of_range(c: ColumnOrName, lo=None, hi=None) -> Column:
    """True outside [lo, hi]; missing counts as inside."""
    c = as_col(c)
    tests = []
    if lo is not None:
        tests.append(c < F.lit(lo))
    if hi is not None:
        tests.append(c > F.lit(hi))
    hit = tests[0]
    for t in tests[1:]:
        hit = hit | t
    return F.coalesce(hit, F.lit(False))


def overwrite_where(c: ColumnOrName, mask: Column, value) -> Column:
    return F.when(mask, value if isinstance(value, Column) else F.lit(value)).otherwise(as_col(c))


def flag_contains(c: ColumnOrName, needles: Sequence[str]) -> Column:
    """1 if any needle occurs in the text, else 0; missing text gives 0."""
    c = as_col(c)
    hit = F.contains(c, F.lit(needles[0]))
    for n in needles[1:]:
        hit = hit | F.contains(c, F.lit(n))
    return F.coalesce(hit, F.lit(False)).cast("int")


def flag_above(c: ColumnOrName, threshold) -> Column:
    return F.coalesce(as_col(c) > F.lit(threshold), F.lit(False)).cast("int")


def lookup(c: ColumnOrName, mapping: Mapping, strict: bool = False) -> Column:
    """Dictionary lookup; a miss gives NULL, or raises at run time when ``strict``."""
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    hit = F.element_at(table, as_col(c))
    if not strict:
        return hit
    complaint = F.concat(F.lit("no entry for key "), F.coalesce(as_col(c).cast("string"), F.lit("NULL")))
    return F.coalesce(hit, F.raise_error(complaint))


def cut(c: ColumnOrName, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(edge, next edge]``; outside every bin or missing gives NULL.

    Tested from the top, so that each edge is compared once: filters on the
    result are pushed down with the whole expression in place of ``c``.
    """
    c = as_col(c)
    out = F.when(c > F.lit(edges[-1]), F.lit(None).cast("string"))
    for lo, label in reversed(list(zip(edges[:-1], labels))):
        out = out.when(c > F.lit(lo), F.lit(label))
    return out


def text_or_nan(c: ColumnOrName) -> Column:
    """Text cast in which a missing value becomes the text ``nan``."""
    return F.coalesce(as_col(c).cast("string"), F.lit("nan"))


def by_case(c: ColumnOrName, cases: Mapping, default) -> Column:
    c = as_col(c)
    out = None
    for key, value in cases.items():
        out = F.when(c == F.lit(key), F.lit(value)) if out is None else out.when(c == F.lit(key), F.lit(value))
    return out.otherwise(F.lit(default))


def strip(c: ColumnOrName) -> Column:
    """Remove leading and trailing whitespace of every kind, not just blanks."""
    return F.regexp_replace(as_col(c), r"^\s+|\s+$", "")


_LENIENT = {"MM": "M", "dd": "d"}


def parse_dates(c: ColumnOrName, formats: Sequence[str], lenient: bool = True) -> Column:
    """First format that matches wins, otherwise NULL.

    ``lenient`` accepts months and days without the leading zero.  The result
    is a zone-free timestamp: the session time zone never shifts it.
    """
    text = strip(c)
    hits = []
    for f in formats:
        if lenient:
            for long, short in _LENIENT.items():
                f = f.replace(long, short)
        hits.append(F.try_to_date(text, f))
    return F.coalesce(*hits).cast("timestamp_ntz")


def ratio(a: ColumnOrName, b: ColumnOrName, dp: int = 4) -> Column:
    return round_half_even(F.try_divide(as_col(a).cast("double"), as_col(b).cast("double")), dp)


def climate_index(rain: ColumnOrName, visibility: ColumnOrName, max_rain: float, max_visibility: float,
                  dp: int = 4) -> Column:
    """Half rain share, half lost-visibility share, against the given maxima."""
    wet = F.try_divide(as_col(rain), F.lit(float(max_rain))) * F.lit(0.5)
    blind = (F.lit(1.0) - F.try_divide(as_col(visibility), F.lit(float(max_visibility)))) * F.lit(0.5)
    return round_half_even(wet + blind, dp)


def scorecard(terms: Sequence[Column], noise: Column | None = None, lo: float = 0.0, hi: float = 100.0,
              dp: int = 2) -> Column:
    """Sum of the terms plus noise, clipped and rounded.  A missing term makes the score missing."""
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    if noise is not None:
        total = total + noise
    return round_half_even(clip(total, float(lo), float(hi)), dp)


def weighted_score(probabilities: Mapping[str, Column], weights: Mapping[str, float], dp: int = 2) -> Column:
    """Sum of weight times probability over named classes, in the order of ``weights``."""
    total = None
    for label, weight in weights.items():
        part = probabilities[label] * F.lit(float(weight))
        total = part if total is None else total + part
    return round_half_even(total, dp)


def percent_text(c: ColumnOrName, missing: str = "N/A") -> Column:
    """Percent with one decimal, ties to even; the JVM's own formatting would round ties up."""
    c = as_col(c)
    percent = round_half_even(c * F.lit(100.0), 1)
    return F.when(c.isNull(), F.lit(missing)).otherwise(F.format_string("%.1f%%", percent))


def text_bar(c: ColumnOrName, width: int = 20, block: str = "█") -> Column:
    return F.repeat(F.lit(block), F.floor(as_col(c) * F.lit(float(width))).cast("int"))


def padded_id(prefix: str, n: ColumnOrName, digits: int) -> Column:
    """Prefix plus zero-padded number; longer numbers keep all their digits."""
    return F.format_string(f"{prefix}%0{digits}d", as_col(n).cast("long"))


def step_date_text(n: ColumnOrName, start: str = "2022-01-01", step_hours: int = 8) -> Column:
    """``yyyy-MM-dd`` text of ``start + n * step``, n counted from 0."""
    n = as_col(n).cast("long")
    days = F.floor(n * F.lit(step_hours) / F.lit(24.0)).cast("int")
    return F.date_format(F.date_add(F.lit(start).cast("date"), days), "yyyy-MM-dd")
