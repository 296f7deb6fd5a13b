"""Cleaning: first of each key, dates, range rules, median imputation.

``fit_clean`` reads statistics once and ``apply_clean`` turns them into
literals, so applying is a narrow projection that training, batch scoring and
streams share.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import as_col, number, out_of_range, parse_dates
from .order_stats import column_facts, medians, quantiles

EPOCH = "1970-01-01 00:00:00"


# --- copies ---------------------------------------------------------------------------

def dedup_first(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row of each key in the given order.

    Spark limits each key to its first row before the shuffle as well
    (``WindowGroupLimit``), so a key that holds a large share of the rows
    reaches the reducer as one row per map task.
    """
    w = W.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def removed_rows(before: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows before, distinct keys, and the difference, from one pre-aggregated pass."""
    per_key = before.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_before"),
                       F.count(F.lit(1)).alias("rows_after"),
                       F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("removed"))


# --- statistics -------------------------------------------------------------------------

@dataclass(frozen=True)
class CleanStats:
    """What cleaning learned from a table; small, and the same for every later table."""

    range_rules: dict[str, tuple] = field(default_factory=dict)
    floor_rules: dict[str, tuple] = field(default_factory=dict)
    range_fill: dict[str, float | None] = field(default_factory=dict)
    impute_fill: dict[str, float | None] = field(default_factory=dict)
    date_column: str | None = None
    date_formats: tuple = ()
    date_fill_micros: int | None = None
    maxima: dict[str, float | None] = field(default_factory=dict)

    def to_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(json.dumps(asdict(self), ensure_ascii=False),)], "stats string")

    @staticmethod
    def from_table(df: DataFrame) -> CleanStats:
        raw = json.loads(df.first()["stats"])
        for name in ("range_rules", "floor_rules"):
            raw[name] = {k: tuple(v) for k, v in raw[name].items()}
        raw["date_formats"] = tuple(raw["date_formats"])
        return CleanStats(**raw)


def epoch_micros(c: str | Column) -> Column:
    """Microseconds since 1970 of a zone-free timestamp, whatever the session zone."""
    c = as_col(c).cast("timestamp_ntz")
    days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = F.hour(c) * 3600 + F.minute(c) * 60
    return (days * F.lit(86400) + seconds) * F.lit(1_000_000) + F.floor(F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")


def from_micros(micros: int) -> Column:
    seconds, rest = divmod(micros, 1_000_000)
    days, seconds = divmod(seconds, 86400)
    return F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(days), F.lit(0), F.lit(0), F.lit(seconds + rest / 1e6).cast("decimal(18,6)"))


def range_fixed(df: DataFrame, range_rules: Mapping[str, tuple], fill: Mapping[str, float | None]) -> DataFrame:
    new = {}
    for c, (lo, hi) in range_rules.items():
        x = number(c)
        new[c] = F.when(out_of_range(x, lo, hi), F.lit(fill[c]).cast("double")).otherwise(x)
    return df.withColumns(new) if new else df


def parsed(df: DataFrame, date_column: str | None, date_formats: Sequence[str]) -> DataFrame:
    if date_column is None or df.schema[date_column].dataType != T.StringType():
        return df
    return df.withColumn(date_column, parse_dates(date_column, date_formats))


def _instants(df: DataFrame, date_column: str | None, date_formats: Sequence[str]) -> list[Column]:
    if date_column is None:
        return []
    c = F.col(date_column)
    if df.schema[date_column].dataType == T.StringType():
        c = parse_dates(c, date_formats)
    return [epoch_micros(c).alias("_micros")]


def fit_clean(df: DataFrame, range_rules: Mapping[str, tuple], impute: Sequence[str],
              floor_rules: Mapping[str, tuple] | None = None, date_column: str | None = None,
              date_formats: Sequence[str] = (), maxima: Sequence[str] = (), approx: bool = False) -> CleanStats:
    """Learn fill values in two stages.

    Stage 1: medians of the range-checked columns as they are, absurd values
    included, and the median date, where an even count gives the middle of the
    two middle instants.  Stage 2, after the range fix: medians for imputation,
    and maxima.  Filling with a median cannot raise a maximum, so the maxima
    are those of the imputed columns too.
    """
    raw = df.select(*dict.fromkeys([*range_rules, *impute, *maxima]), *_instants(df, date_column, date_formats))
    checked = [*range_rules, *(["_micros"] if date_column is not None else [])]
    facts = None if approx else column_facts(raw, list(dict.fromkeys([*checked, *impute])))
    first = medians(raw, checked, facts=facts, approx=approx) if checked else {}
    date_fill = first.pop("_micros", None)
    # a median in place of other values changes neither the number of values nor the bounds they lie in
    fixed = range_fixed(raw, range_rules, first)
    second = quantiles(fixed, list(impute), [0.5], facts=facts,
                       also={f"max:{c}": F.max(number(c)) for c in maxima}, approx=approx)
    impute_fill = {c: second[c][0.5] for c in impute}
    tops = {c: second[f"max:{c}"] for c in maxima}
    range_fill, date_fill = first, None if date_fill is None else int(date_fill)
    return CleanStats(dict(range_rules), dict(floor_rules or {}), range_fill, impute_fill, date_column,
                      tuple(date_formats), date_fill, tops)


def apply_clean(df: DataFrame, stats: CleanStats) -> DataFrame:
    """Dates, range rules, floor rules, imputation: one narrow projection."""
    out = parsed(df, stats.date_column, stats.date_formats)
    if stats.date_column is not None and stats.date_fill_micros is not None:
        out = out.withColumn(stats.date_column, F.coalesce(F.col(stats.date_column),
                                                           from_micros(stats.date_fill_micros)))
    out = range_fixed(out, stats.range_rules, stats.range_fill)
    new = {}
    for c, (lo, value) in stats.floor_rules.items():
        x = number(c)
        new[c] = F.when(out_of_range(x, lo), F.lit(float(value))).otherwise(x)
    out = out.withColumns(new) if new else out
    fills = {c: F.coalesce(number(c), F.lit(v).cast("double")) for c, v in stats.impute_fill.items()}
    return out.withColumns(fills) if fills else out


# --- counts ------------------------------------------------------------------------------

def violations(df: DataFrame, range_rules: Mapping[str, tuple]) -> DataFrame:
    """Rows outside the rule, per column; one pass."""
    counted = df.agg(*[F.count_if(out_of_range(number(c), lo, hi)).alias(c) for c, (lo, hi) in range_rules.items()])
    return unpivoted(counted, "column_name", "violations")


def unpivoted(one_row: DataFrame, name: str, value: str) -> DataFrame:
    return one_row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in one_row.columns])).alias("_s")).select("_s.*")


def null_counts(df: DataFrame, columns: Sequence[str], value: str = "nulls") -> DataFrame:
    """Missing values per column; one pass."""
    return unpivoted(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]), "column_name", value)
