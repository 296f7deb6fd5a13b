"""Profiles: counts, shares, exact describe, best row, clean-table summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import number, round_half_even
from ..sources.tables import stage
from .clean import epoch_micros, unpivoted
from .order_stats import ColumnFacts, quantiles


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("long"))


#: Fingerprints that occur twice are broadcast to the rows up to this number (of two longs); beyond it they are joined by a shuffle.
BROADCAST_FINGERPRINTS = 1_000_000


def fingerprint(columns: Sequence[str]) -> dict[str, Column]:
    """Two 64-bit hashes of a row, ``_f1`` and ``_f2``; missing values count as such, wherever they are."""
    parts = [part for c in columns for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return {f"_f{i}": F.xxhash64(F.lit(i), *parts) for i in (1, 2)}


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column; missing equals missing.

    Only 16 bytes a row are shuffled to find the fingerprints that occur twice; whole rows are compared where they do, and nowhere else.
    """
    marked = df.withColumns(fingerprint(df.columns))
    again = stage(marked.groupBy("_f1", "_f2").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_f1", "_f2"), "fingerprints")
    few = again.limit(BROADCAST_FINGERPRINTS + 1).count() <= BROADCAST_FINGERPRINTS
    candidates = marked.join(F.broadcast(again) if few else again, ["_f1", "_f2"], "left_semi")
    per_row = candidates.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return per_row.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def dirty_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count, missing values per column and full-row duplicates, as one table.

    Counts are added up where the rows are read; duplicates are found as in ``duplicate_rows``.
    """
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"nulls:{c}") for c in columns])
    counts = counted.select(F.inline(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(f"`{c}`").alias("value")) for c in counted.columns])))
    return counts.unionByName(duplicate_rows(df).select(F.lit("duplicates").alias("measure"), F.col("duplicates").alias("value")))


def global_stats(df: DataFrame, column: str) -> DataFrame:
    x = number(column)
    return df.agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("min_value"), F.max(x).alias("max_value"),
                  F.avg(x).alias("mean_value"))


def literal_rows(spark: SparkSession, column: str, values: Sequence) -> DataFrame:
    """A small dimension of declared values as a one-column table, made on the JVM side."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in values])).alias(column))


def value_counts(df: DataFrame, column: str, domain: Sequence | None = None) -> DataFrame:
    """Counts by value, largest first, missing left out; with ``domain`` its absent values count 0."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    if domain is not None:
        wanted = literal_rows(df.sparkSession, column, domain)
        counts = wanted.join(counts, column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))
    return counts.orderBy(F.desc("n"), column)


def value_shares(df: DataFrame, column: str, dp: int = 1) -> DataFrame:
    """Percent of the non-missing rows by value, as number and as text.

    The total is a scalar subquery, so no task sees the counts of all values.
    """
    known = df.where(F.col(column).isNotNull())
    counts = known.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = known.select(F.count(F.lit(1))).scalar()
    share = F.col("n").cast("double") / total * F.lit(100.0)
    percent = round_half_even(share, dp)
    return (counts.select(column, "n", percent.alias("percent"))
            .withColumn("percent_text", F.format_string(f"%.{dp}f%%", F.col("percent")))
            .orderBy(F.desc("n"), column))


def share_of(column: str, value) -> Column:
    """Aggregate expression: percent of all rows, missing ones included, that equal ``value``."""
    return F.avg(F.coalesce(F.col(column) == F.lit(value), F.lit(False)).cast("int")) * F.lit(100.0)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


STATISTICS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]


def _is_date(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() in ("date", "timestamp", "timestamp_ntz")


def describe(df: DataFrame, columns: Sequence[str], dp: int = 2, facts: Mapping[str, ColumnFacts] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, one row per column.

    A date column is described in days since 1970, with fractions.
    """
    as_numbers = df.select(*[(epoch_micros(c) / F.lit(86_400_000_000.0)).alias(c) if _is_date(df, c) else F.col(c) for c in columns])
    quartiles = quantiles(as_numbers, columns, [0.25, 0.5, 0.75], facts=facts)
    moments = as_numbers.agg(*[F.struct(
        F.count(number(c)).alias("count"), F.avg(number(c)).alias("mean"), F.stddev_samp(number(c)).alias("std"),
        F.min(number(c)).alias("min"), F.max(number(c)).alias("max")).alias(c) for c in columns])
    rows = []
    for c in columns:
        q = quartiles[c]
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.col(f"{c}.count").alias("count"),
            *[round_half_even(F.col(f"{c}.{m}"), dp).alias(a) for m, a in (("mean", "mean"), ("std", "std"), ("min", "min"))],
            *[round_half_even(F.lit(q[p]).cast("double"), dp).alias(a) for p, a in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))],
            round_half_even(F.col(f"{c}.max"), dp).alias("max")))
    return moments.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def first_best(df: DataFrame, metric: str, position: str) -> DataFrame:
    """Row with the largest metric; the first one on a tie, a missing metric last."""
    return df.orderBy(F.desc_nulls_last(metric), position).limit(1)


def preview(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(key).limit(n)


def clean_summary(df: DataFrame, score: str, tier: str, tiers: Sequence[str]) -> DataFrame:
    """Rows, columns, missing values, mean score and tier shares in one pass."""
    missing = F.lit(0).cast("long")
    for c in df.columns:
        missing = missing + F.count_if(F.col(c).isNull())
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"),
                  missing.alias("nulls"), round_half_even(F.avg(score), 2).alias("mean_score"),
                  *[round_half_even(share_of(tier, t), 1).alias(f"pct_{t.lower()}") for t in tiers])


def null_counts_before_after(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    b = unpivoted(before.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]), "column_name", "nulls_before")
    a = unpivoted(after.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]), "column_name", "nulls_after")
    return b.join(a, "column_name")
