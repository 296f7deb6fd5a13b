"""Fault injection, so that the repair can be tested: nulls, absurd values, bad dates, copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import draws
from .sample import sample_rows, with_sample_group


def inject_nulls(df: DataFrame, key: str, columns: Sequence[str], p: float, seed: int,
                 method: str = "xxhash64") -> DataFrame:
    """Each listed column loses each value independently with probability ``p``."""
    u = draws.uniforms(seed, [f"null.{c}" for c in columns], key, method)
    lost = {c: F.when(F.col("_u")[i] < F.lit(float(p)), F.lit(None)).otherwise(F.col(c)) for i, c in enumerate(columns)}
    return df.withColumn("_u", u).withColumns(lost).drop("_u")


def inject_outliers(df: DataFrame, key: str, outliers: Sequence[tuple[str, Sequence]], per_column: int,
                    seed: int, method: str = "xxhash64", total: int | None = None) -> DataFrame:
    """One sample, cut into consecutive groups; group i gets absurd values in column i.

    The groups are hash ranges, so this is a narrow projection of the input.
    """
    marked = with_sample_group(df, key, [per_column] * len(outliers), seed, "_group", method, total)
    u = draws.uniforms(seed, [f"outlier.{c}" for c, _ in outliers], key, method)
    new = {}
    for i, (column, values) in enumerate(outliers):
        bad = draws.choice(f"_u[{i}]", list(values)).cast(df.schema[column].dataType)
        new[column] = F.when(F.col("_group") == i, bad).otherwise(F.col(column))
    return marked.withColumn("_u", u).withColumns(new).drop("_u", "_group")


def inject_texts(df: DataFrame, key: str, column: str, texts: Sequence[str], k: int, seed: int,
                 method: str = "xxhash64", total: int | None = None) -> DataFrame:
    """Overwrite ``column`` with one of ``texts`` in exactly ``k`` sampled rows."""
    marked = with_sample_group(df, key, [k], seed, "_group", method, total)
    drawn = marked.withColumn("_u", draws.uniform(seed, f"text.{column}", key, method))
    bad = draws.choice("_u", list(texts))
    return drawn.withColumn(column, F.when(F.col("_group") == 0, bad).otherwise(F.col(column))).drop("_group", "_u")


def append_copies(df: DataFrame, key: str, k: int, seed: int, method: str = "xxhash64", total: int | None = None) -> DataFrame:
    """Append exact copies of ``k`` sampled rows."""
    return df.unionByName(sample_rows(df, key, k, seed, method, total))
