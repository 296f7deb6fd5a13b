"""Synthetic tables as Spark jobs: every value is a hash draw of the row's key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import draws
from ..functions.scalar import padded_id


def synthesize(base: DataFrame, key: str, spec: Sequence[tuple], seed: int, method: str = "xxhash64",
               keep: Sequence[str] = ()) -> DataFrame:
    """One drawn row per row of ``base``; ``key`` must identify rows.

    A narrow plan at any size: no shuffle and no dependence on partitioning.
    The uniforms are projected first, a column each, and the draws refer to them; those of columns that nobody reads are not drawn.
    """
    salts = [name + part for name, kind, *_ in spec for part in draws.uniforms_needed(kind)]
    at = {salt: f"_u{i}" for i, salt in enumerate(salts)}
    columns = {name: draws.draw(kind, args, [at[name + part] for part in draws.uniforms_needed(kind)])
               for name, kind, *args in spec}
    kept = [key, *[k for k in keep if k != key]]
    projected = base.select(*kept, *[draws.uniform(seed, salt, key, method).alias(at[salt]) for salt in salts])
    return projected.select(*kept, *[c.alias(n) for n, c in columns.items()])


def row_numbers(spark: SparkSession, n: int) -> DataFrame:
    """Keys 0 .. n-1 in a column ``n``."""
    return spark.range(n).withColumnRenamed("id", "n")
