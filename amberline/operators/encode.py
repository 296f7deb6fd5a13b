"""Label encoding: the code of a value is its 0-based rank among the distinct texts, in code-point order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import lookup, text_or_nan
from .order_stats import prefix_sums

MAX_LABELS = 10_000


def _texts(df: DataFrame, columns: Sequence[str], missing_as_text: bool) -> DataFrame:
    return df.withColumns({c: text_or_nan(c) if missing_as_text else F.col(c).cast("string") for c in columns})


def fit_labels(df: DataFrame, columns: Sequence[str], missing_as_text: bool = False,
               max_labels: int = MAX_LABELS) -> dict[str, list[str]]:
    """Sorted distinct texts per column, all columns in one map-side combined pass.

    For columns of category size; ``label_table`` has no such bound.
    """
    values = _texts(df.select(*columns), columns, missing_as_text).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in columns])).alias("s")).select("s.*")
    limit = max_labels * len(columns)
    found = values.where(F.col("v").isNotNull()).distinct().limit(limit + 1).collect()
    labels: dict[str, list[str]] = {c: [] for c in columns}
    for r in found:
        labels[r["c"]].append(r["v"])
    for c, vs in labels.items():
        if len(vs) > max_labels or len(found) > limit:
            raise ValueError(f"{c} has too many labels for a label list; use label_table")
        vs.sort()
    return labels


def from_catalogs(catalogs: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
    """Label lists of fixed catalogs instead of fitted ones."""
    return {c: sorted(set(values)) for c, values in catalogs.items()}


def encode(df: DataFrame, labels: Mapping[str, Sequence[str]], suffix: str = "_cod",
           missing_as_text: bool = False) -> DataFrame:
    """Integer codes next to each column; a value outside its label list, or a missing one, is a run-time error."""
    return df.withColumns({c + suffix: lookup(text_or_nan(c) if missing_as_text else F.col(c).cast("string"),
                                              {v: i for i, v in enumerate(labels[c])}, strict=True) for c in labels})


def decode(df: DataFrame, code: str, labels: Sequence[str], out: str) -> DataFrame:
    """Text of a code."""
    return df.withColumn(out, F.element_at(F.array(*[F.lit(v) for v in labels]), F.col(code).cast("int") + 1))


def class_mapping(spark: SparkSession, labels: Mapping[str, Sequence[str]]) -> DataFrame:
    """The label lists as a table."""
    rows = [(c, v, i) for c, vs in labels.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "column_name string, label string, code int")


def label_table(df: DataFrame, column: str) -> DataFrame:
    """Distinct values and codes of a column of any cardinality; nothing passes through the driver."""
    distinct = (df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("label")).distinct()
                .withColumn("_one", F.lit(1).cast("long")))
    return prefix_sums(distinct, [], ["label"], {"code": "_one"}, "labels").select("label", "code")


def encode_by_table(df: DataFrame, column: str, table: DataFrame, out: str) -> DataFrame:
    """Codes by equi-join with a label table; Catalyst broadcasts the table only if it is small."""
    codes = table.select(F.col("label").alias("_label"), F.col("code").alias(out))
    joined = df.join(codes, F.col(column).cast("string") == F.col("_label"), "left")
    return joined.select(*df.columns, out)
