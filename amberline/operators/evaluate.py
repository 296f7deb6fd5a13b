"""Classification metrics from pre-aggregated counts."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import percent_text, round_half_even
from .order_stats import prefix_sums
from .profile import first_best


def confusion(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return (df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull()).groupBy(*by, actual, predicted)
            .agg(F.count(F.lit(1)).alias("n")))


def _per_class(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per class seen as actual or predicted (in each group): support, predictions, hits, scores."""
    y, p, n = F.col(actual).cast("string"), F.col(predicted).cast("string"), F.col("n")
    zero = F.lit(0).cast("long")
    parts = F.array(
        F.struct(y.alias("label"), n.alias("support"), zero.alias("predicted"), F.when(y == p, n).otherwise(zero).alias("hits")),
        F.struct(p.alias("label"), zero.alias("support"), n.alias("predicted"), zero.alias("hits")))
    counted = (confusion(df, actual, predicted, by).select(*by, F.explode(parts).alias("s")).select(*by, "s.*").groupBy(*by, "label")
               .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")))
    hits = F.col("hits").cast("double")
    return counted.select(
        *by, "label", "support", "hits",
        F.coalesce(F.try_divide(hits, F.col("predicted")), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(hits, F.col("support")), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide(hits * 2.0, F.col("predicted") + F.col("support")), F.lit(0.0)).alias("f1"))


def class_report(df: DataFrame, actual: str, predicted: str, dp: int = 4) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    After the confusion counts, whose exchange both parts of the report share, there is one row per class.
    """
    total = F.sum("support")

    def weighted(c: str) -> Column:
        return F.sum(F.col(c) * F.col("support")) / total

    none = F.lit(None).cast("double")
    averages = F.array(
        F.struct(F.lit("accuracy").alias("label"), none.alias("precision"), none.alias("recall"),
                 (F.sum("hits") / total).alias("f1"), total.alias("support")),
        F.struct(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                 F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), total.alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), weighted("precision").alias("precision"),
                 weighted("recall").alias("recall"), weighted("f1").alias("f1"), total.alias("support")))
    classes = _per_class(df, actual, predicted)
    report = classes.select("label", "precision", "recall", "f1", "support").unionByName(
        classes.agg(averages.alias("r")).select(F.explode("r").alias("s")).select("s.*"))
    return report.select("label", *[round_half_even(c, dp).alias(c) for c in ("precision", "recall", "f1")], "support")


def class_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro F1 and weighted F1 in one row (for each group)."""
    total = F.sum("support")
    return _per_class(df, actual, predicted, by).groupBy(*by).agg(
        (F.sum("hits") / total).alias("accuracy"), F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("f1") * F.col("support")) / total).alias("f1_weighted"))


def accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(F.avg((F.col(actual) == F.col(predicted)).cast("int")).alias("accuracy"))


def accuracy_by(df: DataFrame, group: str, actual: str, predicted: str) -> DataFrame:
    """Accuracy of each group, say each fold."""
    return df.groupBy(group).agg(F.avg((F.col(actual) == F.col(predicted)).cast("int")).alias("accuracy"))


def log_loss(df: DataFrame, actual: str, probabilities: Mapping[str, str | Column], eps: float = 1e-15,
             by: Sequence[str] = ()) -> DataFrame:
    """Mean negative log of the probability given to the actual class; with ``by`` for each group, say each boosting round."""
    p = None
    for label, c in probabilities.items():
        c = F.col(c) if isinstance(c, str) else c
        hit = F.col(actual) == F.lit(label)
        p = F.when(hit, c) if p is None else p.when(hit, c)
    safe = F.greatest(F.least(p, F.lit(1.0 - eps)), F.lit(eps))
    return df.groupBy(*by).agg(F.avg(F.when(p.isNotNull(), -F.log(safe))).alias("log_loss"))


def roc_auc_by_class(df: DataFrame, actual: str, probabilities: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """One-versus-rest area under the ROC curve per class; NULL if the class or its rest is empty or a score is missing.

    Rows are first added up per (class, score).  The number of negatives below
    a score comes from ``prefix_sums``, so no task sees a whole class.
    """
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    pairs = F.array(*[F.struct(F.lit(label).alias("label"), F.col(c).cast("double").alias("score"),
                               F.when(F.col(actual) == F.lit(label), one).otherwise(zero).alias("pos"))
                      for label, c in probabilities.items()])
    scored = (df.where(F.col(actual).isNotNull()).select(*by, F.explode(pairs).alias("s")).select(*by, "s.*")
              .groupBy(*by, "label", "score").agg(F.sum("pos").alias("pos"), F.sum(1 - F.col("pos")).alias("neg")))
    ranked = prefix_sums(scored, [*by, "label"], ["score"], {"neg_below": "neg"}, "auc")
    won = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / F.lit(2.0)))
    return ranked.groupBy(*by, "label").agg(
        F.when(F.count("score") == F.count(F.lit(1)), F.try_divide(won, F.sum("pos").cast("double") * F.sum("neg"))).alias("auc"))


def roc_auc_ovr(df: DataFrame, actual: str, probabilities: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Macro average of the class areas; missing as soon as one class area is undefined."""
    per = roc_auc_by_class(df, actual, probabilities, by)
    return per.groupBy(*by).agg(F.when(F.count("auc") == F.count(F.lit(1)), F.avg("auc")).alias("auc"))


def metrics(df: DataFrame, actual: str, predicted: str, probabilities: Mapping[str, str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row (for each group, say each model): accuracy, f1_macro, f1_weighted, auc."""
    row = class_metrics(df, actual, predicted, by)
    if probabilities is None:
        return row.withColumn("auc", F.lit(None).cast("double"))
    both = row.unionByName(roc_auc_ovr(df, actual, probabilities, by), allowMissingColumns=True)
    return both.groupBy(*by).agg(*[F.max(m).alias(m) for m in METRICS])  # each column has one non-null row


METRICS = ["accuracy", "f1_macro", "f1_weighted", "auc"]


def compare(named: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """One row per model, in the given order, with a percent text next to each metric."""
    out = None
    for i, (name, row) in enumerate(named):
        part = row.select(F.lit(i).alias("position"), F.lit(name).alias("model"), *METRICS)
        out = part if out is None else out.unionByName(part)
    return out


def with_percent_texts(table: DataFrame, columns: Sequence[str] = METRICS) -> DataFrame:
    return table.withColumns({f"{c}_text": percent_text(c) for c in columns})


def best_model(table: DataFrame, metric: str = "f1_weighted") -> DataFrame:
    return first_best(table, metric, "position")


def final_metrics(row: DataFrame, dp: int = 4) -> DataFrame:
    return row.select(*[round_half_even(c, dp).alias(c) for c in METRICS])


# --- run log ---------------------------------------------------------------------------

RUN_SCHEMA = "run_id string, run_name string, logged_at timestamp, kind string, key string, value string"


def run_rows(spark: SparkSession, run_name: str, params: Mapping, measured: Mapping, run_id: str | None = None) -> DataFrame:
    """One run as (run, kind, key, value) records."""
    run_id = run_id or uuid.uuid4().hex
    now = datetime.datetime.now()
    rows = [(run_id, run_name, now, kind, k, None if v is None else str(v))
            for kind, items in (("param", params), ("metric", measured)) for k, v in items.items()]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def log_run(spark: SparkSession, path: str, run_name: str, params: Mapping, measured: Mapping) -> str:
    """Adds a run to the log folder, in a folder of its own; returns its id."""
    run_id = uuid.uuid4().hex
    run_rows(spark, run_name, params, measured, run_id).coalesce(1).write.mode("append").partitionBy("run_id").parquet(path)
    return run_id


def read_runs(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """All runs of the log, or one, which reads the folder of that run alone."""
    runs = spark.read.schema(RUN_SCHEMA).parquet(path)
    return (runs if run_id is None else runs.where(F.col("run_id") == run_id)).select(*[c.split()[0] for c in RUN_SCHEMA.split(", ")])
