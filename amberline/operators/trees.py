"""Fitted trees as a table, and what follows from it: scores by going down the trees, and importances by Spark SQL alone.

The table comes from the folder that a saved model consists of, so it holds what is served.  It is as large as the model: trees times nodes, whatever the
number of rows scored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import number
from ..sources.tables import scratch_path
from .ensembles import nodes_of_table, of_arrays, saved_nodes, sums_by_steps
from .models import boosted_models, features_of


def tree_table(model: PipelineModel) -> DataFrame:
    """(class, tree, weight, node, feature, threshold, left, right, value, gain, rows), one row per node of a forest or of the boosted class models.

    ``class`` is the place of the class model, 0 for a forest.  ``feature`` (its place), ``threshold``, ``left`` and ``right`` are null in leaves; rows with a value up to the
    threshold go left.  ``value`` has the class shares of a forest, or the one output of a boosted tree.  ``rows`` is the weight of the rows fitted on.
    """
    boosted = boosted_models(model)
    last = model.stages[-1]
    if not boosted and not isinstance(last, RandomForestClassificationModel):
        raise ValueError("only forests and boosted models have trees")
    spark, out = SparkSession.getActiveSession(), None
    for i, m in enumerate(boosted or [last]):
        path = scratch_path(spark, "trees")
        m.save(path)
        saved = saved_nodes(spark, path)
        n = F.col("nodeData")
        total = F.aggregate(n["impurityStats"], F.lit(0.0), lambda a, x: a + x)
        inner = n["leftChild"] >= 0
        part = saved.select(
            F.lit(i).alias("class"), "tree", "weight", n["id"].alias("node"), F.when(inner, n["split"]["featureIndex"]).alias("feature"),
            F.when(inner, n["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"), F.when(inner, n["leftChild"]).alias("left"),
            F.when(inner, n["rightChild"]).alias("right"),
            (F.array(n["prediction"]) if boosted else F.transform(n["impurityStats"], lambda s: s / total)).alias("value"),
            F.when(inner, n["gain"]).alias("gain"), (n["impurityStats"][0] if boosted else total).alias("rows"))
        out = part if out is None else out.unionByName(part)
    return out


def walk_trees(trees: DataFrame, rows: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """(key, margins): the weighted sum of what the leaves say that a row falls into, one entry per class.

    A row goes down each tree once, step by step, in batches; the nodes, which are the model, are sent to the tasks.  Rows with one key are added up.
    """
    nodes = nodes_of_table(trees)
    segments = [int(np.flatnonzero(nodes.classes == c)[0]) for c in np.unique(nodes.classes)]
    entries = len(segments) * nodes.value.shape[1]
    x = F.array(*[number(c).cast("double") for c in features])
    said = rows.select(F.col(key).alias("_key"), of_arrays(sums_by_steps(nodes, segments), len(features))(x).alias("_said"))
    sums = said.groupBy("_key").agg(*[F.sum(F.col("_said")[i]).alias(f"_m{i}") for i in range(entries)])
    return sums.select(F.col("_key").alias(key), F.array(*[f"_m{i}" for i in range(entries)]).alias("margins"))


def importances_by_trees(trees: DataFrame, features: Sequence[str], forest: bool) -> DataFrame:
    """(feature, importance) from the gains of all splits, times the rows they split; they sum to 1.

    The trees of a forest count alike; those of a boosted model by their gains, and its class models alike.
    """
    gains = trees.where(F.col("feature").isNotNull()).groupBy("class", "tree", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("gain"))
    unit = ["class", "tree"] if forest else ["class"]
    shares = gains.join(gains.groupBy(*unit).agg(F.sum("gain").alias("_all")), unit).where(F.col("_all") > 0)
    per = shares.groupBy("feature").agg(F.sum(F.col("gain") / F.col("_all")).alias("share"))
    whole = per.agg(F.sum("share")).first()[0]
    names = F.array(*[F.lit(f) for f in features])
    return per.select(names[F.col("feature")].alias("feature"), (F.col("share") / F.lit(whole)).alias("importance"))


def walked_classes(model: PipelineModel, rows: DataFrame, key: str, predicted: str = "walked") -> DataFrame:
    """(key, predicted) with the place of the class that the table of trees gives a row."""
    margins = walk_trees(tree_table(model), rows, key, features_of(model))
    return margins.select(key, (F.array_position("margins", F.array_max("margins")) - 1).alias(predicted))
