"""Boosted class models and forests whose trees are grown within a task (``growing``), as models of Spark ML.

Rows are known by the places of their features among cuts, which are exact quantiles of all rows.  The tasks, one for each class of a boosted model and one for a share of the trees
of a forest, receive these places of all rows, about 20 bytes a row, so a fit has no job for each level of a tree.  Fits of more than ``TASK_ROWS`` rows are left to Spark ML.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import remove_path, scratch_path, stage
from . import growing
from .ensembles import Nodes, keep_nodes
from .order_stats import prefix_sums

cloudpickle.register_pickle_by_value(growing)  # executors need no installation of this package

#: Rows that a task may hold, at about 60 bytes each while they arrive.
TASK_ROWS = 10_000_000
#: The settings of ``GBTClassifier`` that trees are grown by here, with their defaults.
DEFAULTS = {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 1.0, "featureSubsetStrategy": "all", "minInstancesPerNode": 1, "minInfoGain": 0.0, "maxBins": 32}
MOST_DEPTH = 13
NODE = "class int, tree int, node int, feature int, threshold double, left int, right int, value double, impurity double, stats array<double>, rows long, gain double"


def feature_cuts(values: DataFrame, column: str, features: int, bins: int) -> list[np.ndarray]:
    """Per feature the ascending cuts that part its values into at most ``bins`` places of about as many rows: all places of few values, else exact quantiles.

    ``column`` is an array of doubles.  A cut is half way between two values that occur.  Values are counted first, so what is sorted are distinct ones.
    """
    each = values.select(F.posexplode(column).alias("f", "v"))
    counted = stage(each.groupBy("f", "v").agg(F.count(F.lit(1)).alias("n")), "feature-values")
    sizes = counted.groupBy("f").agg(F.count(F.lit(1)).alias("_values"), F.sum("n").alias("_rows"))
    placed = prefix_sums(counted, ["f"], ["v"], {"_below": "n"}).join(F.broadcast(sizes), "f")
    place = F.when(F.col("_values") <= bins, F.col("v")).otherwise(F.floor(F.col("_below") * bins / F.col("_rows")).cast("double"))
    found = placed.groupBy("f", place.alias("_place")).agg(F.min("v").alias("low"), F.max("v").alias("high")).collect()  # at most ``bins`` a feature
    spans = [sorted((r["low"], r["high"]) for r in found if r["f"] == f) for f in range(features)]
    return [np.array([_between(one[1], two[0]) for one, two in zip(of, of[1:])]) for of in spans]


def _between(low: float, high: float) -> float:
    middle = low / 2 + high / 2
    return middle if low <= middle < high else low


def chosen_features(strategy: str, features: int) -> int | None:
    """How many features a node chooses from, for a strategy that is a name or a number, as Spark ML reads it; none for one that is neither."""
    named = {"all": features, "auto": features, "sqrt": int(np.ceil(np.sqrt(features))), "log2": max(1, int(np.ceil(np.log2(features)))), "onethird": int(np.ceil(features / 3))}
    if strategy in named:
        return named[strategy]
    try:
        number = float(strategy)
    except ValueError:
        return None
    if number >= 1 and "." not in strategy:
        return min(int(number), features)
    return int(np.ceil(number * features)) if 0 < number <= 1 else None


def _blocks(ready: DataFrame, features: str, label: str, width: int, code: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(part, place, codes, labels): the rows in blocks, in an order that the files they are read from give."""

    def blocks(batches):
        for place, batch in enumerate(batches):
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                labels = batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)
                yield pa.RecordBatch.from_pydict({"part": pa.array([batch.column(2)[0].as_py()], pa.int32()), "place": pa.array([place], pa.int32()),
                                                  "codes": pa.array([code(x).tobytes()], pa.binary()), "labels": pa.array([labels.tobytes()], pa.binary())})

    rows = ready.select(vector_to_array(features).alias("x"), F.col(label).alias("y"), F.spark_partition_id().alias("part"))
    return rows.mapInArrow(blocks, "part int, place int, codes binary, labels binary")


def _nodes(blocks: DataFrame, tasks: int, joined: Callable[[list[bytes]], np.ndarray], cuts: Sequence[np.ndarray], grow: Callable) -> pa.Table:
    """Nodes of the trees that ``grow`` gives, as (class, tree, nodes), for the codes and labels of all rows and the number of the task."""

    def table(own: int, tree: int, made: dict) -> pa.RecordBatch:
        size, inner = len(made["left"]), made["left"] >= 0
        threshold = [float(cuts[f][p]) if f >= 0 else None for f, p in zip(made["feature"], made["place"])]
        stats = pa.ListArray.from_arrays(np.arange(size + 1, dtype=np.int32) * made["stats"].shape[1], made["stats"].ravel())
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(size, own), pa.int32()), pa.array(np.full(size, tree), pa.int32()), pa.array(np.arange(size), pa.int32()), pa.array(made["feature"], pa.int32()),
            pa.array(threshold, pa.float64()), pa.array(made["left"], pa.int32()), pa.array(np.where(inner, made["left"] + 1, -1), pa.int32()), pa.array(made["value"]),
            pa.array(made["impurity"]), stats, pa.array(made["rows"], pa.int64()), pa.array(made["gain"])],
            ["class", "tree", "node", "feature", "threshold", "left", "right", "value", "impurity", "stats", "rows", "gain"])

    def trees(batches):
        found: dict[int, list] = {}
        for batch in batches:
            for task, part, place, codes, labels in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                found.setdefault(task, []).append((part, place, codes, labels))
        for task in sorted(found):
            held = sorted(found.pop(task), key=lambda b: b[:2])
            codes = joined([b[2] for b in held])
            kind = np.concatenate([np.frombuffer(b[3], np.uint8) for b in held])
            del held
            for own, tree, made in grow(codes, kind, task):
                yield table(own, tree, made)

    each = blocks.crossJoin(F.broadcast(blocks.sparkSession.range(tasks).select(F.col("id").cast("int").alias("task"))))
    dealt = each.select("task", "part", "place", "codes", "labels").repartitionById(tasks, F.col("task"))
    nodes = dealt.mapInArrow(trees, NODE).toArrow()
    return nodes.sort_by([(column, "ascending") for column in ("class", "tree", "node")])


def _class_weights(ready: DataFrame, label_col: str, weight_col: str | None, classes: int) -> list[float] | None:
    """The weight of each class; none where it is not one number, or where the rows are too many for a task."""
    weight = F.col(weight_col) if weight_col else F.lit(1.0)
    found = {int(r[0]): r for r in ready.groupBy(label_col).agg(F.count(F.lit(1)), F.min(weight), F.max(weight)).collect()}  # one row a class
    if not found or sum(r[1] for r in found.values()) > TASK_ROWS or any(r[2] != r[3] or not r[2] > 0 for r in found.values()):
        return None
    return [float(found[k][2]) if k in found else 0.0 for k in range(classes)]


def _width(ready: DataFrame, features_col: str) -> int:
    return ready.select(F.size(vector_to_array(features_col))).first()[0]


def _as_nodes(tables: Sequence[pa.Table], value: np.ndarray) -> Nodes:
    """What ``ensembles`` reads from the saved models of these trees; ``value`` has the outputs of each node."""
    whole = pa.concat_tables(tables).combine_chunks()
    own_class, tree, left, right = (whole[name].to_numpy() for name in ("class", "tree", "left", "right"))
    first = np.flatnonzero(np.r_[True, (own_class[1:] != own_class[:-1]) | (tree[1:] != tree[:-1])])
    shift, own, inner = np.repeat(first, np.diff(np.r_[first, len(whole)])), np.arange(len(whole)), left >= 0
    return Nodes(first, own_class[first], np.where(inner, whole["feature"].to_numpy(), 0).astype(np.int32), whole["threshold"].fill_null(0.0).to_numpy(),
                 np.where(inner, left + shift, own).astype(np.int32), np.where(inner, right + shift, own).astype(np.int32), value)


@dataclass
class Grown:
    """The nodes of the trees of all classes."""

    tables: list[pa.Table]
    features: int
    rounds: int
    step: float

    @cached_property
    def nodes(self) -> Nodes:
        value, tree = (np.concatenate([t[name].to_numpy() for t in self.tables]) for name in ("value", "tree"))
        return _as_nodes(self.tables, (value * np.where(tree == 0, 1.0, self.step))[:, None])


def grown(ready: DataFrame, classes: int, features_col: str, label_col: str, weight_col: str | None, seed: int, params: Mapping) -> Grown | None:
    """The trees of the boosters of all classes, or none where Spark ML is needed: other settings, weights that differ within a class, or too many rows."""
    known = {**DEFAULTS, **params}
    if set(known) != set(DEFAULTS) or known["maxDepth"] > MOST_DEPTH or classes > 256:
        return None
    weights = _class_weights(ready, label_col, weight_col, classes)
    if weights is None:
        return None
    width = _width(ready, features_col)
    chosen = chosen_features(str(known["featureSubsetStrategy"]), width)
    if chosen is None:
        return None
    cuts = feature_cuts(ready.select(vector_to_array(features_col).alias("x")), "x", width, known["maxBins"])
    places = [len(c) + 1 for c in cuts]
    if max(places) > growing.CODE_PLACES:
        return None
    layout = growing.Layout(places, growing.joined(places, known["maxDepth"]))
    settings = growing.Settings(known["maxIter"], known["maxDepth"], known["stepSize"], known["subsamplingRate"], chosen, known["minInstancesPerNode"],
                                known["minInfoGain"], seed % 2 ** 63)
    code, boosted, groups, scale = growing.coded, growing.boosted_trees, len(layout.groups), weights if weight_col else None

    def grow(codes: np.ndarray, kind: np.ndarray, task: int):
        for tree, made in enumerate(boosted(codes, layout, kind, task, scale, settings)):
            yield task, tree, made

    def joined(parts: list[bytes]) -> np.ndarray:
        return np.concatenate([np.frombuffer(p, np.uint16).reshape(groups, -1) for p in parts], axis=1)

    blocks = stage(_blocks(ready, features_col, label_col, width, lambda x: code(x, cuts, layout.groups)), "fit-blocks")
    nodes = _nodes(blocks, classes, joined, cuts, grow)
    return Grown([nodes.filter(pc.equal(nodes["class"], k)) for k in range(classes)], width, known["maxIter"], known["stepSize"])


def grown_forest(ready: DataFrame, classes: int, estimator: RandomForestClassifier, weight_col: str | None) -> RandomForestClassificationModel | None:
    """The forest that the estimator's settings describe, its trees dealt to as many tasks as the session has cores, or none where Spark ML is needed."""
    value = estimator.getOrDefault
    if estimator.isSet("thresholds") or value("impurity") != "gini" or value("minWeightFractionPerNode") or value("maxBins") > 256 or value("maxDepth") > MOST_DEPTH or classes > 256:
        return None
    weights = _class_weights(ready, value("labelCol"), weight_col, classes)
    if weights is None:
        return None
    width, strategy, trees = _width(ready, value("featuresCol")), value("featureSubsetStrategy"), value("numTrees")
    chosen = chosen_features("all" if strategy == "auto" and trees == 1 else "sqrt" if strategy == "auto" else strategy, width)
    if chosen is None:
        return None
    spark = ready.sparkSession
    cuts = feature_cuts(ready.select(vector_to_array(value("featuresCol")).alias("x")), "x", width, value("maxBins"))
    settings = growing.Settings(trees, value("maxDepth"), 1.0, value("subsamplingRate"), chosen, value("minInstancesPerNode"), value("minInfoGain"), value("seed") % 2 ** 63)
    place, one, bins, scale, bootstrap = growing.placed, growing.forest_tree, max(len(c) for c in cuts) + 1, np.array(weights), value("bootstrap")
    tasks = max(1, min(trees, spark.sparkContext.defaultParallelism))

    def grow(codes: np.ndarray, kind: np.ndarray, task: int):
        for tree in range(task, trees, tasks):
            yield 0, tree, one(codes, bins, kind, scale, settings, tree, bootstrap)

    def joined(parts: list[bytes]) -> np.ndarray:
        return np.concatenate([np.frombuffer(p, np.uint8).reshape(-1, width) for p in parts])

    blocks = stage(_blocks(ready, value("featuresCol"), value("labelCol"), width, lambda x: place(x, cuts)), "fit-blocks")
    nodes = _nodes(blocks, tasks, joined, cuts, grow)
    model = _loaded(spark, estimator, RandomForestClassificationModel, "DecisionTreeClassificationModel", "classification", nodes, [1.0] * trees,
                    numFeatures=width, numClasses=classes, numTrees=trees)
    stats = pc.list_flatten(nodes["stats"]).to_numpy().reshape(-1, classes)
    total = stats.sum(axis=1, keepdims=True)
    keep_nodes([model], _as_nodes([nodes], np.divide(stats, total, out=np.zeros_like(stats), where=total != 0)))
    return model


def as_model(spark: SparkSession, estimator: GBTClassifier, nodes: pa.Table, features: int) -> GBTClassificationModel:
    """The trees as a model of Spark ML."""
    trees, step = nodes["tree"][-1].as_py() + 1, estimator.getStepSize()
    return _loaded(spark, estimator, GBTClassificationModel, "DecisionTreeRegressionModel", "regression", nodes, [1.0] + [step] * (trees - 1),
                   numFeatures=features, numTrees=trees)


def _loaded(spark: SparkSession, estimator, model: type, tree_class: str, package: str, nodes: pa.Table, weights: Sequence[float], **sizes):
    """Trees read from a folder in the form that Spark ML saves models in, with the settings of the estimator."""
    path = scratch_path(spark, "grown")

    def described(name: str, uid: str, given: Mapping, defaults: Mapping, **more) -> str:
        plain = [{p.name: v for p, v in each.items()} for each in (given, defaults)]
        return json.dumps({"class": f"org.apache.spark.ml.{name}", "timestamp": int(time.time() * 1000), "sparkVersion": pyspark.__version__, "uid": uid,
                           "paramMap": plain[0], "defaultParamMap": plain[1], **more})

    whole = described(f"classification.{model.__name__}", estimator.uid, estimator._paramMap, estimator._defaultParamMap, **sizes)
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    tree = [(t, described(f"{package}.{tree_class}", f"{estimator.uid}_{t}", {}, {}), float(w)) for t, w in enumerate(weights)]
    spark.createDataFrame(tree, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    split = F.struct(F.coalesce("feature", F.lit(-1)).alias("featureIndex"),
                     F.when(F.col("left") >= 0, F.array("threshold")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    data = F.struct(F.col("node").alias("id"), F.col("value").alias("prediction"), "impurity", F.col("stats").alias("impurityStats"),
                    F.col("rows").alias("rawCount"), "gain", F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split"))
    spark.createDataFrame(nodes).select(F.col("tree").alias("treeID"), data.alias("nodeData")).coalesce(1).write.parquet(f"{path}/data")
    made = model.load(path)
    remove_path(spark, path)
    return made
