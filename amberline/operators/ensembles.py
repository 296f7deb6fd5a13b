"""Sums over many trees for many rows at once: batches of rows meet arrays made of the trees.

Spark ML follows one row down one tree after the other.  Here numpy works on a batch in each task, in blocks of rows; what is sent to the tasks is the model.
The functions for the tasks are nested ones, so that executors need no installation of this package.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import remove_path, scratch_path

#: Rows of a block: with a thousand trees its arrays stay in a core's cache.
BLOCK_ROWS = 32
#: Entries that a block of rows may hold for all trees.
BLOCK_ENTRIES = 1 << 16
#: Features of few places are put together, up to so many places of a group.
GROUP_PLACES = 256
#: Masks are sent to the tasks up to this size; ensembles whose masks are larger, of very deep trees, are gone down step by step.
MASK_BYTES = 1 << 26
#: So many words of 64 leaves may a tree's masks have; beyond, going down step by step is faster as well (a tree of 1,440 leaves: 2.5 times).
MASK_WORDS = 4


@dataclass
class Nodes:
    """The nodes of all trees of one kind, ordered by class, tree and place; ``left`` and ``right`` are places in these arrays, the node's own in a leaf."""

    starts: np.ndarray   # of each tree
    classes: np.ndarray  # of each tree
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray    # (nodes, values), times the weight of the tree

    def inner(self) -> np.ndarray:
        return self.left != np.arange(len(self.left))

    def depth(self) -> int:
        """Most steps from a root to a leaf."""
        at, steps = np.unique(self.starts), 0
        while (at := at[self.inner()[at]]).size:
            at, steps = np.concatenate([self.left[at], self.right[at]]), steps + 1
        return steps


def saved_nodes(spark: SparkSession, path: str) -> DataFrame:
    """(tree, weight, nodeData) of the ensemble that was saved to a folder."""
    weights = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    return spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData").join(weights, "tree")


def nodes_of_table(table: DataFrame) -> Nodes:
    """From the columns class, tree, weight, node, feature, threshold, left, right and value (an array): as large as the model."""
    found = table.select("class", "tree", "weight", "node", F.coalesce("feature", F.lit(0)).alias("feature"), F.coalesce("threshold", F.lit(0.0)).alias("threshold"),
                         F.coalesce("left", "node").alias("left"), F.coalesce("right", "node").alias("right"), "value").toArrow().combine_chunks()
    c = {name: found.column(name).to_numpy() for name in found.column_names if name != "value"}
    order = np.lexsort((c["node"], c["tree"], c["class"]))
    c = {name: a[order] for name, a in c.items()}
    value = pa.concat_arrays(found.column("value").chunks).flatten().to_numpy().reshape(len(order), -1)[order]
    first = np.flatnonzero(np.r_[True, (c["class"][1:] != c["class"][:-1]) | (c["tree"][1:] != c["tree"][:-1])])
    shift = np.repeat(first, np.diff(np.r_[first, len(order)]))
    return Nodes(first, c["class"][first], c["feature"].astype(np.int32), c["threshold"], (c["left"] + shift).astype(np.int32), (c["right"] + shift).astype(np.int32),
                 value * c["weight"][:, None])


def _model_table(spark: SparkSession, models: Sequence, value: Callable[[Column], Column]) -> tuple[DataFrame, list[str]]:
    out, paths = None, []
    n = F.col("nodeData")
    inner = n["leftChild"] >= 0
    for i, m in enumerate(models):
        paths.append(scratch_path(spark, "nodes"))
        m.save(paths[-1])
        part = saved_nodes(spark, paths[-1]).select(
            F.lit(i).alias("class"), "tree", "weight", n["id"].alias("node"), F.when(inner, n["split"]["featureIndex"]).alias("feature"),
            F.when(inner, n["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"), F.when(inner, n["leftChild"]).alias("left"),
            F.when(inner, n["rightChild"]).alias("right"), value(n).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out, paths


def keep_nodes(models: Sequence, nodes: Nodes) -> None:
    """Class models remember their nodes with the first of them."""
    models[0]._amberline_nodes = ([id(m._java_obj) for m in models], nodes)


def _model_nodes(spark: SparkSession, models: Sequence, value: Callable[[Column], Column]) -> Nodes:
    """The nodes of class models, read once for the same models; ``value`` makes the array of outputs from the saved data of a node."""
    known = getattr(models[0], "_amberline_nodes", None)
    if known is None or known[0] != [id(m._java_obj) for m in models]:
        table, paths = _model_table(spark, models, value)
        keep_nodes(models, nodes_of_table(table))
        for path in paths:
            remove_path(spark, path)
    return models[0]._amberline_nodes[1]


def boosted_nodes(spark: SparkSession, models: Sequence[GBTClassificationModel]) -> Nodes:
    return _model_nodes(spark, models, lambda n: F.array(n["prediction"]))


def forest_nodes(spark: SparkSession, model: RandomForestClassificationModel) -> Nodes:
    """The outputs are the class shares; a node without rows has none."""

    def shares(n: Column) -> Column:
        total = F.aggregate(n["impurityStats"], F.lit(0.0), lambda a, x: a + x)
        return F.transform(n["impurityStats"], lambda x: F.when(total != 0.0, x / total).otherwise(0.0))

    return _model_nodes(spark, [model], shares)


def _leaves(nodes: Nodes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each node the first leaf below it and the one after its last, counted within the tree from the left, and the tree; and the leaves of each tree."""
    size = len(nodes.left)
    first, end, tree = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    inner, count = nodes.inner(), np.zeros(len(nodes.starts), np.int64)
    for t, root in enumerate(nodes.starts):
        todo = [(int(root), False)]
        while todo:
            at, done = todo.pop()
            tree[at] = t
            if not inner[at]:
                first[at], end[at] = count[t], count[t] + 1
                count[t] += 1
            elif done:
                first[at], end[at] = first[nodes.left[at]], end[nodes.right[at]]
            else:
                todo += [(at, True), (int(nodes.right[at]), False), (int(nodes.left[at]), False)]
    return first, end, tree, count


def _low_bits(n: int) -> int:
    return (1 << n) - 1


def _segment_sums(segments: Sequence[int], in_order: bool) -> Callable[[np.ndarray], np.ndarray]:
    """Sums over segments of trees of an array (rows, trees); ``in_order`` adds tree after tree, as Spark ML does, to the last bit."""
    starts = np.asarray(segments)

    def pairwise(outputs: np.ndarray) -> np.ndarray:
        return np.add.reduceat(outputs, starts, axis=1)

    def ordered(outputs: np.ndarray) -> np.ndarray:
        return np.stack([part.cumsum(axis=1)[:, -1] for part in np.split(outputs, starts[1:], axis=1)], axis=1)

    return ordered if in_order else pairwise


def _grouped(places: Sequence[int], most: int) -> list[list[int]]:
    """Numbers of features, put together while a group has at most ``GROUP_PLACES`` places and all groups at most ``most``."""
    groups: list[list[int]] = []
    total, size = sum(places), 0
    for f in sorted(range(len(places)), key=lambda f: places[f]):
        joined = size * places[f]
        if groups and joined <= GROUP_PLACES and total - size - places[f] + joined <= most:
            groups[-1].append(f)
            total, size = total - size - places[f] + joined, joined
        else:
            groups.append([f])
            size = places[f]
    return groups


def sums_by_masks(nodes: Nodes, features: int, segments: Sequence[int], in_order: bool = False) -> Callable[[np.ndarray], np.ndarray]:
    """A function of rows (rows, features) that gives the sums of the trees' outputs, one per segment and value, over segments of trees, given by their first trees.

    A row is known by its place among the thresholds of each feature.  For each place there is a mask per tree of the leaves that can still be reached;
    the first leaf that is left over when the masks of all features are put together is the one reached.  Features of few places are put together beforehand.
    """
    first, end, tree, count = _leaves(nodes)
    trees, words = len(nodes.starts), int(-(-count.max() // 64))
    inner = np.flatnonzero(nodes.inner())
    cuts = [np.unique(nodes.threshold[inner[nodes.feature[inner] == f]]) for f in range(features)]
    offsets = np.cumsum([0, *[len(c) + 1 for c in cuts]])
    masks = np.full((offsets[-1], words, trees), ~np.uint64(0))
    for f, at in ((f, at) for f in range(features) for at in inner[nodes.feature[inner] == f]):
        # beyond the threshold the leaves on the left are out of reach
        beyond = offsets[f] + int(np.searchsorted(cuts[f], nodes.threshold[at])) + 1
        lost = _low_bits(int(end[nodes.left[at]])) & ~_low_bits(int(first[nodes.left[at]]))
        for w in range(words):
            if part := (lost >> (64 * w)) & _low_bits(64):
                masks[beyond:offsets[f + 1], w, tree[at]] &= np.uint64(_low_bits(64) & ~part)
    masks = masks.reshape(len(masks), -1)
    used = [f for f in range(features) if len(cuts[f])]
    groups = [[used[i] for i in g] for g in _grouped([len(cuts[f]) + 1 for f in used], MASK_BYTES // masks[0].nbytes)]
    joint = []
    for group in groups:
        made = masks[offsets[group[0]]:offsets[group[0] + 1]]
        for f in group[1:]:
            made = (made[:, None] & masks[offsets[f]:offsets[f + 1]]).reshape(-1, masks.shape[1])
        joint.append(made)
    firsts = np.cumsum([0, *[len(m) for m in joint]])
    masks = np.concatenate(joint) if joint else masks
    kinds = nodes.value.shape[1]
    values = np.zeros((kinds, 64 * words, trees))
    leaves = np.flatnonzero(~nodes.inner())
    values[:, first[leaves], tree[leaves]] = nodes.value[leaves].T
    values, parts, block, add = values.reshape(kinds, -1), len(segments), BLOCK_ROWS, _segment_sums(segments, in_order)

    def sums(x: np.ndarray) -> np.ndarray:
        codes = []
        for group, start in zip(groups, firsts):
            code = np.zeros(len(x), np.int64)
            for f in group:
                code = code * (len(cuts[f]) + 1) + np.searchsorted(cuts[f], x[:, f])
            codes.append(code + start)
        out = np.zeros((len(x), parts, kinds))
        own = np.arange(trees)
        for a in range(0, len(x), block):
            rows = min(block, len(x) - a)
            left = np.full((rows, masks.shape[1]), ~np.uint64(0))
            part = np.empty_like(left)
            for code in codes:
                np.take(masks, code[a:a + rows], axis=0, out=part, mode="clip")
                np.bitwise_and(left, part, out=left)
            left = left.reshape(rows, -1, trees)
            leaf = np.bitwise_count((left[:, -1] - np.uint64(1)) & ~left[:, -1]).astype(np.int64) + 64 * (left.shape[1] - 1)
            for w in range(left.shape[1] - 2, -1, -1):
                leaf = np.where(left[:, w] != 0, np.bitwise_count((left[:, w] - np.uint64(1)) & ~left[:, w]).astype(np.int64) + 64 * w, leaf)
            at = leaf * trees + own
            for v in range(kinds):
                out[a:a + rows, :, v] = add(values[v].take(at))
        return out.reshape(len(x), parts * kinds)

    return sums


def sums_by_steps(nodes: Nodes, segments: Sequence[int], in_order: bool = False) -> Callable[[np.ndarray], np.ndarray]:
    """The same sums by going down every tree step by step."""
    roots, steps = nodes.starts.astype(np.int32), nodes.depth()
    feature, threshold, left, right, value = nodes.feature, nodes.threshold, nodes.left, nodes.right, nodes.value
    parts, block, add = len(segments), max(1, BLOCK_ENTRIES // len(roots)), _segment_sums(segments, in_order)

    def sums(x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), parts, value.shape[1]))
        for a in range(0, len(x), block):
            rows = x[a:a + block]
            flat, own = rows.ravel(), (np.arange(len(rows)) * rows.shape[1])[:, None]
            at = np.broadcast_to(roots, (len(rows), len(roots)))
            for _ in range(steps):
                at = np.where(flat.take(own + feature.take(at)) <= threshold.take(at), left.take(at), right.take(at))
            for v in range(value.shape[1]):
                out[a:a + len(rows), :, v] = add(value[:, v].take(at))
        return out.reshape(len(x), parts * value.shape[1])

    return sums


def mask_bytes(nodes: Nodes) -> int:
    """What the masks of ``sums_by_masks`` take."""
    inner = nodes.inner()
    places = len(np.unique(np.c_[nodes.feature[inner], nodes.threshold[inner]], axis=0)) + 1 + int(nodes.feature.max(initial=0))
    leaves = np.add.reduceat(~inner, nodes.starts)
    return places * int(-(-leaves.max() // 64)) * len(nodes.starts) * 8


def _suits_masks(nodes: Nodes) -> bool:
    return np.add.reduceat(~nodes.inner(), nodes.starts).max() <= 64 * MASK_WORDS and mask_bytes(nodes) <= MASK_BYTES


def boosted_sums(spark: SparkSession, models: Sequence[GBTClassificationModel], ends: Sequence[int]) -> Callable[[Column], Column]:
    """For an array of features, what the rounds between two of ``ends`` put to the margin of each class, class by class."""
    return sums_of_rounds(boosted_nodes(spark, models), len(models), models[0].numFeatures, ends)


def sums_of_rounds(nodes: Nodes, classes: int, features: int, ends: Sequence[int]) -> Callable[[Column], Column]:
    """The same from the nodes of the models."""
    own = [np.flatnonzero(nodes.classes == i)[0] for i in range(classes)]
    segments = [first + a for first in own for a in [0, *ends[:-1]]]
    by = sums_by_masks(nodes, features, segments) if _suits_masks(nodes) else sums_by_steps(nodes, segments)
    return of_arrays(by, features)


def forest_votes(spark: SparkSession, model: RandomForestClassificationModel) -> Callable[[Column], Column]:
    """For an array of features, the class shares of the leaves reached, added up tree after tree: Spark's raw predictions."""
    nodes, features = forest_nodes(spark, model), model.numFeatures
    by = sums_by_masks(nodes, features, [0], True) if _suits_masks(nodes) else sums_by_steps(nodes, [0], True)
    return of_arrays(by, features)


def of_arrays(sums: Callable[[np.ndarray], np.ndarray], features: int) -> Callable[[Column], Column]:
    """``sums`` as a function of a column with an array of ``features`` doubles; what is missing in it goes right."""

    def batch(x: pa.Array) -> pa.Array:
        given = x.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(x), features)
        found = sums(given)
        return pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * found.shape[1], found.ravel())

    return F.arrow_udf(batch, "array<double>")
