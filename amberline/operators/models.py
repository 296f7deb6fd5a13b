"""Classifiers on Spark ML: estimators, probabilities, importances, cross-validation, grid search."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.feature import SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.draws import rank_hash
from ..functions.scalar import number
from ..sources.tables import ensure_checkpoint_dir, stage
from . import boosting
from .ensembles import boosted_sums, forest_votes, keep_nodes, sums_of_rounds
from .sample import balanced_weights, class_counts, per_class, sample_rows

LABEL = "_label"
VECTOR = "_features"
PREDICTION = "_prediction"
RAW = "_raw"
PROBABILITY = "_probability"
WEIGHT = "w"


# --- scaling ----------------------------------------------------------------------------

def fit_scaler(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, in one pass; a constant column gets scale 1."""
    row = df.agg(*[a for i, c in enumerate(columns) for a in (
        F.avg(number(c)).alias(f"m{i}"), F.stddev_pop(number(c)).alias(f"s{i}"))]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def scaled(c: str, stats: Mapping[str, tuple[float, float]]) -> Column:
    mean, sd = stats[c]
    return (number(c) - F.lit(mean)) / F.lit(sd)


def scaling_stage(stats: Mapping[str, tuple[float, float]], suffix: str = "_z") -> SQLTransformer:
    """The same scaling as a stage that is saved with the model."""
    parts = [f"(CAST(`{c}` AS DOUBLE) - CAST('{m!r}' AS DOUBLE)) / CAST('{s!r}' AS DOUBLE) AS `{c}{suffix}`"
             for c, (m, s) in stats.items()]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


# --- estimators ---------------------------------------------------------------------------

OUTPUTS = {"featuresCol": VECTOR, "labelCol": LABEL, "predictionCol": PREDICTION, "rawPredictionCol": RAW,
           "probabilityCol": PROBABILITY}


def logistic(weight_sum: float, weight_col: str | None = WEIGHT, maxIter: int = 1000, C: float = 1.0) -> Estimator:
    """Multinomial logistic regression with an L2 penalty.

    ``weight_sum`` turns the penalty per total loss (C) into Spark's penalty
    per mean loss.  The inputs are scaled beforehand, so no second scaling.
    """
    est = LogisticRegression(family="multinomial", maxIter=maxIter, standardization=False, elasticNetParam=0.0,
                             regParam=1.0 / (C * weight_sum), **OUTPUTS)
    return est.setWeightCol(weight_col) if weight_col else est


def forest(weight_col: str | None = WEIGHT, seed: int = 42, numTrees: int = 200, maxDepth: int = 12,
           minInstancesPerNode: int = 5, maxBins: int = 64) -> Estimator:
    est = RandomForestClassifier(numTrees=numTrees, maxDepth=maxDepth, minInstancesPerNode=minInstancesPerNode,
                                 featureSubsetStrategy="sqrt", maxBins=maxBins, seed=seed, **OUTPUTS)
    return est.setWeightCol(weight_col) if weight_col else est


MARGIN = "_margin_{}"


def fit_boosted(ready: DataFrame, classes: int, weight_col: str | None = WEIGHT, seed: int = 42,
                parallelism: int = 3, **params) -> list[GBTClassificationModel]:
    """One boosted binary classifier per class; Spark's gradient-boosted trees are binary.

    Each model writes only its own margin column.  Chaining them as stages
    keeps scoring on the JVM, where ``OneVsRestModel`` would collect the
    margins with a Python function per row and class.  The trees are grown in
    one task a class, without the jobs that Spark ML has for each level of a
    tree; Spark ML fits where rows or settings do not allow that.
    """
    trees = boosting.grown(ready, classes, VECTOR, LABEL, weight_col, seed, params)
    made = _boosted(ready, classes, weight_col, seed, parallelism, params, trees)
    if trees is not None:
        keep_nodes(made, trees.nodes)
    return made


def _boosted(ready: DataFrame, classes: int, weight_col: str | None, seed: int, parallelism: int, params: Mapping,
             trees: boosting.Grown | None) -> list[GBTClassificationModel]:
    """Models of the trees, or, where there are none, fitted by Spark ML."""

    def one(i: int) -> GBTClassificationModel:
        est = GBTClassifier(seed=seed, featuresCol=VECTOR, labelCol=f"_is_{i}", predictionCol="", **params)
        est = est.setRawPredictionCol(MARGIN.format(i)).setProbabilityCol("")
        if weight_col:
            est = est.setWeightCol(weight_col)
        if trees is not None:
            return boosting.as_model(ready.sparkSession, est, trees.tables[i], trees.features)
        return est.fit(ready.withColumn(f"_is_{i}", (F.col(LABEL) == F.lit(float(i))).cast("double")))

    if parallelism > 1:
        with ThreadPool(min(parallelism, classes)) as pool:
            return pool.map(one, range(classes))
    return [one(i) for i in range(classes)]


def fit_model(train: DataFrame, kind: str, features: Sequence[str], target: str, params: Mapping | None = None,
              weighted: bool = True, seed: int = 42) -> PipelineModel:
    """Fit ``kind`` (``logistic``, ``forest`` or ``boosted``) on the rows that have a target.

    The saved pipeline holds the label order, the feature order and, for the
    logistic model, the scaling.  The training columns are staged, as the estimator reads them more than once.
    """
    params = dict(params or {})
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    rows = train.select(*features, target).where(F.col(target).isNotNull())
    counts = class_counts(rows, target)
    total = float(sum(counts.values()))
    if weighted:
        rows = rows.withColumn(WEIGHT, per_class(target, balanced_weights(counts)))
    rows = stage(rows, "training-rows")
    stages: list = [StringIndexer(inputCol=target, outputCol=LABEL, stringOrderType="alphabetAsc")]
    inputs = list(features)
    weight_col = WEIGHT if weighted else None
    if kind == "logistic":
        stages.append(scaling_stage(fit_scaler(rows, features)))
        inputs = [f"{c}_z" for c in features]
        estimator = logistic(total, weight_col, **params)  # balanced weights add up to the row count
    elif kind == "forest":
        estimator = forest(weight_col, seed, **params)
    elif kind == "boosted":
        estimator = None
    else:
        raise ValueError(f"unknown model kind {kind!r}")
    stages.append(VectorAssembler(inputCols=inputs, outputCol=VECTOR, handleInvalid="error"))
    if kind == "logistic":
        return Pipeline(stages=[*stages, estimator]).fit(rows)
    head = Pipeline(stages=stages).fit(rows)
    ready = head.transform(rows).select(VECTOR, LABEL, *([WEIGHT] if weighted else []))
    if kind == "forest":
        return PipelineModel([*head.stages, boosting.grown_forest(ready, len(counts), estimator, weight_col) or estimator.fit(ready)])
    return PipelineModel([*head.stages, *fit_boosted(ready, len(counts), weight_col, seed, **params)])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _stage(model: PipelineModel, kind):
    return next((s for s in model.stages if isinstance(s, kind)), None)


def labels_of(model: PipelineModel) -> list[str]:
    return list(_stage(model, StringIndexerModel).labels)


def features_of(model: PipelineModel) -> list[str]:
    scaling = _stage(model, SQLTransformer)
    names = _stage(model, VectorAssembler).getInputCols()
    return [n.removesuffix("_z") for n in names] if scaling is not None else list(names)


# --- applying -------------------------------------------------------------------------------

def boosted_models(model: PipelineModel) -> list[GBTClassificationModel]:
    return [s for s in model.stages if isinstance(s, GBTClassificationModel)]


def with_margin_probabilities(df: DataFrame, margins: str, probabilities: str, at: str) -> DataFrame:
    """Class probabilities of an array of margins, and the 1-based place of the largest margin (the first one on a tie)."""
    out = df.withColumn("_odds", F.transform(margins, lambda m: 1.0 / (1.0 + F.exp(m * -2.0))))
    out = out.withColumn("_total", F.aggregate("_odds", F.lit(0.0), lambda a, x: a + x))
    return (out.withColumn(probabilities, F.transform("_odds", lambda x: x / F.col("_total")))
            .withColumn(at, F.array_position(margins, F.array_max(margins))).drop("_odds", "_total"))


def class_probabilities(model: PipelineModel, df: DataFrame, predicted: str = "predicted",
                        probabilities: str = "probabilities") -> DataFrame:
    """Adds the predicted class text and an array of class probabilities in label order.

    A narrow plan without Python functions.  A boosted class model gives a
    margin m, which means 1 / (1 + exp(-2 m)); the largest margin decides the
    class and the class probabilities are normalised to sum 1.
    """
    out = PipelineModel([s for s in model.stages if not isinstance(s, StringIndexerModel)]).transform(df)
    per_class_models = boosted_models(model)
    if per_class_models:
        margins = [vector_to_array(MARGIN.format(i))[1] for i in range(len(per_class_models))]
        return _from_margins(model, df, out, F.array(*margins), predicted, probabilities)
    return _named(model, df, out, F.col(PREDICTION) + 1, vector_to_array(PROBABILITY), predicted, probabilities)


def batch_probabilities(model: PipelineModel, df: DataFrame, predicted: str = "predicted", probabilities: str = "probabilities") -> DataFrame:
    """What ``class_probabilities`` gives, for many rows: the margins of a boosted model and the votes of a forest are added up for batches of rows in Python
    tasks, where a row and tree at a time takes several times longer.  Other models are applied as there."""
    per_class_models = boosted_models(model)
    last = model.stages[-1]
    if isinstance(last, RandomForestClassificationModel) and not last.isSet("thresholds"):
        out = PipelineModel([s for s in model.stages[:-1] if not isinstance(s, StringIndexerModel)]).transform(df)
        out = out.withColumn("_votes", forest_votes(df.sparkSession, last)(vector_to_array(VECTOR)))
        out = out.withColumn("_total", F.aggregate("_votes", F.lit(0.0), lambda a, x: a + x))
        most = F.array_position("_votes", F.array_max("_votes"))
        return _named(model, df, out, most, F.transform("_votes", lambda x: x / F.col("_total")), predicted, probabilities)
    if not per_class_models:
        return class_probabilities(model, df, predicted, probabilities)
    head = PipelineModel([s for s in model.stages if not isinstance(s, (StringIndexerModel, GBTClassificationModel))])
    last = per_class_models[0].getNumTrees
    out, margins = with_round_margins(head.transform(df), per_class_models, [last])
    return _from_margins(model, df, out, margins[last], predicted, probabilities)


def _from_margins(model: PipelineModel, df: DataFrame, out: DataFrame, margins: Column, predicted: str, probabilities: str) -> DataFrame:
    out = with_margin_probabilities(out.withColumn("_margins", margins), "_margins", "_probs", "_at")
    return _named(model, df, out, F.col("_at"), F.col("_probs"), predicted, probabilities)


def _named(model: PipelineModel, df: DataFrame, out: DataFrame, at: Column, probs: Column, predicted: str, probabilities: str) -> DataFrame:
    labels = F.array(*[F.lit(v) for v in labels_of(model)])
    return out.select(*df.columns, F.element_at(labels, at.cast("int")).alias(predicted),
                      probs.alias(probabilities))


def probability_columns(model: PipelineModel, probabilities: str = "probabilities") -> dict[str, Column]:
    """Probability of each class by its name."""
    return {label: F.col(probabilities)[i] for i, label in enumerate(labels_of(model))}


def logistic_gradient(model: PipelineModel, train: DataFrame, target: str, weighted: bool = True) -> DataFrame:
    """(label, feature, gradient) of the penalised loss that a logistic model minimises, at its coefficients, over the rows it was fitted on.

    The loss is the weighted mean log-loss plus half the penalty times the squared coefficients; the intercepts, feature ``(intercept)``, are not penalised.  All are
    near 0 where the fit has converged, and only there.  One pass of pre-aggregated sums, one for each class and feature.
    """
    fitted = model.stages[-1]
    if not isinstance(fitted, LogisticRegressionModel):
        raise ValueError("only a logistic model has this gradient")
    labels, names = labels_of(model), features_of(model)
    rows = train.where(F.col(target).isNotNull())
    w = per_class(target, balanced_weights(class_counts(rows, target))) if weighted else F.lit(1.0)
    scored = model.transform(rows.withColumn(WEIGHT, w))
    scored = scored.select(WEIGHT, LABEL, vector_to_array(VECTOR).alias("_x"), vector_to_array(PROBABILITY).alias("_p"))
    coefficients, penalty = fitted.coefficientMatrix.toArray(), fitted.getRegParam()
    sums = {}
    for k in range(len(labels)):
        excess = F.col(WEIGHT) * (F.col("_p")[k] - (F.col(LABEL) == F.lit(float(k))).cast("double"))
        sums |= {(k, j): F.sum(excess * F.col("_x")[j]) for j in range(len(names))}
        sums[k, None] = F.sum(excess)
    row = scored.agg(F.sum(WEIGHT).alias("_w"), *[s.alias(f"g{i}") for i, s in enumerate(sums.values())])

    def entry(i: int, k: int, j: int | None) -> Column:
        pull = 0.0 if j is None else penalty * float(coefficients[k][j])
        return F.struct(F.lit(labels[k]).alias("label"), F.lit("(intercept)" if j is None else names[j]).alias("feature"),
                        (F.col(f"g{i}") / F.col("_w") + F.lit(pull)).alias("gradient"))

    return row.select(F.inline(F.array(*[entry(i, k, j) for i, (k, j) in enumerate(sums)])))


def importances(model: PipelineModel, top: int | None = None) -> DataFrame:
    """Feature importances (they sum to 1), largest first; the mean over the class models if there are several."""
    sources = boosted_models(model) or [model.stages[-1]]
    values = sum(m.featureImportances.toArray() for m in sources) / len(sources)
    rows = [(name, float(v), i) for i, (name, v) in enumerate(zip(features_of(model), values))]
    spark = SparkSession.getActiveSession()
    return top_importances(spark.createDataFrame(rows, "feature string, importance double, position int"), top)


def top_importances(table: DataFrame, top: int | None = None) -> DataFrame:
    """Features by falling importance, equal ones by position."""
    ordered = table.orderBy(F.desc("importance"), "position").drop("position")
    return ordered.limit(top) if top else ordered


def slice_rounds(model: GBTClassificationModel, first: int, end: int) -> GBTClassificationModel:
    """The model made of the rounds from ``first`` (counted from 0) up to ``end``; margins of slices add up to that of all rounds."""
    if not 0 <= first <= end <= model.getNumTrees:
        raise ValueError(f"rounds {first} to {end} wanted of a model with {model.getNumTrees}")
    java, jvm = model._java_obj, SparkContext._active_spark_context._jvm
    made = jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), java.trees()[first:end], java.treeWeights()[first:end],
                                                                         java.numFeatures(), java.numClasses())
    return model._copyValues(GBTClassificationModel(made))


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model as it was after so many rounds; they do not depend on how many follow."""
    return slice_rounds(model, 0, rounds)


def with_round_margins(df: DataFrame, models: Sequence[GBTClassificationModel], rounds: Sequence[int]) -> tuple[DataFrame, dict[int, Column]]:
    """Adds what the rounds between two of ``rounds`` put to the margins; the margins of all classes after each of them are prefix sums of that.

    Each tree is applied once, however many rounds are asked for.
    """
    ends = sorted(set(rounds))
    if any(not 0 < r <= m.getNumTrees for m in models for r in ends):
        raise ValueError(f"rounds {ends} wanted of models with {[m.getNumTrees for m in models]}")
    return _margins_after(df, len(models), ends, boosted_sums(df.sparkSession, models, ends))


def _margins_after(df: DataFrame, classes: int, ends: Sequence[int], sums: Callable[[Column], Column]) -> tuple[DataFrame, dict[int, Column]]:
    out = df.withColumn("_parts", sums(vector_to_array(VECTOR)))

    def margin(i: int, at: int) -> Column:
        return sum((F.col("_parts")[i * len(ends) + b] for b in range(at + 1)), F.lit(0.0))

    return out, {r: F.array(*[margin(i, at) for i in range(classes)]) for at, r in enumerate(ends)}


def shown_rounds(total: int, every: int) -> list[int]:
    """Round 1, every ``every``-th one after it, and the last."""
    return sorted({*range(1, total + 1, every), total})


def loss_by_round(model: PipelineModel, test: DataFrame, target: str, every: int = 50, eps: float = 1e-15) -> DataFrame:
    """(round, log_loss): log-loss over all classes on ``test`` after every n-th round and the last, in one pass.

    The probabilities are those of ``class_probabilities``.  Rows whose target is missing, or a class that the model does not know, are left out.
    """
    inner_models = boosted_models(model)
    if not inner_models:
        raise ValueError("only boosted models have a loss per round")
    labels = labels_of(model)
    head = PipelineModel([s for s in model.stages[:-len(inner_models)] if not isinstance(s, StringIndexerModel)])
    place = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(target).cast("string"))
    ready = head.transform(test.where(place > 0)).select(VECTOR, place.cast("int").alias("_class"))
    rounds = shown_rounds(inner_models[0].getNumTrees, every)
    scored, margins = with_round_margins(ready, inner_models, rounds)

    def loss(r: int) -> Column:
        odds = F.transform(margins[r], lambda m: 1.0 / (1.0 + F.exp(m * -2.0)))
        p = F.element_at(odds, F.col("_class")) / F.aggregate(odds, F.lit(0.0), lambda a, x: a + x)
        return F.avg(-F.log(F.greatest(F.least(p, F.lit(1.0 - eps)), F.lit(eps))))

    row = scored.agg(*[loss(r).alias(f"r{r}") for r in rounds])
    return row.select(F.inline(F.array(*[F.struct(F.lit(r).alias("round"), F.col(f"r{r}").alias("log_loss")) for r in rounds])))


def boosting_curve(model: PipelineModel, test: DataFrame, target: str, every: int = 50) -> DataFrame:
    """Loss on ``test`` after every n-th round, per class model, in one pass; for watching, not for stopping.

    It is Spark's loss of a boosted model: twice the log-loss of the margin, the mean over the rows.
    """
    inner_models = boosted_models(model)
    if not inner_models:
        raise ValueError("only boosted models have a loss per round")
    head = PipelineModel(model.stages[:-len(inner_models)])
    ready = head.transform(test.where(F.col(target).isNotNull())).select(VECTOR, LABEL)
    rounds = shown_rounds(inner_models[0].getNumTrees, every)
    scored, margins = with_round_margins(ready, inner_models, rounds)

    def loss(i: int, r: int) -> Column:
        x = F.when(F.col(LABEL) == F.lit(float(i)), margins[r][i] * -2.0).otherwise(margins[r][i] * 2.0)
        return F.avg((F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))) * 2.0)

    asked = [(i, label, r) for i, label in enumerate(labels_of(model)) for r in rounds]
    row = scored.agg(*[loss(i, r).alias(f"l{i}_{r}") for i, _, r in asked])
    return row.select(F.inline(F.array(*[F.struct(F.lit(label).alias("label"), F.lit(r).alias("round"), F.col(f"l{i}_{r}").alias("loss")) for i, label, r in asked])))


# --- validation --------------------------------------------------------------------------------

def _assembled(df: DataFrame, features: Sequence[str], target: str, keep: Sequence[str]) -> tuple[PipelineModel, DataFrame]:
    rows = df.where(F.col(target).isNotNull())
    head = Pipeline(stages=[
        StringIndexer(inputCol=target, outputCol=LABEL, stringOrderType="alphabetAsc"),
        VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="error")]).fit(rows)
    return head, head.transform(rows).select(VECTOR, LABEL, *keep)


def drawn(df: DataFrame, key: str, rows: int, seed: int = 42) -> DataFrame:
    """At most ``rows`` rows, drawn by a hash of the key and written once in one piece.

    All partitions scan and filter, and only the drawn rows meet in one task, in the order of their keys.  Iterative fits on a
    bounded sample are many short passes; one partition spares each of them the scheduling of empty ones.
    """
    return stage(sample_rows(df, key, rows, seed).repartition(1).sortWithinPartitions(key), "fit-rows")


def _fold_accuracy(fit: DataFrame, held: DataFrame, classes: int, params: Mapping, weight_col: str | None,
                   seed: int, parallelism: int, rounds: Sequence[int] | None = None) -> list[float]:
    """Accuracy after each number of ``rounds``, or after all rounds of ``params``, by one fit and one pass over the rows held out."""
    params = dict(params) if rounds is None else {**params, "maxIter": max(rounds)}
    trees = boosting.grown(fit, classes, VECTOR, LABEL, weight_col, seed, params)  # judged without making models of them
    models = None if trees is not None else _boosted(fit, classes, weight_col, seed, parallelism, params, None)
    wanted = [models[0].getNumTrees if trees is None else trees.rounds] if rounds is None else list(rounds)
    if trees is None:
        scored, margins = with_round_margins(held, models, wanted)
    else:
        scored, margins = _margins_after(held, classes, sorted(set(wanted)), sums_of_rounds(trees.nodes, classes, trees.features, sorted(set(wanted))))
    hits = [(F.array_position(margins[r], F.array_max(margins[r])) - 1 == F.col(LABEL)).cast("int") for r in wanted]
    return list(scored.agg(*[F.avg(h).alias(f"a{i}") for i, h in enumerate(hits)]).first())


def fold_parts(ready: DataFrame, fold: str, k: int, key: str | None, fit_rows: int | None, seed: int) -> list[tuple[DataFrame, DataFrame]]:
    """For each fold the rows to fit on, at most ``fit_rows`` of the other folds, and all rows of the fold, from staged copies.

    The rows are written once by fold, and judged fold by fold from there.  Drawn are the rows with the smallest hashes of ``key`` among the other folds;
    they are among the ``fit_rows`` smallest of each fold, so one pass that limits each fold where it is read draws them for all folds, whatever their number.
    """
    rows = stage(ready.sortWithinPartitions(fold, *([key] if key else [])), "folded-rows", [fold])  # fits follow the order of the rows
    held = [rows.where(F.col(fold) == f) for f in range(k)]
    if fit_rows is None:
        return [(rows.where(F.col(fold) != f), held[f]) for f in range(k)]
    hashed = rows.withColumn("_h", rank_hash(seed, key))
    smallest = hashed.withColumn("_place", F.row_number().over(W.partitionBy(fold).orderBy("_h", key))).where(F.col("_place") <= fit_rows).drop("_place")
    others = smallest.withColumn("_for", F.explode(F.array(*[F.lit(f) for f in range(k)]))).where(F.col("_for") != F.col(fold))
    drawn_rows = others.withColumn("_place", F.row_number().over(W.partitionBy("_for").orderBy("_h", key))).where(F.col("_place") <= fit_rows)
    fits = stage(drawn_rows.drop("_place", "_h").sortWithinPartitions("_for", key), "fold-fits", ["_for"])
    return [(fits.where(F.col("_for") == f).drop("_for").coalesce(1), held[f]) for f in range(k)]


def cross_validate(df: DataFrame, fold: str, k: int, features: Sequence[str], target: str,
                   params: Mapping | None = None, seed: int = 42, parallelism: int | None = None, key: str | None = None,
                   fit_rows: int | None = None) -> DataFrame:
    """Accuracy of the boosted model on all rows of each fold, with the number of rows judged, fitted without weights on the other folds.

    ``fit_rows`` bounds how many rows of the other folds, drawn by a hash of ``key``, a model is fitted on.  ``parallelism`` fits run at the same time,
    by default as many as the session has cores.
    """
    ensure_checkpoint_dir(df.sparkSession)
    head, ready = _assembled(df, features, target, [fold, *([key] if key else [])])
    parts = fold_parts(ready, fold, k, key, fit_rows, seed)
    classes = len(labels_of(head))
    with ThreadPool(min(k, -(-_threads(df, parallelism) // classes))) as pool:  # the folds are independent fits of a task a class
        scores = pool.map(lambda f: (f + 1, _fold_accuracy(*parts[f], classes, dict(params or {}), None, seed, classes)[0]), range(k))
    return df.sparkSession.createDataFrame([(*score, held.count()) for score, (_, held) in zip(scores, parts)], "fold int, accuracy double, judged long")


def _threads(df: DataFrame, parallelism: int | None) -> int:
    return parallelism or max(4, df.sparkSession.sparkContext.defaultParallelism)


def fold_summary(scores: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold scores."""
    return scores.agg(F.avg("accuracy").alias("mean_accuracy"), F.stddev_pop("accuracy").alias("std_accuracy"))


def grid_search(train: DataFrame, fold: str, folds: int, features: Sequence[str], target: str,
                grid: Mapping[str, Sequence], base: Mapping | None = None, seed: int = 42,
                parallelism: int | None = None, key: str | None = None, fit_rows: int | None = None) -> tuple[PipelineModel, DataFrame]:
    """Accuracy of every setting of the boosted model over given folds; best setting refitted on all of ``train``.

    ``fit_rows`` bounds how many rows, drawn by a hash of ``key``, each model is fitted on; all rows of a fold are judged.  Settings are tried with the
    last grid key varying fastest, and the first best one wins.  The fits of all settings and folds are one pool of tasks, the longest first, of which
    ``parallelism`` run at the same time, by default as many as the session has cores; settings that differ in the number of rounds share a fit.
    """
    ensure_checkpoint_dir(train.sparkSession)
    head, ready = _assembled(train, features, target, [fold, *([key] if key else [])])
    classes = len(labels_of(head))
    parts = fold_parts(ready, fold, folds, key, fit_rows, seed)
    names = list(grid)
    settings = [dict(zip(names, values)) for values in itertools.product(*[grid[n] for n in names])]

    rounds = list(grid["maxIter"]) if "maxIter" in names else None  # one fit of the most rounds serves them all
    rest = [n for n in names if n != "maxIter"]
    fits = list(dict.fromkeys(tuple(w[n] for n in rest) for w in settings))

    def one(task: tuple[tuple, int]) -> list[float]:
        values, f = task
        return _fold_accuracy(*parts[f], classes, {**dict(base or {}), **dict(zip(rest, values))}, None, seed, 1, rounds)

    def depth(task: tuple[tuple, int]) -> float:
        return {**dict(base or {}), **dict(zip(rest, task[0]))}.get("maxDepth", 5)

    tasks = sorted(((values, f) for values in fits for f in range(folds)), key=depth, reverse=True)
    with ThreadPool(min(_threads(train, parallelism), len(tasks))) as pool:
        found = dict(zip(tasks, pool.map(one, tasks, chunksize=1)))
    scores = []
    for w in settings:
        at = rounds.index(w["maxIter"]) if rounds else 0
        scores.append([found[tuple(w[n] for n in rest), f][at] for f in range(folds)])
    means = [sum(s) / len(s) for s in scores]
    top = max(range(len(settings)), key=lambda i: (means[i], -i))
    whole = stage(ready, "grid-rows") if fit_rows is None else drawn(ready, key, fit_rows, seed)
    best = PipelineModel([*head.stages, *fit_boosted(whole, classes, None, seed, **{**dict(base or {}), **settings[top]})])
    rows = [(i, *[float(w[n]) for n in names], means[i],
             (sum((x - means[i]) ** 2 for x in scores[i]) / folds) ** 0.5, i == top) for i, w in enumerate(settings)]
    schema = ", ".join(["setting int", *[f"{n} double" for n in names], "mean_accuracy double",
                        "std_accuracy double", "best boolean"])
    return best, train.sparkSession.createDataFrame(rows, schema)
