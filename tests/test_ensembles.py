"""Sums over many trees in batches: equal to Spark's own scores, without a row per tree, from rows made once."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from amberline import presets
from amberline.catalog import evidence, modelling
from amberline.operators import ensembles, models, trees
from amberline.plans import prepare
from amberline.sources import synthetic, tables

KEY = "id_siniestro"
SETTINGS = {"shallow": {"maxIter": 5, "maxDepth": 3}, "deep": {"maxIter": 3, "maxDepth": 11, "minInfoGain": 0.0, "stepSize": 0.3}}


@pytest.fixture(scope="module")
def rows(spark):
    table = prepare.serving_features(prepare.accidents(spark, 900, 42))
    return tables.stage(table.select(KEY, *presets.FEATURES, presets.TARGET))


@pytest.fixture(scope="module")
def fitted(rows):
    return {kind: models.fit_model(rows, "boosted", presets.FEATURES, presets.TARGET, p) for kind, p in SETTINGS.items()}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("kind, limit", [("shallow", None), ("deep", None), ("deep", 0)])
def test_margins_are_those_of_spark(spark, rows, fitted, kind, limit, monkeypatch):
    """Trees of up to 64 leaves, of more, and those whose masks would be too large."""
    if limit is not None:
        monkeypatch.setattr(ensembles, "MASK_BYTES", limit)
    model = fitted[kind]
    inner = models.boosted_models(model)
    nodes = ensembles.boosted_nodes(spark, inner)
    most = np.add.reduceat(~nodes.inner(), nodes.starts).max()
    assert (most > 64) == (kind == "deep")
    whole = model.transform(rows)
    rounds = [1, 2, inner[0].getNumTrees]
    scored, margins = models.with_round_margins(whole, inner, rounds)
    assert "UDF" in _plan(scored)
    own = F.array(*[vector_to_array(models.MARGIN.format(i))[1] for i in range(3)])
    found = scored.select(own.alias("own"), *[margins[r].alias(f"m{r}") for r in rounds]).collect()
    assert len(found) == rows.count() and all(r[f"m{rounds[-1]}"] == pytest.approx(r.own, abs=1e-9) for r in found)
    cut = models.PipelineModel([*model.stages[:-3], *[models.first_rounds(m, 2) for m in inner]]).transform(rows)
    early = cut.select(KEY, own.alias("own")).join(scored.select(KEY, margins[2].alias("m")), KEY).collect()
    assert len(early) == len(found) and all(r.m == pytest.approx(r.own, abs=1e-9) for r in early)


def test_missing_values_and_values_at_a_threshold_go_the_same_way(spark, fitted):
    inner = models.boosted_models(fitted["shallow"])
    nodes = ensembles.boosted_nodes(spark, inner)
    x = np.zeros((40, len(presets.FEATURES)))
    at = np.flatnonzero(nodes.inner())[:38]
    x[np.arange(len(at)), nodes.feature[at]] = nodes.threshold[at]
    x[38], x[39] = np.nan, np.inf
    segments = [int(np.flatnonzero(nodes.classes == c)[0]) for c in range(3)]
    masks, steps = (by(x) for by in (ensembles.sums_by_masks(nodes, x.shape[1], segments), ensembles.sums_by_steps(nodes, segments)))
    assert masks == pytest.approx(steps)
    assert ensembles.sums_by_steps(nodes, segments)(x[:0]).shape == (0, 3)


def test_scoring_keeps_one_row_per_row(rows, fitted):
    walked = trees.walk_trees(tables.stage(trees.tree_table(fitted["shallow"])), rows, KEY, presets.FEATURES)
    assert "Generate" not in _plan(walked) and "Join" not in _plan(walked)
    twice = trees.walk_trees(trees.tree_table(fitted["shallow"]), rows.unionByName(rows), KEY, presets.FEATURES)
    one = {r[KEY]: r.margins for r in walked.collect()}
    assert all([2 * x for x in one[r[KEY]]] == pytest.approx(r.margins) for r in twice.collect())


def test_batches_give_what_the_model_gives(rows, fitted):
    for model in fitted.values():
        batched = models.batch_probabilities(model, rows, "a", "b")
        assert "ArrowEvalPython" in batched._jdf.queryExecution().executedPlan().toString()
        both = batched.join(models.class_probabilities(model, rows).select(KEY, "predicted", "probabilities"), KEY).collect()
        assert len(both) == 900 and all(r.a == r.predicted and r.b == pytest.approx(r.probabilities, abs=1e-9) for r in both)
    other = models.fit_model(rows, "logistic", presets.FEATURES, presets.TARGET, {"maxIter": 2})
    assert {r.predicted for r in models.batch_probabilities(other, rows).collect()} == {r.predicted for r in models.class_probabilities(other, rows).collect()}


@pytest.mark.parametrize("limit", [None, 0])
def test_batches_give_the_votes_of_a_forest_to_the_last_bit(rows, limit, monkeypatch):
    """Trees of more than 64 leaves, by masks and by steps."""
    if limit is not None:
        monkeypatch.setattr(ensembles, "MASK_BYTES", limit)
    model = models.fit_model(rows, "forest", presets.FEATURES, presets.TARGET, {"numTrees": 12, "maxDepth": 11, "minInstancesPerNode": 1})
    batched = models.batch_probabilities(model, rows, "a", "b")
    assert "ArrowEvalPython" in batched._jdf.queryExecution().executedPlan().toString()
    nodes = ensembles.forest_nodes(rows.sparkSession, model.stages[-1])
    assert np.add.reduceat(~nodes.inner(), nodes.starts).max() > 64
    both = batched.join(models.class_probabilities(model, rows).select(KEY, "predicted", "probabilities"), KEY).collect()
    assert len(both) == 900 and all((r.a, r.b) == (r.predicted, r.probabilities) for r in both)


def test_the_curve_is_the_loss_of_spark(rows, fitted):
    model = fitted["shallow"]
    found = {(r.label, r.round): r.loss for r in models.boosting_curve(model, rows, presets.TARGET, every=1).collect()}
    ready = model.transform(rows)
    for i, (label, inner) in enumerate(zip(models.labels_of(model), models.boosted_models(model))):
        binary = ready.withColumn(inner.getLabelCol(), (F.col(models.LABEL) == float(i)).cast("double")).withColumn(models.WEIGHT, F.lit(1.0))
        assert [found[label, r + 1] for r in range(5)] == pytest.approx(inner.evaluateEachIteration(binary))


def test_a_query_makes_its_rows_once(spark, small, monkeypatch):
    made, drawn = [], []
    split, bounded = modelling._split, modelling.train.bounded
    monkeypatch.setattr(modelling, "_split", lambda *a: (made.append(a), split(*a))[1])
    monkeypatch.setattr(modelling.train, "bounded", lambda *a: (drawn.append(a), bounded(*a))[1])
    quick = {"logistic": {"maxIter": 2}, "forest": {"numTrees": 2}, "boosted": {"maxIter": 2}, "boosted_plain": {"maxIter": 2}}
    monkeypatch.setattr(modelling, "SETTINGS", {k: (p, k != "boosted_plain") for k, p in quick.items()})
    for query in (modelling.boosted_scores_unweighted, modelling.trained_comparison, modelling.prediction_table, modelling.boosting_curve, evidence.importances_by_trees):
        monkeypatch.setattr(modelling, "_models", {})
        query(spark, small)
        assert len(made) == len(drawn) == 1, query
        made.clear(), drawn.clear()


def test_only_the_columns_that_are_read_are_drawn(spark):
    spec = [("a", "integer", 0, 10), ("b", "choice", ["x", "y"]), ("c", "normal", 0, 1, 3)]
    made = synthetic.synthesize(spark.range(50), "id", spec, 1, "md5")
    assert _plan(made).count("md5(") == 4 and _plan(made.select("id", "a")).count("md5(") == 1
    alone = {r.id: r.a for r in made.select("id", "a").collect()}
    assert {r.id: r.a for r in made.collect()} == alone
