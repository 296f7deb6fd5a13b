"""Trees grown in one task a class are those of Spark ML, without its jobs."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from amberline import presets
from amberline.operators import boosting, growing, models, sample
from amberline.plans import prepare
from amberline.sources import tables

KEY = "id_siniestro"
WHOLE = {"maxIter": 5, "maxDepth": 4, "stepSize": 0.3}  # nothing is drawn, so there is one right answer
NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    draws = np.random.default_rng(3)
    x = draws.integers(0, [9, 30, 4], (3000, 3)) / 4.0
    y = x[:, 0] + x[:, 1] * (x[:, 2] > 0.3) / 3 + draws.normal(size=3000) / 2
    made = [(i, *map(float, r), "uvw"[int(k)]) for i, (r, k) in enumerate(zip(x, np.digitize(y, [1.5, 3.0])))]
    return tables.stage(spark.createDataFrame(made, "k int, a double, b double, c double, y string").repartition(3, "k").sortWithinPartitions("k"))


@pytest.fixture
def never_spark(monkeypatch):
    def fit(self, *a):
        raise AssertionError("fitted by Spark ML")

    monkeypatch.setattr(GBTClassifier, "fit", fit)


def _both(monkeypatch, rows, params, weighted):
    own = models.fit_model(rows, "boosted", NAMES, "y", params, weighted)
    monkeypatch.setattr(boosting, "TASK_ROWS", 0)
    return own, models.fit_model(rows, "boosted", NAMES, "y", params, weighted)


@pytest.mark.parametrize("weighted", [True, False])
@pytest.mark.parametrize("more", [{}, {"minInstancesPerNode": 40, "minInfoGain": 0.01}])
def test_trees_are_those_of_spark(monkeypatch, rows, weighted, more):
    own, theirs = _both(monkeypatch, rows, {**WHOLE, **more}, weighted)
    a, b = ({r["k"]: np.array(r["probabilities"]) for r in models.class_probabilities(m, rows).collect()} for m in (own, theirs))
    assert len(a) == 3000 and max(np.abs(a[k] - b[k]).max() for k in a) < 1e-4
    for x, y in zip(models.boosted_models(own), models.boosted_models(theirs)):
        assert x.getNumTrees == y.getNumTrees and x.treeWeights == y.treeWeights
        assert x.getRawPredictionCol() == y.getRawPredictionCol() and x.getMaxDepth() == y.getMaxDepth() == 4
        assert x.featureImportances.toArray() == pytest.approx(y.featureImportances.toArray(), abs=1e-4)


def test_a_saved_model_is_the_same(rows, never_spark, tmp_path):
    own = models.fit_model(rows, "boosted", NAMES, "y", {**WHOLE, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.7"})
    models.save_model(own, str(tmp_path / "m"))
    one, two, three = ({r["k"]: r["probabilities"] for r in score(m, rows).collect()} for m, score in (
        (own, models.class_probabilities), (models.load_model(str(tmp_path / "m")), models.class_probabilities), (own, models.batch_probabilities)))
    assert one == two and all(one[k] == pytest.approx(three[k], abs=1e-12) for k in one)


def test_folds_and_queries_need_no_job_a_level(spark, never_spark):
    table = tables.stage(prepare.serving_features(prepare.accidents(spark, 1500, 42)).select(KEY, *presets.FEATURES, presets.TARGET))
    folded = sample.stratified_folds(table, KEY, presets.TARGET, 2)
    params = {**presets.BOOSTED_PLAIN, "maxIter": 30}
    first, second = (models.cross_validate(folded, "fold", 2, presets.FEATURES, presets.TARGET, params, key=KEY).collect() for _ in range(2))
    assert first == second and all(r.accuracy > 0.7 for r in first)
    for settings, weighted in ((presets.BOOSTED_PLAIN, False), (presets.BOOSTED_WEIGHTED, True)):
        model = models.fit_model(table, "boosted", presets.FEATURES, presets.TARGET, {**settings, "maxIter": 3}, weighted)
        assert [m.getNumTrees for m in models.boosted_models(model)] == [3] * 3


@pytest.mark.parametrize("params", [{"lossType": "logistic"}, {"featureSubsetStrategy": "sqrt"}])
def test_other_settings_are_fitted(rows, params):
    model = models.fit_model(rows, "boosted", NAMES, "y", {"maxIter": 2, "maxDepth": 2, **params})
    assert models.class_probabilities(model, rows).count() == 3000


def test_cuts_are_exact_quantiles(spark):
    values = spark.range(1000).select(F.array((F.col("id") % 3).cast("double"), F.col("id") / 10.0, F.lit(7.0), F.when(F.col("id") < 900, 0.0).otherwise(F.col("id")).cast("double")).alias("x"))
    few, many, one, heavy = boosting.feature_cuts(values, "x", 4, 10)
    assert list(few) == [0.5, 1.5] and list(one) == [] and list(heavy) == [450.0]
    assert len(many) == 9 and many == pytest.approx([9.95 + 10 * i for i in range(9)])


def test_sums_of_joined_features():
    draws = np.random.default_rng(5)
    places = [32, 4, 2, 32, 7]
    layout = growing.Layout(places, growing.joined(places))
    assert max(layout.sizes) <= growing.CODE_PLACES and len(layout.groups) < len(places)
    x = np.stack([draws.integers(0, p, 500) for p in places], axis=1).astype(float)
    codes = growing.coded(x, [np.arange(p - 1) + 0.5 for p in places], layout.groups)
    out = np.zeros(sum(places))
    for j, size in enumerate(layout.sizes):
        layout.by_feature(j, np.bincount(codes[j], minlength=size).astype(float), out)
    assert list(out) == [c for f, p in enumerate(places) for c in np.bincount(x[:, f].astype(int), minlength=p)]
    for f in range(len(places)):
        assert list(layout.place_of[f][codes[layout.group_of[f]]]) == list(x[:, f])


@pytest.mark.parametrize("weighted", [True, False])
def test_trees_of_a_forest_are_those_of_spark(monkeypatch, rows, weighted):
    """Without draws all trees are one right answer."""
    made, kept = [], models.forest
    monkeypatch.setattr(models, "forest", lambda *a, **b: kept(*a, **b).setBootstrap(False).setFeatureSubsetStrategy("all"))
    for limit in (boosting.TASK_ROWS, 0):
        monkeypatch.setattr(boosting, "TASK_ROWS", limit)
        made.append(models.fit_model(rows, "forest", NAMES, "y", {"numTrees": 2, "maxDepth": 6, "minInstancesPerNode": 5}, weighted))
    a, b = ({r["k"]: np.array(r["probabilities"]) for r in models.class_probabilities(m, rows).collect()} for m in made)
    assert len(a) == 3000 and max(np.abs(a[k] - b[k]).max() for k in a) < 1e-9
    one, two = (m.stages[-1] for m in made)
    assert [t.numNodes for t in one.trees] == [t.numNodes for t in two.trees] and one.featureImportances.toArray() == pytest.approx(two.featureImportances.toArray())


def test_forests_need_no_job_a_level(rows, monkeypatch, tmp_path):
    def fit(self, *a):
        raise AssertionError("fitted by Spark ML")

    monkeypatch.setattr(RandomForestClassifier, "fit", fit)
    one, two = (models.fit_model(rows, "forest", NAMES, "y", {"numTrees": 9, "maxDepth": 5}) for _ in range(2))
    models.save_model(one, str(tmp_path / "m"))
    scored = [{r["k"]: r["probabilities"] for r in score(m, rows).collect()} for m, score in (
        (one, models.class_probabilities), (two, models.class_probabilities), (one, models.batch_probabilities), (models.load_model(str(tmp_path / "m")), models.class_probabilities))]
    assert scored[0] == scored[1] == scored[3] and all(scored[0][k] == pytest.approx(scored[2][k]) for k in scored[0])
    trees = one.stages[-1].trees
    assert len(trees) == 9 and len({t.toDebugString for t in trees}) > 1  # rows and features are drawn for each
    hit = models.class_probabilities(one, rows).agg(F.avg((F.col("predicted") == F.col("y")).cast("int"))).first()[0]
    assert hit > 0.6
