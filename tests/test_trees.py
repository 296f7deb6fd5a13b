"""Fitted trees as a table, the optimum of the logistic model, multi-class loss per round, draws for all folds at once."""

import pytest
from pyspark.sql import functions as F

from amberline import presets
from amberline.operators import evaluate, models, sample, trees
from amberline.plans import prepare
from amberline.sources import tables

KEY = "id_siniestro"


@pytest.fixture(scope="module")
def rows(spark):
    table = prepare.serving_features(prepare.accidents(spark, 900, 42))
    return tables.stage(table.select(KEY, *presets.FEATURES, presets.TARGET))


@pytest.fixture(scope="module")
def fitted(rows):
    settings = {"boosted": {"maxIter": 7, "maxDepth": 4, "stepSize": 0.3}, "forest": {"numTrees": 9, "maxDepth": 6}}
    return {kind: models.fit_model(rows, kind, presets.FEATURES, presets.TARGET, p) for kind, p in settings.items()}


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_the_table_of_trees_scores_like_the_model(rows, fitted, kind):
    model = fitted[kind]
    labels = models.labels_of(model)
    scored = {r[KEY]: (r.predicted, r.probabilities) for r in models.class_probabilities(model, rows).collect()}
    table = tables.stage(trees.tree_table(model))
    margins = {r[KEY]: r.margins for r in trees.walk_trees(table, rows, KEY, presets.FEATURES).collect()}
    assert margins.keys() == scored.keys()
    for k, m in margins.items():
        if kind == "forest":
            m = [x / 9 for x in m]
            assert m == pytest.approx(scored[k][1])
        assert labels[max(range(3), key=lambda i: (m[i], -i))] == scored[k][0]
    found = {r.feature: r.importance for r in trees.importances_by_trees(table, presets.FEATURES, kind == "forest").collect()}
    want = {r.feature: r.importance for r in models.importances(model).collect()}
    assert all(found.get(f, 0.0) == pytest.approx(v, abs=1e-12) for f, v in want.items())
    leaves = table.where("left is null")
    assert leaves.where("feature is not null or threshold is not null or gain is not null").count() == 0
    assert table.count() == 2 * leaves.count() - table.select("class", "tree").distinct().count()


def test_a_wrong_tree_is_noticed(rows, fitted):
    table = trees.tree_table(fitted["boosted"])
    wrong = table.withColumn("threshold", F.when(F.col("node") == 0, F.col("threshold") + 3.0).otherwise(F.col("threshold")))
    right, other = ({r[KEY]: r.margins for r in trees.walk_trees(t, rows, KEY, presets.FEATURES).collect()} for t in (table, wrong))
    assert sum(right[k] != pytest.approx(other[k]) for k in right) > len(right) / 20


def test_only_tree_models_have_trees(rows):
    model = models.fit_model(rows, "logistic", presets.FEATURES, presets.TARGET, {"maxIter": 2})
    with pytest.raises(ValueError, match="trees"):
        trees.tree_table(model)
    with pytest.raises(ValueError, match="boosted"):
        models.loss_by_round(model, rows, presets.TARGET)


def test_gradient_vanishes_at_the_optimum_only(rows, fitted):
    for weighted in (True, False):
        whole = models.fit_model(rows, "logistic", presets.FEATURES, presets.TARGET, presets.LOGISTIC, weighted)
        found = models.logistic_gradient(whole, rows, presets.TARGET, weighted).collect()
        assert len(found) == 3 * (len(presets.FEATURES) + 1)
        assert max(abs(r.gradient) for r in found) < 1e-4
    short = models.fit_model(rows, "logistic", presets.FEATURES, presets.TARGET, {"maxIter": 2})
    assert max(abs(r.gradient) for r in models.logistic_gradient(short, rows, presets.TARGET).collect()) > 1e-3
    assert max(abs(r.gradient) for r in models.logistic_gradient(whole, rows, presets.TARGET, True).collect()) > 1e-3  # fitted without weights
    with pytest.raises(ValueError, match="logistic"):
        models.logistic_gradient(fitted["forest"], rows, presets.TARGET)


def test_loss_by_round_is_that_of_the_model_cut_off(rows, fitted):
    model = fitted["boosted"]
    inner = models.boosted_models(model)
    odd = rows.withColumn(presets.TARGET, F.when(F.col("edad_conductor") < 25, F.lit("OTRO")).otherwise(F.col(presets.TARGET)))
    for test in (rows, odd):
        known = test.where(F.col(presets.TARGET).isin(presets.TIERS))
        found = {r["round"]: r.log_loss for r in models.loss_by_round(model, test, presets.TARGET, every=3).collect()}
        assert sorted(found) == [1, 4, 7]
        for r, loss in found.items():
            cut_off = models.PipelineModel([*model.stages[:-3], *[models.first_rounds(m, r) for m in inner]])
            scored = models.class_probabilities(cut_off, known)
            want = evaluate.log_loss(scored, presets.TARGET, models.probability_columns(cut_off)).first().log_loss
            assert loss == pytest.approx(want, rel=1e-9)
    assert models.shown_rounds(300, 50) == [1, 51, 101, 151, 201, 251, 300] and models.shown_rounds(1, 50) == [1]
    with pytest.raises(ValueError):
        models.slice_rounds(inner[0], 5, 9)


def test_draws_for_all_folds_are_those_for_each(spark, rows):
    folded = tables.stage(sample.stratified_folds(rows, KEY, presets.TARGET, 4)).where(F.col("fold").isNotNull())
    parts = models.fold_parts(folded, "fold", 4, KEY, 60, 7)
    seen = []
    for f, (fit, held) in enumerate(parts):
        want = sample.sample_rows(folded.where(F.col("fold") != f), KEY, 60, 7)
        assert sorted(r[KEY] for r in fit.collect()) == sorted(r[KEY] for r in want.collect())
        assert fit.rdd.getNumPartitions() == 1
        seen += [r[KEY] for r in held.collect()]
    assert sorted(seen) == sorted(r[KEY] for r in folded.collect())
    every = models.fold_parts(folded, "fold", 4, None, None, 7)
    assert [fit.count() + held.count() for fit, held in every] == [folded.count()] * 4


def test_folds_are_drawn_in_one_pass_whatever_their_number(rows, monkeypatch):
    staged = []
    monkeypatch.setattr(models, "stage", lambda df, *a: (staged.append(a[0]), tables.stage(df, *a))[1])
    for k in (2, 6):
        folded = sample.stratified_folds(rows, KEY, presets.TARGET, k).where(F.col("fold").isNotNull())
        staged.clear()
        models.fold_parts(folded, "fold", k, KEY, 30, 7)
        assert staged == ["folded-rows", "fold-fits"]
