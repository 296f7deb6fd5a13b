"""The query of the whole chain compares all kinds of model."""

from amberline import presets
from amberline.catalog import modelling
from amberline.operators import models
from conftest import SMALL


def test_three_jobs_choose_among_all_three_models(spark, monkeypatch):
    small = {"logistic": {"maxIter": 3}, "forest": {"numTrees": 3, "maxDepth": 3}, "boosted": {"maxIter": 2, "maxDepth": 2}}
    seen = {}

    def fit(rows, kind, features, target, params, *rest, kept=models.fit_model):
        seen[kind] = (params, rows.count())
        return kept(rows, kind, features, target, small[kind], *rest)

    monkeypatch.setattr(models, "fit_model", fit)
    monkeypatch.setattr(modelling, "FIT_ROWS", 300)
    assert modelling.three_jobs(spark, SMALL).count() > 0
    assert seen == {"logistic": (presets.LOGISTIC, 300), "forest": (presets.FOREST, 300), "boosted": (presets.BOOSTED_WEIGHTED, 300)}
