"""Second job: split, fit the three kinds of model, compare, keep predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import presets
from ..operators import evaluate, models
from ..operators.rate import named_probabilities
from ..operators.sample import stratified_split
from ..sources.tables import stage

NAMES = {"logistic": "Regresión Logística", "forest": "Random Forest", "boosted": "Boosted Trees"}


@dataclass
class Trained:
    models: dict[str, PipelineModel]
    comparison: DataFrame
    train: DataFrame
    test: DataFrame
    scored: dict[str, DataFrame] = field(default_factory=dict)

    def best(self, metric: str = "f1_weighted") -> tuple[str, PipelineModel]:
        """Kind and model that are best by a metric of the comparison, the first one on a tie."""
        name = evaluate.best_model(self.comparison, metric).first()["model"]
        kind = next(k for k, n in NAMES.items() if n == name)
        return kind, self.models[kind]


def split_table(df: DataFrame, key: str, target: str, share: float = presets.TEST_SHARE,
                seed: int = presets.SPLIT_SEED, method: str = "xxhash64") -> tuple[DataFrame, DataFrame]:
    marked = stratified_split(df, key, target, share, seed, method=method)
    return (marked.where(~F.col("is_test")).drop("is_test"), marked.where(F.col("is_test")).drop("is_test"))


def bounded(df: DataFrame, key: str, target: str, rows: int | None, seed: int = 42) -> DataFrame:
    """The rows that have a target, written once: all of them, or, with ``rows``, at most so many, drawn by a hash of the key, in one piece."""
    known = df.where(F.col(target).isNotNull())
    return stage(known.sortWithinPartitions(key), "fit-rows") if rows is None else models.drawn(known, key, rows, seed)


def train_and_compare(df: DataFrame, key: str, features: Sequence[str] = tuple(presets.FEATURES),
                      target: str = presets.TARGET, settings: Mapping[str, Mapping] | None = None,
                      weighted: bool = True, seed: int = 42, fit_rows: int | None = None) -> Trained:
    """Fit every kind in ``settings`` on the training rows and compare them on all test rows.

    The models are fitted on all training rows; ``fit_rows`` bounds how many, drawn by a hash of the key.
    """
    settings = settings or {"logistic": presets.LOGISTIC, "forest": presets.FOREST, "boosted": presets.BOOSTED_WEIGHTED}
    features = [f for f in features if f in df.columns]
    train, test = split_table(df.select(key, *features, target), key, target, seed=seed)
    rows = bounded(train, key, target, fit_rows, seed)
    fitted = {kind: models.fit_model(rows, kind, features, target, params, weighted, seed) for kind, params in settings.items()}
    return compare_models(fitted, train, test, target)


def compare_models(fitted: Mapping[str, PipelineModel], train: DataFrame, test: DataFrame, target: str) -> Trained:
    """Score the test rows with each model and compare; several models read a copy of the rows written once."""
    scored, rows = {}, []
    if len(fitted) > 1:
        test = stage(test, "test-rows")
    for kind, model in fitted.items():
        result = stage(models.batch_probabilities(model, test), f"scored-{kind}")
        labels = models.labels_of(model)
        flat = result.withColumns({f"p_{i}": F.col("probabilities")[i] for i in range(len(labels))})
        rows.append((NAMES[kind], evaluate.metrics(flat, target, "predicted",
                                                   {label: f"p_{i}" for i, label in enumerate(labels)})))
        scored[kind] = result
    return Trained(dict(fitted), evaluate.compare(rows), train, test, scored)


def prediction_table(trained: Trained, key: str, features: Sequence[str], target: str = presets.TARGET,
                     compat_positions: bool = False) -> DataFrame:
    """Test rows with the actual class, the tree models' classes and the boosted probabilities."""
    return predictions_side_by_side(trained.scored["boosted"], trained.scored.get("forest"), models.labels_of(trained.models["boosted"]), key,
                                    features, target, compat_positions)


def predictions_side_by_side(boosted: DataFrame, forest: DataFrame | None, labels: Sequence[str], key: str, features: Sequence[str],
                             target: str, compat_positions: bool = False) -> DataFrame:
    """The prediction table from scored rows (``predicted`` and ``probabilities`` in the order of ``labels``)."""
    by_name = named_probabilities(labels, "probabilities", compat_positions)
    left = boosted.select(key, *features, F.col(target).alias("y_real"), F.col("predicted").alias(presets.BOOSTED_PREDICTION),
                          *[p.alias(presets.BOOSTED_PROBABILITY + label) for label, p in by_name.items()])
    if forest is None:
        return left
    right = forest.select(key, F.col("predicted").alias(presets.FOREST_PREDICTION))
    return left.join(right, key)
