"""Third job: score routes, set tiers, report and publish."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import presets
from ..operators import rate
from ..operators.models import batch_probabilities, labels_of
from ..sources.tables import save_table, export_csv, stage
from .prepare import serving_features


@dataclass(frozen=True)
class Rated:
    routes: DataFrame
    by_class: DataFrame
    by_score: DataFrame


def rate_routes(routes: DataFrame, model: PipelineModel, labels: Mapping[str, Sequence[str]] | None = None,
                max_rain: float = presets.SERVING_MAX_RAIN, max_visibility: float = presets.SERVING_MAX_VISIBILITY,
                compat_positions: bool = False) -> Rated:
    """Scored routes (class tier and score tier side by side) with a regional summary for each tier."""
    scored = rate.score_batch(serving_features(routes, labels, max_rain, max_visibility), model, compat_positions)
    scored = stage(scored.withColumn("nivel_por_score", rate.tier_from_proba_score("score_riesgo")), "routes")
    return Rated(scored, rate.summarise(scored, "region", "ruta_id", "score_riesgo", "nivel_riesgo"),
                 rate.summarise(scored, "region", "ruta_id", "score_riesgo", "nivel_por_score"))


def publish(rated: Rated, route_table: str, region_table: str, csv_folder: str | None = None,
            by_score: bool = False, fmt: str = "parquet") -> None:
    """Route and region tables, and CSV copies.  ``by_score`` publishes the score tier in both."""
    routes = rated.routes
    if by_score:
        routes = routes.withColumn("nivel_riesgo", F.col("nivel_por_score"))
    routes = routes.drop("nivel_por_score")
    region = rated.by_score if by_score else rated.by_class
    save_table(routes, route_table, fmt)
    save_table(region, region_table, fmt)
    if csv_folder:
        export_csv(routes, f"{csv_folder}/{route_table.split('.')[-1]}")
        export_csv(region, f"{csv_folder}/{region_table.split('.')[-1]}", single_file=True)


def score_requests(requests: DataFrame, model: PipelineModel, labels: Mapping[str, Sequence[str]] | None = None,
                   defaults: Mapping[str, object] = presets.REQUEST_DEFAULTS, compat_positions: bool = False,
                   max_rain: float = presets.SERVING_MAX_RAIN,
                   max_visibility: float = presets.SERVING_MAX_VISIBILITY) -> DataFrame:
    """Answers for any number of requests; missing inputs take the defaults.  Also fit for streams."""
    full = serving_features(rate.with_defaults(requests, defaults), labels, max_rain, max_visibility)
    scored = batch_probabilities(model, full, "_tier", "_p")
    answers = rate.answer_columns("_tier", rate.named_probabilities(labels_of(model), "_p", compat_positions))
    return scored.select(*[c for c in requests.columns if c not in answers], *[c.alias(n) for n, c in answers.items()])
