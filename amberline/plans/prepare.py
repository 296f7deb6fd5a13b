"""First job: accidents in, clean and encoded accidents out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import presets
from ..functions import draws
from ..functions.scalar import (capped, climate_index, flag_above, flag_contains, floored, lookup,
                                padded_id, ratio, scorecard, step_date_text)
from ..operators.clean import CleanStats, apply_clean, dedup_first, fit_clean
from ..operators.dirty import append_copies, inject_nulls, inject_outliers, inject_texts
from ..operators.encode import encode, fit_labels, from_catalogs
from ..operators.rate import tier_from_rule_score
from ..sources.synthetic import row_numbers, synthesize
from ..sources.tables import normalise_missing, stage


def rule_terms(rain="lluvia_mm", visibility="visibilidad_km", flow="flujo_vehicular", vehicle_age="antiguedad_veh",
               offences="infracciones_prev", road="tipo_via", vehicle="tipo_vehiculo",
               slot="franja_horaria") -> list[Column]:
    """The eight terms of the rule score; an unknown road or vehicle type is an error."""
    return [
        capped(F.col(rain) / 200.0 * 20.0, 20.0),
        floored((10.0 - F.col(visibility)) / 10.0 * 15.0, 0.0),
        capped(F.col(flow) / 12000.0 * 15.0, 15.0),
        capped(F.col(vehicle_age) / 25.0 * 10.0, 10.0),
        capped(F.col(offences) * 4.0, 15.0),
        lookup(road, presets.ROAD_TYPE_POINTS, strict=True).cast("double"),
        lookup(vehicle, presets.VEHICLE_TYPE_POINTS, strict=True).cast("double"),
        flag_contains(slot, presets.NIGHT_MARKERS) * F.lit(float(presets.NIGHT_POINTS)),
    ]


def with_rule_score(df: DataFrame, key: str, seed: int, noise_sd: float = presets.SCORE_NOISE_SD,
                    method: str = "xxhash64") -> DataFrame:
    noise = None
    if noise_sd:
        df = df.withColumn("_u", draws.uniforms(seed, ["noise.a", "noise.b"], key, method))
        noise = F.expr(draws.normal_text("_u[0]", "_u[1]")) * F.lit(float(noise_sd))
    scored = df.withColumn("score_riesgo", scorecard(rule_terms(), noise))
    return scored.withColumn(presets.TARGET, tier_from_rule_score("score_riesgo")).drop("_u")


#: Of the accident table.
SEED = 42


def draw_accidents(base: DataFrame, key: str, seed: int = SEED, method: str = "xxhash64") -> DataFrame:
    """The columns of accidents before they are scored, beside ``key``, which counts rows from 0."""
    drawn = synthesize(base, key, presets.accident_spec(), seed, method)
    return drawn.withColumns({"id_siniestro": padded_id("SIN-2024-", F.col(key) + 1, 5),
                              "fecha": step_date_text(key, presets.FIRST_DATE, presets.STEP_HOURS)})


def build_accidents(base: DataFrame, key: str, seed: int = SEED, method: str = "xxhash64") -> DataFrame:
    """One accident per row of ``base``, whose ``key`` counts rows from 0: 23 columns, score and tier."""
    drawn = draw_accidents(base, key, seed, method)
    scored = with_rule_score(drawn, "id_siniestro", seed, method=method).drop(key)
    return scored.select("id_siniestro", "fecha", *[c for c in scored.columns if c not in ("id_siniestro", "fecha")])


def accidents(spark: SparkSession, n: int = 5000, seed: int = 42) -> DataFrame:
    return build_accidents(row_numbers(spark, n), "n", seed)


def dirty_accidents(df: DataFrame, key: str = "id_siniestro", seed: int = 42, outliers: int = presets.OUTLIERS_PER_COLUMN,
                    bad_dates: int = presets.BAD_DATE_ROWS, copies: int = presets.COPIED_ROWS,
                    method: str = "xxhash64") -> DataFrame:
    """The table with gaps, absurd values, bad dates and copies; ``df`` should be a stored table."""
    total = df.count()
    out = inject_nulls(df, key, presets.NULLABLE_COLUMNS, presets.NULL_RATE, seed, method)
    out = inject_outliers(out, key, presets.OUTLIERS, outliers, seed + 1, method, total)
    out = inject_texts(out, key, "fecha", presets.BAD_DATES, bad_dates, seed + 2, method, total)
    return append_copies(out, key, copies, seed + 3, method, total)


def derive(df: DataFrame, max_rain: float, max_visibility: float, with_season: bool = True) -> DataFrame:
    """Night flag, climate index, experience ratio, old-vehicle flag and season."""
    new = {
        "es_horario_riesgo": flag_contains("franja_horaria", presets.NIGHT_MARKERS),
        "indice_clima_peligro": climate_index("lluvia_mm", "visibilidad_km", max_rain, max_visibility),
        "ratio_exp_edad": ratio("experiencia_anios", "edad_conductor"),
        "vehiculo_antiguo": flag_above("antiguedad_veh", presets.OLD_VEHICLE_YEARS),
    }
    if with_season:
        new["estacion"] = lookup("mes", presets.MONTH_TO_SEASON)
    return df.withColumns(new)


@dataclass(frozen=True)
class Prepared:
    """A clean table with what was learned on the way; the same values serve later tables."""

    table: DataFrame
    stats: CleanStats
    labels: Mapping[str, Sequence[str]]


def clean_accidents(df: DataFrame, key: str = "id_siniestro", order: Sequence[str] = (),
                    fit_on: Column | None = None) -> Prepared:
    """Deduplicate, repair dates, ranges and gaps, derive features, encode.

    The deduplicated rows are staged once, because the statistics passes and
    the final projection all start from them.  ``order`` says which copy comes
    first; by default the other columns decide, in their order.  ``fit_on`` limits the
    statistics to the kept rows for which it is true (say, the training rows).
    """
    first = dedup_first(df, [key], list(order) or [c for c in df.columns if c != key])
    rows = stage(normalise_missing(first), "dedup")
    stats = fit_clean(rows if fit_on is None else rows.where(fit_on), presets.RANGE_RULES,
                      presets.NULLABLE_COLUMNS, presets.FLOOR_RULES, "fecha", presets.DATE_FORMATS,
                      ["lluvia_mm", "visibilidad_km"])
    derived = derive(apply_clean(rows, stats), stats.maxima["lluvia_mm"], stats.maxima["visibilidad_km"])
    labels = fit_labels(derived, presets.ENCODED_COLUMNS, missing_as_text=True)
    return Prepared(encode(derived, labels, missing_as_text=True), stats, labels)


def serving_features(df: DataFrame, labels: Mapping[str, Sequence[str]] | None = None,
                     max_rain: float = presets.SERVING_MAX_RAIN,
                     max_visibility: float = presets.SERVING_MAX_VISIBILITY) -> DataFrame:
    """Features of rows to score: fixed maxima and catalogs by default, or fitted ones passed in."""
    derived = derive(df, max_rain, max_visibility, with_season="estacion" not in df.columns)
    return encode(derived, labels or from_catalogs(presets.SERVING_CATALOGS))


def build_routes(base: DataFrame, key: str, seed: int = 99, method: str = "xxhash64") -> DataFrame:
    """One route to score per row of ``base``, whose ``key`` counts rows from 0."""
    drawn = synthesize(base, key, presets.route_spec(), seed, method)
    return drawn.select(padded_id("RUTA-", F.col(key) + 1, 3).alias("ruta_id"),
                        *[c for c in drawn.columns if c != key])


