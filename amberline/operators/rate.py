"""Tiers, probability scores, request scoring, ranked lists and regional summaries.

A "tier" may come from the rule score, from the predicted class or from the
probability score.  The three are separate functions and callers name the
column, because the three disagree.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import presets
from ..functions.scalar import as_col, by_case, cut, round_half_even, weighted_score
from .models import batch_probabilities, labels_of
from .profile import literal_rows


# --- tiers ------------------------------------------------------------------------------

def tier_from_rule_score(score, edges: Sequence[float] = presets.TIER_EDGES,
                         labels: Sequence[str] = presets.TIERS) -> Column:
    return cut(score, edges, labels)


def tier_from_proba_score(score, edges: Sequence[float] = presets.TIER_EDGES,
                          labels: Sequence[str] = presets.TIERS, compat_nan_text: bool = False) -> Column:
    """Bins on the probability score; ``compat_nan_text`` writes a missing tier as the text ``nan``.

    With the standard weights the score is at most 60, so the top tier is
    never reached; weights and edges are parameters.
    """
    tier = cut(score, edges, labels)
    return F.coalesce(tier, F.lit("nan")) if compat_nan_text else tier


def named_probabilities(labels: Sequence[str], probabilities: str | Column,
                        compat_positions: bool = False) -> dict[str, Column]:
    """Probability columns by tier name.

    By default a name gets the probability of that class.  ``compat_positions``
    takes positions 2, 1, 0 as the high, medium and low tier whatever the
    label order, which mislabels them when labels are alphabetical.
    """
    p = as_col(probabilities)
    if compat_positions:
        return {"ALTO": p[2], "MEDIO": p[1], "BAJO": p[0]}
    return {label: p[i] for i, label in enumerate(labels)}


def proba_score(by_label: Mapping[str, Column], weights: Mapping[str, float] = presets.TIER_WEIGHTS,
                dp: int = 2) -> Column:
    return weighted_score(by_label, weights, dp)


# --- scoring ----------------------------------------------------------------------------

def score_batch(df: DataFrame, model: PipelineModel, compat_positions: bool = False, dp: int = 4,
                weights: Mapping[str, float] = presets.TIER_WEIGHTS) -> DataFrame:
    """Adds the class, the three probabilities and the probability score; narrow, no shuffle."""
    scored = batch_probabilities(model, df, "nivel_riesgo", "_p")
    named = named_probabilities(labels_of(model), "_p", compat_positions)
    return scored.select(*[c for c in df.columns if c != "nivel_riesgo"], "nivel_riesgo",
                         *[round_half_even(named[t], dp).alias(f"proba_{t}") for t in presets.TIERS],
                         proba_score(named, weights).alias("score_riesgo"))


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Every default applies to a missing value and to a column that is not there at all."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v)
                           for c, v in defaults.items()})


def answer_columns(predicted, by_label: Mapping[str, Column], weights: Mapping[str, float] = presets.TIER_WEIGHTS,
                   dp: int = 2) -> dict[str, Column]:
    """Tier, score, emoji, probabilities in percent and advice for a scored request."""
    tier = as_col(predicted)
    return {
        "nivel_riesgo": tier,
        "score_riesgo": proba_score(by_label, weights, dp),
        "emoji": by_case(tier, {t: presets.TIER_EMOJI[t] for t in ("ALTO", "MEDIO")}, presets.TIER_EMOJI["BAJO"]),
        **{f"proba_{t}": round_half_even(by_label[t] * F.lit(100.0), 1) for t in reversed(presets.TIERS)},
        "recomendacion": by_case(tier, {t: presets.TIER_ADVICE[t] for t in ("ALTO", "MEDIO")},
                                 presets.TIER_ADVICE["BAJO"]),
    }


# --- reports ------------------------------------------------------------------------------

def summarise(df: DataFrame, by: str, key: str, score: str, tier: str,
              tiers: Sequence[str] = presets.TIERS, dp: int = 2) -> DataFrame:
    """Rows, mean score and rows per tier by ``by``, ordered by the unrounded mean, largest first."""
    grouped = df.where(F.col(by).isNotNull()).groupBy(by).agg(
        F.count(key).alias("total_rutas"), F.avg(score).alias("_mean"),
        *[F.count_if(F.col(tier) == F.lit(t)).alias(f"rutas_{t.lower()}") for t in reversed(tiers)])
    return grouped.orderBy(F.desc_nulls_last("_mean"), by).select(
        by, "total_rutas", round_half_even("_mean", dp).alias("score_promedio"),
        *[f"rutas_{t.lower()}" for t in reversed(tiers)])


def worst(df: DataFrame, tier: str, value: str, score: str, key: str | Sequence[str], n: int = 10,
          columns: Sequence[str] | None = None) -> DataFrame:
    """The n rows of one tier with the highest score."""
    keys = [key] if isinstance(key, str) else list(key)
    rows = df.where(F.col(tier) == F.lit(value))
    ranked = rows.orderBy(F.desc_nulls_last(score), *keys).limit(n)
    return ranked.select(*columns) if columns else ranked


def top_per_tier(df: DataFrame, tier: str, score: str, key: str | Sequence[str], n: int = 10,
                 tiers: Sequence[str] = presets.TIERS) -> DataFrame:
    """The n highest-scored rows of each tier with the tier's total; an empty tier keeps one row with a note.

    The rank filter becomes a per-task limit before the shuffle, and the
    totals are a pre-aggregated count, so a tier that holds most rows never
    sits in one task.  ``df`` is read twice; stage it if it is costly.
    """
    keys = [key] if isinstance(key, str) else list(key)
    known = df.where(F.col(tier).isin(*tiers))
    w = W.partitionBy(tier).orderBy(F.desc_nulls_last(score), *keys)
    best = known.withColumn("puesto", F.row_number().over(w)).where(F.col("puesto") <= n)
    totals = known.groupBy(tier).agg(F.count(F.lit(1)).alias("total"))
    frame = (literal_rows(df.sparkSession, tier, tiers).join(totals, tier, "left")
             .withColumn("total", F.coalesce("total", F.lit(0))))
    note = F.when(F.col("total") == 0, F.replace(F.lit(presets.EMPTY_TIER_NOTE), F.lit("{tier}"), F.col(tier)))
    listed = best.withColumn("puesto", F.col("puesto").cast("long"))  # cast after the filter, or the limit is not inferred
    return frame.join(listed, tier, "left").withColumn("aviso", note).orderBy(tier, "puesto")


def score_profile(df: DataFrame, score: str, tier: str, tiers: Sequence[str] = presets.TIERS, dp: int = 2) -> DataFrame:
    """Smallest, largest and mean score and rows per tier, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.min(score).alias("min_score"), F.max(score).alias("max_score"),
                  round_half_even(F.avg(score), dp).alias("mean_score"),
                  *[F.count_if(F.col(tier) == F.lit(t)).alias(f"n_{t.lower()}") for t in reversed(tiers)])
