"""Rule scores of line items, tiers, ranked lists, regional summaries, probability scores."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import presets
from ..functions import draws
from ..functions.scalar import capped, lookup, round_half_even, scorecard
from ..operators import rate
from ..sources.tables import export_csv, read_table_or_csv, save_table, scratch_path, stage, table_count
from .registry import query, sql_case, sql_cut, sql_literal, sql_round, sql_uniform, table

PRIORITY_POINTS = {"1-URGENT": 20.0, "2-HIGH": 14.0, "3-MEDIUM": 9.0, "4-NOT SPECIFIED": 5.0, "5-LOW": 3.0}
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def order_regions(spark: SparkSession, d: str) -> DataFrame:
    """Priority and region of each order.

    The small tables are joined to orders first, so that line items, the
    largest table, are shuffled once, by order key, and not again by customer.
    No hint: Catalyst broadcasts a side when its size allows and AQE splits a
    hot key.
    """
    nations = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    customers = table(spark, d, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return table(spark, d, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderpriority", F.col("r_name").alias("region"))


def line_score() -> Column:
    return scorecard([
        capped(F.col("l_quantity") / 50.0 * 30.0, 30.0), capped(F.col("l_extendedprice") / 100000.0 * 25.0, 25.0),
        capped(F.col("l_tax") / 0.08 * 15.0, 15.0), lookup("o_orderpriority", PRIORITY_POINTS, strict=True),
        F.when(F.col("l_returnflag") == "R", 8.0).otherwise(0.0)])


def rated_lines(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select(*LINE_KEY, "l_quantity", "l_extendedprice", "l_tax", "l_returnflag")
    joined = lines.join(order_regions(spark, d), F.col("l_orderkey") == F.col("o_orderkey"))
    scored = joined.select(*LINE_KEY, "region", "l_quantity", line_score().alias("score"))
    return scored.withColumn("tier", rate.tier_from_rule_score("score"))


_POINTS = sql_case([(f"o_orderpriority = {sql_literal(k)}", f"{v}::DOUBLE") for k, v in PRIORITY_POINTS.items()], "NULL")
_SCORE = ("least(l_quantity/50::DOUBLE*30::DOUBLE, 30::DOUBLE) + least(l_extendedprice/100000::DOUBLE*25::DOUBLE, 25::DOUBLE)"
          f" + least(l_tax/0.08::DOUBLE*15::DOUBLE, 15::DOUBLE) + {_POINTS}"
          " + CASE WHEN l_returnflag = 'R' THEN 8::DOUBLE ELSE 0::DOUBLE END")
RATED = f"""s0 AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, r_name AS region, l_quantity,
    least(greatest({_SCORE}, 0::DOUBLE), 100::DOUBLE) AS raw
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
s AS (SELECT * EXCLUDE (raw), {sql_round('raw', 2)} AS score FROM s0),
r AS (SELECT *, {sql_cut('score', presets.TIER_EDGES, presets.TIERS)} AS tier FROM s)"""
_TIER_COUNTS = ", ".join(f"count_if(tier = '{t}')::BIGINT AS rutas_{t.lower()}" for t in reversed(presets.TIERS))


@query("region_summary", f"""WITH {RATED}
SELECT region, count(*) AS total_rutas, {sql_round('avg(score)', 2)} AS score_promedio, {_TIER_COUNTS} FROM r GROUP BY region""")
def region_summary(spark, d):
    return rate.summarise(rated_lines(spark, d), "region", "l_orderkey", "score", "tier")


@query("rated_lines", f"WITH {RATED} SELECT * FROM r")
def rated_lines_query(spark, d):
    return rated_lines(spark, d)


_ORDER = "score DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query("worst_lines", f"WITH {RATED} SELECT * FROM r WHERE tier = 'ALTO' ORDER BY {_ORDER}, l_quantity LIMIT 10")
def worst_lines(spark, d):
    return rate.worst(rated_lines(spark, d), "tier", "ALTO", "score", [*LINE_KEY, "l_quantity"])


@query("medium_watch_list", f"WITH {RATED} SELECT region, l_orderkey, score FROM r WHERE tier = 'MEDIO' ORDER BY {_ORDER} LIMIT 10")
def medium_watch_list(spark, d):
    return rate.worst(rated_lines(spark, d), "tier", "MEDIO", "score", LINE_KEY, columns=["region", "l_orderkey", "score"])


@query("top_per_tier", f"""WITH {RATED},
k AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY {_ORDER}) AS puesto, count(*) OVER (PARTITION BY tier) AS total FROM r)
SELECT tier, total, puesto, score, l_orderkey, NULL::VARCHAR AS aviso FROM k WHERE puesto <= 10 AND tier IS NOT NULL""")
def top_per_tier(spark, d):
    lines = stage(rated_lines(spark, d), "rated")
    return rate.top_per_tier(lines, "tier", "score", LINE_KEY).select(
        "tier", "total", "puesto", "score", "l_orderkey", "aviso")


@query("top_per_tier_with_empty_tier", """
WITH e AS (SELECT event_id, value/8::DOUBLE AS score, CASE WHEN value/8::DOUBLE > 33 THEN 'MEDIO' ELSE 'BAJO' END AS tier FROM events),
k AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY score DESC, event_id) AS puesto, count(*) OVER (PARTITION BY tier) AS total FROM e)
SELECT tier, total, event_id, puesto, NULL::VARCHAR AS aviso FROM k WHERE puesto <= 3
UNION ALL SELECT 'ALTO', 0, NULL, NULL, 'No hay rutas clasificadas como ALTO en este scoring.'""")
def top_per_tier_with_empty_tier(spark, d):
    score = F.col("value") / 8.0
    rows = table(spark, d, "events").select("event_id", score.alias("score"), F.when(score > 33, "MEDIO").otherwise("BAJO").alias("tier"))
    return rate.top_per_tier(rows, "tier", "score", "event_id", 3).select("tier", "total", "event_id", "puesto", "aviso")


@query("score_profile", f"""WITH {RATED}
SELECT count(*) AS total, min(score) AS min_score, max(score) AS max_score, {sql_round('avg(score)', 2)} AS mean_score,
  {', '.join(f"count_if(tier = '{t}')::BIGINT AS n_{t.lower()}" for t in reversed(presets.TIERS))} FROM r""")
def score_profile(spark, d):
    return rate.score_profile(rated_lines(spark, d), "score", "tier")


# --- probability scores over hash-made probabilities ---------------------------------------------------

def order_probabilities(spark: SparkSession, d: str, dp: int = 4) -> DataFrame:
    """Three class probabilities per order, from hashes of its key, and the order's region."""
    u = draws.uniforms(21, [f"p.{c}" for c in presets.TIERS], "o_orderkey", "md5")
    rows = order_regions(spark, d).select("o_orderkey", "region", u.alias("u"))
    rows = rows.select("o_orderkey", "region", *[F.col("u")[i].alias(f"u_{c}") for i, c in enumerate(presets.TIERS)])
    total = F.col("u_BAJO") + F.col("u_MEDIO") + F.col("u_ALTO")
    return rows.select("o_orderkey", "region", *[round_half_even(F.col(f"u_{t}") / total, dp).alias(f"p_{t}") for t in presets.TIERS])


_US = ", ".join(f"{sql_uniform(21, f'p.{t}', 'o_orderkey')} AS u_{t}" for t in presets.TIERS)
PROBS = f"""u AS (SELECT o_orderkey, r_name AS region, {_US} FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
p AS (SELECT o_orderkey, region, {', '.join(sql_round(f'u_{t}/(u_BAJO+u_MEDIO+u_ALTO)', 4) + f' AS p_{t}' for t in presets.TIERS)} FROM u)"""
_BY_NAME = sql_round("p_ALTO*60::DOUBLE + p_MEDIO*30::DOUBLE + p_BAJO*10::DOUBLE", 2)
_BY_POSITION = sql_round("p_MEDIO*60::DOUBLE + p_BAJO*30::DOUBLE + p_ALTO*10::DOUBLE", 2)
_ARGMAX = "CASE WHEN p_ALTO >= p_BAJO AND p_ALTO >= p_MEDIO THEN 'ALTO' WHEN p_BAJO >= p_MEDIO THEN 'BAJO' ELSE 'MEDIO' END"


def _vector() -> F.Column:
    """Probabilities in label order: ALTO, BAJO, MEDIO."""
    return F.array("p_ALTO", "p_BAJO", "p_MEDIO")


def _classified(df: DataFrame) -> DataFrame:
    labels = F.array(*[F.lit(t) for t in sorted(presets.TIERS)])
    at = F.array_position("probs", F.array_max("probs")).cast("int")
    return df.withColumn("probs", _vector()).withColumn("clase", F.element_at(labels, at))


@query("proba_score_by_name", f"WITH {PROBS} SELECT o_orderkey, {_BY_NAME} AS score, {sql_cut(_BY_NAME, presets.TIER_EDGES, presets.TIERS)} AS tier FROM p")
def proba_score_by_name(spark, d):
    named = rate.named_probabilities(sorted(presets.TIERS), _vector())
    scored = order_probabilities(spark, d).select("o_orderkey", rate.proba_score(named).alias("score"))
    return scored.withColumn("tier", rate.tier_from_proba_score("score"))


@query("proba_score_by_position", f"WITH {PROBS} SELECT o_orderkey, {_BY_POSITION} AS score, coalesce({sql_cut(_BY_POSITION, presets.TIER_EDGES, presets.TIERS)}, 'nan') AS tier FROM p")
def proba_score_by_position(spark, d):
    named = rate.named_probabilities(sorted(presets.TIERS), _vector(), compat_positions=True)
    scored = order_probabilities(spark, d).select("o_orderkey", rate.proba_score(named).alias("score"))
    return scored.withColumn("tier", rate.tier_from_proba_score("score", compat_nan_text=True))


_SCORED = f"{PROBS}, q AS (SELECT o_orderkey, region, {_BY_NAME} AS score, {_ARGMAX} AS clase FROM p), z AS (SELECT *, {sql_cut('score', presets.TIER_EDGES, presets.TIERS)} AS nuevo FROM q)"


def _summary_sql(tier: str) -> str:
    counts = ", ".join(f"count_if({tier} = '{t}')::BIGINT AS rutas_{t.lower()}" for t in reversed(presets.TIERS))
    return f"WITH {_SCORED} SELECT region, count(*) AS total_rutas, {sql_round('avg(score)', 2)} AS score_promedio, {counts} FROM z GROUP BY region"


def _scored_orders(spark, d):
    named = rate.named_probabilities(sorted(presets.TIERS), "probs")
    scored = _classified(order_probabilities(spark, d)).withColumn("score", rate.proba_score(named))
    return scored.withColumn("nuevo", rate.tier_from_proba_score("score"))


@query("region_summary_by_class", _summary_sql("clase"))
def region_summary_by_class(spark, d):
    return rate.summarise(_scored_orders(spark, d), "region", "o_orderkey", "score", "clase")


@query("region_summary_by_score", _summary_sql("nuevo"))
def region_summary_by_score(spark, d):
    return rate.summarise(_scored_orders(spark, d), "region", "o_orderkey", "score", "nuevo")


def _case(column: str, table_: dict) -> str:
    return sql_case([(f"{column} = '{t}'", sql_literal(table_[t])) for t in ("ALTO", "MEDIO")], sql_literal(table_["BAJO"]))


@query("answers", f"""WITH {PROBS}, q AS (SELECT *, {_ARGMAX} AS clase FROM p)
SELECT o_orderkey, clase AS nivel_riesgo, {_BY_NAME} AS score_riesgo, {_case('clase', presets.TIER_EMOJI)} AS emoji,
  {', '.join(sql_round(f'p_{t}*100::DOUBLE', 1) + f' AS proba_{t}' for t in presets.TIERS)}, {_case('clase', presets.TIER_ADVICE)} AS recomendacion FROM q""")
def answers(spark, d):
    named = rate.named_probabilities(sorted(presets.TIERS), "probs")
    rows = _classified(order_probabilities(spark, d))
    return rows.select("o_orderkey", *[c.alias(n) for n, c in rate.answer_columns("clase", named).items()])


@query("requests_with_defaults", """
SELECT event_id, coalesce(CASE WHEN user_id % 4 = 0 THEN NULL ELSE value END, 20::DOUBLE) AS lluvia_mm, 10::DOUBLE AS visibilidad_km,
  coalesce(CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'Cusco' END, 'Lima') AS region, 'Tarde (12-18)' AS franja_horaria FROM events""")
def requests_with_defaults(spark, d):
    rows = table(spark, d, "events").select(
        "event_id", F.when(F.col("user_id") % 4 == 0, F.lit(None)).otherwise(F.col("value")).alias("lluvia_mm"),
        F.when(F.col("user_id") % 3 == 0, F.lit(None)).otherwise(F.lit("Cusco")).alias("region"))
    full = rate.with_defaults(rows, presets.REQUEST_DEFAULTS)
    return full.select("event_id", "lluvia_mm", "visibilidad_km", "region", "franja_horaria")


# --- tables and files ------------------------------------------------------------------------------------

@query("table_round_trip", """
SELECT o_orderkey, o_orderstatus, o_totalprice, (SELECT count(*) FROM orders) AS saved FROM orders""")
def table_round_trip(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    name = f"amberline_orders_{uuid.uuid4().hex}"
    save_table(orders, name, path=scratch_path(spark, "table"))
    saved = table_count(spark, name).first()["rows"]
    return spark.table(name).withColumn("saved", F.lit(saved).cast("long"))


@query("csv_round_trip", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    path = scratch_path(spark, "csv")
    export_csv(customers, path)
    return read_table_or_csv(spark, "amberline_no_such_table", path, customers.schema)
