"""Synthetic accident and route tables, one row per order; and the faults put into them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import presets
from ..functions import draws
from ..functions.scalar import padded_id, round_half_even, step_date_text
from ..operators.dirty import append_copies, inject_nulls, inject_outliers, inject_texts
from ..operators.profile import dirty_profile
from ..plans.prepare import build_accidents, build_routes, dirty_accidents
from ..sources.synthetic import synthesize
from ..sources.tables import spread, stage
from .registry import (query, sql_case, sql_choice, sql_cut, sql_draw, sql_literal, sql_normal, sql_rank, sql_round,
                       sql_uniform, table)

OUTLIER_SEED, DATE_SEED, COPY_SEED = 43, 44, 45


MD5 = "md5"  # the hash DuckDB has too


def orders_as_accidents(spark: SparkSession, d: str) -> DataFrame:
    return build_accidents(spread(table(spark, d, "orders").select("o_orderkey"), "o_orderkey"), "o_orderkey", method=MD5)


def stored_accidents(spark: SparkSession, d: str) -> DataFrame:
    """The accidents written once, as the jobs that follow expect a table."""
    return stage(orders_as_accidents(spark, d), "accidents")


def orders_as_dirty_accidents(spark: SparkSession, d: str) -> DataFrame:
    return dirty_accidents(stored_accidents(spark, d), method=MD5)


# --- the same tables in SQL ------------------------------------------------------------------

def _accident_sql() -> str:
    key = "o_orderkey"
    drawn = ", ".join(f"{sql_draw(kind, args, 42, name, key)} AS {name}" for name, kind, *args in presets.accident_spec())
    road = sql_case([(f"tipo_via = {sql_literal(k)}", f"{v}::DOUBLE") for k, v in presets.ROAD_TYPE_POINTS.items()], "NULL")
    vehicle = sql_case([(f"tipo_vehiculo = {sql_literal(k)}", f"{v}::DOUBLE")
                        for k, v in presets.VEHICLE_TYPE_POINTS.items()], "NULL")
    score = ("least(lluvia_mm/200::DOUBLE*20::DOUBLE, 20::DOUBLE)"
             " + greatest((10::DOUBLE-visibilidad_km)/10::DOUBLE*15::DOUBLE, 0::DOUBLE)"
             " + least(flujo_vehicular::DOUBLE/12000::DOUBLE*15::DOUBLE, 15::DOUBLE)"
             " + least(antiguedad_veh::DOUBLE/25::DOUBLE*10::DOUBLE, 10::DOUBLE)"
             " + least(infracciones_prev::DOUBLE*4::DOUBLE, 15::DOUBLE)"
             f" + {road} + {vehicle}"
             " + CASE WHEN contains(franja_horaria,'Noche') OR contains(franja_horaria,'Madrugada') THEN 8::DOUBLE ELSE 0::DOUBLE END"
             f" + {sql_normal(42, 'noise', 'id_siniestro')}*3::DOUBLE")
    clipped = f"least(greatest({score}, 0::DOUBLE), 100::DOUBLE)"
    return f"""acc0 AS (
  SELECT format('SIN-2024-{{:05d}}', o_orderkey + 1) AS id_siniestro,
         strftime(DATE '{presets.FIRST_DATE}' + (floor(o_orderkey*{presets.STEP_HOURS}/24::DOUBLE))::INTEGER, '%Y-%m-%d') AS fecha,
         {drawn}
  FROM orders),
accidents AS (
  SELECT *, {sql_cut('score_riesgo', presets.TIER_EDGES, presets.TIERS)} AS nivel_riesgo
  FROM (SELECT * EXCLUDE (raw), {sql_round('raw', 2)} AS score_riesgo FROM (SELECT *, {clipped} AS raw FROM acc0)))"""


ACCIDENTS = _accident_sql()


def _null_sql(source: str) -> str:
    lost = ", ".join(f"CASE WHEN {sql_uniform(42, 'null.' + c, 'id_siniestro')} < 0.08::DOUBLE THEN NULL ELSE {c} END AS {c}"
                     for c in presets.NULLABLE_COLUMNS)
    return f"SELECT * REPLACE ({lost}) FROM {source}"


def _outlier_sql(source: str) -> str:
    n = presets.OUTLIERS_PER_COLUMN
    swaps = []
    for i, (c, values) in enumerate(presets.OUTLIERS):
        bad = sql_choice(sql_uniform(OUTLIER_SEED, f"outlier.{c}", "id_siniestro"), values)
        swaps.append(f"CASE WHEN _rn > {i * n} AND _rn <= {(i + 1) * n} THEN {bad} ELSE {c} END AS {c}")
    return (f"SELECT * EXCLUDE (_rn) REPLACE ({', '.join(swaps)}) FROM (SELECT *, row_number() OVER "
            f"(ORDER BY {sql_rank(OUTLIER_SEED, 'id_siniestro')}, id_siniestro) AS _rn FROM {source})")


def _bad_date_sql(source: str) -> str:
    bad = sql_choice(sql_uniform(DATE_SEED, "text.fecha", "id_siniestro"), presets.BAD_DATES)
    return (f"SELECT * EXCLUDE (_rn) REPLACE (CASE WHEN _rn <= {presets.BAD_DATE_ROWS} THEN {bad} ELSE fecha END AS fecha) "
            f"FROM (SELECT *, row_number() OVER (ORDER BY {sql_rank(DATE_SEED, 'id_siniestro')}, id_siniestro) AS _rn FROM {source})")


def _copy_sql(source: str) -> str:
    return (f"SELECT * FROM {source} UNION ALL SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER "
            f"(ORDER BY {sql_rank(COPY_SEED, 'id_siniestro')}, id_siniestro) AS _rn FROM {source}) WHERE _rn <= {presets.COPIED_ROWS}")


DIRTY = f"""{ACCIDENTS},
dirty1 AS ({_null_sql('accidents')}),
dirty2 AS ({_outlier_sql('dirty1')}),
dirty3 AS ({_bad_date_sql('dirty2')}),
dirty AS ({_copy_sql('dirty3')})"""


def _route_sql() -> str:
    drawn = ", ".join(f"{sql_draw(kind, args, 99, name, 'o_orderkey')} AS {name}" for name, kind, *args in presets.route_spec())
    return f"routes AS (SELECT format('RUTA-{{:03d}}', o_orderkey + 1) AS ruta_id, {drawn} FROM orders)"


ROUTES = _route_sql()


# --- queries ------------------------------------------------------------------------------------

@query("accident_table", f"WITH {ACCIDENTS} SELECT * FROM accidents")
def accident_table(spark, d):
    return orders_as_accidents(spark, d)


@query("route_table", f"WITH {ROUTES} SELECT * FROM routes")
def route_table(spark, d):
    return build_routes(spread(table(spark, d, "orders").select("o_orderkey"), "o_orderkey"), "o_orderkey", method=MD5)


@query("sequence_columns", """
SELECT event_id, format('SIN-2024-{:05d}', event_id + 1) AS id_siniestro, format('RUTA-{:03d}', event_id + 1) AS ruta_id,
       strftime(DATE '2022-01-01' + (floor(event_id*8/24::DOUBLE))::INTEGER, '%Y-%m-%d') AS fecha FROM events""")
def sequence_columns(spark, d):
    return table(spark, d, "events").select(
        "event_id", padded_id("SIN-2024-", F.col("event_id") + 1, 5).alias("id_siniestro"),
        padded_id("RUTA-", F.col("event_id") + 1, 3).alias("ruta_id"),
        step_date_text("event_id").alias("fecha"))


@query("draw_frequencies", f"""
SELECT v AS region, count(*) AS n, {sql_round('avg(f)', 4)} AS mean_road FROM (
  SELECT {sql_draw('weighted', (presets.REGIONS, presets.REGION_P), 7, 'region', 'event_id')} AS v,
         {sql_draw('poisson', (1.2,), 7, 'offences', 'event_id')} AS f FROM events) GROUP BY v""")
def draw_frequencies(spark, d):
    spec = [("region", "weighted", presets.REGIONS, presets.REGION_P), ("offences", "poisson", 1.2)]
    drawn = synthesize(table(spark, d, "events"), "event_id", spec, 7, MD5)
    return drawn.groupBy("region").agg(F.count(F.lit(1)).alias("n"),
                                       round_half_even(F.avg("offences"), 4).alias("mean_road"))


@query("cheap_draws")
def cheap_draws(spark, d):
    """The cheaper hash: same table at any partitioning, not reproducible outside Spark."""
    u = draws.uniform(7, "u", "event_id")
    return table(spark, d, "events").select("event_id", u.alias("u"), draws.rank_hash(7, "event_id").alias("h"))


@query("null_injection", f"WITH {ACCIDENTS} {_null_sql('accidents')}")
def null_injection(spark, d):
    return inject_nulls(orders_as_accidents(spark, d), "id_siniestro", presets.NULLABLE_COLUMNS, presets.NULL_RATE, 42, MD5)


@query("outlier_injection", f"WITH {ACCIDENTS} {_outlier_sql('accidents')}")
def outlier_injection(spark, d):
    return inject_outliers(stored_accidents(spark, d), "id_siniestro", presets.OUTLIERS,
                           presets.OUTLIERS_PER_COLUMN, OUTLIER_SEED, MD5)


@query("bad_date_injection", f"WITH {ACCIDENTS} {_bad_date_sql('accidents')}")
def bad_date_injection(spark, d):
    return inject_texts(stored_accidents(spark, d), "id_siniestro", "fecha", presets.BAD_DATES,
                        presets.BAD_DATE_ROWS, DATE_SEED, MD5)


@query("appended_copies", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM (
  SELECT *, row_number() OVER (ORDER BY {sql_rank(7, 'o_orderkey')}, o_orderkey) AS _rn FROM orders) WHERE _rn <= 50""")
def appended_copies(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return append_copies(orders, "o_orderkey", 50, 7, MD5)


@query("dirty_accident_table", f"WITH {DIRTY} SELECT * FROM dirty")
def dirty_accident_table(spark, d):
    return orders_as_dirty_accidents(spark, d)


_nulls = " UNION ALL ".join(f"SELECT 'nulls:{c}', count_if({c} IS NULL)::BIGINT FROM dirty" for c in presets.NULLABLE_COLUMNS)


@query("dirty_profile", f"""WITH {DIRTY}
SELECT 'rows' AS measure, count(*) AS value FROM dirty UNION ALL {_nulls} UNION ALL
SELECT 'duplicates', (SELECT count(*) FROM dirty) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty))""")
def dirty_profile_query(spark, d):
    return dirty_profile(orders_as_dirty_accidents(spark, d), presets.NULLABLE_COLUMNS)
