"""Copies, dates, range rules, imputation, encoding, derived features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import presets
from ..functions import draws
from ..functions.scalar import (climate_index, flag_above, flag_contains, lookup, number, out_of_range,
                                overwrite_where, parse_dates, ratio, round_half_even)
from ..operators import clean, encode
from ..operators.order_stats import medians
from ..operators.profile import clean_summary, duplicate_rows, null_counts_before_after
from ..operators.sample import bernoulli_mask
from ..plans.prepare import clean_accidents
from ..sources.tables import spread, stage
from .registry import query, sql_round, sql_uniform, table
from .synthesis import DIRTY, orders_as_dirty_accidents

LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
              "l_linestatus", "l_shipdate"]


def _lines(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return table(spark, d, "lineitem").select(*columns)


# --- copies ------------------------------------------------------------------------------------

@query("first_of_key", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) AS rn FROM lineitem)
WHERE rn = 1""")
def first_of_key(spark, d):
    lines = _lines(spark, d, "l_orderkey", "l_linenumber", *LINE_ORDER)
    return clean.dedup_first(lines, ["l_orderkey", "l_linenumber"], LINE_ORDER).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query("removed_rows", """
SELECT count(*) AS rows_before, count(DISTINCT (l_orderkey, l_linenumber)) AS rows_after,
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS removed FROM lineitem""")
def removed_rows(spark, d):
    return clean.removed_rows(_lines(spark, d, "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query("duplicate_rows", """
SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_quantity FROM lineitem)) AS duplicates""")
def duplicate_rows_query(spark, d):
    return duplicate_rows(_lines(spark, d, "l_orderkey", "l_linenumber", "l_quantity"))


# --- dates ---------------------------------------------------------------------------------------

_DATE_TEXT = """(CASE o_orderkey % 8
  WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d')
  WHEN 2 THEN '31/13/2024' WHEN 3 THEN '2024-99-01' WHEN 4 THEN '  ' || strftime(o_orderdate, '%Y/%m/%d') || chr(9)
  WHEN 5 THEN 'no-date' ELSE strftime(o_orderdate, '%Y-%m-%d') END)"""
_STRIPPED = f"regexp_replace({_DATE_TEXT}, '^\\s+|\\s+$', '', 'g')"
_PARSED = (f"coalesce(try_strptime({_STRIPPED}, '%Y-%m-%d'), try_strptime({_STRIPPED}, '%d/%m/%Y'), "
           f"try_strptime({_STRIPPED}, '%Y/%m/%d'))")


def _date_texts(spark: SparkSession, d: str) -> DataFrame:
    """Order dates written in the three formats, padded with blanks, or spoilt, by key; written once."""
    o = spread(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey")
    k = F.col("o_orderkey") % 8
    iso, dmy, ymd = (F.date_format("o_orderdate", f) for f in presets.DATE_FORMATS)
    text = (F.when(k == 0, dmy).when(k == 1, ymd).when(k == 2, "31/13/2024").when(k == 3, "2024-99-01")
            .when(k == 4, F.concat(F.lit("  "), ymd, F.lit("\t"))).when(k == 5, "no-date").otherwise(iso))
    return stage(o.select("o_orderkey", text.alias("fecha")), "texts")


@query("parsed_dates", f"SELECT o_orderkey, strftime({_PARSED}, '%Y-%m-%d') AS fecha FROM orders")
def parsed_dates(spark, d):
    parsed = parse_dates("fecha", presets.DATE_FORMATS)
    return _date_texts(spark, d).select("o_orderkey", F.date_format(parsed, "yyyy-MM-dd").alias("fecha"))


@query("unparsed_dates", f"SELECT count(*) AS total, count_if({_PARSED} IS NULL)::BIGINT AS unparsed FROM orders")
def unparsed_dates(spark, d):
    parsed = _date_texts(spark, d).select(parse_dates("fecha", presets.DATE_FORMATS).alias("f"))
    return parsed.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("f").isNull()).alias("unparsed"))


@query("median_filled_dates", f"""
WITH p AS (SELECT o_orderkey, {_PARSED} AS f FROM orders),
m AS (SELECT make_timestamp(median(epoch_us(f))::BIGINT) AS mid FROM p)
SELECT o_orderkey, strftime(coalesce(f, (SELECT mid FROM m)), '%Y-%m-%d %H:%M:%S') AS fecha,
       strftime((SELECT mid FROM m), '%Y-%m-%d') AS dia_mediano FROM p""")
def median_filled_dates(spark, d):
    texts = _date_texts(spark, d)
    stats = clean.fit_clean(texts, {}, [], date_column="fecha", date_formats=presets.DATE_FORMATS)
    middle = clean.from_micros(stats.date_fill_micros)
    return clean.apply_clean(texts, stats).select(
        "o_orderkey", F.date_format("fecha", "yyyy-MM-dd HH:mm:ss").alias("fecha"),
        F.date_format(middle.cast("date"), "yyyy-MM-dd").alias("dia_mediano"))


# --- range rules and imputation ---------------------------------------------------------------------

RULES = {"l_quantity": (5, 45), "l_tax": (0.01, 0.07), "l_extendedprice": (1000, 90000)}
_ROW = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def _gappy_lines(spark: SparkSession, d: str) -> DataFrame:
    """Line items with gaps in the three checked columns, by hash of the row's identity; written once."""
    row = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    lines = spread(_lines(spark, d, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", *RULES), "l_orderkey")
    u = draws.uniforms(11, [f"gap.{c}" for c in RULES], "_row", "md5")
    gaps = {c: F.when(F.col("_u")[i] < 0.08, F.lit(None)).otherwise(F.col(c)) for i, c in enumerate(RULES)}
    return stage(lines.withColumn("_row", row).withColumn("_u", u).withColumns(gaps).drop("_u", "_row"), "gaps")


_GAPPY = "g AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount, " + ", ".join(
    f"CASE WHEN {sql_uniform(11, f'gap.{c}', _ROW)} < 0.08::DOUBLE THEN NULL ELSE {c} END AS {c}" for c in RULES) + " FROM lineitem)"
_MED1 = "m1 AS (SELECT " + ", ".join(f"median({c}) AS {c}" for c in RULES) + " FROM g)"
_FIXED = "f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, " + ", ".join(
    f"CASE WHEN g.{c} < {lo} OR g.{c} > {hi} THEN (SELECT {c} FROM m1) ELSE g.{c} END AS {c}"
    for c, (lo, hi) in RULES.items()) + ", CASE WHEN l_discount < 0.05 THEN 0::DOUBLE ELSE l_discount END AS l_discount FROM g)"
_MED2 = "m2 AS (SELECT " + ", ".join(f"median({c}) AS {c}" for c in RULES) + " FROM f)"
_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query("range_rules_fixed", f"WITH {_GAPPY}, {_MED1}, {_FIXED} SELECT {_KEYS}, l_discount, "
       + ", ".join(f"{sql_round(c, 6)} AS {c}" for c in RULES) + " FROM f")
def range_rules_fixed(spark, d):
    rows = _gappy_lines(spark, d)
    stats = clean.fit_clean(rows, RULES, [], {"l_discount": (0.05, 0)})
    return clean.apply_clean(rows, stats).select(
        *_KEYS.split(", "), "l_discount", *[round_half_even(c, 6).alias(c) for c in RULES])


@query("imputed_medians", f"WITH {_GAPPY}, {_MED1}, {_FIXED}, {_MED2} SELECT {_KEYS}, l_discount, "
       + ", ".join(f"{sql_round(f'coalesce({c}, (SELECT {c} FROM m2))', 6)} AS {c}" for c in RULES) + " FROM f")
def imputed_medians(spark, d):
    rows = _gappy_lines(spark, d)
    stats = clean.fit_clean(rows, RULES, list(RULES), {"l_discount": (0.05, 0)})
    return clean.apply_clean(rows, stats).select(
        *_KEYS.split(", "), "l_discount", *[round_half_even(c, 6).alias(c) for c in RULES])


@query("rule_violations", f"WITH {_GAPPY} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count_if({c} < {lo} OR {c} > {hi})::BIGINT AS violations FROM g" for c, (lo, hi) in RULES.items()))
def rule_violations(spark, d):
    return clean.violations(_gappy_lines(spark, d), RULES)


@query("nulls_before_after", f"WITH {_GAPPY} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count_if({c} IS NULL)::BIGINT AS nulls_before, 0::BIGINT AS nulls_after FROM g" for c in RULES))
def nulls_before_after(spark, d):
    rows = _gappy_lines(spark, d)
    stats = clean.fit_clean(rows, {}, list(RULES))
    return null_counts_before_after(rows, clean.apply_clean(rows, stats), list(RULES))


@query("null_counts", f"WITH {_GAPPY} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count_if({c} IS NULL)::BIGINT AS nulls FROM g" for c in RULES))
def null_counts(spark, d):
    return clean.null_counts(_gappy_lines(spark, d), list(RULES))


@query("column_medians", f"WITH {_GAPPY} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {sql_round(f'median({c})', 6)} AS median_value FROM g" for c in RULES))
def column_medians(spark, d):
    found = medians(_gappy_lines(spark, d), list(RULES))
    return spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), round_half_even(F.lit(v), 6).alias("median_value"))
        for c, v in found.items()])).alias("s")).select("s.*")


@query("conditional_overwrite", """
SELECT event_id, CASE WHEN value < 5 OR value > 100 THEN -1::DOUBLE ELSE value END AS value, (value < 5 OR value > 100) AS outside FROM events""")
def conditional_overwrite(spark, d):
    outside = out_of_range(number("value"), 5, 100)
    return table(spark, d, "events").select("event_id", overwrite_where("value", outside, -1.0).alias("value"),
                                            outside.alias("outside"))


# --- the whole clean table ---------------------------------------------------------------------------

_DATE = "regexp_replace(fecha, '^\\s+|\\s+$', '', 'g')"
_R = presets.RANGE_RULES
_TRAIN = f"{sql_uniform(5, 'mask', 'id_siniestro')} < 0.8"


def _clean_sql(fit_on: str = "true") -> str:
    """The clean table; ``fit_on`` limits the rows that statistics come from."""
    return f"""{DIRTY},
c0 AS (SELECT DISTINCT * FROM dirty),
c1 AS (SELECT * REPLACE (coalesce(try_strptime({_DATE}, '%Y-%m-%d'), try_strptime({_DATE}, '%d/%m/%Y'), try_strptime({_DATE}, '%Y/%m/%d')) AS fecha) FROM c0),
mid AS (SELECT make_timestamp(median(epoch_us(fecha))::BIGINT) AS fecha, {', '.join(f'median({c}) AS {c}' for c in _R)} FROM c1 WHERE {fit_on}),
c2 AS (SELECT * REPLACE (coalesce(fecha, (SELECT fecha FROM mid)) AS fecha,
  {', '.join(f"(CASE WHEN {c} < {lo} OR {c} > {hi} THEN (SELECT {c} FROM mid) ELSE {c} END)::DOUBLE AS {c}" for c, (lo, hi) in _R.items())},
  CASE WHEN pago_seguro_sol < 0 THEN 0::DOUBLE ELSE pago_seguro_sol END AS pago_seguro_sol) FROM c1),
mid2 AS (SELECT {', '.join(f'median({c}) AS {c}' for c in presets.NULLABLE_COLUMNS)}, max(lluvia_mm) AS max_rain, max(visibilidad_km) AS max_vis FROM c2 WHERE {fit_on}),
c3 AS (SELECT * REPLACE ({', '.join(f"coalesce({c}, (SELECT {c} FROM mid2))::DOUBLE AS {c}" for c in presets.NULLABLE_COLUMNS)}) FROM c2),
c4 AS (SELECT *,
  CASE WHEN contains(franja_horaria,'Noche') OR contains(franja_horaria,'Madrugada') THEN 1 ELSE 0 END AS es_horario_riesgo,
  {sql_round("lluvia_mm/(SELECT max_rain FROM mid2)*0.5::DOUBLE + (1::DOUBLE - visibilidad_km/(SELECT max_vis FROM mid2))*0.5::DOUBLE", 4)} AS indice_clima_peligro,
  {sql_round("experiencia_anios/edad_conductor", 4)} AS ratio_exp_edad,
  CASE WHEN antiguedad_veh > 10 THEN 1 ELSE 0 END AS vehiculo_antiguo,
  CASE WHEN mes IN (12,1,2) THEN 'Verano' WHEN mes IN (3,4,5) THEN 'Otoño' WHEN mes IN (6,7,8) THEN 'Invierno' ELSE 'Primavera' END AS estacion
  FROM c3),
limpios AS (SELECT *, {', '.join(f"(dense_rank() OVER (ORDER BY {c}) - 1)::INTEGER AS {c}_cod" for c in presets.ENCODED_COLUMNS)} FROM c4)"""


CLEAN = _clean_sql()
_ROUNDED = ["edad_conductor", "lluvia_mm", "flujo_vehicular", "visibilidad_km", "experiencia_anios", "temperatura_c"]


_SHOWN = ("SELECT * REPLACE (strftime(fecha, '%Y-%m-%d %H:%M:%S') AS fecha, " + ", ".join(f"{sql_round(c, 6)} AS {c}" for c in _ROUNDED)
          + ") FROM limpios")


@query("clean_accident_table", f"WITH {CLEAN} {_SHOWN}")
def clean_accident_table(spark, d):
    return _shown(clean_accidents(orders_as_dirty_accidents(spark, d)).table)


def _shown(done):
    return done.withColumns({"fecha": F.date_format("fecha", "yyyy-MM-dd HH:mm:ss"),
                             **{c: round_half_even(c, 6) for c in _ROUNDED}})


@query("clean_summary", f"""WITH {CLEAN} SELECT count(*) AS n_rows, 36::BIGINT AS n_columns,
  (count_if(nivel_riesgo IS NULL))::BIGINT AS nulls, {sql_round('avg(score_riesgo)', 2)} AS mean_score,
  {', '.join(f"{sql_round(f'avg(CASE WHEN nivel_riesgo = {chr(39)}{t}{chr(39)} THEN 1 ELSE 0 END)*100::DOUBLE', 1)} AS pct_{t.lower()}" for t in presets.TIERS)}
  FROM limpios""")
def clean_summary_query(spark, d):
    done = clean_accidents(orders_as_dirty_accidents(spark, d)).table
    return clean_summary(done, "score_riesgo", presets.TARGET, presets.TIERS)


@query("stats_from_train_rows", f"WITH {_clean_sql(_TRAIN)} {_SHOWN}")
def stats_from_train_rows(spark, d):
    """Cleaning whose medians and maxima come from the training share only."""
    return _shown(clean_accidents(orders_as_dirty_accidents(spark, d), fit_on=bernoulli_mask("id_siniestro", 0.8, 5, method="md5")).table)


# --- encoding -------------------------------------------------------------------------------------------

@query("label_codes", """
SELECT o_orderkey, o_orderpriority, (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::INTEGER AS o_orderpriority_cod,
       o_orderstatus, (dense_rank() OVER (ORDER BY o_orderstatus) - 1)::INTEGER AS o_orderstatus_cod FROM orders""")
def label_codes(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return encode.encode(orders, encode.fit_labels(orders, ["o_orderpriority", "o_orderstatus"]))


@query("label_codes_with_missing", """
WITH t AS (SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_type END AS p_type FROM part)
SELECT p_partkey, p_type, (dense_rank() OVER (ORDER BY coalesce(p_type, 'nan')) - 1)::INTEGER AS p_type_cod FROM t""")
def label_codes_with_missing(spark, d):
    parts = table(spark, d, "part").select(
        "p_partkey", F.when(F.col("p_size") % 7 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("p_type"))
    labels = encode.fit_labels(parts, ["p_type"], missing_as_text=True)
    return encode.encode(parts, labels, missing_as_text=True)


@query("catalog_codes", """
SELECT c_custkey, c_mktsegment, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2
  WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END AS c_mktsegment_cod FROM customer""")
def catalog_codes(spark, d):
    catalog = {"c_mktsegment": ["MACHINERY", "BUILDING", "AUTOMOBILE", "HOUSEHOLD", "FURNITURE"]}
    customers = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return encode.encode(customers, encode.from_catalogs(catalog))


@query("decoded_labels", """
SELECT event_id, (dense_rank() OVER (ORDER BY event_type) - 1)::INTEGER AS event_type_cod, event_type AS decoded FROM events""")
def decoded_labels(spark, d):
    events = table(spark, d, "events").select("event_id", "event_type")
    labels = encode.fit_labels(events, ["event_type"])
    coded = encode.encode(events, labels).drop("event_type")
    return encode.decode(coded, "event_type_cod", labels["event_type"], "decoded")


@query("class_mapping", """
SELECT 'o_orderstatus' AS column_name, o_orderstatus AS label, (row_number() OVER (ORDER BY o_orderstatus) - 1)::INTEGER AS code
FROM (SELECT DISTINCT o_orderstatus FROM orders)""")
def class_mapping(spark, d):
    return encode.class_mapping(spark, encode.fit_labels(table(spark, d, "orders"), ["o_orderstatus"]))


@query("codes_by_table", """
SELECT c_custkey, c_name, dense_rank() OVER (ORDER BY c_name) - 1 AS c_name_cod FROM customer""")
def codes_by_table(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_name")
    return encode.encode_by_table(customers, "c_name", encode.label_table(customers, "c_name"), "c_name_cod")


# --- derived features ----------------------------------------------------------------------------------

@query("index_by_data_maximum", f"""
WITH m AS (SELECT max(l_quantity) AS q, max(l_tax) AS t FROM lineitem)
SELECT {_KEYS}, {sql_round('l_quantity/(SELECT q FROM m)*0.5::DOUBLE + (1::DOUBLE - l_tax/(SELECT t FROM m))*0.5::DOUBLE', 4)} AS idx FROM lineitem""")
def index_by_data_maximum(spark, d):
    lines = _lines(spark, d, *_KEYS.split(", "), "l_quantity", "l_tax")
    top = clean.fit_clean(lines, {}, [], maxima=["l_quantity", "l_tax"]).maxima
    return lines.select(*_KEYS.split(", "), climate_index("l_quantity", "l_tax", top["l_quantity"], top["l_tax"]).alias("idx"))


@query("index_by_constants", f"""
SELECT {_KEYS}, {sql_round('l_quantity/300::DOUBLE*0.5::DOUBLE + (1::DOUBLE - l_tax/20::DOUBLE)*0.5::DOUBLE', 4)} AS idx FROM lineitem""")
def index_by_constants(spark, d):
    return _lines(spark, d, *_KEYS.split(", "), "l_quantity", "l_tax").select(
        *_KEYS.split(", "), climate_index("l_quantity", "l_tax", 300, 20).alias("idx"))


@query("ratios", f"""
SELECT {_KEYS}, {sql_round('l_extendedprice/l_quantity', 4)} AS per_unit,
  CASE WHEN l_discount = 0 THEN NULL ELSE {sql_round('l_tax/l_discount', 4)} END AS tax_to_discount FROM lineitem""")
def ratios(spark, d):
    lines = _lines(spark, d, *_KEYS.split(", "), "l_extendedprice", "l_quantity", "l_tax", "l_discount")
    return lines.select(*_KEYS.split(", "), ratio("l_extendedprice", "l_quantity").alias("per_unit"),
                        ratio("l_tax", "l_discount").alias("tax_to_discount"))


@query("seasons_and_flags", """
SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12,1,2) THEN 'Verano' WHEN month(o_orderdate) IN (3,4,5) THEN 'Otoño'
    WHEN month(o_orderdate) IN (6,7,8) THEN 'Invierno' ELSE 'Primavera' END AS estacion,
  CASE WHEN contains(o_orderpriority,'URGENT') OR contains(o_orderpriority,'HIGH') THEN 1 ELSE 0 END AS urgente,
  CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS grande FROM orders""")
def seasons_and_flags(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", lookup(F.month("o_orderdate"), presets.MONTH_TO_SEASON).alias("estacion"),
        flag_contains("o_orderpriority", ["URGENT", "HIGH"]).alias("urgente"),
        flag_above("o_totalprice", 250000).alias("grande"))


@query("lookup_misses", """
SELECT event_id, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE NULL END AS points FROM events""")
def lookup_misses(spark, d):
    return table(spark, d, "events").select("event_id", lookup("event_type", {"click": 1, "view": 2}).alias("points"))
