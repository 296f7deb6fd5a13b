"""Scalar functions, bins and rule scores on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import presets
from ..functions.scalar import (capped, clip, cut, floored, lookup, number, percent_text, round_decimal, round_half_even, scorecard,
                                strip, text_bar, text_or_nan)
from ..operators.clean import epoch_micros
from .registry import query, sql_cut, sql_round, sql_round_decimal, table


@query("rounding", f"""
SELECT event_id, {sql_round('value/8::DOUBLE', 2)} AS r2, {sql_round('value/7::DOUBLE', 4)} AS r4, {sql_round('value/2::DOUBLE', 0)} AS r0,
  {sql_round_decimal('half', 2)} AS exact FROM (SELECT *, value*0.5::DOUBLE AS half FROM events)""")
def rounding(spark, d):
    return table(spark, d, "events").withColumn("half", F.col("value") * 0.5).select(
        "event_id", round_half_even(F.col("value") / 8.0, 2).alias("r2"),
        round_half_even(F.col("value") / 7.0, 4).alias("r4"), round_half_even(F.col("value") / 2.0).alias("r0"),
        round_decimal("half", 2).alias("exact"))


@query("clipping", """
WITH t AS (SELECT event_id, CASE WHEN user_id % 5 = 0 THEN NULL ELSE value END AS v FROM events)
SELECT event_id, CASE WHEN v IS NULL THEN NULL ELSE least(greatest(v, 0.5::DOUBLE), 20::DOUBLE) END AS clipped,
  CASE WHEN v > 10 THEN 10::DOUBLE ELSE v END AS at_most, CASE WHEN v < 10 THEN 10::DOUBLE ELSE v END AS at_least,
  abs(v - 10::DOUBLE) AS distance FROM t""")
def clipping(spark, d):
    v = F.when(F.col("user_id") % 5 == 0, F.lit(None)).otherwise(F.col("value"))
    return table(spark, d, "events").select("event_id", v.alias("v")).select(
        "event_id", clip("v", 0.5, 20.0).alias("clipped"), capped("v", 10.0).alias("at_most"),
        floored("v", 10.0).alias("at_least"), F.abs(F.col("v") - 10.0).alias("distance"))


@query("text_functions", """
SELECT p_partkey, regexp_replace('  ' || p_name || chr(9), '^\\s+|\\s+$', '', 'g') AS stripped,
  coalesce(CASE WHEN p_size > 25 THEN p_type END, 'nan') AS as_text, format('P-{:06d}', p_partkey) AS padded,
  contains(p_name, 'red') AS is_red, CASE WHEN p_size > 40 THEN 'N/A' ELSE printf('%.1f%%', (p_size/64::DOUBLE)*100::DOUBLE) END AS pct,
  repeat('█', floor(p_size/64::DOUBLE*20)::INTEGER) AS bar, (p_size > 10)::INTEGER AS flag FROM part""")
def text_functions(spark, d):
    share = F.col("p_size") / F.lit(64.0)
    return table(spark, d, "part").select(
        "p_partkey", strip(F.concat(F.lit("  "), F.col("p_name"), F.lit("\t"))).alias("stripped"),
        text_or_nan(F.when(F.col("p_size") > 25, F.col("p_type"))).alias("as_text"),
        F.format_string("P-%06d", "p_partkey").alias("padded"), F.contains("p_name", F.lit("red")).alias("is_red"),
        percent_text(F.when(F.col("p_size") > 40, F.lit(None)).otherwise(share)).alias("pct"),
        text_bar(share).alias("bar"), (F.col("p_size") > 10).cast("int").alias("flag"))


@query("date_functions", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, epoch_us(ts) AS micros, month(ts)::INTEGER AS mes FROM events""")
def date_functions(spark, d):
    return table(spark, d, "events").select(
        "event_id", F.date_format(F.to_date("ts"), "yyyy-MM-dd").alias("day"), epoch_micros("ts").alias("micros"),
        F.month("ts").alias("mes"))


_EDGE = "(CASE WHEN event_id % 11 = 0 THEN 33 WHEN event_id % 11 = 1 THEN 66 WHEN event_id % 11 = 2 THEN 0 WHEN event_id % 11 = 3 THEN 100 ELSE value END)::DOUBLE"


def _edge_values(spark, d):
    k = F.col("event_id") % 11
    x = (F.when(k == 0, 33.0).when(k == 1, 66.0).when(k == 2, 0.0).when(k == 3, 100.0).otherwise(F.col("value")))
    return table(spark, d, "events").select("event_id", x.alias("x"))


@query("tier_bins", f"SELECT event_id, {sql_cut(_EDGE, presets.TIER_EDGES, presets.TIERS)} AS tier FROM events")
def tier_bins(spark, d):
    return _edge_values(spark, d).select("event_id", cut("x", presets.TIER_EDGES, presets.TIERS).alias("tier"))


@query("tier_bins_as_text", f"SELECT event_id, coalesce({sql_cut(_EDGE, presets.TIER_EDGES, presets.TIERS)}, 'nan') AS tier FROM events")
def tier_bins_as_text(spark, d):
    return _edge_values(spark, d).select("event_id", text_or_nan(cut("x", presets.TIER_EDGES, presets.TIERS)).alias("tier"))


@query("missing_numbers", """
SELECT event_id, CASE WHEN user_id % 3 = 0 THEN NULL ELSE value END AS value,
       coalesce(CASE WHEN user_id % 3 = 0 THEN NULL ELSE value END > 85, false) AS above FROM events""")
def missing_numbers(spark, d):
    """NaN is written into the column and must behave as missing."""
    x = number(F.when(F.col("user_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("value")))
    return table(spark, d, "events").select("event_id", x.alias("value"), F.coalesce(x > 85, F.lit(False)).alias("above"))


@query("part_scorecard", f"""
SELECT p_partkey, {sql_round('raw', 2)} AS score FROM (SELECT p_partkey, least(greatest(least(p_size/50::DOUBLE*60::DOUBLE, 50::DOUBLE) + greatest((1500::DOUBLE-p_retailprice)/600::DOUBLE*30::DOUBLE, 0::DOUBLE) + CASE p_type WHEN 'ECONOMY' THEN 3::DOUBLE WHEN 'SMALL' THEN 5::DOUBLE ELSE 9::DOUBLE END, 0::DOUBLE), 100::DOUBLE) AS raw FROM part)""")
def part_scorecard(spark, d):
    kind = F.coalesce(lookup("p_type", {"ECONOMY": 3.0, "SMALL": 5.0}), F.lit(9.0))
    return table(spark, d, "part").select("p_partkey", scorecard([
        capped(F.col("p_size") / 50.0 * 60.0, 50.0),
        floored((1500.0 - F.col("p_retailprice")) / 600.0 * 30.0, 0.0), kind]).alias("score"))
