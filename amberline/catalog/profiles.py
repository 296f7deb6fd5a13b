"""Counts, shares, describe and best-row queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions.scalar import round_half_even
from ..operators import profile
from ..operators.models import fold_summary
from ..operators.order_stats import column_facts
from .registry import query, sql_round, table

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("shape", "SELECT count(*) AS n_rows, 11::BIGINT AS n_columns FROM lineitem")
def shape(spark, d):
    return profile.shape(table(spark, d, "lineitem"))


@query("global_stats", f"""
SELECT count(*) AS n, min(l_extendedprice) AS min_value, max(l_extendedprice) AS max_value, {sql_round('avg(l_extendedprice)', 4)} AS mean_value FROM lineitem""")
def global_stats(spark, d):
    return profile.global_stats(table(spark, d, "lineitem"), "l_extendedprice").withColumn(
        "mean_value", round_half_even("mean_value", 4))


@query("value_counts", "SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type")
def value_counts(spark, d):
    return profile.value_counts(table(spark, d, "events"), "event_type")


@query("value_counts_over_domain", """
SELECT v.event_type, count(e.event_id) AS n FROM (VALUES ('click'), ('view'), ('refund'), ('signup')) v(event_type)
LEFT JOIN events e ON e.event_type = v.event_type GROUP BY v.event_type""")
def value_counts_over_domain(spark, d):
    return profile.value_counts(table(spark, d, "events"), "event_type", ["click", "view", "refund", "signup"])


@query("value_shares", f"""
SELECT o_orderpriority, count(*) AS n, {sql_round('count(*)::DOUBLE/(SELECT count(*) FROM orders)*100::DOUBLE', 1)} AS percent,
  printf('%.1f%%', {sql_round('count(*)::DOUBLE/(SELECT count(*) FROM orders)*100::DOUBLE', 1)}) AS percent_text
FROM orders GROUP BY o_orderpriority""")
def value_shares(spark, d):
    return profile.value_shares(table(spark, d, "orders"), "o_orderpriority")


@query("share_with_missing", f"""
SELECT {sql_round("avg(CASE WHEN s = 'F' THEN 1 ELSE 0 END)*100::DOUBLE", 4)} AS share FROM
  (SELECT CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS s FROM orders)""")
def share_with_missing(spark, d):
    orders = table(spark, d, "orders").select(
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("s"))
    return orders.agg(round_half_even(profile.share_of("s", "F"), 4).alias("share"))


@query("distinct_values", "SELECT DISTINCT c_mktsegment FROM customer")
def distinct_values(spark, d):
    return profile.distinct_values(table(spark, d, "customer"), "c_mktsegment")


@query("describe", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count({c}) AS "count", {sql_round(f'avg({c})', 2)} AS mean, {sql_round(f'stddev_samp({c})', 2)} AS std,
  {sql_round(f'min({c})', 2)} AS "min", {sql_round(f'quantile_cont({c}, 0.25)', 2)} AS q25, {sql_round(f'quantile_cont({c}, 0.5)', 2)} AS q50,
  {sql_round(f'quantile_cont({c}, 0.75)', 2)} AS q75, {sql_round(f'max({c})', 2)} AS "max" FROM lineitem""" for c in NUMBERS))
def describe(spark, d):
    return profile.describe(table(spark, d, "lineitem"), NUMBERS)


@query("describe_by_narrowing", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count({c}) AS "count", {sql_round(f'avg({c})', 2)} AS mean, {sql_round(f'stddev_samp({c})', 2)} AS std,
  {sql_round(f'min({c})', 2)} AS "min", {sql_round(f'quantile_cont({c}, 0.25)', 2)} AS q25, {sql_round(f'quantile_cont({c}, 0.5)', 2)} AS q50,
  {sql_round(f'quantile_cont({c}, 0.75)', 2)} AS q75, {sql_round(f'max({c})', 2)} AS "max" FROM lineitem""" for c in NUMBERS))
def describe_by_narrowing(spark, d):
    """The same by histograms alone, with no sketch to start from."""
    lines = table(spark, d, "lineitem")
    return profile.describe(lines, NUMBERS, facts={c: replace(f, ranges={}) for c, f in column_facts(lines, NUMBERS).items()})


DATED = ["o_totalprice", "o_orderdate"]


@query("describe_with_dates", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count(x) AS "count", {sql_round('avg(x)', 2)} AS mean, {sql_round('stddev_samp(x)', 2)} AS std,
  {sql_round('min(x)', 2)} AS "min", {sql_round('quantile_cont(x, 0.25)', 2)} AS q25, {sql_round('quantile_cont(x, 0.5)', 2)} AS q50,
  {sql_round('quantile_cont(x, 0.75)', 2)} AS q75, {sql_round('max(x)', 2)} AS "max" FROM (SELECT {x} AS x FROM orders)"""
    for c, x in (("o_totalprice", "o_totalprice"), ("o_orderdate", "date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::DOUBLE"))))
def describe_with_dates(spark, d):
    """Dates are described in days since 1970."""
    return profile.describe(table(spark, d, "orders"), DATED)


@query("spread_of_scores", f"""
SELECT {sql_round('avg(a)', 4)} AS mean_accuracy, {sql_round('stddev_pop(a)', 4)} AS std_accuracy FROM
  (SELECT user_id, avg(value) AS a FROM events GROUP BY user_id)""")
def spread_of_scores(spark, d):
    scores = table(spark, d, "events").groupBy("user_id").agg(F.avg("value").alias("accuracy"))
    out = fold_summary(scores)
    return out.select(*[round_half_even(c, 4).alias(c) for c in out.columns])


@query("best_row", """
SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC NULLS LAST, p_partkey LIMIT 1""")
def best_row(spark, d):
    return profile.first_best(table(spark, d, "part").select("p_partkey", "p_retailprice"), "p_retailprice", "p_partkey")


@query("first_rows", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def first_rows(spark, d):
    return profile.preview(table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), "o_orderkey", 5)
