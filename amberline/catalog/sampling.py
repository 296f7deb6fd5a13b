"""Samples, splits, folds, class weights, scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import round_half_even
from ..operators import sample
from ..operators.models import fit_scaler, scaled
from ..operators.profile import value_shares
from .registry import query, sql_rank, sql_round, sql_uniform, table

MD5 = "md5"  # the hash DuckDB has too


def _orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_orderstatus")


@query("fixed_size_sample", f"""
SELECT o_orderkey, o_orderstatus FROM orders ORDER BY {sql_rank(3, 'o_orderkey')}, o_orderkey LIMIT 80""")
def fixed_size_sample(spark, d):
    return sample.sample_rows(_orders(spark, d), "o_orderkey", 80, 3, MD5)


@query("large_sample", f"""
SELECT event_id, value FROM (SELECT *, row_number() OVER (ORDER BY {sql_rank(4, 'event_id')}, event_id) AS rn,
  count(*) OVER () AS n FROM events) WHERE rn <= n // 3""")
def large_sample(spark, d):
    events = table(spark, d, "events").select("event_id", "value")
    return sample.sample_rows(events, "event_id", events.count() // 3, 4, MD5)


@query("bernoulli_mask", f"SELECT event_id, {sql_uniform(5, 'mask', 'event_id')} < 0.08::DOUBLE AS chosen FROM events")
def bernoulli_mask(spark, d):
    return table(spark, d, "events").select("event_id", sample.bernoulli_mask("event_id", 0.08, 5, method=MD5).alias("chosen"))


def _split_sql(source: str, key: str, label: str, seed: int = 42) -> str:
    return f"""
WITH c AS (SELECT {label} AS y, count(*) AS n FROM {source} GROUP BY 1),
t AS (SELECT sum(n)::BIGINT AS total, ((sum(n)::BIGINT + 4) // 5) AS n_test FROM c),
a AS (SELECT y, n, (n_test*n) // total AS q, (n_test*n) % total AS r, n_test FROM c, t),
g AS (SELECT y, q + CASE WHEN row_number() OVER (ORDER BY r DESC, n DESC, y) <= n_test - sum(q) OVER () THEN 1 ELSE 0 END AS k FROM a),
o AS (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {sql_rank(seed, key)}, {key}) AS rn FROM {source})"""


@query("stratified_split", _split_sql("orders", "o_orderkey", "o_orderstatus") + """
SELECT o_orderkey, o_orderstatus, rn <= k AS is_test FROM o JOIN g ON o.o_orderstatus = g.y""")
def stratified_split(spark, d):
    return sample.stratified_split(_orders(spark, d), "o_orderkey", "o_orderstatus", method=MD5)


_SKEWED = "(CASE WHEN o_orderkey % 200 = 0 THEN 'ALTO' WHEN o_orderkey % 10 < 3 THEN 'BAJO' ELSE 'MEDIO' END)"


def _skewed(spark, d):
    k = F.col("o_orderkey")
    y = F.when(k % 200 == 0, "ALTO").when(k % 10 < 3, "BAJO").otherwise("MEDIO")
    return table(spark, d, "orders").select("o_orderkey", y.alias("y"))


@query("stratified_split_skewed", _split_sql(f"(SELECT o_orderkey, {_SKEWED} AS y FROM orders)", "o_orderkey", "y") + """
SELECT o_orderkey, o.y, rn <= k AS is_test FROM o JOIN g ON o.y = g.y""")
def stratified_split_skewed(spark, d):
    return sample.stratified_split(_skewed(spark, d), "o_orderkey", "y", method=MD5)


@query("split_histogram", _split_sql("orders", "o_orderkey", "o_orderstatus") + f"""
SELECT o_orderstatus, n, {sql_round('n::DOUBLE/sum(n) OVER ()*100::DOUBLE', 1)} AS percent FROM
 (SELECT o_orderstatus, count(*) AS n FROM o JOIN g ON o.o_orderstatus = g.y WHERE rn > k GROUP BY 1)""")
def split_histogram(spark, d):
    marked = sample.stratified_split(_orders(spark, d), "o_orderkey", "o_orderstatus", method=MD5)
    return value_shares(marked.where(~F.col("is_test")), "o_orderstatus").drop("percent_text")


def _fold_sql(source: str, key: str, label: str, k: int) -> str:
    return f"""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {sql_rank(42, key)}, {key}) - 1 AS rn FROM {source}),
c AS (SELECT {label} AS y, sum(count(*)) OVER (ORDER BY {label}) - count(*) AS earlier FROM {source} GROUP BY 1)
SELECT {key}, o.{label}, ((rn + earlier::BIGINT) % {k})::INTEGER AS fold FROM o JOIN c ON o.{label} = c.y"""


@query("shuffled_folds", _fold_sql("orders", "o_orderkey", "o_orderstatus", 5))
def shuffled_folds(spark, d):
    return sample.stratified_folds(_orders(spark, d), "o_orderkey", "o_orderstatus", 5, method=MD5)


@query("shuffled_folds_skewed", _fold_sql(f"(SELECT o_orderkey, {_SKEWED} AS y FROM orders)", "o_orderkey", "y", 5))
def shuffled_folds_skewed(spark, d):
    return sample.stratified_folds(_skewed(spark, d), "o_orderkey", "y", 5, method=MD5)


@query("block_folds", """
WITH s AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS rn,
             min(o_orderkey) OVER (PARTITION BY o_orderstatus) AS seen FROM orders),
p AS (SELECT *, row_number() OVER (ORDER BY seen, rn) - 1 AS pos FROM s),
z AS (SELECT o_orderstatus, count_if(pos % 3 = 0)::BIGINT AS z0, count_if(pos % 3 = 1)::BIGINT AS z1 FROM p GROUP BY 1)
SELECT o_orderkey, s.o_orderstatus, CASE WHEN rn <= z0 THEN 0 WHEN rn <= z0 + z1 THEN 1 ELSE 2 END AS fold
FROM s JOIN z ON s.o_orderstatus = z.o_orderstatus""")
def block_folds(spark, d):
    return sample.block_folds(_orders(spark, d), "o_orderkey", "o_orderstatus", 3)


@query("class_weights", f"""
SELECT o_orderkey, {sql_round('(count(*) OVER ())::DOUBLE/((SELECT count(DISTINCT o_orderpriority) FROM orders)*count(*) OVER (PARTITION BY o_orderpriority))', 8)} AS w FROM orders""")
def class_weights(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return sample.with_balanced_weights(orders, "o_orderpriority").select("o_orderkey", round_half_even("w", 8).alias("w"))


@query("scaled_columns", f"""
WITH m AS (SELECT avg(l_quantity) AS a, stddev_pop(l_quantity) AS s, avg(l_tax) AS b, stddev_pop(l_tax) AS t FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, {sql_round('(l_quantity - (SELECT a FROM m))/(SELECT s FROM m)', 6)} AS q,
  {sql_round('(l_tax - (SELECT b FROM m))/(SELECT t FROM m)', 6)} AS t, 0::DOUBLE AS c FROM lineitem""")
def scaled_columns(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_tax",
                                               F.lit(3.0).alias("same"))
    stats = fit_scaler(lines, ["l_quantity", "l_tax", "same"])
    return lines.select("l_orderkey", "l_linenumber", "l_partkey",
                        round_half_even(scaled("l_quantity", stats), 6).alias("q"),
                        round_half_even(scaled("l_tax", stats), 6).alias("t"), scaled("same", stats).alias("c"))
