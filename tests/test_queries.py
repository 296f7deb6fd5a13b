"""Every registered query against its DuckDB counterpart."""

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SMALL

NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
SLOW = {"three_jobs", "trained_comparison", "boosted_summary", "boosted_plain_summary", "saved_model_summary", "prediction_table", "fold_scores", "grid_scores",
        "boosted_scores", "boosted_scores_unweighted", "boosting_curve", "importances", "scored_routes",
        "route_summary_by_class", "route_top_lists", "answered_requests", "saved_model_answers", "streamed_answers",
        "logistic_scores", "forest_scores", "forest_by_trees", "boosted_by_trees", "importances_by_trees", "loss_by_round", "fold_sizes",
        "logistic_gradients"}  # covered by test_models and test_trees


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in NAMES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def comparable(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", [n for n in contract.queries() if n not in SLOW])
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    got = comparable(tuple(r[c] for c in columns) for r in df.collect())
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    rel = duck.sql(sql)
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert got == comparable(tuple(r[i] for i in at) for r in rel.fetchall())


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() == 5
