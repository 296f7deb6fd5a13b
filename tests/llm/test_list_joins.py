"""Lists beyond the limit are joined to the texts by a shuffle, whatever Catalyst takes their size for."""

import pytest

from amberline.llm import repeats, suffix_dedup


@pytest.fixture(scope="module")
def docs(spark):
    passage = "the quick brown fox jumps over the lazy dog and runs away from here again "
    rows = [(i, f"{i} own words of number {i * 7919} " + (passage if i % 2 else passage[::-1]) + f"end {i}") for i in range(40)]
    return spark.createDataFrame([*rows, (40, None), (41, "")], "doc_id long, text string")


def test_the_limit_decides_the_join(spark):
    texts = spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "doc long, mark long, text string")
    lists = spark.createDataFrame([(1, 1, [3, 4])], "doc long, mark long, spans array<long>")
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    small, large = (repeats.beside_text(texts, lists, "spans", "left", n) for n in (1000, 0))
    assert "BroadcastHashJoin" in plan(small) and "SortMergeJoin" in plan(large) and "Broadcast" not in plan(large)
    assert sorted(small.collect()) == sorted(large.collect())


def test_both_joins_give_the_same_rows(docs, monkeypatch):
    found = []
    for limit in (0, 1 << 20):
        monkeypatch.setattr(suffix_dedup, "LIST_BYTES", limit)
        out = suffix_dedup.drop_bytes(docs, suffix_dedup.removed_bytes(docs))
        found.append(sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()))
    assert found[0] == found[1] and len(found[0]) == 42 and sum(r[2] for r in found[0]) > 0
