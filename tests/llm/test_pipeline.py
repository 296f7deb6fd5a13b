import pytest

import brute
import corpus_pipeline as pipeline
from amberline.llm.common import checkpointed
from test_lines_urls_chat import water


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def expected(name, before, sf_dir, spark):
    """What a stage must keep of ``before`` ({id: row}), as {id: text}; None where only conditions can be said."""
    docs = [(d, r.text) for d, r in before.items()]
    if name == "line_dedup":
        return {d: t for d, (_, dropped, t) in brute.line_dedup(docs, 10, keep_first=True).items() if not dropped or brute.WORD.search(t)}
    if name == "near_dedup":
        near = brute.near_duplicates(docs, 80)
        return {d: t for d, t in docs if near[d][1] == d}
    return None


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {}
    for name, stage in pipeline.STAGES:
        after = checkpointed(stage(spark, docs, sf_dir))
        out[name] = (rows_of(docs), rows_of(after), after.columns)
        docs = after
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "benchmark_decontamination", "mixing_sources"]
    for name, (before, after, columns) in stages.items():
        assert set(after) <= set(before)
        if name != "mixing_sources":
            assert columns == pipeline.COLUMNS
        assert all(r.n_chars == len(r.text) for r in after.values())


def test_quality_keeps_clean_documents(spark, stages):
    before, after, _ = stages["quality_rules"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    assert all(r.text == before[d].text for d, r in after.items())
    failed = {d for d, r in before.items() if brute.quality(r.text)[5]}
    assert not failed & set(after)
    clean = [d for d, q in labels.items() if q and d not in failed]
    assert sum(d in after for d in clean) >= .98 * len(clean)
    junk = [d for d, q in labels.items() if not q]
    assert sum(d not in after for d in junk) >= .8 * len(junk)


@pytest.mark.parametrize("name", ["line_dedup", "near_dedup"])
def test_dedup_stages(spark, stages, name):
    before, after, _ = stages[name]
    assert {d: r.text for d, r in after.items()} == expected(name, before, "/root/testdata/sf0.001", spark)


def test_decontamination_leaves_no_window(spark, stages):
    before, after, _ = stages["benchmark_decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    first = brute.contamination([(d, r.text) for d, r in before.items()], items)
    assert all(not x[1] for x in brute.contamination([(d, r.text) for d, r in after.items()], items).values())
    assert all(after[d].text == before[d].text for d, x in first.items() if not x[1])
    assert set(before) - set(after) == {d for d, x in first.items() if 2 * x[1] > x[0]}


def test_mixing_comes_near_the_targets(stages):
    before, after, _ = stages["mixing_sources"]
    sizes, taken, largest = {}, {}, {}
    for r in before.values():
        n = len(brute.WORD.findall(r.text))
        sizes[r.source] = sizes.get(r.source, 0) + n
        largest[r.source] = max(largest.get(r.source, 0), n)
    for r in after.values():
        assert r.taken == r.copies * r.size and 1 <= r.copies <= 2 and r.source_size == sizes[r.source]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in water(sizes).items():
        assert abs(taken.get(s, 0) - t) <= largest[s] / 2 + 1e-6


def test_run_gives_the_last_stage(spark, stages):
    got = rows_of(pipeline.run(spark, "/root/testdata/sf0.001"))
    assert got == stages["mixing_sources"][1]


def test_odd_rows_and_empty_tables(spark):
    sf_dir = "/root/testdata/sf0.001"
    schema = "doc_id long, text string, lang string, source string, n_chars long, h long, size string"
    odd = [(1, None, None, None, None, 1, "x"), (None, "", "en", "a", 0, 1, "x"), (2, "word " * 30_000, "en", None, 1, 1, "x"),
           (3, " ".join(f"a{i}" for i in range(60)), None, "b", 1, 1, "x"), (3, " ".join(f"a{i}" for i in range(60)), None, "b", 1, 1, "x"),
           (None, " ".join(f"b{i}" for i in range(60)), "de", "b", None, 1, "x")]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in pipeline.STAGES:
            docs = checkpointed(stage(spark, docs, sf_dir))
        assert (docs.count() > 0) == bool(rows)
