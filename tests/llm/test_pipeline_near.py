"""The pipeline's near-dedup stage on planted copies."""

import brute
import corpus_pipeline as pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def text(seed, changed=0, words=204):
    """``words`` distinct words; ``changed`` of them, far apart, are others: each takes five of the 200 shingles."""
    w = [f"w{seed}x{i}" for i in range(words)]
    for c in range(changed):
        w[10 + 20 * c] = f"new{seed}x{c}"
    return " ".join(w)


def table(spark, docs):
    return spark.createDataFrame([(d, t, "en", "a", len(t or "")) for d, t in docs], SCHEMA)


def test_copies_between_80_and_85_percent_go(spark):
    # 3, 4 and 5 changed words: similarities 0.86, 0.82 and 0.78
    docs = [(10 * seed + k, text(seed, changed)) for seed in range(1, 21) for k, changed in enumerate((0, 3 + seed % 3))]
    kept = {r.doc_id for r in pipeline.near_dedup_stage(spark, table(spark, docs), None).collect()}
    wanted = {d for d, (_, least) in brute.near_duplicates(docs, 80).items() if d == least}
    assert kept == wanted
    assert wanted < {d for d, (_, least) in brute.near_duplicates(docs, 85).items() if d == least}


def test_stage_on_supplied_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before = [(r.doc_id, r.text) for r in docs.collect()]
    kept = {r.doc_id for r in pipeline.near_dedup_stage(spark, docs, None).collect()}
    assert kept == {d for d, (_, least) in brute.near_duplicates(before, 80).items() if d == least}


def test_one_row_stays_of_copies_with_null_or_shared_ids(spark):
    docs = [(None, text(1)), (None, text(1)), (None, text(1, 2)), (None, text(1).upper()),  # only null ids
            (None, text(2)), (7, text(2)), (7, text(2)), (9, text(2, 1)),  # a real id comes first
            (7, text(3)), (9, text(4)),  # ids of dropped or repeated rows, other texts
            (None, text(5)), (None, ""), (None, ""), (None, None)]
    kept = [(r.doc_id, r.text) for r in pipeline.near_dedup_stage(spark, table(spark, docs), None).collect()]
    first = [x for x in kept if x in docs[:4]]
    assert len(first) == 1
    rest = [(7, text(2)), (7, text(3)), (9, text(4)), (None, text(5)), (None, ""), (None, ""), (None, None)]
    assert sorted(map(repr, kept)) == sorted(map(repr, first + rest))
