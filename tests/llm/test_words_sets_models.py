import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from amberline.llm import decontaminate, language, near_dedup, quality, queries, repeats, substring_dedup, suffix_dedup, vec
from amberline.llm.suffix_array import equal_windows, suffix_array

DOCS = "doc_id long, text string, source string, c0 string, doc string, mark int"


def documents(spark, small):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "s", "x", "y", 1) for d, t in rows], DOCS)


def passage(rng, n, words=400):
    return [f"w{rng.randrange(words)}é" if rng.random() < .1 else f"w{rng.randrange(words)}" for _ in range(n)]


def odd_documents(seed=2):
    """Copies, shared passages with edits, repeats inside a text, one very long text, empties."""
    rng = random.Random(seed)
    shared = [passage(rng, 60) for _ in range(4)]
    rows = []
    for i in range(70):
        body = passage(rng, rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            p = list(rng.choice(shared))
            if rng.random() < .5:
                p[rng.randrange(len(p))] = "edit"
            at = rng.randint(0, len(body))
            body[at:at] = p
        rows.append((i * 3, rng.choice([" ", "\n", "  \t"]).join(body)))
    rows += [(500 + i, rows[5][1]) for i in range(40)]
    rows += [(900, None), (901, ""), (902, " \n\t "), (903, "a " * 300), (904, "ab" * 200), (905, " ".join(shared[0] + passage(rng, 30_000) + shared[1])),
             (906, "\x00" * 120), (907, "Ü" * 26)]
    rng.shuffle(rows)
    return rows


# --- helpers -------------------------------------------------------------------------------

def test_words_and_codes_do_not_depend_on_blocks():
    import pyarrow as pa

    texts = pa.array([t for _, t in odd_documents()])
    want = [brute.WORD.findall(t or "") for t in texts.to_pylist()]
    for limit in (1, 1000, 1 << 21):
        got, codes = [], {}
        for _, _, buf, offsets in vec.blocks(texts, limit):
            starts, ends, firsts = vec.word_spans(buf, offsets)
            data = buf.tobytes()
            words = [data[a:b].decode() for a, b in zip(starts, ends)]
            got += [words[a:b] for a, b in zip(firsts, firsts[1:])]
            for w, c in zip(words, vec.word_codes(buf, starts, ends).tolist()):
                assert codes.setdefault(w, c) == c
        assert got == want and len(set(codes.values())) == len(codes)


def test_suffix_arrays():
    rng = np.random.default_rng(0)
    for _ in range(300):
        x = rng.integers(0, rng.integers(1, 5), rng.integers(0, 60))
        assert suffix_array(x).tolist() == sorted(range(len(x)), key=lambda i: x[i:].tolist())
    data = np.frombuffer(b"abcabcxabcab", dtype=np.uint8)
    at, kind = equal_windows(data, np.array([0, 7]), np.array([6, 12]), 3)
    groups = {}
    for p, k in zip(at.tolist(), kind.tolist()):
        groups.setdefault(k, []).append(p)
    assert sorted(map(sorted, groups.values())) == [[0, 3, 7], [1, 8], [2, 9]]


def test_stream_does_not_depend_on_batches():
    rng = np.random.default_rng(1)
    rows = np.stack([rng.integers(0, 9, 500), rng.integers(0, 4, 500), rng.integers(0, 40, 500), np.zeros(500, int),
                     rng.integers(0, 50, 500) << 16 | 16], 1)
    rows = np.array(sorted(map(tuple, rows)))
    for smaller_only in (False, True):
        seen = []
        for size in (1, 13, 1000):
            s = repeats._Stream(smaller_only, True)
            parts = [s.feed(list(rows[i:i + size].T)) for i in range(0, len(rows), size)] + [s.feed([np.zeros(0, np.int64)] * 5, last=True)]
            seen.append(sorted(map(tuple, np.concatenate([np.stack(p, 1) for p in parts]).tolist())))
        assert seen[0] == seen[1] == seen[2]


# --- op2, op7 ------------------------------------------------------------------------------

def byte_rows(out):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()}


def word_rows(out):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out.collect()}


def test_bytes_of_the_small_table(spark, small):
    want = {d: (*x[:3], brute.sha(x[3])) for d, x in brute.byte_dedup(documents(spark, small)).items()}
    assert byte_rows(queries.QUERIES["op2_suffix_array_dedup"](spark, small)) == want


@pytest.mark.parametrize("options", [{}, {"bitmap": False, "block": 1}, {"bitmap": True, "block": 3_000}])
def test_bytes_of_odd_documents(spark, options):
    rows = odd_documents()
    df = frame(spark, rows).repartition(4)
    want = {d: (*x[:3], brute.sha(x[3])) for d, x in brute.byte_dedup(rows).items()}
    assert byte_rows(suffix_dedup.drop_bytes(df, suffix_dedup.removed_bytes(df, **options))) == want


def test_words_of_the_small_table(spark, small):
    want = {d: (*x[:2], brute.sha(x[2])) for d, x in brute.word_dedup(documents(spark, small)).items()}
    assert word_rows(queries.QUERIES["op7_substring_dedup"](spark, small)) == want


def test_words_of_odd_documents(spark, monkeypatch):
    rows = odd_documents()
    df = frame(spark, rows).repartition(4)
    want = {d: (*x[:2], brute.sha(x[2])) for d, x in brute.word_dedup(rows).items()}
    assert word_rows(substring_dedup.drop_repeated_words(df, substring_dedup.repeated_words(df))) == want
    short = {d: (*x[:2], brute.sha(x[2])) for d, x in brute.word_dedup(rows, 6).items()}
    assert word_rows(substring_dedup.drop_repeated_words(df, substring_dedup.repeated_words(df, length=6, seed=2))) == short


def test_repeats_with_repeated_rows_null_ids_and_no_rows(spark):
    text = " ".join(f"q{i}" for i in range(50))
    df = frame(spark, [(1, text), (1, text), (1, "other"), (None, text), (None, None)])
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in substring_dedup.drop_repeated_words(df, substring_dedup.repeated_words(df)).collect())
    assert got == [("1", 1, 0), ("1", 50, 50), ("1", 50, 50), ("None", 0, 0), ("None", 50, 50)]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.source) for r in suffix_dedup.drop_bytes(df, suffix_dedup.removed_bytes(df)).collect())
    n = len(text)
    assert got == sorted([("1", n, 0, "s"), ("1", n, 0, "s"), ("1", 5, 0, "s"), ("None", n, n, "s"), ("None", 0, 0, "s")])
    none = df.limit(0)
    assert substring_dedup.drop_repeated_words(none, substring_dedup.repeated_words(none)).count() == 0
    assert suffix_dedup.drop_bytes(none, suffix_dedup.removed_bytes(none)).count() == 0


# --- op3 -----------------------------------------------------------------------------------

def hits(out):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in out.collect()}


def test_contamination_of_the_small_table(spark, small):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    want = brute.contamination(documents(spark, small), items)
    assert hits(queries.QUERIES["op3_benchmark_decontamination"](spark, small)) == want
    assert any(x[1] for x in want.values())


@pytest.mark.parametrize("block_words", [500_000, 15])
def test_contamination_with_odd_items(spark, block_words):
    rng = random.Random(4)
    words = [f"a{i}" for i in range(6)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 12, 14, 20])))) for i in range(12)]
    items += [(20, None), (21, ""), (22, " -- "), (23, "Über-Straße 9 x! A0 a1 A2 a3 a4 A5 a0 a1"), (3, items[4][1]), (None, "a0 a0 a0 a0")]
    rows = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choice(words) if rng.random() < .95 else "zz" for _ in range(rng.randint(0, 80)))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, "!!"), (103, "x Über straße.9 X a0 A1 a2 a3 a4 a5 a0 a1"), (104, "a0 " * 5000)]
    df = frame(spark, rows)
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n_words int")
    got = hits(decontaminate.match_items(df, table, block_words=block_words))
    plain = [("null" if i is None else i, t) for i, t in items]
    assert got == brute.contamination(rows, plain)
    clean = decontaminate.decontaminate(df, table, block_words=block_words)
    kept = {r.doc_id: r.text for r in clean.collect()}
    assert clean.columns == df.columns and all(x[1] == 0 for x in brute.contamination(list(kept.items()), plain).values())
    assert all(kept[d] == t for d, t in rows if got[d][1] == 0) and {d for d, t in rows if 2 * got[d][1] <= got[d][0]} == set(kept)
    assert hits(decontaminate.match_items(df, table.limit(0))) == brute.contamination(rows, [])
    assert decontaminate.match_items(df.limit(0), table).count() == 0


# --- op4 -----------------------------------------------------------------------------------

def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = queries.QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert len(held) > 150 and sum(r.lang == r.lang_pred for r in held) >= .98 * len(held)


def test_language_of_odd_texts(spark):
    rows = [(i, t, lang, 1) for i, (t, lang) in enumerate([("the cat and the dog " * 3, "en"), ("der hund und die katze " * 3, "de"), ("кошка и собака дома " * 3, "ru")] * 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    profiles = language.learn(docs)
    assert set(profiles) == {"en", "de", "ru"}
    odd = [(1, None), (None, "123 !?"), (2, ""), (3, "СОБАКА"), (4, "the " * 50_000), (4, "x"), (5, "猫"), (6, "\x00²")]
    got = language.identify(spark.createDataFrame([(d, t, 7) for d, t in odd], "doc_id long, text string, held_out int"), profiles).collect()
    by = {(r.doc_id, r.lang_pred) for r in got}
    assert len(got) == 8 and {(1, "und"), (None, "und"), (2, "und"), (3, "ru"), (4, "en"), (6, "und")} <= by
    assert language.identify(docs.limit(0).select("doc_id", "text"), profiles).count() == 0
    assert {r.lang_pred for r in language.identify(docs, {}).collect()} == {"und"} and language.learn(docs.limit(0)) == {}
    assert not any(r.held_out for r in got if r.doc_id is None)


def test_bundles_are_sums_of_bound_grams():
    g = language.Grams(256)
    codes = np.array([97 << 42 | 98 << 21 | 99, 32 << 42 | 97 << 21 | 98], dtype=np.uint64)
    a, b, c, s = (g.letters(np.array([x]))[0].astype(int) for x in (97, 98, 99, 32))
    want = 2 * np.roll(a, 2) * np.roll(b, 1) * c + 3 * np.roll(s, 2) * np.roll(a, 1) * b
    for _ in range(2):  # computed, then kept
        assert (g.bundle(codes, np.array([2, 3])) == want).all()


# --- op5 -----------------------------------------------------------------------------------

def test_viterbi_finds_the_best_labels():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 8):
        for _ in range(20):
            crf = quality.Crf(np.zeros((1, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
            scores = rng.normal(size=(n, 2))

            def total(labels):
                return crf.begin[labels[0]] + sum(scores[i, y] for i, y in enumerate(labels)) + sum(crf.step[a, b] for a, b in zip(labels, labels[1:]))

            best = max(itertools.product((0, 1), repeat=n), key=total)
            assert tuple(quality.viterbi(crf, scores)) == best


def test_quality_of_the_small_table(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op5_quality_rules"](spark, sf).collect()}
    for r in docs.collect():
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == brute.quality(r.text)
        assert not (g.base_failed and g.kept)
    rated = [(got[r.doc_id], r.quality) for r in labels.collect() if not got[r.doc_id].base_failed]
    assert sum(g.kept == bool(q) for g, q in rated) >= .97 * len(rated)
    assert all(g.kept for g, q in rated if q) or sum(not g.kept for g, q in rated if q) <= .01 * len(rated)


def test_quality_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "a\na\n a\nb"), (4, "x y " * 60), (5, "é#*$%&|<>\x00 " * 30), (None, "w " * 19 + "w"), (6, "\n" * 50_000), (7, "  \x85 \xa0 z")]
    df = spark.createDataFrame([(d, t, 1, True) for d, t in rows], "doc_id long, text string, n_words int, kept boolean")
    got = quality.judge(df, quality.DEFAULT).collect()
    want = [(d, *brute.quality(t)) for d, t in rows]
    assert sorted(map(str, ((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got))) == sorted(map(str, want))
    assert quality.judge(df.limit(0), quality.DEFAULT).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fit_on_labels(df, none) is quality.DEFAULT


# --- op8 -----------------------------------------------------------------------------------

def groups(out):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()}


def test_near_duplicates_of_the_small_table(spark, small):
    out = queries.QUERIES["op8_near_dedup"](spark, small)
    assert groups(out) == brute.near_duplicates(documents(spark, small))
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect())


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_duplicates_of_families(spark):
    """Hubs whose copies are only alike through them, chains, families below the threshold, copies, empties."""
    rng = random.Random(8)
    rows, at = [], 0
    for family in range(6):
        base = passage(rng, 200, 5000)
        members = [" ".join(base)] + [edited(rng, base, rng.choice([1, 2, 3, 4])) for _ in range(12)]
        for _ in range(4):  # a chain, each near the one before
            members.append(edited(rng, members[-1].split(), 3))
        for text in members:
            rows.append((at, text))
            at += 1
    rows += [(2000 + i, rows[3][1].upper()) for i in range(30)]
    rows += [(3000, None), (3001, ""), (3002, " "), (3003, "one two"), (3004, "One  two\n"), (3005, "one two three"), (3006, "a " * 1000), (3007, "a " * 3000)]
    rng.shuffle(rows)
    want = brute.near_duplicates(rows)
    assert len({c for _, c in want.values()}) > 15
    assert groups(near_dedup.near_duplicates(frame(spark, rows))) == want


def test_near_duplicates_of_repeated_rows_null_ids_and_no_rows(spark):
    df = frame(spark, [(5, "a b c d e f"), (5, "a b c d e f"), (5, None), (None, "A b c d e f"), (None, "zz"), (2, "zz q")])
    got = sorted(map(str, ((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect())))
    assert got == sorted(map(str, [(5, 2, 5, True), (5, 2, 5, True), (5, 0, 5, True), (None, 2, 5, False), (None, 1, None, True), (2, 1, 2, True)]))
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.range(60).select((F.col("id") * 7 % 61).alias("a"), ((F.col("id") + 1) * 7 % 61).alias("b")).unionByName(spark.createDataFrame([(100, 101), (101, 102), (7, 7)], "a long, b long"))
    got = {r.node: r.label for r in near_dedup.components(links).collect()}
    assert all(got[i] == 0 for i in range(61)) and [got[i] for i in (100, 101, 102)] == [100, 100, 100]


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 400).astype(np.uint64)
    sets = [np.unique(pool[:300]), np.unique(pool[30:330]), pool[:1], pool[:0]]
    m = near_dedup.sketches(sets, 240)
    assert (m[:3] != 2**64 - 1).all() and (m[3] == 2**64 - 1).all()
    assert abs((m[0] == m[1]).mean() - 270 / 330) < .12


def test_automata_are_built_once_for_a_batch(monkeypatch):
    import pyarrow as pa

    class Block:
        def __init__(self, n):
            self.value = (f"test {n}", [(f"i{n}", " ".join(f"w{n}x{j}" for j in range(12)))])

    built = []
    real = decontaminate.Automaton
    monkeypatch.setattr(decontaminate, "Automaton", lambda *a: (built.append(1), real(*a))[1])
    texts = [" ".join(f"w{i % 4}x{j}" for j in range(12)) + " filler" * 60_000 for i in range(10)]
    out = list(decontaminate._matcher([Block(n) for n in range(4)], 10)(iter([pa.RecordBatch.from_arrays([pa.array(texts)], names=["_text"])])))
    assert len(built) == 4 and out[0].column("n_hit").to_pylist() == [12] * 10 and out[0].column("n_items").to_pylist() == [1] * 10


def test_lines_of_many_documents_have_labels_of_their_own():
    documents = [(1, [7, 1, 2]), (1, [7, 3]), (1, [7, 4, 7]), (0, [7, 5, 9]), (0, [9, 6]), (0, [9]), (1, [9, 8]), (0, [9]), (1, [])]
    got = [y.tolist() for y in quality.line_labels(documents)]
    assert got == [[1, 1, 1], [1, 1], [1, 1, 1], [0, 0, 0], [0, 0], [0], [0, 1], [0], []]
    got = [y.tolist() for y in quality.line_labels(documents, share=.75)]
    assert got[3] == [1, 0, 0]


def test_fit_of_a_very_long_labelled_document(spark):
    """Lines that a document is fitted on are bounded, rows that repeat an id count once, and the fit takes seconds."""
    import time

    long = "\n".join(f"line {i} with some words of its own" for i in range(100_000))
    junk = "\n".join("$$ ## !! ??" for _ in range(50))
    df = frame(spark, [(1, long)] + [(2, junk)] * 50 + [(3, junk + "\nx")])
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    begin = time.time()
    crf = quality.fit_on_labels(df, labels)
    assert time.time() - begin < 60
    assert crf.step[0, 0] > crf.step[0, 1] and crf.step[1, 1] > crf.step[1, 0]


def test_language_prediction_equals_a_plain_version(spark, small):
    """The whole result over all documents, from integer vectors that are bundled and compared one by one."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    got = {r.doc_id: r for r in queries.QUERIES["op4_language_id"](spark, small).collect()}
    want = brute.languages([(r.doc_id, r.text, r.lang) for r in docs.collect()])
    assert got.keys() == want.keys()
    for d, (held_out, lang, score) in want.items():
        assert (got[d].held_out, got[d].lang_pred) == (held_out, lang), d
        assert got[d].score == pytest.approx(score, abs=1e-6)
