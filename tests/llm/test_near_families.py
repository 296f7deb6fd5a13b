"""How many rows near-dedup compares: for families with many edits, and for repeated rows."""

import random

import pytest

import brute
from amberline.llm import near_dedup
from test_words_sets_models import edited, frame, groups, passage


@pytest.fixture
def counted(monkeypatch):
    """Numbers of rows that are given to the exact comparison."""
    counts, beside = [], near_dedup.beside

    def counting(base, pairs):
        out = beside(base, pairs)
        counts.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "beside", counting)
    return counts


def family(seed, n, edits):
    rng = random.Random(seed)
    base = passage(rng, 200, 5000)
    rows = [(0, " ".join(base))] + [(1 + i, edited(rng, base, rng.choice(edits))) for i in range(n)]
    rng.shuffle(rows)
    return rows


def test_family_with_very_different_numbers_of_edits(spark, counted):
    """Members with few edits are linked to the middle of the family; those with many are linked with nothing, and not compared with all others."""
    rows = family(3, 250, range(1, 12))
    assert groups(near_dedup.near_duplicates(frame(spark, rows))) == brute.near_duplicates(rows)
    assert sum(counted) < 6 * len(rows)


def test_family_of_strangers(spark, counted):
    """All members have too many edits for a link, and many of them the same similarity to the others."""
    rows = family(4, 250, [7, 8])[:-1]
    assert groups(near_dedup.near_duplicates(frame(spark, rows))) == brute.near_duplicates(rows)
    assert sum(counted) < 6 * len(rows)


def test_links_between_edits_that_their_hub_does_not_share(spark):
    """Members that differ from the middle in the same words: the middle is near none of them, they are near each other."""
    rng = random.Random(6)
    base = passage(rng, 200, 5000)
    rows = [(i, edited(rng, base, 1)) for i in range(20)]
    other = edited(rng, base, 9).split()
    rows += [(100 + i, edited(rng, other, rng.choice([0, 1, 2]))) for i in range(15)]
    want = brute.near_duplicates(rows)
    assert len({c for _, c in want.values()}) >= 2
    assert groups(near_dedup.near_duplicates(frame(spark, rows))) == want


@pytest.mark.parametrize("ids", ["null", "one"])
def test_repeated_rows_are_compared_once(spark, counted, ids):
    rng = random.Random(9)
    base = passage(rng, 120)
    near, found = edited(rng, base, 2), []
    for n in (1, 8):
        doc = None if ids == "null" else 4
        counted.clear()
        out = near_dedup.near_duplicates(frame(spark, [(doc, " ".join(base)), (doc, near)] * n)).collect()
        assert len(out) == 2 * n and {r.component_id for r in out} == {doc}
        found.append(sum(counted))
    assert found == [found[0]] * 2


def test_repeated_rows_of_byte_dedup_grow_linearly(spark, monkeypatch):
    """Contexts that op2 compares, for two texts that share passages, each row repeated n times."""
    from pyspark.sql import functions as F

    from amberline.llm import repeats, suffix_dedup

    rng, sizes = random.Random(2), []
    a = passage(rng, 80)
    b = a[:30] + ["other"] + a[31:60] + ["words"] + a[61:]
    per_document = repeats.per_document

    def counting(found):
        out = per_document(found)
        sizes.append(out.agg(F.sum(F.size("left"))).first()[0])
        return out

    monkeypatch.setattr(repeats, "per_document", counting)
    entries = []
    for n in (1, 6):
        sizes.clear()
        rows = [(None, " ".join(a)), (3, " ".join(b))] * n
        docs = frame(spark, rows)
        out = suffix_dedup.drop_bytes(docs, suffix_dedup.removed_bytes(docs)).collect()
        assert len(out) == 2 * n and {r.n_removed for r in out if r.doc_id == 3} == {0}
        entries.append(sizes[0])
    assert entries[0] > 0 and entries == [entries[0]] * 2


def test_columns_with_the_names_of_the_operator(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (3, "other words that are here alone"), (3, "other words that are here alone")]
    docs = frame(spark, rows).selectExpr("doc_id", "text", "doc_id * 10 as _doc", "text as _mark", "source as kept")
    out = near_dedup.drop_near_duplicates(docs, 1000)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r._doc, r._mark == r.text, r.kept) for r in out.collect()) == [(1, 10, True, "s"), (3, 30, True, "s")]
