import hashlib
import re

import pytest

import brute
from amberline.llm import fill_middle
from amberline.llm.fill_middle import MARKERS, Splitter, digests, fill_in_middle, taken_back, whole_outputs

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def plain_version(doc, text, fim=90, spm=20):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in MARKERS) or h3 % 100 >= fim:
        return doc, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return doc, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def want(rows, **more):
    out = []
    for doc, text in rows:
        *facts, output = plain_version(doc, text, **more)
        out.append((*facts, brute.sha(output), brute.sha(text or "")))
    return sorted(out, key=str)


def got(df, **more):
    return sorted((tuple(r) for r in digests(taken_back(fill_in_middle(df, **more))).collect()), key=str)


ODD = ([(i, f"Wörter {i} <an>d\nMORE\r\n" * (i % 7)) for i in range(60)]
       + [(100, None), (101, ""), (102, "<P"), (103, "a<M>b"), (104, "<<S"), (105, "S><M"), (106, "éü" * 30), (107, "\x00\t"), (108, "x")]
       + [(None, "a null id 1 2 3"), (None, "a null id 1 2 3"), (None, "another"), (None, None), (7, "an id again"), (7, "an id again")])


def frame(spark, rows):
    # columns with names that the operator uses itself
    return spark.createDataFrame([(d, t, 1, "x", "y") for d, t in rows], "doc_id long, text string, part int, piece string, doc string")


@pytest.mark.parametrize("chunk_units", [1, 3, 8192])
def test_equals_plain_version(spark, chunk_units):
    assert got(frame(spark, ODD).repartition(3), chunk_units=chunk_units) == want(ODD)


def test_all_texts_in_each_form(spark):
    assert got(frame(spark, ODD), fim_percent=100, spm_percent=100) == want(ODD, fim=100, spm=100)
    assert got(frame(spark, ODD), fim_percent=100, spm_percent=0) == want(ODD, fim=100, spm=0)
    assert got(frame(spark, ODD), fim_percent=0) == want(ODD, fim=0)


def test_one_group_of_equal_rows(spark):
    rows = [(None, "the same row " * 20)] * 300 + [(5, "the same row " * 20)] * 100
    df = frame(spark, rows).repartition(16)
    assert got(df) == want(rows)
    # equal rows are spread by the partition they come from
    assert fill_in_middle(df).select("doc", "part").distinct().count() > 16


def test_long_units_and_texts(spark, monkeypatch):
    rows = [(1, "a" * 1_300_000 + "é"), (2, "b c" * 400_000), (3, "d" * 10)]
    assert got(frame(spark, rows), fim_percent=100) == want(rows, fim=100)
    pieces = fill_in_middle(frame(spark, rows), fim_percent=100)
    assert max(len(r.piece) for r in pieces.collect()) <= fill_middle.PIECE_BYTES + 3


def test_whole_outputs(spark):
    out = sorted(((r.doc_id, r.form, r.output) for r in whole_outputs(fill_in_middle(frame(spark, ODD))).collect()), key=str)
    assert out == sorted(((d, f, o) for d, _, f, _, _, o in (plain_version(*r) for r in ODD)), key=str)


def test_empty_table(spark):
    assert got(frame(spark, [])) == []
    assert whole_outputs(fill_in_middle(frame(spark, []))).collect() == []


@pytest.mark.parametrize("form,output", [("psm", b"<P>a<<S>b<P<M><S"), ("spm", b"<S>b<P<P>a<<M><S")])
def test_control_strings_across_pieces(form, output):
    for size in (1, 2, 3, 50):
        parts, found = Splitter(form), {0: b"", 1: b"", 2: b""}
        for i in range(0, len(output), size):
            for segment, data in parts.feed(output[i:i + size]):
                found[segment] += data
        for segment, data in parts.feed(b"", last=True):
            found[segment] += data
        assert found == {0: b"a<", 1: b"<S", 2: b"b<P"}


def test_broken_outputs_and_control_strings(spark):
    with pytest.raises(ValueError):
        list(Splitter("psm").feed(b"text<P>") )
    with pytest.raises(ValueError):
        list(Splitter("psm").feed(b"<P>a<S>b", last=True))
    with pytest.raises(ValueError):
        fill_in_middle(frame(spark, ODD), markers=("<P>", "<S<", "<M>"))


def test_one_shuffle(spark):
    plan = digests(taken_back(fill_in_middle(frame(spark, ODD))))._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert plan.count("Exchange") == 1 and plan.count("+- Sort") == 2
