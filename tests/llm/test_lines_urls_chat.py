import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from amberline.llm import chat, line_dedup, mixing, queries, url_rules
from amberline.llm.templates import BEGIN, END, Template, TemplateError, parse

DOCS = "doc_id long, text string, source string, c0 string"


def documents(spark, small, name="documents"):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/{name}.parquet").collect()]


# --- op1 -----------------------------------------------------------------------------------

def check_lines(spark, rows, min_docs, keep_first=False):
    df = spark.createDataFrame([(d, t, "s", "x") for d, t in rows], DOCS).repartition(5)
    maps = line_dedup.line_bitmaps(df, min_docs, keep_first)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.drop_lines(df, maps).collect()}
    assert got == {d: (n, k, brute.sha(t)) for d, (n, k, t) in brute.line_dedup(rows, min_docs, keep_first).items()}


def test_lines_of_the_small_table(spark, small):
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in queries.QUERIES["op1_line_dedup"](spark, small).collect()}
    want = brute.line_dedup(documents(spark, small))
    assert got == {d: (n, k, brute.sha(t)) for d, (n, k, t) in want.items()}
    assert any(k for _, k, _ in want.values())


@pytest.mark.parametrize("keep_first", [False, True])
def test_lines_with_hot_and_odd_lines(spark, keep_first):
    rng = random.Random(3)
    rows = [(i, "\n".join(["  Hot LINE\t" if rng.random() < .8 else f"own {i}", "", rng.choice("abcdefg") * 3, "\x0b", "é\x00z"] * rng.randint(1, 3)))
            for i in range(120)]
    rows += [(1000, None), (1001, ""), (1002, "\n\n"), (1003, "hot line\n" * 3000), (1004, "x" * 100_000 + "\nhot line")]
    check_lines(spark, rows, 10, keep_first)
    check_lines(spark, rows, 2, keep_first)


def test_lines_of_empty_table_and_repeated_rows(spark):
    df = spark.createDataFrame([], DOCS)
    assert line_dedup.drop_lines(df, line_dedup.line_bitmaps(df)).count() == 0
    rows = [(1, "a\nb", "s", "x"), (1, "a\nb", "s", "x"), (1, "c", "s", "x"), (2, "a", "s", "x"), (None, "a\nd", "s", "x"), (None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    got = sorted((str(r.doc_id), r.n_lines, r.n_dropped, str(r.text)) for r in line_dedup.drop_lines(df, line_dedup.line_bitmaps(df, 3)).collect())
    assert got == sorted([("1", 2, 1, "b"), ("1", 2, 1, "b"), ("1", 1, 0, "c"), ("2", 1, 1, ""), ("None", 2, 1, "d"), ("None", 1, 0, "None")])


@pytest.mark.parametrize("keep_first", [False, True])
def test_stream_does_not_depend_on_batches(keep_first):
    rng = np.random.default_rng(0)
    rows = np.unique(np.stack([rng.integers(0, 4, 400), rng.integers(0, 2, 400), rng.integers(0, 30, 400), 0 * rng.integers(0, 2, 400),
                               rng.integers(0, 3, 400)], 1), axis=0)
    results = []
    for size in (1, 7, 1000):
        stream = line_dedup._Stream(5, keep_first)
        out = [stream.feed(list(rows[i:i + size].T)) for i in range(0, len(rows), size)] + [stream.feed([np.zeros(0, np.int64)] * 5, last=True)]
        out = np.concatenate([np.stack(o, 1) for o in out])
        results.append({tuple(r) for r in out[out[:, 5] == 1].tolist()})
    inner = [{r for r in x if r[:2] not in {tuple(rows[0][:2]), tuple(rows[-1][:2])}} for x in results]
    assert inner[0] >= set() and inner[1] == inner[2]


# --- op9 -----------------------------------------------------------------------------------

def test_urls_of_the_small_table(spark, small):
    rules = [tuple(r) for r in queries.RULES]
    for r in queries.QUERIES["op9_url_filters"](spark, small).join(spark.read.parquet(f"{small}/pages.parquet"), "page_id").collect():
        host, path = brute.url_parts(r.url)
        rule, verdict = brute.url_rule(host, path, rules)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or "allow")


@pytest.mark.parametrize("block_rules", [100_000, 3])
def test_urls_with_many_nested_rules(spark, block_rules):
    rng = random.Random(5)
    hosts = ["org", "example.org", "a.example.org", "b.a.example.org", "com", "x.com", "example-a.org", "", "org.example"]
    rules = [url_rules.Rule(h, p, rng.choice(["allow", "block"])) for h in hosts if h for p in rng.sample(["/", "/a", "/a/b", "", "/é"], 3)]
    urls = [f"HTTP://{rng.choice(['', 'w.', 'a.b.'])}{rng.choice(hosts)}{rng.choice(['', ':80'])}{rng.choice(['', '/', '/a', '/a/b/c', '/é?x', '#y', '?q=/a'])}"
            for _ in range(400)] + [None, "", "no scheme/a", "://", "x://y://z/a", "a://b\nc/d\ne?f"]
    df = spark.createDataFrame([(i if i % 9 else None, u, "k", "r") for i, u in enumerate(urls)], "page_id long, url string, k string, rule string")
    out = url_rules.judge_urls(df, rules, default="none", block_rules=block_rules)
    got = sorted(map(str, ((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out.collect())))
    want = []
    for i, u in enumerate(urls):
        host, path = brute.url_parts(u)
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: (len(r.text), len(r.host), r.text), default=None)
        want.append((i if i % 9 else None, host, path, best.text if best else None, best.verdict if best else "none"))
    assert got == sorted(map(str, want))
    assert url_rules.judge_urls(df.limit(0), rules).count() == 0


# --- op6 -----------------------------------------------------------------------------------

def test_chat_reads_back(spark, small):
    convs = {}
    for r in spark.read.parquet(f"{small}/conversations.parquet").orderBy("conv_id", "turn").collect():
        convs.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    convs[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in queries.QUERIES["op6_chat_formatting"](spark, small).collect()}
    assert set(got) == set(convs)
    for c, turns in convs.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), brute.sha("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), brute.sha(loss))


@pytest.mark.parametrize("chunk_chars", [1, 9, 1 << 20])
def test_chat_with_odd_turns(spark, chunk_chars):
    texts = ["", None, "\\", "\\<s>", "<s></s>", "[INST[INST]", "<|turn|>\n<|text|>", "a" * 5000, "é\U0001f600[/INST]", "<\\/s>", "[\\INST]"]
    rows = [(1, i, role, t, "t") for i, t in enumerate(texts) for role in ("assistant", "user", None, "<|text|>")]
    rows += [(2, None, "assistant", "x", "t"), (2, None, "assistant", "x", "t"), (None, 1, "user", "y", "t")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, chunk string")
    formatted = chat.format_conversations(df, chunk_chars=chunk_chars)
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    ordered = sorted(((r or "", t or "", i) for _, i, r, t, _ in rows[:-3]), key=lambda x: (x[2], x[0], x[1]))
    assert got[1].turns_sha256 == brute.sha("".join(f"{r}\n{t}\n" for r, t, _ in ordered)) and got[1].n_turns == 44
    assert got[1].loss_sha256 == brute.sha("".join(t or "" for t in texts))
    assert (got[2].n_turns, got[2].loss_chars, got[None].n_turns, got[None].loss_chars) == (2, 2, 1, 0)
    whole = "".join(r.text for r in formatted.where("conv_id = 1").orderBy("chunk").collect())
    assert len(whole) == got[1].formatted_chars
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_templates():
    def render(source, **v):
        return "".join("<" if p is BEGIN else ">" if p is END else p for p in Template(source).render(**v))

    assert render("a{{ 1 + 2 }}b{# no #}{{ 'x' ~ none ~ true }}") == "a3bxtrue"
    assert len(Template("a{{ 1 + 2 }}{% if 1 == 2 %}{{ x }}{% else %}c{% endif %}").tree) == 1
    assert render("{% for m in ms %}{{ loop.index }}{{ m.a if loop.last else m['b'] }}{% generation %}{{ m.b | upper }}{% endgeneration %}{% endfor %}",
                  ms=iter([{"a": "p", "b": "q"}, {"a": "r", "b": "s"}])) == "1q<Q>2r<S>"
    assert render("{% set y = x | length %}{% if y > 2 and not z %}big{% elif y == 2 %}two{% else %}small{% endif %}", x="ab") == "two"
    assert render("a {%- if 'b' in 'abc' -%} b {%- endif %} c") == "ab c"
    assert render("{{ '}}' }}") == "}}"
    with pytest.raises(TemplateError):
        render("{{ x.__class__ }}", x="")
    for bad in ("{% for x in y %}", "{{ x", "{% endif %}", "{{ x | system }}", "{{ f() }}", "{% import os %}", "{{ 1 'a' }}"):
        with pytest.raises(TemplateError):
            Template(bad)
    assert parse("") == ()


# --- op10 ----------------------------------------------------------------------------------

def water(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    left = share * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] >= most * sizes[s]}
        if not full:
            return target | {s: level * w[s] for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def check_mix(rows, docs):
    sizes = {}
    for d, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len(brute.WORD.findall(text or ""))
    target, taken, largest = water(sizes), dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]], rel=1e-9, abs=1e-6)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6


def test_mix_of_the_small_table(spark, small):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    of = {d: s for d, _, s in docs}
    rows = [r.asDict() | {"source": of[r.doc_id]} for r in queries.QUERIES["op10_mixing"](spark, small).collect()]
    assert len(rows) == len(docs)
    check_mix(rows, docs)
    again = queries.QUERIES["op10_mixing"](spark, small).collect()
    assert sorted(r.taken for r in again) == sorted(r["taken"] for r in rows)


def test_mix_of_odd_rows(spark):
    rng = random.Random(1)
    docs = [(rng.randint(0, 60) if i % 7 else None, " w" * rng.randint(0, 9) if i % 11 else None, rng.choice(["a", "b", "", "é", None])) for i in range(300)]
    docs += [(1000, "one " * 20_000, "z"), (1001, None, "empty")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("h", F.lit(1)).withColumn("size", F.lit("x"))
    rows = [r.asDict() for r in mixing.mix_sources(df).collect()]
    assert len(rows) == len(docs)
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert mixing.mix_sources(df.limit(0)).count() == 0
