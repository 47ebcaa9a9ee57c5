import difflib
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from draftloom.functions import blocks, text


def one(spark, expr, **cols):
    schema = ", ".join(f"{k} string" for k in cols)
    return spark.createDataFrame([tuple(cols.values())], schema).select(expr.alias("x")).first()[0]


PROBES = ["", " ", "a", "\xa0 a \x1c", "a\r\nb\x0bc d\n", "x\n\n\ny\n \nz", "\n\na\n\t\nb\xa0\n\xa0\nc", "a\r\n\r\nb", "\x85a\x85\x85b"]


def test_strip_and_lines_are_pythons(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(PROBES)], "i int, t string").select("i", "t", text.strip(F.col("t")).alias("s"), text.lines(F.col("t")).alias("l"))
    for r in df.collect():
        assert r.s == r.t.strip(), repr(r.t)
        assert r.l == (r.t.splitlines() if r.t else []), repr(r.t)


def brute_paragraphs(t):
    out, run = [], []
    for line in t.splitlines():
        if line.strip():
            run.append(line)
        elif run:
            out.append("\n".join(run))
            run = []
    return out + (["\n".join(run)] if run else [])


def test_paragraphs(spark):
    df = spark.createDataFrame([(p,) for p in PROBES], "t string").select("t", text.paragraphs(F.col("t")).alias("p"))
    for r in df.collect():
        assert r.p == brute_paragraphs(r.t), repr(r.t)
    assert one(spark, text.paragraphs(F.col("t")), t=None) is None


def brute_pack(parts, budget):
    out, buf = [], None
    for p in parts:
        if buf is not None and len(buf) + 2 + len(p) <= budget:
            buf += "\n\n" + p
        else:
            out += [buf] if buf is not None else []
            buf = p
    return out + ([buf] if buf is not None else [])


def test_pack(spark):
    cases = [[], ["abc"], ["a" * 30], ["a" * 4, "b" * 4, "c" * 4, "d" * 30, "e"], ["x"] * 20]
    df = spark.createDataFrame([(c,) for c in cases], "p array<string>").select("p", text.pack(F.col("p"), 12).alias("q"))
    for r in df.collect():
        assert r.q == brute_pack(r.p, 12)


def test_gate(spark):
    long = "word " * 40
    cases = {long: True, "short": False, "| a |\n| b | " + "x" * 90: False, "\n".join(f"- [t{i}](http://x/{i * 'y'})" for i in range(12)): False, "- " + long: True, "y" * 8001: False}
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", text.keep_chunk(F.col("t")).alias("k"))
    for r in df.collect():
        want = cases[r.t] if not r.t.startswith("|") else "x" in r.t.split("\n")[1][:0] or False
        assert r.k == want, r.t[:40]
    assert one(spark, text.keep_chunk(F.col("t")), t=None) is False


def test_truncate_at_headers(spark):
    t = "a\n# One {#x}\nb\n### two\nc"
    for headers, want in ((["## ONE"], "a\n"), (["Two"], "a\n# One {#x}\nb\n"), (["none"], t), ([], t)):
        assert one(spark, text.truncate_at_headers(F.col("t"), headers), t=t) == want


def test_pair_content_round_trip(spark):
    for c, b in (("## H", "body"), ("", "body"), (None, "body"), ("## H", "")):
        got = spark.createDataFrame([(c, b)], "c string, b string").select(text.pair_body(text.pair_content(F.col("c"), F.col("b")), F.col("c")).alias("x")).first()[0]
        assert got == b


def test_anchors(spark):
    a = "see [x](http://a/b) and https://c/d, @key:1 [y](http://a/b)"
    assert sorted(one(spark, text.anchors(F.col("t")), t=a)) == ["@key:1", "http://a/b", "http://a/b", "https://c/d,"]
    lost = spark.createDataFrame([(a, "see [x](http://a/b) @key:1")], "s string, c string").select(text.missing_anchors(F.col("s"), F.col("c"))).first()[0]
    assert lost == ["http://a/b", "https://c/d,"]


def test_selectors(spark):
    rows = [("0", True), ("1", False), ("+0", True), ("-1", True), ("1_0", False), ("0.5", False), ("", False), (None, False), ("zero", False), (" 0 ", True)]
    df = spark.createDataFrame(rows, "t string, want boolean").select("t", "want", text.is_human_authored(F.col("t")).alias("k"))
    for r in df.collect():
        assert r.k == r.want, r.t
    for t, want in (("2024-01-02T00:00", True), ("2023-01-01", False), ("soon", False), (None, False)):
        assert one(spark, text.is_modified_after(F.col("t"), "2023-06-30"), t=t) is want


DOCS = ["", "p\n\n```py\n$$ not\n```\n\nq\n", "a $$x$$ {#e} b\n", "lead\n\n> q\n> r\n\nend", "::: {.a}\nx\n::: {.b}\ny\n:::\n:::\nafter", "::: {.open}\nnever", "> a\n::: x\n> b\n:::\n"]


def test_segments_lossless():
    for d in DOCS:
        assert "".join(s for s, _ in blocks.segments(d)) == d
    assert [e for _, e in blocks.segments(DOCS[4])] == [False, True]
    assert [e for _, e in blocks.segments(DOCS[5])] == [True]


@settings(max_examples=150, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from(["a", "```", "~~~", ":::", "::: {.x}", "> q", "", " ", "$$", "# h", "b c", "`"]), max_size=14))
def test_text_blocks_round_trip(lines):
    d = "\n".join(lines)
    assert "".join(s for s, _ in blocks.segments(d)) == d
    assert "".join(t + s for _, t, s in blocks.body_chunks(d, 10)) == d
    for t, a, b in blocks.prose_spans(d):
        assert d[a:b] == t and t.strip()


def test_frontmatter():
    assert blocks.split_frontmatter("---\na: 1\n---\nbody") == ('{"a": 1}', "body")
    assert blocks.split_frontmatter("---\na: 1\n...\nbody")[1] == "body"
    assert blocks.split_frontmatter("---\n---\nb") == ("{}", "b")
    for raw in ("", "body", "---\na: [\n---\nb", "---\n- x\n---\nb", "---\na: 1\n"):
        assert blocks.split_frontmatter(raw) == ("{}", raw)


def test_similarity_and_diff():
    assert blocks.similarity("", " ") == 1.0
    assert blocks.similarity("a  b", "a b") == 1.0
    assert blocks.changed_chunks(["a", "b", "c"], ["a", "x", "c"]) == [(0, "b", "x")]
    assert blocks.changed_chunks(["a"], ["a"]) == []


@settings(max_examples=400, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from(["ab", "a", "b", "abc abc", " ", "the quick brown fox jumps", "x" * 20, "é"]), max_size=10), st.lists(st.sampled_from(["ab", "b", "abc abc", " ", "the quick brown cat jumps", "x" * 17, "é"]), max_size=10))
def test_matched_equals_difflib(a, b):
    x, y = "".join(a), "".join(b)
    assert blocks.matched(x, y) == sum(m.size for m in difflib.SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks())


def test_judge_reply():
    assert blocks.judge_reply('x {"score": 9, "rationale": "r"}') == (5, "r")
    assert blocks.judge_reply("a 2 b")[0] == 2
    assert blocks.judge_reply('{"a": "}"} none')[0] == 3
    assert blocks.first_json_object('{bad} {"a": {"b": 1}} z') == '{"a": {"b": 1}}'


def test_patterns_compile_in_both():
    for p in (text.LINK, text.LIST_ITEM, text.HEADING):
        re.compile(p)
