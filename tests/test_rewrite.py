"""Chunks by offsets, rewriting, the preference log, pending rewrites and captures."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from draftloom.functions import blocks, text
from draftloom.operators import corpus, pairs as P

BODY = "First paragraph.\nSecond line.\n\n```python\nx = 1\n\ny = 2\n```\n\n\nLast paragraph."


def test_frontmatter_and_glued_headings_are_chunks_of_their_own():
    assert blocks.body_chunks("---\ntitle: a\n---\n\nText here.") == [("frontmatter", "---\ntitle: a\n---\n", ""), ("prose", "\nText here.", "")]
    assert blocks.body_chunks("## H\ntext one two") == [("heading", "## H", "\n"), ("prose", "text one two", "")]
    assert blocks.body_chunks("# A\n## B\n```\ncode\n```") == [("heading", "# A\n## B", "\n"), ("fence", "```\ncode\n```", "")]
    assert blocks.body_chunks("\n\n# A\n\ntext\n") == [("heading", "\n\n# A", "\n\n"), ("prose", "text\n", "")]
    assert blocks.body_chunks("") == [("blank", "", "")] and blocks.body_chunks(" \n ") == [("blank", " \n ", "")]


def test_chunks_keep_fences_whole_and_the_budget():
    kinds = [(k, t) for k, t, _ in blocks.body_chunks(BODY, 10)]
    assert kinds == [("prose", "First paragraph.\nSecond line."), ("fence", "```python\nx = 1\n\ny = 2\n```"), ("prose", "Last paragraph.")]
    assert [t for _, t, _ in blocks.body_chunks("a b\n\nc d\n\ne f", 8)] == ["a b\n\nc d", "e f"]
    assert blocks.body_chunks("~~~\nopen\n\nstill") == [("fence", "~~~\nopen\n\nstill", "")]
    assert [c for *_, c in blocks.chunks_with_context("a\n\n# H\n\nb\n\n## I\nc")] == [None, "# H", "# H", "## I", "## I"]


@settings(max_examples=400, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from(["a", "```", "````", "~~~", "---", "# h", "## ", "#x", "", " ", "\t", "b c", "\xa0"]), max_size=14), st.integers(1, 30))
def test_chunks_round_trip(lines, budget):
    d = "\n".join(lines)
    chunks = blocks.body_chunks(d, budget)
    assert "".join(t + s for _, t, s in chunks) == d
    assert all(not s.strip() for _, _, s in chunks)
    for kind, t, _ in chunks:
        assert kind != "heading" or all(x.startswith("#") for x in t.strip().split("\n"))


def rewritten(spark, t, styler, scorer=None, **kw):
    return corpus.rewrite(spark.createDataFrame([(1, t)], "doc_id int, text string"), styler, scorer, **kw).first()


def test_rewrite_of_posts(spark):
    post = "---\ntitle: Secret\n---\n\n## The Heading\nUnder it.\n\n```py\ncode = 1\n```\n\nAfter the fence.\n"
    got = rewritten(spark, post, lambda t, n: ["\n\n".join([*t.split("\n\n")[:-1], t.split("\n\n")[-1].upper()])], max_chars=10)
    assert got.text == post.replace("Under it.", "UNDER IT.").replace("After the fence.", "AFTER THE FENCE.")
    assert got.n_chunks == 2 and got.n_kept_input == 0 and got.decisions == ["chunk 1: sample 1/1", "chunk 2: sample 1/1"]
    same = rewritten(spark, post, lambda t, n: [t] * n, max_chars=10)
    assert same.text == post and same.n_candidates == 8
    assert rewritten(spark, "keep me", lambda t, n: ["   "]).text == "keep me"


def test_best_of_and_do_no_harm(spark):
    score = lambda t: 0.1 if "good" in t else 0.9
    best = rewritten(spark, "bad input", lambda t, n: ["bad version", "good version"], score, n=2)
    assert best.text == "good version" and best.n_candidates == 2 and "sample 2/2" in best.decisions[0]
    kept = rewritten(spark, "good input", lambda t, n: ["bad A", "bad B"], score, n=2)
    assert kept.text == "good input" and kept.n_kept_input == 1 and "kept input" in kept.decisions[0]


def test_guard_and_preference_log(spark):
    chunk = "See [the notes](./n.qmd#s) for more."
    cands = ["Lost the link.", "See [the notes](./n.qmd#s); tighter."]
    docs = spark.createDataFrame([(1, f"Intro.\n\n## H\n\n{chunk}")], "doc_id int, text string")
    score = lambda t: 0.3 if "tighter" in t else 0.1 if "Lost" in t else 0.5
    rows = corpus.rewrite_decisions(docs, lambda t, n: cands if "notes" in t else [], score, 2, max_chars=10).orderBy("pos").collect()
    assert [(r.context, r.chosen, r.kept_input) for r in rows] == [(None, None, True), ("## H", 1, False)]
    assert rows[1].candidates == cands and rows[1].scores == [None, 0.3] and rows[0].candidates == []
    lost = rewritten(spark, "Read [this](https://example.org/x).", lambda t, n: ["Read this."])
    assert lost.n_anchor_rejected == 1 and "lost anchors" in lost.decisions[0] and "example.org" in lost.decisions[0]


@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from(["[a](b)", "https://x.org/y", "@key2020", "@key2020,", "(https://x.org)", "word"]), max_size=6), st.lists(st.sampled_from(["[a](b)", "https://x.org/y", "@key2020", "word"]), max_size=6))
def test_lost_anchors_equals_the_column(spark, a, b):
    x, y = " ".join(a), " ".join(b)
    df = spark.createDataFrame([(x, y)], "x string, y string")
    assert df.select(text.missing_anchors(F.col("x"), F.col("y"))).first()[0] == blocks.lost_anchors(x, y)


def test_rewrite_pending(spark):
    kind = "id string, messages array<struct<role:string,content:string>>, context string, synthetic boolean"
    rows = [(f"r{i}", [("system", "s"), ("user", f"ctx\n\nslop {i}"), ("assistant", "x")], "ctx", i % 2 == 0) for i in range(6)]
    pairs, done = spark.createDataFrame([*rows, rows[0]], kind), spark.createDataFrame([("r0",)], "id string")
    out = corpus.rewrite_pending(pairs, done, lambda t, n: ["", t.upper()][:2], limit=2).orderBy("id").collect()
    assert [(r.id, r.output) for r in out] == [("r1", "CTX\n\nSLOP 1"), ("r2", "CTX\n\nSLOP 2")]
    worse = corpus.rewrite_pending(pairs, done, lambda t, n: [t + " longer", t + "!"], lambda t: len(t), 2, selector=F.col("synthetic"))
    assert {r.id: r.body for r in worse.select("id", P.FIELDS["output"](F.col("messages"), F.col("context")).alias("body")).collect()} == {"r2": "slop 2!", "r4": "slop 4!"}
    assert corpus.rewrite_pending(pairs, done, lambda t, n: [" "]).count() == 0


@pytest.mark.parametrize(
    "before,after,want",
    [("# Old\n\nx\n\ny", "# New\n\nx\n\nz", ["", "# New"]), ("# A\n\np\n\n# B\n\np\n\nq", "# A\n\np\n\n# B\n\np\n\nr", ["# B"]), ("a", "b", [""]), ("## H\nglued\n\na", "## H\nglued\n\nb", ["## H\nglued"])],
)
def test_context_of_a_capture_is_of_the_new_version(spark, before, after, want):
    df = spark.createDataFrame([("s", before, after)], "source string, before string, after string")
    assert [r.context for r in P.diff_captures(df).orderBy("chunk_index").collect()] == want
