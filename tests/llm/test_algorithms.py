"""Sampling, groups, chunks, overlaps, tokens and packing against brute force, with odd inputs."""

import itertools
import random

import pytest
import tiktoken
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from draftloom.llm import chunking, groups, overlap, packing, sampling, tokens
from draftloom.session import scratch

LOOSE = dict(deadline=None, suppress_health_check=list(HealthCheck))


# --- sampling ---------------------------------------------------------------
def test_sample_stays_and_repeats(spark):
    rows = [(i, f"s{i % 7}" if i % 11 else None, i % 3) for i in range(400)] + [(5, "s5", 2), (5, "s5", 2), (None, "s1", 1)]
    df = spark.createDataFrame(rows, "pair_id bigint, source string, b int")
    store = sampling.PermanentSample(spark, scratch(spark, "t"), rate=0.2, least=1)
    before = set()
    for b in range(3):
        store.add(df.filter(F.col("b") <= b).select(F.col("pair_id").alias("id"), F.col("source").alias("stratum")))
        now = {r.id for r in store.sample().collect()}
        assert before <= now
        before = now
    again = {r.id for r in sampling.sample_by_batches(df.repartition(7), "pair_id", F.col("source"), "b", scratch(spark, "t"), rate=0.2).collect()}
    assert again == before and 40 < len(again) < 140 and None not in again
    assert {r.stratum for r in store.sample().collect()} == {f"s{i}" for i in range(7)} | {None}
    assert sampling.sample_by_batches(df.filter("false"), "pair_id", F.col("source"), "b", scratch(spark, "t")).count() == 0
    few = sampling.PermanentSample(spark, scratch(spark, "t"), rate=0.0, least=3)
    few.add(df.select(F.col("pair_id").alias("id"), F.col("source").alias("stratum")))
    assert min(r["count"] for r in few.sample().groupBy("stratum").count().collect()) >= 3
    with pytest.raises(ValueError):
        sampling.PermanentSample(spark, "x", rate=2)


@pytest.mark.parametrize("least", [0, 1, 3])
def test_sample_store_is_durable(spark, least):
    """Closed, opened again and added to, a store keeps every value, stratum and selected id."""
    at = scratch(spark, "t")
    rows = lambda a, b: spark.createDataFrame([(i, f"s{i % 9}" if i % 13 else None) for i in range(a, b)], "id bigint, stratum string")
    first = sampling.PermanentSample(spark, at, rate=0.1, least=least)
    first.add(rows(0, 150))
    one = {r.id: (r.u, r.stratum) for r in first.sample().collect()}
    again = sampling.PermanentSample(spark, at, rate=0.1, least=least)
    assert again.values().count() == 150 and {r.id for r in again.sample().collect()} == set(one)
    spark.createDataFrame([(1, "lost", 0.5, 1)], sampling.VALUES).write.parquet(f"{at}/values/1")  # an insert that was never committed
    again = sampling.PermanentSample(spark, at, rate=0.1, least=least)
    again.add(rows(100, 400).withColumn("stratum", F.concat(F.lit("moved"), F.coalesce("stratum", F.lit("")))))
    two = {r.id: (r.u, r.stratum) for r in sampling.PermanentSample(spark, at, rate=0.1, least=least).sample().collect()}
    assert one.items() <= two.items() and len(two) > len(one)
    with pytest.raises(ValueError):
        sampling.PermanentSample(spark, at, rate=0.2, least=least)
    if least:
        sizes = {r.stratum: r["count"] for r in sampling.PermanentSample(spark, at, rate=0.1, least=least).sample().groupBy("stratum").count().collect()}
        assert len(sizes) == 20 and min(sizes.values()) >= least


def test_sample_in_one_insert_equals_one_by_one(spark):
    rows = [(i % 300, f"s{i % 7}", i % 4) for i in range(500)]
    df = spark.createDataFrame(rows, "pair_id bigint, source string, b int")
    slow = sampling.PermanentSample(spark, scratch(spark, "t"), rate=0.05, least=2)
    for b in range(4):
        slow.add(df.filter(F.col("b") == b).select(F.col("pair_id").alias("id"), F.col("source").alias("stratum")))
    at = scratch(spark, "t")
    fast = {tuple(r) for r in sampling.sample_by_batches(df, "pair_id", F.col("source"), "b", at, rate=0.05, least=2).collect()}
    assert fast == {tuple(r) for r in slow.sample().collect()}
    kept = sampling.sample_by_batches(df.filter("pair_id < 200"), "pair_id", F.col("source"), "b", at, rate=0.05, least=2)
    assert {tuple(r) for r in kept.collect()} == {r for r in fast if r[0] < 200}


# --- groups -----------------------------------------------------------------
def test_keys(spark):
    labels = ["post/a.qmd", "./post//a.qmd", "Post\\A.QMD ", "post/x/../a.qmd", "/post/./a.qmd", "\xa0post/a.qmd"]
    df = spark.createDataFrame([(x,) for x in labels] + [("other/a.qmd",), (None,), ("",)], "s string")
    got = [r[0] for r in df.select(groups.post_key(F.col("s"))).collect()]
    assert got[:6] == ["post/a.qmd"] * 6 and got[6:] == ["other/a.qmd", None, ""]
    names = spark.createDataFrame([("Ann  Lee",), ("LEE, ann",), (" ann lee ",), ("unknown",), ("",), (None,), ("N/A",)], "s string")
    assert [r[0] for r in names.select(groups.author_key(F.col("s"))).collect()] == ["ann lee"] * 3 + [None] * 4
    series = spark.createDataFrame([("A-b_c",), ("a B C ",), ("-",), ("none",)], "s string")
    assert [r[0] for r in series.select(groups.series_key(F.col("s"))).collect()] == ["a-b-c", "a-b-c", None, None]


def test_components_against_union_find(spark):
    r = random.Random(3)
    for n, m in ((30, 25), (40, 60)):
        edges = [(f"n{r.randrange(n)}", f"n{r.randrange(n)}") for _ in range(m)] + [(None, "x"), ("chain0", "chain0")] + [(f"chain{i}", f"chain{i + 1}") for i in range(20)]
        parent = {}

        def find(x):
            parent.setdefault(x, x)
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            if a and b:
                parent[find(a)] = find(b)
        want = {}
        for x in list(parent):
            want.setdefault(find(x), []).append(x)
        got = {}
        for row in groups.components(spark.createDataFrame(edges, "a string, b string")).collect():
            got.setdefault(row.component, []).append(row.node)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
        assert all(k == min(v) for k, v in got.items())
    assert groups.components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_source_groups_and_splits(spark):
    posts = spark.createDataFrame([("post/a.qmd", "Ann Lee", None, 1), ("post/b.qmd", "lee, ANN", "s-1", 2), ("post/c.qmd", "unknown", "S 1", 3), ("post/d.qmd", "unknown", "-", 4), (None, "x", "y", 5)], "source string, author string, series string, component int")
    pairs = spark.createDataFrame([(1, "post/a.qmd"), (1, "post/a.qmd"), (2, "./post/a.qmd"), (3, "post/c.qmd"), (4, "post/d.qmd"), (5, None), (6, "nowhere.qmd")], "pair_id bigint, source string")
    found = sorted(tuple(r) for r in groups.related_sources(pairs, posts).collect())
    assert found == [("./post/a.qmd", "./post/a.qmd"), ("post/a.qmd", "./post/a.qmd"), ("post/c.qmd", "./post/a.qmd")]
    s = {r.pair_id: r.split for r in groups.grouped_split(pairs, posts).collect()}
    assert set(s) == {1, 2, 3, 4, 5, 6} and s[1] == s[2] == s[3]
    keys = spark.range(20000).select(groups.rendezvous(F.col("id").cast("string"), {"a": 0.7, "b": 0.3}).alias("s"), groups.rendezvous(F.col("id").cast("string"), {"a": 0.7, "b": 0.4}).alias("t"))
    n = keys.filter("s = 'a'").count() / 20000
    assert abs(n - 0.7) < 0.02 and keys.filter("s = 'b' and t = 'a'").count() == 0


# --- chunks -----------------------------------------------------------------
@settings(max_examples=120, **LOOSE)
@given(st.lists(st.sampled_from(["word ", "Sentence. ", "\n\n", "## head\n", "é̂", "👩‍👩‍👧", "x" * 37, "\r\n", "。", " "]), max_size=60), st.integers(12, 60), st.integers(0, 11))
def test_pieces(parts, limit, overlap_):
    text = "".join(parts)
    got = chunking.pieces(text, limit, overlap_)
    assert got[0][0] == 0 and got[-1][1] == len(text)
    assert all(0 < e - s <= limit for s, e in got) or text == ""
    assert all(b[0] == max(a[1] - overlap_, 0) and b[1] > a[1] for a, b in zip(got, got[1:]))


def test_long_runs_of_marks_end():
    text = "a" + "\u0302" * 200 + "b" * 30
    got = chunking.pieces(text, 20, 5)
    assert got[-1][1] == len(text) and all(e - s <= 20 for s, e in got)


def test_natural_cuts():
    text = ("One two three. " * 20 + "\n\n") * 4
    for s, e in chunking.pieces(text, 400, 20)[:-1]:
        assert text[:e].endswith("\n\n") or text[:e].endswith(" ")
    assert chunking.pieces("ab" * 10, 6, 2)[:2] == [(0, 4), (2, 8)]
    with pytest.raises(ValueError):
        chunking.pieces("x", 5, 5)


def test_rechunk(spark):
    long = "Sentence number. " * 1000
    rows = [(1, "s", 0, 9, "short", "x"), (2, "s", 1, None, long, "x"), (2, "s", 1, None, long, "x"), (3, "s", 2, 3, "end", "x"), (4, None, None, None, None, "x"), (5, "t", 0, 1, "", "x")]
    df = spark.createDataFrame(rows, "target_id bigint, source string, chunk_index int, chunk_total int, text string, piece string")
    out = chunking.rechunk_targets(df, 8000, 200).orderBy("source", "chunk_index").collect()
    s = [r for r in out if r.source == "s"]
    assert [r.target_id for r in s] == [1, 2, 2, 2, 3] and [r.chunk_index for r in s] == [0, 1, 2, 3, 4] and {r.chunk_total for r in s} == {5}
    parts = [r for r in s if r.target_id == 2]
    assert parts[0].text + "".join(p.text[200:] for p in parts[1:]) == long
    assert [(r.target_id, r.text) for r in out if r.source is None] == [(4, None)]
    assert chunking.split_oversized(df.filter("false"), "target_id", "text").count() == 0


def test_rechunk_of_one_hot_source(spark):
    """All rows in one group without an order: numbered by id, over several ranges."""
    df = spark.range(2000).select(F.col("id").alias("target_id"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("int").alias("chunk_index"), F.lit("x").alias("text"))
    out = chunking.rechunk_targets(df)
    assert [(r.target_id, r.chunk_index, r.chunk_total) for r in out.orderBy("target_id").collect()] == [(i, i, 2000) for i in range(2000)]


# --- overlaps ---------------------------------------------------------------
def brute_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@settings(max_examples=80, **LOOSE)
@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=12))
def test_common_subsequence(a, b):
    assert overlap.common_subsequence(a, b) == brute_lcs(a, b)


def test_overlaps_against_all_pairs(spark):
    r = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    base = [[r.choice(vocab) for _ in range(r.choice([20, 40, 60, 90]))] for _ in range(25)]
    rows = []
    for i in range(160):
        t = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 3])):
            t[r.randrange(len(t))] = r.choice(vocab)
        u = [r.choice(vocab) for _ in range(30)]
        rows.append((i, [("system", "s"), ("user", " ".join(u)), ("assistant", "## H\n\n" + " ".join(t).upper() + "!")], "## H", r.choice(["train", "train", "val", "eval", None]), "src", 1))
    rows += [rows[0], (900, None, None, "val", None, 2), (901, [("user", None)], None, "train", None, 3)]
    df = spark.createDataFrame(rows, "pair_id bigint, messages array<struct<role:string,content:string>>, context string, split string, source string, key int")
    got = {tuple(x) for x in overlap.overlapping_ids(df).collect()}
    want = set()
    bodies = {x[0]: (x[3], overlap.words_of(x[1][2][1], x[2])) for x in rows[:160] if x[3]}
    for (i, (s, a)), (j, (t, b)) in itertools.combinations(bodies.items(), 2):
        if (s == "train") != (t == "train") and min(len(a), len(b)) >= 25 and overlap.common_subsequence(a, b) >= 0.75 * max(len(a), len(b)):
            want.add((min(i, j), max(i, j)))
    assert got <= want and len(want) > 50 and len(got) >= 0.98 * len(want), (len(got), len(want))
    counts = overlap.overlap_counts(df).collect()
    assert {c.split for c in counts} <= {"val", "eval"} and sum(c.links for c in counts) == len(got)
    classes = {(r.pair_id, r.role): r.links for r in overlap.overlap_classes(df).collect()}
    assert sum(n for (_, role), n in classes.items() if role == "assistant") == 2 * len(got)
    assert overlap.overlapping_ids(df.filter("false")).count() == 0


def test_overlaps_of_a_text_in_both_roles(spark, monkeypatch):
    monkeypatch.setattr(overlap, "spread", lambda rows: rows)  # all in one batch
    r = random.Random(2)
    a, b = (" ".join(r.choice("abcdefghijklmnop") * 3 for _ in range(40)) for _ in range(2))
    rows = [(1, [("user", a), ("assistant", "few words")], None, "train"), (2, [("user", b), ("assistant", a)], None, "train"), (3, [("user", "few words"), ("assistant", a)], None, "val")]
    df = spark.createDataFrame(rows, "pair_id bigint, messages array<struct<role:string,content:string>>, context string, split string").coalesce(1)
    assert {tuple(x) for x in overlap.overlapping_ids(df).collect()} == {(2, 3)}


def test_counts_without_expanding_copies(spark):
    """Copies in both roles: counts of classes equal those of the expanded pairs."""
    r = random.Random(4)
    texts = [" ".join(r.choice("abcdefghijklmnop") * 3 for _ in range(40)) for _ in range(4)]
    rows = [(i, [("user", r.choice(texts)), ("assistant", r.choice([*texts, "few words"]))], None, r.choice(["train", "train", "val", "eval"]), r.choice(["s", "t", None])) for i in range(120)]
    df = spark.createDataFrame(rows, "pair_id bigint, messages array<struct<role:string,content:string>>, context string, split string, source string")
    pairs = overlap.overlaps(df).select("train_id", "eval_id").distinct().join(df.select(F.col("pair_id").alias("eval_id"), "split", "source"), "eval_id")
    want = {tuple(x) for x in pairs.groupBy("split", "source").agg(F.count(F.lit(1)), F.countDistinct("eval_id")).collect()}
    assert {tuple(x) for x in overlap.overlap_counts(df).collect()} == want and len(want) == 6


def test_overlaps_with_a_quarter_of_the_words_edited(spark):
    r = random.Random(11)
    vocab = [f"w{i}" for i in range(3000)]
    rows, percent = [], {}
    for i in range(1200):
        t = [r.choice(vocab) for _ in range(r.choice([32, 60, 100, 160, 240]))]
        u, rate = list(t), (15, 20, 25)[i % 3]
        for k in r.sample(range(len(t)), len(t) * rate // 100):
            u[k] = r.choice(vocab)
        percent[i] = rate
        for j, (words, split) in enumerate(((t, "train"), (u, "val"))):
            rows.append((i + 10_000 * j, [("user", "few words"), ("assistant", " ".join(words))], None, split))
    df = spark.createDataFrame(rows, "pair_id bigint, messages array<struct<role:string,content:string>>, context string, split string")
    got = {a for a, b in overlap.overlapping_ids(df).collect() if b == a + 10_000}
    recall = {p: sum(i in got for i in percent if percent[i] == p) / 400 for p in (15, 20, 25)}
    print(recall)
    assert min(recall.values()) >= 0.95, recall


# --- tokens -----------------------------------------------------------------
TEXTS = ["Hello world", "", None, "naïve café — “x”", " \n\n  a\t b ", "<|endoftext|> it's 12345", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 6, "日本語のテキスト、です。", "👩‍👩‍👧 ẞ \xa0x\x85y\x1cz", "we'll I'VE  don't", "Zxqv" * 9]


@pytest.mark.parametrize("hot,block", [(49152, 2048), (4, 3)])
def test_encode_decode(spark, hot, block):
    tk = pytest.importorskip("tiktoken")
    import public_tokenizers as pt

    enc = tk.Encoding("t", pat_str=pt.PATTERN, mergeable_ranks=tokens.load_ranks(pt.path("byte_bpe_50k.tiktoken")), special_tokens={})
    rows = list(enumerate(TEXTS)) + [(0, TEXTS[0]), (None, "x")]
    df = spark.createDataFrame([(i, t, "clash", "c") for i, t in rows], "doc_id int, text string, ids string, w string")
    got = tokens.encode(df, "doc_id", "text", pt.path("byte_bpe_50k.tiktoken"), hot, block)
    back = {r.doc_id: (list(r.ids), r.decoded) for r in tokens.decode(got, "ids", pt.path("byte_bpe_50k.tiktoken")).collect()}
    for i, t in enumerate(TEXTS):
        assert back[i][0] == enc.encode_ordinary(t or ""), t
        assert back[i][1] == (t or "")
    assert len(back) == len(TEXTS) + 1
    assert tokens.encode(df.filter("false"), "doc_id", "text", pt.path("byte_bpe_50k.tiktoken")).count() == 0


# --- packing ----------------------------------------------------------------
def optimum(items, cap):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for room in {b for b in bins if b + items[i] <= cap}:
            k = bins.index(room)
            bins[k] += items[i]
            go(i + 1, bins)
            bins[k] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


@settings(max_examples=200, **LOOSE)
@given(st.lists(st.integers(1, 24), max_size=8), st.just(24))
def test_reduction_keeps_the_optimum(items, cap):
    counts = {x: items.count(x) for x in items}
    fixed, rest = packing.reduce(dict(counts), cap)
    left = [s for s, n in rest.items() for _ in range(n)]
    assert sum(n for n, _ in fixed) + optimum(left, cap) == optimum(items, cap)
    rows, n = packing.plan(counts, cap)
    load, seen = [0] * n, {}
    for s, a, b, base, k in rows:
        for r in range(a, b):
            load[base + (r - a) // k] += s
            seen[s] = seen.get(s, 0) + 1
    assert seen == counts and max(load, default=0) <= cap and all(load)


def test_pack_documents(spark):
    pytest.importorskip("tiktoken")
    texts = ["word " * n for n in (10, 50, 3, 700, 40, 40, 40)] + [None, "", "word"]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(0, texts[0], 1), (None, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id int, text string, size int")
    out = packing.pack_documents(df, capacity=100).collect()
    assert {r.doc_id for r in out} == set(range(10)) and len(out) == len({(r.doc_id, r.piece) for r in out})
    load = {}
    for r in out:
        load[r.container] = load.get(r.container, 0) + r.tokens
    assert max(load.values()) <= 100 and len(load) <= 11
    assert sorted(r.piece for r in out if r.doc_id == 3) == list(range(8)) and all(r.piece == 0 for r in out if r.doc_id != 3)
    assert packing.pack_documents(df.filter("false")).count() == 0


RANKS = tokens.load_ranks()
PIECES = {v: k for k, v in RANKS.items()}
REFERENCE = tiktoken.Encoding("plain", pat_str=r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+", mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=300, **LOOSE)
@given(st.lists(st.sampled_from(["a", "b", "c", "th", "e", "in", "g", "é", "数"]), min_size=1, max_size=40))
def test_heap_merge_equals_the_tokenizer(parts):
    word = "".join(parts)
    assert tokens.merge_long(word.encode(), RANKS) == REFERENCE.encode_ordinary(word)


def test_long_words(spark):
    """Words far above the bound of the fold are coded exactly, and in time that does not grow with their square."""
    r = random.Random(5)
    texts = ["x" * 200_000, "".join(r.choices("acgt", k=60_000)) + " and more", "数" * 5000 + "。" + "と" * 5000, "a" * (tokens.LONG + 1), "b" * tokens.LONG, " " * 10_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {x[0]: x[1] for x in tokens.encode(df, "doc_id", "text").collect()}
    assert all(got[k] == REFERENCE.encode_ordinary(t) for k, t in enumerate(texts) if k)
    assert b"".join(PIECES[i] for i in got[0]) == texts[0].encode()


def test_plan_leaves_the_literals_out(spark):
    """Plans are described at every step and kept by the driver: their text has no tables of the tokenizer or of the words."""
    texts = [f"word{i} Wörter, 数{i} and <|endoftext|>" for i in range(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    words = docs.select(F.explode(F.split("text", " ")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    coded, ids = tokens.code_words(words, RANKS), tokens.encode(docs, "doc_id", "text")
    back = tokens.decode(ids, "ids")
    for df in (coded, ids, back):
        assert len(df._jdf.queryExecution().toString()) < 60_000
    assert all(list(r.ids) == REFERENCE.encode_ordinary(r.w) for r in coded.collect())
    assert {r.doc_id: (list(r.ids), r.decoded) for r in back.collect()} == {k: (REFERENCE.encode_ordinary(t), t) for k, t in enumerate(texts)}


@pytest.mark.parametrize("items", [30_000, 3_000_000])
def test_plan_does_not_grow_with_the_items(items):
    """Rows of the plan and the time it takes depend on the capacity; nearly no space is left unused."""
    import time

    r = random.Random(1)
    counts = {}
    for _ in range(4000):
        s = min(4096, max(1, int(r.lognormvariate(5.5, 1.1))))
        counts[s] = counts.get(s, 0) + items // 4000
    start = time.time()
    rows, containers = packing.plan(counts, 4096)
    total = sum(s * n for s, n in counts.items())
    assert time.time() - start < 60 and len(rows) < 3 * 4096 and containers <= total / 4096 * 1.01 + 1
    assert {s: sum(b - a for x, a, b, *_ in rows if x == s) for s in counts} == counts


def test_recall_of_overlaps_by_length_and_edits(spark):
    """Random substitutions of up to a quarter of the words: recall in every cell of length and rate."""
    r = random.Random(23)
    vocab = [f"w{i}" for i in range(5000)]
    rows, cell, n = [], {}, 150
    for words in (28, 100, 1000):
        for rate in (10, 15, 20, 25):
            for _ in range(n):
                i = len(cell)
                t = [r.choice(vocab) for _ in range(words)]
                u = list(t)
                for k in r.sample(range(words), words * rate // 100):
                    u[k] = r.choice(vocab)
                cell[i] = (words, rate)
                rows += [(i, [("user", "few words"), ("assistant", " ".join(t))], None, "train"), (i + 100_000, [("user", "few words"), ("assistant", " ".join(u))], None, "val")]
    df = spark.createDataFrame(rows, "pair_id bigint, messages array<struct<role:string,content:string>>, context string, split string")
    found = [cell[a] for a, b in overlap.overlapping_ids(df).collect() if b == a + 100_000]
    recall = {c: found.count(c) / n for c in sorted(set(cell.values()))}
    print(recall)
    assert min(recall.values()) >= 0.9, recall


def test_pieces_rejoin(spark):
    long = ["Sentence number é. " * 1000, "x" * 20_001, ("# H\n\npara graph\n\n" * 900)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(long)] + [(1, long[1]), (9, None), (8, "short")], "target_id bigint, text string")
    assert {r.target_id: r.text for r in chunking.rejoined(chunking.split_oversized(df, "target_id", "text"), "target_id").collect()} == dict(enumerate(long))
    assert chunking.rejoined(chunking.split_oversized(df.filter("false"), "target_id", "text"), "target_id").count() == 0
