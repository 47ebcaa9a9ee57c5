import hashlib

import pytest
from pyspark.sql import functions as F

from draftloom.functions import keys
from draftloom.operators import corpus, model, pairs as P, scores as S, splits, targets as T

C = F.col


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_keys(spark):
    df = spark.createDataFrame([("g", "s", "off", "p", "## H", "text é😀", "post/a.qmd")], "g string, s string, e string, p string, c string, t string, src string")
    r = df.select(keys.synth_key(C("g"), C("s"), C("e"), C("p"), C("c"), C("t")).alias("k"), keys.synth_key(C("g"), C("s"), C("e"), C("p"), F.lit(None), C("t"), F.lit("2")).alias("k2"), keys.capture_id(C("src"), C("g"), C("s")).alias("ci"), keys.prompt_id(C("t")).alias("pi"), keys.role_unit("0", C("src")).alias("u"), keys.arm_index(3, C("t"), 7).alias("a"), keys.dropout_bucket(C("t")).alias("d")).first()
    z = "\0"
    assert r.k == sha(z.join(["g", "s", "off", "p", "## H", "text é😀"]) + z)[:16]
    assert r.k2 == sha(z.join(["g", "s", "off", "p", "", "text é😀"]) + z + "2" + z)[:16]
    assert r.ci == sha(z.join(["post/a.qmd", "g", "s"]))[:8] and r.pi == sha("text é😀")[:12]
    assert abs(r.u - int(sha("0:post/a.qmd")[:16], 16) / 2**64) < 1e-15
    assert r.a == int(sha("3\0text é😀")[:16], 16) % 7 and r.d == int(sha("text é😀"), 16) % 1000


def test_record_id(spark):
    df = spark.createDataFrame([("k", "c", 1, "s"), ("", "c", None, "s"), (None, None, 2, None)], "k string, c string, i int, s string")
    got = [r[0] for r in df.select(keys.record_id(C("k"), C("c"), C("i"), C("s"))).collect()]
    assert got == ["k", "c:None", sha("None\0" + "2")[:16]]


def test_sections_and_passages(spark):
    body = "intro line\n\n# A\n\n" + "word " * 30 + "\n\n## B\n" + "text " * 30 + "\n\n```\ncode " + "x" * 100 + "\n```\n"
    df = spark.createDataFrame([("s", body), ("n", None), ("e", "")], "source string, body string")
    out = T.passages(df, T.ChunkPolicy(heading_context=True)).orderBy("chunk_index").collect()
    assert [(r.source, r.chunk_index, r.chunk_total, r.context) for r in out] == [("s", 0, 2, "# A"), ("s", 1, 2, "## B")]
    assert out[0].text == ("word " * 30).strip()


def test_summary_histogram(spark):
    t = spark.createDataFrame([("x" * n, f"s{n % 3}") for n in range(1, 11)] + [(None, "s9")], "text string, source string")
    r = T.summary(t).first()
    assert (r.chunks, r.median_chars, r.p90_chars, r.max_chars, r.sum_chars, r.sources) == (10, 5, 10, 10, 55, 4)
    h = {x.bin: x.n for x in T.histogram(t, F.length("text"), 5).collect()}
    assert h == {0: 1, 1: 2, 2: 2, 3: 2, 4: 3}
    empty = t.filter("false")
    assert T.summary(empty).first().chunks is None and sum(x.n for x in T.histogram(empty, F.length("text")).collect()) == 0


def test_splits(spark):
    posts = spark.createDataFrame([(f"p{i}",) for i in range(30)] + [(None,)], "post string")
    a, b = splits.make_splits(posts, seed=4), splits.make_splits(posts, seed=4)
    assert a["eval_posts"] == b["eval_posts"] and len(a["eval_posts"]) == 3
    with pytest.raises(ValueError):
        splits.make_splits(posts, eval_frac=1.5)
    with pytest.raises(ValueError):
        splits.make_splits(posts.filter("false"))
    rows = spark.createDataFrame([(f"p{i}", i % 2 == 0) for i in range(30)] + [(None, None)], "source string, synthetic boolean")
    s = {r.role: r for r in splits.role_summary(splits.with_role(rows, a)).collect()}
    assert set(s) == set(splits.ROLES) and sum(r.pairs for r in s.values()) == 31 and s["eval"].posts == 3
    w = splits.danger_report(splits.role_summary(splits.with_role(rows, a)), posts.limit(1)).collect()
    assert {r.warning for r in w if r.role == "eval"} >= {"few posts", "few pairs", "stale pinned posts"}
    folds = splits.balanced_folds(spark.createDataFrame([(f"p{i}", 10 - i) for i in range(8)], "post string, n int"), 2)
    assert {r.n for r in folds.groupBy("fold").agg(F.count("*").alias("n")).collect()} == {4}


def pair(i, user="u", asst="a", ctx=None, source="s", sim=None, at="2024", synthetic=False):
    return (i, [("system", "S"), ("user", user), ("assistant", asst)], ctx, source, sim, at, "c", 0, 1, synthetic)


SCHEMA = "pair_id int, messages array<struct<role:string,content:string>>, context string, source string, transform_sim double, captured_at string, capture_id string, chunk_index int, chunk_total int, synthetic boolean"


def test_problems(spark):
    rows = [pair(1), pair(2, user=" "), pair(3, ctx="## H", user="## H\n\nu", asst="x"), pair(4, source=None), (5, None, None, "s", None, None, "c", 0, 1, None), (6, [("user", "a")], None, "s", None, "t", "c", 0, 1, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.pair_id: r.p for r in df.select("pair_id", P.problems(df, "S", ["source", "captured_at"]).alias("p")).collect()}
    assert got[1] == [] and got[2] == ["user content is empty"] and got[3] == ["assistant content does not start with its context"] and got[4] == ["meta missing source"]
    assert len(got[5]) == 2 and len(got[6]) == 1


def test_gates_latest_cap(spark):
    rows = [pair(1, sim=0.9), pair(2, sim=None), pair(3, sim=0.85), pair(4, source=None, at=None), pair(5, at="2025"), pair(6, source="t", at=None), pair(7, source="t", at=None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r[0] for r in df.filter(P.near_identity(C("transform_sim"))).select("pair_id").collect()} == {2, 3, 4, 5, 6, 7}
    assert {r.pair_id for r in P.latest_per_source(df).collect()} == {4, 5, 6, 7}
    assert sorted(r.pair_id for r in P.per_target_cap(df, 3, [C("pair_id")]).collect()) == [1, 2, 3]
    g = spark.createDataFrame([(0.99, "a", "aaaaa"), (None, "a", "aaaa"), (0.5, "a", "aaa")], "s double, d string, o string")
    assert [r[0] for r in g.select(P.drop_reason(C("s"), C("d"), C("o"))).collect()] == ["identity", "inflation", None]


def test_resume_and_coverage(spark):
    w = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1), (None, 3), (None, 4)], "key string, n int")
    done = spark.createDataFrame([("b",), (None,)], "key string")
    assert sorted((r.key or "", r.n) for r in P.resume(w, done, "key", [C("n")]).collect()) == [("", 3), ("a", 1)]
    t = spark.createDataFrame([("body ",), ("other",), (None,)], "text string")
    assert sorted(r.text or "" for r in P.uncovered(t, spark.createDataFrame([pair(1, asst="## H\n\nbody", ctx="## H")], SCHEMA)).collect()) == ["", "other"]


def test_diff_captures(spark):
    df = spark.createDataFrame([("s", "# H\n\none\n\ntwo", "# H\n\none\n\n2"), ("same", "a", "a"), ("null", None, "a")], "source string, before string, after string")
    assert [tuple(r) for r in P.diff_captures(df).collect()] == [("s", 0, 1, "# H", "two", "2")]


def test_scores(spark):
    v = spark.createDataFrame([([1.0, 2.0],), ([-1000.0, 0.0],), (None,)], "v array<double>")
    got = [r[0] for r in v.select(S.linear_score(C("v"), [1.0, -0.5], 0.0)).collect()]
    assert got[0] == 0.5 and got[1] == 0.0 and got[2] is None
    with pytest.raises(Exception, match="expected vectors"):
        v.select(S.linear_score(C("v"), [1.0], 0.0)).collect()
    df = spark.createDataFrame([("a", 1, None, "k"), ("b", 2, None, "k")], "id string, x int, y string, z string")
    table, const = S.covariate_table(df, "id", ["x"])
    assert table.columns == ["id", "x"] and const == {"y": "null", "z": "k"}
    scored, errors = S.score_rows(spark.createDataFrame([("1", "ok"), ("2", "bad"), ("2", "bad"), ("3", "ok")], "id string, text string"), spark.createDataFrame([("3",)], "id string"), {"detector": lambda t: {"score": 1 / (t != "bad")}})
    assert [r.id for r in scored.collect()] == ["1"] and [r.id for r in errors.collect()] == ["2"]


def test_auc_against_all_pairs(spark):
    rows = [(i // 2, i % 2, ((i * 37) % 11) / 10.0) for i in range(40)]
    df = spark.createDataFrame(rows, "pair_row int, label int, score double")
    p, q = [s for _, y, s in rows if y], [s for _, y, s in rows if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in p for b in q) / (len(p) * len(q))
    assert abs(model.auc(df).first().auc - want) < 1e-12
    assert model.auc(df.filter("label = 1")).first().auc is None
    got = model.pairwise_accuracy(df).first()[0]
    assert abs(got - sum((rows[2 * k + 1][2] > rows[2 * k][2]) + 0.5 * (rows[2 * k + 1][2] == rows[2 * k][2]) for k in range(20)) / 20) < 1e-12


def test_assemble_fit(spark):
    rows = [pair(i, user=f"draft words {i}", asst=f"mine {i}", source=f"p{i % 5}") for i in range(20)] + [pair(99, user=" "), pair(98, sim=0.99)]
    extra = spark.createDataFrame([("free text", "p9"), (" ", "p9")], "text string, source string")
    ds = model.assemble(spark.createDataFrame(rows, SCHEMA), extra=extra)
    assert ds.count() == 41
    import numpy as np

    e = model.embed(ds, lambda ts: np.array([[len(t), t.count("d"), 1.0] for t in ts], dtype=float))
    head = model.head_of(model.fit(e, 1.0))
    assert model.pairwise_accuracy(model.predict(e, head)).first()[0] == 1.0


def test_rewrite_and_best(spark):
    docs = spark.createDataFrame([("a", "# H\n\nsome  text [x](http://u)\n\n```\nkeep  me\n```\n"), ("b", ""), ("c", None)], "doc_id string, text string")
    out = {r.doc_id: r for r in corpus.rewrite(docs, lambda t, n: [t.replace("  ", " "), "short"], lambda t: float(len(t))).collect()}
    assert out["a"].text == "# H\n\nsome text [x](http://u)\n\n```\nkeep  me\n```\n" and out["a"].n_anchor_rejected == 1
    assert out["b"].text == "" and out["c"].text == ""
    c = spark.createDataFrame([("k", -1, 1.0, "in"), ("k", 0, 1.0, "x"), ("j", -1, 2.0, "in"), ("j", 0, 1.0, "y"), ("j", 1, 1.0, "z")], "k string, idx int, score double, text string")
    assert {r.k: r.text for r in corpus.best_of(c, ["k"]).collect()} == {"k": "in", "j": "y"}


def test_data_hash(spark):
    rows = [(1, ["a", None], None), (2, ["b"], "x"), (2, ["b"], "x"), (3, [], "")]
    of = lambda r, n=1: corpus.data_hash(spark.createDataFrame(r, "i int, t array<string>, s string").repartition(n))
    got = of(rows)
    assert len(got) == 16 and got == of(rows[::-1], 3)
    assert len({got, of(rows[1:]), of(rows[:2] + rows[3:]), of([(1, ["a"], None)] + rows[1:]), of(rows[:3] + [(3, [], None)]), of([])}) == 6


def test_registered_over_the_whole_job(spark, monkeypatch):
    from draftloom.plans import catalogue

    d, seen = "/root/testdata/sf0.001", []
    monkeypatch.setattr(model, "choose_c", lambda rows, folds, grid=model.GRID: seen.append(grid) or 1.0)
    catalogue.classifier(spark, d)
    assert seen == [[0.01, 0.03, 0.1, 0.3, 1.0, 3.0, 10.0]]
    import json

    assert json.loads(catalogue.training_manifest(spark, d).first()[0])["data_sha"] == corpus.data_hash(catalogue._once(spark, d).drop("ingested_at")) != "0" * 16


def test_sessions(spark):
    items = spark.createDataFrame([("a", i, 10) for i in range(7)], "arm string, item int, tokens int")
    got = {int(r.item): (r.session, r.turn) for r in corpus.session_plan(items, 25, 3, ["item"]).collect()}
    assert got == {0: (0, 0), 1: (0, 1), 2: (1, 0), 3: (1, 1), 4: (2, 0), 5: (2, 1), 6: (3, 0)}


def test_sessions_of_a_large_arm_are_in_order(spark):
    n = 9_001
    rows = [("a", i, i * 7 % 11) for i in range(n)] + [("b", i, i % 5) for i in range(30)]
    got = {(r.arm, int(r.item)): (r.session, r.turn) for r in corpus.session_plan(spark.createDataFrame(rows, "arm string, item int, tokens int").repartition(5), 25, 6, ["item"]).collect()}
    want, last, at = {}, None, (0, 0, 0)
    for arm, i, t in rows:
        session, turn, used = at if arm == last else (0, 0, 0)
        if turn and (turn >= 6 or used + t > 25):
            session, turn, used = session + 1, 0, 0
        want[arm, i], last, at = (session, turn), arm, (session, turn + 1, used + t)
    assert got == want


def test_arms(spark):
    a = splits.arms(spark, ["m", "m", "n"], ["s"], ["off", "on"])
    assert [tuple(r) for r in a.orderBy("arm_idx").collect()] == [(0, "s", "off", "m"), (1, "s", "off", "n"), (2, "s", "on", "m"), (3, "s", "on", "n")]


def test_lookup_join(spark):
    from draftloom.operators import joins

    rows = spark.createDataFrame([(i, "hot" if i % 3 else None if i % 2 else f"k{i}") for i in range(60)], "id int, k string")
    dim = spark.createDataFrame([("hot", 1), (None, 2), ("k0", 3), ("unused", 4)], "name string, v int")
    got = {r.id: r.v for r in joins.lookup(rows, dim, F.col("k"), "name").collect()}
    assert len(got) == 60 and got[0] == 3 and got[1] == 1 and got[3] == 2 and got[6] is None
    assert joins.lookup(rows, dim, F.col("k"), "name", "inner").count() == 51
    assert joins.lookup(rows.filter("false"), dim, F.col("k"), "name").columns == ["id", "k", "v"]


def test_spread_runs_nothing_and_scratch_is_deleted(spark, tmp_path):
    import os

    from draftloom import session

    spark.range(100).write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    assert session.spread(t).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    grouped = t.groupBy("id").count()
    assert session.spread(grouped) is grouped
    at = session.scratch(spark, "x")
    t.write.parquet(at)
    session.clean()
    assert not os.path.exists(at)


def test_holdouts_and_folds_are_exact_shares(spark):
    posts = spark.createDataFrame([(f"p{i}",) for i in range(101)] + [("p1",), (None,)], "post string")
    held = {r.post for r in splits.held_out(posts, 0.25, 3).collect()}
    assert len(held) == 25 and held == {r.post for r in splits.held_out(posts.repartition(5), 0.25, 3).collect()}
    assert splits.held_out(posts, 0.0).count() == 0 and splits.held_out(posts.filter("false"), 0.5).count() == 0
    assert {r.post for r in splits.held_out(posts, 0.5, pinned=["p1", "gone"]).collect()} == {"p1"}
    assert splits.held_out(posts.limit(2), 0.01).count() == 1
    folds = splits.shuffle_folds(posts, 3, 0.1)
    assert {r["count"] for r in folds.groupBy("fold").count().collect()} == {10} and folds.distinct().count() == 30


@pytest.mark.parametrize("sizes", [[10 - i for i in range(8)], [1] * 37, [50, 1, 1, 1, 7, 7, 7, 7, 7, 2, 2], [5, 5, 5], [3, 3, 0, 0, 0], [9] + [2] * 40])
def test_balanced_folds_equal_the_greedy_deal(spark, sizes):
    rows = [(f"p{i:03d}", n) for i, n in enumerate(sizes)]
    load, want = [0] * 4, {}
    for post, n in sorted(rows, key=lambda r: (-r[1], r[0])):
        k = min(range(4), key=lambda i: (load[i], i))
        load[k] += n
        want[post] = k
    got = {r.post: r.fold for r in splits.balanced_folds(spark.createDataFrame(rows, "post string, n int")).collect()}
    if 0 in sizes:  # posts of no rows weigh nothing: any fold is as light
        got, want = ({p: k for p, k in x.items() if dict(rows)[p]} for x in (got, want))
    assert got == want


def test_evaluate_holdout_and_artifact(spark, tmp_path):
    rows = [(f"{i}:{y}", i, f"p{i % 6}", y, i % 3 == 0, i == 0 and y == 0, [float(y), 0.1 * (i % 4), 1.0]) for i in range(24) for y in (0, 1)]
    df = spark.createDataFrame(rows, "row_id string, pair_row int, post string, label int, synthetic boolean, is_free boolean, vector array<double>")
    held = splits.held_out(df.select("post"), 0.0, pinned=["p0", "p1"])
    got = {r.stratum: r for r in model.evaluate_holdout(df, held, 1.0).collect()}
    assert set(got) == {"all", "real", "synthetic"} and got["all"].pairwise_accuracy == 1.0 and got["all"].auc == 1.0 and got["all"].pairs == 7
    assert got["real"].positives == 4 and got["synthetic"].positives == 4
    head = model.head_of(model.fit(df, 1.0))
    meta = model.write_artifact(spark, f"{tmp_path}/art", head, df, [])
    assert meta["n_pairs"] == 24 and meta["n_pairs_synthetic"] == 8 and model.load_artifact(spark, f"{tmp_path}/art")[0]["coef"] == head["coef"]
    from draftloom.sources.jsonl import write_json

    for bad in ({"coef": [], "intercept": 0.0}, {"coef": ["x"], "intercept": 0.0}, {"coef": [1.0], "intercept": 0.0}, {"coef": head["coef"], "intercept": None}):
        write_json(spark, f"{tmp_path}/art/head.json", bad)
        with pytest.raises(ValueError):
            model.load_artifact(spark, f"{tmp_path}/art")


def test_ranks_and_running_sums_over_ranges(spark):
    from draftloom.operators import ranks

    rows = [(i, "hot" if i % 4 else None, (i * 7919) % 1000, i % 3) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, g string, o int, v int").repartition(7)
    want, seen = {}, {}
    for i, g, o, v in sorted(rows, key=lambda r: (r[1] or "", r[2], r[0])):
        n, t = seen.get(g, (0, 0))
        want[i], seen[g] = (n, t + v), (n + 1, t + v)
    got = {r.id: (r.k, r._total) for r in ranks.ranked(df, "g", ["o", "id"], "k").collect()}
    assert got == {i: (n, 2250 if i % 4 else 750) for i, (n, _) in want.items()}
    assert {r.id: r.s for r in ranks.running(df, "g", ["o", "id"], "v", "s").collect()} == {i: t for i, (_, t) in want.items()}
    assert ranks.ranked(df.filter("false"), "g", ["o"], "k").count() == 0


def test_all_fits_of_a_choice_share_their_passes(spark, monkeypatch):
    import numpy as np

    from draftloom.plans.catalogue import hashed_words

    words = hashed_words(["B a b", "", "b  a B"], 8)
    assert (words[0] == words[2]).all() and not words[1].any() and np.abs(words[0]).sum() in (1, 3)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        a, b = rng.normal(0.0, 1.0, 5), rng.normal(0.35, 1.3, 5)
        a = b if i % 10 == 0 else a  # a tie under every head
        rows += [(i, f"p{i % 9}", 1, [float(v) for v in b])] * (1 + i % 2) + [(i, f"p{i % 9}", 0, [float(v) for v in a])]
    folds = {f"p{i}": i % 4 for i in range(9)}
    df = spark.createDataFrame(rows, "pair_row int, post string, label int, vector array<double>").repartition(5)

    def optimum(rest, c):
        x, y = np.array([[*r[3], 1.0] for r in rest]), np.array([r[2] for r in rest])
        weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
        w, l2 = np.zeros(6), np.array([1 / c] * 5 + [0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-(x @ w)))
            w = w - np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + np.diag(l2), x.T @ (weight * (p - y)) + l2 * w)
        return w

    means = {}
    for c in model.GRID:
        per = []
        for k in range(4):
            w, won = optimum([r for r in rows if folds[r[1]] != k], c), []
            for i in range(120):
                if folds[f"p{i % 9}"] == k:
                    d, a = (next(r[3] for r in rows if r[0] == i and r[2] == y) for y in (1, 0))
                    won.append(0.5 if d == a else float(np.dot(d, w[:5]) > np.dot(a, w[:5])))
            per.append(np.mean(won))
        means[c] = np.mean(per)
    sc, id_ = spark.sparkContext, "choice"
    sc.setJobGroup(id_, "choice of C")
    got = model.choose_c(df, spark.createDataFrame([*folds.items()], "post string, fold int"))
    jobs = len(sc.statusTracker().getJobIdsForGroup(id_))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert got == max(model.GRID, key=lambda c: (round(means[c], 12), -c))
    assert 0 < jobs < 100  # one fit after another took more than 500 on sf0.01

    for full in (model.FULL, 2):  # with all second moments, and with their diagonal
        monkeypatch.setattr(model, "FULL", full)
        for c in (0.01, 10.0):
            head = model.fit(df, c)
            assert np.allclose([*head.coefficients, head.intercept], optimum(rows, c), atol=1e-4)
    h = model.head_of(head)
    z = spark.createDataFrame([(0, r[3]) for r in rows], "g int, v array<double>").select(S.linear_score(C("v"), h["coef"], h["intercept"]).alias("s"), (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.get(model.margins(C("g"), C("v"), {0: [head]}), 0)))).alias("t"))
    assert z.filter("s <> t or t is null").count() == 0
    with pytest.raises(ValueError, match="both labels"):
        model.fit(df.filter("label = 1"))
