"""Capture sessions in a store, training modes, signals that may be missing, generation sessions."""

import json
import os
import stat

import numpy as np
import pytest
from pyspark.sql import functions as F

from draftloom import cli
from draftloom.operators import captures, model, scores as S, sessions, splits
from draftloom.sources import jsonl


def test_sessions_are_sticky_and_replace_their_own_pairs(spark, tmp_path):
    store, pairs = f"{tmp_path}/sessions", f"{tmp_path}/pairs"
    (tmp_path / "pairs").mkdir()
    (tmp_path / "pairs" / "old.jsonl").write_text('broken\n{"messages":[],"meta":{"source":"a.qmd","snapped_at":"2020"}}\n')
    captures.open_session(spark, store, "a.qmd", "## H\n\none\n\ntwo", "2024-01-01")
    with pytest.raises(ValueError, match="is open"):
        captures.open_session(spark, store, "a.qmd", "x")
    with pytest.raises(ValueError, match="as it was"):
        captures.save_session(spark, store, pairs, "a.qmd", "## H\n\none\n\ntwo", "S")
    assert captures.save_session(spark, store, pairs, "a.qmd", "## H\n\n1\n\ntwo", "S", keep_open=True) == 1
    assert captures.save_session(spark, store, pairs, "a.qmd", "## H\n\n1\n\ntwo\n\n## I\n\nthree", "S", keep_open=True, tags=["t"]) == 1
    rows = jsonl.read_jsonl(spark, pairs, jsonl.PAIR).select("messages", "meta.*").collect()
    assert sorted(r.snapped_at for r in rows) == ["2020", "2024-01-01"]  # the interim save was replaced, the earlier session kept
    new = next(r for r in rows if r.snapped_at == "2024-01-01")
    assert new.context == "## H" and new.messages[1].content == "## H\n\none" and new.messages[2].content == "## H\n\n1" and new.tags == ["t"]
    assert captures.save_session(spark, store, pairs, "a.qmd", "all new", "S", "replace", whole=True) == 1
    assert jsonl.read_jsonl(spark, pairs, jsonl.PAIR).count() == 1 and spark.read.text(pairs).filter("value = 'broken'").count() == 1
    assert captures.open_sessions(spark, store).count() == 0 and not captures.drop_session(spark, store, "a.qmd")
    with pytest.raises(ValueError, match="no session"):
        captures.save_session(spark, store, pairs, "a.qmd", "x", "S")


def test_session_commands(spark, tmp_path, capsys):
    run = lambda *x: cli.main([str(v) for v in x])
    (tmp_path / "t.md").write_text("one\n\ntwo")
    run("log", "open", "--pairs", tmp_path / "p", "--sessions", tmp_path / "s", "--source", "t", "--after", tmp_path / "t.md")
    (tmp_path / "t.md").write_text("one\n\nthree")
    run("log", "save", "--pairs", tmp_path / "p", "--sessions", tmp_path / "s", "--source", "t", "--after", tmp_path / "t.md", "--system", "S")
    assert "saved 1 pair(s)" in capsys.readouterr().out and cli.flat_pairs(spark, str(tmp_path / "p")).count() == 1
    with pytest.raises(SystemExit):
        run("log", "save", "--pairs", tmp_path / "p", "--sessions", tmp_path / "s", "--source", "t", "--after", tmp_path / "t.md")


def embed(texts):
    return np.array([[len(t) % 5, t.count("draft"), 1.0] for t in texts], dtype=float)


def test_training_modes(spark, tmp_path):
    run = lambda *x: cli.main([str(v) for v in x])
    (tmp_path / "p").mkdir()
    said = lambda i: [{"role": "system", "content": "S"}, {"role": "user", "content": f"draft text {i}"}, {"role": "assistant", "content": f"own words {i}"}]
    (tmp_path / "p" / "a.jsonl").write_text("\n".join(json.dumps({"messages": said(i), "meta": {"source": f"p{i % 12}", "captured_at": "2024", "capture_id": f"c{i}", "chunk_index": 0, "chunk_total": 1, "synthetic": i % 2 == 0}}) for i in range(48)))
    base = ["train-clf", "--pairs", tmp_path / "p", "--hook", "tests.test_captures_modes:embed", "--c", 1.0]
    run(*base, "--out", tmp_path / "all")
    head, meta = model.load_artifact(spark, str(tmp_path / "all"))
    assert meta["split"]["mode"] == "fit_all" and meta["n_pairs"] == 48 and meta["n_posts"] == 12 and len(head["coef"]) == 3
    run(*base, "--out", tmp_path / "hold", "--holdout-posts", "p1", "p2", "gone")
    _, meta = model.load_artifact(spark, str(tmp_path / "hold"))
    assert meta["split"]["holdout_posts"] == ["p1", "p2"] and meta["n_posts"] == 10 and meta["metrics"][0]["pairwise_accuracy"] == 1.0
    run("make-splits", "--pairs", tmp_path / "p", "--out", tmp_path / "splits.json")
    run(*base, "--out", tmp_path / "roles", "--splits", tmp_path / "splits.json")
    _, meta = model.load_artifact(spark, str(tmp_path / "roles"))
    assert meta["split"]["mode"] == "splits" and meta["n_posts"] < 12 and any(m["metric"] == "styler_holdout" for m in meta["metrics"])
    with pytest.raises(SystemExit):
        run(*base, "--out", tmp_path / "x", "--splits", tmp_path / "splits.json", "--holdout-frac", 0.2)
    rows = model.assemble(cli.flat_pairs(spark, str(tmp_path / "p")))
    assert model.subset(rows, spark.createDataFrame([("p1",), ("p1",)], "post string")).count() == 8
    assert splits.held_out(rows.select("post"), 0.25).count() == 3


def test_linter_that_is_missing_or_fails(tmp_path, monkeypatch):
    assert S.prose_linter("no-such-linter")("text") == {"available": False, "alerts": 0}
    for said, want in (('{"f.md": [{"Severity": "error"}, {"Severity": "warning"}]}', {"available": True, "alerts": 2}), ('{"Code": "E100", "Text": "no config"}', {"available": False, "alerts": 0}), ("oops", {"available": False, "alerts": 0})):
        (tmp_path / "lint").write_text(f"#!/bin/sh\ncat <<'X'\n{said}\nX\n")
        os.chmod(tmp_path / "lint", os.stat(tmp_path / "lint").st_mode | stat.S_IEXEC)
        monkeypatch.setenv("PATH", f"{tmp_path}:{os.environ['PATH']}")
        assert S.prose_linter("lint")("text") == want
    assert S.judge(lambda t: '{"score": 9, "rationale": "r"}')("x") == {"score": 5, "rationale": "r"}


def test_generation_sessions(spark):
    rows = [("a", i, 40, 40, i == 3) for i in range(8)] + [("b", 0, 10_000, 0, False), ("b", 1, 10_000, 0, False), (None, 0, None, None, None)]
    items = spark.createDataFrame(rows, "arm string, item int, ask_chars int, reply_chars int, failed boolean")
    got = {(r.arm, r.item): (r.session, r.turn, r.outcome) for r in sessions.run(items.repartition(3), ["item"], 3, 60).collect()}
    # a: three turns end a session; the failed fourth ends the next at once; what is left goes on afresh
    assert [got["a", i] for i in range(8)] == [(0, 1, "ran"), (0, 2, "ran"), (0, 3, "ran"), (1, 1, "error"), (2, 1, "ran"), (2, 2, "ran"), (2, 3, "ran"), (3, 1, "ran")]
    assert got["b", 0] == (0, 1, "ran") and got["b", 1] == (1, 1, "ran") and got[None, 0] == (0, 1, "ran")
    assert sessions.run(items.filter("false"), ["item"], 3, 60).count() == 0
    one = spark.createDataFrame([(100, 50, 7, 40), (100, 0, None, 40), (100, None, None, 40)], "h int, p int, r int, a int")
    assert [r[0] for r in one.select(sessions.next_prompt(F.col("h"), F.col("p"), F.col("r"), F.col("a"))).collect()] == [67, 35, 35]
    caps = spark.createDataFrame([(None, 1000), (500, 1000), (None, None)], "own int, w int")
    assert [r[0] for r in caps.select(sessions.token_cap(F.col("own"), F.col("w"), 700)).collect()] == [700, 500, 700]


def test_strategies_hooks_and_sorts(spark):
    from draftloom.operators import corpus, strategies, targets as T

    reg = strategies.Strategies()
    reg.load(spark.createDataFrame([("plain", "one", 1), ("plain", "two", 2)], "label string, system string, version int"))
    assert reg.resolve("plain").version == 2 and reg.resolve("own", "text").version == 0 and len(reg.resolve("plain").prompt_id) == 12
    with pytest.raises(ValueError, match="known: plain"):
        reg.resolve("gone")
    assert reg.table(spark).count() == 1
    pairs = spark.createDataFrame([(i, f"s{i % 3}") for i in range(9)], "pair_id int, source string")
    none = F.array().cast("array<string>")
    kept, accounts = corpus.training_corpus(pairs, none, spark.createDataFrame([("s0",)], "post string"), per_target=lambda df: df.filter("pair_id < 6"))
    assert kept.count() == 6 and {r.stage: r.n for r in accounts.collect()} == {"kept": 9, "capped": 3} and kept.filter("part = 'val'").count() == 2
    assert [r.pair_id for r in T.sort_targets(pairs, [F.desc("source"), F.col("pair_id")]).limit(2).collect()] == [2, 5]


def test_scores_report(spark):
    from draftloom.plans import report

    scores = spark.createDataFrame([("1", "slop", 0.9), ("1", "target", 0.4), ("2", "slop", 0.5), ("2", "target", None)], "id string, field string, s double").select("id", "field", F.lit(3).alias("text_chars"), F.struct(F.lit(True).alias("available"), F.lit(1).alias("alerts")).alias("vale"), F.struct(F.lit(2).alias("score"), F.lit("r").alias("rationale")).alias("judge"), F.struct(F.col("s").alias("score")).alias("detector"))
    pairs = spark.createDataFrame([("1", "a <b> text", 0, True, ("m", 0.5, "length"))], "id string, text string, ord int, synthetic boolean, gen struct<model:string,temperature:double,finish_reason:string>")
    page = report.scores_report(scores, pairs)
    assert page.count("<section>") == 2 and "a &lt;b&gt; text" in page and "t=0.5 · length" in page and ">synthetic<" in page and "(text unavailable)" in page and "0.50" in page
    assert "<table>" in report.scores_report(scores.filter("false"), pairs)
    assert report.provenance(False, None) == '<span class="badge real">real</span>'
