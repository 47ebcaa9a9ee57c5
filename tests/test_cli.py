import json

import numpy as np
import pytest

from draftloom import cli


def hash_embed(texts):
    return np.array([[len(t) % 7, t.count("draft"), 1.0] for t in texts], dtype=float)


def signals():
    return {"detector": lambda t: {"score": len(t) / 1000}, "judge": lambda t: {"score": 3, "rationale": "r"}}


def shorten():
    return (lambda t, n: [t.replace("  ", " ")]), (lambda t: float(len(t)))


def length(c):
    from pyspark.sql import functions as F

    return F.length(c)


@pytest.fixture()
def pairs(tmp_path):
    (tmp_path / "pairs").mkdir()
    rows = []
    for i in range(24):
        meta = {"source": f"p{i % 6}", "captured_at": f"2024-01-{i % 9 + 1:02d}", "capture_id": f"c{i}", "chunk_index": 0, "chunk_total": 1, "synthetic": i % 2 == 0}
        rows.append(json.dumps({"messages": [{"role": "system", "content": "S"}, {"role": "user", "content": f"draft text {i}"}, {"role": "assistant", "content": f"own text {i}"}], "meta": meta}))
    (tmp_path / "pairs" / "a.jsonl").write_text("\n".join([*rows, "broken line"]))
    return tmp_path


def run(*args):
    cli.main([str(a) for a in args])


def test_splits_train_eval(spark, pairs, capsys):
    p = pairs / "pairs"
    run("make-splits", "--pairs", p, "--out", pairs / "splits.json")
    with pytest.raises(SystemExit):
        run("make-splits", "--pairs", p, "--out", pairs / "splits.json")
    run("train", "--pairs", p, "--out", pairs / "run", "--system", "S", "--dry-run", "--cap", 2)
    assert json.loads((pairs / "run.manifest.json").read_text())["counts"]["train"]["pairs"] > 0
    for _ in range(2):
        run("eval", "--pairs", p, "--scores", pairs / "scores", "--hook", "tests.test_cli:signals")
    out = capsys.readouterr().out
    assert '"scored": 24' in out and '"scored": 0' in out
    run("export-table", "--scores", pairs / "scores", "--out", pairs / "table")
    assert json.loads((pairs / "table.meta.json").read_text())["rows"] == 24


def test_log_and_run(spark, pairs, capsys):
    p = pairs / "pairs"
    (pairs / "a.txt").write_text("one\n\ntwo")
    (pairs / "b.txt").write_text("one\n\nthree")
    run("log", "pair", "--pairs", p, "--source", "new", "--before", pairs / "a.txt", "--after", pairs / "b.txt", "--system", "S")
    assert cli.flat_pairs(spark, str(p)).filter("source = 'new'").count() == 1
    run("log", "tidy", "--pairs", p)
    left = cli.flat_pairs(spark, str(p))
    assert left.count() < 25 and spark.read.text(str(p)).filter("value = 'broken line'").count() == 1
    run("log", "drop", "--pairs", p, "--source", "new")
    assert "1 removed" in capsys.readouterr().out
    run("log", "list", "--pairs", p)
    run("run", "--docs", pairs / "a.txt", "--out", pairs / "out", "--hook", "tests.test_cli:shorten")
    assert spark.read.json(str(pairs / "out")).first().text == "one\n\ntwo"
    (pairs / "req").mkdir()
    (pairs / "req" / "1.txt").write_text('{"id":"1","texts":["abc"]}\n')
    run("serve", "--requests", pairs / "req", "--out", pairs / "ans", "--checkpoint", pairs / "cp", "--hook", "tests.test_cli:length")
    assert spark.read.text(str(pairs / "ans")).first().value == '{"id":"1","scores":[3]}'


def test_targets_and_synth(spark, pairs):
    (pairs / "blog").mkdir()
    (pairs / "blog" / "a.qmd").write_text("---\nautomation: 0\n---\n" + "word " * 30 + "\n\n" + "text " * 30)
    (pairs / "blog" / "b.qmd").write_text("---\nautomation: 2\n---\n" + "word " * 30)
    run("targets", "--root", pairs / "blog", "--out", pairs / "targets", "--human-only", "--report", pairs / "r.html")
    assert spark.read.json(str(pairs / "targets")).count() == 2 and "<table>" in (pairs / "r.html").read_text()
    run("synth", "--targets", pairs / "targets", "--pairs", pairs / "pairs", "--out", pairs / "cells", "--model", "m", "n", "--strategy", "s", "--effort", "off", "--per-generator")
    assert spark.read.json(str(pairs / "cells")).count() == 4
