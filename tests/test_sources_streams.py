import json

from pyspark.sql import functions as F

from draftloom.sources import jsonl, posts
from draftloom.streaming import streams


def rec(source, user="u"):
    return json.dumps({"messages": [{"role": "system", "content": "S"}, {"role": "user", "content": user}, {"role": "assistant", "content": "a"}], "meta": {"source": source, "extra": 1}})


def test_jsonl_round_trip(spark, tmp_path):
    path = str(tmp_path / "pairs")
    (tmp_path / "pairs").mkdir()
    lines = [rec("a"), "", "not json", "[1]", rec("b"), rec("a")]
    (tmp_path / "pairs" / "x.jsonl").write_text("\n".join(lines))
    assert jsonl.read_jsonl(spark, path, jsonl.PAIR).count() == 3
    assert jsonl.read_jsonl(spark, str(tmp_path / "none"), jsonl.PAIR).count() == 0
    assert jsonl.remove_source(spark, path, "a") == 2
    left = sorted(r.value for r in spark.read.text(path).collect())
    assert left == sorted(["not json", "[1]", rec("b")])
    assert jsonl.remove_source(spark, path, "zzz") == 0
    p = spark.createDataFrame([("1", "x"), ("1", "x"), ("2", "y")], "prompt_id string, system string")
    at = str(tmp_path / "prompts")
    assert jsonl.archive_prompts(p, at) == 2 and jsonl.archive_prompts(p, at) == 0


def test_export(spark, tmp_path):
    side = jsonl.export_table(spark.createDataFrame([(1, "a")], "id int, x string"), str(tmp_path / "t"), "abc", {"k": "v"})
    assert side["rows"] == 1 and jsonl.read_json(spark, str(tmp_path / "t.meta.json"))["constants"] == {"k": "v"}


def test_posts(spark, tmp_path):
    for name in ("a.qmd", "_draft.qmd", "sub/b.qmd", ".hidden/c.qmd", "_site/d.qmd", "renv/e.qmd", "note.md"):
        f = tmp_path / name
        f.parent.mkdir(exist_ok=True)
        f.write_text("---\ntitle: T\n---\nbody")
    got = posts.with_frontmatter(posts.read_posts(spark, str(tmp_path)))
    assert sorted((r.source, r.meta, r.body) for r in got.collect()) == [("a.qmd", '{"title": "T"}', "body"), ("sub/b.qmd", '{"title": "T"}', "body")]


def test_answers_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.txt").write_text('{"id":"1","texts":["ab","c"]}\n\nnope\n{"id":"2","op":"meta"}\n{"id":"3","op":"what"}\n{"id":"4"}\n')
    out = streams.answers(spark.readStream.text(str(src)), lambda t: F.length(t).cast("double"), {"m": "x"})
    q = out.writeStream.format("memory").queryName("answers").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination()
    got = [json.loads(r.value) for r in spark.table("answers").collect()]
    assert {"id": "1", "scores": [2.0, 1.0]} in got and {"id": "2", "meta": {"m": "x"}} in got and {"error": "not a request"} in got
    assert {"id": "3", "error": "unknown op what"} in got and {"id": "4", "error": "texts missing"} in got and len(got) == 5


def test_append_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.json").write_text('{"id":"1"}\n{"id":"1"}\n{"id":"2"}\n')
    for k in range(2):
        s = spark.readStream.schema("id string").json(str(src))
        streams.append_once(s, str(tmp_path / "out"), str(tmp_path / f"cp{k}"), "id").awaitTermination()
        (src / f"{k + 2}.json").write_text('{"id":"2"}\n{"id":"3"}\n')
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1", "2", "3"]


EVENTS = [("a", "open", "1", "x"), ("a", "open", "2", "y"), ("a", "save", "3", "z"), ("a", "save", "4", "w"), ("a", "drop", "5", ""), ("a", "save", "6", "q"), ("b", "save", "1", "q"), ("c", "open", "1", "s"), ("c", "save", "2", "s")]


def test_capture(spark, tmp_path):
    df = spark.createDataFrame(EVENTS, "source string, op string, at string, content string")
    assert [tuple(r) for r in streams.capture_batch(df).collect()] == [("a", "1", "x", "w", "save")]
    df.coalesce(1).write.json(str(tmp_path / "ev"))
    s = streams.capture_sessions(spark.readStream.schema(df.schema).json(str(tmp_path / "ev")))
    q = s.writeStream.format("memory").queryName("caps").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination()
    assert [tuple(r) for r in spark.table("caps").orderBy("after").collect()] == [("a", "1", "x", "w", "save"), ("a", "1", "x", "z", "save")]
