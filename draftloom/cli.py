"""Commands over folders of JSON lines: ``python -m draftloom.cli COMMAND ...``.

Generators, judges, stylers and embedding models are libraries' business; the
commands that need one take a dotted path to a callable (``--hook pkg.mod:name``).
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from draftloom.functions import text
from draftloom.operators import captures, corpus, model, pairs as P, scores as S, splits, targets as T
from draftloom.plans import report
from draftloom.sources import jsonl, posts as posts_source
from draftloom.streaming import streams


def hook(path: str):
    mod, _, name = path.partition(":")
    return getattr(importlib.import_module(mod), name)


def flat_pairs(spark: SparkSession, path: str) -> DataFrame:
    """A pair corpus with its known meta keys as columns and a pair_id."""
    p = jsonl.read_jsonl(spark, path, jsonl.PAIR).select("messages", "meta.*")
    return p.withColumn("pair_id", F.xxhash64("source", "capture_id", "chunk_index", "synth_key", F.to_json("messages")))


def cmd_targets(spark: SparkSession, a: argparse.Namespace) -> None:
    p = posts_source.with_frontmatter(posts_source.read_posts(spark, a.root))
    keep = text.is_human_authored(F.get_json_object("meta", f"$.{a.field}"), a.max_level) if a.human_only else F.lit(True)
    t = T.passages(p.filter(keep), T.ChunkPolicy(min_chars=a.min_chars, max_chars=a.max_chars or None, merge=a.merge, stop_at=a.stop_at, heading_context=a.context))
    jsonl.append_jsonl(T.sort_targets(T.select_targets(t, sample_frac=a.sample), a.sort), a.out)
    if a.report:
        with open(a.report, "w") as f:
            f.write(report.targets_report(t))
    if a.show:
        print(report.sample_text(t, a.show))


def cmd_synth(spark: SparkSession, a: argparse.Namespace) -> None:
    """Cells still to be generated, as JSON lines; with --dry-run their number by model."""
    from draftloom.functions import keys

    t = jsonl.read_jsonl(spark, a.targets, "source string, chunk_index int, chunk_total int, context string, text string")
    arms = splits.arms(spark, a.model, a.strategy, a.effort)
    n = len(set(a.model)) * len(set(a.strategy)) * len(set(a.effort))
    cells = splits.assign_arms(t, arms, n, a.seed, a.per_generator)
    c = F.col
    cells = cells.withColumn("synth_key", keys.synth_key(splits.arm_name(c("model"), a.kind), c("strategy"), c("effort"), F.lit(""), splits.effective_context(c("context"), c("text"), a.dropout), c("text")))
    todo = P.resume(cells, flat_pairs(spark, a.pairs).select("synth_key"), "synth_key", [c("source"), c("chunk_index")])
    if a.dry_run:
        todo.groupBy("model").count().orderBy("model").show(1000, False)
    else:
        jsonl.append_jsonl(todo, a.out)


def cmd_eval(spark: SparkSession, a: argparse.Namespace) -> None:
    p = flat_pairs(spark, a.pairs)
    rows = p.select(F.col("pair_id").cast("string").alias("id"), P.FIELDS[a.score_field](F.col("messages"), F.col("context")).alias("text"))
    done = jsonl.read_jsonl(spark, a.scores, "id string")
    good, bad = S.score_rows(rows, done, hook(a.hook)())
    jsonl.append_jsonl(good.withColumn("field", F.lit(a.score_field)), a.scores)
    print(json.dumps({"scored": good.count(), "errors": bad.count()}))
    every = jsonl.read_jsonl(spark, a.scores, S.SCORE)
    S.aggregate(every, ["field"]).show(100, False)
    if a.report:
        texts = p.select(F.col("pair_id").cast("string").alias("id"), P.FIELDS[a.score_field](F.col("messages"), F.col("context")).alias("text"), F.lit(0).alias("ord"), "synthetic", "gen")
        with open(a.report, "w") as f:
            f.write(report.scores_report(every, texts))


def cmd_export(spark: SparkSession, a: argparse.Namespace) -> None:
    s = jsonl.read_jsonl(spark, a.scores, S.SCORE)
    table, constants = S.covariate_table(s.select(*S.flatten(s.schema)), "id", ["field"])
    sha = jsonl.file_hash(spark, a.scores).agg(F.array_join(F.array_sort(F.collect_list("sha")), "")).first()[0]
    print(json.dumps(jsonl.export_table(table, a.out, sha, constants)))


def cmd_splits(spark: SparkSession, a: argparse.Namespace) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(a.out)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path) and not a.force:
        sys.exit(f"{a.out} exists")
    p = flat_pairs(spark, a.pairs).select(F.col("source").alias("post"), F.coalesce("synthetic", F.lit(False)).alias("synthetic"))
    s = splits.make_splits(p.select("post"), a.eval_frac, a.detector_frac, a.seed, p.filter("not synthetic").select("post"))
    jsonl.write_json(spark, a.out, s)
    summary = splits.role_summary(splits.with_role(p.withColumnRenamed("post", "source"), s))
    summary.show()
    pinned = spark.createDataFrame([(x,) for x in s["eval_posts"]], "post string")
    splits.danger_report(summary, pinned.join(p, "post", "left_anti")).show(100, False)


def cmd_train_clf(spark: SparkSession, a: argparse.Namespace) -> None:
    """The classifier in one of three modes: by splits, with held-out posts, or on everything."""
    if a.splits and (a.holdout_frac or a.holdout_posts):
        sys.exit("--splits goes without --holdout-frac and --holdout-posts")
    p = flat_pairs(spark, a.pairs)
    embedded = lambda rows: model.embed(model.assemble(rows), hook(a.hook)).persist()
    if a.splits:
        contract = jsonl.read_json(spark, a.splits, splits.VERSION)
        p = splits.with_role(p, contract)  # posts for evaluation are not even embedded
        styler = embedded(p.filter("role = 'styler'"))
        meta = model.train_head(embedded(p.filter("role = 'detector'")), a.out, "splits", a.c, unseen=styler, split={"path": a.splits, "seed": contract["seed"], "rest_rule": contract["rest_rule"]})
    else:
        rows = embedded(p)
        held = splits.held_out(rows.select("post"), a.holdout_frac, a.seed, a.holdout_posts) if a.holdout_frac or a.holdout_posts else None
        meta = model.train_head(rows, a.out, "all" if held is None else "holdout", a.c, held, split=None if held is None else {"holdout_frac": a.holdout_frac, "holdout_seed": a.seed})
    print(json.dumps(meta["metrics"]))


def cmd_train(spark: SparkSession, a: argparse.Namespace) -> None:
    """Corpus and manifest of a run; the paid run itself is the hook's."""
    p = flat_pairs(spark, a.pairs)
    role = splits.with_role(p, jsonl.read_json(spark, a.splits, splits.VERSION)) if a.splits else p.withColumn("role", F.lit("styler"))
    posts = role.filter("role = 'styler'").select(F.col("source").alias("post"))
    val = splits.held_out(posts, a.val_frac, a.seed)
    c, accounts = corpus.training_corpus(role, P.problems(role, a.system, ["source", "captured_at", "capture_id", "chunk_index", "chunk_total"]), val, F.col("role"), "styler", cap=a.cap)
    accounts.show()
    sha = jsonl.file_hash(spark, a.pairs).agg(F.substring(F.sha2(F.array_join(F.array_sort(F.collect_list("sha")), ""), 256), 1, 16)).first()[0]
    m = corpus.manifest(c, sha, {"seed": a.seed, "val_frac": a.val_frac}, a.price)
    jsonl.write_json(spark, f"{a.out}.manifest.json", m)
    if not a.dry_run:
        jsonl.export_conversations(c.filter("part = 'train'"), f"{a.out}/train")
        jsonl.export_conversations(c.filter("part = 'val'"), f"{a.out}/val")
        if a.hook:
            jsonl.write_json(spark, f"{a.out}.manifest.json", m | {"result": hook(a.hook)(a.out)})


def cmd_run(spark: SparkSession, a: argparse.Namespace) -> None:
    docs = spark.read.text(a.docs, wholetext=True).select(F.input_file_name().alias("doc_id"), F.col("value").alias("text"))
    corpus.rewrite(docs, *hook(a.hook)(), n=a.samples, guard=not a.no_guard).write.mode("overwrite").json(a.out)


def cmd_serve(spark: SparkSession, a: argparse.Namespace) -> None:
    out = streams.answers(spark.readStream.text(a.requests), hook(a.hook), {"head": a.hook})
    out.writeStream.format("text").option("path", a.out).option("checkpointLocation", a.checkpoint).trigger(availableNow=True).start().awaitTermination()


def cmd_log(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.action == "list":
        P.pairs_by_source(flat_pairs(spark, a.pairs)).orderBy("source").show(1000, False)
        P.corpus_counts(flat_pairs(spark, a.pairs)).show()
    elif a.action == "drop":
        print(jsonl.remove_source(spark, a.pairs, a.source), "removed")
    elif a.action == "tidy":
        raw = jsonl.read_jsonl(spark, a.pairs, jsonl.PAIR, keep_raw=True).select("_line", "_raw", "meta.source", "meta.captured_at")
        kept = P.latest_per_source(raw.filter("_raw is null")).unionByName(raw.filter("_raw is not null"))
        jsonl.rewrite_jsonl(kept.select("_line"), a.pairs)
    elif a.action == "sessions":
        captures.open_sessions(spark, a.sessions).select("source", "snapped_at", F.length("content").alias("chars")).orderBy("snapped_at").show(1000, False)
    elif a.action == "forget":
        print("dropped" if captures.drop_session(spark, a.sessions, a.source) else "nothing open")
    elif a.action in ("open", "save"):
        now = whole_text(spark, a.after)
        try:
            if a.action == "open":
                print("opened", captures.open_session(spark, a.sessions, a.source, now))
            else:
                print("saved", captures.save_session(spark, a.sessions, a.pairs, a.source, now, a.system, a.earlier, a.keep_open, a.whole, not a.no_context, a.tag), "pair(s)")
        except ValueError as e:
            sys.exit(str(e))
    else:  # two given versions: a session that is opened and saved at once
        store = f"{a.pairs.rstrip('/')}.pair-{uuid.uuid4().hex}"
        try:
            captures.open_session(spark, store, a.source, whole_text(spark, a.before))
            captures.save_session(spark, store, a.pairs, a.source, whole_text(spark, a.after), a.system, "append", whole=a.whole)
        except ValueError as e:
            sys.exit(str(e))
        finally:
            jsonl.delete(spark, store)


def whole_text(spark: SparkSession, path: str) -> str:
    """A text file, or what comes in on standard input for '-'."""
    return sys.stdin.read() if path == "-" else spark.read.text(path, wholetext=True).first()[0]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="draftloom")
    sub = top.add_subparsers(dest="command", required=True)

    def add(name: str, f, *options: tuple) -> None:
        p = sub.add_parser(name)
        p.set_defaults(run=f)
        for flag, kw in options:
            p.add_argument(flag, **kw)

    need, many = dict(required=True), dict(nargs="+", required=True)
    yes = dict(action="store_true")
    num = lambda t, d: dict(type=t, default=d)
    add("targets", cmd_targets, ("--root", need), ("--out", need), ("--human-only", yes), ("--field", dict(default="automation")), ("--max-level", num(int, 0)), ("--min-chars", num(int, 80)), ("--max-chars", num(int, 8000)), ("--merge", yes), ("--context", yes), ("--stop-at", dict(nargs="*", default=[])), ("--sample", num(float, None)), ("--sort", dict(default="none")), ("--report", {}), ("--show", num(int, 0)))
    add("synth", cmd_synth, ("--targets", need), ("--pairs", need), ("--out", need), ("--model", many), ("--strategy", many), ("--effort", many), ("--kind", dict(default="gpt", choices=list(splits.ARM_NAMES))), ("--seed", num(int, 0)), ("--dropout", num(float, 0.0)), ("--per-generator", yes), ("--dry-run", yes))
    add("eval", cmd_eval, ("--pairs", need), ("--scores", need), ("--hook", need), ("--score-field", dict(default="slop", choices=list(P.FIELDS))), ("--report", {}))
    add("export-table", cmd_export, ("--scores", need), ("--out", need))
    add("make-splits", cmd_splits, ("--pairs", need), ("--out", need), ("--eval-frac", num(float, 0.1)), ("--detector-frac", num(float, 0.4)), ("--seed", num(int, 0)), ("--force", yes))
    add("train-clf", cmd_train_clf, ("--pairs", need), ("--out", need), ("--hook", need), ("--splits", {}), ("--c", num(float, None)), ("--holdout-frac", num(float, 0.0)), ("--holdout-posts", dict(nargs="*", default=None)), ("--seed", num(int, 0)))
    add("train", cmd_train, ("--pairs", need), ("--out", need), ("--system", need), ("--splits", {}), ("--val-frac", num(float, 0.1)), ("--seed", num(int, 0)), ("--cap", num(int, None)), ("--price", num(float, 0.0)), ("--hook", {}), ("--dry-run", yes))
    add("run", cmd_run, ("--docs", need), ("--out", need), ("--hook", need), ("--samples", num(int, 4)), ("--no-guard", yes))
    add("serve", cmd_serve, ("--requests", need), ("--out", need), ("--checkpoint", need), ("--hook", need))
    add("log", cmd_log, ("action", dict(choices=["list", "drop", "tidy", "pair", "open", "save", "sessions", "forget"])), ("--pairs", need), ("--source", dict(default="")), ("--before", {}), ("--after", {}), ("--system", dict(default="")), ("--sessions", dict(default="sessions")), ("--earlier", dict(default="smart", choices=["smart", "replace", "append"])), ("--keep-open", yes), ("--whole", yes), ("--no-context", yes), ("--tag", dict(nargs="*", default=None)))
    return top


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    a.run(SparkSession.builder.appName("draftloom").getOrCreate(), a)


if __name__ == "__main__":
    main()
