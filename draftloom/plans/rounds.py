"""More of the query catalogue: sinks and sources as round trips, scoring and rewriting rounds, sessions.

Registered beside ``catalogue``; every query reads its whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from draftloom.functions import keys, text
from draftloom.operators import corpus, model, pairs as P, scores as S, sessions, splits, targets as T
from draftloom.plans.catalogue import _PAIRS, _SCORED_SQL, _body, _contract, _fold_spaces, _once, _scored, _strip, _unit, query
from draftloom.session import scratch, table
from draftloom.sources import jsonl, posts as posts_source

BROKEN = ["not json", "[1, 2]", '"text"', "", "{broken"]


# --- sources and sinks -------------------------------------------------------
@query("SELECT DISTINCT target_id, source, chunk_index, context, text FROM targets")
def jsonl_scan(spark: SparkSession, d: str) -> DataFrame:
    """Targets appended as JSON lines beside lines that are none, and read again."""
    at = scratch(spark, "jsonl")
    cols = ["target_id", "source", "chunk_index", "context", "text"]
    jsonl.append_jsonl(table(spark, d, "targets").select(*cols), at)
    spark.createDataFrame([(x,) for x in BROKEN], "value string").write.mode("append").text(at)
    return jsonl.read_jsonl(spark, at, "target_id bigint, source string, chunk_index int, context string, text string").distinct()


@query(
    """WITH s AS (SELECT source FROM pairs WHERE source IS NOT NULL GROUP BY source ORDER BY count(*) DESC, source LIMIT 1)
    SELECT source, count(*) AS lines FROM pairs WHERE source IS NULL OR source <> (SELECT source FROM s) GROUP BY source UNION ALL SELECT '(broken)', 4"""
)
def jsonl_without_source(spark: SparkSession, d: str) -> DataFrame:
    """The pairs as JSON lines after the busiest source was deleted; lines that are no records stay."""
    p = table(spark, d, "pairs")
    busiest = p.filter("source is not null").groupBy("source").count().orderBy(F.desc("count"), "source").first()
    at = scratch(spark, "jsonl")
    jsonl.append_jsonl(p.select("messages", F.struct("source", "captured_at", "capture_id", "chunk_index").alias("meta")), at)
    spark.createDataFrame([(x,) for x in BROKEN], "value string").write.mode("append").text(at)
    jsonl.remove_source(spark, at, busiest[0])
    left = jsonl.read_jsonl(spark, at, jsonl.PAIR, keep_raw=True)
    return left.groupBy(F.when(F.col("_raw").isNotNull(), F.lit("(broken)")).otherwise(F.col("meta.source")).alias("source")).agg(F.count(F.lit(1)).alias("lines"))


@query("SELECT DISTINCT output_id, generator, meta.reasoning_effort AS effort, meta.prompt_tokens AS prompt_tokens FROM gen_outputs")
def csv_export(spark: SparkSession, d: str) -> DataFrame:
    """A table of covariates exported as CSV with its provenance, and read again."""
    g = table(spark, d, "gen_outputs").select("output_id", "generator", F.col("meta.reasoning_effort").alias("effort"), F.col("meta.prompt_tokens").alias("prompt_tokens")).distinct()
    at = scratch(spark, "csv")
    side = jsonl.export_table(g, at, corpus.data_hash(g), {})
    assert side["columns"] == g.columns
    return spark.read.option("header", True).schema("output_id bigint, generator string, effort string, prompt_tokens int").csv(at)


@query("SELECT DISTINCT meta.prompt_id AS prompt_id FROM gen_outputs WHERE meta.prompt_id IS NOT NULL")
def prompt_archive(spark: SparkSession, d: str) -> DataFrame:
    """Prompts archived twice: each id once."""
    prompts = table(spark, d, "gen_outputs").select("meta.prompt_id", "meta.prompt_label", "meta.prompt_version").filter("prompt_id is not null")
    at = scratch(spark, "prompts")
    jsonl.archive_prompts(prompts, at)
    assert jsonl.archive_prompts(prompts, at) == 0
    return jsonl.read_jsonl(spark, at, "prompt_id string")


@query("SELECT DISTINCT output_id, 'spent ' || meta.reasoning_tokens AS reasoning FROM gen_outputs WHERE meta.reasoning_tokens > 0")
def reasoning_sidecar(spark: SparkSession, d: str) -> DataFrame:
    """What the corpus leaves to the sidecar of reasoning, keyed by its record."""
    n = F.col("meta.reasoning_tokens")
    g = table(spark, d, "gen_outputs").select("output_id", F.when(n > 0, F.concat(F.lit("spent "), n.cast("string"))).alias("reasoning")).distinct()
    return jsonl.split_reasoning(g, "output_id")[1]


@query(f"SELECT m.role AS role, count(*) AS messages, sum(length(m.content))::BIGINT AS chars FROM (SELECT unnest(messages) AS m FROM {_PAIRS}) GROUP BY 1")
def conversations(spark: SparkSession, d: str) -> DataFrame:
    """The corpus exported as conversations alone and read again, by role."""
    at = scratch(spark, "conversations")
    jsonl.export_conversations(_once(spark, d), at)
    m = spark.read.schema("messages array<struct<role:string,content:string>>").json(at).select(F.explode("messages").alias("m"))
    return m.groupBy("m.role").agg(F.count(F.lit(1)).alias("messages"), F.sum(F.length("m.content")).alias("chars"))


@query("SELECT DISTINCT source, CASE WHEN starts_with('blog/' || source, 'blog/post/') THEN substr(source, 6) ELSE 'blog/' || source END AS label FROM posts WHERE source IS NOT NULL")
def source_labels(spark: SparkSession, d: str) -> DataFrame:
    """Paths of posts, relative to a root where they lie under it."""
    p = table(spark, d, "posts").select("source").filter("source is not null").distinct()
    return p.select("source", posts_source.source_label(F.concat(F.lit("file:/x/../blog/"), "source"), "/x/../blog/post").alias("label")).withColumn("label", F.regexp_replace("label", r"^/x/\.\./", ""))


# --- selection, union, statistics ---------------------------------------------
@query(f"SELECT DISTINCT target_id, source, text FROM targets WHERE source IS NOT NULL AND {_unit("'0:' || source")} >= 0.4::DOUBLE AND {_unit("'0' || chr(0) || source || chr(0) || coalesce(text, '')")} < 0.5::DOUBLE")
def selected_targets(spark: SparkSession, d: str) -> DataFrame:
    """The styler's passages, and of them a growth-stable half."""
    t = table(spark, d, "targets").filter("source is not null").select("target_id", "source", "text").distinct()
    return T.select_targets(t, splits.hash_role(F.col("source")), "styler", 0.5)


@query("SELECT target_id, length(text) AS n_chars FROM (SELECT DISTINCT target_id, text, source, chunk_index FROM targets WHERE text IS NOT NULL) ORDER BY length(text) DESC, target_id LIMIT 100")
def longest_targets(spark: SparkSession, d: str) -> DataFrame:
    """A top-100 report: the longest passages."""
    t = table(spark, d, "targets").filter("text is not null").select("target_id", "text", "source", "chunk_index").distinct()
    return P.first_n(t, 100, [F.desc(F.length("text")), F.col("target_id")]).select("target_id", F.length("text").cast("bigint").alias("n_chars"))


@query("SELECT coalesce(source, '?') AS source, generator, count(*) AS rows FROM (SELECT source, NULL::VARCHAR AS generator FROM targets UNION ALL SELECT NULL, generator FROM gen_outputs) GROUP BY 1, 2")
def corpora_union(spark: SparkSession, d: str) -> DataFrame:
    """Two corpora with different columns as one."""
    u = P.union_corpora(table(spark, d, "targets").select("source", "text"), table(spark, d, "gen_outputs").select("text", "generator"))
    return u.groupBy(F.coalesce("source", F.lit("?")).alias("source"), "generator").agg(F.count(F.lit(1)).alias("rows"))


@query("SELECT m AS model, count(*) AS outputs, max(CASE m WHEN 'alpha' THEN 32000 ELSE 8192 END)::INT AS context_window FROM (SELECT DISTINCT output_id, meta.model AS m FROM gen_outputs) GROUP BY m")
def model_windows(spark: SparkSession, d: str) -> DataFrame:
    """The context window of each output's model, from a registry, a default where it is not listed."""
    registry = spark.createDataFrame([("alpha", 32000), ("alpha", 16000), ("unused", 1)], "model string, context_window int")
    g = table(spark, d, "gen_outputs").select("output_id", "meta.model").distinct()
    return P.with_windows(g, registry, 8192).groupBy("model").agg(F.count(F.lit(1)).alias("outputs"), F.max("context_window").alias("context_window"))


@query(f"SELECT round(avg(m), 4) AS mean, round(stddev_pop(m), 4) AS std, count(m) AS folds FROM (SELECT ingest_batch, avg(transform_sim) AS m FROM {_PAIRS} GROUP BY 1)")
def fold_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Mean and deviation over batches of the mean similarity."""
    per = _once(spark, d).groupBy("ingest_batch").agg(F.avg("transform_sim").alias("m"))
    return model.fold_stats(per, "m")


@query(f"SELECT pair_row::VARCHAR AS id, round(d, 6) AS draft, round(a, 6) AS rewrite, round(d, 6) - round(a, 6) AS delta FROM (SELECT pair_row, max(CASE WHEN label = 1 THEN score END) AS d, max(CASE WHEN label = 0 THEN score END) AS a FROM {_SCORED_SQL} GROUP BY 1)".replace("round(d, 6) - round(a, 6) AS delta", "round((round(d, 6) - round(a, 6)), 2) + 0.0::DOUBLE AS delta"))
def paired_scores(spark: SparkSession, d: str) -> DataFrame:
    """Draft, rewrite and fall of the detector's score of each pair."""
    s = _scored(spark, d).select(F.col("pair_row").cast("string").alias("id"), F.when(F.col("label") == 1, "slop").when(F.col("label") == 0, "target").alias("field"), F.struct(F.round("score", 6).alias("score")).alias("detector"))
    return S.paired_report(s)


@query(
    f"""SELECT row_id, pair_row, post, label FROM (SELECT pair_id || ':' || l AS row_id, pair_id AS pair_row, coalesce(source, '?') AS post, l::INT AS label FROM (SELECT * FROM {_PAIRS} WHERE coalesce(transform_sim <= 0.85::DOUBLE, true) AND coalesce({_strip(_body(2))}, '') <> '' AND coalesce({_strip(_body(3))}, '') <> ''), (SELECT unnest([0, 1]) AS l))
    WHERE post IN (SELECT unnest(val_posts) FROM train_corpus)"""
)
def subset_rows(spark: SparkSession, d: str) -> DataFrame:
    """The dataset's rows of the posts that earlier runs held out."""
    keep = table(spark, d, "train_corpus").select(F.explode("val_posts").alias("post"))
    return model.subset(model.assemble(_once(spark, d)), keep).select("row_id", "pair_row", "post", "label")


@query()
def splits_contract(spark: SparkSession, d: str) -> DataFrame:
    """The pinned evaluation posts of a splits contract, written to a file and read back."""
    p = table(spark, d, "pairs").select(F.col("source").alias("post"), "synthetic")
    s = splits.make_splits(p, candidates=p.filter("not coalesce(synthetic, false)").select("post"))
    at = f"{scratch(spark, 'splits')}.json"
    jsonl.write_json(spark, at, s)
    return spark.createDataFrame([(x,) for x in jsonl.read_json(spark, at, splits.VERSION)["eval_posts"]], "post string")


# --- scoring and rewriting rounds ---------------------------------------------
@query(f"SELECT pair_id::VARCHAR AS id, length({_body(3)})::INT AS text_chars, round(length({_body(3)}) / 1000.0::DOUBLE, 6) AS score FROM {_PAIRS} WHERE split <> 'train' AND coalesce({_body(3)}, '') <> ''")
def scored_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs that no earlier run scored (the training split was), scored by an injected detector."""
    p = _once(spark, d)
    rows = p.select(F.col("pair_id").cast("string").alias("id"), P.extract(F.col("messages"), F.col("context"), "target").alias("text")).filter("coalesce(text, '') <> ''")
    good, _ = S.score_rows(rows, p.filter("split = 'train'").select(F.col("pair_id").cast("string").alias("id")), {"detector": lambda t: {"score": len(t) / 1000}})
    return good.select("id", "text_chars", F.round("detector.score", 6).alias("score"))


@query(f"SELECT pair_id AS id, regexp_replace({_body(2)}, '[ \\t]+', ' ', 'g') AS output FROM {_PAIRS} WHERE split = 'eval' AND NOT coalesce(synthetic, false) AND coalesce({_strip('messages[2].content')}, '') <> ''")
def rewritten_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The real evaluation pairs rewritten by a stand-in styler, the heading taken off the output."""
    p = _once(spark, d).filter("split = 'eval'").withColumnRenamed("pair_id", "id")
    done = spark.createDataFrame([], "id bigint")
    out = corpus.rewrite_pending(p, done, lambda t, n: _fold_spaces(t, n), selector=~F.coalesce("synthetic", F.lit(False)))
    return out.select("id", P.FIELDS["output"](F.col("messages"), F.regexp_replace("context", "[ \t]+", " ")).alias("output"))


@query()
def rewrite_preferences(spark: SparkSession, d: str) -> DataFrame:
    """The log of candidates, scores and choices over the bodies of the posts."""
    p = table(spark, d, "posts").filter("raw is not null").select(F.col("post_id").alias("doc_id"), F.col("raw").alias("text")).dropDuplicates(["doc_id", "text"])
    p = p.groupBy("doc_id").agg(F.min("text").alias("text"))
    return corpus.rewrite_decisions(p, _fold_spaces, lambda t: float(len(t)), 2)


# --- sessions ------------------------------------------------------------------
def _session_items(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "gen_outputs").select("output_id", "target_id", "generator", "text", F.coalesce("meta.prompt_tokens", F.lit(0)).alias("prompt_tokens"), F.col("meta.finish_reason").alias("finish")).dropDuplicates(["output_id"])
    t = table(spark, d, "targets").groupBy("target_id").agg(F.max("text").alias("ask"))
    j = g.join(t, "target_id", "left")
    return j.select(F.coalesce("generator", F.lit("?")).alias("arm"), F.col("output_id").alias("item"), F.coalesce(F.length("ask"), F.lit(0)).alias("ask_chars"), F.coalesce(F.length("text"), F.lit(0)).alias("reply_chars"), F.col("text").isNull().alias("failed"))


_NEXT = "(s.asked + s.replied + t.ask_chars) // 4 > 8000"


@query(
    f"""WITH RECURSIVE g AS (SELECT output_id, any_value(target_id) AS target_id, any_value(coalesce(generator, '?')) AS arm, any_value(text) AS text FROM gen_outputs GROUP BY output_id),
    a AS (SELECT target_id, max(text) AS ask FROM targets GROUP BY 1),
    t AS (SELECT arm, output_id AS item, coalesce(length(ask), 0) AS ask_chars, coalesce(length(text), 0) AS reply_chars, text IS NULL AS failed, row_number() OVER (PARTITION BY arm ORDER BY output_id) AS k FROM g LEFT JOIN a USING (target_id)),
    s AS (SELECT arm, k, item, 0 AS session, 1 AS turn, 0 AS est, CASE WHEN failed THEN 'error' ELSE 'ran' END AS outcome, CASE WHEN failed THEN 0 ELSE ask_chars END AS asked, CASE WHEN failed THEN 0 ELSE reply_chars END AS replied, CASE WHEN failed THEN true ELSE false END AS ended FROM t WHERE k = 1
    UNION ALL SELECT t.arm, t.k, t.item, s.session + n.fresh, CASE WHEN n.fresh = 1 THEN 1 ELSE s.turn + 1 END, CASE WHEN n.fresh = 1 THEN 0 ELSE (s.asked + s.replied + t.ask_chars) // 4 END, CASE WHEN t.failed THEN 'error' ELSE 'ran' END,
        CASE WHEN t.failed THEN 0 WHEN n.fresh = 1 THEN t.ask_chars ELSE s.asked + t.ask_chars END, CASE WHEN t.failed THEN 0 WHEN n.fresh = 1 THEN t.reply_chars ELSE s.replied + t.reply_chars END, t.failed
      FROM s JOIN t ON t.arm = s.arm AND t.k = s.k + 1, LATERAL (SELECT CASE WHEN s.ended OR s.turn >= 16 OR {_NEXT} THEN 1 ELSE 0 END AS fresh) n)
    SELECT arm, item, session::INT AS session, turn::INT AS turn, est::BIGINT AS estimate, outcome FROM s"""
)
def generation_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions as they run: history grows, the budget and errors end a session, what is left goes on in a fresh one."""
    return sessions.run(_session_items(spark, d), ["item"], turns=16, budget=8000)


@query("SELECT DISTINCT output_id, CASE WHEN coalesce(meta.prompt_tokens, 0) > 0 THEN meta.prompt_tokens + coalesce(meta.completion_tokens, 0) + coalesce(length(text), 0) // 4 ELSE (coalesce(length(text), 0) * 2) // 4 END::BIGINT AS estimate, least(32000, CASE WHEN meta.model = 'alpha' THEN 12800 ELSE 6553 END)::INT AS cap FROM gen_outputs")
def next_prompts(spark: SparkSession, d: str) -> DataFrame:
    """The estimate of the prompt of a next turn, and the cap that it is held against."""
    g = table(spark, d, "gen_outputs").select("output_id", "text", "meta").distinct()
    window = F.when(F.col("meta.model") == "alpha", F.lit(16000)).otherwise(F.lit(8192))
    n = F.coalesce(F.length("text"), F.lit(0))
    return g.select("output_id", sessions.next_prompt(n, F.col("meta.prompt_tokens"), F.col("meta.completion_tokens"), n).alias("estimate"), sessions.token_cap(F.lit(None), window, 32_000).alias("cap")).distinct()
