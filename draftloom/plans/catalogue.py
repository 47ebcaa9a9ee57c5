"""The query catalogue: name -> Spark query over the tables of a folder, name -> DuckDB SQL.

Every query reads its whole tables. Queries without SQL need difflib, YAML,
models or state; they are tested against brute force.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from draftloom.functions import blocks, keys, text
from draftloom.operators import corpus, model, pairs as P, scores as S, splits, targets as T
from draftloom.session import spread, stored, table
from draftloom.sources import jsonl, posts as posts_source
from draftloom.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Production parameters.
ROLE_SALT, DETECTOR_FRAC, SAMPLE_FRAC = "0", 0.4, 0.25
COEF = [((i * 37) % 17 - 8) / 16.0 for i in range(64)]
EDGES = [0.51, 0.55, 0.59, 0.65]
MODELS, STRATEGIES, EFFORTS = ["alpha", "beta", "gamma"], ["formal", "padded"], ["off", "medium"]
REQUIRED = ["source", "captured_at", "capture_id", "chunk_index", "chunk_total"]
HEADERS = ["## Quiet notebook", "## Tilted notebook", "## Humble manifold"]
SYSTEM = "You turn a draft into the house voice of this notebook. Leave headings, lists, code, formulas and links as they are. Answer with the rewritten passage and nothing besides."


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# SQL twins of the text functions
_WS = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{_WS}]+|[{_WS}]+$', '', 'g')"


def _lines(x: str) -> str:
    ls = f"string_split_regex({x}, '{_BREAK}')"
    return f"(CASE WHEN {ls}[-1] = '' THEN {ls}[1:len({ls})-1] ELSE {ls} END)"


def _paragraphs(x: str) -> str:
    joined = f"array_to_string(list_transform({_lines(x)}, lambda l: CASE WHEN {_strip('l')} = '' THEN '' ELSE l END), chr(10))"
    return f"list_filter(list_transform(string_split_regex({joined}, '\\n\\n+'), lambda p: regexp_replace(p, '^\\n+|\\n+$', '', 'g')), lambda p: {_strip('p')} <> '')"


def _residual(x: str) -> str:
    a = f"regexp_replace({x}, '{text.LINK}', ' ', 'g')"
    b = f"regexp_replace({a}, '(?m)^\\s*(?:[-*+]|\\d+[.)])\\s', ' ', 'g')"
    return f"length({_strip(f"regexp_replace({b}, '[\\s*_#>|`/\\\\\\-]+', ' ', 'g')")})"


def _link_list(x: str) -> str:
    s = _strip(x)
    return f"(CASE WHEN {s} = '' THEN true ELSE {_residual(s)}::DOUBLE / length({s}) < 0.2::DOUBLE END)"


def _all_lines(x: str, test: str) -> str:
    ls = f"list_filter({_lines(x)}, lambda l: {_strip('l')} <> '')"
    return f"(len({ls}) > 0 AND len(list_filter({ls}, lambda l: NOT ({test}))) = 0)"


def _table(x: str) -> str:
    return _all_lines(x, f"starts_with(regexp_replace(l, '^[{_WS}]+', ''), '|')")


def _list(x: str) -> str:
    return _all_lines(x, r"regexp_matches(l, '^\s{0,3}([-*+]\s|\d+[.)]\s)')")


def _keep(x: str) -> str:
    s = _strip(x)
    return f"coalesce(length({s}) >= 80 AND length({s}) <= 8000 AND NOT {_table(s)} AND NOT {_link_list(s)}, false)"


def _unit(x: str) -> str:
    return f"(('0x' || substr(sha256({x}), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0::DOUBLE)"


_PAIRS = "(SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY pair_id ORDER BY ingested_at) = 1)"


def _once(spark: SparkSession, d: str) -> DataFrame:
    """The pairs table, each pair_id once (repeats differ in ingested_at only)."""
    return P.first_by_key(table(spark, d, "pairs"), "pair_id", [F.col("ingested_at")])


def _body(k: int) -> str:
    c = f"messages[{k}].content"
    return f"(CASE WHEN coalesce(context, '') <> '' AND starts_with({c}, context || chr(10) || chr(10)) THEN substr({c}, length(context) + 3) ELSE {c} END)"


_COEF_SQL = "[" + ", ".join(str(c) for c in COEF) + "]::DOUBLE[]"
_SCORE_SQL = f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-(0.125::DOUBLE + list_dot_product(embedding::DOUBLE[], {_COEF_SQL})))))"


def _scored(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    return e.select("vec_id", F.expr("vec_id div 2").alias("pair_row"), (F.col("label") % 2).alias("label"), (F.col("label") >= 5).alias("synthetic"), S.linear_score(F.col("embedding"), COEF, 0.125).alias("score"))


_SCORED_SQL = f"(SELECT vec_id, vec_id // 2 AS pair_row, label % 2 AS label, label >= 5 AS synthetic, {_SCORE_SQL} AS score FROM embeddings)"


# --- passages ----------------------------------------------------------------
@query(
    f"""WITH c AS (SELECT source, unnest({_paragraphs('text')}) AS p FROM documents WHERE source IS NOT NULL),
    k AS (SELECT source, p FROM c WHERE {_keep('p')})
    SELECT CASE WHEN {_unit("'0:' || source")} < 0.4::DOUBLE THEN 'detector' ELSE 'styler' END AS role, count(DISTINCT source) AS posts, count(*) AS chunks, sum(length({_strip('p')}))::BIGINT AS chars FROM k GROUP BY 1"""
)
def role_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: paragraphs of all documents, gated, by role of their source."""
    c = spread(table(spark, d, "documents").filter("source is not null").select("source", "text")).select("source", F.explode(text.paragraphs(F.col("text"))).alias("p")).filter(text.keep_chunk(F.col("p")))
    return c.groupBy(splits.hash_role(F.col("source"), ROLE_SALT, DETECTOR_FRAC).alias("role")).agg(F.countDistinct("source").alias("posts"), F.count(F.lit(1)).alias("chunks"), F.sum(F.length(text.strip(F.col("p")))).alias("chars"))


@query(f"SELECT DISTINCT target_id, generate_subscripts(p, 1) - 1 AS pos, unnest(p) AS paragraph FROM (SELECT target_id, {_paragraphs('text')} AS p FROM targets)")
def paragraph_split(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "targets").select("target_id", F.posexplode(text.paragraphs(F.col("text"))).alias("pos", "paragraph"))
    return t.distinct().withColumn("pos", F.col("pos").cast("bigint"))


_SECTIONS_SQL = f"""WITH l AS (SELECT target_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS n FROM (SELECT DISTINCT target_id, {_lines('text')} AS ls FROM targets WHERE text IS NOT NULL)),
    h AS (SELECT *, regexp_matches(line, '^\\s{{0,3}}#{{1,6}}\\s+(.*?)\\s*$') AS is_h FROM l),
    s AS (SELECT *, count(*) FILTER (is_h) OVER (PARTITION BY target_id ORDER BY n) AS sec FROM h),
    g AS (SELECT target_id, sec, coalesce(max({_strip('line')}) FILTER (is_h), '') AS heading, coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT is_h), '') AS body FROM s GROUP BY 1, 2)
    SELECT target_id, heading, body FROM g WHERE heading <> '' OR {_strip('body')} <> ''"""


@query(_SECTIONS_SQL)
def section_split(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "targets").filter("text is not null").select("target_id", "text").distinct()
    return t.select("target_id", F.explode(T.sections(F.col("text"))).alias("s")).select("target_id", "s.heading", "s.body")


@query(
    f"""WITH p AS (SELECT DISTINCT target_id, {_paragraphs('text')} AS ps FROM targets WHERE text IS NOT NULL),
    u AS (SELECT target_id, generate_subscripts(ps, 1) - 1 AS pos, unnest(ps) AS p FROM p)
    SELECT target_id, pos, coalesce(last_value(CASE WHEN regexp_matches(string_split(p, chr(10))[1], '^\\s{{0,3}}#{{1,6}}\\s') THEN {_strip('p')} END IGNORE NULLS) OVER (PARTITION BY target_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS heading FROM u"""
)
def nearest_heading(spark: SparkSession, d: str) -> DataFrame:
    """Heading above each paragraph, carried forward inside the row."""
    t = table(spark, d, "targets").filter("text is not null").select("target_id", "text").distinct()
    return t.select("target_id", F.posexplode(P.headings_above(text.paragraphs(F.col("text")))).alias("pos", "heading")).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    """WITH t AS (SELECT DISTINCT target_id, text FROM targets WHERE text IS NOT NULL),
    l AS (SELECT target_id, string_split(text, chr(10)) AS ls FROM t),
    c AS (SELECT target_id, ls, list_position(list_transform(ls, lambda x: regexp_matches(x, '^\\s{0,3}#{1,6}\\s+(.*?)\\s*$') AND lower(regexp_replace(regexp_extract(x, '^\\s{0,3}#{1,6}\\s+(.*?)\\s*$', 1), '\\s*\\{[^}]*\\}\\s*$', '')) IN ('quiet notebook', 'tilted notebook', 'humble manifold')), true) AS k FROM l)
    SELECT target_id, CASE WHEN coalesce(k, 0) > 0 THEN length(array_to_string(ls[1:k-1], chr(10))) + (k > 1)::INT ELSE length(array_to_string(ls, chr(10))) END AS kept_chars FROM c"""
)
def truncate_at_header(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "targets").filter("text is not null").select("target_id", "text").distinct()
    return t.select("target_id", F.length(text.truncate_at_headers(F.col("text"), HEADERS)).cast("bigint").alias("kept_chars"))


@query(f"SELECT DISTINCT target_id, {_keep('text')} AS keep, {_table('text')} AS is_table, {_list('text')} AS is_list, {_link_list('text')} AS is_links, {_residual('text')} AS residual FROM targets WHERE text IS NOT NULL")
def chunk_gate(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("text")
    t = spread(table(spark, d, "targets").filter("text is not null").select("target_id", "text"))
    return t.select("target_id", text.keep_chunk(c).alias("keep"), text.is_table(c).alias("is_table"), text.is_list(c).alias("is_list"), text.is_link_list(c).alias("is_links"), text.prose_residual(c).cast("bigint").alias("residual")).distinct()


@query(
    f"""WITH p AS (SELECT doc_id, ps FROM (SELECT doc_id, {_paragraphs('text')} AS ps FROM documents WHERE text IS NOT NULL) WHERE len(ps) > 0),
    f AS (SELECT doc_id, string_split(list_reduce(ps, lambda acc, x: CASE WHEN length(string_split(acc, chr(57344))[-1]) + 2 + length(x) <= 1500 THEN acc || chr(10) || chr(10) || x ELSE acc || chr(57344) || x END), chr(57344)) AS parts FROM p)
    SELECT doc_id, (generate_subscripts(parts, 1) - 1)::INT AS pos, unnest(parts) AS passage FROM f"""
)
def pack_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    t = spread(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", F.posexplode(text.pack(text.paragraphs(F.col("text")), 1500)).alias("pos", "passage"))
    return t


@query()
def post_passages(spark: SparkSession, d: str) -> DataFrame:
    """Posts with frontmatter parsed, human-authored ones only, cut into gated passages."""
    p = posts_source.with_frontmatter(table(spark, d, "posts").filter("raw is not null and source is not null"))
    level = F.coalesce(F.get_json_object("meta", "$.automation"), F.col("automation"))
    return T.passages(p.filter(text.is_human_authored(level)).select("source", "body").distinct(), T.ChunkPolicy(merge=True, heading_context=True))


@query()
def frontmatter(spark: SparkSession, d: str) -> DataFrame:
    p = posts_source.with_frontmatter(table(spark, d, "posts"))
    return p.select("post_id", "source", F.get_json_object("meta", "$.title").alias("title"), F.get_json_object("meta", "$.automation").alias("automation"), F.length("body").alias("body_chars"))


@query(
    r"""SELECT post_id, coalesce(CASE WHEN regexp_matches(a, '^[+-]?\d+(_\d+)*$') THEN replace(a, '_', '')::BIGINT <= 0 END, false) AS human,
    coalesce(regexp_matches(substr(modified, 1, 10), '^\d{4}-\d{2}-\d{2}$') AND substr(modified, 1, 10) > '2023-06-30', false) AS recent FROM (SELECT *, """
    + _strip("automation")
    + " AS a FROM posts)"
)
def selectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "posts").select("post_id", text.is_human_authored(F.col("automation")).alias("human"), text.is_modified_after(F.col("modified"), "2023-06-30").alias("recent"))


@query(
    r"""SELECT post_id, coalesce(regexp_matches(lower(n), '\.qmd$') AND NOT starts_with(n, '_') AND NOT starts_with(n, '.') AND len(list_filter(ps[1:len(ps)-1], lambda p: (starts_with(p, '.') AND p NOT IN ('.', '..')) OR p IN ('renv', '_site'))) = 0, false) AS valid
    FROM (SELECT post_id, string_split(source, '/') AS ps, string_split(source, '/')[-1] AS n FROM posts)"""
)
def valid_paths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "posts").select("post_id", posts_source.valid_post_path(F.col("source")).alias("valid"))


@query("SELECT chunks, least(greatest(median, 0), max_chars)::INT AS median_chars, (SELECT n FROM (SELECT length(text) AS n, row_number() OVER (ORDER BY length(text)) - 1 AS r FROM targets WHERE text IS NOT NULL) WHERE r = least(chunks - 1, floor(0.9::DOUBLE * chunks))) AS p90_chars, max_chars, sum_chars, sources FROM (SELECT count(text) AS chunks, floor(median(length(text))) AS median, max(length(text)) AS max_chars, sum(length(text))::BIGINT AS sum_chars, count(DISTINCT source) AS sources FROM targets)")
def target_stats(spark: SparkSession, d: str) -> DataFrame:
    s = T.summary(table(spark, d, "targets"))
    return s.withColumn("p90_chars", F.col("p90_chars").cast("bigint")).withColumn("max_chars", F.col("max_chars").cast("bigint"))


@query(
    """WITH v AS (SELECT length(text)::DOUBLE AS v FROM targets WHERE text IS NOT NULL), t AS (SELECT max(v) AS top FROM v),
    b AS (SELECT least(9, floor(v / top * 10))::INT AS bin, count(*) AS n FROM v, t GROUP BY 1)
    SELECT r.bin::INT AS bin, round(top / 10 * r.bin, 6) AS lo, round(top / 10 * (r.bin + 1), 6) AS hi, coalesce(n, 0) AS n FROM (SELECT unnest(range(10)) AS bin) r CROSS JOIN t LEFT JOIN b ON b.bin = r.bin"""
)
def length_histogram(spark: SparkSession, d: str) -> DataFrame:
    return T.histogram(table(spark, d, "targets"), F.length("text")).withColumn("lo", F.round("lo", 6)).withColumn("hi", F.round("hi", 6))


# --- identity and assignment -------------------------------------------------
_Z = "chr(0)"


@query(
    f"""SELECT output_id, substr(sha256(coalesce(generator, '') || {_Z} || coalesce(slop_strategy, '') || {_Z} || coalesce(meta.reasoning_effort, '') || {_Z} || coalesce(meta.prompt_id, '') || {_Z} || '' || {_Z} || coalesce(text, '') || {_Z}), 1, 16) AS synth_key,
    substr(sha256(target_id::VARCHAR || {_Z} || coalesce(generator, '') || {_Z} || coalesce(slop_strategy, '')), 1, 8) AS capture_id FROM (SELECT DISTINCT output_id, target_id, text, meta, generator, slop_strategy FROM gen_outputs)"""
)
def synth_keys(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "gen_outputs").select("output_id", "target_id", "text", "meta", "generator", "slop_strategy").distinct()
    c = F.col
    return g.select("output_id", keys.synth_key(c("generator"), c("slop_strategy"), c("meta.reasoning_effort"), c("meta.prompt_id"), F.lit(""), c("text")).alias("synth_key"), keys.capture_id(c("target_id").cast("string"), c("generator"), c("slop_strategy")).alias("capture_id"))


@query(
    f"""SELECT pair_id, coalesce(nullif(synth_key, ''), CASE WHEN coalesce(capture_id, '') <> '' THEN capture_id || ':' || coalesce(chunk_index::VARCHAR, 'None') END, substr(sha256(coalesce(source, 'None') || {_Z} || coalesce(chunk_index::VARCHAR, 'None')), 1, 16)) AS record_id,
    substr(sha256(messages[1].content), 1, 12) AS prompt_id FROM {_PAIRS}"""
)
def record_ids(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return _once(spark, d).select("pair_id", keys.record_id(c("synth_key"), c("capture_id"), c("chunk_index"), c("source")).alias("record_id"), keys.prompt_id(P.content(c("messages"), 0)).alias("prompt_id"))


@query(
    f"""SELECT target_id, CASE WHEN {_unit("'0:' || source")} < 0.4::DOUBLE THEN 'detector' ELSE 'styler' END AS role,
    {_unit(f"'0' || {_Z} || coalesce(source, '') || {_Z} || coalesce(text, '')")} < 0.25::DOUBLE AS sampled,
    (('0x' || substr(sha256('0' || {_Z} || coalesce(text, '')), 1, 16))::UBIGINT % 12)::INT AS arm_idx,
    list_reduce(list_prepend(0::BIGINT, list_transform(range(8), lambda i: ('0x' || substr(sha256(text), (i * 8 + 1)::BIGINT, 8))::BIGINT)), lambda a, x: (a * 296 + x) % 1000)::INT < 300 AS dropped
    FROM (SELECT DISTINCT target_id, source, text FROM targets WHERE text IS NOT NULL AND source IS NOT NULL)"""
)
def hash_assign(spark: SparkSession, d: str) -> DataFrame:
    """Role, growth-stable sample, arm and heading dropout of each target."""
    t = table(spark, d, "targets").filter("text is not null and source is not null").select("target_id", "source", "text").distinct()
    c = F.col
    return t.select("target_id", splits.hash_role(c("source")).alias("role"), (keys.hash_unit("0", c("source"), c("text")) < SAMPLE_FRAC).alias("sampled"), keys.arm_index(0, c("text"), 12).alias("arm_idx"), (keys.dropout_bucket(c("text")) < 300).alias("dropped"))


@query(
    """SELECT target_id, strategy, effort, model FROM (SELECT DISTINCT target_id FROM targets) CROSS JOIN (SELECT unnest(['formal', 'padded']) AS strategy) CROSS JOIN (SELECT unnest(['off', 'medium']) AS effort) CROSS JOIN (SELECT unnest(['alpha', 'beta', 'gamma']) AS model)"""
)
def arms_crossed(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "targets").select("target_id").distinct()
    a = splits.arms(spark, MODELS, STRATEGIES, EFFORTS)
    return splits.assign_arms(t, a, 12, per_generator=True).select("target_id", "strategy", "effort", "model")


@query(
    """SELECT arm.strategy AS strategy, arm.effort AS effort, arm.model AS model, count(*) AS targets FROM (SELECT (('0x' || substr(sha256('0' || chr(0) || text), 1, 16))::UBIGINT % 12)::INT AS i FROM (SELECT DISTINCT target_id, text FROM targets WHERE text IS NOT NULL)) x
    JOIN (SELECT (row_number() OVER (ORDER BY s, e, m) - 1)::INT AS i, ['formal', 'padded'][s] AS strategy, ['off', 'medium'][e] AS effort, ['alpha', 'beta', 'gamma'][m] AS model FROM (SELECT unnest([1, 2]) AS s), (SELECT unnest([1, 2]) AS e), (SELECT unnest([1, 2, 3]) AS m)) arm ON arm.i = x.i GROUP BY 1, 2, 3"""
)
def arms_by_hash(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "targets").filter("text is not null").select("target_id", "text").distinct()
    return splits.assign_arms(t, splits.arms(spark, MODELS, STRATEGIES, EFFORTS), 12).groupBy("strategy", "effort", "model").agg(F.count(F.lit(1)).alias("targets"))


@query(
    f"""WITH p AS {_PAIRS}, r AS (SELECT pair_id, source, coalesce(synthetic, false) AS synthetic, CASE WHEN source IN (SELECT unnest(val_posts) FROM train_corpus) THEN 'eval' WHEN {_unit("'0:' || coalesce(source, '?')")} < 0.4::DOUBLE THEN 'detector' ELSE 'styler' END AS role FROM p)
    SELECT d.role, count(DISTINCT source) AS posts, count(pair_id) AS pairs, count(pair_id) FILTER (NOT synthetic) AS pairs_real, count(pair_id) FILTER (synthetic) AS pairs_synth FROM (SELECT unnest(['eval', 'styler', 'detector']) AS role) d LEFT JOIN r ON r.role = d.role GROUP BY 1"""
)
def role_summary(spark: SparkSession, d: str) -> DataFrame:
    return splits.role_summary(splits.with_role(_once(spark, d).select("pair_id", "source", "synthetic"), _contract(spark, d)))


def _contract(spark: SparkSession, d: str) -> dict:
    """The splits contract with the posts that earlier runs pinned (a short list written by hand: train_corpus)."""
    pinned = sorted(r[0] for r in table(spark, d, "train_corpus").select(F.explode("val_posts")).distinct().toLocalIterator())
    return {"schema_version": 1, "eval_posts": pinned, "rest_rule": {"kind": "hash", "salt": ROLE_SALT, "detector_frac": DETECTOR_FRAC}}


@query(
    f"""WITH p AS {_PAIRS}, x AS (SELECT 'all' AS corpus, p.* FROM p UNION ALL SELECT 'synthetic', p.* FROM p WHERE synthetic UNION ALL SELECT 'first', p.* FROM p WHERE source = (SELECT min(source) FROM p)),
    r AS (SELECT corpus, source, coalesce(synthetic, false) AS synthetic, CASE WHEN source IN (SELECT unnest(val_posts) FROM train_corpus) THEN 'eval' WHEN {_unit("'0:' || coalesce(source, '?')")} < 0.4::DOUBLE THEN 'detector' ELSE 'styler' END AS role FROM x),
    s AS (SELECT c.corpus, d.role, count(DISTINCT source) AS posts, count(r.role) AS pairs, count(r.role) FILTER (NOT synthetic) AS real FROM (SELECT unnest(['all', 'synthetic', 'first']) AS corpus) c CROSS JOIN (SELECT unnest(['eval', 'styler', 'detector']) AS role) d LEFT JOIN r ON r.role = d.role AND r.corpus = c.corpus GROUP BY 1, 2),
    stale AS (SELECT corpus, count(*) AS n FROM (SELECT c.corpus, v.post FROM (SELECT unnest(['all', 'synthetic', 'first']) AS corpus) c, (SELECT DISTINCT unnest(val_posts) AS post FROM train_corpus) v EXCEPT SELECT corpus, source FROM x) GROUP BY 1)
    SELECT corpus, role, 'few posts' AS warning FROM s WHERE posts < 10 UNION ALL SELECT corpus, role, 'few pairs' FROM s WHERE pairs < 50
    UNION ALL SELECT corpus, role, 'eval is all synthetic' FROM s WHERE role = 'eval' AND pairs > 0 AND real = 0 UNION ALL SELECT corpus, role, 'cross validation unstable' FROM s WHERE role = 'detector' AND posts < 8
    UNION ALL SELECT corpus, 'eval', 'stale pinned posts' FROM stale WHERE n > 0"""
)
def danger_report(spark: SparkSession, d: str) -> DataFrame:
    """Warnings of three corpora: all pairs, the synthetic ones, those of the first post."""
    pairs, contract = _once(spark, d).select("pair_id", "source", "synthetic"), _contract(spark, d)
    first = pairs.agg(F.min("source")).first()[0]
    pinned = table(spark, d, "train_corpus").select(F.explode("val_posts").alias("post")).distinct()
    out = []
    for name, rows in (("all", pairs), ("synthetic", pairs.filter("synthetic")), ("first", pairs.filter(F.col("source") == first))):
        stale = pinned.join(rows.select(F.col("source").alias("post")).distinct(), "post", "left_anti")
        out.append(splits.danger_report(splits.role_summary(splits.with_role(rows, contract)), stale).withColumn("corpus", F.lit(name)))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("SELECT DISTINCT v AS post FROM (SELECT unnest(val_posts) AS v FROM train_corpus) INTERSECT SELECT source FROM pairs")
def pinned_present(spark: SparkSession, d: str) -> DataFrame:
    return splits.present(table(spark, d, "train_corpus").select(F.explode("val_posts").alias("post")), table(spark, d, "pairs").select(F.col("source").alias("post")))


@query("SELECT source AS post FROM posts EXCEPT SELECT unnest(val_posts) FROM train_corpus")
def posts_left(spark: SparkSession, d: str) -> DataFrame:
    return splits.remaining(table(spark, d, "posts").select(F.col("source").alias("post")), table(spark, d, "train_corpus").select(F.explode("val_posts").alias("post")))


@query(
    """WITH n AS (SELECT source AS post, count(*) AS n FROM pairs WHERE source IS NOT NULL GROUP BY 1), f AS (SELECT post, fold, ('0x' || substr(sha256('0:' || fold || ':' || post), 1, 15))::BIGINT AS u FROM n, (SELECT unnest(range(8))::INT AS fold))
    SELECT fold, post FROM (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY u, post) AS k, count(*) OVER (PARTITION BY fold) AS c FROM f) WHERE k <= greatest(1, round_even(c * 0.25, 0))"""
)
def shuffled_folds(spark: SparkSession, d: str) -> DataFrame:
    """The test posts of eight shuffled folds."""
    return splits.shuffle_folds(table(spark, d, "pairs").select(F.col("source").alias("post")))


@query(
    """WITH RECURSIVE s AS (SELECT post, n, row_number() OVER (ORDER BY n DESC, post) AS k FROM (SELECT source AS post, count(*) AS n FROM pairs WHERE source IS NOT NULL GROUP BY 1)),
    r AS (SELECT k, post, 0 AS fold, [n, 0, 0, 0]::BIGINT[] AS load FROM s WHERE k = 1 UNION ALL
    SELECT s.k, s.post, f.fold, list_transform(r.load, lambda x, i: CASE WHEN i = f.fold + 1 THEN x + s.n ELSE x END) FROM r JOIN s ON s.k = r.k + 1, LATERAL (SELECT list_position(r.load, list_min(r.load)) - 1 AS fold) f)
    SELECT post, fold::INT AS fold FROM r"""
)
def by_post_folds(spark: SparkSession, d: str) -> DataFrame:
    """Balanced inner folds of the posts."""
    return splits.balanced_folds(table(spark, d, "pairs").filter("source is not null").groupBy(F.col("source").alias("post")).agg(F.count(F.lit(1)).alias("n")))


# --- pairs -------------------------------------------------------------------
def _anchors(x: str) -> str:
    return f"list_concat(regexp_extract_all({x}, '{text.LINK_TARGET}', 1), list_concat(regexp_extract_all({x}, '{text.BARE_URL}', 1), regexp_extract_all({x}, '{text.CITE_KEY}')))"


@query(f"SELECT pair_id, {_body(2)} AS slop, {_body(3)} AS target FROM {_PAIRS}")
def pair_extract(spark: SparkSession, d: str) -> DataFrame:
    m, c = F.col("messages"), F.col("context")
    return _once(spark, d).select("pair_id", P.extract(m, c, "slop").alias("slop"), P.extract(m, c, "target").alias("target"))


@query(
    f"""WITH p AS {_PAIRS}, f AS (SELECT pair_id, source, captured_at, capture_id, chunk_index, chunk_total, coalesce(context, '') AS c, coalesce(len(messages) = 3, false) AS three, coalesce(list_transform(messages, lambda m: m.role) = ['system', 'user', 'assistant'], false) AS roles, messages[1].content AS m1, messages[2].content AS m2, messages[3].content AS m3 FROM p)
    SELECT pair_id, len(list_filter([NOT three, three AND NOT roles, three AND roles AND NOT coalesce(m1 = '{SYSTEM}', false), three AND roles AND coalesce({_strip('m2')} = '', true), three AND roles AND coalesce({_strip('m3')} = '', true),
    source IS NULL, captured_at IS NULL, capture_id IS NULL, chunk_index IS NULL, chunk_total IS NULL, three AND c <> '' AND NOT coalesce(starts_with(m2, c), false), three AND c <> '' AND NOT coalesce(starts_with(m3, c), false)], lambda x: x))::INT AS problems FROM f"""
)
def pair_validate(spark: SparkSession, d: str) -> DataFrame:
    p = _once(spark, d)
    return p.select("pair_id", F.size(P.problems(p, SYSTEM, REQUIRED)).alias("problems"))


@query(f"SELECT pair_id, coalesce(transform_sim <= 0.85::DOUBLE, true) AS keep, CASE WHEN transform_sim > 0.95::DOUBLE THEN 'identity' WHEN length({_body(3)}) > 3.0::DOUBLE * length({_body(2)}) THEN 'inflation' END AS reason FROM {_PAIRS}")
def output_gates(spark: SparkSession, d: str) -> DataFrame:
    m, c = F.col("messages"), F.col("context")
    return _once(spark, d).select("pair_id", P.near_identity(F.col("transform_sim")).alias("keep"), P.drop_reason(F.col("transform_sim"), P.extract(m, c, "slop"), P.extract(m, c, "target")).alias("reason"))


@query("SELECT count(*) AS rows, count(DISTINCT pair_id) AS ids, epoch_us(min(first_at)) AS first_at FROM (SELECT pair_id, min(ingested_at) AS first_at FROM pairs GROUP BY pair_id)")
def dedup_first(spark: SparkSession, d: str) -> DataFrame:
    return _once(spark, d).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("pair_id").alias("ids"), F.unix_micros(F.min("ingested_at")).alias("first_at"))


@query(
    f"""WITH w AS (SELECT output_id, substr(sha256(coalesce(generator, '') || {_Z} || coalesce(slop_strategy, '') || {_Z} || coalesce(text, '')), 1, 16) AS k FROM gen_outputs), e AS (SELECT substr(sha256(coalesce(generator, '') || {_Z} || coalesce(slop_strategy, '') || {_Z} || coalesce({_body(2)}, '')), 1, 16) AS k FROM pairs)
    SELECT k AS key, min(output_id) AS output_id FROM w WHERE k NOT IN (SELECT k FROM e) GROUP BY k"""
)
def resume_cells(spark: SparkSession, d: str) -> DataFrame:
    """Generated drafts whose cell is not in the pairs yet, each cell once, the first by output_id."""
    key = lambda t: F.substring(F.sha2(F.concat_ws("\x00", F.coalesce("generator", F.lit("")), F.coalesce("slop_strategy", F.lit("")), F.coalesce(t, F.lit(""))), 256), 1, 16).alias("key")
    w = table(spark, d, "gen_outputs").select(key(F.col("text")), "output_id")
    return P.resume(w, table(spark, d, "pairs").select(key(P.extract(F.col("messages"), F.col("context"), "slop"))), "key", [F.col("output_id")])


@query(f"SELECT DISTINCT target_id FROM targets t WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE {_strip(_body(3))} = {_strip('t.text')})")
def coverage(spark: SparkSession, d: str) -> DataFrame:
    """Targets that no pair rewrites to."""
    return P.uncovered(table(spark, d, "targets").select("target_id", "text"), table(spark, d, "pairs").select("messages", "context")).select("target_id").distinct()


@query("SELECT DISTINCT pair_id, source, captured_at FROM (SELECT *, max(captured_at) OVER (PARTITION BY source) AS top FROM pairs) WHERE source IS NULL OR top IS NULL OR captured_at = top")
def tidy_latest(spark: SparkSession, d: str) -> DataFrame:
    return P.latest_per_source(table(spark, d, "pairs").select("pair_id", "source", "captured_at").distinct())


@query(f"SELECT source, count(*) AS pairs, count(DISTINCT capture_id) AS saves FROM {_PAIRS} GROUP BY source")
def pairs_by_source(spark: SparkSession, d: str) -> DataFrame:
    return P.pairs_by_source(_once(spark, d))


@query(f"SELECT count(*) AS pairs, count(*) FILTER (coalesce(context, '') <> '') AS with_context FROM {_PAIRS}")
def corpus_counts(spark: SparkSession, d: str) -> DataFrame:
    return P.corpus_counts(_once(spark, d))


@query(f"SELECT pair_id FROM {_PAIRS} QUALIFY row_number() OVER (PARTITION BY coalesce({_strip(_body(3))}, '') ORDER BY pair_id) <= 2")
def per_target_cap(spark: SparkSession, d: str) -> DataFrame:
    return P.per_target_cap(_once(spark, d).select("pair_id", "messages", "context"), 2, [F.col("pair_id")]).select("pair_id")


@query(f"SELECT pair_id, list_sort(list_concat(regexp_extract_all({_body(3)}, '{text.LINK_TARGET}', 1), list_concat(regexp_extract_all({_body(3)}, '{text.BARE_URL}', 1), regexp_extract_all({_body(3)}, '{text.CITE_KEY}')))) AS anchors FROM {_PAIRS} WHERE messages[3].content IS NOT NULL")
def anchors(spark: SparkSession, d: str) -> DataFrame:
    m, c = F.col("messages"), F.col("context")
    return _once(spark, d).filter(P.content(m, 2).isNotNull()).select("pair_id", F.array_sort(text.anchors(P.extract(m, c, "target"))).alias("anchors"))


@query(
    f"""WITH a AS (SELECT pair_id, {_anchors(_body(2))} AS want, {_anchors(_body(3))} AS have FROM {_PAIRS})
    SELECT pair_id, lost FROM (SELECT pair_id, list_sort(list_filter(list_distinct(want), lambda k: len(list_filter(have, lambda x: x = k)) < len(list_filter(want, lambda y: y = k)))) AS lost FROM a) WHERE len(lost) > 0"""
)
def anchors_lost(spark: SparkSession, d: str) -> DataFrame:
    m, c = F.col("messages"), F.col("context")
    return _once(spark, d).select("pair_id", text.missing_anchors(P.extract(m, c, "slop"), P.extract(m, c, "target")).alias("lost")).filter(F.size("lost") > 0)


@query("SELECT generator, count(*) AS outputs FROM (SELECT DISTINCT output_id, generator FROM gen_outputs) GROUP BY generator")
def count_by_generator(spark: SparkSession, d: str) -> DataFrame:
    return S.count_by(table(spark, d, "gen_outputs").select("output_id", "generator").distinct(), "generator", "outputs")


@query("SELECT DISTINCT output_id, length(text) // 4 AS tokens, CASE WHEN age < 60 THEN 'just now' WHEN age < 3600 THEN (age // 60)::VARCHAR || 'm ago' WHEN age < 86400 THEN (age // 3600)::VARCHAR || 'h ago' WHEN age < 1209600 THEN (age // 86400)::VARCHAR || 'd ago' ELSE (age // 604800)::VARCHAR || 'w ago' END AS age FROM (SELECT output_id, text, floor(epoch(TIMESTAMPTZ '2030-01-01 00:00:00+00') - epoch(created_at))::BIGINT AS age FROM gen_outputs)")
def ages_and_tokens(spark: SparkSession, d: str) -> DataFrame:
    age = F.lit(1893456000) - F.ceil(F.unix_micros("created_at") / 1_000_000)
    return table(spark, d, "gen_outputs").select("output_id", text.estimate_tokens(F.col("text")).alias("tokens"), text.humanize_age(age).alias("age")).distinct()


@query(
    f"""WITH p AS {_PAIRS}, c AS (SELECT *, coalesce(source IS NOT NULL AND captured_at IS NOT NULL AND coalesce({_strip('messages[3].content')}, '') <> '', false) AS ok FROM p)
    SELECT CASE WHEN NOT ok THEN 'invalid' WHEN coalesce(synthetic, false) THEN 'selector' ELSE 'kept' END AS stage, count(*) AS n FROM c GROUP BY 1"""
)
def drop_accounts(spark: SparkSession, d: str) -> DataFrame:
    p = _once(spark, d)
    bad = F.filter(F.array(F.when(F.col("source").isNull() | F.col("captured_at").isNull() | (F.coalesce(text.strip(P.content(F.col("messages"), 2)), F.lit("")) == ""), F.lit("x"))), lambda x: x.isNotNull())
    none = spark.createDataFrame([], "post string")
    return corpus.training_corpus(p, bad, none, selector=~F.coalesce("synthetic", F.lit(False)))[1]


@query(f"SELECT pair_id, CASE WHEN source IN (SELECT unnest(val_posts) FROM train_corpus) THEN 'val' ELSE 'train' END AS part FROM {_PAIRS} WHERE source IS NOT NULL")
def val_split(spark: SparkSession, d: str) -> DataFrame:
    val = table(spark, d, "train_corpus").select(F.explode("val_posts").alias("post"))
    none = F.array().cast("array<string>")
    return corpus.training_corpus(_once(spark, d).filter("source is not null"), none, val)[0].select("pair_id", "part")


@query()
def training_manifest(spark: SparkSession, d: str) -> DataFrame:
    import json

    pairs = table(spark, d, "pairs")
    val = table(spark, d, "train_corpus").select(F.explode("val_posts").alias("post"))
    m, c = F.col("messages"), F.col("context")
    # texts are read where they lie; what is shuffled is their problems, hash and size
    slim = pairs.select("pair_id", "source", "ingested_at", P.problems(pairs, SYSTEM, REQUIRED).alias("problems"), P.target_hash(m, c).alias("target"), corpus.chars(m).alias("chars"))
    once = P.first_by_key(slim, "pair_id", [F.col("ingested_at")])
    kept, _ = corpus.training_corpus(once, F.col("problems"), val, per_target=lambda rows: P.per_target_cap(rows, 4, [F.col("pair_id")], F.col("target")))
    return spark.createDataFrame([(json.dumps(corpus.manifest(kept, corpus.data_hash(pairs.drop("ingested_at"), once=True), {"epochs": 3}, size=F.col("chars"))),)], "manifest string")


# --- scores ------------------------------------------------------------------
@query(f"SELECT vec_id, round({_SCORE_SQL}, 9) AS score, len(list_filter([0.51, 0.55, 0.59, 0.65]::DOUBLE[], lambda e: round({_SCORE_SQL}, 9) >= e))::INT AS bucket FROM embeddings")
def head_score(spark: SparkSession, d: str) -> DataFrame:
    s = _scored(spark, d).select("vec_id", F.round("score", 9).alias("score"))
    return s.withColumn("bucket", S.bucketize(F.col("score"), EDGES))


@query(f"SELECT CASE WHEN label = 1 THEN 'draft' ELSE 'author' END AS side, round(quantile_cont(score, 0.5), 6) AS p50, round(quantile_cont(score, 0.75), 6) AS p75, round(quantile_cont(score, 0.95), 6) AS p95 FROM {_SCORED_SQL} GROUP BY 1")
def quantile_edges(spark: SparkSession, d: str) -> DataFrame:
    q = S.quantile_edges(_scored(spark, d).withColumn("side", model.label_text(F.col("label"))))
    return q.select("side", *[F.round(c, 6).alias(c) for c in ("p50", "p75", "p95")])


_PAIRWISE = f"SELECT pair_row, {{by}} max(CASE WHEN label = 1 THEN score END) AS d, max(CASE WHEN label = 0 THEN score END) AS a FROM {_SCORED_SQL} GROUP BY pair_row {{group}}"


@query(f"SELECT round(avg(CASE WHEN d > a THEN 1.0::DOUBLE WHEN d = a THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END), 6) AS pairwise_accuracy, count(*) AS pairs FROM ({_PAIRWISE.format(by='', group='')}) WHERE d IS NOT NULL AND a IS NOT NULL")
def pairwise_accuracy(spark: SparkSession, d: str) -> DataFrame:
    return model.pairwise_accuracy(_scored(spark, d)).withColumn("pairwise_accuracy", F.round("pairwise_accuracy", 6))


@query(f"SELECT synthetic, round(avg(CASE WHEN d > a THEN 1.0::DOUBLE WHEN d = a THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END), 6) AS pairwise_accuracy, count(*) AS pairs FROM ({_PAIRWISE.format(by='synthetic,', group=', synthetic')}) WHERE d IS NOT NULL AND a IS NOT NULL GROUP BY synthetic")
def provenance_facet(spark: SparkSession, d: str) -> DataFrame:
    return model.provenance(_scored(spark, d)).withColumn("pairwise_accuracy", F.round("pairwise_accuracy", 6))


@query(f"SELECT round((SELECT sum((p.score > q.score)::DOUBLE + 0.5::DOUBLE * (p.score = q.score)::DOUBLE) FROM {_SCORED_SQL} p, {_SCORED_SQL} q WHERE p.label = 1 AND q.label = 0) / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)), 6) AS auc, count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives FROM {_SCORED_SQL}")
def auc_midrank(spark: SparkSession, d: str) -> DataFrame:
    return model.auc(_scored(spark, d)).withColumn("auc", F.round("auc", 6))


def _score_rows(spark: SparkSession, d: str) -> DataFrame:
    """Score records made of the pairs' covariates: a judge's score by length, a linter where the model is known."""
    p = _once(spark, d)
    n = F.length(P.content(F.col("messages"), 2))
    return p.select(F.col("pair_id").cast("string").alias("id"), F.col("split"), F.col("gen.model").alias("model"), F.struct((F.lit(1) + F.coalesce(n, F.lit(0)) % 5).cast("int").alias("score")).alias("judge"), F.struct(F.col("gen").isNotNull().alias("available"), (F.coalesce(n, F.lit(0)) % 7).cast("int").alias("alerts")).alias("vale"), F.struct(F.col("transform_sim").alias("score")).alias("detector"))


_SCORES_SQL = f"(SELECT pair_id, split, gen.model AS model, 1 + coalesce(length(messages[3].content), 0) % 5 AS judge, gen IS NOT NULL AS available, coalesce(length(messages[3].content), 0) % 7 AS alerts, transform_sim AS sim FROM {_PAIRS})"
_MEANS = "count(*) AS n, round(avg(judge), 6) AS mean_judge, round(avg(CASE WHEN available THEN alerts END), 6) AS mean_vale, round(avg(sim), 6) AS mean_detector"


@query(f"SELECT split AS field, CASE WHEN grouping(f) = 0 THEN f END AS facet, grouping(f)::INT AS level, {_MEANS} FROM (SELECT *, coalesce(model, 'null') AS f FROM {_SCORES_SQL}) GROUP BY GROUPING SETS ((split), (split, f))")
def facet_summary(spark: SparkSession, d: str) -> DataFrame:
    m = [F.count(F.lit(1)).alias("n"), F.round(F.avg("judge.score"), 6).alias("mean_judge"), F.round(F.avg(F.when(F.col("vale.available"), F.col("vale.alerts"))), 6).alias("mean_vale"), F.round(F.avg("detector.score"), 6).alias("mean_detector")]
    return S.facet_summary(_score_rows(spark, d), m, S.facet_key(F.col("model"), "string"), F.col("split"))


@query(f"SELECT split, {_MEANS} FROM {_SCORES_SQL} GROUP BY split")
def score_means(spark: SparkSession, d: str) -> DataFrame:
    a = S.aggregate(_score_rows(spark, d), ["split"])
    return a.select("split", "n", *[F.round(c, 6).alias(c) for c in ("mean_judge", "mean_vale", "mean_detector")])


@query("SELECT o.output_id, coalesce(t.text, '(text unavailable)') AS text FROM (SELECT DISTINCT output_id, target_id FROM gen_outputs) o LEFT JOIN (SELECT target_id, arg_max(coalesce(text, '(text unavailable)'), loaded_at) AS text FROM targets GROUP BY 1) t ON t.target_id = o.target_id")
def score_join(spark: SparkSession, d: str) -> DataFrame:
    """Records joined to their text, with a note where it is missing; the last of repeated texts."""
    t = table(spark, d, "targets").select(F.col("target_id").alias("id"), F.coalesce("text", F.lit("(text unavailable)")).alias("text"), F.col("loaded_at").alias("ord"))
    o = table(spark, d, "gen_outputs").select("output_id", F.col("target_id").alias("id")).distinct()
    return S.with_texts(o, t).select("output_id", "text")


@query(
    """SELECT m AS model, count(*) AS pairs, round(sum(meta.cost), 6) AS cost, round(sum(meta.gen_seconds), 6) AS gen_seconds, sum(meta.prompt_tokens)::BIGINT AS prompt_tokens, sum(meta.completion_tokens)::BIGINT AS completion_tokens, sum(meta.reasoning_tokens)::BIGINT AS reasoning_tokens, sum(meta.cached_tokens)::BIGINT AS cached_tokens,
    round(sum(meta.cost) / count(*), 9) AS cost_per_pair, round(sum(meta.cached_tokens) / nullif(sum(meta.prompt_tokens), 0), 9) AS cached_share, round(sum(meta.completion_tokens) / nullif(sum(meta.gen_seconds), 0), 9) AS tokens_per_second FROM (SELECT DISTINCT output_id, meta, meta.model AS m FROM gen_outputs) GROUP BY m"""
)
def gen_economics(spark: SparkSession, d: str) -> DataFrame:
    g = S.gen_economics(table(spark, d, "gen_outputs").select("output_id", "meta").distinct().select("meta.*"))
    return g.select("model", "pairs", *[F.round(c, 6).alias(c) if c in ("cost", "gen_seconds") else F.round(c, 9).alias(c) if c in ("cost_per_pair", "cached_share", "tokens_per_second") else F.col(c) for c in g.columns[2:]])


@query("SELECT user_id AS id, count(*) FILTER (s = 'suggestion') AS suggestion, count(*) FILTER (s = 'warning') AS warning, count(*) FILTER (s = 'error') AS error FROM (SELECT user_id, ['suggestion', 'warning', 'error', 'other'][event_id % 4 + 1] AS s FROM events) GROUP BY 1")
def alerts_by_severity(spark: SparkSession, d: str) -> DataFrame:
    names = F.array(*[F.lit(x) for x in ("suggestion", "warning", "error", "other")])
    return S.alerts_by_severity(table(spark, d, "events").select(F.col("user_id").alias("id"), F.get(names, (F.col("event_id") % 4).cast("int")).alias("severity")))


@query("SELECT event_type AS key, round(arg_max(value, event_id), 6) AS value FROM events GROUP BY 1")
def final_metrics(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "events").select(F.col("event_id").alias("line_no"), F.col("event_type").alias("key"), "value")
    return jsonl.final_metrics(log).withColumn("value", F.round("value", 6))


@query("SELECT DISTINCT output_id, meta.model AS model, meta.reasoning_effort AS reasoning_effort, round(meta.temperature, 6) AS temperature, meta.finish_reason AS finish_reason, meta.prompt_tokens AS prompt_tokens, meta.completion_tokens AS completion_tokens, generator, slop_strategy FROM gen_outputs")
def covariates(spark: SparkSession, d: str) -> DataFrame:
    """Nested covariates flattened to one wide row a record."""
    g = table(spark, d, "gen_outputs")
    wide = g.select(*S.flatten(g.drop("text", "created_at", "target_id").schema)).distinct()
    return wide.select("output_id", F.col("`meta.model`").alias("model"), F.col("`meta.reasoning_effort`").alias("reasoning_effort"), F.round("`meta.temperature`", 6).alias("temperature"), F.col("`meta.finish_reason`").alias("finish_reason"), F.col("`meta.prompt_tokens`").alias("prompt_tokens"), F.col("`meta.completion_tokens`").alias("completion_tokens"), "generator", "slop_strategy")


@query(
    "SELECT DISTINCT output_id, meta.model AS model, meta.reasoning_effort AS reasoning_effort, meta.completion_tokens AS completion_tokens, meta.finish_reason AS finish_reason, generator, meta.prompt_tokens AS prompt_tokens, slop_strategy, round(meta.temperature, 6) AS temperature FROM gen_outputs"
)
def covariate_table(spark: SparkSession, d: str) -> DataFrame:
    """The wide table without its constant columns."""
    g = covariates(spark, d).withColumn("corpus", F.lit("main"))
    return S.covariate_table(g, "output_id", ["model", "reasoning_effort"])[0]


@query("SELECT target_id, arg_min(output_id, (length(text), output_id)) AS output_id FROM (SELECT DISTINCT output_id, target_id, text FROM gen_outputs WHERE text IS NOT NULL) GROUP BY 1")
def best_of_n(spark: SparkSession, d: str) -> DataFrame:
    """The shortest draft of each target, the first of equals."""
    c = table(spark, d, "gen_outputs").filter("text is not null").select("target_id", F.col("output_id").alias("idx"), F.length("text").alias("score"), "text").distinct()
    return corpus.best_of(c, ["target_id"]).select("target_id", F.col("idx").alias("output_id"))


# --- difflib, segmentation, models, state ------------------------------------
@query()
def segments(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "targets").filter("text is not null").select("target_id", "text").distinct()
    return t.select("target_id", F.explode(blocks.segments_udf("text")).alias("s")).select("target_id", "s.ord", "s.text", "s.editable")


@query()
def prose_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "posts").filter("raw is not null").select("post_id", "raw").distinct()
    return p.select("post_id", F.explode(blocks.prose_spans_udf("raw")).alias("s")).select("post_id", "s.start", "s.end", "s.text")


@query()
def transform_similarity(spark: SparkSession, d: str) -> DataFrame:
    m, c = F.col("messages"), F.col("context")
    return _once(spark, d).repartition(spark.sparkContext.defaultParallelism, "pair_id").select("pair_id", blocks.similarity_udf(P.extract(m, c, "slop"), P.extract(m, c, "target")).alias("similarity"))


@query()
def capture_diff(spark: SparkSession, d: str) -> DataFrame:
    """Changed paragraphs between the draft and the rewrite of each pair."""
    m, c = F.col("messages"), F.col("context")
    return P.diff_captures(_once(spark, d).select(F.col("pair_id").cast("string").alias("source"), P.extract(m, c, "slop").alias("before"), P.extract(m, c, "target").alias("after")))


def _fold_spaces(t: str, n: int) -> list[str]:
    """A stand-in styler: candidates with white space folded, the last one without its links."""
    import re

    folded = re.sub(r"[ \t]+", " ", t)
    return [folded, re.sub(r"\]\([^)]*\)", "]", folded)][:n]


@query()
def rewrite_round(spark: SparkSession, d: str) -> DataFrame:
    """Documents rewritten chunk by chunk with the anchor guard and do-no-harm."""
    return corpus.rewrite(spread(table(spark, d, "documents").select("doc_id", "text")), _fold_spaces, lambda t: float(len(t)))


@query(
    """WITH RECURSIVE t AS (SELECT *, row_number() OVER (PARTITION BY arm ORDER BY item, tokens) AS k FROM (SELECT DISTINCT coalesce(generator, '?') AS arm, output_id AS item, coalesce(length(text), 0) // 4 AS tokens FROM gen_outputs)),
    r AS (SELECT arm, k, item, 0 AS session, 0 AS turn, tokens AS used FROM t WHERE k = 1 UNION ALL
    SELECT t.arm, t.k, t.item, r.session + f.fresh, CASE WHEN f.fresh = 1 THEN 0 ELSE r.turn + 1 END, CASE WHEN f.fresh = 1 THEN t.tokens ELSE r.used + t.tokens END FROM r JOIN t ON t.arm = r.arm AND t.k = r.k + 1, LATERAL (SELECT CASE WHEN r.turn + 1 >= 16 OR r.used + t.tokens > 32000 THEN 1 ELSE 0 END AS fresh) f)
    SELECT arm, session::INT AS session, turn::INT AS turn, item::VARCHAR AS item FROM r"""
)
def session_budget(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "gen_outputs").select(F.coalesce("generator", F.lit("?")).alias("arm"), F.col("output_id").alias("item"), F.coalesce(text.estimate_tokens(F.col("text")), F.lit(0)).alias("tokens")).distinct()
    return corpus.session_plan(t, 32_000, 16, ["item"])


@query(
    f"""SELECT 'o' || output_id AS id, coalesce(nullif(regexp_extract(text, '\\b([1-5])\\b', 1), '')::INT, 3) AS score, {_strip('text')} AS rationale FROM (SELECT DISTINCT output_id, text FROM gen_outputs WHERE text IS NOT NULL)
    UNION ALL SELECT 'e' || event_id, coalesce(nullif(regexp_extract(props, '\\b([1-5])\\b', 1), '')::INT, 3), props FROM events
    UNION ALL SELECT 'm' || output_id, greatest(1, least(5, n // 60))::INT, 'after ' || n FROM (SELECT DISTINCT output_id, coalesce(meta.completion_tokens, 0) AS n, text FROM gen_outputs)"""
)
def judge_replies(spark: SparkSession, d: str) -> DataFrame:
    """Judge replies of three kinds: free text, JSON without a score, and a score in JSON after a text."""
    g = table(spark, d, "gen_outputs").select("output_id", "text", F.coalesce("meta.completion_tokens", F.lit(0)).alias("n")).distinct()
    free = g.filter("text is not null").select(F.concat(F.lit("o"), F.col("output_id")).alias("id"), F.col("text").alias("reply")).distinct()
    other = table(spark, d, "events").select(F.concat(F.lit("e"), F.col("event_id")).alias("id"), F.col("props").alias("reply"))
    scored = g.select(F.concat(F.lit("m"), F.col("output_id")).alias("id"), F.concat(F.coalesce("text", F.lit("")), F.lit(" So: "), F.to_json(F.struct(F.floor(F.col("n") / 60).alias("score"), F.concat(F.lit("after "), F.col("n")).alias("rationale")))).alias("reply"))
    return free.unionByName(other).unionByName(scored).select("id", blocks.judge_reply_udf("reply").alias("j")).select("id", "j.score", "j.rationale")


@query(
    f"""WITH p AS (SELECT pair_id, coalesce(source, '?') AS post, coalesce(synthetic, false) AS synthetic, {_strip(_body(2))} AS a, {_strip(_body(3))} AS b FROM {_PAIRS} WHERE coalesce(transform_sim <= 0.85::DOUBLE, true))
    SELECT pair_id || ':' || label AS row_id, pair_id AS pair_row, post, CASE WHEN label = 1 THEN a ELSE b END AS text, label, synthetic, false AS is_free FROM p, (SELECT unnest([0, 1])::INT AS label) WHERE coalesce(a, '') <> '' AND coalesce(b, '') <> ''"""
)
def dataset_rows(spark: SparkSession, d: str) -> DataFrame:
    return model.assemble(_once(spark, d))


class _Hashes(dict):
    """The hash of each word, computed at first sight."""

    def __missing__(self, word: str) -> int:
        h = self[word] = zlib.crc32(word.encode())
        return h


def hashed_words(texts: list[str], size: int = 64) -> np.ndarray:
    """A stand-in encoder: signed counts of hashed words."""
    words = [t.lower().split() for t in texts]
    n = [len(w) for w in words]
    h = np.fromiter(map(_Hashes().__getitem__, itertools.chain.from_iterable(words)), np.int64, sum(n))
    at = np.repeat(np.arange(len(n)) * size, n) + h % size
    return np.bincount(at, np.where(h & 0x8000, 1.0, -1.0), len(n) * size).reshape(-1, size)


@query()
def classifier(spark: SparkSession, d: str) -> DataFrame:
    """Dataset, embedding, nested choice of C, balanced fit, held-out metrics by post."""
    rows = stored(model.embed(model.assemble(_once(spark, d)), hashed_words, batch=1024).drop("text"), "embedded")
    held = splits.held_out(rows.select("post"), 0.2)
    return model.evaluate_holdout(rows, held)


@query(
    """SELECT CASE WHEN event_id % 10 = 0 THEN '{"id":"' || event_id || '","meta":{"model":"length"}}' ELSE '{"id":"' || event_id || '","scores":[' || round(length(event_type) / 100.0::DOUBLE, 6) || ',' || round(length(props) / 100.0::DOUBLE, 6) || ']}' END AS value FROM events"""
)
def serve_lines(spark: SparkSession, d: str) -> DataFrame:
    """The line scorer's answers over the events as requests (the stream's function on a table)."""
    lines = table(spark, d, "events").select(F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.when(F.col("event_id") % 10 == 0, "meta").otherwise("score").alias("op"), F.array(F.col("event_type"), F.col("props")).alias("texts"))).alias("value"))
    return streams.answers(lines, lambda t: F.round(F.length(t) / 100.0, 6), {"model": "length"})


@query(
    """WITH e AS (SELECT user_id::VARCHAR AS source, ['open', 'save', 'save', 'drop'][event_id % 4 + 1] AS op, printf('%012d', event_id) AS tm, props AS content FROM events),
    n AS (SELECT *, count(*) FILTER (op = 'drop') OVER (PARTITION BY source ORDER BY tm) AS drops FROM e),
    o AS (SELECT *, first_value(CASE WHEN op = 'open' THEN tm END IGNORE NULLS) OVER w AS opened, first_value(CASE WHEN op = 'open' THEN content END IGNORE NULLS) OVER w AS before FROM n WINDOW w AS (PARTITION BY source, drops ORDER BY tm ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT source, opened AS snapped_at, arg_max(before, tm) AS before, arg_max(content, tm) AS after, 'save' AS reason FROM o WHERE op = 'save' AND opened IS NOT NULL AND content <> before GROUP BY source, opened"""
)
def capture_sessions(spark: SparkSession, d: str) -> DataFrame:
    """The last save of every capture session in the event log (open, save, drop by user)."""
    op = F.get(F.array(F.lit("open"), F.lit("save"), F.lit("save"), F.lit("drop")), (F.col("event_id") % 4).cast("int"))
    e = table(spark, d, "events").select(F.col("user_id").cast("string").alias("source"), op.alias("op"), F.format_string("%012d", "event_id").alias("at"), F.col("props").alias("content"))
    return streams.capture_batch(e)


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1")
def latest_version(spark: SparkSession, d: str) -> DataFrame:
    return streams.latest_version(table(spark, d, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id").select("user_id", "event_id", "event_type")
