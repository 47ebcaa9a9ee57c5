"""Pair records: extraction, validation, gates, identity, resume, capture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from draftloom.functions import text
from draftloom.functions.blocks import changes_udf


def content(messages: Column, k: int) -> Column:
    return F.get(messages, k)["content"]


def extract(messages: Column, context: Column, field: str) -> Column:
    """The named text of a pair: 'slop' (the draft) or 'target' (the rewrite), without the heading."""
    return text.pair_body(content(messages, {"slop": 1, "target": 2}[field]), context)


#: Named extractors, as the scoring commands take them; 'output' is the styler's rewrite, a column of its own.
FIELDS = {f: (lambda m, c, f=f: extract(m, c, f)) for f in ("slop", "target")} | {"output": lambda m, c: text.pair_body(F.col("output"), c)}


def problems(pairs: DataFrame, system: str, required: list[str]) -> Column:
    """What is wrong with a record (messages, context and flat meta columns), as an array of messages; [] if it is valid."""
    m = F.col("messages")
    roles = F.transform(m, lambda x: x["role"])
    three = F.coalesce(F.size(m) == 3, F.lit(False))
    triple = F.coalesce(three & (roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))), F.lit(False))
    blank = lambda k: F.coalesce(text.strip(content(m, k)) == "", F.lit(True))
    context = F.coalesce(F.col("context"), F.lit(""))
    headless = lambda k: ~F.coalesce(F.startswith(content(m, k), context), F.lit(False))
    checks = [
        (~three, F.lit("messages must be a list of exactly 3 items")),
        (three & ~triple, F.lit("message roles must be [system, user, assistant]")),
        (triple & ~F.coalesce(content(m, 0) == system, F.lit(False)), F.lit("system message is not the frozen prompt")),
        (triple & blank(1), F.lit("user content is empty")),
        (triple & blank(2), F.lit("assistant content is empty")),
        *[(F.col(k).isNull(), F.lit(f"meta missing {k}")) for k in required],
        (three & (context != "") & headless(1), F.lit("user content does not start with its context")),
        (three & (context != "") & headless(2), F.lit("assistant content does not start with its context")),
    ]
    return F.filter(F.array(*[F.when(c, msg) for c, msg in checks]), lambda x: x.isNotNull())


def near_identity(sim: Column, most: float = 0.85) -> Column:
    """Whether to keep a pair: similarity up to ``most``; a missing one is kept."""
    return F.coalesce(sim <= most, F.lit(True))


def drop_reason(sim: Column, draft: Column, output: Column, identity: float = 0.95, inflation: float = 3.0) -> Column:
    """'identity' before 'inflation' (output over so many times the draft), strictly above the bounds; null keeps the row."""
    return F.when(sim > identity, F.lit("identity")).when(F.length(output) > inflation * F.length(draft), F.lit("inflation"))


def first_by_key(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row a key, the first in the order; rows with a null key are one key. Aggregates before the shuffle."""
    cols = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_r"))
    return best.select(key, "_r.*").select(*rows.columns)


def resume(wanted: DataFrame, done: DataFrame, key: str, order: list[Column] | None = None) -> DataFrame:
    """Rows whose key is not done yet, each key once."""
    left = wanted.join(done.select(key).distinct(), key, "left_anti")
    return first_by_key(left, key, order or [F.col(c) for c in wanted.columns if c != key])


def uncovered(targets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Targets whose text is the body of no pair."""
    bodies = pairs.select(text.strip(extract(F.col("messages"), F.col("context"), "target")).alias("_body")).filter("_body is not null").distinct()
    return targets.join(bodies, text.strip(F.col("text")) == F.col("_body"), "left_anti")


def latest_per_source(pairs: DataFrame) -> DataFrame:
    """The pairs of each source's last capture, ties kept; sources without any timestamp and null sources keep all.

    The maxima are pre-aggregated and joined back, so that a hot source is
    never one window.
    """
    top = pairs.filter("source is not null").groupBy(F.col("source").alias("_s")).agg(F.max("captured_at").alias("_top"))
    j = pairs.join(top, F.col("source") == F.col("_s"), "left")
    return j.filter(F.col("source").isNull() | F.col("_top").isNull() | F.coalesce(F.col("captured_at") == F.col("_top"), F.lit(False))).select(*pairs.columns)


def pairs_by_source(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("source").agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct("capture_id").alias("saves"))


def corpus_counts(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.count(F.lit(1)).alias("pairs"), F.count_if(F.coalesce(F.col("context"), F.lit("")) != "").alias("with_context"))


def target_hash(messages: Column, context: Column) -> Column:
    """What pairs of one target text share: the hash of the rewrite's body."""
    return F.sha2(F.coalesce(text.strip(extract(messages, context, "target")), F.lit("")), 256)


def per_target_cap(pairs: DataFrame, k: int, order: list[Column], target: Column | None = None) -> DataFrame:
    """At most k pairs of one target text, the first in the order; ``target`` stands for the text where rows carry its hash only.

    A top-k: candidates are cut to k in each (text, salt) part first, so that a
    text that a third of the rows share does not meet in one task.
    """
    b = pairs.withColumn("_b", target if target is not None else target_hash(F.col("messages"), F.col("context"))).withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(64)))
    part = b.withColumn("_n", F.row_number().over(Window.partitionBy("_b", "_salt").orderBy(*order))).filter(F.col("_n") <= k)
    return part.withColumn("_n", F.row_number().over(Window.partitionBy("_b").orderBy(*order))).filter(F.col("_n") <= k).select(*pairs.columns)


def diff_captures(before_after: DataFrame, min_chars: int = 0) -> DataFrame:
    """(source, chunk_index, chunk_total, context, before, after) of the paragraphs changed between two versions.

    Input: source, before, after (whole texts). ``context`` is the nearest
    heading above the change in the new version. Equal texts give nothing.
    """
    a, b = text.paragraphs(F.col("before")), text.paragraphs(F.col("after"))
    d = before_after.select("source", a.alias("a"), b.alias("b")).withColumn("cs", F.filter(changes_udf("a", "b"), lambda c: F.length(c["after"]) >= min_chars))
    e = d.select("source", headings_above(F.col("b")).alias("h"), F.size("cs").alias("chunk_total"), F.posexplode("cs").alias("chunk_index", "c"))
    return e.select("source", "chunk_index", "chunk_total", F.get("h", F.col("c.at")).alias("context"), F.col("c.before").alias("before"), F.col("c.after").alias("after"))


def headings_above(paragraphs: Column) -> Column:
    """For each paragraph the last one before it whose first line is a heading; '' if there is none."""
    is_head = lambda p: F.regexp_like(F.substring_index(p, "\n", 1), F.lit(r"^\s{0,3}#{1,6}\s"))
    zero = F.struct(F.lit("").alias("now"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(paragraphs, zero, lambda s, p: F.struct(F.when(is_head(p), text.strip(p)).otherwise(s["now"]).alias("now"), F.concat(s["out"], F.array(s["now"])).alias("out")), lambda s: s["out"])


def union_corpora(*parts: DataFrame) -> DataFrame:
    """All rows of several corpora; columns that one lacks are null there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def first_n(rows: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first n rows in an explicit order (a top-k: no full sort reaches one task)."""
    return rows.orderBy(*order).limit(n)


def with_windows(generators: DataFrame, registry: DataFrame, default: int) -> DataFrame:
    """Adds the context window of each model from a registry (model, context_window); a default where it is not listed."""
    known = registry.groupBy("model").agg(F.max("context_window").alias("_w"))
    return generators.join(known, "model", "left").withColumn("context_window", F.coalesce("_w", F.lit(default))).drop("_w")
