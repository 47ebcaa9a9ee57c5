"""Posts to passages: sections, packing, hygiene, numbering, selection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftloom.functions import keys, text
from draftloom.functions.blocks import prose_udf


@dataclass(frozen=True)
class ChunkPolicy:
    """Hygiene knobs of passages."""

    min_chars: int = 80
    max_chars: int | None = 8000
    prose_only: bool = True
    markers: list[str] = field(default_factory=list)
    drop_links: bool = True
    drop_lists: bool = False
    merge: bool = False
    merge_max_chars: int = 1500
    stop_at: list[str] = field(default_factory=list)
    heading_context: bool = False


def sections(body: Column) -> Column:
    """array<struct<heading, body>>: each heading line opens a section and is not part of its body.

    One fold over the lines inside the row, so a post never leaves its row.
    """
    kind = "array<struct<heading:string,body:array<string>>>"
    zero = F.struct(F.array().cast(kind).alias("done"), F.lit("").alias("heading"), F.array().cast("array<string>").alias("lines"))

    def close(s: Column) -> Column:
        return F.concat(s["done"], F.array(F.struct(s["heading"].alias("heading"), s["lines"].alias("body"))))

    def step(s: Column, line: Column) -> Column:
        opened = F.struct(close(s).alias("done"), text.strip(line).alias("heading"), F.array().cast("array<string>").alias("lines"))
        more = F.struct(s["done"].alias("done"), s["heading"].alias("heading"), F.concat(s["lines"], F.array(line)).alias("lines"))
        return F.when(F.regexp_like(line, F.lit(text.HEADING)), opened).otherwise(more)

    out = F.aggregate(text.lines(body), zero, step, close)
    return F.filter(F.transform(out, lambda s: F.struct(s["heading"].alias("heading"), F.array_join(s["body"], "\n").alias("body"))), lambda s: (s["heading"] != "") | (text.strip(s["body"]) != ""))


def passages(posts: DataFrame, policy: ChunkPolicy = ChunkPolicy()) -> DataFrame:
    """(source, chunk_index, chunk_total, context, text) of posts (source, body).

    Cut at the named headers, keep editable prose, split into sections and
    paragraphs (packed if ``merge``), gate, number. Numbering happens in the
    row, so posts need no shuffle. Null and empty bodies give nothing.
    """
    body = text.truncate_at_headers(F.col("body"), policy.stop_at)
    p = posts.select("source", (prose_udf(body) if policy.prose_only else body).alias("b"))
    split = lambda s: text.pack(text.paragraphs(s), policy.merge_max_chars) if policy.merge else text.paragraphs(s)
    gate = lambda c: text.keep_chunk(c, policy.min_chars, policy.max_chars, policy.markers, policy.drop_links, policy.drop_lists)
    chunks = F.flatten(F.transform(sections(F.col("b")), lambda s: F.transform(F.filter(split(s["body"]), gate), lambda c: F.struct(s["heading"].alias("context"), text.strip(c).alias("text")))))
    c = p.select("source", chunks.alias("cs"))
    out = c.select("source", F.size("cs").alias("chunk_total"), F.posexplode("cs").alias("chunk_index", "c"))
    context = F.col("c.context") if policy.heading_context else F.lit("")
    return out.select("source", "chunk_index", "chunk_total", context.alias("context"), F.col("c.text").alias("text"))


def select_targets(targets: DataFrame, role: Column | None = None, wanted: str | None = None, sample_frac: float | None = None, salt: str = "0") -> DataFrame:
    """Passages of one role, and of those a growth-stable share by hash: a row's fate depends on itself only."""
    out = targets if role is None or wanted is None else targets.filter(role == wanted)
    if sample_frac is None:
        return out
    if not 0 < sample_frac <= 1:
        raise ValueError("sample_frac must be in (0, 1]")
    return out.filter(keys.hash_unit(salt, F.col("source"), F.col("text")) < sample_frac)


def sort_targets(targets: DataFrame, by: str | list[Column] = "none") -> DataFrame:
    """none, length (longest first), source (then chunk_index), or the caller's own columns."""
    if not isinstance(by, str):
        return targets.orderBy(*by)
    if by == "length":
        return targets.orderBy(F.desc(F.length("text")), "source", "chunk_index")
    if by == "source":
        return targets.orderBy("source", "chunk_index")
    if by != "none":
        raise ValueError(by)
    return targets


def summary(targets: DataFrame, text_col: str = "text", source_col: str = "source") -> DataFrame:
    """count, median (truncated), p90 (the element at int(0.9 n)), max, sum of lengths, and sources.

    Lengths are counted per value first, so the quantiles come from a histogram
    of lengths and not from a sort of all rows in one task.
    """
    n = targets.select(F.length(text_col).alias("n")).filter("n is not null").groupBy("n").agg(F.count(F.lit(1)).alias("c"))
    stats = n.agg(F.sum("c").alias("chunks"), F.max("n").alias("max_chars"), F.sum(F.col("n") * F.col("c")).alias("sum_chars"), F.percentile("n", 0.5, F.col("c")).cast("int").alias("median_chars"), F.sort_array(F.collect_list(F.struct("n", "c"))).alias("h"))
    run = F.aggregate("h", F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("int").alias("at")), lambda s, x: F.struct((s["seen"] + x["c"]).alias("seen"), F.coalesce(s["at"], F.when(s["seen"] + x["c"] > F.least(F.col("chunks") - 1, F.floor(F.col("chunks") * 0.9)), x["n"])).alias("at")))
    s = targets.agg(F.countDistinct(source_col).alias("sources"))
    return stats.withColumn("p90_chars", run["at"]).drop("h").crossJoin(s).select("chunks", "median_chars", "p90_chars", "max_chars", "sum_chars", "sources")


def histogram(rows: DataFrame, value: Column, bins: int = 10) -> DataFrame:
    """(bin, lo, hi, n): equal bins from 0 to the maximum, the last one closed; empty bins are there."""
    v = rows.select(value.cast("double").alias("v")).filter("v is not null")
    top = v.agg(F.max("v").alias("top"))
    per = v.crossJoin(F.broadcast(top)).groupBy(F.least(F.lit(bins - 1), F.floor(F.when(F.col("top") > 0, F.col("v") / F.col("top") * bins).otherwise(0.0))).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = rows.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(F.broadcast(top))
    return every.join(per, "bin", "left").select("bin", (F.col("top") / bins * F.col("bin")).alias("lo"), (F.col("top") / bins * (F.col("bin") + 1)).alias("hi"), F.coalesce("n", F.lit(0)).alias("n"))
