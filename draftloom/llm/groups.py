"""Splits that keep related records together.

Method: hash-to-min connected components over labels, post paths, authors and
series, then weighted rendezvous hashing of components to splits. Clusters are
kept as (node, member) rows, never as arrays, so no row grows with a component.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftloom.operators.joins import lookup
from draftloom.session import checkpoint

#: Rows of a cluster above which its node is a hub; of n rows at most n / HUB are hubs', so their table is small enough to broadcast.
HUB = 100_000

#: Names that stand for no name.
PLACEHOLDERS = [
    "", "-", "--", "?", "n/a", "na", "n.a.", "n.a", "nan", "nil", "none", "null", "unknown", "staff", "anonymous", "anon",
    "tbd", "tba", "todo", "untitled", "default", "author", "series", "no author", "no series", "not set", "unset", "missing", "undefined", "misc", "various", "admin", "editor", "guest", "test", "xxx", "...", "_",
]

_SPACE = r"(?U)[\s\p{Cf}\x1c-\x1f]+"


def squeeze(c: Column) -> Column:
    """Lower case, runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(c), _SPACE, " "))


def post_key(label: Column) -> Column:
    """One spelling for every spelling of a path under the blog root.

    Back slashes, case, ``.`` and ``x/..`` steps, doubled and outer slashes and
    white space around the path do not matter. Null for null; an empty path is ''.
    """
    parts = F.transform(F.split(F.regexp_replace(squeeze(label), r"\\", "/"), "/"), lambda p: F.trim(p))
    walked = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, p: F.when(p.isin("", "."), acc)
        .when((p == "..") & (F.size(acc) > 0), F.slice(acc, F.lit(1), F.size(acc) - 1))
        .when(p == "..", acc)
        .otherwise(F.concat(acc, F.array(p))),
    )
    return F.when(label.isNotNull(), F.array_join(walked, "/"))


def author_key(name: Column) -> Column:
    """Case, spacing and the order of the parts do not matter; null where it names nobody."""
    plain = squeeze(name)
    parts = F.array_sort(F.filter(F.split(F.regexp_replace(plain, r"[,;]+", " "), " "), lambda p: p != ""))
    key = F.array_join(parts, " ")
    return F.when(name.isNotNull() & ~plain.isin(PLACEHOLDERS) & (key != "") & ~key.isin(PLACEHOLDERS), key)


def series_key(name: Column) -> Column:
    """Case and separators do not matter; null where it names no series."""
    plain = squeeze(name)
    key = F.regexp_replace(F.regexp_replace(plain, r"(?U)[^\p{L}\p{N}\p{M}]+", "-"), r"^-|-$", "")
    return F.when(name.isNotNull() & ~plain.isin(PLACEHOLDERS) & (key != "") & ~key.isin(PLACEHOLDERS), key)


def components(edges: DataFrame, max_rounds: int = 60, hub: int = HUB) -> DataFrame:
    """Connected components of (a, b) string edges: rows (node, component).

    Hash-to-min: a node v with cluster C(v) and minimum m sends C(v) to m and m
    to the rest of C(v), until nothing changes. The component is its smallest
    node. Self loops keep a node alone; null ends are dropped; an empty table
    gives none. Minima are pre-aggregated, the clusters of hubs are joined
    where they lie, and every round ends in a reliable checkpoint.
    """
    e = edges.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b")).filter("a is not null and b is not null")
    c = e.select(F.col("a").alias("v"), F.col("b").alias("u")).unionByName(e.select(F.col("b").alias("v"), F.col("a").alias("u")))
    c = c.unionByName(c.select("v", F.col("v").alias("u"))).distinct()
    c = checkpoint(c)
    seen = None
    for _ in range(max_rounds):
        low = c.groupBy("v").agg(F.min("u").alias("m"), F.count(F.lit(1)).alias("n"))
        hubs = F.broadcast(low.filter(F.col("n") > hub).select("v", "m"))  # at most rows / hub of them
        rest = c.join(hubs.select("v"), "v", "left_anti").join(low.filter(F.col("n") <= hub).select("v", "m"), "v")
        sent = c.join(hubs, "v").unionByName(rest).select(F.explode(F.array(F.struct(F.col("m").alias("v"), F.col("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("x")).select("x.v", "x.u")
        c = checkpoint(sent.unionByName(low.select("v", F.col("v").alias("u"))).distinct())
        now = c.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == seen:
            return c.groupBy("v").agg(F.min("u").alias("component")).withColumnRenamed("v", "node")
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def rendezvous(key: Column, weights: dict[str, float], seed: str = "0") -> Column:
    """The split with the highest weighted score of the key: -w / ln(u(key, split)).

    Growing or changing a weight moves only the keys that must move. Null keys
    are hashed as the text 'null'. Weights must be positive.
    """
    if not weights or min(weights.values()) <= 0:
        raise ValueError("weights must be positive")
    scores = []
    for s, w in weights.items():
        h = F.conv(F.substring(F.sha2(F.concat_ws("\x00", F.lit(seed), F.lit(s), F.coalesce(key, F.lit("null"))), 256), 1, 12), 16, 10).cast("double")
        scores.append(F.struct((F.lit(-w) / F.log((h + 0.5) / F.lit(float(16**12)))).alias("score"), F.lit(s).alias("split")))
    return F.array_max(F.array(*scores))["split"]


def source_groups(pairs: DataFrame, posts: DataFrame) -> DataFrame:
    """Rows (source, component) of every distinct non-null label of pairs, as written.

    Labels of one post, and of posts that share an author or a series directly
    or through a chain (also posts without pairs), have one component.
    """
    labels = pairs.filter("source is not null").select("source").distinct().withColumn("post", F.concat(F.lit("p:"), post_key(F.col("source"))))
    p = posts.select(
        F.concat(F.lit("p:"), post_key(F.col("source"))).alias("post"),
        F.concat(F.lit("a:"), author_key(F.col("author"))).alias("by"),
        F.concat(F.lit("s:"), series_key(F.col("series"))).alias("part"),
    ).filter("post is not null")
    edges = p.select(F.col("post").alias("a"), F.explode(F.array("by", "part", "post")).alias("b")).filter("b is not null")
    edges = edges.unionByName(labels.select(F.col("post").alias("a"), F.col("post").alias("b"))).distinct()
    return labels.join(components(edges), F.col("post") == F.col("node")).select("source", "component")


def related_sources(pairs: DataFrame, posts: DataFrame) -> DataFrame:
    """Rows (source, group_source) of groups with at least two labels; group_source is the smallest in byte order."""
    g = checkpoint(source_groups(pairs, posts))
    lead = g.groupBy("component").agg(F.min("source").alias("group_source"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return g.join(lead, "component").select("source", "group_source")


def grouped_split(pairs: DataFrame, posts: DataFrame, weights: dict[str, float] | None = None, seed: str = "0") -> DataFrame:
    """(pair_id, source, component, split): pairs of one group get one split.

    Null sources belong to no post; each such pair is its own group. Repeated
    rows of one pair_id count once (their sources are equal).
    """
    g = source_groups(pairs, posts)
    ids = pairs.groupBy("pair_id").agg(F.min("source").alias("source"))
    j = lookup(ids, g.withColumnRenamed("source", "label"), F.col("source"), "label").withColumn("component", F.coalesce("component", F.concat(F.lit("id:"), F.col("pair_id").cast("string")), F.lit("id:null")))
    return j.select("pair_id", "source", "component", rendezvous(F.col("component"), weights or {"train": 0.8, "validation": 0.1, "test": 0.1}, seed).alias("split"))
