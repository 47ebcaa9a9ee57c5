"""Roles, splits and experiment arms: deterministic assignment by hash."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from draftloom.functions import keys
from draftloom.operators import ranks
from draftloom.operators.joins import lookup

ROLES = ["eval", "styler", "detector"]
VERSION = 1


def make_splits(posts: DataFrame, eval_frac: float = 0.1, detector_frac: float = 0.4, seed: int = 0, candidates: DataFrame | None = None) -> dict:
    """The splits contract of a ``post`` column: a pinned eval list and the hash rule for the rest.

    The list of posts is a dimension (one row a file), shuffled on the driver
    with Python's generator, so that a seed gives the same list everywhere. The
    eval list is sized on all posts, drawn from the candidates.
    """
    for name, f in (("eval_frac", eval_frac), ("detector_frac", detector_frac)):
        if not 0 < f < 1:
            raise ValueError(f"{name} must be in (0, 1), got {f}")
    labels = lambda df: sorted(r[0] for r in df.select("post").filter("post is not null").distinct().toLocalIterator())
    every = labels(posts)
    pool = labels(candidates) if candidates is not None else list(every)
    if not every or not pool:
        raise ValueError("no posts to split")
    random.Random(seed).shuffle(pool)
    return {
        "schema_version": VERSION, "created_at": dt.datetime.now(dt.timezone.utc).isoformat(), "seed": seed,
        "eval_posts": sorted(pool[: max(1, round(len(every) * eval_frac))]), "rest_rule": {"kind": "hash", "detector_frac": detector_frac, "salt": str(seed)},
    }


def hash_role(source: Column, salt: str = "0", detector_frac: float = 0.4) -> Column:
    return F.when(keys.role_unit(salt, source) < detector_frac, F.lit("detector")).otherwise(F.lit("styler"))


def with_role(rows: DataFrame, splits: dict, source: str = "source") -> DataFrame:
    """Adds ``role``: eval for pinned posts, else by hash; a null source is hashed as '?'."""
    rule = splits["rest_rule"]
    pinned = rows.sparkSession.createDataFrame([(p,) for p in splits["eval_posts"]], "_pinned string")
    j = rows.join(pinned, F.col(source) == F.col("_pinned"), "left")
    return j.withColumn("role", F.when(F.col("_pinned").isNotNull(), F.lit("eval")).otherwise(hash_role(F.coalesce(F.col(source), F.lit("?")), rule["salt"], rule["detector_frac"]))).drop("_pinned")


def role_summary(rows: DataFrame) -> DataFrame:
    """(role, posts, pairs, pairs_real, pairs_synth) of rows with role, source and synthetic; all three roles are there."""
    per = rows.groupBy("role").agg(
        F.countDistinct("source").alias("posts"), F.count(F.lit(1)).alias("pairs"), F.count_if(~F.coalesce("synthetic", F.lit(False))).alias("pairs_real"), F.count_if(F.coalesce("synthetic", F.lit(False))).alias("pairs_synth")
    )
    dim = rows.sparkSession.createDataFrame([(r,) for r in ROLES], "role string")
    return dim.join(per, "role", "left").na.fill(0)


def danger_report(summary: DataFrame, stale: DataFrame, min_posts: int = 10, min_pairs: int = 50, min_cv_posts: int = 8) -> DataFrame:
    """(role, warning) rows of strata too small or too synthetic to trust; ``stale`` holds pinned posts without pairs."""
    rules = F.array(
        F.when(F.col("posts") < min_posts, F.lit("few posts")),
        F.when(F.col("pairs") < min_pairs, F.lit("few pairs")),
        F.when((F.col("role") == "eval") & (F.col("pairs") > 0) & (F.col("pairs_real") == 0), F.lit("eval is all synthetic")),
        F.when((F.col("role") == "detector") & (F.col("posts") < min_cv_posts), F.lit("cross validation unstable")),
    )
    a = summary.select("role", F.explode(F.filter(rules, lambda x: x.isNotNull())).alias("warning"))
    b = stale.agg(F.count(F.lit(1)).alias("n")).filter("n > 0").select(F.lit("eval").alias("role"), F.lit("stale pinned posts").alias("warning"))
    return a.unionByName(b)


def held_out(posts: DataFrame, frac: float, seed: int = 0, pinned: list[str] | DataFrame | None = None) -> DataFrame:
    """(post) of a by-post hold-out: the pinned posts that exist, else the share with the smallest seeded hash; none for a share of 0.

    Everything else is training data. Null posts are never held out.
    """
    every = posts.select("post").filter("post is not null").distinct()
    if pinned is not None:
        names = pinned if isinstance(pinned, DataFrame) else posts.sparkSession.createDataFrame([(p,) for p in pinned], "post string")
        return every.join(names.select("post").distinct(), "post", "left_semi")
    if not frac or frac <= 0:
        return every.filter("false")
    rows = every.select("post", F.lit(0).alias("_s"), ranks.hash60(F.lit(str(seed)), F.col("post")).alias("_u"))
    return ranks.smallest_share(rows.withColumnRenamed("_s", "sample"), "sample", "_u", "post", frac).select("post")


def present(posts: DataFrame, among: DataFrame) -> DataFrame:
    """Distinct posts that are in both tables (post)."""
    return posts.select("post").intersect(among.select("post"))


def remaining(posts: DataFrame, without: DataFrame) -> DataFrame:
    """Distinct posts that are not among the others."""
    return posts.select("post").subtract(without.select("post"))


def shuffle_folds(posts: DataFrame, folds: int = 8, test_frac: float = 0.25, seed: int = 0) -> DataFrame:
    """(fold, post): the test posts of each shuffled fold, the share with the smallest hash of seed, fold and post."""
    every = posts.select("post").filter("post is not null").distinct().withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    rows = every.withColumn("_u", ranks.hash60(F.concat(F.lit(f"{seed}:"), F.col("fold").cast("string")), F.col("post")))
    return ranks.smallest_share(rows, "fold", "_u", "post", test_frac).select("fold", "post")


def _deal(sizes: dict[int, int], folds: int) -> list[tuple[int, list[int], list[int]]]:
    """(size, folds of its first posts, folds of the others in turn): each post, by falling size, to the lightest fold.

    Once the loads differ by less than the size, posts of that size go round.
    """
    load, out = [0] * folds, []
    for n in sorted(sizes, reverse=True):
        left, first = sizes[n], []
        while left and (max(load) - min(load) >= n > 0):
            k = min(range(folds), key=lambda i: (load[i], i))
            load[k] += n
            first.append(k)
            left -= 1
        turn = sorted(range(folds), key=lambda i: (load[i], i))
        for place, k in enumerate(turn):
            load[k] += n * (left // folds + (place < left % folds))
        out.append((n, first, turn))
    return out


def balanced_folds(sizes: DataFrame, folds: int = 4) -> DataFrame:
    """(post, fold): posts by falling size, each to the lightest fold so far. Input (post, n): one row a post.

    Only the number of posts of each size comes to the driver; posts find
    their fold by their rank in their size.
    """
    counts = {r["n"]: r["c"] for r in sizes.groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
    deal = sizes.sparkSession.createDataFrame([(n, a, b) for n, a, b in _deal(counts, folds)], "_size bigint, _first array<int>, _turn array<int>")
    r = ranks.ranked(sizes.select("post", F.col("n").cast("bigint").alias("n")), "n", ["post"], "_k")
    j = lookup(r, deal, F.col("n"), "_size", "inner")
    later = F.get("_turn", F.pmod(F.col("_k") - F.size("_first"), F.lit(folds)).cast("int"))
    return j.select("post", F.when(F.col("_k") < F.size("_first"), F.get("_first", F.col("_k").cast("int"))).otherwise(later).alias("fold"))


#: How a generator of each kind is named, as its keys have it.
ARM_NAMES = {"gpt": "{}", "local": "local-{}", "openrouter": "openrouter/{}"}


def arm_name(model: Column, kind: str = "gpt") -> Column:
    """The generator's name of an arm, which its keys are made of."""
    before, after = ARM_NAMES[kind].split("{}")
    return F.concat(F.lit(before), model, F.lit(after))


def arms(spark: SparkSession, models: list[str], strategies: list[str], efforts: list[str]) -> DataFrame:
    """(arm_idx, strategy, effort, model): the cross product, strategies slowest; repeats dropped, order kept."""
    uniq = lambda xs: list(dict.fromkeys(xs))
    rows = [(i, s, e, m) for i, (s, e, m) in enumerate((s, e, m) for s in uniq(strategies) for e in uniq(efforts) for m in uniq(models))]
    return spark.createDataFrame(rows, "arm_idx int, strategy string, effort string, model string")


def assign_arms(targets: DataFrame, arm_table: DataFrame, n_arms: int, seed: int = 0, per_generator: bool = False) -> DataFrame:
    """Each target with one arm by hash, or with every arm. The arm table is a short list that the caller wrote, so it is broadcast."""
    if per_generator:
        return targets.crossJoin(F.broadcast(arm_table))
    return targets.withColumn("arm_idx", keys.arm_index(seed, F.col("text"), n_arms)).join(F.broadcast(arm_table), "arm_idx")


def effective_context(context: Column, body: Column, dropout: float) -> Column:
    """The heading, left out for a fixed share of the bodies."""
    return F.when(keys.dropout_bucket(body) < int(dropout * 1000), F.lit("")).otherwise(F.coalesce(context, F.lit("")))
