"""The draft-or-author classifier: dataset, metrics, balanced fit, nested choice of C."""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from draftloom.functions import text
from draftloom.operators.pairs import extract, near_identity
from draftloom.operators.splits import balanced_folds, shuffle_folds
from draftloom.session import stored

GRID = [0.01, 0.03, 0.1, 0.3, 1.0, 3.0, 10.0]

#: Dimensions, with the intercept, up to which a fit starts from all second moments; above, from their diagonal.
FULL = 257

#: Rows up to which a table of posts is broadcast.
NEAR = 200_000


def assemble(pairs: DataFrame, max_sim: float | None = 0.85, extra: DataFrame | None = None) -> DataFrame:
    """(row_id, pair_row, post, text, label, synthetic, is_free): both sides of each kept pair (1 draft, 0 author).

    Pairs with an empty side or a similarity above the bound are left out, a
    missing similarity is kept; ``extra`` (text, source) are free author texts.
    """
    p = pairs.select("pair_id", F.coalesce("source", F.lit("?")).alias("post"), F.coalesce("synthetic", F.lit(False)).alias("synthetic"), F.col("transform_sim").alias("sim"), text.strip(extract(F.col("messages"), F.col("context"), "slop")).alias("a"), text.strip(extract(F.col("messages"), F.col("context"), "target")).alias("b"))
    p = p.filter((F.coalesce("a", F.lit("")) != "") & (F.coalesce("b", F.lit("")) != ""))
    if max_sim is not None:
        p = p.filter(near_identity(F.col("sim"), max_sim))
    side = F.explode(F.array(F.struct(F.lit(1).alias("label"), F.col("a").alias("text")), F.struct(F.lit(0).alias("label"), F.col("b").alias("text")))).alias("s")
    out = p.select("pair_id", "post", "synthetic", side).select(F.concat_ws(":", F.col("pair_id").cast("string"), F.col("s.label").cast("string")).alias("row_id"), F.col("pair_id").alias("pair_row"), "post", "s.text", "s.label", "synthetic", F.lit(False).alias("is_free"))
    if extra is not None:
        free = extra.filter(F.coalesce(text.strip(F.col("text")), F.lit("")) != "")
        out = out.unionByName(free.select(F.concat(F.lit("free:"), F.xxhash64("source", "text").cast("string")).alias("row_id"), F.lit(None).cast(out.schema["pair_row"].dataType).alias("pair_row"), F.col("source").alias("post"), "text", F.lit(0).alias("label"), F.lit(False).alias("synthetic"), F.lit(True).alias("is_free")))
    return out


def embed(rows: DataFrame, encode: Callable[[list[str]], np.ndarray], text_col: str = "text", out: str = "vector", batch: int = 32) -> DataFrame:
    """Adds unit vectors by an injected encoder, loaded once a worker, in Arrow batches; null texts stay null."""

    def vectors(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            got: list = [None] * len(s)
            some = [i for i, t in enumerate(s) if t is not None]
            for k in range(0, len(some), batch):
                at = some[k : k + batch]
                v = np.asarray(encode([s.iloc[i] for i in at]), dtype=np.float64)
                v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
                for i, x in zip(at, v):
                    got[i] = x
            yield pd.Series(got)

    return rows.withColumn(out, F.pandas_udf(vectors, "array<double>")(text_col))


def pairwise_accuracy(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Share of pairs whose draft scores above its rewrite, ties a half. Input: pair_row, label, score."""
    p = scored.filter("pair_row is not null").groupBy("pair_row", *(by or [])).agg(F.max(F.when(F.col("label") == 1, F.col("score"))).alias("d"), F.max(F.when(F.col("label") == 0, F.col("score"))).alias("a"))
    win = F.when(F.col("d") > F.col("a"), 1.0).when(F.col("d") == F.col("a"), 0.5).otherwise(0.0)
    return p.filter("d is not null and a is not null").groupBy(*(by or [])).agg(F.avg(win).alias("pairwise_accuracy"), F.count(F.lit(1)).alias("pairs"))


def auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """ROC AUC with mid-ranks; null where one class is missing.

    Counts are taken per distinct score, then prefix sums are run in ranges of
    scores side by side: a range's offset comes from the totals of the ranges
    before it, so no window holds all rows.
    """
    n = scored.filter(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("s")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("q"))
    n = n.withColumn("b", F.floor(F.col("s") * 1024))
    tot = n.groupBy("b").agg(F.sum("q").alias("bq"))
    tot = tot.withColumn("before", F.coalesce(F.sum("bq").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = F.coalesce(F.sum("q").over(Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    j = n.withColumn("own", own).join(tot, "b")
    u = F.sum(F.col("p") * (F.col("before") + F.col("own") + F.col("q") / 2.0))
    return j.agg(F.try_divide(u, F.sum("p").cast("double") * F.sum("q")).alias("auc"), F.sum("p").alias("positives"), F.sum("q").alias("negatives"))


def fold_stats(folds: DataFrame, metric: str) -> DataFrame:
    """Mean and population standard deviation over folds, to 4 places."""
    return folds.agg(F.round(F.avg(metric), 4).alias("mean"), F.round(F.stddev_pop(metric), 4).alias("std"), F.count(metric).alias("folds"))


def class_weights(rows: DataFrame, label: str = "label") -> DataFrame:
    """Adds ``weight`` n / (2 n_class), so that both classes weigh the same."""
    n = rows.groupBy(F.col(label).alias("_l")).agg(F.count(F.lit(1)).alias("_n"))
    total = n.agg(F.sum("_n").alias("_t"))
    return rows.join(F.broadcast(n.crossJoin(total).withColumn("weight", F.col("_t") / (2.0 * F.col("_n")))), F.col(label) == F.col("_l")).drop("_l", "_n", "_t")


class Linear(NamedTuple):
    """A fitted head: a coefficient for each dimension and the intercept."""

    coefficients: np.ndarray
    intercept: float


def fit(rows: DataFrame, c: float = 1.0, vector: str = "vector", label: str = "label") -> Linear:
    """Balanced L2 logistic regression with inverse strength C (penalty 1 / (2 C n), none on the intercept, no standardisation)."""
    x = _blocks(rows, F.lit(0), vector, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        got = _fits(x, [(None, c)])
    finally:
        x.unpersist()
    if not got:
        raise ValueError("a fit needs rows of both labels")
    return got[None, c]


def _blocks(rows: DataFrame, group: Column, vector: str, label: str) -> RDD:
    """(group, label, n, bytes): vectors of a group and label side by side, as doubles, for as many rows as an Arrow batch has."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            g, y, v = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False), b.column(2)
            sizes = set(v.value_lengths().to_pylist())
            if len(sizes) > 1 or not all(sizes):
                raise ValueError(f"a fit needs a vector of the same size in each row, got sizes {sorted(sizes, key=str)}")
            x = v.flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            if not np.isfinite(x).all():
                raise ValueError("a fit needs vectors of finite numbers")
            out = [(k, w, x[(g == k) & (y == w)]) for k, w in sorted(set(zip(g.tolist(), y.tolist())))]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int32()) for i in (0, 1)] + [pa.array([len(o[2]) for o in out], pa.int32()), pa.array([o[2].tobytes() for o in out], pa.binary())], names=["g", "y", "n", "x"])

    r = rows.select(group.cast("int").alias("g"), F.col(label).cast("int").alias("y"), F.col(vector).cast("array<double>").alias("x"))
    return r.mapInArrow(pack, "g int, y int, n int, x binary").rdd.map(lambda b: (b[0], b[1], b[2], bytes(b[3])))


def _moments(full: int) -> Callable[[Iterator[tuple]], Iterator[dict]]:
    """{(group, label): second moments of the vectors with a 1 behind}: only their diagonal above ``full`` dimensions."""

    def of(parts: Iterator[tuple]) -> Iterator[dict]:
        got: dict = {}
        for g, y, n, raw in parts:
            x = np.hstack([np.frombuffer(raw).reshape(n, -1), np.ones((n, 1))])
            got = _merged(got, {(g, y): x.T @ x if x.shape[1] <= full else (x * x).sum(0)})
        yield got

    return of


def _merged(a: dict, b: dict) -> dict:
    if len(sizes := {len(m) for m in [*a.values(), *b.values()]}) > 1:
        raise ValueError(f"a fit needs vectors of one size, got {sorted(n - 1 for n in sizes)}")
    return a | {k: a[k] + m if k in a else m for k, m in b.items()}


def _descend(pre: np.ndarray, rounds: int = 200, tol: float = 1e-8, kept: int = 12) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """L-BFGS from 0 as a generator: yields a point, is sent the loss and gradient there, returns the optimum. ``pre``: a bound of the inverse curvature, or its diagonal."""
    scale = lambda v: pre @ v if pre.ndim == 2 else pre * v
    w = np.zeros(len(pre))
    f, g = yield w
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        if np.abs(g).max() <= tol:
            break
        q, back = g.copy(), []
        for s, y, sy in reversed(past):
            back.append(a := (s @ q) / sy)
            q -= a * y
        q = scale(q) if not past else scale(q) * (past[-1][2] / (past[-1][1] @ scale(past[-1][1])))
        for (s, y, sy), a in zip(past, reversed(back)):
            q += (a - (y @ q) / sy) * s
        if g @ q <= 0:
            past, q = [], scale(g)
        t, slope = 1.0, g @ q
        while True:
            f2, g2 = yield (to := w - t * q)
            if f2 <= f - 1e-4 * t * slope + 1e-14 * abs(f):
                break
            t /= 2
            if t < 1e-9:  # no better point can be told apart
                return w
        s, y = to - w, g2 - g
        if s @ y > 1e-300:
            past = [*past, (s, y, s @ y)][-kept:]
        w, f, g = to, f2, g2
    return w


def _fits(x: RDD, problems: list[tuple[int | None, float]]) -> dict[tuple[int | None, float], Linear]:
    """Heads of (left out group, C), all fitted in the same passes over the blocks; groups whose rest has one label are left out.

    A pass yields the loss and gradient of every head that is not done; only
    their sums reach the driver, of a size that rows and tasks don't change.
    """
    moments = x.mapPartitions(_moments(FULL)).treeReduce(_merged) if problems else {}
    ask, got, weights, penalty, runs = {}, {}, {}, {}, {}
    for k, c in problems:
        own = {y: sum(m for (g, z), m in moments.items() if z == y and g != k) for y in (0, 1)}
        if any(np.ndim(m) == 0 for m in own.values()):
            continue
        of = {y: float(m.flat[-1]) for y, m in own.items()}
        weights[k, c] = [1 / (2 * of[0]), 1 / (2 * of[1])]  # n / (2 n_class), over the n of the mean
        bound = sum(w * m for w, m in zip(weights[k, c], own.values())) / 4
        penalty[k, c] = np.append(np.full(len(bound) - 1, 1 / (c * sum(of.values()))), 0.0)
        runs[k, c] = _descend(np.linalg.inv(bound + np.diag(penalty[k, c])) if bound.ndim == 2 else 1 / (bound + penalty[k, c]))
        ask[k, c] = next(runs[k, c])
    while ask:
        names = list(ask)
        sums = x.mapPartitions(_gradients(np.column_stack([ask[p] for p in names]), np.array([weights[p] for p in names]).T, [p[0] for p in names])).treeReduce(np.add)
        for p, (f, *g) in zip(names, sums.T):
            w = ask.pop(p)
            try:
                ask[p] = runs[p].send((f + (penalty[p] * w * w).sum() / 2, np.array(g) + penalty[p] * w))
            except StopIteration as end:
                got[p] = Linear(end.value[:-1], float(end.value[-1]))
    return got


def _gradients(w: np.ndarray, weight: np.ndarray, left_out: list[int | None]) -> Callable[[Iterator[tuple]], Iterator[np.ndarray]]:
    """Per head (a column) the weighted loss, then its gradient, over the blocks of all groups but its own."""

    def of(parts: Iterator[tuple]) -> Iterator[np.ndarray]:
        out = np.zeros((len(w) + 1, w.shape[1]))
        for g, y, n, raw in parts:
            at = [i for i, k in enumerate(left_out) if k != g]
            if not at:
                continue
            x, sign = np.frombuffer(raw).reshape(n, -1), -1.0 if y else 1.0
            m = sign * (x @ w[:-1, at] + w[-1, at])
            r = (1 + np.tanh(m / 2)) * (sign / 2 * weight[y, at])
            out[0, at] += np.logaddexp(0, m).sum(0) * weight[y, at]
            out[1:-1, at] += x.T @ r
            out[-1, at] += r.sum(0)
        yield out

    return of


def head_of(model) -> dict:
    """The linear head of a fitted model, as the artifact keeps it."""
    return {"schema_version": 1, "coef": [float(x) for x in model.coefficients], "intercept": float(model.intercept)}


def predict(rows: DataFrame, head: dict, vector: str = "vector") -> DataFrame:
    from draftloom.operators.scores import linear_score

    return rows.withColumn("score", linear_score(F.col(vector), head["coef"], head["intercept"]))


def near(posts: DataFrame) -> DataFrame:
    """A table of posts, to be broadcast if it has few rows (counted), so that no vector is shuffled for it."""
    return F.broadcast(posts) if posts.limit(NEAR + 1).count() <= NEAR else posts


def subset(rows: DataFrame, keep: DataFrame) -> DataFrame:
    """The rows of the posts (post) to keep."""
    return rows.join(keep.select("post").distinct(), "post", "left_semi")


def sized_posts(rows: DataFrame) -> DataFrame:
    """(post, n): the rows of each post."""
    return rows.groupBy("post").agg(F.count(F.lit(1)).alias("n"))


def choose_c(rows: DataFrame, folds: DataFrame, grid: list[float] = GRID) -> float:
    """The C with the best mean pairwise accuracy over folds of posts (post, fold); ties go to the smallest; 1.0 below 4 posts."""
    folds = stored(folds, "folds")
    if len(folds.limit(4).collect()) < 4:
        return 1.0
    r = rows.join(near(folds), "post").select("fold", "pair_row", "label", "vector")
    cs = sorted(grid)
    x = _blocks(r, F.col("fold"), "vector", "label").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        heads = _fits(x, [(k[0], c) for k in folds.select("fold").distinct().orderBy("fold").collect() for c in cs])
    finally:
        x.unpersist()
    got: dict[float, list[float]] = {c: [] for c in cs}
    # all heads score the posts of their fold in one pass
    margin = F.posexplode(margins(F.col("fold"), F.col("vector"), {k: [heads[k, c] for c in cs] for k in sorted({k for k, _ in heads})})).alias("c", "z")
    scored = r.select("fold", "pair_row", "label", margin).withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("z"))))
    for x in pairwise_accuracy(scored, ["fold", "c"]).orderBy("fold", "c").collect():
        got[cs[x["c"]]].append(x["pairwise_accuracy"])
    means = {c: float(np.mean(v)) for c, v in got.items() if v}
    return max(sorted(means), key=lambda c: (means[c], -c)) if means else min(grid)


def margins(group: Column, vector: Column, heads: dict[int, list[Linear]]) -> Column:
    """The margins of a vector under each head of its group, summed up in the order of ``linear_score``, so equal vectors have equal ones; null for a group without heads."""
    by = {k: (np.array([h.coefficients for h in hs]).T, np.array([h.intercept for h in hs])) for k, hs in heads.items()}

    @F.pandas_udf("array<double>")
    def of(groups: pd.Series, vectors: pd.Series) -> pd.Series:
        got: list = [None] * len(groups)
        g = groups.to_numpy()
        for k, (coef, intercept) in by.items():
            at = np.flatnonzero((g == k) & vectors.notna().to_numpy())
            if len(at):
                x = np.stack(vectors.iloc[at].to_numpy())
                z = np.tile(intercept, (len(at), 1))
                for i in range(x.shape[1]):
                    z += x[:, i : i + 1] * coef[i]
                for i, row in zip(at, z):
                    got[i] = row
        return pd.Series(got)

    return of(group, vector)


def provenance(scored: DataFrame) -> DataFrame:
    """Pairwise accuracy of real and synthetic pairs; a table only where both kinds exist."""
    p = pairwise_accuracy(scored, ["synthetic"])
    return p.withColumn("_kinds", F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))).filter("_kinds > 1").drop("_kinds")  # two rows at most


def label_text(label: Column) -> Column:
    return F.when(label == 1, F.lit("draft")).otherwise(F.lit("author"))


def evaluate(rows: DataFrame, folds: DataFrame, c: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(a row a fold: fold, pairwise_accuracy, auc; the mean and deviation of each metric) over test posts (fold, post).

    Free author texts train but are not scored; folds with one class are left out.
    """
    spark = rows.sparkSession
    got = []
    for k in sorted(r[0] for r in folds.select("fold").distinct().collect()):
        test_posts = folds.filter(F.col("fold") == k).select("post")
        train, test = rows.join(test_posts, "post", "left_anti"), rows.filter(~F.col("is_free")).join(test_posts, "post", "left_semi")
        if train.select("label").distinct().count() < 2 or not test.take(1):
            continue
        scored = predict(test, head_of(fit(train, c))).select("pair_row", "label", "score").persist()
        got.append((k, pairwise_accuracy(scored).first()[0], auc(scored).first()[0]))
        scored.unpersist()
    per = spark.createDataFrame(got, "fold int, pairwise_accuracy double, auc double")
    stats = [fold_stats(per, m).withColumn("metric", F.lit(m)) for m in ("pairwise_accuracy", "auc")]
    return per, stats[0].unionByName(stats[1])


#: The strata that metrics are faceted by: real edits, and pairs made by a machine.
STRATA = {"all": None, "real": False, "synthetic": True}


def evaluate_holdout(rows: DataFrame, held: DataFrame, c: float | None = None) -> DataFrame:
    """(stratum, pairwise_accuracy, pairs, auc, positives, negatives, c) over the held-out posts (post), fitted on all others.

    Without ``c`` it is chosen by folds of the training posts alone. Free
    author texts train and are not scored. The strata real and synthetic are
    there only if the scored pairs are of both kinds; metrics have 4 places.
    """
    held = near(stored(held.select("post"), "held"))
    train = rows.join(held, "post", "left_anti")
    test = rows.filter(~F.col("is_free")).join(held, "post", "left_semi")
    chosen = c if c is not None else choose_c(train, balanced_folds(sized_posts(train)))
    scored = stored(predict(test, head_of(fit(train, chosen))).select("pair_row", "label", "score", "synthetic"), "scored")
    every = scored.select("pair_row", "label", "score", F.explode(F.array(F.lit("all"), F.when(F.col("synthetic"), "synthetic").otherwise("real"))).alias("stratum"))
    kinds = scored.agg(F.count_distinct("synthetic")).first()[0]
    names = list(STRATA) if kinds > 1 else ["all"]
    parts = []
    for name in names:
        mine = every.filter(F.col("stratum") == name)
        parts.append(pairwise_accuracy(mine).crossJoin(auc(mine)).select(F.lit(name).alias("stratum"), F.round("pairwise_accuracy", 4).alias("pairwise_accuracy"), "pairs", F.round("auc", 4).alias("auc"), "positives", "negatives", F.lit(float(chosen)).alias("c")))  # one row each
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_artifact(spark, path: str, head: dict, rows: DataFrame, metrics: list[dict], split: dict | None = None, chosen: dict | None = None, embed_model: str = "", threshold: float = 0.5) -> dict:
    """head.json (coefficients, intercept) and meta.json (provenance, counts, metrics) under a folder; returns the meta."""
    import datetime as dt

    from draftloom.sources.jsonl import write_json

    one = F.col("label") == 1
    n = rows.agg(F.count_if(one).alias("n_pairs"), F.count_if(one & ~F.col("synthetic")).alias("n_pairs_real"), F.count_if(one & F.col("synthetic")).alias("n_pairs_synthetic"), F.count_distinct("post").alias("n_posts"), F.count_if("is_free").alias("n_free_positives")).first().asDict()
    meta = {"schema_version": head["schema_version"], "embed_model": embed_model, "embed_dim": len(head["coef"]), "normalize": True, "label_polarity": "p_slop", "threshold": threshold, "trained_at": dt.datetime.now(dt.timezone.utc).isoformat(), **n, "head_C": chosen, "split": split or {"mode": "fit_all"}, "metrics": metrics}
    write_json(spark, f"{path}/head.json", {"coef": head["coef"], "intercept": head["intercept"], "calibration": None})
    write_json(spark, f"{path}/meta.json", meta)
    return meta


def load_artifact(spark, path: str) -> tuple[dict, dict]:
    """(head, meta) of a folder; an error names what is wrong with a broken one."""
    from draftloom.sources.jsonl import read_json

    head, meta = read_json(spark, f"{path}/head.json"), read_json(spark, f"{path}/meta.json", 1)
    number = lambda x: isinstance(x, (int, float)) and not isinstance(x, bool)
    coef = head.get("coef") if isinstance(head, dict) else None
    if not isinstance(coef, list) or not coef or not all(map(number, coef)):
        raise ValueError(f"{path}: 'coef' must be a non-empty list of numbers")
    if not number(head.get("intercept")):
        raise ValueError(f"{path}: 'intercept' must be a number")
    if meta.get("embed_dim") not in (None, len(coef)):
        raise ValueError(f"{path}: {len(coef)} coefficients for embeddings of {meta['embed_dim']}")
    return head, meta


def train_head(rows: DataFrame, path: str, mode: str = "all", c: float | None = None, held: DataFrame | None = None, unseen: DataFrame | None = None, split: dict | None = None, embed_model: str = "") -> dict:
    """Choose C, measure, fit and write an artifact; returns its meta.

    ``all``: measured by shuffled folds of posts, fitted on all rows.
    ``holdout``: measured on the held-out posts, fitted on the others.
    ``splits``: rows are the detector's; measured by folds, and on ``unseen``
    rows of other posts (the styler's) with the same head; fitted on all rows.
    """
    spark = rows.sparkSession
    if not rows.filter("pair_row is not null").take(1):
        raise ValueError("no pairs to train on")
    if mode not in ("all", "holdout", "splits") or (mode == "holdout") != (held is not None):
        raise ValueError("mode must be all, splits, or holdout with held-out posts")
    mine = rows if held is None else rows.join(held.select("post"), "post", "left_anti")
    chosen = c if c is not None else choose_c(mine, balanced_folds(sized_posts(mine)))
    head = head_of(fit(mine, chosen))
    if mode == "holdout":
        metrics = [r.asDict() for r in evaluate_holdout(rows, held, chosen).collect()]
        split = {"holdout_posts": sorted(r[0] for r in held.select("post").toLocalIterator())} | (split or {})  # the artifact lists them
    else:
        metrics = [r.asDict() for r in evaluate(mine, shuffle_folds(mine.select("post")), chosen)[1].collect()]
    if unseen is not None:
        s = predict(unseen.filter(~F.col("is_free")), head)
        metrics.append({"metric": "styler_holdout", "pairwise_accuracy": pairwise_accuracy(s).first()[0], "auc": auc(s).first()[0]})
    return write_artifact(spark, path, head, mine, metrics, {"mode": {"all": "fit_all"}.get(mode, mode)} | (split or {}), {"mode": "fixed" if c is not None else "nested", "value": chosen}, embed_model)
