"""Training corpora and rewriting: selection with accounts, manifests, best of N, sessions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftloom.functions.blocks import body_chunks_udf, lost_anchors
from draftloom.operators.pairs import content, first_n, per_target_cap


def training_corpus(pairs: DataFrame, problems: Column, val_posts: DataFrame, role: Column | None = None, wanted: str | None = None, selector: Column | None = None, cap: int | None = None, per_target: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(corpus with ``part`` train or val, accounts (stage, n)): validate, role, selector, cap, split by post.

    Each pair meets the filters in order and is counted at the first that drops
    it. ``val_posts`` (post) are held out whole. ``per_target`` is a policy on the
    kept pairs (which of those that share a target stay); ``cap`` is the usual one.
    """
    stages = [("invalid", F.size(problems) > 0)]
    if role is not None:
        stages.append(("role", ~F.coalesce(role == wanted, F.lit(False))))
    if selector is not None:
        stages.append(("selector", ~F.coalesce(selector, F.lit(False))))
    reason = F.coalesce(*[F.when(c, F.lit(n)) for n, c in stages], F.lit("kept"))
    r = pairs.withColumn("_reason", reason)
    kept = r.filter("_reason = 'kept'").drop("_reason")
    accounts = r.groupBy(F.col("_reason").alias("stage")).agg(F.count(F.lit(1)).alias("n"))
    if cap is not None or per_target is not None:
        capped = per_target(kept) if per_target is not None else per_target_cap(kept, cap, [F.col("pair_id")])
        before, after = kept.agg(F.count(F.lit(1)).alias("_a")), capped.agg(F.count(F.lit(1)).alias("_b"))  # one row each, counted only if the accounts are asked for
        accounts = accounts.unionByName(before.crossJoin(after).select(F.lit("capped").alias("stage"), (F.col("_a") - F.col("_b")).alias("n")))
        kept = capped
    held = val_posts.select(F.col("post").alias("_post")).distinct()
    j = kept.join(held, F.col("source") == F.col("_post"), "left")
    return j.withColumn("part", F.when(F.col("_post").isNotNull(), F.lit("val")).otherwise(F.lit("train"))).drop("_post"), accounts


def data_hash(rows: DataFrame, once: bool = False) -> str:
    """16 hex digits of the rows' contents: the same for any order and layout, and for no other rows.

    The hashes of the rows are summed in four parts, so that no list holds them. With ``once`` equal rows count once.
    """
    h = rows.select(F.sha2(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}), 256).alias("h"))
    h = h.distinct() if once else h
    parts = [F.sum(F.conv(F.substring("h", 1 + 16 * k, 15), 16, 10).cast("decimal(20,0)")).cast("string").alias(f"p{k}") for k in range(4)]
    sums = h.agg(F.count(F.lit(1)).cast("string").alias("n"), *parts)
    return sums.select(F.substring(F.sha2(F.concat_ws(":", "n", *[f"p{k}" for k in range(4)]), 256), 1, 16)).first()[0]


def chars(messages: Column) -> Column:
    """Characters of all contents."""
    return F.aggregate(F.transform(messages, lambda m: F.length(F.coalesce(m["content"], F.lit("")))), F.lit(0), lambda a, x: a + x)


def manifest(corpus: DataFrame, data_hash: str, hyper: dict, price_per_million: float = 0.0, size: Column | None = None) -> dict:
    """Counts, tokens (characters over four) and cost of a run, from one aggregate; ``size`` where rows carry their characters only."""
    size = size if size is not None else chars(F.col("messages"))
    by = {r["part"]: r.asDict() for r in corpus.groupBy("part").agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct("source").alias("posts"), F.floor(F.sum(size) / 4).alias("tokens")).collect()}
    tokens = sum(int(x["tokens"] or 0) for k, x in by.items() if k == "train")
    return {"schema_version": 1, "data_sha": data_hash, "counts": by, "hyperparams": hyper, "estimate": {"tokens_per_epoch": tokens, "cost_per_epoch": round(tokens * price_per_million / 1e6, 4)}}


def best_of(candidates: DataFrame, key: list[str]) -> DataFrame:
    """Of each key the candidate with the lowest score, the first of equals; the input (idx -1) wins unless one is strictly lower."""
    first = F.struct("score", "idx")
    return candidates.groupBy(*key).agg(F.min_by(F.struct("idx", "score", "text"), first).alias("_b")).select(*key, "_b.*")


#: (a passage under its heading, how many) -> candidates.
Styler = Callable[[str, int], list[str]]
Scorer = Callable[[str], float]


def _choose(chunk: str, context: str | None, styler: Styler, scorer: Scorer | None, n: int, guard: bool) -> tuple[list[str], list[float | None], int | None, int, str]:
    """(candidates, their scores, the chosen one, how many were refused, the decision in words) for one prose chunk."""
    head = f"{context}\n\n" if context else ""
    said = [c[len(head) :] if head and c.startswith(head) else c for c in styler(head + chunk, n) if c and c.strip()]
    said = [c.strip() for c in said if c.strip()]
    lost = [lost_anchors(chunk, c) if guard else [] for c in said]
    kept = [i for i, gone in enumerate(lost) if not gone]
    scores: list[float | None] = [None] * len(said)
    refused = len(said) - len(kept)
    if not kept:
        gone = sorted({x for xs in lost for x in xs})
        return said, scores, None, refused, f"kept input (all {refused} sample(s) lost anchors: {', '.join(gone[:3])}{'…' if len(gone) > 3 else ''})" if gone else "kept input (no usable sample)"
    if scorer is None:
        return said, scores, kept[0], refused, f"sample 1/{len(kept)}"
    for i in kept:
        scores[i] = float(scorer(said[i]))
    base, best = float(scorer(chunk.strip())), min(kept, key=lambda i: scores[i])
    if scores[best] < base:
        return said, scores, best, refused, f"sample {kept.index(best) + 1}/{len(kept)} (score {scores[best]:.2f} < input {base:.2f})"
    return said, scores, None, refused, f"kept input (best sample {scores[best]:.2f} >= input {base:.2f})"


def _edged(chunk: str, out: str) -> str:
    """A candidate with the line ends that the chunk had around it."""
    return chunk[: len(chunk) - len(chunk.lstrip("\n"))] + out.strip("\n") + chunk[len(chunk.rstrip("\n")) :]


def _decided(docs: DataFrame, styler: Styler, scorer: Scorer | None, n: int, guard: bool, max_chars: int) -> DataFrame:
    """A row a chunk of every document: kind, context, input, candidates, scores, chosen, refused, decision, text, sep."""
    ch = docs.select("doc_id", F.posexplode(body_chunks_udf(F.coalesce("text", F.lit("")), max_chars)).alias("pos", "c")).select("doc_id", "pos", "c.*")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for d, p, kind, chunk, sep, context in zip(b["doc_id"], b["pos"], b["kind"], b["text"], b["sep"], b["context"]):
                got: tuple = ([], [], None, 0, "verbatim")
                if kind == "prose":
                    got = _choose(chunk, context, styler, scorer, n, guard)
                out.append((d, p, kind, context, chunk, *got, chunk if got[2] is None else _edged(chunk, got[0][got[2]]), sep))
            # object columns: a missing choice or score is null, not NaN
            yield pd.DataFrame(out, columns=["doc_id", "pos", "kind", "context", "input", "candidates", "scores", "chosen", "refused", "decision", "text", "sep"], dtype=object)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return ch.mapInPandas(run, f"doc_id {kind}, pos int, kind string, context string, input string, candidates array<string>, scores array<double>, chosen int, refused int, decision string, text string, sep string")


def rewrite(docs: DataFrame, styler: Styler, scorer: Scorer | None, n: int = 4, guard: bool = True, max_chars: int = 1500) -> DataFrame:
    """(doc_id, text, n_chunks, n_candidates, n_kept_input, n_anchor_rejected, decisions): prose chunks restyled, the rest verbatim.

    Frontmatter, headings and fences never reach the styler; it gets a prose
    chunk under its heading, and the heading is taken off its answers again.
    With ``guard`` candidates that lose a link or a citation are refused before
    any is scored. Of the others the one with the lowest score is taken, if it
    is strictly below the input's; without a scorer the first. Blank answers
    are none, and without a usable one the input stays. Chunk counts are of
    prose. Styler and scorer are injected; null and empty texts give ''.
    """
    c = _decided(docs, styler, scorer, n, guard, max_chars)
    prose = F.col("kind") == "prose"
    # a document's chunks are of one document: the group is as long as its text
    parts = F.array_sort(F.collect_list(F.struct("pos", F.concat("text", "sep").alias("t"), F.when(prose, F.col("decision")).alias("d"))))
    g = c.groupBy("doc_id").agg(parts.alias("p"), F.count_if(prose).cast("int").alias("n_chunks"), F.sum(F.size("candidates")).cast("int").alias("n_candidates"), F.count_if(prose & F.col("chosen").isNull()).cast("int").alias("n_kept_input"), F.sum("refused").cast("int").alias("n_anchor_rejected"))
    said = F.filter(F.transform("p", lambda x: x["d"]), lambda d: d.isNotNull())
    return g.select("doc_id", F.array_join(F.transform("p", lambda x: x["t"]), "").alias("text"), "n_chunks", "n_candidates", "n_kept_input", "n_anchor_rejected", F.transform(said, lambda d, i: F.concat(F.lit("chunk "), (i + 1).cast("string"), F.lit(": "), d)).alias("decisions"))


def rewrite_decisions(docs: DataFrame, styler: Styler, scorer: Scorer | None, n: int = 4, guard: bool = True, max_chars: int = 1500) -> DataFrame:
    """The preference log, a row a prose chunk: (doc_id, pos, context, input, candidates, scores, chosen, kept_input, decision).

    Refused candidates are in the list with a null score; ``chosen`` counts from 0 and is null where the input was kept.
    """
    c = _decided(docs, styler, scorer, n, guard, max_chars).filter("kind = 'prose'")
    return c.select("doc_id", "pos", "context", "input", "candidates", "scores", "chosen", F.col("chosen").isNull().alias("kept_input"), "decision")


def rewrite_pending(pairs: DataFrame, done: DataFrame, styler: Styler, scorer: Scorer | None = None, n: int = 1, selector: Column | None = None, limit: int | None = None) -> DataFrame:
    """The pairs (id, messages, ...) not done yet, each id once, with ``output``: the styler's rewrite of the user's content as stored.

    No do-no-harm and no guard: of several candidates that are not blank the
    one with the lowest score, without a scorer the first; records without any
    are left out. ``limit`` takes the first by id among the selected.
    """
    fresh = pairs if selector is None else pairs.filter(F.coalesce(selector, F.lit(False)))
    fresh = fresh.join(done.select("id").distinct(), "id", "left_anti").dropDuplicates(["id"])
    if limit is not None:
        fresh = first_n(fresh, limit, [F.col("id")])

    def best(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            kept = [c for c in styler(t or "", n) if c and c.strip()]
            return None if not kept else kept[0] if len(kept) == 1 or scorer is None else min(kept, key=scorer)

        return texts.map(one)

    return fresh.withColumn("output", F.pandas_udf(best, "string")(content(F.col("messages"), 1))).filter("output is not null")


def session_plan(items: DataFrame, budget: int, turns: int, order: list[str]) -> DataFrame:
    """(arm, session, turn, item): items of an arm in order, a new session when turns or the token budget are used up.

    A greedy fold whose budget resets, over the sorted items of an arm as a
    stream: an arm of any size has one plan, and no list holds it. An arm is
    one task. Missing tokens count as none. Input: arm, item, tokens.
    """
    rows = items.select("arm", *[F.col(o).alias(f"_o{k}") for k, o in enumerate(order)], "item", F.coalesce(F.col("tokens").cast("bigint"), F.lit(0).cast("bigint")).alias("tokens"))
    keys = [f"_o{k}" for k in range(len(order))]
    # the whole key is sorted before the item is made a string
    ordered = rows.repartition("arm").sortWithinPartitions("arm", *keys, "item", "tokens").select(F.col("arm"), F.col("item").cast("string").alias("item"), "tokens")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        arm, session, turn, used = object(), 0, 0, 0  # no arm yet
        for b in batches:
            out = []
            for a, item, n in zip(b["arm"], b["item"], b["tokens"]):
                if a != arm:
                    arm, session, turn, used = a, 0, 0, 0
                elif turn >= turns or used + n > budget:
                    session, turn, used = session + 1, 0, 0
                out.append((a, session, turn, item))
                turn, used = turn + 1, used + n
            yield pd.DataFrame(out, columns=["arm", "session", "turn", "item"])

    kind = items.schema["arm"].dataType.simpleString()
    return ordered.mapInPandas(fold, f"arm {kind}, session int, turn int, item string")
