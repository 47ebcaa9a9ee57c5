"""Same and near-same records across splits.

Method: minwise hashes of the bag of words in banded buckets; only buckets that
hold both an evaluation and a training text give candidates; the parities of
the bag in hashed cells drop those that cannot have enough words in common,
and no others; what is left is verified exactly (Jaccard of the shingles, and
the longest common subsequence of the words), on distinct texts, and then
expanded to the records.

A common subsequence of three quarters of the longer text is a part of both
bags, so the bags of every case have a Jaccard of at least 0.6, wherever the
edits are: a band of 4 rows meets with probability 0.13 or more, one of 24
bands with 0.964 or more.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftloom.llm.defects import turn, without_heading, words_in
from draftloom.llm.markup import bare
from draftloom.session import scratch, spread

SHINGLE, BANDS, ROWS = 3, 24, 4
#: Cells of a bag's parities; folded to half as many, they are all that texts of up to SHORT words need.
CELLS, SHORT = 512, 128
LEAST_WORDS, SHARE = 25, 0.75
#: Ids that are broadcast at most (8 bytes each, 8 MB); beyond, the texts are fetched by a shuffled join.
BROADCAST_IDS = 1_000_000

def words_of(content: str | None, context: str | None) -> list[str]:
    """Lower-case runs of letters or digits, without the context heading and markup."""
    body = without_heading(content, context)
    return words_in(bare(body).lower()) if body else []


@lru_cache(200_000)
def _word_hash(w: str) -> int:
    return xxhash.xxh64_intdigest(w)


def _hashers(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240229)
    return r.integers(1, 2**32, n, dtype=np.uint32) | np.uint32(1), r.integers(0, 2**32, n, dtype=np.uint32)


_A, _B = _hashers(BANDS * ROWS)


def occurrences(words: list[str]) -> list[int]:
    """For each word, how often it has occurred up to there: with it, the bag is a set."""
    seen: dict[str, int] = {}
    out = []
    for w in words:
        k = seen[w] = seen.get(w, 0) + 1
        out.append(k)
    return out


def signatures(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Band keys [texts, BANDS] and parities [texts, CELLS / 64] of the bags of texts with at least one word."""
    lens = np.array([len(t) for t in texts])
    cuts = np.concatenate([[0], np.cumsum(lens)[:-1]]).astype(np.int64)
    with np.errstate(over="ignore"):
        x = np.array([*map(_word_hash, chain.from_iterable(texts))], np.uint64)
        x += np.array([*chain.from_iterable(map(occurrences, texts))], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        sig = np.empty((len(texts), BANDS * ROWS), np.uint64)
        short = (x >> np.uint64(32)).astype(np.uint32)
        mixed = np.empty_like(short)
        for k in range(BANDS * ROWS):
            np.multiply(short, _A[k], out=mixed)
            mixed += _B[k]
            sig[:, k] = np.minimum.reduceat(mixed, cuts)
        keys = np.zeros((len(texts), BANDS), np.uint64)
        for r in range(ROWS):
            keys = keys * np.uint64(0xC2B2AE3D27D4EB4F) + sig[:, r::ROWS]
            keys ^= keys >> np.uint64(31)
        keys = keys * np.uint64(0x165667B19E3779F9) + np.arange(BANDS, dtype=np.uint64)
    cell = np.repeat(np.arange(len(texts)), lens) * CELLS + (x % np.uint64(CELLS)).astype(np.int64)
    odd = (np.bincount(cell, minlength=len(texts) * CELLS) & 1).astype(np.uint8)
    return keys.view(np.int64), np.packbits(odd.reshape(len(texts), CELLS), axis=1).view(np.int64)


def _may_overlap() -> Column:
    """No bound is lost: parities differ in no more cells than the bags have words of only one of them."""

    def differing(parts: list[Column]) -> Column:
        return reduce(lambda a, b: a + b, [F.bit_count(x) for x in parts])

    half = range(CELLS // 128)
    folded = [F.col(f"tf{k}").bitwiseXOR(F.col(f"ef{k}")) for k in half]
    upper = [F.col(f"tu{k}").bitwiseXOR(F.col(f"eu{k}")) for k in half]
    lower = [f.bitwiseXOR(u) for f, u in zip(folded, upper)]
    most = F.greatest("tn", "en")
    only_one = F.col("tn") + F.col("en") - 2 * SHARE * most
    return (F.least("tn", "en") >= SHARE * most) & (differing(folded) <= only_one) & F.coalesce(differing(upper + lower) <= only_one, F.lit(True))


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, by bits of one big integer."""
    masks: dict[str, int] = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        u = v & masks.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def jaccard(a: list[str], b: list[str]) -> float:
    x, y = ({tuple(t[i : i + SHINGLE]) for i in range(len(t) - SHINGLE + 1)} for t in (a, b))
    return len(x & y) / len(x | y) if x or y else 1.0


def _bodies(rows: DataFrame, id_col: str, messages: Column, split: Column, context: Column) -> DataFrame:
    """(id, train, side, h, n, keys, folded, upper) of every user and assistant body of at least LEAST_WORDS words."""
    schema = "id bigint, train boolean, side int, h bigint, n int, keys array<bigint>, folded array<bigint>, upper array<bigint>"

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen: dict[tuple, int] = {}
            texts: list[list[str]] = []
            rows = []
            for i, tr, u, a, c in zip(b["i"], b["train"], b["u"], b["a"], b["c"]):
                for side, t in ((0, u), (1, a)):
                    if not t:
                        continue
                    k = seen.get((t, c))
                    if k is None:
                        w = words_of(t, c)
                        k = seen[t, c] = len(texts) if len(w) >= LEAST_WORDS else -1
                        if k >= 0:
                            texts.append(w)
                    if k >= 0:
                        rows.append((i, tr, side, k))
            if not rows:
                continue
            keys, odd = signatures(texts)
            upper = odd[:, CELLS // 128 :]
            folded = odd[:, : CELLS // 128] ^ upper
            h = np.array([xxhash.xxh64_intdigest("\x00".join(t), 11) for t in texts], np.uint64).view(np.int64)
            ids, tr, sides, k = zip(*rows)
            k = np.array(k)
            first = np.zeros(len(k), bool)
            first[np.unique((k * 2 + np.array(tr)) * 2 + np.array(sides), return_index=True)[1]] = True  # keys of a text once a batch, split and side
            yield pd.DataFrame({"id": ids, "train": tr, "side": sides, "h": h[k], "n": [len(texts[x]) for x in k], "keys": [keys[x] if f else None for x, f in zip(k, first)], "folded": [folded[x] if f else None for x, f in zip(k, first)], "upper": [upper[x] if f and len(texts[x]) > SHORT else None for x, f in zip(k, first)]})

    src = rows.filter(split.isin("train", "val", "eval") & F.col(id_col).isNotNull())
    src = src.select(F.col(id_col).cast("bigint").alias("i"), (split == "train").alias("train"), turn(messages, "user").alias("u"), turn(messages, "assistant").alias("a"), context.alias("c"))
    return spread(src).mapInPandas(look, schema)


def linked_texts(rows: DataFrame, id_col: str = "pair_id") -> tuple[DataFrame, DataFrame]:
    """(members (id, train, side, h), links (side, th, eh, jaccard, share)): the class of each body, and the classes that overlap across splits.

    A class is all bodies of a role with the same words. Bodies are compared
    with bodies of the same role; copies are not expanded.
    """
    spark = rows.sparkSession
    at = scratch(spark, "bodies")
    _bodies(rows, id_col, F.col("messages"), F.col("split"), F.col("context")).write.parquet(at)
    bodies = spark.read.parquet(at)
    member = bodies.select("id", "train", "side", "h").distinct()

    parts = [(p, k) for p in ("folded", "upper") for k in range(CELLS // 128)]
    odd = [F.get(p, F.lit(k)).alias(f"{p[0]}{k}") for p, k in parts]
    keyed = bodies.filter("keys is not null").select(F.explode("keys").alias("key"), "train", "side", "h", "n", *odd).repartition("key", "side").dropDuplicates(["key", "side", "train", "h"])

    def of(train: bool, p: str) -> DataFrame:
        return keyed.filter(F.col("train") == train).select("key", "side", *[F.col(c).alias(p + c) for c in ("h", "n", *[f"{q[0]}{k}" for q, k in parts])])

    met = of(True, "t").join(of(False, "e"), ["key", "side"]).filter(_may_overlap())
    found = scratch(spark, "candidates")
    met.select("side", "th", "eh").distinct().write.parquet(found)
    candidates = spark.read.parquet(found)
    near = candidates.filter("th <> eh")

    # the words of the candidates, from one record of each
    wanted = near.select("side", F.col("th").alias("h")).unionByName(near.select("side", F.col("eh").alias("h"))).distinct()
    reps = bodies.filter("keys is not null").join(wanted, ["side", "h"]).groupBy("side", "h").agg(F.min("id").alias("i"))
    kept = scratch(spark, "representatives")
    reps.write.parquet(kept)
    reps = spark.read.parquet(kept)
    few = reps.count() <= BROADCAST_IDS
    src = rows.select(F.col(id_col).cast("bigint").alias("i"), turn(F.col("messages"), "user").alias("u"), turn(F.col("messages"), "assistant").alias("a"), F.col("context").alias("c"))
    texts = src.join(F.broadcast(reps) if few else reps, "i").select("side", "h", F.when(F.col("side") == 0, F.col("u")).otherwise(F.col("a")).alias("t"), "c").dropDuplicates(["side", "h"])
    pairs = near.join(texts.select("side", F.col("h").alias("th"), F.col("t").alias("tt"), F.col("c").alias("tc")), ["side", "th"])
    pairs = pairs.join(texts.select("side", F.col("h").alias("eh"), F.col("t").alias("et"), F.col("c").alias("ec")), ["side", "eh"])

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            known: dict[tuple, tuple] = {}

            def of(t: str, c: str | None) -> tuple[list[str], set]:
                if (t, c) not in known:
                    w = words_of(t, c)
                    known[t, c] = w, set(zip(w, occurrences(w)))
                return known[t, c]

            for side, th, eh, tt, tc, et, ec in zip(b["side"], b["th"], b["eh"], b["tt"], b["tc"], b["et"], b["ec"]):
                (x, xs), (y, ys) = of(tt, tc), of(et, ec)
                most = max(len(x), len(y))
                if len(xs & ys) < SHARE * most:
                    continue
                share = common_subsequence(x, y) / most if most else 0.0
                if share >= SHARE and min(len(x), len(y)) >= LEAST_WORDS:
                    out.append((side, th, eh, jaccard(x, y), share))
            yield pd.DataFrame(out, columns=["side", "th", "eh", "jaccard", "share"])

    cols = ["side", "th", "eh", "tt", "tc", "et", "ec"]
    linked = pairs.select(*cols).mapInPandas(verify, "side int, th bigint, eh bigint, jaccard double, share double")
    linked = linked.unionByName(candidates.filter("th = eh").select("side", "th", "eh", F.lit(1.0).alias("jaccard"), F.lit(1.0).alias("share")))
    return member, linked


def overlaps(rows: DataFrame, id_col: str = "pair_id") -> DataFrame:
    """(train_id, eval_id, side, jaccard, share) of every record pair across splits whose bodies overlap.

    Bodies are compared with bodies of the same role. Repeated rows of an id
    count once; null contents, null splits and bodies under LEAST_WORDS words
    overlap nothing; ``share`` is the common subsequence over the longer body.
    """
    member, linked = linked_texts(rows, id_col)
    t = member.filter("train").select(F.col("id").alias("train_id"), "side", F.col("h").alias("th"))
    e = member.filter("not train").select(F.col("id").alias("eval_id"), "side", F.col("h").alias("eh"))
    return linked.join(e, ["side", "eh"]).join(t, ["side", "th"]).select("train_id", "eval_id", "side", "jaccard", "share")


def overlapping_ids(rows: DataFrame, id_col: str = "pair_id") -> DataFrame:
    """(pair_a, pair_b), the smaller id first, each pair once."""
    o = overlaps(rows, id_col)
    return o.filter("train_id <> eval_id").select(F.least("train_id", "eval_id").alias("pair_a"), F.greatest("train_id", "eval_id").alias("pair_b")).distinct()


def _linked_copies(member: DataFrame, links: DataFrame) -> DataFrame:
    """(train, side, h, links): of each class with overlaps, how many bodies of the other side of the split it overlaps with."""
    size = member.groupBy("train", "side", "h").agg(F.count(F.lit(1)).alias("n"))
    ends = links.select("side", F.explode(F.array(F.struct(F.lit(True).alias("train"), F.col("th").alias("h"), F.col("eh").alias("other")), F.struct(F.lit(False).alias("train"), F.col("eh").alias("h"), F.col("th").alias("other")))).alias("x")).select("side", "x.*")
    far = size.select((~F.col("train")).alias("train"), "side", F.col("h").alias("other"), "n")
    return ends.join(far, ["train", "side", "other"]).groupBy("train", "side", "h").agg(F.sum("n").alias("links"))


def overlap_classes(rows: DataFrame, id_col: str = "pair_id") -> DataFrame:
    """(id, role, class_id, links): every body of at least LEAST_WORDS words once, with its class and its number of overlaps across splits."""
    member, links = linked_texts(rows, id_col)
    out = member.join(_linked_copies(member, links), ["train", "side", "h"], "left")
    role = F.when(F.col("side") == 0, F.lit("user")).otherwise(F.lit("assistant"))
    return out.select(F.col("id").alias(id_col), role.alias("role"), F.col("h").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))


def overlap_counts(rows: DataFrame, id_col: str = "pair_id") -> DataFrame:
    """(split, source, links, records): overlaps of the evaluation records per split and source, as written.

    Counted from classes, copies are not expanded: a record's links are those
    of its user body and of its assistant body, less the training records that
    overlap in both. Of different bodies of one role under one id the one with the largest hash counts.
    """
    member, links = linked_texts(rows, id_col)
    body = lambda side: F.max(F.when(F.col("side") == side, F.col("h")))
    records = member.groupBy("id", "train").agg(body(0).alias("u"), body(1).alias("a"))
    shapes = records.filter("u is not null and a is not null").groupBy("train", "u", "a").agg(F.count(F.lit(1)).alias("n"))
    of = {side: links.filter(F.col("side") == side).select("th", "eh") for side in (0, 1)}
    both = shapes.filter("not train").select(F.col("u").alias("eu"), F.col("a").alias("ea")).join(of[0].toDF("tu", "eu"), "eu")
    both = both.join(shapes.filter("train").select(F.col("u").alias("tu"), F.col("a").alias("ta"), "n"), "tu").join(of[1].toDF("ta", "ea"), ["ta", "ea"])
    both = both.groupBy(F.col("eu").alias("u"), F.col("ea").alias("a")).agg(F.sum("n").alias("twice"))
    one = _linked_copies(records.select("train", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("u").alias("h")), F.struct(F.lit(1).alias("side"), F.col("a").alias("h")))).alias("x")).select("train", "x.*").filter("h is not null"), links).filter("not train")
    n = records.filter("not train").select("id", "u", "a")
    for side, c in ((0, "u"), (1, "a")):
        n = n.join(one.filter(F.col("side") == side).select(F.col("h").alias(c), F.col("links").alias(f"n{side}")), c, "left")
    n = n.join(both, ["u", "a"], "left").select("id", (F.coalesce("n0", F.lit(0)) + F.coalesce("n1", F.lit(0)) - F.coalesce("twice", F.lit(0))).alias("links")).filter("links > 0")
    written = rows.filter(F.col("split").isin("val", "eval")).select(F.col(id_col).cast("bigint").alias("id"), "split", "source").distinct()
    return written.join(n, "id").groupBy("split", "source").agg(F.sum("links").alias("links"), F.count(F.lit(1)).alias("records"))
