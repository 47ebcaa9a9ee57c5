"""Containers of fixed capacity filled with texts sized in tokens.

Method: Martello-Toth dominance reduction, then best fit. Items matter only by
size, and sizes are at most the capacity, so the instance is a histogram with
a row for each size: the driver fixes dominating sets and packs the remainder
on counts, in runs of equal containers, at a cost that depends on the capacity
and not on the number of texts. The plan (rank ranges of a size -> containers)
goes back to the executors, where texts are ranked within their size.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from draftloom.llm.tokens import TOKENIZER, load_ranks
from draftloom.session import checkpoint, spread

CAPACITY = 4096
#: Fixed value: the pre-tokeniser's words, as the tokenizer's library writes them.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Buckets that the ranking of one size is split into.
BUCKETS = 256


def sized(docs: DataFrame, id_col: str, text_col: str, path: str = TOKENIZER) -> DataFrame:
    """(id, tokens): the number of tokens of each text, 0 for null and empty; an id counts once, with its longest text."""
    ranks = load_ranks(path)  # of the tokenizer's size; read here, so that executors need no file of their own

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "tokens": [len(enc.encode_ordinary(t)) if t else 0 for t in b["t"]]})

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).filter("id is not null")
    return spread(src).mapInPandas(count, f"id {kind}, tokens bigint").groupBy("id").agg(F.max("tokens").alias("tokens"))


class Stock:
    """Counts of item sizes, with the sizes in order."""

    def __init__(self, counts: dict[int, int]):
        self.n = {s: c for s, c in counts.items() if c > 0}
        self.sizes = sorted(self.n)

    def take(self, s: int, k: int) -> None:
        self.n[s] -= k
        if not self.n[s]:
            del self.n[s]
            self.sizes.pop(bisect_left(self.sizes, s))

    def at_most(self, r: int, but: int = 0) -> int:
        """The largest size up to r; ``but``: a size of which one item is spoken for. 0 if there is none."""
        i = bisect_right(self.sizes, r) - 1
        while i >= 0:
            s = self.sizes[i]
            if s != but or self.n[s] > 1:
                return s
            i -= 1
        return 0

    def smallest(self, k: int, but: int) -> list[int]:
        out: list[int] = []
        for s in self.sizes:
            out += [s] * min(self.n[s] - (s == but), k - len(out))
            if len(out) == k:
                break
        return out


def _dominating(stock: Stock, s: int, capacity: int) -> tuple[int, ...] | None:
    """Companions whose set with one item of size s dominates every feasible set with it, or None.

    A set dominates another if each item of the other, or each group in a
    partition of them, fits under an item of the set.
    """
    room = capacity - s
    best = stock.at_most(room, s)
    if not best:
        return ()
    if best == room:
        return (best,)
    low = stock.smallest(3, s)
    if len(low) < 2 or low[0] + low[1] > room:
        return (best,)
    if len(low) == 3 and sum(low) <= room:
        return None
    # at most two companions: the fullest pair against the largest single
    pair = 0
    for a in reversed(stock.sizes[: bisect_right(stock.sizes, room)]):
        if a * 2 < pair:
            break
        if a == s and stock.n[a] < 2:
            continue
        left = min(room - a, a)
        i = bisect_right(stock.sizes, left) - 1
        while i >= 0 and stock.n[stock.sizes[i]] - (stock.sizes[i] == s) - (stock.sizes[i] == a) <= 0:
            i -= 1
        if i >= 0:
            pair = max(pair, a + stock.sizes[i])
    if best >= pair:
        return (best,)
    # the largest single with the largest beside it, if no pair has a larger second item
    stock.n[best] -= 1
    second = max((x for x in stock.sizes[: bisect_right(stock.sizes, room - best)] if stock.n[x] - (x == s) > 0), default=0)
    stock.n[best] += 1
    half = stock.at_most(room // 2, s)
    return (best, second) if second and half <= second else None


def reduce(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, dict[int, int]]], dict[int, int]]:
    """(containers fixed, as (how many, size -> items in each)), and the counts that are left."""
    stock, fixed = Stock(counts), []
    i = len(stock.sizes) - 1
    while i >= 0:
        s = stock.sizes[i]
        mates = _dominating(stock, s, capacity)
        if mates is None:
            i -= 1
            continue
        content: dict[int, int] = {s: 1}
        for m in mates:
            content[m] = content.get(m, 0) + 1
        # the same set again, as long as the choice cannot change: until one of its sizes would run out
        times = min(stock.n[x] // k for x, k in content.items())
        small = stock.sizes[0]
        if len(mates) and small not in content and times > 1 and capacity - sum(x * k for x, k in content.items()) < small:
            pass
        elif len(mates) == 0 or content.get(capacity - s) or len(mates) == 1:
            pass
        else:
            times = 1
        for x, k in content.items():
            stock.take(x, k * times)
        fixed.append((times, content))
        i = min(bisect_right(stock.sizes, s), len(stock.sizes)) - 1
    return fixed, stock.n


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Best fit decreasing on counts: containers in runs of equal content."""
    groups: dict[int, list[tuple[int, dict[int, int]]]] = {}
    rooms: list[int] = []

    def put(room: int, n: int, content: dict[int, int]) -> None:
        if n:
            if room not in groups:
                groups[room] = []
                insort(rooms, room)
            groups[room].append((n, content))

    for s in sorted(counts, reverse=True):
        left = counts[s]
        while left:
            i = bisect_left(rooms, s)
            if i < len(rooms):
                room = rooms[i]
                n, content = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(i)
            else:
                room, n, content = capacity, left, {}
            each = room // s
            full = min(n, left // each)
            put(room - each * s, full, content | {s: each})
            left -= full * each
            rest = n - full
            if rest and 0 < left < each:
                put(room - left * s, 1, content | {s: left})
                left, rest = 0, rest - 1
            if content:
                put(room, rest, content)
    return [g for gs in groups.values() for g in gs]


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rows (size, rank_from, rank_to, container_from, items of the size in each), and the number of containers."""
    fixed, rest = reduce(counts, capacity)
    rows, used, base = [], dict.fromkeys(counts, 0), 0
    for n, content in [*fixed, *best_fit(rest, capacity)]:
        for s, k in content.items():
            rows.append((s, used[s], used[s] + n * k, base, k))
            used[s] += n * k
        base += n
    return rows, base


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, path: str = TOKENIZER) -> DataFrame:
    """(id, piece, token_from, tokens, container) of every text.

    A text is whole (piece 0) unless it alone exceeds the capacity; then it is
    cut into full pieces, each a container of its own, and a last one that is
    packed like other texts. Texts of no tokens (null, empty) take no space
    and lie in container 0. Ids that repeat count once, null ids are left out.
    """
    spark = docs.sparkSession
    items = checkpoint(sized(docs, id_col, text_col, path))
    cap = F.lit(capacity)
    items = items.withColumn("full", F.when(F.col("tokens") > cap, F.floor(F.col("tokens") / cap)).otherwise(F.lit(0)).cast("bigint"))
    items = items.withColumn("size", F.col("tokens") - F.col("full") * cap)
    # at most one row for each size up to the capacity comes to the driver
    counts = {int(r["size"]): int(r["n"]) for r in items.filter("size > 0").groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows, containers = plan(counts, capacity)
    slots = spark.createDataFrame(rows, "size bigint, a bigint, b bigint, base bigint, k bigint")
    slots = slots.groupBy("size").agg(F.sort_array(F.collect_list(F.struct("a", "b", "base", "k"))).alias("slots"))

    ranked = _rank(items.filter("size > 0"), "size")
    # of bounded size: the plan's rows depend on the capacity only
    placed = ranked.join(F.broadcast(slots), "size").withColumn("slot", F.get(F.filter("slots", lambda x: (x["a"] <= F.col("rank")) & (F.col("rank") < x["b"])), 0))
    whole = placed.select("id", F.col("full").alias("piece"), (F.col("full") * cap).alias("token_from"), F.col("size").alias("tokens"), (F.col("slot.base") + F.floor((F.col("rank") - F.col("slot.a")) / F.col("slot.k"))).cast("bigint").alias("container"))
    cut = _rank(items.filter("full > 0").withColumn("one", F.lit(0)), "one", "full")
    cut = cut.select("id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("full") - 1)).alias("piece"), "rank")
    cut = cut.select("id", "piece", (F.col("piece") * cap).alias("token_from"), cap.cast("bigint").alias("tokens"), (F.lit(containers) + F.col("rank") + F.col("piece")).alias("container"))
    none = items.filter("tokens = 0").select("id", F.lit(0).cast("bigint").alias("piece"), F.lit(0).cast("bigint").alias("token_from"), F.lit(0).cast("bigint").alias("tokens"), F.lit(0).cast("bigint").alias("container"))
    return whole.unionByName(cut).unionByName(none).withColumnRenamed("id", id_col)


def _rank(items: DataFrame, group: str, weight: str | None = None) -> DataFrame:
    """Adds ``rank``, the running weight (or count) of a group's rows before this one, in parallel within a group.

    A group is split into buckets by hash; a running sum over its bucket totals
    (BUCKETS rows at most) gives where each bucket begins.
    """
    w = F.col(weight) if weight else F.lit(1).cast("bigint")
    b = items.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(BUCKETS))).withColumn("_w", w)
    at = b.groupBy(F.col(group).alias("_g"), F.col("_b").alias("_c")).agg(F.sum("_w").alias("_n"))
    at = at.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("_g").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = F.coalesce(F.sum("_w").over(Window.partitionBy(group, "_b").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = b.withColumn("_own", own).join(at, (F.col(group) == F.col("_g")) & (F.col("_b") == F.col("_c")))
    return out.withColumn("rank", F.col("_before") + F.col("_own")).drop("_b", "_w", "_g", "_c", "_n", "_before", "_own")


def container_fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(container, pieces, tokens, unused) of every container."""
    return packed.groupBy("container").agg(F.count(F.lit(1)).alias("pieces"), F.sum("tokens").alias("tokens"), (F.lit(capacity) - F.sum("tokens")).alias("unused"))
