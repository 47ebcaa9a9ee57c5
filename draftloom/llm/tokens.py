"""Byte-level BPE ids of a corpus, in Spark expressions.

Method: distinct words are split into bytes (as hex pairs) and folded by ranked
merges with higher-order functions over a literal rank map. The map is a
literal array of small maps, so a lookup costs one hash and a few comparisons.
A bounded literal of the commonest words codes most words in place; the rest
are joined by word. Decoding concatenates the tokens' binary pieces.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from draftloom.session import checkpoint, scratch, spread

#: Fixed value: white space as the pre-tokeniser counts it.
_WS = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Fixed value: the pre-tokeniser's words.
WORDS = rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
NONE = 2**31 - 1
#: Words coded by a literal: so many at most, of so many bytes each at most, so that the plan's size has a bound.
HOT, HOT_BYTES = 49152, 64
#: Bytes of a word that the fold merges; longer ones are merged by a heap, with the same result.
LONG = 256
#: Words of a text handled as one row; longer texts are cut between words.
BLOCK = 2048


def load_ranks(path: str = TOKENIZER) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _literal(spark: SparkSession, entries: dict[str, object], value_type: str) -> tuple[Column, int]:
    """A literal array of maps and its length; entry k is in the map numbered crc32(k) mod length.

    It is made from Spark's binary form of the value: a plan's mentions of it
    share the one block of bytes, and descriptions of the plan, which Spark
    keeps on the driver and logs at each step, do not spell it out.
    """
    n = max(1, len(entries) // 4)
    shelves: list[dict[str, object]] = [{} for _ in range(n)]
    for k, v in entries.items():
        shelves[zlib.crc32(k.encode()) % n][k] = v
    row = spark.createDataFrame([(json.dumps(shelves, separators=(",", ":")),)], "j string").select(F.from_json("j", f"array<map<string,{value_type}>>"))._jdf
    value = row.queryExecution().executedPlan().executeCollect()[0].getArray(0)
    sql = spark._jvm.org.apache.spark.sql
    return Column(sql.classic.ExpressionUtils.column(sql.catalyst.expressions.Literal(value, row.schema().fields()[0].dataType()))), n


def _find(literal: tuple[Column, int], key: Column) -> Column:
    shelves, n = literal
    return F.element_at(F.get(shelves, (F.crc32(key.cast("binary")) % n).cast("int")), key)


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), the value computed once: lambdas have no common subexpressions."""
    return F.get(F.transform(F.array(value), f), 0)


def merge_word(word: Column, ranks: tuple[Column, int]) -> Column:
    """The token ids of one word: bytes, then the lowest-ranked leftmost pair merged until none is left.

    The state keeps the parts, the rank of each neighbouring pair and the
    lowest of them, so a merge looks up only the two pairs it makes.
    """
    rank = lambda a: F.coalesce(_find(ranks, a), F.lit(NONE))
    no_rank, no_part = F.array().cast("array<int>"), F.array().cast("array<string>")
    state = lambda p, r: _let(r, lambda x: F.struct(p.alias("p"), x.alias("r"), F.coalesce(F.array_min(x), F.lit(NONE)).alias("best")))

    def merged(s: Column) -> Column:
        p, r = s["p"], s["r"]

        def at_pair(x: Column) -> Column:  # x: place of the pair, its parts, joined
            at = x["at"]
            left = F.when(at > 1, F.array(rank(F.concat(F.get(p, at - 2), x["joined"])))).otherwise(no_rank)
            right = F.when(at < F.size(r), F.array(rank(F.concat(x["joined"], F.get(p, at + 1))))).otherwise(no_rank)
            parts = F.concat(F.slice(p, F.lit(1), at - 1), F.array(x["joined"]), F.slice(p, at + 2, F.size(p)))
            near = F.concat(F.slice(r, F.lit(1), F.greatest(at - 2, F.lit(0))), left, right, F.slice(r, at + 2, F.size(r)))
            return state(parts, near)

        pair = _let(F.array_position(r, s["best"]).cast("int"), lambda at: F.struct(at.alias("at"), F.concat(F.get(p, at - 1), F.get(p, at)).alias("joined")))
        return _let(pair, at_pair)

    def fold(parts: Column) -> Column:
        pairs = F.zip_with(F.slice(parts, F.lit(1), F.size(parts) - 1), F.slice(parts, F.lit(2), F.size(parts) - 1), lambda a, b: rank(F.concat(a, b)))
        step = lambda s, _: F.when(s["best"] == NONE, s).otherwise(merged(s))
        return F.aggregate(F.sequence(F.lit(2), F.greatest(F.size(parts), F.lit(2))), state(parts, pairs), step, lambda s: s["p"])

    parts = F.coalesce(F.regexp_extract_all(F.hex(F.encode(word, "UTF-8")), F.lit("(..)"), 1), no_part)
    return F.transform(_let(parts, fold), lambda p: _find(ranks, p))


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same ids as ``merge_word``, by a heap of pairs over linked parts: n log n for a word of n bytes."""
    n = len(word)
    after, before, ends = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    gone = bytearray(n)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i]
        if gone[i] or j >= n or ends[j] != end:
            continue  # one of the two has been merged since
        gone[j], ends[i], after[i] = 1, end, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(word[i : ends[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, ends[after[i]]))
        if before[i] >= 0 and (r := ranks.get(word[before[i] : end])) is not None:
            heapq.heappush(heap, (r, before[i], end))
    return [ranks[word[i : ends[i]]] for i in range(n) if not gone[i]]


def code_words(words: DataFrame, ranks: dict[bytes, int], long: int = LONG) -> DataFrame:
    """(w, ...) with ids: whole-word tokens by one look-up, others by the fold; null for words above ``long`` bytes."""
    literal = _literal(words.sparkSession, {k.hex().upper(): v for k, v in ranks.items()}, "int")
    first = words.withColumn("_id", _find(literal, F.hex(F.encode("w", "UTF-8"))))
    ids = F.when(F.col("_id").isNotNull(), F.array("_id")).when(F.octet_length("w") <= long, merge_word(F.col("w"), literal))
    return first.select(*words.columns, ids.alias("ids"))


def code_long_words(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(w, n) with the ids of words of any length, merged by ``merge_long`` in Arrow batches."""

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(ids=[merge_long(w.encode(), ranks) for w in b["w"]])

    return words.mapInPandas(merge, "w string, n bigint, ids array<int>")


def encode(docs: DataFrame, id_col: str, text_col: str, path: str = TOKENIZER, hot: int = HOT, block: int = BLOCK, long: int = LONG) -> DataFrame:
    """(id, ids array<int>) of every row of docs.

    Empty and null texts have an empty list; strings that look like special
    tokens are ordinary text. Rows that repeat an id count once; of
    different texts under one id the one with the smallest hash is taken. Null
    ids are one id. A word of any length is coded exactly.
    """
    spark = docs.sparkSession
    src = spread(docs.select(F.col(id_col).alias("_id0"), F.col(text_col).alias("_t")))
    words = F.regexp_extract_all("_t", F.lit(WORDS), 0)

    ranks = load_ranks(path)
    counted = src.select(F.explode(words).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    coded = checkpoint(code_words(counted, ranks, long))
    if coded.filter("ids is null").take(1):
        coded = checkpoint(coded.filter("ids is not null").unionByName(code_long_words(coded.filter("ids is null").select("w", "n"), ranks)))
    top = coded.filter(F.octet_length("w") <= HOT_BYTES).orderBy(F.desc("n"), "w").limit(hot).select("w", "ids").collect()
    shelf = _literal(spark, {r["w"]: r["ids"] for r in top}, "array<int>")

    def look(ws: Column, b: Column) -> Column:
        """The ids of a block of words; -1 - k stands for word k if the literal lacks it, and is listed in ``open`` with its place."""
        found = F.flatten(F.transform(ws, lambda w, k: F.coalesce(_find(shelf, w), F.array(-k - 1))))
        gaps = lambda ids: F.transform(F.filter(ids, lambda x: x < 0), lambda x: F.struct(F.array_position(ids, x).cast("int").alias("k"), F.get(ws, -x - 1).alias("w")))
        return _let(found, lambda ids: F.struct(b.alias("b"), ids.alias("ids"), gaps(ids).alias("open")))

    def cut(ws: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.floor((F.size(ws) - 1) / block).cast("int")), lambda b: F.slice(ws, b * block + 1, F.lit(block)))
        return F.transform(F.when(F.size(ws) <= block, F.array(ws)).otherwise(many), look)

    blocks = src.select("_id0", F.coalesce(F.xxhash64("_t"), F.lit(0)).alias("h"), F.explode(_let(F.coalesce(words, F.array().cast("array<string>")), cut)).alias("x"))
    part = blocks.select("_id0", "h", "x.*")
    kind = "array<struct<k:int,ids:array<int>>>"
    if coded.count() > len(top):  # words beyond the literal: joined by word; written once, since both sides of the join come of it
        at = scratch(spark, "coded-blocks")
        part.write.parquet(at)
        part = spark.read.parquet(at)
        open_ = part.filter(F.size("open") > 0).select("_id0", "h", "b", F.explode("open").alias("o")).select("_id0", "h", "b", "o.k", "o.w")
        got = open_.join(coded.select("w", "ids"), "w").groupBy("_id0", "h", "b").agg(F.array_sort(F.collect_set(F.struct("k", "ids"))).alias("m"))
        rows = part.select("_id0", "h", "b", "ids", F.lit(None).cast(kind).alias("m")).unionByName(got.withColumn("ids", F.lit(None).cast("array<int>")))
    else:
        rows = part.select("_id0", "h", "b", "ids", F.lit(None).cast(kind).alias("m"))
    # one shuffle, by id, serves both aggregations
    filled = rows.repartition("_id0").groupBy("_id0", "h", "b").agg(F.max("ids").alias("ids"), F.max("m").alias("m"))
    start = lambda j: F.coalesce(F.get("m", j - 1)["k"], F.lit(0)) + 1
    end = lambda j: F.coalesce(F.get("m", j)["k"], F.size("ids") + 1)
    piece = lambda j: F.concat(F.slice("ids", start(j), end(j) - start(j)), F.coalesce(F.get("m", j)["ids"], F.array().cast("array<int>")))
    whole = F.when(F.col("m").isNull(), F.col("ids")).otherwise(F.flatten(F.transform(F.sequence(F.lit(0), F.size("m")), piece)))
    done = filled.select("_id0", F.struct("h", "b", whole.alias("ids")).alias("x")).groupBy("_id0").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    same = F.transform(F.filter("xs", lambda x: x["h"] == F.get("xs", 0)["h"]), lambda x: x["ids"])
    return done.select(F.col("_id0").alias(id_col), F.when(F.size("xs") == 1, F.get("xs", 0)["ids"]).otherwise(F.flatten(same)).alias("ids"))


def decode(coded: DataFrame, ids_col: str, path: str = TOKENIZER, out: str = "decoded") -> DataFrame:
    """Adds the text of the ids: the tokens' binary pieces, concatenated. Null for null or an unknown id."""
    literal = _literal(coded.sparkSession, {str(v): k.hex() for k, v in load_ranks(path).items()}, "string")
    hexes = F.transform(F.col(ids_col), lambda i: _find(literal, i.cast("string")))
    text = F.decode(F.unhex(F.array_join(hexes, "")), "UTF-8")
    return coded.withColumn(out, F.when(F.forall(hexes, lambda h: h.isNotNull()), text))
