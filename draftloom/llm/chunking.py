"""Oversized texts cut into overlapping pieces at natural boundaries.

Method: a recursive separator hierarchy (section, paragraph, sentence, word,
character) cuts a text into atoms; atoms are packed greedily up to the limit,
and every piece after the first begins with the tail of the piece before.
Only texts above the limit leave the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftloom.operators.ranks import ranked

LIMIT, OVERLAP = 8000, 200

#: Ends of units, strongest first. Each match's end is a place to cut.
BOUNDARIES = [
    re.compile(r"(?:\r\n|\n|\r)(?=[ ]{0,3}#{1,6}[ \t]|=+[^=\r\n]+=+[ \t]*(?:\r|\n|$)|\\(?:sub)*section\b)"),
    re.compile(r"(?:\r\n|\n|\r)(?:[ \t\xa0]*(?:\r\n|\n|\r))+"),
    re.compile(r"[.!?…][\"'”’»)\]]*(?:\s+|$)|[。！？]+[」』”’]*|\r\n|\n|\r"),
    re.compile(r"\s+"),
]
_CLUSTER = re.compile("[̀-ͯ᪰-᫿⃐-⃿︀-️‍\U0001f3fb-\U0001f3ff]")


def _char_cuts(text: str, start: int, end: int, size: int) -> Iterator[int]:
    """Cuts every ``size`` characters, moved left off combining marks and CRLF."""
    at = start + size
    while at < end:
        cut = at
        while cut > start + 1 and (_CLUSTER.match(text[cut]) or text[cut - 1] == "‍" or text[cut - 1 : cut + 1] == "\r\n"):
            cut -= 1
        if cut <= start + 1:
            cut = at  # nothing but marks: any cut is as good
        yield cut
        start, at = cut, cut + size


def atoms(text: str, start: int, end: int, size: int, level: int = 0) -> list[int]:
    """Ends of consecutive atoms of [start, end), none longer than ``size``."""
    if end - start <= size:
        return [end]
    if level == len(BOUNDARIES):
        return [*_char_cuts(text, start, end, size), end]
    ends = [m.end() for m in BOUNDARIES[level].finditer(text, start, end) if start < m.end() < end]
    out: list[int] = []
    for e in [*ends, end]:
        out += [e] if e - start <= size else atoms(text, start, e, size, level + 1)
        start = e
    return out


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(start, end) of the pieces; each later start is the last end less the overlap (0 at least).

    Sections and paragraphs are preferred: the pack ends at the strongest
    boundary that keeps it at least half full, else at the last atom that fits.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and under the limit")
    n = len(text)
    if n <= limit:
        return [(0, n)]
    ends = atoms(text, 0, n, limit - overlap)
    strong = [{m.end() for m in b.finditer(text)} for b in BOUNDARIES[:2]]
    out, start, body, i = [], 0, 0, 0
    while True:
        j = i
        while j < len(ends) and ends[j] - start <= limit:
            j += 1
        if j == len(ends):
            out.append((start, n))
            return out
        pick = j - 1
        for marks in strong:
            k = j - 1
            while k > i and not (ends[k] in marks):
                k -= 1
            if ends[k] in marks and ends[k] - start >= limit // 2:
                pick = k
                break
        out.append((start, ends[pick]))
        body = ends[pick]
        start = max(body - overlap, 0)
        i = pick + 1


def split_oversized(df: DataFrame, id_col: str, text_col: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Pieces of every text above ``limit`` code points, one row a piece.

    Result: id, piece_index (from 0), piece_total, piece_start, piece_end
    (code points), piece. Null, empty and short texts give no row. Rows that
    repeat an id and a text count once; an id with several oversized texts
    gives the pieces of the smallest of them.
    """
    schema = f"{id_col} {df.schema[id_col].dataType.simpleString()}, piece_index int, piece_total int, piece_start int, piece_end int, piece string"

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for key, text in zip(b.iloc[:, 0], b.iloc[:, 1]):
                spans = pieces(text, limit, overlap)
                rows += [(key, k, len(spans), s, e, text[s:e]) for k, (s, e) in enumerate(spans)]
            yield pd.DataFrame(rows, columns=[id_col, "piece_index", "piece_total", "piece_start", "piece_end", "piece"])

    big = df.select(F.col(id_col), F.col(text_col).alias("_text")).filter(F.length("_text") > limit)
    return big.groupBy(id_col).agg(F.min("_text").alias("_text")).mapInPandas(cut, schema)


def rejoined(cut: DataFrame, id_col: str) -> DataFrame:
    """(id, text): the texts that pieces were cut from; of each piece what lies beyond the one before."""
    of = F.array_sort(F.collect_list(F.struct("piece_start", "piece_end", "piece")))  # the pieces of one text
    parts = cut.groupBy(id_col).agg(of.alias("p"))
    seen = lambda i: F.coalesce(F.get("p", i - 1)["piece_end"], F.lit(0))
    beyond = F.transform("p", lambda x, i: F.substring(x["piece"], seen(i) - x["piece_start"] + 1, F.length(x["piece"])))
    return parts.select(id_col, F.array_join(beyond, "").alias("text"))


def rechunk_targets(targets: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """The whole targets table with oversized texts cut and chunk numbers put right.

    chunk_total is the number of pieces of the source after cutting and
    chunk_index their order (old chunk_index, target_id, piece). Repeated rows
    of a target_id count once. Null sources form one group; a null text stays
    one row. Result: target_id, source, piece_index, piece_total, chunk_index,
    chunk_total, text.
    """
    once = targets.groupBy("target_id").agg(
        F.min("source").alias("source"), F.min("chunk_index").alias("_o"), F.max(F.length("text")).alias("_n"),
        F.max(F.when(F.length("text") <= limit, F.col("text"))).alias("_short"),
    )
    cut = split_oversized(targets, "target_id", "text", limit, overlap)
    short = once.filter(F.coalesce(F.col("_n") <= limit, F.lit(True))).select("target_id", "source", "_o", F.lit(0).alias("piece_index"), F.lit(1).alias("piece_total"), F.col("_short").alias("text"))
    long = cut.join(once.select("target_id", "source", "_o"), "target_id").select("target_id", "source", "_o", "piece_index", "piece_total", F.col("piece").alias("text"))
    rows = short.unionByName(long).withColumn("_o", F.coalesce("_o", F.lit(2**31 - 1)))
    out = ranked(rows, "source", ["_o", "target_id", "piece_index"], "chunk_index")
    return out.select("target_id", "source", "piece_index", "piece_total", F.col("chunk_index").cast("int").alias("chunk_index"), F.col("_total").cast("int").alias("chunk_total"), "text")
