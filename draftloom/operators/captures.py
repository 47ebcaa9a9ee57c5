"""Capture sessions kept in a folder: open a text, save what was changed since, drop."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from draftloom.functions import text
from draftloom.operators.pairs import diff_captures
from draftloom.sources import jsonl

SESSION = "source string, snapped_at string, content string"


def open_sessions(spark: SparkSession, store: str) -> DataFrame:
    """(source, snapped_at, content) of every open session."""
    return jsonl.read_jsonl(spark, store, SESSION)


def open_session(spark: SparkSession, store: str, source: str, content: str, at: str | None = None) -> str:
    """Record a text as the state before a rewrite; returns the session's time. A session is sticky: a second open is an error."""
    if open_sessions(spark, store).filter(F.col("source") == source).take(1):
        raise ValueError(f"a session is open for {source}")
    at = at or dt.datetime.now(dt.timezone.utc).isoformat(timespec="microseconds")
    jsonl.append_jsonl(spark.createDataFrame([(source, at, content)], SESSION), store)
    return at


def drop_session(spark: SparkSession, store: str, source: str) -> bool:
    """Forget a session; whether there was one."""
    rows = jsonl.read_jsonl(spark, store, SESSION, keep_raw=True)
    mine = F.coalesce(F.col("source") == source, F.lit(False)) & F.col("_raw").isNull()
    if not rows.filter(mine).take(1):
        return False
    jsonl.rewrite_jsonl(rows.filter(~mine).select("_line"), store)
    return True


def save_session(spark: SparkSession, store: str, pairs: str, source: str, content: str, system: str, earlier: str = "smart", keep_open: bool = False, whole: bool = False, heading_context: bool = True, tags: list[str] | None = None) -> int:
    """Append the pairs of what changed since the session was opened; returns how many.

    ``earlier`` says what becomes of the source's pairs in the corpus: 'smart'
    replaces those of this session (saved before with ``keep_open``), 'replace'
    all of them, 'append' none. ``whole`` gives one pair for the text instead
    of one a changed region. Nothing open or nothing changed is an error.
    """
    if earlier not in ("smart", "replace", "append"):
        raise ValueError(earlier)
    found = open_sessions(spark, store).filter(F.col("source") == source).first()
    if found is None:
        raise ValueError(f"no session is open for {source}")
    if found["content"] == content:
        raise ValueError(f"{source} is as it was when the session was opened")
    both = spark.createDataFrame([(source, found["content"], content)], "source string, before string, after string")
    if whole:
        d = both.select("source", F.lit(0).alias("chunk_index"), F.lit(1).alias("chunk_total"), F.lit("").alias("context"), "before", "after")
    else:
        d = diff_captures(both)
        d = d if heading_context else d.withColumn("context", F.lit(""))
    d = d.persist()
    n = d.count()
    if not n:
        raise ValueError("no paragraph was changed")
    if earlier != "append":
        rows = jsonl.read_jsonl(spark, pairs, jsonl.PAIR, keep_raw=True)
        gone = F.col("_raw").isNull() & F.coalesce(F.col("meta.source") == source, F.lit(False))
        if earlier == "smart":
            gone = gone & F.coalesce(F.col("meta.snapped_at") == found["snapped_at"], F.lit(False))
        if rows.filter(gone).take(1):
            jsonl.rewrite_jsonl(rows.filter(~gone).select("_line"), pairs)
    said = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    now = dt.datetime.now(dt.timezone.utc).isoformat(timespec="microseconds")
    context = F.nullif("context", F.lit(""))
    meta = F.struct(
        "source", F.lit(now).alias("captured_at"), F.lit(uuid.uuid4().hex[:8]).alias("capture_id"), "chunk_index", "chunk_total", F.length("before").alias("before_chars"), F.length("after").alias("after_chars"),
        F.lit(found["snapped_at"]).alias("snapped_at"), context.alias("context"), F.when(context.isNotNull(), F.lit("immediate")).alias("context_mode"), (F.array(*[F.lit(t) for t in tags]) if tags else F.lit(None).cast("array<string>")).alias("tags"),
    )
    jsonl.append_jsonl(d.select(F.array(said("system", F.lit(system)), said("user", text.pair_content(F.col("context"), F.col("before"))), said("assistant", text.pair_content(F.col("context"), F.col("after")))).alias("messages"), meta.alias("meta")), pairs)
    d.unpersist()
    if not keep_open:
        drop_session(spark, store, source)
    return n
