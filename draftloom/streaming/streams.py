"""Structured Streaming: the line scorer, append-once sinks, latest versions, capture sessions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from draftloom.operators import ranks
from draftloom.operators.joins import lookup

REQUEST = "id string, op string, texts array<string>"


def answers(lines: DataFrame, score: Callable[[Column], Column], meta: dict[str, str]) -> DataFrame:
    """(value) one JSON answer a request line: scores, meta, or an error of that line; blank lines are passed over.

    Stateless, so it runs the same on a stream and on a table.
    """
    r = lines.filter(F.trim("value") != "").withColumn("r", F.from_json("value", REQUEST))
    op = F.coalesce(F.col("r.op"), F.lit("score"))
    scored = F.to_json(F.struct(F.col("r.id").alias("id"), F.transform("r.texts", score).alias("scores")))
    about = F.to_json(F.struct(F.col("r.id").alias("id"), F.create_map(*[x for k, v in meta.items() for x in (F.lit(k), F.lit(v))]).alias("meta")))
    error = lambda m: F.to_json(F.struct(F.col("r.id").alias("id"), m.alias("error")))
    bad = F.col("r").isNull() | (F.col("r.id").isNull() & F.col("r.texts").isNull() & F.col("r.op").isNull())
    value = (
        F.when(bad, error(F.lit("not a request"))).when(op == "meta", about).when((op == "score") & F.col("r.texts").isNotNull(), scored)
        .when(op == "score", error(F.lit("texts missing"))).otherwise(error(F.concat(F.lit("unknown op "), op)))
    )
    return r.select(value.alias("value"))


#: Parts that the keys of an append-once table are spread over.
PARTS = 256


def append_once(stream: DataFrame, path: str, checkpoint: str, key: str) -> StreamingQuery:
    """Append the rows of a stream whose key is not in the table yet, each key once; a replayed batch adds nothing.

    The table is parted by a hash of the key, so that a batch reads the keys of
    the parts that it touches and no others.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates([key]).withColumn("part", F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int"))
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            touched = [r[0] for r in new.select("part").distinct().collect()]
            # the batch's own folder is left out: a replay rewrites it
            old = spark.read.parquet(path).filter((F.col("batch") != number) & F.col("part").isin(touched))
            new = new.join(old.select(key, "part"), [key, "part"], "left_anti").select(*new.columns)
        new.write.mode("overwrite").partitionBy("part").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_version(changes: DataFrame, key: str, version: str) -> DataFrame:
    """Of each key the row with the highest version: a debounce that drops what is stale. For batches and complete-mode streams."""
    cols = [c for c in changes.columns if c != key]
    return changes.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(version)).alias("_r")).select(key, "_r.*")


def capture_sessions(events: DataFrame) -> DataFrame:
    """(source, snapped_at, before, after, reason) from a stream of capture commands (source, op, at, content).

    ``open`` keeps a snapshot (a second open is sticky: it keeps the first);
    ``save`` gives the change since the snapshot and keeps the session open, so
    a later save of the session replaces it (same snapped_at); ``drop`` forgets.
    A save without a session, or of an unchanged text, gives nothing.
    """
    out = "source string, snapped_at string, before string, after string, reason string"

    def update(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else None
        rows = []
        x = pd.concat(list(frames)).sort_values("at", kind="stable")
        for op, at, content in zip(x["op"], x["at"], x["content"]):
            if op == "open" and held is None:
                held = (at, content)
            elif op == "save" and held is not None and content != held[1]:
                rows.append((key[0], held[0], held[1], content, "save"))
            elif op == "drop":
                held = None
        if held is None:
            if state.exists:
                state.remove()
        else:
            state.update(held)
        yield pd.DataFrame(rows, columns=["source", "snapped_at", "before", "after", "reason"])

    from pyspark.sql.streaming.state import GroupStateTimeout

    return events.groupBy("source").applyInPandasWithState(update, out, "snapped_at string, content string", "append", GroupStateTimeout.NoTimeout)


def capture_batch(events: DataFrame) -> DataFrame:
    """The last save of each capture session of a finished log; columns as ``capture_sessions``.

    Drops are counted in ranges of the log, so a source with a third of all
    events is no single task; a session's first open and last save are
    pre-aggregated. Of events at one time opens come before saves.
    """
    e = ranks.running(events.select("source", "op", "at", "content", F.when(F.col("op") == "drop", 1).otherwise(0).alias("_drop")), "source", ["at", "op"], "_drop", "drops")
    opened = e.filter("op = 'open'").groupBy(F.struct("source", "drops").alias("of")).agg(F.min(F.struct("at", "op", "content")).alias("o"))
    saves = lookup(e.filter("op = 'save'"), opened, F.struct("source", "drops"), "of", "inner")
    saves = saves.filter((F.struct("at", "op") > F.struct("o.at", "o.op")) & (F.col("content") != F.col("o.content")))
    last = saves.groupBy("source", F.col("o.at").alias("snapped_at")).agg(F.max_by(F.struct(F.col("o.content").alias("before"), F.col("content").alias("after")), "at").alias("x"))
    return last.select("source", "snapped_at", "x.before", "x.after", F.lit("save").alias("reason"))
