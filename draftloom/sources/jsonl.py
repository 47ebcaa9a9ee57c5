"""JSON lines: a tolerant reader, and sinks that append, rewrite and delete."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The known keys of a pair record.
GEN = "struct<model:string,reasoning_effort:string,temperature:double,top_p:double,max_tokens:int,finish_reason:string,prompt_tokens:int,completion_tokens:int,reasoning_tokens:int,cached_tokens:int,cost:double,gen_seconds:double,provider:string,provider_sort:string,prompt_id:string,prompt_version:int,prompt_label:string,replicate:string,session_id:string,session_turn:int,context_window:int,window_fill:double>"
META = f"struct<source:string,captured_at:string,capture_id:string,chunk_index:int,chunk_total:int,snapped_at:string,context:string,transform_sim:double,synthetic:boolean,generator:string,slop_strategy:string,synth_key:string,tags:array<string>,gen:{GEN}>"
PAIR = f"messages array<struct<role:string,content:string>>, meta {META}"


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType, keep_raw: bool = False) -> DataFrame:
    """One row a JSON object; blank lines, undecodable lines and other JSON values are dropped.

    With ``keep_raw`` they stay, with all fields null and the line in ``_raw``,
    and every line's text is in ``_line``, so that a rewrite can give it back.
    A missing path is an empty table.
    """
    if not spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(path)):
        lines = spark.createDataFrame([], "value string")
    else:
        lines = spark.read.text(path)
    lines = lines.filter(F.trim(F.regexp_replace("value", r"(?U)\s", "")) != "")
    kind = F.schema_of_variant(F.try_parse_json("value"))
    is_object = F.coalesce(F.startswith(kind, F.lit("OBJECT")), F.lit(False))
    out = lines.withColumn("_ok", is_object).withColumn("_r", F.from_json("value", schema))
    if not keep_raw:
        return out.filter("_ok").select("_r.*")
    return out.select(F.when(F.col("_ok"), F.col("_r")).alias("_r"), F.when(~F.col("_ok"), F.col("value")).alias("_raw"), F.col("value").alias("_line")).select("_r.*", "_raw", "_line")


def append_jsonl(rows: DataFrame, path: str) -> None:
    """Append the rows as JSON lines; nulls are left out."""
    rows.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(path)


def rewrite_jsonl(rows: DataFrame, path: str) -> None:
    """Replace a folder of JSON lines that ``rows`` may still be read from: stage beside it, then swap.

    A ``_line`` column is written as it is, otherwise the row as JSON.
    """
    line = F.col("_line") if "_line" in rows.columns else F.to_json(F.struct("*"))
    stage = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    rows.select(line.alias("value")).write.text(stage)
    jvm = rows.sparkSession._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(rows.sparkSession._jsc.hadoopConfiguration())
    old = jvm.org.apache.hadoop.fs.Path(f"{stage}.old")
    if fs.exists(jvm.org.apache.hadoop.fs.Path(path)):
        fs.rename(jvm.org.apache.hadoop.fs.Path(path), old)
    fs.rename(jvm.org.apache.hadoop.fs.Path(stage), jvm.org.apache.hadoop.fs.Path(path))
    fs.delete(old, True)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def remove_source(spark: SparkSession, path: str, source: str) -> int:
    """Delete the pairs of one source; other lines stay as written, undecodable ones too. Returns how many went."""
    rows = read_jsonl(spark, path, PAIR, keep_raw=True)
    gone = F.coalesce(F.col("meta.source") == source, F.lit(False)) & F.col("_raw").isNull()
    n = rows.filter(gone).count()
    if n:
        rewrite_jsonl(rows.filter(~gone).select("_line"), path)
    return n


def archive_prompts(prompts: DataFrame, path: str) -> int:
    """Append prompts whose prompt_id is not there yet; returns how many were new."""
    spark = prompts.sparkSession
    seen = read_jsonl(spark, path, "prompt_id string").select("prompt_id")
    new = prompts.dropDuplicates(["prompt_id"]).join(seen, "prompt_id", "left_anti").persist()
    n = new.count()
    if n:
        append_jsonl(new, path)
    new.unpersist()
    return n


def split_reasoning(rows: DataFrame, key: str = "synth_key", column: str = "reasoning") -> tuple[DataFrame, DataFrame]:
    """(rows without the reasoning, the reasoning keyed by ``key`` where there is any)."""
    return rows.drop(column), rows.filter(F.coalesce(F.col(column), F.lit("")) != "").select(key, column)


def export_conversations(pairs: DataFrame, path: str) -> None:
    """Messages only, as JSON lines."""
    pairs.select("messages").write.mode("overwrite").json(path)


def export_table(table: DataFrame, path: str, source_hash: str, constants: dict[str, str], extra: dict | None = None) -> dict:
    """A CSV folder with a header, and beside it a JSON of its provenance, which is returned."""
    table.write.mode("overwrite").option("header", True).csv(path)
    side = {"source_sha": source_hash, "rows": table.sparkSession.read.option("header", True).csv(path).count(), "columns": table.columns, "constants": constants} | (extra or {})
    write_json(table.sparkSession, f"{path.rstrip('/')}.meta.json", side)
    return side


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """One JSON file (manifest, splits, artifact) on the file system of its path."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(json.dumps(value, ensure_ascii=False, indent=1).encode()))
    out.close()


def read_json(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """A JSON file; ``version`` must equal its schema_version."""
    value = json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))
    if version is not None and value.get("schema_version") != version:
        raise ValueError(f"{path}: schema_version {value.get('schema_version')}, expected {version}")
    return value


def file_hash(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha): 16 hex digits of sha-256 of each file."""
    return spark.read.format("binaryFile").load(path).select("path", F.substring(F.sha2("content", 256), 1, 16).alias("sha"))


def setting(flag: str | None, env: str, default: str | None = None) -> str:
    """A flag, else the environment, else the default; an error if there is none."""
    value = flag or os.environ.get(env) or default
    if not value:
        raise ValueError(f"set {env}")
    return value


def final_metrics(log: DataFrame) -> DataFrame:
    """(key, value) of a training log (line_no, key, value): the last value of each loss key, the sum of token counts."""
    last = log.filter("key not like '%tokens%'").groupBy("key").agg(F.max_by("value", "line_no").alias("value"))
    total = log.filter("key like '%tokens%'").groupBy("key").agg(F.sum("value").alias("value"))
    return last.unionByName(total)
