"""Score records: signals, resumable scoring, summaries by facet, reports as tables."""

from __future__ import annotations

import json
import os
import shutil
import subprocess
import tempfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftloom.functions.blocks import judge_reply
from draftloom.session import checkpoint

#: Severities a prose linter reports.
SEVERITIES = ["suggestion", "warning", "error"]
SCORE = "id string, field string, text_chars int, vale struct<available:boolean,alerts:int>, judge struct<score:int,rationale:string>, detector struct<score:double>"


def linear_score(vector: Column, coef: list[float], intercept: float) -> Column:
    """P(draft) of a vector under a linear head; an error where the lengths differ; null for a null vector."""
    w = F.array(*[F.lit(float(c)) for c in coef])
    z = F.aggregate(F.zip_with(vector.cast("array<double>"), w, lambda a, b: a * b), F.lit(float(intercept)), lambda a, x: a + x)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return F.when(vector.isNull(), F.lit(None)).when(F.size(vector) != len(coef), F.raise_error(F.lit(f"expected vectors of {len(coef)}")).cast("double")).otherwise(p)


def bucketize(score: Column, edges: list[float]) -> Column:
    """How many edges the score has reached."""
    return F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda e: score >= e))


def quantile_edges(scores: DataFrame, score: str = "score", side: str = "side") -> DataFrame:
    """(side, p50, p75, p95) of the scores of each side: the ladder that buckets are calibrated on."""
    q = scores.groupBy(side).agg(F.percentile(score, F.array(F.lit(0.5), F.lit(0.75), F.lit(0.95))).alias("q"))
    return q.select(side, *[F.get("q", i).alias(n) for i, n in enumerate(("p50", "p75", "p95"))])


def aggregate(rows: DataFrame, by: list[str]) -> DataFrame:
    """n and the mean of each signal; a linter counts where it was available, a mean of nothing is null."""
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg("judge.score").alias("mean_judge"), F.avg(F.when(F.col("vale.available"), F.coalesce("vale.alerts", F.lit(0)))).alias("mean_vale"), F.avg("detector.score").alias("mean_detector")
    )


def facet_key(c: Column, kind: str) -> Column:
    """A facet's value as text: 'null' for null, True and False for booleans."""
    return F.coalesce(F.initcap(c.cast("string")) if kind == "boolean" else c.cast("string"), F.lit("null"))


def facet_summary(rows: DataFrame, measures: list[Column], facet: Column, field: Column) -> DataFrame:
    """Totals by field and by (field, facet) in one pass of grouping sets; the total's facet is null and level 1."""
    t = rows.withColumn("facet", facet).withColumn("field", field)
    return t.groupingSets([["field"], ["field", "facet"]], "field", "facet").agg(F.grouping("facet").cast("int").alias("level"), *measures)


def with_texts(scores: DataFrame, pairs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Scores with the text of their pair, or a note that it is missing; of repeated pairs the last (by ord)."""
    last = pairs.groupBy(id_col).agg(F.max_by(text_col, "ord").alias("_t"))
    return scores.join(last, id_col, "left").withColumn(text_col, F.coalesce("_t", F.lit("(text unavailable)"))).drop("_t")


def paired_report(scores: DataFrame, a: str = "slop", b: str = "target") -> DataFrame:
    """(id, draft, rewrite, delta) of detector scores, largest fall first, unscored last."""
    p = scores.groupBy("id").agg(F.max(F.when(F.col("field") == a, F.col("detector.score"))).alias("draft"), F.max(F.when(F.col("field") == b, F.col("detector.score"))).alias("rewrite"))
    return p.withColumn("delta", F.round(F.col("draft") - F.col("rewrite"), 2)).orderBy(F.desc_nulls_last("delta"), "id")


def alerts_by_severity(alerts: DataFrame) -> DataFrame:
    """(id, suggestion, warning, error) of linter alerts (id, severity); unknown severities are left out."""
    return alerts.groupBy("id").agg(*[F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES])


def count_by(rows: DataFrame, key: str, out: str = "rows") -> DataFrame:
    """How many rows each value of a key has, null too."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def gen_economics(rows: DataFrame) -> DataFrame:
    """Sums and ratios of generation a model; ratios over nothing are null. Columns: model, cost, gen_seconds and four kinds of tokens."""
    sums = rows.groupBy("model").agg(
        F.count(F.lit(1)).alias("pairs"), *[F.sum(c).alias(c) for c in ("cost", "gen_seconds", "prompt_tokens", "completion_tokens", "reasoning_tokens", "cached_tokens")]
    )
    return sums.withColumn("cost_per_pair", F.try_divide("cost", "pairs")).withColumn("cached_share", F.try_divide("cached_tokens", "prompt_tokens")).withColumn("tokens_per_second", F.try_divide("completion_tokens", "gen_seconds"))


def covariate_table(rows: DataFrame, id_col: str, first: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """(table, constants): id, the facet columns in order, the rest by name; columns with one value over several rows are taken out.

    All columns are examined in one pass; a null is a value.
    """
    cols = [c for c in rows.columns if c != id_col]
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00"))
    probe = rows.agg(F.count(F.lit(1)).alias("_n"), *[F.struct(F.min(text(c)).alias("lo"), F.max(text(c)).alias("hi")).alias(c) for c in cols]).first()
    constants = {c: ("null" if probe[c]["lo"] == "\x00" else probe[c]["lo"]) for c in cols if probe["_n"] > 1 and probe[c]["lo"] == probe[c]["hi"]}
    keep = [c for c in first if c in cols and c not in constants]
    shown = [id_col, *keep, *sorted(c for c in cols if c not in constants and c not in keep)]
    return rows.select(*[F.col(f"`{c}`") for c in shown]), constants


def flatten(schema, sep: str = ".") -> list[Column]:
    """Scalar leaves of nested structs as dotted columns; arrays and maps are left out."""
    from pyspark.sql.types import ArrayType, MapType, StructType

    out: list[Column] = []

    def walk(fields, path: list[str]) -> None:
        for f in fields:
            here = [*path, f.name]
            if isinstance(f.dataType, StructType):
                walk(f.dataType.fields, here)
            elif not isinstance(f.dataType, (ArrayType, MapType)):
                out.append(F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here)))

    walk(schema.fields, [])
    return out


Signal = Callable[[str], dict | None]


def prose_linter(binary: str = "vale", config: str | None = None) -> Signal:
    """A signal from a prose linter on the workers' path, run on a Markdown file, since styles are scoped by file name.

    Where the binary is missing, fails or answers with an error the signal is
    not available, and nothing is raised.
    """

    def lint(text: str) -> dict:
        none = {"available": False, "alerts": 0}
        exe = shutil.which(binary)
        if exe is None:
            return none
        with tempfile.TemporaryDirectory() as d:
            path = os.path.join(d, "text.md")
            with open(path, "w", encoding="utf-8") as f:
                f.write(text)
            try:
                said = subprocess.run([exe, "--output=JSON", *([f"--config={config}"] if config else []), path], capture_output=True, text=True, check=False).stdout
                found = json.loads(said)
            except (OSError, ValueError):
                return none
        if not isinstance(found, dict) or found.get("Code"):
            return none
        return {"available": True, "alerts": sum(isinstance(a, dict) for alerts in found.values() if isinstance(alerts, list) for a in alerts)}

    return lint


def judge(ask: Callable[[str], str]) -> Signal:
    """A signal from a judge's replies: ``ask`` sends a text and returns the reply."""
    return lambda text: dict(zip(("score", "rationale"), judge_reply(ask(text))))


def score_rows(rows: DataFrame, done: DataFrame, signals: dict[str, Signal], id_col: str = "id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(records, errors) of rows not scored yet, each id once; a signal that raises gives an error row, not a failed job.

    ``signals`` are injected callables (judge, linter, detector) that return a
    struct's fields; missing ones stay null.
    """
    fresh = rows.join(done.select(id_col).distinct(), id_col, "left_anti").dropDuplicates([id_col])
    schema = "id string, ok boolean, error string, text_chars int, vale struct<available:boolean,alerts:int>, judge struct<score:int,rationale:string>, detector struct<score:double>"
    names = ["vale", "judge", "detector"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, t in zip(b["id"], b["text"]):
                try:
                    got = {k: signals[k](t or "") if k in signals else None for k in names}
                    out.append((i, True, None, len(t or ""), *[got[k] for k in names]))
                except Exception as e:  # noqa: BLE001
                    out.append((i, False, f"{type(e).__name__}: {e}", len(t or ""), None, None, None))
            yield pd.DataFrame(out, columns=["id", "ok", "error", "text_chars", *names])

    both = fresh.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInPandas(run, schema)
    both = checkpoint(both)  # signals may be paid for: they run once, and a lost executor does not run them again
    return both.filter("ok").drop("ok", "error"), both.filter("not ok").select("id", "error")
