"""Reports: tables aggregated in Spark, a bounded number of rows rendered on the driver."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftloom.operators import targets as T


def table_html(df: DataFrame, max_rows: int = 200, chars: int = 400) -> str:
    """An HTML table of the first rows in the frame's own order, long texts cut for display."""
    shown = df.select([F.substring(F.col(f"`{c}`").cast("string"), 1, chars).alias(c) for c in df.columns]).limit(max_rows).collect()
    head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
    body = "".join("<tr>" + "".join(f"<td>{html.escape(v or '')}</td>" for v in r) + "</tr>" for r in shown)
    return f"<table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table>"


def targets_report(targets: DataFrame, max_rows: int = 200) -> str:
    """The passages page: statistics over all, the longest rows shown."""
    stats = T.summary(targets).first().asDict()
    cards = "".join(f"<li>{html.escape(k)}: {v}</li>" for k, v in stats.items())
    bars = table_html(T.histogram(targets, F.length("text")).orderBy("bin"))
    return f"<html><body><ul>{cards}</ul>{bars}{table_html(T.sort_targets(targets, 'length'), max_rows)}</body></html>"


def sample_text(df: DataFrame, n: int = 5, seed: int = 0) -> str:
    """A seeded sample for the terminal, one row a line."""
    rows = df.orderBy(F.rand(seed)).limit(n).collect()
    return "\n".join(" | ".join(f"{k}={str(v)[:80]}" for k, v in r.asDict().items()) for r in rows)


def _badge(kind: str, text: str) -> str:
    return f'<span class="badge {kind}">{html.escape(text)}</span>'


def _cards(row: dict) -> str:
    return "<ul class=cards>" + "".join(f"<li>{html.escape(k)}: {html.escape('—' if v is None else f'{v:.3f}' if isinstance(v, float) else str(v))}</li>" for k, v in row.items()) + "</ul>"


def _bars(df: DataFrame) -> str:
    """A histogram (bin, lo, hi, n) as bars."""
    rows = df.orderBy("bin").collect()
    most = max((r["n"] for r in rows), default=0) or 1
    return "<div class=bars>" + "".join(f'<i style="height:{100 * r["n"] // most}%" title="{r["lo"] or 0:.3g} to {r["hi"] or 0:.3g}: {r["n"]}"></i>' for r in rows) + "</div>"


def provenance(synthetic: bool | None, gen: dict | None) -> str:
    """Badges of where a pair is from, and a line of what is not a column: sampling, provider, an odd end."""
    gen = gen or {}
    told = [f"t={gen['temperature']}" if gen.get("temperature") is not None else None, f"top_p={gen['top_p']}" if gen.get("top_p") is not None else None, gen.get("provider"), gen.get("finish_reason") if gen.get("finish_reason") != "stop" else None]
    prompt = gen.get("prompt_label") and f"{gen['prompt_label']} v{gen['prompt_version']}" if gen.get("prompt_version") else gen.get("prompt_label") or gen.get("prompt_id")
    badges = [_badge("synthetic" if synthetic else "real", "synthetic" if synthetic else "real"), *[_badge("covariate", str(x)) for x in (gen.get("model"), gen.get("reasoning_effort"), prompt) if x]]
    line = " · ".join(str(x) for x in told if x)
    return " ".join(badges) + (f"<div class=sub>{html.escape(line)}</div>" if line else "")


def scores_report(scores: DataFrame, pairs: DataFrame, max_rows: int = 200, chars: int = 400) -> str:
    """The scores page: a card and a histogram a field, and the largest falls with provenance badges and their texts.

    Statistics are over all scores; of the pairs the first ``max_rows`` by fall are shown.
    """
    from draftloom.operators import scores as S

    fields = []
    for r in sorted((r.asDict() for r in S.aggregate(scores, ["field"]).collect()), key=lambda r: r["field"] or ""):
        mine = scores.filter(F.col("field").eqNullSafe(F.lit(r["field"])))
        fields.append(f"<section><h2>{html.escape(r['field'] or '—')}</h2>{_cards(r)}{_bars(T.histogram(mine, F.col('detector.score')))}</section>")
    top = S.with_texts(S.paired_report(scores), pairs).orderBy(F.desc_nulls_last("delta"), "id").limit(max_rows)
    extra = [c for c in ("synthetic", "gen") if c in pairs.columns]
    if extra:
        top = top.join(pairs.groupBy("id").agg(*[F.max_by(c, "ord").alias(c) for c in extra]), "id", "left")
    body = ""
    for r in sorted((r.asDict(recursive=True) for r in top.collect()), key=lambda r: (r["delta"] is None, -(r["delta"] or 0), r["id"])):
        marks = provenance(r.get("synthetic"), r.get("gen")) if extra else ""
        told = "".join(f"<td>{'—' if r[c] is None else format(r[c], '.2f')}</td>" for c in ("draft", "rewrite", "delta"))
        body += f"<tr><td>{html.escape(str(r['id']))} {marks}</td>{told}<td>{html.escape((r['text'] or '')[:chars])}</td></tr>"
    return f"<html><body>{''.join(fields)}<table><thead><tr><th>id</th><th>draft</th><th>rewrite</th><th>delta</th><th>text</th></tr></thead><tbody>{body}</tbody></table></body></html>"
