"""Text operators that need offsets or difflib: plain functions and their Arrow UDFs."""

from __future__ import annotations

import difflib
import json
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import pandas as pd
from pyspark.sql import functions as F

from draftloom.functions import text as text_patterns

#: Blocks that pass through a rewrite unchanged.
PROTECTED = [
    re.compile(r"^[ \t]*```.*?$.*?^[ \t]*```[ \t]*$(?:\n|\Z)", re.M | re.S),
    re.compile(r"\$\$.*?\$\$[ \t]*(?:\{[^}\n]*\})?", re.S),
    re.compile(r"^(?:[ \t]{0,3}>[^\n]*\n?)+", re.M),
]


def div_spans(text: str) -> list[tuple[int, int]]:
    """Spans of ``:::`` blocks, nested ones inside their outermost; an unclosed one is none."""
    lines = text.splitlines(keepends=True)
    marks = [(k, line.strip()) for k, line in enumerate(lines) if line.lstrip().startswith(":::")]
    if not marks:
        return []
    ends = [0, *accumulate(map(len, lines))]
    opened: list[int] = []
    pairs: list[tuple[int, int]] = []
    for k, mark in marks:
        if mark == ":::" and opened:
            first = opened.pop()
            while pairs and pairs[-1][0] > first:  # blocks within this one
                pairs.pop()
            pairs.append((first, k))
        else:
            opened.append(k)
    return [(ends[a], ends[b + 1]) for a, b in pairs]


def segments(text: str) -> list[tuple[str, bool]]:
    """(text, editable) parts whose concatenation is the text."""
    spans = sorted([m.span() for p in PROTECTED for m in p.finditer(text)] + div_spans(text))
    out, at, k = [], 0, 0
    while k < len(spans):
        a, b = spans[k]
        while k + 1 < len(spans) and spans[k + 1][0] <= b:
            k += 1
            b = max(b, spans[k][1])
        out += [(text[at:a], True)] * (at < a) + [(text[a:b], False)]
        at, k = b, k + 1
    return out + [(text[at:], True)] * (at < len(text))


def prose_spans(text: str, min_chars: int = 0) -> list[tuple[str, int, int]]:
    """(paragraph, start, end) of the editable prose: no frontmatter, no headings."""
    m = FRONTMATTER.match(text)
    out, at = [], 0
    for part, editable in segments(text):
        if editable:
            for p in re.finditer(r"[^\n]*\S[^\n]*(?:\n[^\n]*\S[^\n]*)*", part):
                a, b = at + p.start(), at + p.end()
                if (m is None or a >= m.end()) and not re.match(r"[ \t]{0,3}#{1,6}[ \t]", p.group()) and len(p.group().strip()) >= min_chars:
                    out.append((p.group(), a, b))
        at += len(part)
    return out


#: Fixed value: frontmatter that a rewrite leaves byte for byte as it is.
FRONTMATTER = re.compile(r"\A---\n.*?\n---\n", re.S)


def split_frontmatter(raw: str) -> tuple[str, str]:
    """The YAML block between ``---`` and ``---`` or ``...``, as JSON, and the body; ('{}', whole text) if there is none or it is malformed."""
    import yaml

    m = re.match(r"﻿?---[ \t]*\r?\n(.*?)(?:\r?\n)?^(?:---|\.\.\.)[ \t]*(?:\r?\n|\Z)", raw, re.S | re.M)
    if not m:
        return "{}", raw
    try:
        meta = yaml.safe_load(m.group(1)) or {}
    except yaml.YAMLError:
        return "{}", raw
    if not isinstance(meta, dict):
        return "{}", raw
    return json.dumps({str(k): v for k, v in meta.items()}, default=str, ensure_ascii=False), raw[m.end() :]


#: Lengths of the runs looked for, longest first: a longest match is found among the few long runs two texts share.
_GRAMS = (16, 6, 3, 1)


def _longest(x: str, y_at: dict[str, list[int]], k: int, a: int, b: int, c: int, d: int) -> tuple[int, int, int]:
    """(size, start in x, start in y) of the longest match of at least k characters in x[a:b] and y[c:d], the earliest in x, then in y."""
    best, at, to = 0, a, c
    runs: dict[int, int] = {}
    for i in range(a, b - k + 1):
        places = y_at.get(x[i : i + k])
        if places is None:
            runs = {}
            continue
        now: dict[int, int] = {}
        for p in range(bisect_left(places, c) if places[0] < c else 0, len(places)):
            j = places[p]
            if j > d - k:
                break
            n = now[j] = runs.get(j - 1, 0) + 1
            if n > best:
                best, at, to = n, i - n + 1, j - n + 1
        runs = now
    return (best + k - 1 if best else 0), at, to


def matched(x: str, y: str) -> int:
    """Characters in the matching blocks of two texts: the longest block, then those before and after it, and so on.

    The blocks are those of ``difflib.SequenceMatcher`` without its heuristic
    of popular elements. A match of k characters or more is a row of common
    k-grams, so it is found among these, from long to short.
    """
    index: dict[int, dict[str, list[int]]] = {}
    total, todo = 0, [(0, len(x), 0, len(y), 0)]
    while todo:
        a, b, c, d, level = todo.pop()
        size = 0
        while not size and level < len(_GRAMS):
            k = _GRAMS[level]
            if b - a >= k and d - c >= k:
                if k not in index:
                    index[k] = {}
                    for j in range(len(y) - k + 1):
                        index[k].setdefault(y[j : j + k], []).append(j)
                size, i, j = _longest(x, index[k], k, a, b, c, d)
            if not size:
                level += 1
        if size:
            total += size
            todo += [(a, i, c, j, level), (i + size, b, j + size, d, level)]
    return total


def similarity(a: str, b: str) -> float:
    """difflib's ratio of the texts with white space normalised, to 3 places; 1.0 for two empty ones."""
    x, y = " ".join(a.split()), " ".join(b.split())
    return 1.0 if x == y else round(2.0 * matched(x, y) / (len(x) + len(y)), 3)


_FENCED = r"(?P<mark>`{3,}|~{3,})[^\n]*(?:\n(?![^\S\n]*(?P=mark))[^\n]*)*(?:\n[^\S\n]*(?P=mark)[^\n]*)?"
#: A block: lines with text in a row, a fence with whatever is in it counting as one of them.
_BLOCK = re.compile(rf"^(?:{_FENCED}|[^\n]*\S[^\n]*)(?:\n(?:{_FENCED.replace('mark', 'more')}|[^\n]*\S[^\n]*))*", re.M)
_HEADS = re.compile(r"\s*(?:^#{1,6}[^\S\n][^\n]*(?:\n|\Z))+", re.M)
_FENCE = re.compile(r"\s*^(?:```|~~~)", re.M)


def chunk_spans(text: str, max_chars: int = 1500) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the frontmatter, heading, fence, prose and blank chunks of a text, by one scan over offsets.

    Blank lines outside fences part the blocks and lie between the spans;
    those at the ends of the body belong to its first and last block. Headings
    glued to text are spans of their own. Neighbouring prose is one span while
    it is no longer than ``max_chars``.
    """
    m = FRONTMATTER.match(text)
    at, n = m.end() if m else 0, len(text)
    out: list[tuple[str, int, int]] = [("frontmatter", 0, at)] * bool(m)
    blocks = [x.span() for x in _BLOCK.finditer(text, at)]
    if not blocks:
        return [*out, ("blank", at, n)] if at < n or not m else out
    blocks[0], blocks[-1] = (at, blocks[0][1]), (blocks[-1][0], n) if len(blocks) > 1 else (at, n)
    for start, end in blocks:
        heads = _HEADS.match(text, start, end)
        if heads:
            cut = heads.end()
            if not text[cut:end].strip():
                out.append(("heading", start, end))
                continue
            out.append(("heading", start, cut - 1))  # the line's end parts it from the text
            start = cut
        if _FENCE.match(text, start, end):
            out.append(("fence", start, end))
        elif out and out[-1][0] == "prose" and end - out[-1][1] <= max_chars:
            out[-1] = ("prose", out[-1][1], end)
        else:
            out.append(("prose", start, end))
    return out


def body_chunks(text: str, max_chars: int = 1500) -> list[tuple[str, str, str]]:
    """(kind, text, what parts it from the next): chunks whose concatenation is the text."""
    spans = chunk_spans(text, max_chars)
    return [(kind, text[a:b], text[b:after]) for (kind, a, b), after in zip(spans, [*[x[1] for x in spans[1:]], len(text)])]


def chunks_with_context(text: str, max_chars: int = 1500) -> list[tuple[str, str, str, str | None]]:
    """``body_chunks`` with the heading that each stands under (its last line), if there is one."""
    context, out = None, []
    for kind, t, sep in body_chunks(text, max_chars):
        if kind == "heading":
            context = t.rstrip("\n").split("\n")[-1]
        out.append((kind, t, sep, context))
    return out


_ANCHORS = [re.compile(p) for p in (text_patterns.LINK_TARGET, text_patterns.BARE_URL)] + [re.compile(f"({text_patterns.CITE_KEY})")]


def lost_anchors(source: str, candidate: str) -> list[str]:
    """``text.missing_anchors`` of two strings, where a choice is made inside a batch."""
    count = lambda t: Counter(x for p in _ANCHORS for x in p.findall(t))
    return sorted((count(source) - count(candidate)).keys())


def changes(before: list[str], after: list[str]) -> list[tuple[int, str, str]]:
    """(place in the new version, old, new) of the paragraphs that were replaced, runs joined by blank lines."""
    ops = difflib.SequenceMatcher(None, before, after, autojunk=False).get_opcodes()
    return [(c, "\n\n".join(before[a:b]), "\n\n".join(after[c:d])) for tag, a, b, c, d in ops if tag == "replace"]


def changed_chunks(before: list[str], after: list[str]) -> list[tuple[int, str, str]]:
    """(number, old, new) of the changes."""
    return [(k, x, y) for k, (_, x, y) in enumerate(changes(before, after))]


def first_json_object(text: str) -> str | None:
    """The first balanced {...} that parses, as written."""
    for m in re.finditer(r"\{", text):
        depth, quoted, skip = 0, False, False
        for k in range(m.start(), len(text)):
            c = text[k]
            if skip:
                skip = False
            elif c == "\\" and quoted:
                skip = True
            elif c == '"':
                quoted = not quoted
            elif not quoted:
                depth += (c == "{") - (c == "}")
                if depth == 0:
                    try:
                        if isinstance(json.loads(text[m.start() : k + 1]), dict):
                            return text[m.start() : k + 1]
                    except ValueError:
                        pass
                    break
    return None


def judge_reply(text: str) -> tuple[int, str]:
    """(score 1 to 5, rationale) of a judge's reply: JSON, else the first lone digit, else 3."""
    found = first_json_object(text)
    if found:
        try:
            x = json.loads(found)
            return max(1, min(5, int(x["score"]))), str(x.get("rationale", ""))
        except (KeyError, TypeError, ValueError):
            pass
    m = re.search(r"\b([1-5])\b", text)
    return (int(m.group(1)) if m else 3), text.strip()


# --- UDFs: null in, null out; built at the call, since a schema's text needs a session -----------
def _on_series(f, schema: str, c):
    def over(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else f(x))

    return F.pandas_udf(over, schema)(c)


def segments_udf(c):
    return _on_series(lambda t: [{"ord": i, "text": s, "editable": e} for i, (s, e) in enumerate(segments(t))], "array<struct<ord:int,text:string,editable:boolean>>", c)


def prose_udf(c):
    return _on_series(lambda t: "".join(s for s, e in segments(t) if e), "string", c)


def prose_spans_udf(c):
    return _on_series(lambda t: [{"text": s, "start": a, "end": b} for s, a, b in prose_spans(t)], "array<struct<text:string,start:int,end:int>>", c)


def body_chunks_udf(c, max_chars: int = 1500):
    return _on_series(lambda t: [{"kind": k, "text": s, "sep": p, "context": h} for k, s, p, h in chunks_with_context(t, max_chars)], "array<struct<kind:string,text:string,sep:string,context:string>>", c)


def frontmatter_udf(c):
    def over(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(None, None) if x is None else split_frontmatter(x) for x in s], columns=["meta", "body"])

    return F.pandas_udf(over, "struct<meta:string,body:string>")(c)


def similarity_udf(a, b):
    def over(x: pd.Series, y: pd.Series) -> pd.Series:
        once = {k: similarity(*k) for k in set(zip(x, y)) if k[0] is not None and k[1] is not None}  # a pair that repeats in the batch is compared once
        return pd.Series([once.get(k) for k in zip(x, y)], dtype="float64")

    return F.pandas_udf(over, "double")(a, b)


def changes_udf(a, b):
    def over(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else [{"at": k, "before": o, "after": n} for k, o, n in changes(list(p), list(q))] for p, q in zip(x, y)])

    return F.pandas_udf(over, "array<struct<at:int,before:string,after:string>>")(a, b)


def judge_reply_udf(c):
    def over(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(None, None) if x is None else judge_reply(x) for x in s], columns=["score", "rationale"])

    return F.pandas_udf(over, "struct<score:int,rationale:string>")(c)
