"""Scalar text functions as Column expressions.

Everything here stays in the JVM. Lines follow Python's ``splitlines``, white
space Python's ``strip``, lengths count code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Line breaks of ``splitlines``.
LINE_BREAK = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"
_BLANK = "(?U)[\\s\\x1c-\\x1f]"
#: Patterns of the chunk gate.
LINK = r"\[[^\]]*\]\([^)]*\)"
LIST_ITEM = r"^\s{0,3}(?:[-*+]\s|\d+[.)]\s)"
LIST_MARKER = r"(?m)^\s*(?:[-*+]|\d+[.)])\s"
MARKUP_NOISE = r"[\s*_#>|`/\\\-]+"
HEADING = r"^\s{0,3}#{1,6}\s+(.*?)\s*$"
#: What a rewrite must keep (link targets, bare addresses, citation keys).
LINK_TARGET = r"\]\(([^)\s]+)"
BARE_URL = r"(?:^|[^(])(https?://[^\s)\]]+)"
CITE_KEY = r"@[A-Za-z][A-Za-z0-9_:-]*"


def strip(c: Column) -> Column:
    """Python's ``str.strip``: all Unicode white space and the separators \\x1c-\\x1f."""
    return F.regexp_replace(c, f"{_BLANK[:4]}^{_BLANK[4:]}+|{_BLANK[4:]}+$", "")


def has_text(c: Column) -> Column:
    """Not blank: stops at the first character that is no white space."""
    return F.regexp_like(c, F.lit("(?U)[^\\s\\x1c-\\x1f]"))


def _let(value: Column, f) -> Column:
    """f(value) with the value computed once, also where no common subexpressions are found."""
    return F.get(F.transform(F.array(value), f), 0)


def lines(c: Column) -> Column:
    """``splitlines``; no empty last line after a final break."""
    return _let(F.split(c, LINE_BREAK), lambda parts: F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts))


def paragraphs(c: Column) -> Column:
    """Maximal runs of non-blank lines, joined by LF; a line of white space only is blank."""
    ls = F.transform(lines(c), lambda x: F.when(has_text(x), x).otherwise(F.lit("")))
    runs = F.split(F.array_join(ls, "\n"), "\\n(?:\\n)+")
    return F.filter(F.transform(runs, lambda x: F.btrim(x, F.lit("\n"))), has_text)


def nonblank_lines(c: Column) -> Column:
    return F.filter(lines(c), has_text)


def header_key(c: Column) -> Column:
    """A header's title for matching: no ``#``, no trailing attribute block, lower case."""
    return F.lower(F.regexp_replace(strip(F.regexp_replace(c, "^#+", "")), r"\s*\{[^}]*\}\s*$", ""))


def truncate_at_headers(c: Column, headers: list[str]) -> Column:
    """The text before the first line that is one of the headers, at any level and in any case."""
    if not headers:
        return c
    wanted = F.array(*[header_key(F.lit(h)) for h in headers])
    ls = F.split(c, "(?<=\n)")
    hit = F.transform(ls, lambda x: F.regexp_like(x, F.lit(HEADING)) & F.array_contains(wanted, header_key(F.regexp_extract(x, HEADING, 1))))
    at = F.array_position(hit, True)
    return F.when(at > 0, F.array_join(F.slice(ls, F.lit(1), at.cast("int") - 1), "")).otherwise(c)


def prose_residual(c: Column) -> Column:
    """Characters of prose left after links, list markers and marks."""
    t = F.regexp_replace(c, LINK, " ")
    t = F.regexp_replace(t, LIST_MARKER, " ")
    return F.length(strip(F.regexp_replace(t, MARKUP_NOISE, " ")))


def is_link_list(c: Column, least: float = 0.2) -> Column:
    """Mostly links; an empty chunk counts as one."""
    return _let(strip(c), lambda s: _mostly_links(s, least))


def _mostly_links(s: Column, least: float = 0.2) -> Column:
    return F.when(s == "", F.lit(True)).otherwise(prose_residual(s) / F.length(s) < least)


def _all_lines(c: Column, pattern: str) -> Column:
    """Some lines, and each of those that are not blank matches; most texts fail at their first line."""
    return _let(nonblank_lines(c), lambda ls: (F.size(ls) > 0) & F.forall(ls, lambda x: F.regexp_like(x, F.lit(pattern))))


def is_table(c: Column) -> Column:
    return _all_lines(c, f"(?U)^{_BLANK[4:]}*\\|")


def is_list(c: Column) -> Column:
    return _all_lines(c, LIST_ITEM)


def keep_chunk(c: Column, min_chars: int = 80, max_chars: int | None = 8000, markers: list[str] | None = None, drop_links: bool = True, drop_lists: bool = False) -> Column:
    """The hygiene gate of passages; false for null."""

    def gate(s: Column) -> Column:
        ok = F.length(s) >= min_chars
        if max_chars is not None:
            ok = ok & (F.length(s) <= max_chars)
        for m in markers or []:
            ok = ok & ~F.contains(c, F.lit(m))
        ok = ok & ~is_table(s)
        if drop_lists:
            ok = ok & ~is_list(s)
        if drop_links:
            ok = ok & ~_mostly_links(s)
        return ok

    return F.coalesce(_let(strip(c), gate), F.lit(False))


def pack(parts: Column, budget: int) -> Column:
    """Greedy packing of paragraphs into passages of up to ``budget`` characters (2 a join); an oversized one stands alone."""
    zero = F.struct(F.array().cast("array<string>").alias("out"), F.lit(None).cast("string").alias("buf"))

    def step(s: Column, p: Column) -> Column:
        fits = s["buf"].isNotNull() & (F.length(s["buf"]) + 2 + F.length(p) <= budget)
        grown = F.struct(s["out"].alias("out"), F.concat(s["buf"], F.lit("\n\n"), p).alias("buf"))
        flushed = F.struct(F.when(s["buf"].isNull(), s["out"]).otherwise(F.concat(s["out"], F.array(s["buf"]))).alias("out"), p.alias("buf"))
        return F.when(fits, grown).otherwise(flushed)

    return F.aggregate(parts, zero, step, lambda s: F.when(s["buf"].isNull(), s["out"]).otherwise(F.concat(s["out"], F.array(s["buf"]))))


def anchors(c: Column) -> Column:
    """The multiset of link targets, bare addresses and citation keys, as an array."""
    return F.concat(
        F.regexp_extract_all(c, F.lit(LINK_TARGET), 1), F.regexp_extract_all(c, F.lit(BARE_URL), 1), F.regexp_extract_all(c, F.lit(CITE_KEY), 0)
    )


def missing_anchors(source: Column, candidate: Column) -> Column:
    """Anchors that the candidate has fewer of, sorted."""
    have, want = anchors(candidate), anchors(source)
    count = lambda a, k: F.size(F.filter(a, lambda x: x == k))
    return F.array_sort(F.filter(F.array_distinct(want), lambda k: count(have, k) < count(want, k)))


def pair_content(context: Column, body: Column) -> Column:
    """A body under its heading; the body alone where there is no heading."""
    return F.when(F.coalesce(context, F.lit("")) != "", F.concat(context, F.lit("\n\n"), body)).otherwise(body)


def pair_body(content: Column, context: Column) -> Column:
    """The inverse of ``pair_content``: the content without its heading and the blank line."""
    prefix = F.concat(context, F.lit("\n\n"))
    cut = F.startswith(content, prefix) & (F.coalesce(context, F.lit("")) != "")
    return F.when(F.coalesce(cut, F.lit(False)), F.substr(content, F.length(prefix) + 1)).otherwise(content)


def estimate_tokens(c: Column) -> Column:
    """Characters over four, rounded down."""
    return F.floor(F.length(c) / 4)


def humanize_age(seconds: Column) -> Column:
    """An age in words: seconds, minutes, hours, days to two weeks, then weeks."""
    n = lambda unit, name: F.concat((F.floor(seconds / unit)).cast("string"), F.lit(name))
    return F.when(seconds < 60, F.lit("just now")).when(seconds < 3600, n(60, "m ago")).when(seconds < 86400, n(3600, "h ago")).when(seconds < 14 * 86400, n(86400, "d ago")).otherwise(n(7 * 86400, "w ago"))


def is_human_authored(field: Column, most: int = 0) -> Column:
    """An automation level up to ``most``; missing or unreadable levels are false."""
    t = strip(field)
    return F.coalesce(F.when(F.regexp_like(t, F.lit(r"^[+-]?\d+(?:_\d+)*$")), F.try_to_number(F.regexp_replace(F.regexp_replace(t, "_", ""), r"^\+", ""), F.lit("S999999999999")) <= most), F.lit(False))


def is_modified_after(field: Column, day: str) -> Column:
    """The ISO day of a field after ``day``, compared as text; malformed fields are false."""
    d = F.substring(field, 1, 10)
    return F.coalesce(F.regexp_like(d, F.lit(r"^\d{4}-\d{2}-\d{2}$")) & (d > F.lit(day)), F.lit(False))
