"""SQL twins of the pN_ queries that SQL can express: samples, groups and splits."""

from __future__ import annotations

from draftloom.llm.groups import PLACEHOLDERS

#: White space and format characters, as the keys count them.
_SPACE = r"[\s\x0b\p{Cf}\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_NO_NAME = ", ".join(f"'{p}'" for p in PLACEHOLDERS)


def _squeeze(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '{_SPACE}', ' ', 'g'), ' ')"


def _post_key(x: str) -> str:
    parts = f"list_transform(string_split(replace({_squeeze(x)}, chr(92), '/'), '/'), lambda p: trim(p, ' '))"
    step = "lambda acc, p: CASE WHEN p IN ('', '.') THEN acc WHEN p = '..' THEN regexp_replace(acc, '/[^/]*$', '') ELSE acc || '/' || p END"
    return f"substr(list_reduce(list_prepend('', {parts}), {step}), 2)"


def _author_key(x: str) -> str:
    key = f"array_to_string(list_sort(list_filter(string_split(regexp_replace({_squeeze(x)}, '[,;]+', ' ', 'g'), ' '), lambda p: p <> '')), ' ')"
    return f"(CASE WHEN {_squeeze(x)} NOT IN ({_NO_NAME}) AND {key} NOT IN ({_NO_NAME}) THEN {key} END)"


def _series_key(x: str) -> str:
    key = rf"regexp_replace(regexp_replace({_squeeze(x)}, '[^\p{{L}}\p{{N}}\p{{M}}]+', '-', 'g'), '^-|-$', '', 'g')"
    return f"(CASE WHEN {_squeeze(x)} NOT IN ({_NO_NAME}) AND {key} NOT IN ({_NO_NAME}) THEN {key} END)"


def sample(least: int) -> str:
    due = "greatest(0.1::DOUBLE, least(1.0::DOUBLE, min(u) + pow(2.0::DOUBLE, -50)))" if least else "0.1::DOUBLE"
    return f"""WITH r AS (SELECT pair_id AS id, CASE WHEN source IS NOT NULL THEN {_post_key('source')} END AS stratum, coalesce(ingest_batch, 2147483647) AS b FROM pairs WHERE pair_id IS NOT NULL),
    n AS (SELECT b, row_number() OVER (ORDER BY b) - 1 AS nth FROM (SELECT DISTINCT coalesce(ingest_batch, 2147483647) AS b FROM pairs)),
    f AS (SELECT id, min(b) AS b FROM r GROUP BY id),
    v AS (SELECT id, nth, CASE WHEN bool_or(stratum IS NULL) THEN NULL ELSE min(stratum) END AS stratum, ('0x' || substr(sha256('42' || chr(0) || id), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u FROM r JOIN f USING (id, b) JOIN n USING (b) GROUP BY id, nth),
    a AS (SELECT stratum, min(nth) AS nth FROM v GROUP BY stratum),
    t AS (SELECT v.stratum, {due} AS threshold FROM v JOIN a ON v.stratum IS NOT DISTINCT FROM a.stratum AND v.nth = a.nth GROUP BY v.stratum)
    SELECT id AS pair_id, v.stratum AS source, u, threshold, nth::INT AS first_batch FROM v JOIN t ON v.stratum IS NOT DISTINCT FROM t.stratum WHERE u < threshold"""


_GROUPS = f"""RECURSIVE p AS (SELECT DISTINCT 'p:' || {_post_key('source')} AS post, 'a:' || {_author_key('author')} AS written, 's:' || {_series_key('series')} AS part FROM posts WHERE source IS NOT NULL),
    l AS (SELECT DISTINCT source, 'p:' || {_post_key('source')} AS post FROM pairs WHERE source IS NOT NULL),
    e AS (SELECT post AS x, written AS y FROM p WHERE written IS NOT NULL UNION SELECT post, part FROM p WHERE part IS NOT NULL UNION SELECT post, post FROM l),
    b AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
    c AS (SELECT x AS node, x AS reach FROM b UNION SELECT y, y FROM b UNION SELECT c.node, b.y FROM c JOIN b ON c.reach = b.x),
    g AS (SELECT source, min(reach) AS component FROM l JOIN c ON c.node = l.post GROUP BY source)"""


def _score(split: str, weight: float) -> str:
    h = f"('0x' || substr(sha256('0' || chr(0) || '{split}' || chr(0) || component), 1, 12))::BIGINT::DOUBLE"
    return f"{{'score': {-weight}::DOUBLE / ln(({h} + 0.5::DOUBLE) / 281474976710656.0::DOUBLE), 'split': '{split}'}}"


SQL = {
    "p3_sample": sample(1),
    "p3_tenth": sample(0),
    "p5_found": f"WITH {_GROUPS} SELECT source, lead AS group_source FROM (SELECT source, min(source) OVER (PARTITION BY component) AS lead, count(*) OVER (PARTITION BY component) AS n FROM g) WHERE n > 1",
    "p5_splits": f"""WITH {_GROUPS}, i AS (SELECT pair_id, min(source) AS source FROM pairs GROUP BY pair_id),
    j AS (SELECT pair_id, i.source, coalesce(component, 'id:' || pair_id, 'id:null') AS component FROM i LEFT JOIN g ON g.source = i.source)
    SELECT pair_id, source, component, list_max([{_score('train', 0.8)}, {_score('validation', 0.1)}, {_score('test', 0.1)}]).split AS split FROM j""",
}
