"""Text decoded with the wrong encoding: found and, where possible, restored.

Method: expectation-maximisation. The latent variable of a record is its
encoding chain (what the bytes were, and what they were read as; possibly
twice), or none. A worker turns each record into log-likelihood ratios of the
chains against clean text; EM learns a mixture of chains for every source and
field, smoothed by the corpus mixture, so that weak evidence in one record is
weighed by its neighbours; each record is repaired by its posterior chain.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftloom.operators.joins import lookup
from draftloom.session import checkpoint, spread

#: UTF-8 bytes read as one of these. cp1252 takes the bytes it leaves open as C1 controls.
UTF8_READ_AS = ["cp1252", "latin_1", "mac_roman", "cp437", "cp850", "cp852", "cp1251", "cp1250", "cp866", "koi8_r", "iso8859_2"]
#: UTF-8 bytes read as a multi-byte encoding.
UTF8_READ_AS_WIDE = ["cp932", "gbk"]
#: (what it was, what it was read as) between single-byte encodings.
SINGLE = [
    ("iso8859_2", "cp1252"), ("cp1250", "cp1252"), ("cp1251", "cp1252"), ("koi8_r", "cp1252"), ("cp866", "cp1252"), ("koi8_r", "cp1251"), ("cp1251", "koi8_r"),
    ("cp866", "cp1251"), ("iso8859_5", "cp1251"), ("cp1252", "mac_roman"), ("mac_roman", "cp1252"), ("cp850", "cp1252"), ("cp1252", "cp850"), ("cp1252", "cp1251"), ("cp1251", "mac_roman"), ("cp1250", "cp1251"), ("cp1252", "cp437"), ("iso8859_2", "cp1250"), ("cp1250", "iso8859_2"),
]
#: A wide encoding read as a single-byte one.
WIDE_READ_AS = [("cp932", "cp1252"), ("euc_jp", "cp1252"), ("gbk", "cp1252"), ("cp932", "cp437"), ("euc_jp", "cp932"), ("cp932", "mac_roman")]
CHAINS = [
    *[f"utf_8>{w}" for w in UTF8_READ_AS], *[f"utf_8>{w}" for w in UTF8_READ_AS_WIDE], *[f"{a}>{b}" for a, b in SINGLE], *[f"{a}>{b}" for a, b in WIDE_READ_AS],
    "utf_8>cp1252>utf_8>cp1252", "lost",
]
INDEX = {c: k for k, c in enumerate(CHAINS)}
STRONG, CAP = 8.0, 60.0


@lru_cache(None)
def _bytes_of(enc: str) -> dict[str, int]:
    """Character -> byte of a single-byte encoding; bytes it leaves open are C1 controls."""
    out = {chr(b): b for b in range(0x80, 0xA0)} if enc in ("cp1252", "cp1251", "cp1250") else {}
    for b in range(256):
        try:
            out[bytes([b]).decode(enc)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    if enc == "latin_1":
        out |= {chr(b): b for b in range(256)}
    return out


def to_bytes(text: str, enc: str) -> bytes | None:
    """The bytes that were read as ``text``, or None if ``enc`` cannot have given it."""
    if enc in ("cp932", "gbk"):
        try:
            return text.encode(enc)
        except UnicodeEncodeError:
            return None
    table = _bytes_of(enc)
    try:
        return bytes([table[c] for c in text])
    except KeyError:
        return None


@lru_cache(None)
def _utf8_pattern(enc: str) -> tuple[re.Pattern[str], frozenset[str]]:
    by = {}
    for c, b in _bytes_of(enc).items():
        by.setdefault(b, []).append(c)
    span = lambda lo, hi: "".join(re.escape(c) for b in range(lo, hi + 1) for c in by.get(b, ()))
    cont = f"[{span(0x80, 0xBF)}]"
    lead = frozenset(c for b in range(0xC2, 0xF5) for c in by.get(b, ()))
    return re.compile(f"[{span(0xC2, 0xDF)}]{cont}|[{span(0xE0, 0xEF)}]{cont}{{2}}|[{span(0xF0, 0xF4)}]{cont}{{3}}"), lead


#: Letters beyond ASCII of languages written in Latin letters, common ones and others.
COMMON = set("äöüßÄÖÜéèêëàâîïôûùçœÉÈÊÀÂÎÔÇáíóúñÁÍÓÚÑãõÃÕąćęłńóśźżĄĆĘŁŃŚŹŻ")
OTHER = set("åøæÅØÆëËïÏÿðÐþÞýÝìòÌÒÙÛŒšžčřěůťďňŠŽČŘĚŮőűŐŰğışĞİŞăâîșțĂȘȚāēīōūģķļņ")
#: Frequencies of Russian letters, per thousand.
RUSSIAN = dict(zip("оеаинтсрвлкмдпуяыьгзбчйхжшюцщэфъё", [110, 85, 80, 74, 67, 63, 55, 47, 45, 44, 35, 32, 30, 28, 26, 20, 19, 17, 17, 16, 16, 14, 12, 10, 9, 7, 6, 5, 4, 3, 3, 1, 1]))
_LOG = {c: math.log(f / 1000) for c, f in RUSSIAN.items()}
_PUNCT = set("“”‘’„‚«»‹›—–…•·¿¡€£¥§°±²³µ¼½¾©®™ªº×÷¶")


def _plausible(c: str) -> bool:
    """Whether a decoded character is one that texts hold."""
    o = ord(c)
    return (
        0x80 <= o <= 0xFF or c in COMMON or c in OTHER or c in _PUNCT or 0x410 <= o <= 0x44F or c in "Ёёіїєґ"
        or 0x391 <= o <= 0x3CE or 0x5D0 <= o <= 0x5EA or 0x620 <= o <= 0x64A or 0xE01 <= o <= 0xE4E or 0x3040 <= o <= 0x30FF or 0x4E00 <= o <= 0x9FFF or 0xAC00 <= o <= 0xD7A3
        or 0x2010 <= o <= 0x2027 or 0x2030 <= o <= 0x203A or 0x20A0 <= o <= 0x20BF or 0x2100 <= o <= 0x22FF or 0x2460 <= o <= 0x24FF or 0x2600 <= o <= 0x27BF or 0x3000 <= o <= 0x303F or 0xFE0F == o or 0xFB00 <= o <= 0xFB06 or 0xFF01 <= o <= 0xFF5E
        or 0x1F1E6 <= o <= 0x1FAFF or 0x1D400 <= o <= 0x1D7FF or o in (0x200B, 0x200D, 0xFEFF, 0x2003) or 0x300 <= o <= 0x304
    )


_TYPO = set("“”‘’„«»—–…•\xa0.")


def _match_weight(enc: str, seen: str, ch: str, before: str) -> float:
    """Log-likelihood ratio of one UTF-8 sequence read as ``enc``."""
    if not _plausible(ch) or "\x80" <= ch <= "\x9f" and enc not in ("cp1252", "latin_1"):
        return 0.0
    tail = seen[1:]
    if enc in ("cp1251", "koi8_r", "cp866", "cp1252", "latin_1", "cp1250", "iso8859_2") and len(seen) == 2 and (set(tail) <= _TYPO or tail in "ёЁ"):
        # a letter before a closing mark or a fixed space is common in clean text too
        if enc not in ("cp1252", "latin_1") or seen[0] not in "ÃÂ" or before.isupper() or "\x80" <= ch <= "\x9f":
            return 0.7
        return 6.0 if tail == "\xa0" else 2.5
    if enc in ("cp1251", "koi8_r", "cp866") and all(c.lower() in RUSSIAN for c in seen):
        return 0.0
    if enc in ("cp850", "cp852") and seen.isalpha():
        return 0.5
    return STRONG * (len(seen) - 1)


def _script(c: str) -> int:
    o = ord(c)
    return 2 if 0x400 <= o <= 0x52F else 1 if c.isalpha() and o < 0x250 else 3 if c.isalpha() else 0


@lru_cache(200_000)
def word_score(word: str) -> float:
    """Log-probability of the characters beyond ASCII of a word, given their neighbours."""
    total, prev, pprev = 0.0, "", ""
    last = len(word) - 1
    for k, c in enumerate(word):
        if c >= "\x80":
            s = _script(c)
            if s:
                if s == 1:
                    p = -3.5 if c in COMMON else -6.5 if c in OTHER else -9.0
                    if prev >= "\x80" and _script(prev) == 1:
                        p -= 4.0 if pprev >= "\x80" and _script(pprev) == 1 else 2.0
                    elif c not in COMMON and k == 0 == last:
                        p -= 1.0
                elif s == 2:
                    f = RUSSIAN.get(c.lower())
                    p = _LOG[c.lower()] if f else -9.0
                else:
                    p = -4.0
                if prev and prev.isalpha():
                    if _script(prev) != s and s < 3:
                        p -= 9.0
                    if c.isupper() and prev.islower():
                        p -= 6.0
                    elif c.isupper() and prev.isupper():
                        p -= 1.0
                    elif c.islower() and prev.isupper() and pprev.isupper():
                        p -= 3.0
            elif "\x80" <= c <= "\x9f":
                p = -12.0
            else:
                after = word[k + 1] if k < last else ""
                inner, outer = prev.isalpha() and after.isalpha(), prev.isalpha() or after.isalpha()
                if c in "’‘'­·" or unicodedata.combining(c):
                    p = -3.0
                elif c in "–—‑":
                    p = -6.0 if inner else -3.0
                elif c in "¿¡“„«‘" and not prev.isalnum():
                    p = -3.0
                elif c in "²³°ªº™®©µ" and not inner:
                    p = -3.5
                elif c in "”»’…€£$%½¼¾•" and not inner:
                    p = -3.0
                elif c in _PUNCT or ord(c) >= 0x2000:
                    p = -13.0 if inner else -6.0 if outer else -3.0
                else:
                    p = -13.0 if inner else -9.0 if outer else -5.0
            total += p
        elif prev >= "\x80" and c.isalpha() and _script(prev) == 2:
            total -= 9.0
        pprev, prev = prev, c
    return total


#: Characters of a word that are judged together; longer words (compounds, unspaced scripts) are read in such windows.
WINDOW = 40


def _word_ratios(word: str) -> tuple[tuple[int, float], ...]:
    """Of a word of any length, the single-byte chains that could have given it, with their ratios."""
    if len(word) <= WINDOW:
        return _window_ratios(word)
    sums: dict[int, float] = {}
    for part in {word[k : k + WINDOW] for k in range(0, len(word), WINDOW)}:
        for c, gain in () if part.isascii() or len(set(part)) < 4 else _window_ratios(part):  # a row of one letter tells nothing
            sums[c] = sums.get(c, 0.0) + gain
    # as for a short word, all of it must be of the chain's characters
    return tuple((c, gain) for c, gain in sums.items() if to_bytes(word, CHAINS[c].split(">")[1]) is not None)


@lru_cache(200_000)
def _window_ratios(word: str) -> tuple[tuple[int, float], ...]:
    here, out = word_score(word), []
    for a, b in SINGLE:
        raw = to_bytes(word, b)
        if raw is None:
            continue
        try:
            was = raw.decode(a)
        except UnicodeDecodeError:
            continue
        if was == word or any("\x80" <= c <= "\x9f" for c in was):
            continue
        then, new = word_score(was), [c for c in was if c >= "\x80"]
        gain = then - here
        if gain > 0 and (not new or then < -5.5 * len(new) or 2 * sum(c.isalpha() for c in new) <= len(new)):
            continue  # what it would become is no word either
        most = 1.0 if len(word) == 1 else 12.0
        out.append((INDEX[f"{a}>{b}"], max(-12.0, min(most, gain))))
    return tuple(out)


_MENTION = re.compile(r"`[^`\x00-\x20A-Za-z0-9]+`|\"[^\"\x00-\x7f]+\"|'[^'\x00-\x7f]+'|“[^”\x00-\x7f“]+”|«[^»\x00-\x7f]+»|‘[^’\x00-\x7f‘]+’")
#: Signs of a mention that is taken for one by itself: what stands for one to five characters.
SHORT_MENTION = {"`": 18, '"': 14, "'": 14}
#: Words by which a text speaks about a sequence of characters.
_ABOUT = re.compile(r"(?i)\b(?:encod\w*|decod\w*|utf-?8|unicode|latin-?1|cp\d+|windows-\d+|ascii|mojibake|garbl\w*|bytes?|characters?|sequences?|glyphs?|shows? up|appears?|instead of|turn(?:s|ed) into|becomes?|kodier\w*|zeichen\w*|caract[eè]re\w*|codificaci\w*|encodage)\b")
_WORD = re.compile(r"[^\s,;:!?()\[\]{}\"<>|/\\*_~=+`.]*[^\x00-\x7f\s][^\s,;:!?()\[\]{}\"<>|/\\*_~=+`.]*")
_WIDE = re.compile(r"[^\x00-\x7f�]{2,}")
#: What a run of a wide encoding looks like when its bytes are read one by one: a second byte may be an ASCII sign.
_RUN = re.compile(r"(?:[^\x00-\x7f\s][\x21-\x7e]?){6,}")
_PART = re.compile(r"[^\n.!?]+")


def _undo_utf8(text: str, enc: str) -> tuple[str, float, int]:
    """The text with sequences of UTF-8 read as ``enc`` undone, their weight and number."""
    pattern, lead = _utf8_pattern(enc)
    if lead.isdisjoint(text):
        return text, 0.0, 0
    weight, n = 0.0, 0

    def back(m: re.Match[str]) -> str:
        nonlocal weight, n
        seen = m.group()
        raw = to_bytes(seen, enc)
        try:
            ch = raw.decode("utf-8") if raw else ""
        except UnicodeDecodeError:
            return seen
        w = _match_weight(enc, seen, ch, text[m.start() - 1 : m.start()]) if ch else 0.0
        if w <= 0:
            return seen
        weight, n = weight + w, n + 1
        return ch

    return pattern.sub(back, text), weight, n


def _kana(s: str) -> int:
    return sum(0x3041 <= ord(c) <= 0x30FE or 0x4E00 <= ord(c) <= 0x9FFF for c in s)


def _wide_back(run: str, enc: str) -> str | None:
    """A run of UTF-8 read as a wide encoding, undone; None if it is not one."""
    raw = to_bytes(run, enc)
    if raw is None:
        return None
    try:
        was = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return was if was != run and all(_plausible(c) for c in was) else None


def _without_mentions(text: str) -> str:
    """The text without sequences that it quotes in order to speak about them."""

    def gone(m: re.Match[str]) -> str:
        s = m.group()
        if len(s) <= SHORT_MENTION.get(s[0], 10):
            return " "
        a, b = max(text.rfind("\n", 0, m.start()), text.rfind(". ", 0, m.start())), text.find("\n", m.end())
        return " " if _ABOUT.search(text, a + 1, m.start()) or _ABOUT.search(text, m.end(), b if b >= 0 else len(text)) else s

    return _MENTION.sub(gone, text)


def _wide_runs(text: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, was, read, restored) of the parts that a wide encoding read as another gives: dense lines, and runs within others."""
    at = 0
    for line in text.split("\n"):
        start, at = at, at + len(line) + 1
        if line.isascii():
            continue
        dense = sum(c >= "\x80" for c in line) * 4 > len(line)
        for s, e in [(0, len(line))] if dense else [m.span() for m in _RUN.finditer(line)]:
            for a, b in WIDE_READ_AS:
                if not dense and a == "gbk":
                    continue  # a short run of any accented letters is some Chinese
                for end in (e,) if dense else (e, e - 1, e - 2):
                    raw = to_bytes(line[s:end], b)
                    try:
                        was = raw.decode(a) if raw else ""
                    except UnicodeDecodeError:
                        continue
                    k = _kana(was)
                    if k < 4 or k * 2 <= len(was) or len(set(was)) < (6 if dense else 4) or any(0xFF61 <= ord(c) <= 0xFF9F for c in was):
                        continue
                    if dense or 3 * sum(0x3041 <= ord(c) <= 0x30FE for c in was) >= len(was):
                        yield start + s, start + end, a, b, was
                        break


def evidence(text: str) -> dict[int, float]:
    """Chain -> log-likelihood ratio against clean text, for chains above 0.5. Mentions are left out."""
    text = _without_mentions(text)
    chars = set(text)
    odd = {c for c in chars if c >= "\x80"}
    out: dict[int, float] = {}
    if not odd:
        return out
    if "�" in odd:
        out[INDEX["lost"]] = STRONG * 1.5
    for enc in UTF8_READ_AS:
        if _utf8_pattern(enc)[1].isdisjoint(odd):
            continue
        once, weight, _ = _undo_utf8(text, enc)
        if weight > 0:
            if enc == "cp1252":
                _, again, _ = _undo_utf8(once, enc)
                if again > 0:
                    out[INDEX["utf_8>cp1252>utf_8>cp1252"]] = weight + again
            if enc == "latin_1" and not any("\x80" <= c <= "\x9f" for c in odd):
                weight -= 0.5  # as good as cp1252, which is the commoner mistake
            out[INDEX[f"utf_8>{enc}"]] = weight
    if any(o >= 0x3000 or 0xFF61 <= o <= 0xFF9F for o in map(ord, odd)):
        for enc in UTF8_READ_AS_WIDE:
            hits = sum(len(m) for m in _WIDE.findall(text) if _wide_back(m, enc))
            if hits:
                out[INDEX[f"utf_8>{enc}"]] = 3.0 * hits
    if any("\x80" <= c <= "\xff" or c in "ƒ„…†‡‰Šš‹›Œœ" for c in odd):
        for _, _, a, b, was in _wide_runs(text):
            out[INDEX[f"{a}>{b}"]] = out.get(INDEX[f"{a}>{b}"], 0.0) + 2.0 * _kana(was)
    # single-byte chains: parts of the text, so that a garbled part is not outweighed by a clean one
    for part in _PART.findall(text):
        if part.isascii():
            continue
        sums: dict[int, float] = {}
        for w in _WORD.findall(part):
            for k, gain in _word_ratios(w):
                sums[k] = sums.get(k, 0.0) + gain
        for k, v in sums.items():
            if v > 2.5:
                out[k] = out.get(k, 0.0) + v
    return {k: min(v, CAP) for k, v in out.items() if v > 0.5}


def restore(text: str, chain: str) -> tuple[str, bool]:
    """The text with the chain undone, and whether no trace of it is left."""
    if chain == "lost":
        return text, False
    steps = chain.split(">")
    out = text
    for k in range(len(steps) - 2, -1, -2):
        was, read = steps[k], steps[k + 1]
        if was == "utf_8" and read not in UTF8_READ_AS_WIDE:
            out = _undo_utf8(out, read)[0]
        elif was == "utf_8":
            out = _WIDE.sub(lambda m: _wide_back(m.group(), read) or m.group(), out)
        elif (was, read) in WIDE_READ_AS:
            for start, end, a, b, got in reversed(list(_wide_runs(out))):
                if (a, b) == (was, read):
                    out = out[:start] + got + out[end:]
        else:
            key = INDEX[f"{was}>{read}"]

            def part(m: re.Match[str]) -> str:
                gain = sum(g for w in _WORD.findall(m.group()) for k, g in _word_ratios(w) if k == key)
                if gain <= 1.0:
                    return m.group()
                raw = to_bytes(m.group(), read)
                return raw.decode(was, "replace") if raw else _WORD.sub(lambda w: (to_bytes(w.group(), read) or b"").decode(was, "replace") or w.group(), m.group())

            out = _PART.sub(part, out)
    return out, "�" not in out


def gather(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, field, ratios array<struct<c,l>>) of the records with any evidence.

    ASCII texts cannot be cases and stay in the JVM; null and empty texts give no row.
    """
    schema = "id bigint, source string, ratios array<struct<c:int,l:double>>"

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, s, t in zip(b["id"], b["source"], b["t"]):
                if e := evidence(t):
                    rows.append((i, s, [{"c": k, "l": float(v)} for k, v in sorted(e.items())]))
            yield pd.DataFrame(rows, columns=["id", "source", "ratios"])

    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("t"))
    return spread(src.filter(F.col("t").rlike(r"[^\x00-\x7f]"))).mapInPandas(look, schema).withColumn("field", F.lit(text_col))


def estimate(docs: DataFrame, found: DataFrame, source_col: str, rounds: int = 30, strength: float = 20.0, base: float = 0.01, settled: float = 2e-4) -> DataFrame:
    """Adds ``chain`` and ``posterior`` (of any chain) to the gathered evidence by EM.

    The mixture of a source and field is smoothed by ``strength``
    pseudo-records of the corpus mixture; sums are pre-aggregated, and one row
    a (source, field, chain) is kept. Ends when no chain's share of the corpus
    changes by more than ``settled``, or after ``rounds``.
    """
    n = len(CHAINS)
    size = docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    total = size.agg(F.sum("n")).first()[0] or 1.0
    every = [base / n] * n
    of = F.struct("source", "field")
    mix, still = None, False
    for k in range(rounds):
        prior = F.array(*[F.lit(float(p)) for p in every])
        if mix is None:
            e = found.withColumn("prior", prior)
        else:
            e = lookup(found, mix, of, "of", salts=4)
            e = e.withColumn("prior", F.transform(prior, lambda p, i: (F.coalesce(F.get("own", i), F.lit(0.0)) + strength * p) / (F.coalesce("n", F.lit(0.0)) + strength))).drop("own", "n")
        odds = F.transform("ratios", lambda r: F.struct(r["c"].alias("c"), (F.get("prior", r["c"]) * F.exp(r["l"])).alias("o")))
        clean = F.lit(1.0) - F.aggregate("prior", F.lit(0.0), lambda a, x: a + x)
        e = e.withColumn("odds", odds).withColumn("sum", F.aggregate("odds", F.lit(0.0), lambda a, x: a + x["o"]) + F.greatest(clean, F.lit(1e-9)))
        if still or k == rounds - 1:
            best = F.array_max(F.transform("odds", lambda x: F.struct(x["o"].alias("o"), (-x["c"]).alias("c"))))
            names = F.array(*[F.lit(c) for c in CHAINS])
            e = e.withColumn("posterior", F.lit(1.0) - F.greatest(clean, F.lit(1e-9)) / F.col("sum"))
            return e.withColumn("chain", F.get(names, -best["c"])).drop("odds", "sum", "prior")
        shares = e.select("source", "field", "sum", F.explode("odds").alias("x")).groupBy("source", "field", F.col("x.c").alias("c")).agg(F.sum(F.col("x.o") / F.col("sum")).alias("r"))
        shares = checkpoint(shares)
        sums = {r["c"]: r["r"] for r in shares.groupBy("c").agg(F.sum("r").alias("r")).collect()}
        then, every = every, [(sums.get(c, 0.0) + base / n) / (total + 1.0) for c in range(n)]
        still = max(abs(p - q) for p, q in zip(then, every)) <= settled
        own = shares.groupBy("source", "field").agg(F.map_from_entries(F.collect_list(F.struct("c", "r"))).alias("m"))  # at most one entry a chain
        own = own.select(F.col("source").alias("s0"), of.alias("of"), F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda c: F.coalesce(F.element_at("m", c), F.lit(0.0))).alias("own"))
        mix = own.join(size, F.col("s0").eqNullSafe(F.col("source"))).select("of", "own", "n")
    raise ValueError("rounds must be at least 1")


def garbled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", least: float = 0.5) -> DataFrame:
    """(id, chain, posterior) of the affected records, each id once, by its strongest row."""
    found = checkpoint(gather(docs, id_col, text_col, source_col))
    scored = estimate(docs, found, source_col).filter(F.col("posterior") >= least)
    return scored.groupBy(F.col("id").alias(id_col)).agg(F.max_by("chain", F.struct("posterior", "chain")).alias("chain"), F.max("posterior").alias("posterior"))


def repaired(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, chain, posterior, restored, text): affected records with the text put right as far as it can be.

    ``restored`` is false where characters were lost for good.
    """
    hit = garbled(docs, id_col, text_col, source_col)
    texts = docs.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t")).join(hit, F.col("_i") == F.col(id_col)).groupBy(id_col, "chain", "posterior").agg(F.max("_t").alias("_t"))
    schema = f"{id_col} bigint, chain string, posterior double, restored boolean, {text_col} string"

    def fix(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            both = [restore(t, c) for t, c in zip(b["_t"], b["chain"])]
            yield pd.DataFrame({id_col: b[id_col], "chain": b["chain"], "posterior": b["posterior"], "restored": [r for _, r in both], text_col: [t for t, _ in both]})

    return texts.mapInPandas(fix, schema)
