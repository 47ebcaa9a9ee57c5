"""Broken prompt and response pairs: empty, truncated, refused, copied, in another language.

Method: a suffix automaton of the prompt's words is traversed by the answer to
measure how much of it is copied; an automaton over tokens (phrases with gaps)
runs over all sentences for refusals, which are told from prose by what the
other sentences say; a stack of delimiters and the kind of the last line tell whether
the last sentence ended; stop words vote for the language of each side.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftloom.session import spread

WORD = re.compile(r"[^\W_]+")
_ASCII = str.maketrans({c: " " for c in map(chr, range(128)) if not c.isalnum()})


def words_in(text: str) -> list[str]:
    """``WORD.findall``: plain ASCII, once common marks are spaces, is cut by a table instead of a pattern."""
    plain = text
    if not plain.isascii():
        for c in "“”‘’—–…":
            plain = plain.replace(c, " ")
        if not plain.isascii():
            return WORD.findall(text)
    return plain.translate(_ASCII).split()


# --- empty -----------------------------------------------------------------
#: Words that stand for a missing value.
MISSING = set("na nan none null nil nul void empty blank missing undefined unknown unavailable tbd tba todo noanswer noresponse nooutput nodata notavailable notapplicable novalue nothing noneprovided nichts keine leer aucun aucune vide ninguno nada vacío brak пусто нет なし 無し 无".split())


_LONGEST_MISSING = max(map(len, MISSING))


def is_empty(answer: str | None) -> bool:
    core = ""
    for m in WORD.finditer(answer or ""):
        core += m.group().casefold()
        if len(core) > _LONGEST_MISSING:
            return False
    return core == "" or core in MISSING


# --- refusal ---------------------------------------------------------------
class TokenAutomaton:
    """Patterns of words with gaps, all followed at once over a sequence of tokens.

    A pattern is a row of words: ``a|b`` one of several, ``x*`` a beginning,
    ``w?`` may be absent, ``~3`` up to three other words, ``<name>`` any number
    of words of a class. A state is a place in a pattern; every token moves all
    states that are alive, whatever the length of the sequence.
    """

    def __init__(self, patterns: dict[str, list[str]], classes: dict[str, frozenset[str]]):
        self.classes = classes
        self.rows: list[tuple[str, list[tuple]]] = []
        self.start: dict[str, list[int]] = {}
        for name, ps in patterns.items():
            for p in ps:
                for words in self._spread(p.split()):
                    row = [self._element(w) for w in words]
                    for w in row[0][1]:
                        self.start.setdefault(w, []).append(len(self.rows))
                    self.rows.append((name, row))

    @staticmethod
    def _spread(words: list[str]) -> list[list[str]]:
        out: list[list[str]] = [[]]
        for w in words:
            out = [x + [w.rstrip("?")] for x in out] + ([list(x) for x in out] if w.endswith("?") else [])
        return out

    def _element(self, w: str) -> tuple:
        if w[0] == "~":
            return "gap", int(w[1:])
        if w[0] == "<":
            return "class", self.classes[w[1:-1]]
        alternatives = w.split("|")
        return "word", frozenset(x for x in alternatives if x[-1] != "*"), tuple(x[:-1] for x in alternatives if x[-1] == "*")

    def hits(self, tokens: list[str]) -> Iterator[tuple[str, int, int]]:
        """(pattern's name, first token, last token) of every match."""
        alive: list[tuple[int, int, int, int]] = []  # row, place in it, first token, words left in the gap
        for i, t in enumerate(tokens):
            if not alive and t not in self.start:
                continue
            then = [(r, 0, i, 0) for r in self.start.get(t, ())]
            alive, now = [], alive + then
            for r, k, first, left in now:
                name, row = self.rows[r]
                e = row[k]
                if e[0] != "word":  # a gap: stay in it, or take what follows it
                    if e[0] == "class" and t in e[1]:
                        alive.append((r, k, first, 0))
                    elif e[0] == "gap" and left > 0:
                        alive.append((r, k, first, left - 1))
                    k += 1
                    e = row[k]
                if t in e[1] or e[2] and t.startswith(e[2]):
                    if k + 1 == len(row):
                        yield name, first, i
                    else:
                        alive.append((r, k + 1, first, row[k + 1][1] if row[k + 1][0] == "gap" else 0))


#: Words between a declining phrase and the task.
FILLERS = frozenset("to be able try trying really further have in a position any just simply currently for me from on i i'm am can comfortable it at this time moment possible here willing want please unfortunately and must also feel with help you out going do".split())
#: Words for the task, and what it is done to.
TASK = "rewrit*|rework*|restyl*|rephras*|revis*|edit*|process*|assist*|comply*|compli*|comple*|produc*|fulfil*|continu*|paraphras*|polish*|transform*|handl*|convert*|translat*|generat*|provid*|improv*|refin*|adapt*|answer*|respond*|proceed*|engag*|touch*|pass|passing|do|doing|help|helping"
OBJECTS = frozenset("this that the such your it with on these those any a request text passage draft paragraph content".split())
#: Phrases that decline, by what they need beside them.
DECLINES = {
    # said by anyone, the task follows
    "alone": ["can't", "cannot", "can not", "unable", "not able", "not possible", "impossible", "not in a position", "not have permission", "not something", "not feel able", "not comfortable", "not permitted", "not allowed", "not willing", "not going to", "not supposed"],
    # said in the first person, the task follows
    "first": ["won't", "will not", "rather not", "decline", "declining", "refuse", "refrain", "don't have permission", "no permission", "prevent me", "prevents me", "don't feel able", "am not free", "keeps me", "keep me", "stop me", "forbid me", "don't want", "do not want", "couldn't", "could not"],
}
#: Whole refusals, English idioms first, then other languages.
WHOLE = [
    "request is|was|has? been? declined|refused|denied|rejected", "falls|fall outside of? what i", "outside of? my|the scope|remit|capabilit*|guidelines", "against|violate|violates|violating|breach|breaches|breaching my rules|guidelines|policy|policies|principles",
    "rewriting|editing|processing|reworking|restyling this|that|such|the ~1 is not something|possible", "i must|respectfully|will decline|refuse", "i have|need to decline|refuse", "i'll decline|refuse", "content policy",
    # Spanish
    "no puedo|podré|podre|debo ~3 ayudar*|reescribir*|procesar*|editar*|cumplir*|atender*|continuar*|reformular*|modificar*|completar*|hacer*|tratar*|satisfacer*", "no me es posible ~3 ayudar*|reescribir*|procesar*|editar*|cumplir*|atender*|continuar*|reformular*|modificar*|completar*|hacer*|tratar*|satisfacer*",
    "no estoy autorizado|autorizada ~3 ayudar*|reescribir*|procesar*|editar*|cumplir*|atender*|continuar*|reformular*|modificar*|completar*|hacer*|tratar*|satisfacer*", "no tengo permiso ~3 ayudar*|reescribir*|procesar*|editar*|cumplir*|atender*|continuar*|reformular*|modificar*|completar*|hacer*|tratar*|satisfacer*",
    "debo rechazar|declinar|negarme", "tengo que rechazar|declinar|negarme", "rechazo esta|la petición|peticion|solicitud", "no puedo hacerlo", "no puedo hacer eso",
    # Portuguese, Italian
    "não|nao posso|consigo|poderei ~3 ajudar*|reescrever*|processar*|editar*|cumprir*|atender*|continuar*|reformular*|modificar*|fazer*|tratar*", "não|nao me é possível ~3 ajudar*|reescrever*|processar*|editar*|cumprir*|atender*|continuar*|reformular*|modificar*|fazer*|tratar*",
    "não|nao estou autorizado|autorizada ~3 ajudar*|reescrever*|processar*|editar*|cumprir*|atender*|continuar*|reformular*|modificar*|fazer*|tratar*", "devo recusar", "tenho de|que recusar", "non posso aiutar*|riscriver*|elaborar*|modificar*",
    # French
    "je ne peux|puis|pourrai|suis|saurais|dois pas? ~4 traiter*|réécrire*|reformuler*|modifier*|aider*|répondre*|accéder*|donner|continuer*|mesure*|retravailler*|éditer*|satisfaire*", "il m'est impossible", "je dois|préfère refuser|décliner", "je dois|préfère ne pas", "je refuse de", "ne m'est pas possible", "ne m'autorisent pas",
    # German
    "kann|darf|möchte|werde ich? ~6 nicht ~2 umschreiben*|bearbeiten*|helfen*|verarbeiten*|überarbeiten*|erfüllen*|umformulieren*|behandeln*|nachkommen*|weiterhelfen*|ausführen*|liefern*|ändern*", "muss|möchte ich? ~5 ablehnen|verweigern", "ist es? mir ~3 nicht möglich|erlaubt|gestattet", "anfrage|bitte ~3 abgelehnt",
    # Polish, Dutch
    "nie mogę|będę ~4 pomóc*|przepisać*|przetworzyć*|zredagować*|edytować*|zrealizować*|spełnić*|wykonać*|przeredagować*|przerobić*|opracować*", "nie jestem w stanie ~4 pomóc*|przepisać*|przetworzyć*|zredagować*|edytować*|zrealizować*|spełnić*|wykonać*|przeredagować*|przerobić*|opracować*",
    "nie wolno mi ~4 pomóc*|przepisać*|przetworzyć*|zredagować*|edytować*|zrealizować*|spełnić*|wykonać*|przeredagować*|przerobić*|opracować*", "muszę odmówić", "odmawiam", "kan ik? ~4 niet helpen|herschrijven|bewerken|verwerken",
    # Russian
    "не могу|смогу|буду ~4 помочь*|переписать*|обработать*|редактировать*|отредактировать*|выполнить*|переработать*|продолжить*|помогать*|сделать*", "не имею права ~4 помочь*|переписать*|обработать*|редактировать*|отредактировать*|выполнить*|переработать*|продолжить*|помогать*|сделать*",
    "не в состоянии ~4 помочь*|переписать*|обработать*|редактировать*|отредактировать*|выполнить*|переработать*|продолжить*|помогать*|сделать*", "вынужден|вынуждена|вынуждены|должен|должна ~2 отказать*", "отказываюсь",
]
REFUSALS = TokenAutomaton(
    {
        "alone": [f"{p} <fillers> {TASK}" for p in DECLINES["alone"]], "first": [f"{p} <fillers> {TASK}" for p in DECLINES["first"]],
        "last": ["decline", "refuse"], "pass": ["have|going to <fillers> pass on", "must <fillers> pass on"], "whole": WHOLE,
    },
    {"fillers": FILLERS},
)
#: Refusals in languages without spaces: whole ones, and stems that an ending in the same sentence makes one.
_UNSPACED = [*[a + b for a in ("无法", "不能", "無法") for b in ("协助", "帮助", "处理", "改写", "满足", "提供", "完成", "重写", "編輯", "處理", "協助")], "お断りします", "お断りいたします", "お断りしなければ", "도와드릴 수 없", "도와드릴수 없", "도와드릴 수없", "도와드릴수없"]
_STEMS, _ENDINGS = ["書き直", "書き換え", "お手伝い", "対応", "処理", "編集", "お応え", "お受け", "ご要望"], ["できません", "できかねます", "いたしかねます"]


@lru_cache(1)
def _unspaced() -> ahocorasick.Automaton:
    auto = ahocorasick.Automaton()
    for kind, words in (("whole", _UNSPACED), ("stem", _STEMS), ("ending", _ENDINGS)):
        for w in words:
            auto.add_word(w, kind)
    auto.make_automaton()
    return auto


_QUOTED = re.compile(r"[\"“«„][^\"”»“\n]{2,}[\"”»“]|「[^」\n]{2,}」")
_TOK = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
_SENT = re.compile(r"[^.!?。！？\n]+[.!?。！？]*")
_FIRST_PERSON = frozenset("i i'm i'd i'll i've me my".split())


def _declines(sentence: str) -> bool:
    """Whether a sentence declines: a pattern of the automaton, with its object or in the first person."""
    tokens = _TOK.findall(sentence.lower())
    mine = not _FIRST_PERSON.isdisjoint(tokens)
    for name, first, last in REFUSALS.hits(tokens):
        after = tokens[last + 1] if last + 1 < len(tokens) else None
        if name == "whole" or name == "pass" and mine or name == "last" and after is None and mine:
            return True
        if name == "alone" or name == "first" and mine:
            if tokens[last] in ("do", "help") and not (after is None or after in OBJECTS or after in ("you", "so")):
                continue
            if after != "but" and (mine or after is None or after in OBJECTS or after in ("you", "so", "because", "about", "further")):
                return True
    if not sentence.isascii():
        stem = False
        for _, kind in _unspaced().iter(sentence):
            if kind == "whole" or kind == "ending" and stem:
                return True
            stem = stem or kind == "stem"
    return False


#: What a refusal says around the declining itself (regret, reasons, offers, the reader).
_AROUND = re.compile(
    r"(?i)\b(?:sorry|apolog\w+|regret|unfortunately|afraid|you|your|yours|request\w*|instead|happy to|glad to|let me know|feel free|polic(?:y|ies)|guidelines|as an ai|assistant|thank\w*|understand|appreciate|reasons?"
    r"|lo siento|disculp\w+|lamento|usted|puedes?|petici[oó]n|solicitud|gracias|desculp\w+|pedido|você|obrigad\w|désolé\w*|vous|votre|merci|demande|leider|sie|ihre\w*|ihnen|gerne|danke|anfrage|bedaure|przepraszam|niestety|prośb\w+|dziękuję|helaas|verzoek|извините|сожалени\w+|вы|вам|ваш\w*|запрос\w*|спасибо)\b|申し訳|恐れ入り|ください|ご了承|抱歉|对不起|請|请|죄송"
)


def _covered(prompt: str, answer: str) -> float:
    """The share of the prompt's longer words that occur in the answer."""
    of = {w for w in words_in(prompt.casefold()) if len(w) > 3}
    return len(of.intersection(words_in(answer.casefold()))) / len(of) if of else 0.0


def is_refusal(answer: str, prompt: str | None = None) -> bool:
    """An answer whose own words, quotations apart, decline the task.

    One of up to four sentences that begins by declining is one. In any other
    at least half of the sentences must decline or say what goes with it, and
    little of the prompt may be in it: else it is prose.
    """
    plain = _QUOTED.sub(" ", answer.replace("’", "'").replace("`", ""))
    sentences = [s for s in _SENT.findall(plain) if WORD.search(s)]

    said = [_declines(s) for s in sentences]
    if not any(said):
        return False
    if len(sentences) <= 4 and any(said[:2]):
        return True
    around = [bool(_AROUND.search(s)) for s in sentences]
    if 4 * sum(around) < len(sentences) or prompt is not None and _covered(prompt, plain) > 0.35:
        return False
    return 2 * sum(a or b for a, b in zip(around, said)) >= len(sentences)


# --- copy ------------------------------------------------------------------
class SuffixAutomaton:
    """All runs of a sequence's words, as transitions between end classes."""

    def __init__(self, words: list[str]):
        self.next: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for w in words:
            cur = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and w not in self.next[p]:
                self.next[p][w] = cur
                p = link[p]
            if p != -1:
                q = self.next[p][w]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and self.next[p].get(w) == q:
                        self.next[p][w] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        self.link, self.length = link, length

    def covered(self, words: list[str], least: int = 3) -> int:
        """Words of a sequence inside runs of at least ``least`` words of the automaton's."""
        state = run = 0
        reach = total = 0
        for i, w in enumerate(words):
            while state and w not in self.next[state]:
                state = self.link[state]
                run = self.length[state]
            if w in self.next[state]:
                state = self.next[state][w]
                run += 1
            else:
                run = 0
            if run >= least:
                total += i + 1 - max(reach, i + 1 - run)
                reach = i + 1
        return total


def _edits(a: list[str], b: list[str], most: int) -> int:
    """Levenshtein distance of word sequences within a band; most + 1 if it is more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    big = most + 1
    prev = {j: j for j in range(min(len(b), most) + 1)}
    for i, x in enumerate(a, 1):
        cur = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            if j == 0:
                cur[j] = i
                continue
            cur[j] = min(prev.get(j - 1, big) + (x != b[j - 1]), prev.get(j, big) + 1, cur.get(j - 1, big) + 1)
        prev = cur
        if min(prev.values()) > most:
            return big
    return prev.get(len(b), big)


def is_copy(prompt: str, answer: str) -> bool:
    """The answer's words are the prompt's but for one in twenty and a line of introduction."""
    p = words_in(prompt.casefold())
    if not p:
        return False
    tries = [answer]
    head, _, rest = answer.strip().partition("\n")
    if rest:
        tries.append(rest)
    if m := re.match(r"[^.:!?\n]*[:!]\s+(?:[^.:!?\n]*:\s+)?", answer):
        tries.append(answer[m.end() :])
    of = set(p)
    most = max(len(p) // 20, 0)
    automaton = None
    for t in tries:
        a = words_in(t.casefold())
        if not a or abs(len(a) - len(p)) > most or len(of.difference(a)) > most:
            continue
        automaton = automaton or SuffixAutomaton(p)
        if automaton.covered(a, min(3, len(p))) < len(a) - 3 * most:
            continue
        if most == 0 or a == p:
            if a == p:
                return True
        elif _edits(p, a, most) <= most:
            return True
    return False


# --- language --------------------------------------------------------------
#: Stop words that tell languages apart.
STOPWORDS = {
    "en": "the and of to is was that with for not but from this which are you it on as by be at or an have has were been their its they we he she i my in",
    "de": "der die das und ist nicht mit von den dem ein eine einen einem einer für auf sich im zu auch es ich wir sie war haben hat wird werden als noch nur aus bei nach über keiner kein keine aber oder dass daß jeder heute",
    "fr": "le les des et est un une du dans que qui pour pas sur au aux avec ce cette il elle nous vous je ne plus par sont été mais ou comme sans rien toute tout depuis cet leur dont",
    "es": "el los las y es un una del que por con para se lo su al como más pero sus ya o este sí porque esta entre cuando muy sin sobre también hasta nada nadie fue desde hace todo ser sido",
    "pt": "o os as e é um uma do da dos das que por com para se no na nos nas mais mas como ao à não já foi há em ou seu sua pelo pela muito também só ninguém tem ser nada",
    "pl": "i w na z nie się jest że do to jak ale po od za przez dla czy tylko już był była było są ten ta te więc żeby nikt który która które każdy został znów swój mi o",
    "it": "il lo gli e è un una di che per con non si della dei delle nel nella sono come più ma anche questo questa al alla da ha",
    "nl": "de het een en van is dat niet met voor op zijn ook aan er maar om te bij uit naar dan wordt was",
}
_VOTES: dict[str, list[str]] = {}
for _l, _ws in STOPWORDS.items():
    for _w in _ws.split():
        _VOTES.setdefault(_w, []).append(_l)
_SCRIPTS = [("ru", re.compile(r"[а-яё]{2,}", re.I)), ("ja", re.compile(r"[぀-ヿ]+")), ("zh", re.compile(r"[一-鿿]+")), ("ko", re.compile(r"[가-힣]+")), ("ar", re.compile(r"[؀-ۿ]+")), ("he", re.compile(r"[א-ת]+")), ("el", re.compile(r"[α-ωά-ώ]{2,}", re.I)), ("hi", re.compile(r"[ऀ-ॿ]+")), ("th", re.compile(r"[ก-๛]+"))]
_NOT_PROSE = re.compile(r"(?ms)^(```|~~~).*?^\1|\$\$.*?\$\$|^[ \t]*>.*?$|<(script|style|pre)\b.*?</\2>|\\begin\{(verbatim|equation|align\*?|lstlisting)\}.*?\\end\{\3\}|`[^`\n]+`|\\[a-zA-Z]+\*?|[\"“«„][^\"”»“\n]{12,}[\"”»“]")


def votes(text: str) -> dict[str, int]:
    """Language -> votes of stop words, or characters in its own script."""
    text = _NOT_PROSE.sub(" ", text)
    out: dict[str, int] = {}
    said = Counter(words_in(text.lower()))
    for w in _VOTES.keys() & said.keys():
        for lang in _VOTES[w]:
            out[lang] = out.get(lang, 0) + said[w]
    if not text.isascii():
        for lang, pat in _SCRIPTS:
            n = sum(map(len, pat.findall(text)))
            if n:
                out[lang] = out.get(lang, 0) + (n // 4 if lang in ("ru", "el") else n // 2)
        if out.get("ja"):
            out["ja"] += out.pop("zh", 0)
    return out


def language(text: str) -> str | None:
    """The language with the most votes, if it has at least 3 and 1.5 times the next."""
    v = sorted(((n, x) for x, n in votes(text).items()), reverse=True)
    if not v or v[0][0] < 3 or len(v) > 1 and v[1][0] * 3 > v[0][0] * 2:
        return None
    return v[0][1]


def other_language(prompt: str, answer: str) -> bool:
    a, p = votes(answer), votes(prompt)
    if not a or not p:
        return False
    la, lp = max(a, key=lambda x: (a[x], x)), max(p, key=lambda x: (p[x], x))
    if la == lp or a[la] < 3 or p[lp] < 3:
        return False
    return 2 * a[la] >= 3 * a.get(lp, 0) + 2 and 2 * p[lp] >= 3 * p.get(la, 0) + 2


# --- truncated -------------------------------------------------------------
_INVISIBLE = "﻿​‌‍⁠"
_BLOCK_END = re.compile(
    r"^\s*(?:[-*+•]\s+\S|\d+[.)]\s+\S|#{1,6}\s|>\s?\S|\||\{\||\|\}|:::|```|~~~|\$\$|\\\]|\\(?:end|section|subsection|subsubsection|chapter|paragraph|item|label|caption|bibliography)\b|\[[^\]]+\]:\s|\[\^[^\]]+\]:|<[^>]+>.*|=+[^=]+=+\s*$|[-=_*]{3,}\s*$|\[\[[^\]]*\]\]\s*$|\{\{.*\}\}\s*$|!\[[^\]]*\]\([^)]*\)\s*$|[*#:;]+\s*\S|<!--)"
)
_END = re.compile(r"[.!?…。！？](?:[\"'”’»)\]}*_~`」』]|\s*\[[^\]\s]*\](?:\([^)]*\)|\{[^}]*\})?|\^\[[^\]]*\]|\{\{[^}]*\}\}|~?\\\w+\{[^}]*\}|</?\w[^>]*>|&\w+;|<!--.*?-->)*\s*$")
_MARK_END = re.compile(r"(?:</\w+\s*>|/>|-->|\\\)|\\\]|\\end\{\w+\*?\}|\]\([^)\s]*(?:\s\"[^\"]*\")?\)|`|\}\}|\]\])\s*$")
#: What opens and closes blocks, in the whole text; a run of code in a line is passed over.
_BLOCKS = re.compile(r"(?m)^[ ]{0,3}(?P<fence>```+|~~~+)|`[^`\n]+`|\\begin\{(?P<begin>[^}\n]*)\}?|\\end\{(?P<end>[^}\n]*)\}?|<(?P<open>pre|script|style|table)\b|</(?P<close>pre|script|style|table)\b|^(?P<wiki>\{\|)|^(?P<ikiw>\|\})|(?P<math>\$\$)")
_INLINE = re.compile(r"`[^`\n]+`|\$[^$\n]+\$|\\[()\[\]{}]|[:;=]-?[()\[\]]|(?m:^\s*\(?\w{1,3}\))|[\[(]\s*-?[\d.]+\s*,\s*-?[\d.]+\s*[\])]|(?<![\w*])\*\*(?=[\w'“(])|(?<=[^\s*])\*\*(?!\*)|[()\[\]{}“”„]")
_CLOSES = {")": "(", "]": "[", "}": "{"}


def open_blocks(text: str) -> list[str]:
    """The stack of fences, environments, tables, code and displayed formulas left open; a stray closer closes nothing."""
    stack: list[str] = []
    for m in _BLOCKS.finditer(text):
        kind, v = m.lastgroup, m.group(m.lastgroup) if m.lastgroup else ""
        if kind is None:
            continue
        within = stack[-1] if stack else ""
        if within[:1] in "`~" and within:
            if kind == "fence" and v[0] == within[0]:
                stack.pop()
            continue
        name = {"fence": v[:1], "begin": "\\" + v, "end": "\\" + v, "open": "<" + v, "close": "<" + v, "wiki": "{|", "ikiw": "{|", "math": "$$"}[kind]
        if within in ("\\verbatim", "\\lstlisting", "<pre", "<script", "<style") and (kind not in ("end", "close") or name != within):
            continue
        if kind in ("end", "close", "ikiw") or kind == "math" and "$$" in stack:
            if name in stack:
                while stack.pop() != name:
                    pass
        else:
            stack.append(name)
    return stack


def open_inline(paragraph: str) -> list[str]:
    """The stack of brackets, quotes and strong emphasis left open in a paragraph, code and formulas apart."""
    stack: list[str] = []
    for m in _INLINE.finditer(paragraph):
        c = m.group()
        if c == "**" and "**" in stack:
            del stack[stack.index("**") :]
        elif c == "**" and paragraph[m.end() : m.end() + 1].strip() and not paragraph[: m.start()][-1:].strip():
            stack.append(c)
        elif c in ("(", "[", "{", "“", "„"):
            if c == "“" and "„" in stack:  # closes a German quotation
                del stack[stack.index("„") :]
            else:
                stack.append(c)
        elif c == "”" or c in _CLOSES:
            of = _CLOSES.get(c, "“")
            if of in stack:
                while stack.pop() != of:
                    pass
    return stack


def is_truncated(answer: str) -> bool:
    """The last sentence is not complete, or a fence, formula, environment or table is left open."""
    text = answer.rstrip().rstrip(_INVISIBLE).rstrip()
    if open_blocks(text):
        return True
    last = re.split(r"\r\n|\n|\r", text)[-1]
    if len(WORD.findall(text)) <= 3 and not re.search(r"[,;:(\[“—-]\s*$", text):
        return False
    stripped = last.strip()
    # a bracket or quotation opened in the last paragraph and never closed
    left = open_inline(re.split(r"(?:\r\n|\n|\r){2,}", text)[-1])
    if any(c in ("(", "[", "{", "**") for c in left):
        return True
    if _BLOCK_END.match(last) and not re.search(r"[,;(“]$|\s[—–-]$", stripped):
        return False
    if _END.search(stripped) or _MARK_END.search(stripped):
        return bool(left) and not re.search(r"[.!?…]\s*$", stripped)
    return not _short_line_in_list(text, stripped)


def _short_line_in_list(text: str, last: str) -> bool:
    """Whether the last line belongs to a list, quote or code begun on an earlier line of its block."""
    block = re.split(r"(?:\r\n|\n|\r){2,}", text)[-1]
    head = re.split(r"\r\n|\n|\r", block)[0]
    return head != last and bool(re.match(r"\s*(?:[-*+]\s|\d+[.)]\s|>|\||<)", head)) and not re.search(r"[,;:—]$", last)


# --- all -------------------------------------------------------------------
def without_heading(text: str | None, context: str | None) -> str | None:
    """The text without a first line equal to the context heading."""
    if text is None or not context or not (c := context.strip()):
        return text
    t = text.lstrip("﻿ \t\r\n")
    if t.startswith(c) and (len(t) == len(c) or t[len(c)] in "\r\n"):
        return t[len(c) :].lstrip("\r\n")
    return text


def defect(prompt: str | None, answer: str | None) -> str | None:
    """The defect of an answer, or None. Of several the first of: empty, refusal, copy, language, truncated."""
    if is_empty(answer):
        return "empty"
    if is_refusal(answer, prompt):
        return "refusal"
    if prompt is not None and not is_empty(prompt):
        if is_copy(prompt, answer):
            return "copy"
        if other_language(prompt, answer):
            return "language"
    return "truncated" if is_truncated(answer) else None


def flag_defects(rows: DataFrame, table_name: str, id_col: str, prompt: Column, answer: Column, context: Column) -> DataFrame:
    """(rec_table, rec_id, defect) of the defective rows; repeated rows of an id give one row.

    A null answer is 'empty'; a null prompt leaves the defects that need none;
    a null context is no heading. Rows with a null id are left out.
    """

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = []
            for i, p, a, c in zip(b["i"], b["p"], b["a"], b["c"]):
                if d := defect(without_heading(p, c), without_heading(a, c)):
                    got.append((i, d))
            yield pd.DataFrame(got, columns=["rec_id", "defect"])

    src = rows.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("i"), prompt.alias("p"), answer.alias("a"), context.alias("c"))
    out = spread(src).mapInPandas(look, "rec_id bigint, defect string")
    return out.groupBy("rec_id").agg(F.min("defect").alias("defect")).select(F.lit(table_name).alias("rec_table"), "rec_id", "defect")


def turn(messages: Column, role: str) -> Column:
    """The content of the first message of a role; null if there is none."""
    return F.get(F.filter(messages, lambda m: m["role"] == role), 0)["content"]
