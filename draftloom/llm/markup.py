"""Markup leaves of a text: scanned, read by a recurrent labeller, turned into clean text.

A scanner cuts a text into a sequence of leaves: runs of prose, bodies of code,
and spans that may be HTML, Markdown, wiki or LaTeX notation or may be meant
literally. ``draftloom.llm.labeller`` reads the sequence with a bidirectional
LSTM and gives each leaf its family. Here are the scanner and the rewriting.
"""

from __future__ import annotations

import html
import re
import zlib
from typing import NamedTuple

FAMILIES = ["none", "html", "markdown", "wiki", "latex"]

#: kind -> (role in the clean text, families the notation can belong to). The order fixes the kinds' numbers.
KINDS: dict[str, tuple[str, tuple[str, ...]]] = {
    "text": ("text", ()),
    "code": ("code", ()),
    "fence": ("mark", ("markdown",)),
    "atx": ("heading", ("markdown",)),
    "setext": ("heading", ("markdown",)),
    "bullet": ("item", ("markdown",)),
    "number": ("item", ("markdown",)),
    "quote": ("quote", ("markdown",)),
    "pipe": ("row", ("markdown",)),
    "div": ("mark", ("markdown",)),
    "linkdef": ("mark", ("markdown",)),
    "notedef": ("note", ("markdown",)),
    "rule": ("mark", ("markdown",)),
    "tick": ("code", ("markdown",)),
    "image": ("alt", ("markdown",)),
    "link": ("inner", ("markdown",)),
    "reflink": ("inner", ("markdown",)),
    "span": ("inner", ("markdown",)),
    "cite": ("mark", ("markdown",)),
    "noteref": ("mark", ("markdown",)),
    "inlinenote": ("mark", ("markdown",)),
    "strong": ("inner", ("markdown",)),
    "emph": ("inner", ("markdown",)),
    "under": ("inner", ("markdown",)),
    "strike": ("inner", ("markdown",)),
    "attr": ("mark", ("markdown",)),
    "autolink": ("inner", ("markdown", "html")),
    "comment": ("mark", ("html",)),
    "tag": ("tag", ("html",)),
    "endtag": ("tag", ("html",)),
    "entity": ("entity", ("html",)),
    "angle": ("literal", ("html",)),
    "wikihead": ("heading", ("wiki",)),
    "wikilink": ("inner", ("wiki",)),
    "wikiurl": ("inner", ("wiki",)),
    "template": ("mark", ("wiki",)),
    "wikibold": ("inner", ("wiki",)),
    "wikitable": ("row", ("wiki",)),
    "wikiterm": ("item", ("wiki",)),
    "env": ("mark", ("latex",)),
    "section": ("heading", ("latex",)),
    "command": ("command", ("latex",)),
    "accent": ("accent", ("latex",)),
    "item": ("item", ("latex",)),
    "display": ("formula", ("latex",)),
    "inline": ("formula", ("latex",)),
    "dollar": ("formula", ("latex",)),
    "bracket": ("literal", ("markdown",)),
    "sign": ("literal", ()),
}
KIND_NO = {k: i for i, k in enumerate(KINDS)}


class Leaf(NamedTuple):
    kind: str
    start: int
    end: int
    path: int  # a hash of the names of all open tags


#: Names of HTML elements.
_TAGS = "a abbr address article aside audio b bdi bdo big blockquote body br button canvas caption center cite code col colgroup dd del details dfn div dl dt em embed fieldset figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark math meta nav noscript object ol option p param picture pre progress q s samp script section select small source span strike strong style sub summary sup svg table tbody td template textarea tfoot th thead time title tr tt u ul var video wbr ref nowiki gallery references".split()
_TAG = "(?:" + "|".join(sorted(_TAGS, key=len, reverse=True)) + ")"
_ATTR = r"(?:\s+[A-Za-z_:@][\w:.-]*(?:\s*=\s*(?:\"[^\"<>]*\"|'[^'<>]*'|[^\s\"'<>=`]+))?)*"

_CODE_BLOCKS = re.compile(
    r"(?P<fence>^[ \t]*(?P<f>`{3,}|~{3,})[^\n`]*\n)(?P<fbody>.*?)(?P<fend>^[ \t]*(?P=f)[`~]*[ \t]*$|\Z)"
    r"|(?P<pre><(?P<t>pre|script|style|nowiki|textarea)\b[^>]*>(?:\s*<code\b[^>]*>)?)(?P<pbody>.*?)(?P<pend>(?:</code\s*>\s*)?</(?P=t)\s*>|\Z)"
    r"|(?P<verb>\\begin\{(?P<v>verbatim\*?|lstlisting|minted|Verbatim|alltt)\}(?:\[[^\]\n]*\])?(?:\{[^}\n]*\})?)(?P<vbody>.*?)(?P<vend>\\end\{(?P=v)\}|\Z)"
    r"|(?P<vline>\\verb\*?(?P<d>[^\w\s*])[^\n]*?(?P=d))"
    r"|(?P<display>(?<!\\)\$\$.+?\$\$(?:[ \t]*\{\#[^}\n]*\})?|\\\[.+?\\\])",
    re.M | re.S | re.I,
)

#: Notation that begins a line, tried where a line begins with one of these signs.
_LINE_SIGNS = frozenset("#-*+>|:={![;<0123456789abcdefghijklmnopqrstuvwxyz")
_LINE = re.compile(
    r"(?P<div>[ \t]{0,3}:{3,}[^\n]*$)"
    r"|(?P<wikitable>[ \t]*(?:\{\|[^\n]*|\|\}|\|-+[^\n|]*|![^\n\[][^\n]*|\|\+[^\n]*|\|[^\n|]*\|\|[^\n]*)$)"
    r"|(?P<pipe>[ \t]*\|[^\n]*\|[ \t]*$|[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)+$)"
    r"|(?P<wikihead>(?P<eq>={1,6})[ \t]*[^=\n](?:[^\n]*[^=\n])?[ \t]*(?P=eq)[ \t]*$)"
    r"|(?P<atx>[ ]{0,3}\#{1,6}(?:[ \t]+[^\n]*)?$)"
    r"|(?P<rule>[ ]{0,3}(?:(?:\*[ \t]*){3,}|(?:-[ \t]*){3,}|(?:_[ \t]*){3,})$)"
    r"|(?P<linkdef>[ ]{0,3}\[[^\]\n^@]+\]:[ \t]*\S+[^\n]*$)"
    r"|(?P<notedef>[ ]{0,3}\[\^[^\]\s]+\]:)"
    r"|(?P<bullet>[ \t]*[-*+][ \t]+(?:\[[ xX]\][ \t]+)?(?=\S))"
    r"|(?P<number>[ \t]*(?:\d{1,3}|[a-z]|[ivx]{1,4})[.)][ \t]+(?=\S))"
    r"|(?P<quote>[ ]{0,3}>[ \t]?)"
    r"|(?P<wikiterm>[;:]{1,3}[ \t]*[^\s;:][^\n]*$)",
    re.M,
)
_SETEXT = re.compile(r"^(?P<setext>[^\s>|\#\-*=+:;!{\[\\<$][^\n]*\n[ ]{0,3}(?:-{3,}|={3,})[ \t]*$)", re.M)

#: Signs that can begin notation within a line, and the notations to try there, in order.
_TRIGGER = re.compile(r"[<&\[{\\$*_~`^@|%>]|''|==|->|!\[")
_AT: dict[str, list[str]] = {
    "<": [r"(?P<comment><!--.*?-->)", rf"(?P<tag><(?i:!DOCTYPE[^>]*|{_TAG}{_ATTR}\s*/?)>)", rf"(?P<endtag></(?i:{_TAG})\s*>)", r"(?P<autolink><(?:https?://|mailto:)[^\s<>]+>)", r"(?P<angle></?[A-Za-z][A-Za-z0-9-]*[^<>\n]*>)", r"(?P<sign><-?)"],
    "&": [r"(?P<entity>&(?:[A-Za-z][A-Za-z0-9]{1,31}|\#[0-9]{1,7}|\#[xX][0-9A-Fa-f]{1,6});)", r"(?P<sign>&)"],
    "!": [r"(?P<image>!\[(?:[^\[\]\n]|\n(?![ \t]*\n))*\](?:\([^)\n]*\)|\[[^\]\n]*\])(?:\{[^}\n]*\})?)"],
    "[": [
        r"(?P<wikilink>\[\[[^\[\]\n]+(?:\[\[[^\[\]\n]*\]\][^\[\]\n]*)*\]\])", r"(?P<wikiurl>\[(?:https?:)?//[^\s\]]+(?:[ \t]+[^\]\n]*)?\](?!\())", r"(?P<noteref>\[\^[^\]\s]+\])", r"(?P<cite>\[[^\[\]\n@]*@[\w:.\#$%&+?<>~/-]+[^\[\]\n]*\])",
        r"(?P<link>\[(?:[^\[\]\n]|\n(?![ \t]*\n))*\]\([^()\n]*(?:\([^()\n]*\)[^()\n]*)*\)(?:\{[^}\n]*\})?)", r"(?P<span>\[[^\[\]\n]+\]\{[^}\n]+\})", r"(?P<reflink>(?<!\w)\[[^\[\]\n]+\][ ]?\[[^\[\]\n]*\])", r"(?P<bracket>\[[^\[\]\n]*\])",
    ],
    "{": [r"(?P<attr>\{(?:[.\#][A-Za-z][\w-]*|[\w-]+=[^\s}]+)(?:\s+[^}\n]*)?\})"],
    "\\": [
        r"(?P<env>\\(?:begin|end)\{[A-Za-z]+\*?\}(?:\[[^\]\n]*\])?)", r"(?P<section>\\(?:part|chapter|section|subsection|subsubsection|paragraph|title)\*?\{[^{}\n]*\})", r"(?P<item>\\item\b(?:\[[^\]\n]*\])?[ \t]*)", r"(?P<inline>\\\(.+?\\\))",
        r"(?P<accent>\\[\"'`^~=.uvHck](?:\{(?:\\[ij]|[A-Za-z])\}|\\[ij]\b|(?<=[\"'`^~=.])[A-Za-z]))", r"(?P<command>\\[A-Za-z@]+\*?(?:\[[^\]\n]*\])*(?:\{(?:[^{}\n]|\{[^{}\n]*\})*\})*|\\[%$&\#_{}~^\\,;:! ])",
    ],
    "~": [r"(?P<command>~\\[A-Za-z@]+\*?(?:\[[^\]\n]*\])*(?:\{(?:[^{}\n]|\{[^{}\n]*\})*\})+)", r"(?P<strike>~~(?![\s~])[^~\n]+?~~)", r"(?P<sign>~+)"],
    "$": [r"(?P<dollar>(?<![\\\w$])\$(?!\s)[^$\n]+?(?<!\\)\$(?!\$))", r"(?P<sign>\$+[\d.,]*)"],
    "*": [r"(?P<strong>\*\*(?!\s)(?:[^*\n]|\n(?![ \t]*(?:\n|[-+*>#|]|\d+[.)])))+?(?<!\s)\*\*)", r"(?P<emph>(?<!\*)\*(?![\s*)])(?:[^*\n]|\n(?![ \t]*(?:\n|[-+*>#|]|\d+[.)])))+?(?<![\s*(])\*(?![\w*]))", r"(?P<sign>\*+)"],
    "_": [r"(?P<strong>(?<!\w)__(?!\s)[^_\n]+?(?<!\s)__(?!\w))", r"(?P<under>(?<![\w_])_(?![\s_])[^_\n]+?(?<![\s_])_(?![\w_]))", r"(?P<sign>_+)"],
    "`": [r"(?P<tick>(?<!`)(?P<bt>`{1,2})(?!`)[^\n]+?(?<!`)(?P=bt)(?!`))"],
    "'": [r"(?P<wikibold>'{2,5}[^'\n]+'{2,5})"],
    "^": [r"(?P<inlinenote>\^\[[^\]\n]+\])", r"(?P<sign>\^\w*)"],
    "@": [r"(?P<cite>(?<![\w@.])@\{?[A-Za-z][\w]*[:_-]?\w*\d{4}\w?\}?)"],
    "=": [r"(?P<sign>==+)"],
    "-": [r"(?P<sign>->)"],
}
_DISPATCH = {c: re.compile("|".join(ps), re.M | re.S) for c, ps in _AT.items()}
_NAMES = {"bt": "tick", "eq": "wikihead"}
_LINES = re.compile("\r\n|\r|[\x0b\x0c\x85  ]")
_BLOCK_SIGNS = ("```", "~~~", "<pre", "<script", "<style", "<nowiki", "<textarea", "\\begin{", "\\verb", "$$", "\\[", "<PRE", "<SCRIPT", "<STYLE")
_NAME = re.compile(r"\w+")


#: Tags whose end may be left out: another of the name ends the one before it.
_IMPLIED = frozenset("p li td th tr dt dd option".split())
_SEED = 7


def _templates(text: str) -> dict[int, int]:
    """Start -> end of the outermost balanced ``{{...}}`` at each start, of any length and with others in them."""
    out: dict[int, int] = {}
    opened: list[int] = []
    for m in re.finditer(r"\{\{|\}\}", text) if "{{" in text else ():
        if m.group() == "{{":
            opened.append(m.start())
        elif opened and m.start() > opened[-1] + 2:
            out[opened.pop()] = m.end()
        elif opened:
            opened.pop()
    return out


def _block(text: str, at: int) -> str:
    """The block that a position lies in, by the first signs of its line."""
    line = text.rfind("\n", 0, at) + 1
    head = text[line : line + 3].lstrip()
    return head[:1] if head[:1] in "#>-*+|!={\\<$;:" else "1" if head[:1].isdigit() else "p"


def scan(text: str) -> list[Leaf]:
    """The leaves of a text whose lines end in LF, in order and without gaps; [] if no leaf can be markup."""
    out: list[Leaf] = []
    path: list[tuple[str, int]] = [("", _SEED)]  # the open tags, each with the hash of the path to it
    found = False
    templates = _templates(text)
    last_comment = text.rfind("-->")  # none can end after it
    last_inline = text.rfind("\\)")

    def add(kind: str, s: int, e: int) -> None:
        nonlocal found
        found = True
        if kind == "endtag" and len(path) > 1:
            path.pop()
        out.append(Leaf(kind, s, e, path[-1][1]))
        if kind == "tag" and text[s + 1] != "!" and not text.startswith("/>", e - 2):
            name = _NAME.match(text, s + 1).group().lower()
            if name not in ("br", "hr", "img", "input", "meta", "link", "wbr"):
                if path[-1][0] == name and name in _IMPLIED:
                    path.pop()
                path.append((name, (path[-1][1] * 31 + zlib.crc32(name.encode())) & 0x7FFFFFFF))

    def plain(a: int, b: int) -> None:
        at = pos = a
        start, k = True, -1  # k: the next trigger, once found
        while pos < b:
            if start:
                j = pos
                while j < b and text[j] in " \t":
                    j += 1
                m = _LINE.match(text, pos, b) if j < b and text[j] in _LINE_SIGNS else None
                if m and m.end() > pos:
                    if at < pos:
                        out.append(Leaf("text", at, pos, path[-1][1]))
                    add(_NAMES.get(m.lastgroup, m.lastgroup), pos, m.end())
                    at = pos = m.end()
                    continue
            start = False
            if k < pos:
                t = _TRIGGER.search(text, pos, b)
                k = t.start() if t else b
            nl = text.find("\n", pos, k)
            if nl >= 0:
                pos, start = nl + 1, True
                continue
            if k >= b:
                break
            end = templates.get(k)
            if end is not None and end <= b:
                kind = "template"
            else:
                c = text[k]
                d = _DISPATCH.get(c)
                if c == "<" and last_comment < k and text.startswith("<!--", k) or c == "\\" and last_inline < k and text.startswith("\\(", k):
                    d = None  # never closed
                m = d.match(text, k, b) if d else None
                if not m:
                    pos = k + 1
                    continue
                kind, end = _NAMES.get(m.lastgroup, m.lastgroup), m.end()
            if at < k:
                out.append(Leaf("text", at, k, path[-1][1]))
            add(kind, k, end)
            at = pos = end
        if at < b:
            out.append(Leaf("text", at, b, path[-1][1]))

    def inline(a: int, b: int) -> None:
        if a < b and ("\n--" in text or "\n==" in text or "\n -" in text):
            for m in _SETEXT.finditer(text, a, b):
                plain(a, m.start())
                add("setext", m.start(), m.end())
                a = m.end()
        plain(a, b)

    at = 0
    if any(x in text for x in _BLOCK_SIGNS):
        for m in _CODE_BLOCKS.finditer(text):
            inline(at, m.start())
            here = path[-1][1]
            if m.group("fence") is not None:
                parts = [("fence", "fence"), ("code", "fbody"), ("fence", "fend")]
            elif m.group("pre") is not None:
                parts = [("tag", "pre"), ("code", "pbody"), ("endtag", "pend")]
            elif m.group("verb") is not None:
                parts = [("env", "verb"), ("code", "vbody"), ("env", "vend")]
            elif m.group("vline") is not None:
                parts = [("command", "vline")]
            else:
                parts = [("display", "display")]
            found = True
            for kind, g in parts:
                if m.end(g) > m.start(g):
                    out.append(Leaf(kind, m.start(g), m.end(g), (here * 31 + zlib.crc32(g.encode())) & 0x7FFFFFFF))
            at = m.end()
    inline(at, len(text))
    return out if found else []


def unix(text: str) -> str:
    return _LINES.sub("\n", text)


# --- rewriting -------------------------------------------------------------
_ACCENTS = {'"': "̈", "'": "́", "`": "̀", "^": "̂", "~": "̃", "=": "̄", ".": "̇", "u": "̆", "v": "̌", "H": "̋", "c": "̧", "k": "̨"}
_BREAKING = re.compile(r"</?(?:p|div|li|ul|ol|tr|table|h[1-6]|br|hr|blockquote|pre|section|article|dd|dt|dl|thead|tbody)\b", re.I)


def _inner(kind: str, s: str) -> str:
    if kind in ("strong", "strike"):
        return s[2:-2]
    if kind in ("emph", "under"):
        return s[1:-1]
    if kind == "tick":
        return s.strip("`")
    if kind == "wikibold":
        return s.strip("'")
    if kind == "wikilink":
        body = s[2:-2]
        return "" if re.match(r"(?i)(?:category|file|image|datei|bild|fichier|archivo)\s*:", body) and "|" not in body else body.rsplit("|", 1)[-1]
    if kind == "wikiurl":
        return s[1:-1].partition(" ")[2]
    if kind == "autolink":
        return s[1:-1]
    m = re.match(r"!?\[([^\]\n]*)\]", s)
    return m.group(1) if m else s


def rewrite(text: str, leaves: list[Leaf], families: list[str]) -> list[tuple[str, str]]:
    """The clean text as (role, text) parts: heading, item, quote, row, code, formula, text.

    Parts of a line follow one another; a new line within a part is kept. A
    leaf of family 'none' is kept as it is written.
    """
    import unicodedata

    out: list[tuple[str, str]] = []
    for leaf, fam in zip(leaves, families):
        s = text[leaf.start : leaf.end]
        role = KINDS[leaf.kind][0]
        if leaf.kind == "code":
            out.append(("code", s.strip("\n")))
        elif leaf.kind == "text" or fam == "none":
            out.append(("text", s))
        elif role == "heading":
            if leaf.kind == "setext":
                s = s.split("\n")[0]
            elif leaf.kind == "section":
                s = s[s.index("{") + 1 : -1]
            else:
                s = s.strip().strip("#=")
            out.append(("heading", s.strip()))
        elif role == "item":
            out.append(("item", s.lstrip(";: ") if leaf.kind == "wikiterm" else ""))
        elif role == "quote":
            out.append(("quote", ""))
        elif role == "row":
            cells = [c.strip() for c in re.split(r"\|\||!!|\|", re.sub(r"^\s*[|!{]+[-+}]?|\|\s*$", "", s))]
            plain = "" if re.fullmatch(r"[\s|:\-+{}]*|\s*\{\|.*", s) else " | ".join(c for c in cells if c)
            out.append(("row", plain))
        elif role in ("inner", "alt"):
            out.append(("code" if leaf.kind == "tick" else "text", _inner(leaf.kind, s)))
        elif leaf.kind == "tick":
            out.append(("code", _inner("tick", s)))
        elif role == "formula":
            out.append(("formula", re.sub(r"^(\$\$?|\\\[|\\\()\s*|\s*(\$\$?|\\\]|\\\))(\s*\{#[^}]*\})?$", "", s)))
        elif role == "entity":
            out.append(("text", html.unescape(s)))
        elif role == "tag":
            out.append(("text", "\n" if _BREAKING.match(s) else ""))
        elif role == "accent":
            base = re.sub(r"[{}\\]", "", s[2:]).replace("i", "i")[-1:]
            out.append(("text", unicodedata.normalize("NFC", base + _ACCENTS.get(s[1], ""))))
        elif role == "command":
            args = re.findall(r"\{((?:[^{}]|\{[^{}]*\})*)\}", s)
            if re.match(r"~?\\(?:cite|ref|label|eqref|pageref|cref|Cref|autoref|input|include|vspace|hspace)", s):
                out.append(("text", ""))
            elif re.match(r"\\[%$&#_{}]$", s):
                out.append(("text", s[1:]))
            else:
                out.append(("text", (" " if s[:1] == "~" else "") + " ".join(args)))
        elif role == "note":
            out.append(("text", ""))
        else:
            out.append(("mark", ""))
    return _lines_of_items(out)


def _lines_of_items(parts: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Items and quotes with the rest of their line in them."""
    out: list[tuple[str, str]] = []
    held: tuple[str, str] | None = None
    for role, s in parts:
        if held is not None:
            if role in ("text", "code", "formula") and not (role == "code" and "\n" in s):
                head, nl, rest = s.partition("\n")
                held = (held[0], held[1] + head)
                if not nl:
                    continue
                out.append(held)
                held, s = None, nl + rest
            elif role == "mark":
                continue
            else:
                out.append(held)
                held = None
        if role in ("item", "quote"):
            held = (role, s)
        else:
            out.append((role, s))
    return out + ([held] if held is not None else [])


def join_parts(parts: list[tuple[str, str]]) -> str:
    """One clean text: headings on lines of their own, items after a bullet, code lines indented."""
    out: list[str] = []
    for role, s in parts:
        if role == "heading":
            out.append(f"\n\n{s}\n\n")
        elif role == "item":
            out.append(f"\n• {s}")
        elif role == "quote":
            out.append(f"\n{s}")
        elif role == "code" and "\n" in s:
            out.append("\n" + "\n".join("    " + x for x in s.split("\n")) + "\n")
        elif role == "row":
            out.append(f"\n{s}" if s else "")
        elif role in ("text", "code", "formula"):
            out.append(s)
    text = re.sub(r"[ \t]+\n", "\n", "".join(out))
    text = re.sub(r"\n\n(?=• )(?<=[^\n]\n\n)", "\n", text) if "\n• " in text and text.count("\n• ") > 1 else text
    return re.sub(r"\n{3,}", "\n\n", text).strip()


#: What goes when only words are wanted: marks, addresses and attributes.
_STRIP = re.compile(
    rf"<!--.*?-->|</?{_TAG}{_ATTR}\s*/?>|&(?:\#?\w{{1,31}});|\]\((?:[^()\n]|\([^()\n]*\))*\)(?:\{{[^}}\n]*\}})?|\]\[[^\[\]\n]*\]|(?<=\])\{{[^}}\n]*\}}|^[ ]{{0,3}}\[[^\]\n]+\]:[ \t]*\S+[^\n]*$"
    r"|\[-?@[^\]\n]*\]|\[\^[^\]\s]+\]:?|\[(?:https?:)?//\S+|\[\[(?:[^\[\]|\n]*\|)+|\{\{[^{}|\n]*\||\\(?:begin|end|label|ref|cite|eqref)\{[^}\n]*\}|\\[A-Za-z]+\*?|^[ ]{0,3}(?:`{3,}|~{3,})[^\n]*$|^[ \t]{0,3}:{3,}[^\n]*$",
    re.M | re.S,
)


def bare(text: str) -> str:
    """The text without marks, addresses and attributes, for comparing words."""
    if not any(c in text for c in "<&[{\\`~:*_"):
        return text
    return _STRIP.sub(" ", text)
