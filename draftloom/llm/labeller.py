"""A recurrent block labeller: a bidirectional LSTM in numpy over leaf sequences.

Each leaf is read as its kind, its whole tag path, its first and last words,
the mean of all hashed words in it and a few signs of shape; the labeller gives it a family of notation or 'none', using
the document to both sides. It is trained here, on texts made by a grammar of
the notations and of signs that are meant literally, with random words; the
number of training texts is a documented parameter.
"""

from __future__ import annotations

import hashlib
import inspect
import random
import re
import sys
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from draftloom.llm import markup
from draftloom.llm.markup import FAMILIES, KIND_NO, KINDS, Leaf
from draftloom.session import shared_dir, spread
from draftloom.sources.jsonl import read_json, write_json

SHAPES, WORDS_, PATHS = 13, 512, 64
SIZE = {"kind": 12, "path": 6, "word": 8}
D = SIZE["kind"] + SIZE["path"] + 2 * SIZE["word"] + SHAPES
H = 20
#: Of each kind, the families it may be given.
ALLOWED = np.zeros((len(KINDS), len(FAMILIES)), dtype=np.float32)
for _k, (_, _fams) in KINDS.items():
    ALLOWED[KIND_NO[_k], [0, *[FAMILIES.index(f) for f in _fams]]] = 1.0

_TOKEN = re.compile(r"\w+")


class _Buckets(dict):
    """Word -> its number in the table of vectors; any run of digits is one word."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        n = self[word] = zlib.crc32((word.lower() if not word.isdigit() else "0").encode()) % WORDS_ + 1
        return n


_BUCKET = _Buckets()
_DIGIT = re.compile(r"\d")


class Features(NamedTuple):
    """Of the leaves of a text: integers (kind, path, four words), signs of shape, and all words, with how many each leaf has."""

    ints: np.ndarray
    shape: np.ndarray
    words: np.ndarray
    counts: np.ndarray

    def __len__(self) -> int:
        return len(self.ints)


def features(text: str, leaves: list[Leaf]) -> Features:
    ints = np.zeros((len(leaves), 6), dtype=np.int32)
    shape = np.zeros((len(leaves), SHAPES), dtype=np.float32)
    n = len(text)
    every: list[int] = []
    counts = []
    for i, leaf in enumerate(leaves):
        kind, s, e, path = leaf
        before, after = text[s - 1 : s], text[e : e + 1]
        body = text[s:e]
        words = [_BUCKET[w] for w in _TOKEN.findall(body)]
        every += words
        counts.append(len(words))
        some = words[:2] + words[-2:] if kind in ("text", "code") else words[:4]
        ints[i, 0] = KIND_NO[kind]
        ints[i, 1] = (path + ord(markup._block(text, s) or "\n")) % PATHS
        ints[i, 2 : 2 + len(some)] = some
        shape[i] = (
            before in ("", "\n"), before.isspace(), before.isalnum(), after in ("", "\n"), after.isspace(), after.isdigit(),
            body[1:2].isdigit(), _DIGIT.search(body) is not None, " " in body, e - s > 20, body.isupper(), s == 0 or e == n, body.endswith(("}", ">", ")", "]")),
        )
    return Features(ints, shape, np.array(every, np.int32), np.array(counts, np.int64))


class Packed:
    """The integers [t, n, 6] of a batch, and the words of its leaves in a row, each leaf at its place of t x n."""

    def __init__(self, ints: np.ndarray, words: np.ndarray, place: np.ndarray, counts: np.ndarray):
        some = counts > 0
        self.ints, self.words, self.place, self.counts = ints, words, place[some], counts[some]
        self.starts = np.concatenate([[0], np.cumsum(self.counts)[:-1]]).astype(np.int64) if some.any() else np.zeros(0, np.int64)

    def __getitem__(self, key):
        return self.ints[key]

    def means(self, table: np.ndarray) -> np.ndarray:
        out = np.zeros((self.ints.shape[0] * self.ints.shape[1], table.shape[1]), table.dtype)
        if len(self.words):
            out[self.place] = np.add.reduceat(table[self.words], self.starts, axis=0) / self.counts[:, None].astype(table.dtype)
        return out.reshape(*self.ints.shape[:2], -1)

    def spread(self, grads: np.ndarray, into: np.ndarray) -> None:
        """The gradient of the means, added to the table's."""
        if len(self.words):
            each = grads.reshape(-1, grads.shape[-1])[self.place] / self.counts[:, None]
            np.add.at(into, self.words, np.repeat(each, self.counts, axis=0))


class Labeller:
    """Weights and the forward and backward pass."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        g = lambda *s: (r.standard_normal(s) * (0.5 / np.sqrt(s[-2] if len(s) > 1 else 1))).astype(np.float32)
        self.p = {
            "ek": g(len(KINDS), SIZE["kind"]) * 2, "ep": g(PATHS, SIZE["path"]), "ew": g(WORDS_ + 1, SIZE["word"]),
            "wf": g(D + H, 4 * H), "wb": g(D + H, 4 * H), "bf": np.zeros(4 * H, np.float32), "bb": np.zeros(4 * H, np.float32),
            "wo": g(2 * H, len(FAMILIES)), "bo": np.zeros(len(FAMILIES), np.float32),
        }
        for b in ("bf", "bb"):
            self.p[b][H : 2 * H] = 1.0

    def embed(self, ints: Packed, shape: np.ndarray) -> np.ndarray:
        w = ints[..., 2:]
        some = (w > 0)[..., None]
        words = (self.p["ew"][w] * some).sum(-2) / np.maximum(some.sum(-2), 1)
        return np.concatenate([self.p["ek"][ints[..., 0]], self.p["ep"][ints[..., 1]], words, ints.means(self.p["ew"]), shape], -1)

    def _run(self, x: np.ndarray, mask: np.ndarray, w: np.ndarray, b: np.ndarray, keep: list | None = None) -> np.ndarray:
        t, n, _ = x.shape
        xw = (x.reshape(t * n, D) @ w[:D] + b).reshape(t, n, 4 * H)
        h = c = np.zeros((n, H), np.float32)
        out = np.zeros((t, n, H), np.float32)
        wh = w[D:]
        for k in range(t):
            z = xw[k] + h @ wh
            s = 1.0 / (1.0 + np.exp(-z[:, : 3 * H]))
            g = np.tanh(z[:, 3 * H :])
            i, f, o = s[:, :H], s[:, H : 2 * H], s[:, 2 * H :]
            m = mask[k][:, None]
            c2 = f * c + i * g
            tc = np.tanh(c2)
            h2 = o * tc
            if keep is not None:
                keep.append((i, f, o, g, c, tc, h, m))
            c, h = c2 * m + c * (1 - m), h2 * m + h * (1 - m)
            out[k] = h
        return out

    def forward(self, ints: Packed, shape: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Log-probabilities [t, n, family]; both passes see the padding as absent."""
        x = self.embed(ints, shape)
        kf, kb = ([], []) if keep is not None else (None, None)
        f = self._run(x, mask, self.p["wf"], self.p["bf"], kf)
        b = self._run(x[::-1], mask[::-1], self.p["wb"], self.p["bb"], kb)[::-1]
        h = np.concatenate([f, b], -1)
        z = h @ self.p["wo"] + self.p["bo"]
        z = np.where(ALLOWED[ints[..., 0]] > 0, z, -30.0)
        z = z - z.max(-1, keepdims=True)
        logp = z - np.log(np.exp(z).sum(-1, keepdims=True))
        if keep is not None:
            keep.update(x=x, h=h, kf=kf, kb=kb)
        return logp

    def _back(self, x: np.ndarray, dout: np.ndarray, kept: list, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        t, n, _ = x.shape
        dw, db, dx = np.zeros_like(w), np.zeros(4 * H, np.float32), np.zeros_like(x)
        dh = dc = np.zeros((n, H), np.float32)
        for k in range(t - 1, -1, -1):
            i, f, o, g, c, tc, h, m = kept[k]
            dhk = dh + dout[k]
            dh2, dcs = dhk * m, dc * m
            dc2 = dcs + dh2 * o * (1 - tc * tc)
            dz = np.concatenate([dc2 * g * i * (1 - i), dc2 * c * f * (1 - f), dh2 * tc * o * (1 - o), dc2 * i * (1 - g * g)], -1)
            dw[:D] += x[k].T @ dz
            dw[D:] += h.T @ dz
            db += dz.sum(0)
            dx[k] = dz @ w[:D].T
            dh = dz @ w[D:].T + dhk * (1 - m)
            dc = dc2 * f + dc * (1 - m)
        return dw, db, dx

    def gradients(self, ints: Packed, shape: np.ndarray, mask: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        keep: dict = {}
        logp = self.forward(ints, shape, mask, keep)
        total = max(mask.sum(), 1.0)
        hot = np.eye(len(FAMILIES), dtype=np.float32)[gold]
        loss = float(-(logp * hot).sum(-1).ravel() @ mask.ravel() / total)
        dz = (np.exp(logp) - hot) * mask[..., None] / total
        dz = np.where(ALLOWED[ints[..., 0]] > 0, dz, 0.0).astype(np.float32)
        h, x = keep["h"], keep["x"]
        g = {"wo": np.einsum("tnh,tnc->hc", h, dz), "bo": dz.sum((0, 1))}
        dh = dz @ self.p["wo"].T
        g["wf"], g["bf"], dx = self._back(x, dh[..., :H], keep["kf"], self.p["wf"])
        g["wb"], g["bb"], dxb = self._back(x[::-1], dh[::-1, :, H:], keep["kb"], self.p["wb"])
        dx = dx + dxb[::-1]
        a, b = SIZE["kind"], SIZE["kind"] + SIZE["path"]
        for name, col, part in (("ek", ints[..., 0], dx[..., :a]), ("ep", ints[..., 1], dx[..., a:b])):
            g[name] = np.zeros_like(self.p[name])
            np.add.at(g[name], col.ravel(), part.reshape(-1, part.shape[-1]))
        w = ints[..., 2:]
        n = np.maximum((w > 0).sum(-1, keepdims=True), 1)
        dw = dx[..., b : b + SIZE["word"]] / n
        g["ew"] = np.zeros_like(self.p["ew"])
        for k in range(w.shape[-1]):
            np.add.at(g["ew"], w[..., k].ravel(), (dw * (w[..., k : k + 1] > 0)).reshape(-1, SIZE["word"]))
        ints.spread(dx[..., b + SIZE["word"] : b + 2 * SIZE["word"]], g["ew"])
        return loss, g

    def label(self, texts: list[str], scanned: list[list[Leaf]], batch: int = 256) -> list[list[str]]:
        """The family of each leaf of each text."""
        order = sorted((i for i, x in enumerate(scanned) if x), key=lambda i: len(scanned[i]))
        out: list[list[str]] = [[] for _ in texts]
        at = 0
        while at < len(order):
            longest = len(scanned[order[min(at + batch, len(order)) - 1]])
            step = batch if longest <= 64 else max(1, min(batch, 16384 // longest))
            rows = order[at : at + step]
            at += step
            ints, shape, mask = pack([features(texts[i], scanned[i]) for i in rows])
            best = self.forward(ints, shape, mask).argmax(-1)
            for n, i in enumerate(rows):
                out[i] = [FAMILIES[k] for k in best[: len(scanned[i]), n]]
        return out


def pack(rows: list[Features]) -> tuple[Packed, np.ndarray, np.ndarray]:
    t = max(map(len, rows))
    ints, shape, mask = np.zeros((t, len(rows), 6), np.int32), np.zeros((t, len(rows), SHAPES), np.float32), np.zeros((t, len(rows)), np.float32)
    for n, f in enumerate(rows):
        ints[: len(f), n], shape[: len(f), n], mask[: len(f), n] = f.ints, f.shape, 1.0
    place = np.concatenate([np.arange(len(f)) * len(rows) + n for n, f in enumerate(rows)])
    return Packed(ints, np.concatenate([f.words for f in rows]), place, np.concatenate([f.counts for f in rows])), shape, mask


# --- training texts --------------------------------------------------------
class Grammar:
    """Random texts with the family of every notation in them."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        parts = [a + b for a in "b d f g h k l m n p r s t v z br st tr".split() for b in "a e i o u ar en il on us".split()]
        self.words = ["".join(self.r.choices(parts, k=self.r.choice([1, 2, 2, 3]))) for _ in range(3000)]
        self.small = "the a of and to in is was it for on as with at by from that this we they not no or but de la le et der die und el y o".split()

    def w(self) -> str:
        x = self.r.choice(self.small) if self.r.random() < 0.4 else self.r.choice(self.words)
        return x

    def phrase(self, a: int = 1, b: int = 4) -> str:
        if a == 1 and self.r.random() < 0.06:
            return self.r.choice("abcdefghijklmnopqrstuvwxyz")
        return " ".join(self.r.choice(self.words) for _ in range(self.r.randint(a, b)))

    def sentence(self) -> list[str]:
        x = [self.w() for _ in range(self.r.randint(5, 16))]
        x[0] = x[0].capitalize()
        x[-1] += self.r.choice(".....!?")
        return x

    def inline(self) -> tuple[str, str]:
        r, p, n = self.r, self.phrase, self.r.randint(1, 999)
        k = r.randrange(4)
        if k == 0:
            t = r.choice("b i u em strong code span sub small kbd a".split())
            t = t.upper() if r.random() < 0.2 else t
            return "html", r.choice([f"<{t}>{p()}</{t}>", f'<a href="https://{p(1, 1)}.org/{n}">{p()}</a>', f"<span class='{p(1, 1)}'>{p()}</span>", f"<!-- {p()} -->", "<br>", "<br/>", "&nbsp;", "&amp;", f"&ldquo;{p()}&rdquo;", f"&#{n + 160};", f'<img src="{p(1, 1)}.png" alt="{p()}">', f'<SPAN STYLE="color:red">{p()}</SPAN>'])
        if k == 1:
            x = p(1, 3)
            return "markdown", r.choice([f"*{x}*", f"_{x}_", f"**{x}**", f"__{x}__", f"~~{x}~~", f"`{x}`", f"[{x}](./{p(1, 1)}.md)", f'[{x}](<./{p(1, 1)}/> "{p(1, 1)}")', f"![{x}](img/{p(1, 1)}.png)", f"[{x}][{r.choice(['ref', 'r', 'note'])}{n}]", f"[{x}][]", f"[{x}]{{.{p(1, 1)}}}", f"[@{p(1, 1)}{1900 + n % 130}]", f"[see @{p(1, 1)}{1990 + n % 40}, p. {n}]", f"^[{x}]", f"[^{n % 9 + 1}]", f"<https://{p(1, 1)}.org>"])
        if k == 2:
            x = p(1, 2)
            return "wiki", r.choice([f"[[{x}]]", f"[[{x.title()}|{p()}]]", f"[[File:{p(1, 1)}.png|thumb|{x}]]", f"[[Category:{x}]]", f"'''{x}'''", f"''{x}''", f"{{{{{p(1, 1)}|{x}}}}}", f"{{{{citation needed|date={p(1, 1)}}}}}", f"[https://{p(1, 1)}.org/w {x}]", f"{{{{Infobox|name={x}|size={n}}}}}", self.template()])
        x = p(1, 2)
        return "latex", r.choice([f"\\emph{{{x}}}", f"\\textbf{{{x}}}", f"\\cite{{{p(1, 1)}}}", f"\\ref{{sec:{p(1, 1)}}}", f"~\\cite{{{p(1, 1)}}}", f"\\footnote{{{x}}}", f"$x_{{{n}}}$", f"$\\alpha = {n}$", f"$k={n}$", f"$a + b$", f"$n$", f"$x^2$", f"$f(x) = {n}x$", f"\\(x_i + {n}\\)", f"na\\\"{{\\i}}ve", "caf\\'e", f"\\texttt{{{x}}}", "\\LaTeX", "\\ldots", "100\\%", f"\\href{{https://x.org}}{{{x}}}", self.sum()])

    def sum(self) -> str:
        """A formula of any length."""
        return "$" + " + ".join(f"{self.r.choice('abcxyz')}_{{{i}}} {self.r.choice(['x', 't', 'n'])}^{i}" for i in range(self.r.choice([2, 6, 30, 90]))) + "$"

    def template(self) -> str:
        """A template of any length, with others in it."""
        inner = self.r.choice([f"{{{{{self.phrase(1, 1)}|{self.phrase()}}}}}", f"[[{self.phrase()}]]", self.phrase(1, 60)])
        return "{{" + self.phrase(1, 1).capitalize() + "".join(f"\n| {self.phrase(1, 1)} = {x}" for x in (inner, *[self.phrase(1, 9) for _ in range(self.r.choice([1, 3, 30]))])) + self.r.choice(["", "\n"]) + "}}"

    def literal(self) -> str:
        r, p, n, m = self.r, self.phrase, self.r.randint(1, 999), self.r.randint(1, 99)
        return r.choice([
            f"costs ${n} to ${m} per {p(1, 1)}.", f"fell from ${n} to ${m}.", f"paid ${n}.50 and ${m} for it", f"between ${n}k and ${m}k", f"{n} < {m} and {m} > 3", f"{p(1, 1)} < {n} and y > {m}", f"{n} * {m} {p(1, 1)} and 2 * {m}", f"a star* come from", f"count(*)", f"{n} -> {m} -> {n}",
            f"{p(1, 1)} <- {n}", f"~{n} {p(1, 1)}", f"{n}% more -- or {m}% less --", f"x^{n} where x_{m} was meant", f"a == b == c", "wrote [sic] after", "and [...] before", f"the call a[{n}][{m}] reads", f"{p(1, 1)}[{n}][{m}]", f"[{n}, {m}]", f"m[i][j] and a[0]",
            f"the set {{{n}, {m}}} was", f"C:\\temp\\{p(1, 1)}{n} holds", f"D:\\{p(1, 1)}\\{p(1, 1)}", f"the path C:\\{p(1, 1)}\\runs{n}", "the R&D team", "AT&T and Q&A", f"ticket #{n}", f"{n}/{m} (or {n}:{m})", f"{p(1, 1)}_{p(1, 1)}_{p(1, 1)}", "*.txt and *.csv", "~/data and ~/bin",
            f"{p(1, 1)}@{p(1, 1)}.org", f"vector<int> or List<T>", f"<{n} or >{m}", f"x > {n} & y < {m}", f"{n} | {m}", f"5 * x * {n}", f"i <= {n} && j >= {m}", f"a^b^c", f"pay $5, then $10, then ${n}", f"US$ {n} or $ {m}", f"f(a*b, c*d)", "2 * x * y", f"* {n} *",
            f"paid ${n} {p(10, 90)} and ${m} {p(1, 9)}", f"${n} {p(10, 90)} for ${m}.", f"where {n} < {p(12, 30)} and {m} > 2", f"[{p(8, 20)}]", f"({n} [of {m}] {p(9, 30)} [{n}])",
        ])

    def code(self) -> str:
        p, n = self.phrase, self.r.randint(1, 99)
        return self.r.choice([f"for i in range({n}):\n    {p(1, 1)}[i] = '[[{p(1, 1)}]]'", f"def {p(1, 1)}(x):\n    return x * {n}  # **not bold**", f"<div>{p(1, 1)}</div>\n<p>&amp;</p>", f'echo "${p(1, 1)}" | sort -n\n# {p(1, 1)}', f"SELECT {p(1, 1)}, count(*)\nFROM {p(1, 1)}\n\nGROUP BY 1", f"{p(1, 1)} <- {n}", f"x_{n} = f({n})  # $5"])

    def block(self) -> tuple[str, str]:
        r, p, n = self.r, self.phrase, self.r.randint(1, 9)
        k = r.randrange(10)
        if k < 4:
            b = r.choice(["- ", "* ", "+ "])
            return "markdown", r.choice([
                f"{'#' * r.randint(1, 6)} {p()}", f"{p(1, 3).capitalize()}\n{r.choice('-=') * r.randint(4, 14)}", "\n".join(f"{b}{p()}" for _ in range(3)), f"{b}{p()}\n    {b}{p()}\n{b}{p()}", f"{b}[x] {p()}\n{b}[ ] {p()}", "\n".join(f"{i}. {p()}" for i in range(1, 4)),
                f"> {p(3, 8)}.", f"> {p(3, 8)}\n> {p(3, 6)}.", f"| {p()} | {p()} |\n|---|:-:|\n| {n} | {p()} |", f"::: {{.callout-note}}\n{p(3, 6)}.\n:::", f"[ref{n}]: ./{p(1, 1)}.md", f"[^{n}]: {p(3, 6)}.", f"```{r.choice(['', 'python', 'sh', 'sql'])}\n{self.code()}\n```", f"~~~{r.choice(['', 'r'])}\n{self.code()}\n~~~", "* * *", "---",
            ])
        if k < 6:
            return "html", r.choice([f"<ul>\n<li>{p()}</li>\n<li>{p()}</li>\n</ul>", f"<table><tr><th>{p()}</th></tr><tr><td>{p()}</td></tr></table>", f"<h{n % 6 + 1}>{p()}</h{n % 6 + 1}>", f"<pre><code>{self.code()}</code></pre>", f"<script>var {p(1, 1)} = {n};</script>", f"<style>.{p(1, 1)} {{ color: red }}</style>", f"<P>{p(3, 6)}.<P>", f'<div class="note">{p()}<br>{p()}</div>', f"<blockquote>{p()}</blockquote>"])
        if k < 8:
            return "wiki", r.choice([f"{'=' * r.randint(2, 4)} {p()} ==", f"== {p()} ==", f"=== {p()} ===", f'{{| class="wikitable"\n! {p()} !! {p()}\n|-\n| {n} || {p()}\n|}}', f"; {p(1, 2)}: {p()}", f";{p(1, 2)}\n:{p(2, 4)}", f": {p(2, 5)}", f"[[Category:{p()}]]", f"{{{{Infobox|name={p()}|size={n}}}}}", self.template()])
        return "latex", r.choice([f"\\section{{{p()}}}", f"\\subsection*{{{p()}}}", f"\\begin{{itemize}}\n\\item {p()}\n\\item {p()}\n\\end{{itemize}}", f"\\begin{{equation}}\nx^2 = {n} x + 1 \\label{{eq:{p(1, 1)}}}\n\\end{{equation}}", f"$$\n\\sum_{{i=1}}^{{{n}}} x_i = \\frac{{1}}{{{n}}}\n$$", f"\\[ \\int_0^{n} x^2 \\, dx \\]", f"\\begin{{verbatim}}\n{self.code()}\n\\end{{verbatim}}", f"$$ a + b = {n} $$"])

    def text(self) -> tuple[str, list[tuple[int, int, str]]]:
        """A text and the (start, end, family) of what is in it."""
        r, out, spans = self.r, "", []
        for _ in range(r.randint(1, 7)):
            if out:
                out += "\n\n"
            if r.random() < 0.35:
                fam, s = self.block()
                if fam == "wiki" and s.startswith("=") and s.rstrip("=")[-1:] and len(s) - len(s.lstrip("=")) != len(s) - len(s.rstrip("=")):
                    continue
                spans.append((len(out), len(out) + len(s), fam))
                out += s
                continue
            if r.random() < 0.1:  # notations close to one another
                for k in range(r.randint(2, 5)):
                    fam, s = self.inline() if r.random() < 0.8 else ("none", self.literal())
                    out += r.choice([" ", " and ", ", ", f" {self.w()} "]) if k else ""
                    spans.append((len(out), len(out) + len(s), fam))
                    out += s
                continue
            for _ in range(r.randint(1, 3)):
                words = self.sentence()
                at = r.randrange(1, len(words))
                for i, x in enumerate(words):
                    if i == at and r.random() < 0.45:
                        glue = r.random() < 0.08
                        if r.random() < 0.5:
                            fam, s = self.inline()
                        else:
                            fam, s = "none", self.literal()
                        if glue and fam != "none" and s[0] in "~^{&<\\":
                            out = out.rstrip(" ")
                        spans.append((len(out), len(out) + len(s), fam))
                        out += s + " "
                    out += x + (" " if i < len(words) - 1 else "")
                out += " "
            out = out.rstrip(" ")
        if r.random() < 0.3:  # lines broken within paragraphs and notations, where the next word is plain
            out = re.sub(r"(?<=[a-z]) (?=[a-z]{2})", lambda m: "\n" if r.random() < 0.1 and not out.rfind("\n", 0, m.start()) < 0 and out[out.rfind("\n", 0, m.start()) + 1 : m.start()][:1].isalpha() else " ", out)
        return out, spans


def training_rows(n: int, seed: int) -> list[tuple[Features, np.ndarray, str]]:
    g, rows = Grammar(seed), []
    while len(rows) < n:
        text, spans = g.text()
        leaves = markup.scan(text)
        if not leaves:
            continue
        gold = np.zeros(len(leaves), np.int64)
        for i, leaf in enumerate(leaves):
            if leaf.kind in ("text", "code"):
                continue
            fam = next((f for s, e, f in spans if s <= leaf.start < e or leaf.start < s < leaf.end), "none")
            k = FAMILIES.index(fam)
            gold[i] = k if ALLOWED[KIND_NO[leaf.kind], k] else 0
        rows.append((features(text, leaves), gold, text))
    return rows


def train(texts: int = 3200, epochs: int = 6, batch: int = 32, rate: float = 0.02, seed: int = 7) -> Labeller:
    """Adam on ``texts`` generated texts (at most so many; the bound of the sample). The same arguments give the same weights."""
    rows = training_rows(texts, seed)
    rows.sort(key=lambda r: len(r[1]))
    net, r = Labeller(seed), random.Random(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    batches = [rows[i : i + batch] for i in range(0, len(rows), batch)]
    step = 0
    for epoch in range(epochs):
        r.shuffle(batches)
        for b in batches:
            ints, shape, mask = pack([x[0] for x in b])
            gold = np.zeros(mask.shape, np.int64)
            for n, x in enumerate(b):
                gold[: len(x[1]), n] = x[1]
            _, g = net.gradients(ints, shape, mask, gold)
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            step += 1
            lr = rate * (0.5**epoch) * min(1.0, step / 20)
            for k, x in g.items():
                x = x * min(1.0, 2.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.99 * v[k] + 0.01 * x * x
                net.p[k] -= (lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


_TRAINED: list[Labeller] = []


def trained(spark: SparkSession | None = None) -> Labeller:
    """The labeller with its production parameters, trained once.

    With a session the weights are kept in the shared folder, under a name made
    of the training parameters and of this module, so that other processes
    read them instead of training again.
    """
    if not _TRAINED:
        at = None
        if spark is not None:
            told = "".join(inspect.getsource(m) for m in (sys.modules[__name__], markup)) + repr(train.__defaults__)
            at = f"{shared_dir(spark).rstrip('/')}/labeller-{hashlib.sha256(told.encode()).hexdigest()[:16]}.json"
        net = _stored(spark, at) if at else None
        if net is None:
            net = train()
            if at:
                write_json(spark, at, {"schema_version": 1, "weights": {k: v.astype(float).ravel().tolist() for k, v in net.p.items()}})
        _TRAINED.append(net)
    return _TRAINED[0]


def _stored(spark: SparkSession, path: str) -> Labeller | None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return None
    try:
        weights = read_json(spark, path, 1)["weights"]
    except ValueError:  # written in part by a process that was lost
        return None
    net = Labeller(0)
    net.p = {k: np.array(weights[k], np.float32).reshape(v.shape) for k, v in net.p.items()}
    return net


# --- on tables -------------------------------------------------------------
def found_families(texts: list[str], net: Labeller) -> list[set[str]]:
    clean = [markup.unix(t) for t in texts]
    scanned = [markup.scan(t) for t in clean]
    return [set(f) - {"none"} for f in net.label(clean, scanned)]


def families(rows: DataFrame, id_col: str, texts: Column, net: Labeller | None = None) -> DataFrame:
    """(rec_id, family) once for every record and family of markup in an array of its texts.

    Null arrays and null, empty or plain texts give no row; rows that repeat an
    id are taken together; null ids are left out. Every text is read whole.
    """
    net = net or trained(rows.sparkSession)

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            number: dict[str, int] = {}  # a text that repeats in the batch is read once
            use: list[tuple[int, int]] = []
            for i, ts in zip(b["i"], b["ts"]):
                for t in ts if ts is not None else ():
                    if t:
                        use.append((i, number.setdefault(t, len(number))))
            got = found_families(list(number), net)
            out = {(i, f) for i, k in use for f in got[k]}
            yield pd.DataFrame(sorted(out), columns=["rec_id", "family"])

    src = rows.select(F.col(id_col).cast("bigint").alias("i"), texts.alias("ts")).filter("i is not null and ts is not null")
    return spread(src).mapInPandas(look, "rec_id bigint, family string").distinct()


def cleaned(rows: DataFrame, id_col: str, field: Column, text: Column, net: Labeller | None = None) -> DataFrame:
    """(rec_id, field, families, clean, blocks array<struct<role,text>>) of every row with a text.

    Headings, list items, quotes, table rows, code and formulas keep their role
    in ``blocks`` and their place in ``clean``. A null text stays null, with no
    blocks; a plain one is one block of role text.
    """
    net = net or trained(rows.sparkSession)
    schema = "rec_id bigint, field string, families array<string>, clean string, blocks array<struct<role:string,text:string>>"

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [markup.unix(t) if t is not None else "" for t in b["t"]]
            scanned = [markup.scan(t) for t in texts]
            labels = net.label(texts, scanned)
            rows = []
            for i, f, raw, t, leaves, fams in zip(b["i"], b["f"], b["t"], texts, scanned, labels):
                parts = markup.rewrite(t, leaves, fams) if leaves else [("text", t)] if t else []
                blocks = [{"role": r, "text": s} for r, s in parts if r != "mark" and s.strip()]
                rows.append((i, f, sorted(set(fams) - {"none"}), markup.join_parts(parts) if raw is not None else None, blocks))
            yield pd.DataFrame(rows, columns=["rec_id", "field", "families", "clean", "blocks"])

    return rows.select(F.col(id_col).cast("bigint").alias("i"), field.alias("f"), text.alias("t")).mapInPandas(look, schema)
