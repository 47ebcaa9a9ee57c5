"""Markup, defects and wrong encodings on small cases, round trips and held-out texts."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from draftloom.llm import defects, labeller, markup, mojibake


@pytest.fixture(scope="module")
def net():
    return labeller.trained()


# --- markup -----------------------------------------------------------------
FOUND = [
    ("plain words, nothing else.", set()), ("", set()),
    ("a *word* here", {"markdown"}), ("# Title\n\ntext", {"markdown"}), ("Title\n-----\n\ntext", {"markdown"}), ("- a\n- b", {"markdown"}), ("1. a\n2. b", {"markdown"}), ("> quoted", {"markdown"}), ("see [x](./y.md)", {"markdown"}), ("![x](a.png)", {"markdown"}),
    ("```\n<b>x</b> [[y]] $z$\n```", {"markdown"}), ("| a | b |\n|---|---|\n| 1 | 2 |", {"markdown"}), ("::: {.note}\nx\n:::", {"markdown"}), ("as said [@lee1999]", {"markdown"}), ("word^[a note] more", {"markdown"}), ("a [b]{.c} d", {"markdown"}), ("a `b` c", {"markdown"}), ("See [the x][ref1] first.\n\n[ref1]: ./a.md", {"markdown"}),
    ("a <b>bold</b> c", {"html"}), ("a &amp; b", {"html"}), ("x <!-- y --> z", {"html"}), ("<pre><code>*x* [[y]]</code></pre>", {"html"}), ("<ul>\n<li>a</li>\n</ul>", {"html"}),
    ("a [[link|text]] b", {"wiki"}), ("== Head ==", {"wiki"}), ("a '''b''' c", {"wiki"}), ("a {{term|b}} c", {"wiki"}), ('{| class="w"\n! a !! b\n|-\n| 1 || 2\n|}', {"wiki"}), ("see [https://x.example/a here]", {"wiki"}),
    ("a \\emph{b} c", {"latex"}), ("\\begin{verbatim}\n*x* <b>\n\\end{verbatim}", {"latex"}), ("so $x_1 = 3$ holds", {"latex"}), ("$$\na+b\n$$", {"latex"}), ("\\section{One}", {"latex"}), ("a \\(x\\) b", {"latex"}),
    ("*a* and <b>b</b> and [[c]] and \\emph{d}", {"markdown", "html", "wiki", "latex"}),
    ("costs $5 to $7 per run.", set()), ("if x < 3 and y > 4 then", set()), ("wrote [sic] and [...] there", set()), ("2 * 3 folds and 2 * 24 seeds", set()), ("the path C:\\temp\\runs4 holds", set()), ("call a[1][2] twice", set()), ("a == b == c here", set()), ("the R&D team", set()), ("a star* come", set()), ("it went 5 -> 6 -> 5", set()),
]


@pytest.mark.parametrize("text,want", FOUND)
def test_families(net, text, want):
    assert labeller.found_families([text], net)[0] == want


def test_held_out_accuracy(net):
    ok = n = 0
    for feats, gold, _ in labeller.training_rows(300, seed=12345):
        ints, shape, mask = labeller.pack([feats])
        best = net.forward(ints, shape, mask).argmax(-1)[:, 0]
        ok, n = ok + int((best == gold).sum()), n + len(gold)
    assert ok / n > 0.99


def test_gradients_are_right():
    rows = labeller.training_rows(3, seed=1)
    net = labeller.Labeller(3)
    ints, shape, mask = labeller.pack([r[0] for r in rows])
    import numpy as np

    gold = np.zeros(mask.shape, np.int64)
    for n, r in enumerate(rows):
        gold[: len(r[1]), n] = r[1]
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    _, g = net.gradients(ints, shape, mask, gold)
    for name in ("wf", "wb", "wo", "ek", "ew"):
        at = tuple(int(x) for x in np.unravel_index(np.abs(g[name]).argmax(), g[name].shape))
        old, eps = net.p[name][at], 1e-3
        net.p[name][at] = old + eps
        up = net.gradients(ints, shape, mask, gold)[0]
        net.p[name][at] = old - eps
        down = net.gradients(ints, shape, mask, gold)[0]
        net.p[name][at] = old
        assert abs((up - down) / (2 * eps) - g[name][at]) < 2e-2 * max(0.05, abs(g[name][at]))


def test_scan_covers_text():
    for text, _ in FOUND:
        leaves = markup.scan(text)
        assert not leaves or (leaves[0].start == 0 and leaves[-1].end == len(text) and all(a.end == b.start for a, b in zip(leaves, leaves[1:])))


def test_clean_and_tables(spark, net):
    t = "# Head *x*\n\n- one\n- two\n\nso $a+b$ and <b>c</b> &amp; d\n\n```py\nx = 1\ny\n```\n"
    df = spark.createDataFrame([(1, t, 9), (1, t, 9), (2, None, 9), (3, "", 9), (4, "plain", 9), (None, "*x*", 9)], "id bigint, text string, family int")
    got = {r.rec_id: r for r in labeller.cleaned(df.dropDuplicates(), "id", F.lit("text"), F.col("text"), net).collect()}
    assert got[1].families == ["html", "latex", "markdown"]
    assert {"heading", "item", "code", "formula"} <= {b.role for b in got[1].blocks}
    assert "• one\n• two" in got[1].clean and "so a+b and c & d" in got[1].clean and "    x = 1" in got[1].clean
    assert got[2].clean is None and got[3].clean == "" and got[4].clean == "plain" and got[2].blocks == []
    fam = sorted((r.rec_id, r.family) for r in labeller.families(df, "id", F.array("text"), net).collect())
    assert fam == [(1, "html"), (1, "latex"), (1, "markdown")]
    assert labeller.families(df.filter("false"), "id", F.array("text"), net).count() == 0


def test_long_text(net):
    assert labeller.found_families(["word *x* <b>y</b>\n\n" * 20000], net)[0] == {"markdown", "html"}


# --- defects ----------------------------------------------------------------
P = "The quiet harbour has a bad name at Lome, mostly earned by the lazy prior of the second draft and its many small errors that nobody minded at the time."


@pytest.mark.parametrize(
    "answer,want",
    [
        (None, "empty"), ("", "empty"), (" \u200b\n", "empty"), ("N/A", "empty"), ("—", "empty"), ('""', "empty"), ("none", "empty"), ("...", "empty"),
        ("I'm sorry, but I can't help with rewriting this passage.", "refusal"), ("As an AI system, I'd rather not edit the text.", "refusal"), ("Lo siento, no puedo ayudar con esta solicitud.", "refusal"), ("Je ne peux pas traiter cette demande.", "refusal"), ("Diese Anfrage kann ich leider nicht bearbeiten.", "refusal"), ("My guidelines prevent me from rewriting the passage.", "refusal"), ("I'm going to have to pass on this draft.", "refusal"), ("This is not something I'm comfortable rewriting.", "refusal"),
        (P, "copy"), ("Sure! Here's the text:\n\n" + P.upper(), "copy"), (P.replace("lazy", "idle"), "copy"), (P.replace(" ", "  ").replace(",", ""), "copy"),
        ("Der Hafen ist seit Wochen still und keiner hat es gemerkt, aber das ist nicht neu.", "language"),
        ("I believed the notes up to the folded trace and not one", "truncated"), ("It broke twice. The trick is to stop,", "truncated"), ("We tried.\n\n```py\nx = 1", "truncated"), ("It holds. A robust way of doing —", "truncated"),
        ("I cannot help but think the lattice is a red herring.", None), ('"I can\'t help with that," said the clerk at Soza, and pointed at the window.', None), ("I'm sorry to report that the frozen weight never converged.", None), ("I won't pretend that the stream can be rewritten in 697 minutes.", None),
        ("It broke twice.\n\n- one\n- two", None), ("It broke twice.\n\n## Next part", None), ("It broke twice.\n\n```\nx\n```", None), ("It broke twice.\n\n$$\nx\n$$", None), ("Fine.", None), ("She said “it is done.”", None), ("He wrote it down. (See the note.)", None), ("He quotes “der die das und ist nicht mit von” and went on with the rest of the work in the end.", None),
    ],
)
def test_defect(answer, want):
    assert defects.defect(P, answer) == want


def test_suffix_automaton_against_brute_force():
    a = "a b c a b d e a b c".split()
    sa = defects.SuffixAutomaton(a)
    for words in ("a b c", "x a b d y", "a b x c a", "e a b c", "z"):
        w = words.split()
        inside = set()
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if any(a[k : k + j - i] == w[i:j] for k in range(len(a))):
                    inside |= set(range(i, j))
        assert sa.covered(w, 2) == len(inside), words


def test_flag_table(spark):
    rows = [(1, P, None, None, "x"), (1, P, None, None, "x"), (2, None, "It is done.", None, "x"), (3, P, "## H\n\n", "## H", "x"), (None, P, None, None, "x")]
    df = spark.createDataFrame(rows, "pid bigint, p string, a string, c string, defect string")
    got = sorted(tuple(r) for r in defects.flag_defects(df, "pairs", "pid", F.col("p"), F.col("a"), F.col("c")).collect())
    assert got == [("pairs", 1, "empty"), ("pairs", 3, "empty")]
    assert defects.flag_defects(df.filter("false"), "pairs", "pid", F.col("p"), F.col("a"), F.col("c")).count() == 0


# --- encodings --------------------------------------------------------------
CLEAN = {
    "fr": "Conformément à la note rédigée, le château a été trouvé près de la forêt, où l'été dure.", "de": "Gemäß der Übersicht hätte jeder Prüfer größere Kübel für die Straße gewählt.", "pl": "Późną jesienią ogród znów się zepsuł, więc wziąłem łącznik i zbiór źródeł.",
    "ru": "Поздней осенью рынок снова сломался, и мы взяли колодец, чтобы понять ветер.", "en": "“Don’t touch the naïve café” — it’s 85 °C, a piñata and 5 € more…",
}


def worst(text):
    e = mojibake.evidence(text)
    return max(e.values(), default=0.0)


@pytest.mark.parametrize("lang", list(CLEAN))
@pytest.mark.parametrize("read", ["cp1252", "latin_1", "mac_roman", "cp437", "cp1251"])
def test_round_trip_utf8(lang, read):
    raw = CLEAN[lang].encode()
    table = {b: c for c, b in reversed(list(mojibake._bytes_of(read).items()))}
    seen = "".join(table[b] for b in raw)
    e = mojibake.evidence(seen)
    assert max(e.values()) >= 8
    assert mojibake.restore(seen, f"utf_8>{read}")[0] == CLEAN[lang]


@pytest.mark.parametrize("lang,was,read", [("pl", "iso8859_2", "cp1252"), ("ru", "cp1251", "cp1252"), ("ru", "koi8_r", "cp1251")])
def test_round_trip_single(lang, was, read):
    table = {b: c for c, b in reversed(list(mojibake._bytes_of(read).items()))}
    seen = "".join(table[b] for b in CLEAN[lang].encode(was))
    e = mojibake.evidence(seen)
    assert max(e, key=e.get) == mojibake.INDEX[f"{was}>{read}"] and max(e.values()) > 8
    assert mojibake.restore(seen, f"{was}>{read}")[0] == CLEAN[lang]


def test_double():
    once = CLEAN["fr"].encode().decode("latin_1")
    table = {b: c for c, b in reversed(list(mojibake._bytes_of("cp1252").items()))}
    seen = "".join(table[b] for b in "".join(table[b] for b in CLEAN["fr"].encode()).encode())
    assert once and mojibake.restore(seen, "utf_8>cp1252>utf_8>cp1252")[0] == CLEAN["fr"]


@pytest.mark.parametrize("text", [*CLEAN.values(), "ATENÇÃO: NÃO MEXA NO CORAÇÃO SEM AUTORIZAÇÃO.", "The ™ and the § are both fake; Ð is a letter.", "Grade Â beats grade Ô.", "you see things like `Ã©` where the accent was", "A classic sign is the sequence `â€™`, they say", "The room holds 148 m³ ± 40. ¿Really? ¡Yes!", "測試 ค้นหา שלום مرحبا 🙂 ﬁ ①②③", "市場と雑音のあいだに道がある。"])
def test_clean_texts_are_no_cases(text):
    assert worst(text) < 5


def test_garbled_table(spark):
    bad = "La note rÃ©digÃ©e Ã\xa0 Lome"
    rows = [(i, "clean text é" if i % 3 else bad, f"s{i % 2}", 7) for i in range(30)] + [(0, bad, "s0", 7), (100, None, None, 7), (101, "", "s0", 7), (102, "lost ��� chars", None, 7), (103, "é" * 100000, "s1", 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, chain int")
    got = {r.doc_id: r for r in mojibake.repaired(df).collect()}
    assert set(got) == {i for i in range(0, 30, 3)} | {102}
    assert got[0].text == "La note rédigée à Lome" and got[0].restored and not got[102].restored
    assert mojibake.garbled(df.filter("false")).count() == 0


LEFT_OPEN = [
    "It holds in every fold. We saw this as shown before (see Fig.", "The run went on. Then it **stopped for good.", "One.\n\n\\begin{align}\na\n\\end{align}\n\nTwo.\n\n\\end{align}\n\\begin{align}\nb + c = d and on.", "The notes say it plainly [as in the second fold.",
]
CLOSED = ["It holds (see Fig. 2).", "It is **so** here, and 2 ** 3 is eight.", "It lies in [0, 1) for all of them.", "a) first of all it holds.", "We call `f(x` here and it fails.", "Also „so“ it is said, in “quotes” now.", "```\nx = (1\n```"]


@pytest.mark.parametrize("text", LEFT_OPEN)
def test_left_open_is_truncated(text):
    assert defects.is_truncated(text)


@pytest.mark.parametrize("text", CLOSED)
def test_closed_is_not_truncated(text):
    assert not defects.is_truncated(text)


LONG = "Thank you for sharing your passage with me. I have read your request with care and I understand why you want it. Unfortunately, I can't help with rewriting this passage. The reasons are in the guidelines that I follow. If you like, I would be happy to look at another text instead. Please let me know what you would prefer."
LATE = "I'm sorry about this. I apologize for the trouble. I can't help with rewriting this passage."
PROSE = "The fold ran for nine hours. I cannot help but think of the seeds. The trace was cold and nobody had saved it. We wrote the numbers down by hand. Then the second fold began. It went better than the first."


def test_refusals_of_any_length():
    prompt = "The second fold kept every trace of the first, and nobody wondered about the numbers."
    assert all(defects.defect(prompt, x) == "refusal" for x in (LONG, LATE, LONG + " " + "I am sorry that you have to hear this from me. " * 20))
    assert defects.defect(prompt, PROSE) is None and defects.defect(PROSE, PROSE[::1] + " So it was.") != "refusal"


# --- no limits of length ------------------------------------------------------
@pytest.mark.parametrize("times", [1, 10, 1000])
def test_garbled_words_of_any_length(times):
    """One word without a break, far above the window: evidence and repair."""
    word = "żółtaćwiękśzą" * 4 * times
    bad = word.encode("iso8859_2").decode("cp1252")
    assert mojibake.evidence(bad)[mojibake.INDEX["iso8859_2>cp1252"]] > 8
    assert mojibake.restore(bad, "iso8859_2>cp1252") == (word, True)


def test_garbled_phrase_within_a_line():
    was = "The heading of the page is こんにちは世界の皆さん and the rest of this long line is plain English, as it was before."
    for enc, read in (("cp932", "cp1252"), ("euc_jp", "cp1252")):
        bad = was.encode(enc)
        bad = "".join(bytes([b]).decode(read) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in bad)
        assert f"{enc}>{read}" in {mojibake.CHAINS[k] for k in mojibake.evidence(bad)}
        assert "こんにちは" in mojibake.restore(bad, f"{enc}>{read}")[0]
    assert not mojibake.evidence("The letters “àâäéèê” are French, as is «œuvre».")


def test_mentions_of_any_length():
    seq = "café été".encode().decode("cp1252")
    long = "".join(c for c in ("éèêàçùîô" * 5).encode().decode("cp1252") if c > "\x7f")
    assert not mojibake.evidence(f"With the wrong encoding the letters appear as “{long}” on the page.")
    assert mojibake.evidence(f"They said {seq} and left for {seq}.")


def test_em_ends_when_settled(spark):
    bad = "Ça c'est déjà très étrange".encode().decode("cp1252")
    df = spark.createDataFrame([(i, bad if i % 5 == 0 else "plain text", f"s{i % 3}") for i in range(60)], "doc_id bigint, text string, source string")
    assert {r.doc_id for r in mojibake.garbled(df).collect()} == set(range(0, 60, 5))


def test_token_automaton():
    auto = defects.TokenAutomaton({"x": ["not <fill> edit*", "no a? ~2 help|aid", "stop"]}, {"fill": frozenset(["to", "be"])})
    got = lambda s: [(n, a, b) for n, a, b in auto.hits(s.split())]
    assert got("do not " + "to be " * 500 + "edited") == [("x", 1, 1002)]
    assert got("no a b c help") == [("x", 0, 4)] and got("no b c help") == [("x", 0, 3)] and got("no a b c d help") == []
    assert got("not not edit stop") == [("x", 1, 2), ("x", 3, 3)] and got("") == []


@pytest.mark.parametrize("times", [1, 10, 1000])
def test_defects_have_no_limit_of_length(times):
    prompt = "The quick analysis shows that seven models agree on the main result, and that one does not."
    intro = "Here is " + "the very carefully considered " * times + "version of it:"
    assert defects.defect(prompt, f"{intro}\n\n{prompt}") == "copy" and defects.defect(prompt, f"{intro} {prompt}") == "copy"
    assert defects.defect(prompt, "… —  " * 200 * times) == "empty"
    assert defects.defect(prompt, f"I can't {'at this time ' * times}rewrite this passage.") == "refusal"
    quoted = "He said “" + "I cannot rewrite this text " * times + "” and went on to fix the notebook."
    assert defects.defect(prompt, quoted) != "refusal"


@pytest.mark.parametrize("times", [1, 10, 1000])
def test_notations_of_any_length(net, times):
    """Templates, formulas, brackets and tags far above any length seen in training."""
    words = " ".join(["alpha beta gamma"] * 100 * times)
    assert labeller.found_families([f"Before {{{{Infobox | name = {words} | in = {{{{nested|x}}}} }}}} after."], net)[0] == {"wiki"}
    formula = " + ".join(f"a_{{{i}}} x^{i}" for i in range(40 * times))
    assert labeller.found_families([f"We know that ${formula}$ holds here."], net)[0] == {"latex"}
    assert labeller.found_families([f"We paid $5 {words} and then $7 for it."], net)[0] == set()
    assert [x.kind for x in markup.scan(f"a [{words}] b")] == ["text", "bracket", "text"]
    assert [x.kind for x in markup.scan(f"a {{{{x|{words}|{{{{y}}}} {{{{z|{{{{w}}}}}}}} }}}} b")] == ["text", "template", "text"]


def test_scan_is_not_quadratic(net):
    import time

    for text in ("<!-- " * 40000, "[" * 200000, "$x " * 60000, "{{" * 60000, "\\( " * 40000, "<b " * 60000, "![" * 60000, "<li>x " * 40000, "* " * 60000):
        start = time.time()
        markup.scan(text)
        assert time.time() - start < 20, text[:10]


def test_weights_are_kept(spark, net, monkeypatch):
    import numpy as np

    monkeypatch.setattr(labeller, "_TRAINED", [])
    monkeypatch.setattr(labeller, "train", lambda *a: net)
    monkeypatch.setattr(labeller.train, "__defaults__", (1,))
    labeller.trained(spark)
    monkeypatch.setattr(labeller, "_TRAINED", [])
    again = labeller.trained(spark)
    assert again is not net and all((again.p[k] == net.p[k]).all() and again.p[k].dtype == np.float32 for k in net.p)


@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(st.one_of(st.characters(), st.sampled_from("aZ09_ .,-“”’—…é\x1c\x85\n")), max_size=60))
def test_words_equal_the_pattern(text):
    assert defects.words_in(text) == defects.WORD.findall(text)
