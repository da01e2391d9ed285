"""Residue, quality and sentences."""

import pytest

from corpusmill.llm import quality, residue, sentences

MARKUP = [
    "a <b>bold</b> word", "<!-- note", "x &amp; y", "&#8211;", "&#x9;", "see [[Page|text]]", "{{cite|x}}", "''it''", "'''bold'''", "== Head ==",
    "a\n{| class=x\n|-\n| a || b\n|}", "__NOTOC__", "~~~~", "[https://x.example text]", "**bold** x", "a *word* b", "__bold__", "_it_", "~~gone~~", "`code`",
    "```\ncode\n```", "[a](https://x.example)", "![a](b.png)", "[^1]", "[1]: https://x.example", "> quote", "| a | b |\n|---|---|", "Head\n=====", "----",
    "* item", "+ item", "- [x] task", "\\textbf{x}", "\\emph{x}", "{\\em x}", "\\begin{x}", "\\(x\\)", "\\[x\\]", "45\\%", "``x''", "~\\cite{a}", "\\item a", "<em\nclass=n>x</em\n>",
    '<div class="k" id=', "<https://x.example/page>", "<BR>",
]
PLAIN = [
    "a < b and c > d", "n<m and m>k holds", "fish of <28 mm", "3 * 4 * 5", "2**44 and 3**44", "reads (*) one, (**) two", "field_name_4 x", "~400 houses",
    "D:\\maps\\65", "$x_{34} \\leq y^2$ is", "$$\\frac{a}{8}$$", "46 km^2", "{1, 2, 3}", "Raton & Co. did", "&& and || too", "value -> loss", "# Head", "## Head\n\ntext",
    "  • item", "1. item", "- item", "text.[27] More", "#68 in rank", "[sic]", "don't 'quote' it", 'he said "x"', "a -- b", "5' 6'' tall", "", "AT&T; x", "@ 5",
]


@pytest.mark.parametrize("text", MARKUP)
def test_markup(text):
    assert residue.certain("Some words before.\n" + text)


@pytest.mark.parametrize("text", PLAIN)
def test_plain(text):
    assert not residue.certain(text) and residue.clean_text(text) == text


@pytest.mark.parametrize(
    "text, want",
    [
        ("a <b>bold</b> &amp; [[P|text]] ''it''", "a bold & text it"),
        ("== Head ==\n* one\n* two", "## Head\n• one\n• two"),
        ("<h3>Head</h3><ul><li>one</li><li>two</ul>", "### Head\n\n• one\n• two"),
        ("```\nx = 1\ny\n```", "    x = 1\n    y"),
        ("\\begin{equation}\nx_2\n\\end{equation}", "$$x_2$$"),
        ("\\(a\\) and $b_1$ and **c**", "$a$ and $b_1$ and c"),
        ("\\section{Head}\n\\begin{itemize}\n\\item a\n\\end{itemize}", "## Head\n• a"),
        ("x<!-- gone --><ref>r</ref>{{t}} y", "x y"),
        (None, None),
    ],
)
def test_clean(text, want):
    assert residue.clean_text(text) == want


def test_records(spark):
    rows = [(1, "https://h/a", ["plain", "<b>x</b>", None, ""], 1, 2), (2, None, None, 1, 2), (3, "", [], 1, 2), (None, "u", ["<b>x</b>"], 1, 2), (1, "https://h/a", ["plain", "<b>x</b>", None, ""], 1, 2)]
    rows += [(10 + k, "https://h/p", ["x <zing> y </zing> z"], 1, 2) for k in range(4)] + [(20, "https://other/p", ["x <zing> y </zing> z"], 1, 2)]
    rows += [(30 + k, "https://h/p", ["if n<m and m>k then"], 1, 2) for k in range(4)]
    df = spark.createDataFrame(rows, "rec_id long, url string, texts array<string>, host int, sure int")
    got = {tuple(x) for x in residue.records_with_markup(df).collect()}
    # <zing> and </zing> share their vectors and nest on the host with enough pages; <m and m> never closes
    assert got == {(1, 1), *((10 + k, 0) for k in range(4))}
    assert residue.records_with_markup(df.limit(0)).count() == 0 and residue.cleaned(df).count() == len(rows)


@pytest.mark.parametrize("text", ["---", "  ---", ";term: def", "   ;term: def"])
def test_quick_look_misses_no_form(text):
    assert residue.certain("Some words before.\n" + text)


@pytest.mark.parametrize("sign", ["*", "**", "_", "__"])
def test_long_emphasis(sign):
    long = "words that go on " * 60 + "and end"
    assert residue.certain(sign + long + sign) and residue.clean_text(sign + long + sign) == long


def test_unknown_tags_by_their_share(spark):
    rows = [(k, "https://h/p", ["<b>x</b> <zing> y </zing> z"]) for k in range(5)] + [(5, "https://h/p", ["x <zing> y </zing> z"]), (6, "https://h/p", ["x <zing> y"])]
    rows += [(10, "https://o/p", ["a <my-box>b</my-box>"]), (11, "https://o/p", ['a <zang kind="k">b</zang>']), (12, "https://o/p", ["<msup><mi>x</mi><mn>2</mn></msup>"]), (None, "https://h/p", ["x <zing> y"]), (13, "https://o/p", ["n<m and m>k"])]
    df = spark.createDataFrame(rows, "rec_id long, url string, texts array<string>")
    assert {x.rec_id for x in residue.records_with_markup(df).collect()} == {*range(7), 10, 11, 12}
    got = {x.rec_id: x.texts[0] for x in residue.cleaned(df).collect()}
    assert got[0] == "x  y  z" and got[5] == "x  y  z" and got[6] == "x  y" and got[10] == "a b" and got[11] == "a b" and got[12] == "x2" and got[13] == "n<m and m>k"
    assert len(got) == len(rows)


def test_page_slots(spark):
    page = "<html><head><title>t</title></head><body><div id='top'>Site name</div><a href='/'>Home</a><span>Imprint</span><h1>T{0}</h1><p>Text {0} of its own.</p><ul><li>one {0}</li></ul><pre><code>run</code></pre></body></html>"
    rows = [(k, "https://h/x", page.format(k), "t") for k in range(8)] + [(0, "https://h/x", page.format(0), "t"), (20, "u", None, "t"), (21, None, "", "t"), (22, "https://h/y", "<p>cut off <b", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, text string, template string")
    got = {x.page_id: x.text for x in residue.page_slots(df).collect()}
    assert set(got) == {*range(8), 22}
    assert "Site name" not in got[3] and "Imprint" not in got[3] and "# T3" in got[3] and "• one 3" in got[3] and "Text 3 of its own." in got[3]
    assert got[22].startswith("cut off")
    assert residue.page_slots(df.limit(0)).count() == 0


def slots(spark, pages):
    df = spark.createDataFrame([(k, "https://h/x", p) for k, p in enumerate(pages)], "page_id long, url string, text string")
    return {x.page_id: x.text for x in residue.page_slots(df).collect()}


def test_copied_pages_are_no_template(spark):
    own = "<body><div class='top'>Site name</div><h2>References</h2><p>Page {0} first.</p><p>Page {0} second.</p></body>"
    got = slots(spark, [own.format(k) for k in range(6)] + [own.format("copied")] * 8)
    assert all("Page copied first." in got[k] and "Page copied second." in got[k] for k in range(6, 14))
    assert all("Site name" not in x and "## References" in x for x in got.values())
    shared = "<body><p>Shared one.</p><p>Shared two.</p></body>"
    got = slots(spark, [own.format(k) for k in range(6)] + [shared.replace("</body>", f"<p>{k}</p></body>") for k in range(2)])
    assert "Shared one." in got[6] and "Shared two." in got[7]


def test_classes_have_one_order_and_nest(spark):
    turned = ["<p>One sign.</p><p>Other sign.</p>", "<p>Other sign.</p><p>One sign.</p>"]
    got = slots(spark, [f"<body>{turned[k % 2]}<p>Text {k}.</p></body>" for k in range(6)])
    assert all("One sign." in x and "Other sign." in x for x in got.values())
    rank = {"1": (9, 2, "1"), "2": (8, 2, "2")}
    of = {"a": "1", "b": "1", "c": "2", "d": "2"}
    valid = lambda text: {c: v for c, (_, v) in residue.judged_classes(text.split(), of, rank).items()}
    assert valid("a c d b a c d c d b") == {"1": True, "2": True} and valid("a c b d") == {"1": True, "2": False} and valid("a b b a c d") == {"1": False, "2": True}
    assert residue.tags_nest(["<a>", "<b>", "x", "</b>", "</a>"]) and not residue.tags_nest(["<a>", "<b>", "</a>", "</b>"])


def test_texts_that_only_begin_alike_are_no_template(spark):
    notice = "This page is kept by the council. " * 8
    page = "<body><div>Site name</div><p>" + notice + "{0}</p></body>"
    got = slots(spark, [page.format("") for k in range(1)] + [page.format(f"Own words {k}.") for k in range(5)])
    assert all(f"Own words {k}." in got[k + 1] and "Site name" not in got[k + 1] for k in range(5))


PROSE = "The mill by the river was sold in 1900. It was closed when the council moved to the town, and nobody wanted it. They left it to the rain."
JUNK = [
    "\n".join(f"- old mill of Town{k}" for k in range(12)), "\n".join(f"{k}. Name ({1900 + k})" for k in range(12)), "id,name,n\n" + "\n".join(f"{k},Aname,{k * 7}" for k in range(12)),
    "see the mill of Town in Place " * 20, "river pond wooden Town archive temporary ferry charter game seed cart " * 6, "12.5 -3.25 8.125\n" * 12, "Th3 m!ll w@5 +h3r3 @nd !t 5+00d. " * 6,
    "\n".join(f"Height: Place {k}" for k in range(12)), "(a) mill\nTown, 1900\n" * 8, "\n".join(f"{1500 + k} – old mill at Town" for k in range(12)), "", "5_4|~|+.:-1 9+6.*_5\\5\\1|.9~7\n" * 5,
]


def test_quality(spark):
    good = [PROSE, PROSE.upper(), PROSE.lower(), PROSE.replace(" of ", "\nof ").replace(", ", ",\n"), "Der alte Müller verkaufte die Mühle im Jahr 1900. Die Gemeinde war nicht dabei, und der Rat auch nicht.", "Старый мельник продал мельницу. Он уехал в город.", "老磨坊主卖了磨坊。他去了城里。"]
    rows = [(k, ["# T\n\n" + PROSE + f" It was {k}."], 1) for k in range(200)] + [(1000 + k, ["## H\n\n" + t], 1) for k, t in enumerate(JUNK)] + [(2000 + k, ["## H\n\n" + t], 1) for k, t in enumerate(good)]
    rows += [(3000, None, 1), (3001, [], 1), (3002, [None], 1), (None, [PROSE], 1), rows[0]]
    df = spark.createDataFrame(rows, "page_id long, text_list array<string>, lang int")
    got = {x.page_id: x for x in quality.quality(df).collect()}
    assert [k for k in range(len(JUNK)) if not got[1000 + k].junk] == []
    assert [k for k in range(len(good)) if got[2000 + k].junk] == [] and not any(got[k].junk for k in range(200))
    assert got[3002].n_words == 0 and 3000 not in got and 0 <= got[0].n_words_percentile <= 102
    assert quality.quality(df.limit(0)).count() == 0


HINDI = "लड़की ने किताब पढ़ी और फिर वह नदी के किनारे चली गई। उसके भाई ने उसे देखा और वह घर लौट आई।"


def test_quality_is_alike_at_every_size(spark):
    assert quality.statistics(HINDI)[0] == "hi" and quality.statistics(HINDI)[3] < 0.05
    english = [(k, [PROSE + f" It was {k}."]) for k in range(200)]
    z = {}
    for n in (3, 99, 100, 101):
        df = spark.createDataFrame(english + [(1000 + k, [HINDI + f" {k} ।"]) for k in range(n)] + [(5000, ["5_4|~|+.:-1 9+6.*_5 नदी\n" * 5])], "page_id long, text_list array<string>")
        got = {x.page_id: x for x in quality.quality(df).collect()}
        assert not any(got[1000 + k].junk for k in range(n)) and not any(got[k].junk for k in range(200)) and got[5000].junk
        z[n] = got[1000].mean_word_length_z, got[1000].digit_share_z
    assert all(abs(a - b) < 0.2 * max(1, abs(a)) for a, b in zip(z[99], z[100], strict=True))


CASES = [
    ("# Title\n\nOne. Two!\n\n  • item one\n  • item two\n", ["# Title", "One.", "Two!", "• item one", "• item two"]),
    ("Dr. Who met Mrs. Ann, e.g. near St. Paul, cf. Lee et al. 1930, and left.", 1),
    ("The members came from the N.R. The bell rang at 9 p.m. It later became Works Inc. 350 people lived there.", 4),
    ("Kel Jr. left the N.R. until 1736. At 5:13 a.m. Nal came. B. J. Pel went.", 3),
    ('"Who owns it?" asked Ann. She replied: "It is ours. We keep it." Then she left.', 3),
    ("«Где мост?» — спросил он. Он ушёл в 1715 г. вместе с ней.", 2),
    ("纳托说：“图书馆保护了钱币。”道路全长3.96公里！谁来了？", 3),
    ("「修道院は市場を訪れた。」とバナは書いた。誰が来た？", 2),
    ("Ο κ. Νικος ήρθε; Ναι, ήρθε. Έφυγε.", 3),
    ("किसने खोला? सड़क 25.69 किमी है। डॉ. राम ने देखा।", 3),
    ("ห้องสมุดซื้อกำแพง ถนนยาว17.49กิโลเมตร", 2),
    ("Am 23. Mai 1697 fand er z. B. Nr. 11. „Wer kam?“, fragte sie.", 2),
    ("« Qui vint ? » demanda Ann. M. Paul partit ! Elle resta.", 3),
    ("It ended.[16] A new one (see Fig. 9.4 and vol. 27, pp. 88–140). (It was closed.) What?!", 4),
    ("He waited ... and left. It was gone... The end. Pi is 3.14. File map.v1.6 at x.example is new.", 5),
    ("It was Kalanton.The next came.", 2),
    ("Wrapped lines go\non here. And\nhere.", 2),
    ("no end at all", 1),
    ("an \"unbalanced quote. Next one.", 1 + 1),
]


@pytest.mark.parametrize("text, want", CASES)
def test_sentences(text, want):
    ends = sentences.sentence_ends(text)
    cut = [text[a:b].strip() for a, b in zip([0, *ends], ends)]
    assert len(cut) == want if isinstance(want, int) else cut == want
    assert "".join("".join(cut).split()) == "".join(text.split()) and ends == sorted(set(ends))


def test_sentence_frames(spark):
    rows = [(1, ["One. Two.", None, "", "  \n"], 1), (1, ["One. Two.", None, "", "  \n"], 1), (2, None, 1), (None, ["x"], 1), (3, ["a" * 200_000 + ". " + "B. " * 3], 1)]
    df = spark.createDataFrame(rows, "page_id long, text_list array<string>, end_pos int")
    got = {tuple(x) for x in sentences.sentences(df).where("page_id = 1").collect()}
    assert got == {(1, 0, 4), (1, 0, 9)}
    assert [x.sentence for x in sentences.sentence_texts(df).where("page_id = 1").orderBy("sentence_idx").collect()] == ["One.", "Two."]
    sample = spark.createDataFrame([(1, "en"), (1, "en"), (None, "x"), (9, "x")], "page_id long, lang string")
    assert sentences.sample_sentences(df, sample).count() == 2 and sentences.sentences(df.limit(0)).count() == 0
