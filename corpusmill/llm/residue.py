"""Markup in text: which records hold any, and clean text that keeps headings, lists, code and formulas.

A record is read into markup tokens; the form of a token gives its type and no more. Tokens of one host whose occurrence
vectors over its records agree, an opening and its closing one, form an equivalence class; a class is valid if its tokens
nest. The valid classes of a host are its template: a record has markup if it holds tokens of a valid class, and what lies
in their slots is its text. Whole pages of HTML are brought to text by the same deduction over all tags and texts.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.codepoints import flat_sections, mix
from corpusmill.functions.prefilter import key_filter
from corpusmill.session import materialize, salted_join

# Elements of HTML, and of wiki text in angle brackets.
ELEMENTS = """a abbr acronym address area article aside audio b base bdi bdo big blockquote body br button canvas caption center
cite code col colgroup data datalist dd del details dfn dialog dir div dl dt em embed fieldset figcaption figure font footer form
frame frameset h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark math menu meta
meter nav noframes noscript object ol optgroup option output p param picture pre progress q rp rt ruby s samp script section
select small source span strike strong style sub summary sup svg table tbody td template textarea tfoot th thead time title tr
track tt u ul var video wbr annotation mrow ref references nowiki gallery includeonly noinclude onlyinclude poem
syntaxhighlight timeline ce chem score hiero templatestyles mi mo mn ms mtext mspace mfrac msqrt mroot mstyle merror mpadded mphantom
msup msub msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd menclose mfenced maction semantics""".split()
_NAMES = "|".join(sorted(ELEMENTS, key=len, reverse=True))
# Elements without an end tag, and elements whose end tag can be left out.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNENDED = VOID | frozenset("body colgroup dd dt head html li optgroup option p rp rt tbody td tfoot th thead tr references templatestyles".split())

# Names between two low lines that are no emphasis but identifiers of a programming language.
_SPECIAL = r"__(?:init|name|main|file|dict|str|repr|call|len|iter|next|enter|exit|getitem|setitem|new|del|all|doc|eq|hash|class)__"
#: Formulas of the parser's own format; their insides are no markup.
FORMULA = re.compile(r"(?<![\\$])(\$\$?)(?=[^\s$])[^$\n]*?[^\s$\\]\1(?!\$)")
#: Types of tokens by their form. Every part is bounded by characters that it cannot hold, so that reading is linear.
FORMS = re.compile(
    rf"""
    (?P<comment><!--) | (?P<doctype><!DOCTYPE) | (?P<tag></?(?:{_NAMES})(?:\s[^<>]*|\s*/)?(?:>|\Z)) | (?P<address><(?:https?|ftp|mailto):[^\s<>]+>)
  | (?P<point>&(?:\#\d{{1,7}}|\#[xX][0-9a-fA-F]{{1,6}});)
  | (?P<link>\[\[[^\[\]]) | (?P<template>\{{\{{[^{{}}\s]) | (?P<web>\[(?:https?:)?//[^\s\]]+) | (?P<tilde>~~~~? | ~~(?=\S))
  | (?P<texquote>``[^`'\n]+'')
  | (?P<code>(?<![`\w])`[^`\n]+`(?!`)) | (?P<fence>^```)
  | (?P<reference>\[[^\[\]\n]*\]\([^)\s]+(?:\s+"[^"\n]*")?\) | \[\^[\w-]+\] | ^\[[^\]\n]+\]:[ ])
  | (?P<star>(?<![\w*(])\*{{1,3}}(?=[^\s*)(,.;])[^*\n]+?(?<=[^\s*(])\*{{1,3}}(?![\w*)]))
  | (?P<underscore>(?<![\w_])(?!{_SPECIAL})_{{1,3}}(?=[^\W_])[^\n_]+?(?<=[^\s_])_{{1,3}}(?![\w_]))
  | (?P<line>^[ ]{{0,3}}(?:={{1,6}}[^=\n]+={{1,6}}[ ]*$|={{3,}}[ ]*$|-{{3,}}[ ]*$|\*{{3,}}[ ]*$|>+[ ]?\S|\*+[ ]\S|\+[ ]\S|[-*+][ ]\[[ xX]\][ ]|;[ ]?\S[^\n]*:|:+[ ]?''))
  | (?P<table>^\|.*\|[ ]*$ | ^\{{\||^\|[-}}] | ^\|[ ]\S+[ ]=) | (?P<redirect>^\#REDIRECT)
  | (?P<latex>(?<![\w:\\])(?:\\(?:[a-zA-Z]+\*?[\{{\[]|(?:begin|end|item|em|bf|it|par|noindent|maketitle|LaTeX|TeX)\b|[()\[\]%$&\#_{{}}\\])) | (?<=\}})\\[a-zA-Z]+\*?\{{ | (?<=\d)\\[%$&] | \{{\\[a-z]+\b)
    """,
    re.X | re.M | re.I,
)
_NAMED = re.compile(r"&([A-Za-z][A-Za-z0-9]{1,31};)")
_QUOTES, _UNQUOTES = re.compile(r"(?<![\w'])''+(?=[^\s'])"), re.compile(r"(?<=[^\s'])''+")
_TAG = re.compile(r"<(/?)([A-Za-z][\w:-]*)(?:\s[^<>]*?)?(/?)>")
_ATTRIBUTED = re.compile(r"""<([A-Za-z][\w:-]*)(?:\s+[\w:-]+\s*=\s*(?:"[^"<>]*"|'[^'<>]*'))+\s*/?>""")
_KNOWN = frozenset(ELEMENTS)
#: Without any of these there is no markup; a quick look before the slow one.
_SIGNS = re.compile(r"[<`\\~>\[{*_|=+]|&[#A-Za-z]|''|^ {0,3}-{3}|^ {0,3};|^ {0,3}:+ ?'|^#R", re.M)
#: What closes a token that opens something over more than its own form.
_CLOSERS = {"link": "]]", "template": "}}", "comment": "-->"}


def quoted(text: str) -> Iterator[tuple[int, int, int, int]]:
    """Begin and end of both marks of each '' ... '' within a line; a line is left once it holds no more closing ones."""
    if "''" not in text:
        return
    at = 0
    while opened := _QUOTES.search(text, at):
        line = text.find("\n", opened.end())
        closed = _UNQUOTES.search(text, opened.end() + 1, line if line >= 0 else len(text))
        if closed:
            yield *opened.span(), *closed.span()
            at = closed.end()
        elif line < 0:
            return
        else:
            at = line


def certain(text: str) -> bool:
    """Whether a text holds a token of a known form."""
    if not _SIGNS.search(text):
        return False
    if "$" in text:
        text = FORMULA.sub(" ", text)
    return FORMS.search(text) is not None or next(quoted(text), None) is not None or any(n in html.entities.html5 for n in _NAMED.findall(text)) or bool(sure_names(text))


def unknown_tags(text: str) -> list[tuple[str, int, int, bool]]:
    """Names of tags that are no known elements, how often they open and close, and whether their tags nest."""
    if "<" not in text:
        return []
    depth: dict[str, int] = {}
    opened: dict[str, int] = {}
    closed: dict[str, int] = {}
    nested: dict[str, bool] = {}
    for close, name, alone in _TAG.findall(FORMULA.sub(" ", text)):
        name = name.lower()
        if name in _KNOWN:
            continue
        step = 0 if alone else (-1 if close else 1)
        depth[name] = depth.get(name, 0) + step
        opened[name] = opened.get(name, 0) + (not close)
        closed[name] = closed.get(name, 0) + bool(close or alone)
        nested[name] = nested.get(name, True) and depth[name] >= 0
    return [(n, opened[n], closed[n], nested[n] and not depth[n]) for n in opened]


def sure_names(text: str) -> set[str]:
    """Names of unknown tags that one record shows to be tags: with quoted attributes, or nesting with a hyphen or colon in the name."""
    if "<" not in text:
        return set()
    names = {n.lower() for n in _ATTRIBUTED.findall(FORMULA.sub(" ", text))} - _KNOWN
    return names | {n for n, opens, _, nests in unknown_tags(text) if opens and nests and ("-" in n or ":" in n)}


def record_tokens(text: str) -> list[tuple[str, bool, int, int, bool]]:
    """For each type of token in a text: its name, whether it is a known form, how often it opens and closes, and whether
    its tokens nest. Tokens that stand alone, or whose form holds both their ends, open and close at once."""
    if not _SIGNS.search(text):
        return []
    bare = FORMULA.sub(" ", text) if "$" in text else text
    counts: dict[str, list[int]] = {}
    tags: list[tuple[str, bool]] = []
    for m in FORMS.finditer(bare):
        kind = m.lastgroup
        if kind == "tag":
            tag = m.group()
            name = re.match(r"</?([A-Za-z0-9]+)", tag)[1].lower()
            kind = "<" + name
            held = counts.setdefault(kind, [0, 0])
            if name in UNENDED or tag.rstrip(">").endswith("/"):
                held[0] += 1
                held[1] += 1
            else:
                held[tag[1] == "/"] += 1
                tags.append((kind, tag[1] == "/"))
        else:
            held = counts.setdefault(kind, [0, 0])
            held[0] += 1
            held[1] += kind not in _CLOSERS and kind != "fence"
    for kind, closer in _CLOSERS.items():
        if kind in counts:
            counts[kind][1] = bare.count(closer)
    if "fence" in counts:
        n = counts["fence"][0]
        counts["fence"] = [n - n // 2, n // 2]
    pairs = sum(1 for _ in quoted(bare))
    names = sum(n in html.entities.html5 for n in _NAMED.findall(bare))
    counts.update({k: [n, n] for k, n in (("quotes", pairs), ("point", names + counts.get("point", [0])[0])) if n})
    crossed: set[str] = set()
    stack: list[str] = []
    for kind, close in tags:
        if not close:
            stack.append(kind)
        elif stack and stack[-1] == kind:
            stack.pop()
        elif kind in stack:
            at = len(stack) - 1 - stack[::-1].index(kind)
            crossed.update(stack[at + 1 :])
            del stack[at:]
        else:
            crossed.add(kind)
    out = [(k, True, a, b, a == b and k not in crossed) for k, (a, b) in counts.items()]
    sure = sure_names(text)
    return out + [("<" + n, n in sure, a, b, x) for n, a, b, x in unknown_tags(text)]


_TOKENS = "array<struct<name:string,known:boolean,opens:int,closes:int,nests:boolean>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("name", pa.string()), ("known", pa.bool_()), ("opens", pa.int32()), ("closes", pa.int32()), ("nests", pa.bool_())]))
    names = ("name", "known", "opens", "closes", "nests")
    for batch in batches:
        rows, places, values = flat_sections(batch.column("texts"))
        tokens, at = [], []
        for i, text in enumerate(values.to_pylist()):
            if text and (found := record_tokens(text)):
                at.append(i)
                tokens.append([dict(zip(names, x)) for x in found])
        take = np.asarray(at, dtype=np.int64)
        ids, hosts = np.asarray(batch.column("rec_id"), dtype=np.int64), batch.column("host")
        yield pa.record_batch(
            [pa.array(ids[rows[take]]), pa.array(places[take].astype(np.int32)), hosts.take(pa.array(rows[take])), pa.array(tokens, kind)],
            names=["rec_id", "sec_idx", "host", "tokens"],
        )


def host_of(url: str):
    return F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit(""))


#: Records of a host on which the tokens of a class must occur.
LEAST_PAGES = 3
#: Records, agreeing and nesting, that a known form is worth before any record of its host is seen. An unknown tag has none.
KNOWN_RECORDS = 3
#: Share of a host's records with a class beyond which its vectors must agree and its tokens nest; cut-off records do not
#: void the others.
NEST_SHARE = 0.5


def _found(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rec_id, sec_idx, host, tokens of each text with tokens; and rec_id, sec_idx, name, known of those of a valid class.

    Two tokens of a type, the opening and the closing one, are compared by their occurrence vectors over the host's
    records: what both have in common (the sum of the smaller counts) against what either has (the sum of the larger).
    """
    scanned = records.where(F.col("rec_id").isNotNull()).select("rec_id", host_of("url").alias("host"), "texts").mapInArrow(_scan, f"rec_id long, sec_idx int, host string, tokens {_TOKENS}")
    found = materialize(scanned.dropDuplicates(["rec_id", "sec_idx"]), "markup")
    tokens = found.select("rec_id", "sec_idx", "host", F.inline("tokens"))
    start = F.when(F.max("known"), KNOWN_RECORDS).otherwise(0)
    both, either = F.sum(F.least("opens", "closes")) + start, F.sum(F.greatest("opens", "closes")) + start
    classes = tokens.groupBy("host", "name").agg((F.count("*") + start).alias("n"), (both / either).alias("agree"), ((F.sum(F.col("nests").cast("int")) + start) / (F.count("*") + start)).alias("nest"))
    valid = classes.where((F.col("n") >= LEAST_PAGES) & (F.col("agree") > NEST_SHARE) & (F.col("nest") > NEST_SHARE)).select("host", "name")
    return found, salted_join(tokens.select("rec_id", "sec_idx", "host", "name", "known"), valid, ["host", "name"]).select("rec_id", "sec_idx", "name", "known")


def records_with_markup(records: DataFrame) -> DataFrame:
    """rec_id, sec_idx of each text with tokens of a valid class. `records` has rec_id, url and texts (array of strings).

    A record given in several rows counts once. Null ids, lists and texts have no markup; null urls share the host ''.
    Only what was found is shuffled, never the texts.
    """
    return _found(records)[1].select("rec_id", "sec_idx").distinct()


# ---- clean text ----

_BLOCKS = {"p", "div", "section", "article", "blockquote", "table", "tr", "ul", "ol", "dl", "dt", "dd", "br", "hr", "figure", "body", "header", "footer", "nav", "aside", "main", "center"}
_ANY_TAG = re.compile(rf"</?({_NAMES})(?:\s[^<>]*|\s*/)?(?:>|\Z)", re.I)


def _tag_text(m: re.Match) -> str:
    tag, name = m.group(), m.group(1).lower()
    closing = tag[1] == "/"
    if name in ("h1", "h2", "h3", "h4", "h5", "h6"):
        return "\n" if closing else "\n" + "#" * int(name[1]) + " "
    if name == "li":
        return "" if closing else "\n• "
    if name in ("sup",):
        return "" if closing else "^"
    return "\n" if name in _BLOCKS else (" " if name in ("td", "th") and not closing else "")


def _code(body: str) -> str:
    return "\n".join("    " + x for x in body.strip("\n").split("\n"))


def _between(text: str, begin: re.Pattern, end: re.Pattern, to: Callable[[str], str]) -> str:
    """`text` with `to` of what is inside in place of each `begin ... end`. Once no end follows, no more is sought."""
    out, at = [], 0
    while (opened := begin.search(text, at)) and (closed := end.search(text, opened.end())):
        out += (text[at : opened.start()], to(text[opened.end() : closed.start()]))
        at = closed.end()
    return "".join(out) + text[at:]


def _templates(text: str) -> str:
    """`text` without balanced {{ ... }}, however deep; of {{lang|code|text}} the text stays. What is not closed stays but for its braces."""
    if "{{" not in text:
        return text
    levels: list[list[str]] = [[]]
    at = 0
    for m in re.finditer(r"\{\{|\}\}\n?", text):
        levels[-1].append(text[at : m.start()])
        at = m.end()
        if m.group() == "{{":
            levels.append([])
        elif len(levels) > 1:
            inside = "".join(levels.pop()).split("|", 2)
            if len(inside) == 3 and inside[0].strip().lower() == "lang":
                levels[-1].append(inside[2] + m.group()[2:])
        else:
            levels[-1].append(m.group())
    levels[-1].append(text[at:])
    return "".join(x for level in levels for x in level)


def _table(m: re.Match) -> str:
    rows = (row for row in m[0].split("\n")[1:] if row[:1] in "|!" and row[:2] not in ("|-", "|}", "|+"))
    return "\n".join(" ".join(c.strip() for c in re.split(r"\|\||!!", row.lstrip("|! "))) for row in rows)


def _unquoted(text: str) -> str:
    marks = [span for a, b, c, d in quoted(text) for span in ((a, b), (c, d))]
    ends = [0, *(b for _, b in marks)], [*(a for a, _ in marks), len(text)]
    return "".join(text[a:b] for a, b in zip(*ends, strict=True)) if marks else text


_R = re.compile
# code, whose inside stays as it is: (begin, end, whether it is a block)
_CODES = [
    (_R(r"<(?:pre|syntaxhighlight)\b[^<>]*>(?:\s*<code[^<>]*>)?", re.I), _R(r"(?:</code>\s*)?</(?:pre|syntaxhighlight)\s*>", re.I), True),
    (_R(r"^```[^\n]*\n", re.M), _R(r"^```[ ]*$", re.M), True),
    (_R(r"\\begin\{(?:verbatim|lstlisting)\}"), _R(r"\\end\{(?:verbatim|lstlisting)\}"), True),
    (_R(r"<(?:code|kbd|samp|tt|nowiki)\b[^<>]*>", re.I), _R(r"</(?:code|kbd|samp|tt|nowiki)\s*>", re.I), False),
    (_R(r"(?<![`\w])`(?=[^`\n]+`(?!`))"), _R(r"`"), False),
]
#: Lines of code that are told by four blanks and a sign of code; not those of lists and quotations.
_INDENTED = _R(r"^(?: {4,}|\t)(?![ \t]|[•*+>-] |\d+[.)] )[^\n]*(?:[=;{}]|\w\([^\n]*\)|:[ ]*$)[^\n]*$", re.M)
# formulas of LaTeX and HTML: (begin, end, sign)
_FORMULAS = [
    (_R(r"\\begin\{(?:equation|align|displaymath|gather)\*?\}\s*"), _R(r"\s*\\end\{(?:equation|align|displaymath|gather)\*?\}"), "$$"),
    (_R(r"(?<!\\)\\\[\s*"), _R(r"\s*\\\]"), "$$"), (_R(r"(?<!\\)\\\(\s*"), _R(r"\s*\\\)"), "$"), (_R(r"<math\b[^<>]*>\s*", re.I), _R(r"\s*</math>", re.I), "$"),
]
# each form of markup and what stands in its place, in the order in which they are read; a pattern, or a function of the text
_REWRITES: list[tuple[re.Pattern, object]] = [
    (_R(r"<(https?:[^\s<>]+)>"), r"\1"),
    (_R(r"<!DOCTYPE[^<>]*>?", re.I), ""),
    (_ANY_TAG, _tag_text),
    (_R(r"^[ ]*\{\|.*?(?:^\|\}|\Z)", re.S | re.M), _table),
    (_R(r"\[\[(?:Category|File|Image):[^\[\]]*\]\]\n?", re.I), ""),
    (_R(r"\[\[(?:[^\[\]|]*\|)?([^\[\]]*)\]\]"), r"\1"),
    (_templates, None),
    (_R(r"\[(?:https?:)?//[^\s\[\]]+\s*([^\[\]\n]*)\]"), r"\1"),
    (_R(r"!\[([^\[\]\n]*)\]\([^)\n]*\)"), r"\1"),
    (_R(r"\[([^\[\]\n]*)\]\([^)\s]+(?:\s+\"[^\"\n]*\")?\)"), r"\1"),
    (_R(r"\[\^[\w-]+\](?::[^\n]*)?"), ""),
    (_R(r"^\[[^\]\n]+\]: [^\n]*\n?", re.M), ""),
    (_R(r"^#REDIRECT\b[ ]*", re.M | re.I), ""),
    (_R(r"^[ ]{0,3}(={1,6})[ ]*([^=\n]+?)[ ]*\1[ ]*$", re.M), lambda m: "#" * len(m[1]) + " " + m[2]),
    (_R(r"^([^\n]+)\n={3,}[ ]*$", re.M), r"# \1"),
    (_R(r"^([^\n]+)\n-{3,}[ ]*$", re.M), r"## \1"),
    (_R(r"^[ ]{0,3}(?:-{3,}|\*{3,}|={3,})[ ]*\n?", re.M), ""),
    (_R(r"^\|?[ ]*:?-{3,}:?[ ]*(?:\|[ ]*:?-{3,}:?[ ]*)*\|?[ ]*\n?", re.M), ""),
    (_R(r"^\|(.*)\|[ ]*$", re.M), lambda m: " ".join(x.strip() for x in m[1].split("|"))),
    (_R(r"\\(?:chapter|section)\*?\{([^{}]*)\}"), r"## \1"),
    (_R(r"\\(?:sub)+section\*?\{([^{}]*)\}"), r"### \1"),
    (_R(r"\\(?:begin|end)\{[^{}]*\}\n?"), ""),
    (_R(r"^[ ]*\\item\b[ ]*", re.M), "• "),
    (_R(r"~?\\(?:cite|ref|label|footnote|pageref)\*?(?:\[[^\[\]\n]*\])?\{[^{}]*\}"), ""),
    (_R(r"(?<![\w:\\])\\[a-zA-Z]+\*?\{([^{}$]*)\}"), r"\1"),
    (_R(r"\{\\[a-z]+\s+([^{}]*)\}"), r"\1"),
    (_R(r"(?:(?<![\w:\\])|(?<=\d))\\([%$&#_{}])"), r"\1"),
    (_R(r"``([^`'\n]+)''"), r'"\1"'),
    (_unquoted, None),
    (_R(r"~~~~?"), lambda m: "" if len(m[0]) > 2 else m[0]),
    (_R(r"~~([^~\n]+)~~"), r"\1"),
    (_R(r"^[ ]{0,3}[-*+] \[[ xX]\] ", re.M), "• "),
    (_R(r"^[ ]{0,3}[*+]+ (?=\S)", re.M), "• "),
    (_R(r"^[ ]{0,3}>+ ?", re.M), "    "),
    (_R(r"(?<![\w*(])(\*{1,3})(?=[^\s*)(,.;])([^*\n]+?)(?<=[^\s*(])\1(?![\w*)])"), r"\2"),
    (_R(r"__[A-Z]+__\n?"), ""),
    (_R(rf"(?<![\w_])(?!{_SPECIAL})(_{{1,3}})(?=[^\W_])([^\n_]+?)(?<=[^\s_])\1(?![\w_])"), r"\2"),
]
_COMMENT = _R(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_REF_ALONE, _REF, _REF_END = _R(r"<ref\b[^<>]*/>", re.I), _R(r"<ref\b[^<>]*>", re.I), _R(r"</ref\s*>", re.I)
_OWN, _KEPT = _R("[\ue000\ue001]"), _R("\ue000(\\d+)\ue001")


def _rest(m: re.Match) -> str:
    """What stays of a token that is left alone when all forms have been rewritten: damaged, or made by what was removed."""
    kind, t = m.lastgroup, m.group()
    match kind:
        case "tag" | "comment" | "doctype" | "tilde" | "fence" | "redirect":
            return ""
        case "point":
            return html.unescape(t) if html.unescape(t) != t else ""
        case "reference":
            return t[1 : t.index("]")] if t[1] != "^" and t.endswith(")") else ""
        case "latex":
            return t[-1] if not t[-1].isalnum() and t[-1] not in "{[*()]\\" else ""
        case "table":
            return " ".join(x.strip("{}- ") for x in t.split("|")).strip()
        case "line":
            return t.lstrip(" =->+*;:")[:1] if t.rstrip()[-1:] not in "=-*" else t.strip(" =-*")
    return t.strip("<>[]{}`'*_")


def clean_text(text: str | None, names: frozenset[str] = frozenset()) -> str | None:
    """A text without its markup, in the format of the parsed pages: # headings, • items, code indented by four spaces,
    formulas in dollars; code and formulas stay as they are. Null stays null; a text without markup is returned as it is.
    `names` are unknown tags of its host. No known form of markup is left outside of code and formulas."""
    if not text:
        return text
    names = sure_names(text) | names.intersection(n for n, *_ in unknown_tags(text)) if "<" in text else frozenset()
    if not names and not certain(text):
        return text
    kept: list[str] = []

    def keep(piece: str) -> str:
        kept.append(piece)
        return f"\ue000{len(kept) - 1}\ue001"

    def whole(m: re.Match) -> str:
        return keep(m.group())

    text = FORMULA.sub(whole, _OWN.sub(whole, text))
    text = _between(_REF_ALONE.sub("", _COMMENT.sub("", text)), _REF, _REF_END, lambda _: "")
    text = _INDENTED.sub(whole, text)
    for begin, end, block in _CODES:
        text = _between(text, begin, end, lambda body, block=block: f"\n{keep(_code(html.unescape(body)))}\n" if block else keep(html.unescape(body)))
    for begin, end, sign in _FORMULAS:
        text = _between(text, begin, end, lambda body, sign=sign: keep(sign + html.unescape(body.strip()) + sign))
    text = html.unescape(re.sub(r"&(?:amp;)+", "&", text))
    if names:
        text = _TAG.sub(lambda m: "" if m[2].lower() in names else m[0], text)
    for form, to in _REWRITES:
        text = form(text) if to is None else form.sub(to, text)
    while certain(text):
        before = text
        text = re.sub(r"\[{2,}(?=[^\[\]])|\{{2,}(?=[^{}\s])", "", _NAMED.sub(lambda m: html.unescape(m.group()), _unquoted(FORMS.sub(_rest, text))))
        if len(text) >= len(before):
            break
    while _KEPT.search(text):  # what was kept can lie within what was kept later
        text = _KEPT.sub(lambda m: kept[int(m[1])], text)
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"(?<![ \t])[ \t]+\n", "\n", text)).strip("\n")


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        given = "names" in batch.schema.names
        every = batch.column("names").to_pylist() if given else [None] * len(batch)
        left = batch.column("plain").to_pylist() if given else [None] * len(batch)
        cleaned = [
            None if x is None else [t if p and k in p else clean_text(t, frozenset(n or ())) for k, t in enumerate(x)]
            for x, n, p in zip(batch.column("texts").to_pylist(), every, left, strict=True)
        ]
        yield pa.record_batch([batch.column("rec_id"), pa.array(cleaned, pa.list_(pa.string()))], names=["rec_id", "texts"])


def cleaned(records: DataFrame) -> DataFrame:
    """rec_id and its texts without markup; one row for each row given. `records` has rec_id, url and texts.

    What is removed are the tokens of valid classes, as `records_with_markup` finds them. Only the texts of records in which
    the classes of the host say more than the form are shuffled: those with unknown tags of a valid class, and those whose
    tokens of known form all belong to classes that are not valid, which stay as they are.
    """
    shape = "rec_id long, texts array<string>"
    found, valid = _found(records)
    valid = materialize(valid, "markup-valid")
    unknown = valid.where("not known").groupBy("rec_id").agg(F.collect_set(F.substring("name", 2, 1 << 20)).alias("names"))
    plain = found.where(F.exists("tokens", lambda t: t.known)).select("rec_id", "sec_idx").join(valid.select("rec_id", "sec_idx").distinct(), ["rec_id", "sec_idx"], "left_anti")
    plain = plain.groupBy("rec_id").agg(F.collect_set("sec_idx").alias("plain"))
    named = materialize(unknown.join(plain, "rec_id", "full"), "markup-names")
    maybe = key_filter(named.select("rec_id"), "rec_id")

    def split(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("rec_id")
                among = maybe(np.asarray(ids.fill_null(0), dtype=np.int64)) & np.asarray(ids.is_valid())
                yield batch.filter(pa.array(among == wanted))

        return run

    texts = records.select("rec_id", "texts")
    alone = texts.mapInArrow(split(False), texts.schema).mapInArrow(_clean, shape)
    return alone.unionByName(texts.mapInArrow(split(True), texts.schema).join(named, "rec_id", "left").mapInArrow(_clean, shape))


# ---- whole pages of HTML ----

_PIECES = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<[^<>]*(?:>|\Z)|[^<]+|<", re.S | re.I)


# Elements inside a line; text that follows their tags goes on a sentence and is in no template.
INLINE = frozenset("a abbr b bdi cite code em font i kbd mark math annotation q ref s samp small strike strong sub sup tt u var".split())


_HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())


def text_token(words: str) -> str:
    """A token for the whole of a text, however long: its length and a hash of 128 bits."""
    return f"{len(words)}:{blake2b(words.encode('utf-8', 'surrogatepass'), digest_size=16).hexdigest()}"


def page_pieces(page: str) -> Iterator[tuple[str, str, str]]:
    """(token, piece, kind) of each tag and piece of text; comments, scripts and styles are left out.

    Tags are told apart by name and class or id, end tags by those of the tag that they close. Kind is 'tag', 'start' for
    text that begins what an element holds, 'heading' for text of a heading, or 'text'.
    """
    opened = heading = False
    held: dict[str, list[str]] = {}
    for m in _PIECES.finditer(page):
        piece = m.group()
        if m.group(1) or piece.startswith(("<!", "<?")):
            continue
        if tag := re.match(r"<(/?)([A-Za-z][\w-]*)", piece):
            name = tag[2].lower()
            if tag[1]:
                kind = held[name].pop() if held.get(name) else name
            else:
                cls = re.search(r'\b(?:class|id)\s*=\s*"([^"]*)"', piece)
                kind = f"{name}.{cls[1]}" if cls else name
                if name not in VOID:
                    held.setdefault(name, []).append(kind)
            opened = not tag[1] and name not in INLINE
            if name not in INLINE and name not in VOID and name != "span":
                heading = not tag[1] and name in _HEADS
            yield f"<{tag[1]}{kind}>", piece, "tag"
        else:
            words = " ".join(html.unescape(piece).split())
            yield text_token(words), piece, "heading" if heading else "start" if opened and words else "text"
            opened = opened and not words


_MATH = re.compile(r"<annotation\b[^<>]*>(.*?)</annotation>", re.S | re.I)


def _body(page: str) -> str:
    """A page without its head, with formulas in dollars."""
    page = re.sub(r"<head\b.*?</head>", "", page, flags=re.S | re.I)
    return re.sub(r"<math\b.*?</math>", lambda m: "$" + (a[1].strip() if (a := _MATH.search(m[0])) else "") + "$", page, flags=re.S | re.I)


def _page_tokens(page: str) -> list[str]:
    """The tokens of a page that may be in a template, in order."""
    return [t for t, _, kind in page_pieces(_body(page)) if kind in ("tag", "start")]


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [blake2b(" ".join(_body(t or "").split()).encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in batch.column("text").to_pylist()]
        yield pa.record_batch([batch.column("page_id"), batch.column("host"), pa.array(prints, pa.binary())], names=["page_id", "host", "body"])


def _page_vectors(sign: int):
    """Occurrence vectors of a task's pages as sums, with a sign; the empty token, which is none, counts the pages of a host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        for batch in batches:
            ids = np.asarray(batch.column("page_id"), dtype=np.int64)
            weights = (mix(ids.view(np.uint64), 5) >> np.uint64(24)).astype(np.int64)
            sums: Counter = Counter()
            pages: Counter = Counter()
            for host, text, w in zip(batch.column("host").to_pylist(), batch.column("text").to_pylist(), weights.tolist(), strict=True):
                for t, n in Counter(["", *_page_tokens(text or "")]).items():
                    sums[host, t] += sign * w * n
                    pages[host, t] += sign
            keys = list(sums)
            wrapped = [(sums[k] + 2**63) % 2**64 - 2**63 for k in keys]
            yield pa.record_batch([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(wrapped, pa.int64()), pa.array([pages[k] for k in keys], pa.int64())], names=["host", "token", "vector", "n_pages"])

    return run


def tags_nest(tokens: list[str]) -> bool:
    """Whether the tags among the tokens of a class nest, as far as both tags of an element are in it."""
    held, stack = set(tokens), []
    for t in tokens:
        if t.startswith("</") and "<" + t[2:] in held:
            if not stack or stack.pop() != t:
                return False
        elif t.startswith("<") and not t.startswith("</") and "</" + t[1:] in held:
            stack.append("</" + t[1:])
    return not stack


def judged_classes(tokens: list[str], of: dict[str, str], rank: dict[str, tuple]) -> dict[str, tuple[str, bool]]:
    """For each class on a page: the order of its tokens, and whether it is valid there.

    `of` gives the class of a token and `rank` that of a class. A class is valid if its tokens come in one order, as often
    as they come, if its tags nest, and if it is not crossed by a class of a higher rank: each time it comes it must lie
    between two neighbouring tokens of the other, or the other way round.
    """
    own: dict[str, list[str]] = {}
    for t in tokens:
        if t in of:
            own.setdefault(of[t], []).append(t)
    sizes = {c: len(set(x)) for c, x in own.items()}
    good = {c for c, x in own.items() if len(x) % sizes[c] == 0 and len(set(x[: sizes[c]])) == sizes[c] and x == x[: sizes[c]] * (len(x) // sizes[c]) and tags_nest(x[: sizes[c]])}
    crossed: set[str] = set()
    stack: list[str] = []  # classes that have begun and not ended
    seen = dict.fromkeys(good, 0)
    for t in tokens:
        if (c := of.get(t)) not in good:
            continue
        if seen[c] % sizes[c]:
            at = len(stack) - 1 - stack[::-1].index(c)
            crossed.update(min(c, x, key=rank.__getitem__) for x in stack[at + 1 :])
            if not (seen[c] + 1) % sizes[c]:
                del stack[at]
        elif sizes[c] > 1:
            stack.append(c)
        seen[c] += 1
    return {c: ("\n".join(x[: sizes[c]]), c in good and c not in crossed) for c, x in own.items()}


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known: dict[str, tuple[dict, dict]] = {}
        seen: set[tuple[str, str, str, bool]] = set()
        hosts, classes = batch.column("host").to_pylist(), batch.column("classes")
        for k, (host, text) in enumerate(zip(hosts, batch.column("text").to_pylist(), strict=True)):
            if host not in known:
                every = classes[k].as_py()
                of = {x["token"]: x["class"] for x in every}
                known[host] = of, {x["class"]: (x["n_pages"], x["size"], x["class"]) for x in every}
            found = judged_classes(_page_tokens(text or ""), *known[host])
            seen.update((host, c, blake2b(order.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest(), valid) for c, (order, valid) in found.items())
        columns = list(zip(*seen, strict=True)) or [[]] * 4
        yield pa.record_batch([*(pa.array(x, pa.string()) for x in columns[:3]), pa.array(columns[3], pa.bool_())], names=["host", "class", "ordered", "valid"])


#: Share of a host's different pages beyond which a class must occur to be part of its template.
TEMPLATE_SHARE = 0.5
#: Least number of tokens in a class.
CLASS_SIZE = 2


def templates(pages: DataFrame) -> DataFrame:
    """host, token, class: the valid equivalence classes of each host.

    A token's occurrence vector is summed up as one number, each page weighing a random amount, so that vectors are
    compared without being gathered. Of the pages of a host with one body one counts: the others' sums are taken off
    again. A class counts if it is on at least LEAST_PAGES and on more than TEMPLATE_SHARE of the pages, and valid on each
    page (`judged_classes`) with its tokens in one order throughout. `pages` has page_id (unique), host and text.
    """
    from corpusmill.llm.terms import _only

    shown = "host string, token string, vector long, n_pages long"
    bodies = materialize(pages.mapInArrow(_bodies, "page_id long, host string, body binary"), "page-bodies")
    firsts = bodies.groupBy("host", "body").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = materialize(salted_join(bodies, firsts, ["host", "body"]).where("page_id <> first").select("page_id"), "page-bodies-again")
    vectors = pages.mapInArrow(_page_vectors(1), shown).unionByName(_only(pages, again).mapInArrow(_page_vectors(-1), shown))
    tokens = vectors.groupBy("host", "token").agg(F.expr("pmod(sum(cast(vector as decimal(20,0))), 18446744073709551616)").alias("vector"), F.sum("n_pages").alias("n_pages"))
    tokens = materialize(tokens.where(F.col("n_pages") >= LEAST_PAGES), "page-tokens")
    every = tokens.where("token = ''").select("host", F.col("n_pages").alias("host_pages"))
    frequent = tokens.where("token <> ''").join(every, "host").where(F.col("n_pages") > TEMPLATE_SHARE * F.col("host_pages"))
    frequent = frequent.select("host", "token", "n_pages", F.col("vector").cast("string").alias("class"))
    sizes = frequent.groupBy("host", "class").agg(F.count("*").alias("size")).where(F.col("size") >= CLASS_SIZE)
    kept = materialize(frequent.join(sizes, ["host", "class"]), "page-classes")
    asked = kept.groupBy("host").agg(F.collect_list(F.struct("token", "class", "n_pages", "size")).alias("classes"))
    judged = salted_join(pages, asked, ["host"], counted=bodies).select("host", "text", "classes").mapInArrow(_judge, "host string, class string, ordered string, valid boolean")
    valid = judged.groupBy("host", "class").agg(F.every("valid").alias("valid"), (F.min("ordered") == F.max("ordered")).alias("one_order")).where("valid and one_order")
    return kept.join(valid.select("host", "class"), ["host", "class"]).select("host", "token", "class")


def page_slots(pages: DataFrame) -> DataFrame:
    """page_id, text: the text of each page of HTML that is not of its host's template, with headings, lists, code and
    formulas in the format of the parsed pages.

    `pages` has page_id, url and text; a page in several rows counts once; null and empty pages give no row. The text
    tokens of a host's template travel with its pages: they occur on more than TEMPLATE_SHARE of the pages, so they are at
    most 1/TEMPLATE_SHARE of the tokens of its average page; hosts are joined, not broadcast.
    """
    pages = pages.where("page_id is not null and text is not null and text <> ''").select("page_id", host_of("url").alias("host"), "text")
    from corpusmill.operators.pages import once_each

    pages = once_each(pages)
    shared = templates(pages).where(~F.col("token").startswith("<")).groupBy("host").agg(F.collect_set("token").alias("template"))
    both = salted_join(pages, shared, ["host"], how="left")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [slot_text(text, frozenset(t or ())) for text, t in zip(batch.column("text").to_pylist(), batch.column("template").to_pylist(), strict=True)]
            yield pa.record_batch([batch.column("page_id"), pa.array(out, pa.string())], names=["page_id", "text"])

    return both.select("page_id", "text", "template").mapInArrow(extract, "page_id long, text string")


def slot_text(page: str, template: frozenset[str]) -> str:
    """The text in a page's slots; what stands in the template is left out, the structure of the tags is kept."""
    parts = [piece for token, piece, kind in page_pieces(_body(page)) if kind != "start" or token not in template]
    text = clean_text("".join(parts)) or ""
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"^#{1,6}[ ]*$", "", text, flags=re.M))
