"""Sentences of sections in many languages and scripts, as offsets.

A pushdown automaton reads a block of running lines: its stack holds the quotations and brackets that are open, and a
terminator ends a sentence only where the stack is empty and what follows can begin one. Abbreviations are looked up in a
trie, backwards from the full stop. Heading lines and list items are blocks of their own.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.codepoints import flat_sections
from corpusmill.llm.lookalikes import CYRILLIC, GREEK
from corpusmill.operators.pages import once_each

# Abbreviations after which a sentence goes on, whatever follows.
INNER_ABBREVIATIONS = """
dr mr mrs ms prof st fig figs no nos vol vols p pp cf e.g i.e eg ie approx ca vs viz ed eds ch chap sec op cit mt ft gen col capt lt sgt
rev hon gov sen rep pres dept univ assn est ref refs eq eqs
nr bzw z.b d.h u.a usw vgl abb bd hr hrn fr str
m mm mme mlle mgr av env
sr sra srta dra pág págs núm vol ej ud uds
проф акад доц др им ул т т.е т.к стр рис см ср
κ κα δρ σελ βλ αρ
د أ م
डॉ श्री प्रो पं
""".split()
# Abbreviations that can end a sentence; they do where a capital follows.
FINAL_ABBREVIATIONS = "a.m p.m inc co ltd corp jr etc al bros llc plc г гг в вв д п н.э usw etc".split()
# Months after a German ordinal number.
MONTHS = "Januar Februar März April Mai Juni Juli August September Oktober November Dezember Jänner".split()
# What may follow a closing quotation in Japanese so that the sentence goes on.
QUOTATIVE = "とっのはがをにでもな、，"

TERMINATORS = ".!?。！？؟।॥…։።"
OPENERS = {"“": "”", "„": "“”", "«": "»", "「": "」", "『": "』", "(": ")", "（": "）", "[": "]", "‹": "›", "【": "】", "《": "》"}
CLOSERS = "”“»」』)）]›】》\"'’"
_EVENTS = re.compile(r"[.!?。！？؟।॥…։።;;]+|[\"“”„«»「」『』()（）\[\]‹›【】《》]")
_HEADING = re.compile(r"#{1,6}[\s ]")
_ITEM = re.compile(r"\s*(?:[•▪◦‣·]|\d{1,3}[.)](?=\s)|[-–—*](?=\s))")
_REFERENCES = re.compile(r"(?:\[(?:\d{1,4}|[a-z]|note \d+|citation needed)\])+")
_THAI_GAP = re.compile(r"(?<=[฀-๿])[ \t\n  -  ]+(?=[฀-๿])")
_WORD_BEFORE = re.compile(r"[^\s(\[{\"“„«/—–]*\Z")


class Trie:
    """Words read from their ends."""

    def __init__(self, words: list[str]) -> None:
        self.root: dict = {}
        for word in words:
            node = self.root
            for c in reversed(word):
                node = node.setdefault(c, {})
            node[""] = True

    def ends(self, text: str, at: int) -> bool:
        """Whether a whole word of the trie stands right before `at`, in any case."""
        node = self.root
        while True:
            if "" in node and (at == 0 or not (text[at - 1].isalnum() or text[at - 1] == "." or unicodedata.category(text[at - 1])[0] == "M")):
                return True
            if at == 0 or (node := node.get(text[at - 1].lower())) is None:
                return False
            at -= 1


_LATIN = str.maketrans(CYRILLIC | GREEK)
_INNER, _FINAL = Trie(INNER_ABBREVIATIONS), Trie(FINAL_ABBREVIATIONS)
_ACRONYM = re.compile(r"(?:^|[^\w.])((?:\w\.){1,5}\w)\Z")
#: An opening phrase of time or place that ends in an abbreviation is no sentence yet.
_LEAD = re.compile(r"(?:At|By|In|On|From|Until|Before|After|Since|Around|About|Near|For|With)(?:\s+\S+){0,4}\Z")
_INITIAL = re.compile(r"(?:^|[\s(\[\"“„«.\-])([^\W\d_])\Z")


@cache
def _shown_char(char: str) -> str:
    kind = unicodedata.decomposition(char).partition(" ")[0]
    return "" if unicodedata.category(char) == "Cf" else unicodedata.normalize("NFKC", char) if kind == "<wide>" else char


def _shown(text: str) -> str:
    """A text without invisible characters, letters in their usual width; Latin look-alikes in mixed words become Latin."""
    text = "".join(map(_shown_char, text))
    word = text[max(text.rfind(" "), text.rfind("\n")) + 1 :]
    if re.search("[A-Za-z]", word):
        text = text[: len(text) - len(word)] + word.translate(_LATIN)
    return text


def _skip(text: str, at: int, end: int) -> int:
    """The next place with a character that is seen."""
    while at < end and (text[at].isspace() or unicodedata.category(text[at]) == "Cf"):
        at += 1
    return at


def _starts(char: str) -> bool:
    """Whether a sentence can begin with this character."""
    kind = unicodedata.category(char)
    return kind in ("Lu", "Lt", "Lo", "Nd", "No", "Ps", "Pi", "Sc", "Lm") or char in "\"'„“«¿¡#•$<*`\\'|="


def _lines(text: str) -> Iterator[tuple[int, int, bool]]:
    """Blocks of a text: begin, end, and whether the block is one unit, as headings and list items are."""
    begin = at = 0
    open_ = False
    for line in text.split("\n"):
        end = at + len(line)
        single = bool(_HEADING.match(line) or _ITEM.match(line))
        if single or not line.strip():
            if open_:
                yield begin, at - 1, False
                open_ = False
            if single:
                yield at, end, True
        elif not open_:
            begin, open_ = at, True
        at = end + 1
    if open_:
        yield begin, len(text), False


class Automaton:
    """Reads one block; `ends` are the offsets behind the last character of each sentence."""

    def __init__(self, text: str, begin: int, end: int, greek: bool) -> None:
        self.text, self.start, self.end, self.greek = text, begin, end, greek
        self.small = not any(c.isupper() for c in text[begin:end])
        self.stack: list[tuple[str, int]] = []
        self.ends: list[int] = []
        self.passed = begin

    def balanced(self, at: int, closers: str) -> bool:
        """Whether what opens at `at` is closed in the block; else it opens nothing."""
        return any(0 <= self.text.find(c, at + 1, self.end) for c in closers)

    def emit(self, at: int) -> None:
        self.ends.append(at)
        self.start = _skip(self.text, at, self.end)

    def abbreviates(self, at: int, following: str, rest: int) -> bool:
        """Whether the full stop at `at` belongs to the word before it, so that the sentence goes on."""
        text = self.text
        before = text[max(0, at - 48) : at]
        if not before.isascii():
            before = _shown(before)
        if _INNER.ends(before, len(before)):
            return True
        final = _FINAL.ends(before, len(before))
        if final or _ACRONYM.search(before):
            if following.isdigit() and not _LEAD.match(text[self.start : at]):
                # a number that counts something can begin a sentence, a year after a name does not
                return final and before.lower().endswith("al") or not re.match(r"\d+\s+[^\W\d]", text[rest : self.end])
            if _LEAD.match(text[self.start : at]):
                return True
            return not (following.isupper() or following in "\"“„«([¿¡" or unicodedata.category(following) == "Lo")
        if m := _INITIAL.search(before):
            # initials of names; and single small letters before another, as in z. B. or т. е.
            return m[1].isupper() or re.match(r"[^\W\d_]\.", text[rest : self.end]) is not None or not m[1].isascii() and following.isalpha()
        if re.search(r"(?:^|\D)\d{1,2}\Z", before):
            word = re.match(r"\w+", text[rest : self.end])
            return bool(word and word[0] in MONTHS)
        return False

    def final(self, at: int, stop: str, begun_quote: bool | None) -> bool:
        """Whether a sentence can end behind `at`; `stop` is the terminator, begun_quote tells of a quotation just closed:
        whether the sentence began with it, or None if none was."""
        rest = _skip(self.text, at, self.end)
        if rest >= self.end:
            return True
        following, spaced = self.text[rest], rest > at
        uncased = unicodedata.category(following) in ("Lo", "Lm") or "　" <= following <= "鿿"
        if begun_quote is not None and uncased and not spaced:
            return not begun_quote and following not in QUOTATIVE
        if begun_quote and uncased:
            return False
        if following.islower():
            return self.small and spaced and begun_quote is None and not stop.startswith("..")
        return _starts(following)

    def run(self) -> list[int]:
        text = self.text
        for m in _EVENTS.finditer(text, self.passed, self.end):
            sign, at = m.group(), m.start()
            if at < self.passed:
                continue
            if sign[0] in ";;":
                if not self.greek or (len(sign) == 1 and at + 1 < self.end and not text[at + 1].isspace() and text[at + 1] not in CLOSERS):
                    continue
                self.terminator("?", m.end())
            elif sign[0] in TERMINATORS:
                self.full_stop(sign, at, m.end())
            else:
                self.bracket(sign, at)
        tail = text[self.start : self.end]
        if tail.strip():
            self.emit(self.start + len(tail.rstrip()))
        return self.ends

    def bracket(self, sign: str, at: int) -> None:
        text = self.text
        if self.stack and sign in self.stack[-1][0]:
            _, opened = self.stack.pop()
            if not self.stack and sign not in ")）]":
                inside = text[opened + 1 : at].rstrip()
                while inside and inside[-1] in CLOSERS:
                    inside = inside[:-1].rstrip()
                if inside and inside[-1] in TERMINATORS + (";" if self.greek else ""):
                    self.close(at + 1, inside[-1], opened == self.start)
            elif not self.stack and sign in ")）":
                inside = text[opened + 1 : at].rstrip()
                if inside and inside[-1] in TERMINATORS and opened == self.start:
                    self.close(at + 1, inside[-1], None)
        elif sign == '"':
            before = text[at - 1] if at > self.start else " "
            after = text[at + 1] if at + 1 < self.end else " "
            if (before.isspace() or before in "([—–:/-" or at == self.start or not before.isalnum() and before not in TERMINATORS + ",") and not after.isspace() and self.balanced(at, '"'):
                self.stack.append(('"', at))
        elif sign in OPENERS and self.balanced(at, OPENERS[sign]):
            if sign == "[" and _REFERENCES.match(text, at, self.end):
                return
            self.stack.append((OPENERS[sign], at))

    def close(self, at: int, stop: str, begun: bool | None) -> None:
        while at < self.end and self.text[at] in CLOSERS and self.text[at] not in "\"“„'":
            at += 1
        if refs := _REFERENCES.match(self.text, at, self.end):
            at = refs.end()
        if self.final(at, stop, begun):
            self.passed = max(self.passed, at)
            self.emit(at)

    def full_stop(self, sign: str, at: int, end: int) -> None:
        text = self.text
        if self.stack:
            return
        rest = _skip(text, end, self.end)
        following = text[rest] if rest < self.end else ""
        if sign == ".":
            glued = rest == end and following
            if glued and following not in CLOSERS and following != "[":
                # a sentence can follow without a blank: a longer word, then a capital and small letters
                if not (following.isupper() and re.search(r"[^\W\d_]{3,}\Z", text[max(0, at - 8) : at]) and re.match(r"\w[a-zà-ÿ]*(?:\s|\Z|[,'’])", text[rest : min(self.end, rest + 30)]) and not re.search(r"[.:/@]\w*\Z", text[max(0, at - 30) : at])):
                    return
            elif following and self.abbreviates(at, following, rest):
                return
        self.terminator(sign, end)

    def terminator(self, sign: str, at: int) -> None:
        if self.stack:
            return
        text = self.text
        while at < self.end and text[at] in CLOSERS and not (text[at] in "\"'“" and at + 1 < self.end and text[at + 1].isalnum()):
            at += 1
        if refs := _REFERENCES.match(text, at, self.end):
            at = refs.end()
        rest = _skip(text, at, self.end)
        if rest == at < self.end and sign[-1] in ".!?…" and text[at].isascii() and text[at].isalnum() and not text[at].isupper():
            return
        if self.final(at, sign, None):
            self.passed = max(self.passed, at)
            self.emit(at)


def sentence_ends(text: str | None) -> list[int]:
    """Offsets behind the last character of each sentence of a text, in order; none for null, empty or blank text."""
    if not text or not text.strip():
        return []
    greek = len(re.findall("[Ͱ-Ͽἀ-῿]", text)) * 3 > len(text)
    ends: list[int] = []
    for begin, end, single in _lines(text):
        if single:
            ends.append(begin + len(text[begin:end].rstrip()))
            continue
        begin = _skip(text, begin, end)
        gaps = [m.span() for m in _THAI_GAP.finditer(text, begin, end)]
        for stop, then in [*gaps, (end, end)]:
            if text[begin:stop].strip():
                ends += Automaton(text, begin, stop, greek).run()
            begin = then
    return ends


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, places, values = flat_sections(batch.column("text_list"))
        ends = [sentence_ends(t) for t in values.to_pylist()]
        sizes = np.array([len(e) for e in ends], dtype=np.int64)
        pages = np.asarray(batch.column("page_id"), dtype=np.int64)[rows]
        yield pa.record_batch(
            [pa.array(np.repeat(pages, sizes)), pa.array(np.repeat(places, sizes).astype(np.int32)), pa.array([x for e in ends for x in e], pa.int32())],
            names=["page_id", "sec_idx", "end_pos"],
        )


def sentences(pages: DataFrame) -> DataFrame:
    """page_id, sec_idx, end_pos: one row for each sentence of the sections of `pages` (page_id, text_list).

    A page in several rows counts once; null ids, lists and sections and blank sections have no sentences. end_pos counts
    the characters from the start of the section through the sentence's last one. Texts are read where they lie.
    """
    once = once_each(pages.select("page_id", "text_list"))
    return once.mapInArrow(_split, "page_id long, sec_idx int, end_pos int")


def sample_sentences(pages: DataFrame, sample: DataFrame) -> DataFrame:
    """sentences of the pages named in `sample` (page_id)."""
    wanted = sample.select("page_id").distinct()
    return sentences(pages.join(wanted, "page_id", "left_semi"))


def sentence_texts(pages: DataFrame) -> DataFrame:
    """page_id, sec_idx, sentence_idx, sentence: the sentences themselves, in order from 0."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, values = flat_sections(batch.column("text_list"))
            pages_ = np.asarray(batch.column("page_id"), dtype=np.int64)[rows]
            out: list[tuple] = []
            for page, place, text in zip(pages_.tolist(), places.tolist(), values.to_pylist(), strict=True):
                begin = 0
                for k, end in enumerate(sentence_ends(text)):
                    out.append((page, place, k, text[begin:end].strip()))
                    begin = end
            cols = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.string()), strict=True)], names=["page_id", "sec_idx", "sentence_idx", "sentence"])

    return once_each(pages.select("page_id", "text_list")).mapInArrow(cut, "page_id long, sec_idx int, sentence_idx int, sentence string")
