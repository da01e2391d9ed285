"""Statistics of each section's text, and which sections lie in the tails of their language's distributions.

Each statistic is gathered per language into mergeable quantile sketches (KLL); a value becomes a percentile and a robust
z-score, its distance from the median in units of the spread on the side that junk does not widen. Shares are taken as
log-odds, drawn to their mean where a text is short, so that their distributions are spread out. The z-scores on the side
of junk are gathered into a sketch once more, and the tail that is flagged begins where that distribution is emptiest.
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
from corpusmill.session import materialize

# The most common words of languages in Latin script, which any prose holds and lists seldom do.
COMMON_WORDS = {
    "en": "the of and a an in to is was were be been by for with on at as from that this it its which who whose where when while they he she his her their them we you i or not but so if than then because although though after before into near over under no any all some there these those had has have did do does would could may might one two other such more most what why how out up about between through during until without within upon against nor only my your our him me us are will shall can must very also now long ago each every few many",
    "de": "der die das den dem des ein eine einen einem einer und oder aber nicht ist war waren sind wird wurde von vom zu zum zur mit auf im in am an aus bei nach für über unter als wie er sie es ich wir ihr sein seine ihre dass wenn weil durch ohne um trotz seit wer was wo sich auch nur noch",
    "fr": "le la les l un une des du de d et ou mais ne pas est était sont fut a au aux en dans sur par pour avec sans sous ce cette ces qui que qu quoi il elle ils elles on nous vous je se sa son ses leur leurs plus après avant malgré près chez si comme quand où",
    "es": "el la los las un una unos unas de del y o u e pero no es era fue son en con por para sin sobre a al que quien se su sus lo le les más como cuando donde si ya muy después antes cerca entre desde hasta este esta ese esa ha han pesar",
}
# First and last code point of the letters by which a script is told.
SCRIPTS = {"ru": ("Ѐ", "ӿ"), "el": ("Ͱ", "Ͽ"), "ar": ("؀", "ۿ"), "hi": ("ऀ", "ॿ"), "th": ("฀", "๿"), "ja": ("぀", "ヿ"), "ko": ("가", "힣"), "he": ("֐", "׿")}
HAN = ("一", "鿿")
TERMINATORS = ".!?。！？।؟;…"

_WORDS = {w: lang for lang in reversed(COMMON_WORDS) for w in COMMON_WORDS[lang].split()}
_EVERY = {lang: frozenset(text.split()) for lang, text in COMMON_WORDS.items()}
_ANY = frozenset(_WORDS)
_ENTRY = re.compile(r"[ \t]*(?:[-–—•*·▪◦+|›»]|\d{1,4} ?[–—:]|\(?\d{1,4}[.)](?=\s)|\(?[A-Za-z]\)(?=\s)|\(?[a-z][.)](?=\s)|\(?[ivx]{1,5}[.)](?=\s))|[\w ]{1,24}:\s(?=.{0,60}(?<![.!?])\Z)")
#: A row of a table: values between commas, tabs, bars or semicolons that no blank follows; or between wide gaps.
_ROW = re.compile(r"(?=[^\s,;|]*[,;|\t][^\s,;|])(?:[^,;|\t]*[,;|\t](?=[^\s])){3,}|[^\s,;|]+(?:[,;|\t][^\s,;|]+){2,}\Z")
_GAP = re.compile(r"[^\s.!?][ \t]{3,}(?=\S)")
_END = re.compile(r"[.!?。！？।؟…][\"'”’»」』)\]]*(?:\[\d+\])*\s*$")
_INNER = re.compile(r"[.!?؟।][\"'”’»)\]]*(?:\[\d+\])*\s|[。！？]")
_STRIP = "\"'“”‘’„«»()[]{},.;:!?-–—…"
_HEADING = re.compile(r"\A#{1,6} [^\n]*(?:\n|\Z)")

#: Statistics, and on which side of their distribution junk lies.
SIDES = {"prose_share": -1, "common_share": 0, "symbol_share": 1, "digit_share": 1, "entry_share": 1, "repeat_share": 1, "mean_word_length": 0, "end_share": 0, "n_words": 0, "n_lines": 0, "n_chars": 0}
#: Shares that are taken as log-odds, what they are shares of, and by how much of it they are drawn to their mean.
SHARES = {"prose_share": ("n_chars", 20.0), "symbol_share": ("n_chars", 20.0), "digit_share": ("n_chars", 20.0), "entry_share": ("n_chars", 20.0), "repeat_share": ("n_words", 5.0)}
#: Least spread of log-odds that counts as one robust standard deviation, for tables whose texts are all alike.
LEAST_SPREAD = 0.3
#: Sections at which a language's own distribution weighs as much as that of all languages.
LEAST_SECTIONS = 100
#: Where the tail is taken to begin before any data are seen; it weighs as much as LEAST_SECTIONS sections.
FAR = 7.5
#: Size of the sketch of z-scores (its ranks are exact to about 0.1 %), the steps in which it is read, and the share of
#: sections beyond which a gap is sought no more: what lies behind it would be single texts.
TAIL_SKETCH, TAIL_STEPS, TAIL_END = 4096, 1000, 0.995


@cache
def _is_mark(c: str) -> bool:
    """Whether a character is a mark of the letter before it, as vowel signs of Indic and Thai scripts are."""
    return unicodedata.category(c)[0] == "M"


@cache
def _script_ranges() -> list[tuple[str, re.Pattern]]:
    return [(lang, re.compile(f"[{a}-{b}]")) for lang, (a, b) in SCRIPTS.items()] + [("zh", re.compile(f"[{HAN[0]}-{HAN[1]}]"))]


def language(text: str, words: list[str]) -> str:
    """Language by script; in Latin script by common words, 'und' where there are hardly any."""
    if not text.isascii():
        sample = max(1, sum(map(str.isalpha, text)))
        for lang, letters in _script_ranges():
            if len(letters.findall(text)) > (0.15 if lang == "ja" else 0.4) * sample:
                return lang
    best, lang = max((sum(w in known for w in words), lang) for lang, known in _EVERY.items())
    return lang if best > 0.12 * len(words) and len(_EVERY[lang].intersection(words)) >= 3 else "und"


def _spaced(lang: str) -> bool:
    return lang not in ("zh", "ja", "th")


def _paragraphs(body: str) -> Iterator[tuple[str, bool]]:
    """Lines that run on, put together; an entry of a list stands alone and is told."""
    held: list[str] = []
    for line in body.split("\n"):
        entry = _ENTRY.match(line) is not None or _ROW.match(line) is not None or len(_GAP.findall(line)) > 1
        if held and (entry or not line.strip()):
            yield "\n".join(held), False
            held = []
        if entry:
            yield line, True
        elif line.strip():
            held.append(line)
    if held:
        yield "\n".join(held), False


def _like_sentences(part: str) -> bool:
    """Whether a text has words of letters, mostly in lower case, and sentences of usual length."""
    words = part.split()
    clean = sum(w.strip(_STRIP).replace("-", "").replace("'", "").replace("’", "").isalpha() for w in words)
    small = sum(w[:1].islower() for w in words)
    ends = len(_INNER.findall(part)) + (_END.search(part) is not None)
    return clean >= 0.85 * len(words) and small >= 0.6 * len(words) and 4 * ends <= len(words) <= 60 * ends


def statistics(text: str | None) -> tuple:
    """Language and the statistics of SIDES, of a section's body without its heading line."""
    body = _HEADING.sub("", text or "", count=1).strip()
    words = [w for w in (x.strip(_STRIP) for x in body.lower().split()) if w]
    lang = language(body, words)
    n_chars, n_words = len(body), len(words)
    dense = max(1, n_chars - sum(map(body.count, " \n\t")))
    letters = sum(map(str.isalpha, body)) if not body.isascii() else len(re.findall("[A-Za-z]", body))
    digits = sum(map(body.count, "0123456789"))
    marks = sum(map(body.count, ".,;:!?'\"-()"))
    symbols = max(0, dense - letters - digits - marks) if body.isascii() else max(0, sum(not c.isalnum() and not c.isspace() and not _is_mark(c) for c in body) - marks - sum(map(body.count, "“”‘’„«»—–।。、，！？：「」؟،")))
    lines = [x for x in body.split("\n") if x.strip()]
    known = _EVERY.get(lang, _ANY)
    common = sum(w in known for w in words)
    groups = list(zip(words, words[1:], words[2:])) if n_words >= 12 else []
    repeats = 1 - len(set(groups)) / len(groups) if groups else 0.0
    prose = entries = 0
    latin = lang in _EVERY or lang == "und"
    for part, entry in _paragraphs(body):
        size = len(part)
        if entry:
            entries += size
            continue
        ended = _END.search(part) is not None or _INNER.search(part) is not None
        if latin:
            own = [w for w in (x.strip(_STRIP) for x in part.lower().split()) if w]
            share = sum(w in known for w in own) / max(1, len(own))
            good = share >= 0.14 and len(own) >= 4 and (ended or len(own) >= 15)
            # learned prose can do with few common words, and an unknown language has none that are known
            good = good or ended and _like_sentences(part)
        else:
            good = ended or size >= 60
        prose += size * good
    total = max(1, sum(map(len, body.split("\n"))))
    return (lang, prose / total if total else 0.0, common / max(1, n_words), symbols / dense, digits / dense, entries / total, repeats, sum(map(len, words)) / max(1, n_words), sum(_END.search(x) is not None for x in lines) / max(1, len(lines)), float(n_words), float(len(lines)), float(n_chars))


_HEADINGS = re.compile(r"^#{1,6} [^\n]*$", re.M)


def mainly_prose(text: str) -> bool:
    """Whether more than half of a whole English article, without its heading lines, is natural prose."""
    body = _HEADINGS.sub("", text)
    known, prose, total = _EVERY["en"], 0, 0
    every: list[str] = []
    for part, entry in _paragraphs(body):
        total += len(part)
        if entry:
            continue
        words = part.lower().split()
        every += words
        if len(words) < 4:
            continue
        ended = _END.search(part) is not None or _INNER.search(part) is not None
        if sum(map(known.__contains__, words)) >= 0.14 * len(words) and (ended or len(words) >= 15) or ended and _like_sentences(part):
            prose += len(part)
    if not total or 2 * prose <= total:
        return False
    groups = len(every) - 2
    return groups < 12 or 2 * len(set(zip(every, every[1:], every[2:]))) > groups


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", *SIDES]
    for batch in batches:
        rows, places, texts = flat_sections(batch.column("text_list"))
        pages = np.asarray(batch.column("page_id"), dtype=np.int64)[rows]
        found = list(zip(*map(statistics, texts.to_pylist()), strict=True)) or [[]] * len(names)
        yield pa.record_batch([pa.array(pages), pa.array(places.astype(np.int32)), pa.array(found[0], pa.string()), *(pa.array(x, pa.float64()) for x in found[1:])], names=["page_id", "sec_idx", *names])


def section_statistics(pages: DataFrame) -> DataFrame:
    """page_id, sec_idx, lang and the statistics of each section of `pages` (page_id, text_list).

    A page in several rows counts once. Null page ids and null or empty lists give no rows; null and empty sections have
    zeros throughout. Only the figures are shuffled, never the texts.
    """
    figures = ", ".join(f"{c} double" for c in SIDES)
    pages = pages.select("page_id", "text_list").where(F.col("page_id").isNotNull())
    return pages.mapInArrow(_measure, f"page_id long, sec_idx int, lang string, {figures}").dropDuplicates(["page_id", "sec_idx"])


def _value(c: str) -> str:
    """The column that holds a statistic as it is compared: a share's log-odds, other statistics as they are."""
    return f"{c}_value" if c in SHARES else c


def _log_odds(measured: DataFrame) -> DataFrame:
    """`measured` with the log-odds of each share, drawn to the share's mean over all sections (one row to the driver)."""
    kept = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(c)))
    means = measured.agg(*(F.avg(kept(c)).alias(c) for c in SHARES)).first()

    def odds(c: str):
        of, drawn = SHARES[c]
        mean = min(max(means[c] if means[c] is not None else 0.5, 1e-3), 1 - 1e-3)
        size = F.greatest(F.col(of), F.lit(3 * drawn))  # the shortest texts, and empty ones, are judged like short ones
        return F.log((kept(c) * size + drawn * mean) / ((1 - kept(c)) * size + drawn * (1 - mean)))

    return measured.withColumns({_value(c): odds(c) for c in SHARES})


def _percentile(c: str):
    """How many percent of the language's values are smaller, in steps of 2."""
    return 2.0 * F.size(F.filter(f"{c}_of.steps", lambda q: q < F.col(_value(c)))).cast("double")


def tail_begin(steps: list[float], n: int) -> float:
    """Where a distribution, given by its quantiles in rising order, is emptiest above its median; drawn to FAR as if
    LEAST_SECTIONS sections had said so, whatever `n` is."""
    if not n:
        return FAR
    q = np.array(steps)
    first, last = len(q) // 2, max(len(q) // 2 + 1, int(TAIL_END * (len(q) - 1)))
    at = first + int(np.argmax(np.diff(q[first : last + 1])))
    return float(FAR + ((q[at] + q[at + 1]) / 2 - FAR) * n / (n + LEAST_SECTIONS))


def scored(measured: DataFrame) -> DataFrame:
    """`measured` with, for each statistic x, x_percentile and x_z; `tail`, the z-scores on the side of junk put
    together (the logarithm of their summed exponentials: about the largest, more where several are large); and `junk`: whether it lies behind the emptiest place of the distribution of `tail` over all sections.

    The spread is taken on the other side of the median, which junk does not widen. A language's quantiles are drawn
    towards those of all languages together, with its n sections weighing n and these LEAST_SECTIONS, whatever n is;
    sections whose language is not known are held against all. The sketches are one row for each language that
    `language` knows, so their broadcast is bounded; they are partially aggregated, whatever a language's share of the rows.
    """
    measured = _log_odds(measured)
    sketches = measured.groupBy("lang").agg(*(F.kll_sketch_agg_double(_value(c)).alias(c) for c in SIDES))
    every = sketches.agg(*(F.kll_merge_agg_double(c).alias(c) for c in SIDES)).where(F.kll_sketch_get_n_double("n_words") > 0)

    def quantiles(c: str):
        steps = F.kll_sketch_get_quantile_double(F.col(c), F.array(*(F.lit(k / 50) for k in range(51))))
        return F.concat(steps, F.kll_sketch_get_quantile_double(F.col(c), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))))

    def centre(c: str, side: int):
        drawn = F.zip_with(c, f"{c}_all", lambda own, of_all: of_all + (own - of_all) * F.col("weight"))
        low, middle, high = (F.element_at(drawn, k) for k in (52, 53, 54))
        spread = (high - low) / 1.349 if not side else ((high - middle) if side < 0 else (middle - low)) / 0.6745
        return F.struct(F.slice(drawn, 1, 51).alias("steps"), middle.alias("middle"), F.greatest(spread, F.lit(LEAST_SPREAD if c in SHARES else 1e-9)).alias("spread")).alias(f"{c}_of")

    n = F.kll_sketch_get_n_double("n_words")
    weight = F.when(F.col("lang") == "und", 0.0).otherwise(n / (n + LEAST_SECTIONS)).alias("weight")
    drawn = sketches.select("lang", weight, *(quantiles(c).alias(c) for c in SIDES)).join(F.broadcast(every.select(*(quantiles(c).alias(f"{c}_all") for c in SIDES))))  # one row
    known = materialize(drawn.select("lang", *(centre(c, side) for c, side in SIDES.items())), "quality-sketches")
    both = measured.join(F.broadcast(known), "lang")
    percentiles = {f"{c}_percentile": _percentile(c) for c in SIDES}
    both = both.withColumns(percentiles | {f"{c}_z": (F.col(_value(c)) - F.col(f"{c}_of.middle")) / F.col(f"{c}_of.spread") for c in SIDES})
    weights = [F.exp(F.greatest(F.lit(0.0), F.least(F.lit(50.0), F.col(f"{c}_z") * side))) for c, side in SIDES.items() if side]
    both = both.withColumn("tail", F.log(sum(weights, F.lit(1.0))))
    tails = both.agg(F.kll_sketch_agg_double("tail", TAIL_SKETCH).alias("tail"), F.count("tail").alias("n")).where("n > 0")
    read = tails.select("n", F.kll_sketch_get_quantile_double("tail", F.array(*(F.lit(k / TAIL_STEPS) for k in range(TAIL_STEPS + 1)))).alias("q")).first()
    begin = tail_begin(read["q"], read["n"]) if read else FAR
    return both.drop(*(f"{c}_of" for c in SIDES), *map(_value, SHARES)).withColumn("junk", F.col("tail") > begin)


def quality(pages: DataFrame) -> DataFrame:
    """section_statistics with percentiles, robust z-scores and the mark `junk`."""
    return scored(materialize(section_statistics(pages), "quality"))
