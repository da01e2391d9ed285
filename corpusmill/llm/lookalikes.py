"""One form for text that looks the same: widths, joined letters, invisible characters, accents and look-alike letters.

Sections are exploded into positioned code points (a run of plain ASCII stays one piece), joined with a mapping that
decomposes them and replaces look-alikes, and rebuilt; combining marks are then put in order by class and recomposed.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusmill.operators.pages import once_each, sections
from corpusmill.session import materialize, salted_join

# Letters of other scripts that have the shape of a Latin letter, and that letter.
CYRILLIC = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C",
    "Т": "T", "У": "Y", "Х": "X", "Ԛ": "Q", "Ԝ": "W", "Ԍ": "G", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y",
    "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "Ӏ": "I", "ү": "y", "Ү": "Y",
}
GREEK = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X", "α": "a", "ι": "i", "ν": "v", "ο": "o", "ρ": "p", "ϲ": "c", "Ϲ": "C", "ϳ": "j", "Ϳ": "J",
}
OTHERS = {"ɡ": "g", "ı": "i", "ɑ": "a", "‐": "-", "ꞏ": "·", "․": ".", "‚": ",", "ʼ": "’", "∶": ":", "⁄": "/", "∕": "/"}
LOOK_ALIKE = CYRILLIC | GREEK | OTHERS
#: Kinds of compatibility decomposition that change no shape that a reader sees; of <compat> only joined letters do not.
SAME_SHAPE = {"<wide>", "<narrow>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>"}
# Characters without a shape that are not of category Cf.
INVISIBLE = "͏ᅟᅠ឴឵ㅤﾠ"
#: A run of ASCII, without the last character where a mark follows it and without control characters; or one character.
PIECE = r"(?:[\x20-\x7E\n](?!\p{M}))+|(?s:.)"


def shape(char: str) -> str:
    """What is left of a character when decomposed and brought to the shape that a reader sees."""
    if unicodedata.category(char) == "Cf" or char in INVISIBLE or "︀" <= char <= "️" or "\U000e0100" <= char <= "\U000e01ef":
        return ""
    if unicodedata.category(char) == "Zs" or char == "\t":
        return " "
    kind, _, rest = unicodedata.decomposition(char).partition(" ")
    if kind in SAME_SHAPE or kind == "<compat>" and unicodedata.category(char)[0] == "L" and " " in rest:
        char = "".join(shape(chr(int(x, 16))) for x in rest.split())
    return "".join(LOOK_ALIKE.get(c, c) for c in unicodedata.normalize("NFD", char))


def shape_table(spark: SparkSession) -> DataFrame:
    """piece, shown: the code points that change; bounded by Unicode itself, about 15,000 rows."""
    points = (chr(n) for n in range(sys.maxunicode + 1) if not 0xD800 <= n <= 0xDFFF)
    rows = [(c, to) for c in points if unicodedata.category(c) not in ("Cn", "Co") and (to := shape(c)) != c]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["piece", "shown"]), "piece string, shown string")


@F.pandas_udf(StringType())
def _recompose(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def one_form(texts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, text, form: the form is equal for texts that look equal. `texts` has unique `keys` and a text.

    Null texts have a null form, empty ones an empty form; other columns are dropped. Only texts with more than plain
    ASCII are exploded; their pieces meet again within the task that made them, so one row for each text is shuffled.
    """
    texts = texts.select(*keys, "text")
    odd = F.coalesce(F.col("text").rlike(r"[^\x20-\x7E\n]"), F.lit(False))
    plain = texts.where(~odd).select(*keys, "text", F.col("text").alias("form"))
    pieces = texts.where(odd).select(*keys, F.posexplode(F.regexp_extract_all("text", F.lit(PIECE), F.lit(0))).alias("at", "piece"))
    mapped = pieces.join(F.broadcast(shape_table(texts.sparkSession)), "piece", "left")
    placed = F.array_sort(F.collect_list(F.struct("at", F.coalesce("shown", "piece").alias("shown"), "piece")))
    rebuilt = mapped.groupBy(*keys).agg(placed.alias("all")).select(*keys, F.array_join("all.piece", "").alias("text"), F.array_join("all.shown", "").alias("form"))
    return plain.unionByName(rebuilt.withColumn("form", _recompose("form")))


def forms(pages: DataFrame) -> DataFrame:
    """page_id, sec_idx, text, form of each section of `pages` (page_id, text_list); a page in several rows counts once."""
    return one_form(sections(once_each(pages.select("page_id", "text_list"))), ["page_id", "sec_idx"])


def look_alike_pairs(pages: DataFrame) -> DataFrame:
    """page_a, sec_a, page_b, sec_b: pairs of sections with one form but different characters; a is the smaller key.

    Null sections are in no pair. Texts are compared by 128-bit digests. Pairs are made between the different texts of a
    form, and then between their sections: sections with equal text are never paired with each other.
    """
    keyed = forms(pages).where(F.col("text").isNotNull()).select("page_id", "sec_idx", F.unhex(F.md5("form")).alias("form"), F.unhex(F.md5("text")).alias("raw"))
    keyed = materialize(keyed, "forms")
    several = keyed.groupBy("form").agg(F.min("raw").alias("low"), F.max("raw").alias("high")).where("low <> high").select("form")
    members = materialize(salted_join(keyed, several, ["form"]), "form-members")
    raws = members.select("form", "raw").distinct()
    a, b = raws.toDF("form", "raw_a"), raws.toDF("form", "raw_b")
    pairs = a.join(b, "form").where("raw_a < raw_b").select("raw_a", "raw_b")
    side = lambda s: members.select(F.col("raw").alias(f"raw_{s}"), F.struct(F.col("page_id").alias("page"), F.col("sec_idx").alias("sec")).alias(s))
    both = pairs.join(side("a"), "raw_a").join(side("b"), "raw_b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
    return both.select(F.col("low.page").alias("page_a"), F.col("low.sec").alias("sec_a"), F.col("high.page").alias("page_b"), F.col("high.sec").alias("sec_b"))
