"""Sections as lists of sentences, by rules that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.schemas import DUPLICATE_MARK

# Abbreviations after which no sentence ends.
ABBREVIATIONS = "Dr Mr Mrs Ms Prof St Jr Sr No Vol vol Fig fig cf vs e.g i.e approx ca pp al etc Inc Ltd Co".split()
#: A terminator with closing marks, blanks, and what a sentence begins with; and what takes back an end after an abbreviation.
END = r"""([.!?]+["')\]]*)\s+([A-Z0-9"'(•#])"""
NO_END = r"(^|[ (\n\x01])(" + "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS) + r"|[A-Z])\.\x01"


def split_sentences(text: Column) -> Column:
    """Sentences in order; their characters but the blanks between them are those of the text. Null gives null, empty text
    one empty sentence."""
    marked = F.regexp_replace(text, END, "$1\x01$2")
    for _ in range(2):  # of neighbouring abbreviations each pass meets every other one
        marked = F.regexp_replace(marked, NO_END, "$1$2. ")
    return F.split(marked, "\x01", -1)


def segmented(pages: DataFrame, omit_duplicates: bool = True) -> DataFrame:
    """`pages` with each section of text_list as a list of sentences; removed duplicates are left out, or split like text."""
    texts = F.col("text_list")
    if omit_duplicates:
        texts = F.filter(texts, lambda t: ~t.eqNullSafe(F.lit(DUPLICATE_MARK)))
    return pages.withColumn("text_list", F.transform(texts, split_sentences))
