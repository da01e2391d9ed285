"""Words of segmented pages, their frequencies and first places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def words_of(pages: DataFrame, page: str = "page_id") -> DataFrame:
    """page, sec, sent, pos, word: pieces of sentences between spaces (U+0020); empty ones count, line breaks stay inside."""
    sections = pages.select(F.col(page).alias("page"), F.posexplode("text_list").alias("sec", "sentences"))
    sentences = sections.select("page", "sec", F.posexplode("sentences").alias("sent", "s"))
    return sentences.select("page", "sec", "sent", F.posexplode(F.split("s", " ", -1)).alias("pos", "word"))


def word_frequencies(pages: DataFrame, page: str = "page_id") -> DataFrame:
    """word, freq, first_pos: occurrences and the first place, which orders the words by appearance."""
    at = F.struct("page", "sec", "sent", "pos")
    return words_of(pages, page).groupBy("word").agg(F.count("*").alias("freq"), F.min(at).alias("first_pos"))
