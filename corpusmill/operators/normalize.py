"""Normalization of pages and the cut-off of short sections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import normalize as n


def normalized(pages: DataFrame, len_cutoff: int = -1) -> DataFrame:
    """`pages` with each section of text_list normalized and those shorter than `len_cutoff` characters left out.

    Pages whose lists are or become empty stay; null lists stay null, null sections are left out where there is a cut-off.
    """
    texts = F.transform(n.compose_each(F.col("text_list")), n.normal_text)
    return pages.withColumn("text_list", cut_short(texts, len_cutoff))


def cut_short(texts, len_cutoff: int):
    return texts if len_cutoff < 0 else F.filter(texts, lambda t: F.length(t) >= len_cutoff)
