"""Column functions that bring text to one form: Unicode, white space, quotation marks and dashes."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Blanks that become a space, and the character that is deleted.
BLANKS = "\u00a0\u2002\u2003\u2009\u200a\u3000\t"
ZERO_WIDTH = "\u200b"
# Quotation marks and minus that become ASCII, and what they become.
TYPOGRAPHIC, PLAIN = "\u201c\u201d\u2018\u2019\u2212", "\"\"''-"


@F.pandas_udf(ArrayType(StringType()))
def _nfc_each(lists: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in lists:
        yield s.map(lambda x: None if x is None else [None if t is None else unicodedata.normalize("NFC", t) for t in x])


def compose_each(texts: Column) -> Column:
    """Each text of a list in normal form C; lists of plain ASCII never leave the JVM."""
    odd = F.exists(texts, lambda t: F.coalesce(t.rlike(r"[^\x00-\x7F]"), F.lit(False)))
    return F.coalesce(_nfc_each(F.when(odd, texts)), texts)


def line_ends(t: Column) -> Column:
    return F.regexp_replace(t, r"\r\n?", "\n")


def strip_controls(t: Column) -> Column:
    return F.regexp_replace(t, r"[\x00-\x08\x0B-\x1F\x7F]", "")


def plain_blanks(t: Column) -> Column:
    return F.translate(t, BLANKS + ZERO_WIDTH, " " * len(BLANKS))


def squeeze_spaces(t: Column) -> Column:
    """Runs of spaces become one; at the start of a line the first space is not counted in, so that long runs leave two."""
    return F.regexp_replace(t, r"(?<!^)(?<!\n) {2,}", " ")


def squeeze_lines(t: Column) -> Column:
    return F.regexp_replace(t, r"(?U)\n\s*\n", "\n\n")


def trim(t: Column) -> Column:
    return F.regexp_replace(t, r"(?U)\A\s+|\s+\z", "")


def whitespace(t: Column) -> Column:
    for step in (line_ends, strip_controls, plain_blanks, squeeze_spaces, squeeze_lines, trim):
        t = step(t)
    return t


def plain_marks(t: Column) -> Column:
    return F.translate(t, TYPOGRAPHIC, PLAIN)


def normal_text(t: Column) -> Column:
    """White space, then quotation marks and dashes, of text that is composed already."""
    return plain_marks(whitespace(t))
