"""Pages that differ only in formatting: white space, case, punctuation or the order of their sections.

Method: the code points of a page run through a skip-and-fold table into two rolling polynomial hashes per section; the
section hashes are added up after mixing, so that their order does not matter. Canonical strings are never made. Pages
whose hashes collide are compared with two pointers that skip what does not count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.codepoints import chunks, decode, flat_sections, fold_table, mix, rolling_hashes, segment_sum
from corpusmill.functions.prefilter import key_filter
from corpusmill.session import materialize, salted_join

#: Characters that the two pointers take in at a time.
BLOCK = 1 << 12


def section_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes for each text of what remains of it when only letters and digits count, ignoring case."""
    one, two = (np.zeros(len(texts), dtype=np.uint64) for _ in range(2))
    table = fold_table()
    for begin, end in chunks(texts):
        points, starts = decode(texts[begin:end])
        folded = table[points]
        a, b, sizes = rolling_hashes(folded, starts, folded != 0)
        one[begin:end], two[begin:end] = mix(a ^ mix(sizes)), mix(b ^ mix(sizes, 1), 2)
    return one, two


def _page_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("text_list")
        rows, _, texts = flat_sections(lists)
        one, two = section_hashes(texts.to_pylist())
        starts = np.searchsorted(rows, np.arange(len(lists) + 1))
        some = np.diff(starts) > 0
        keys = [pa.array(segment_sum(h, starts).view(np.int64)[some]) for h in (one, two)]
        page = batch.column("page_id").filter(pa.array(some))
        yield pa.record_batch([page, *keys, pa.array(np.diff(starts)[some])], names=["page_id", "key_1", "key_2", "n_sections"])


class Skipping:
    """The letters and digits of a text, folded, a block at a time."""

    def __init__(self, text: str) -> None:
        self.text, self.at, self.rest = text, 0, np.zeros(0, dtype=np.uint32)

    def more(self) -> bool:
        """Move on to the next character that counts; False at the end."""
        while not len(self.rest) and self.at < len(self.text):
            points = np.frombuffer(self.text[self.at : self.at + BLOCK].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            self.at += BLOCK
            folded = fold_table()[points]
            self.rest = folded[folded != 0]
        return len(self.rest) > 0


def same_when_folded(a: str | None, b: str | None) -> bool:
    """Whether two texts hold the same letters and digits in the same order, ignoring case."""
    left, right = Skipping(a or ""), Skipping(b or "")
    while left.more() & right.more():
        n = min(len(left.rest), len(right.rest))
        if not np.array_equal(left.rest[:n], right.rest[:n]):
            return False
        left.rest, right.rest = left.rest[n:], right.rest[n:]
    return not len(left.rest) and not len(right.rest)


def same_pages(a: list[str | None], b: list[str | None]) -> bool:
    """Whether two pages hold the same sections, as often, in any order."""
    if len(a) != len(b):
        return False
    orders = [np.lexsort(section_hashes(x)) for x in (a, b)]
    return all(same_when_folded(a[i], b[j]) for i, j in zip(*orders, strict=True))


def strict_key(page: list[str | None]) -> bytes:
    """A digest of the folded page, for the case that two different pages share their hashes."""
    import hashlib

    parts = sorted("".join(map(chr, (f := fold_table()[decode([s])[0]])[f != 0])) for s in page)
    return hashlib.blake2b("\x00".join(parts).encode(), digest_size=16).digest()


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages, firsts = batch.column("text_list").to_pylist(), batch.column("first_list").to_pylist()
        strict = [None if same_pages(a, b) else strict_key(a) for a, b in zip(pages, firsts, strict=True)]
        yield pa.record_batch([batch.column("first_page_id"), batch.column("page_id"), pa.array(strict, pa.binary())], names=["first_page_id", "page_id", "strict"])


def page_copies(pages: DataFrame) -> DataFrame:
    """first_page_id and page_id: one row for each page, those without copies too; pages without sections have none.

    `pages` has page_id and text_list; a page given in several rows counts once (its rows hold the same content; should
    they not, the row with the smallest hashes stands for the page). Null and empty lists, and null page ids, are no
    pages with sections and give no row. Null sections count as empty ones. A section without letters and digits equals
    every other such section. Other columns of `pages` are ignored.

    At scale: only hashes of fixed size are shuffled for all pages; the groups are made by a partially aggregated
    groupBy; the text moves for those pages alone whose hashes occur more than once, and hot groups are salted.
    """
    pages = pages.select("page_id", "text_list").where(F.col("page_id").isNotNull())
    keys = pages.mapInArrow(_page_keys, "page_id long, key_1 long, key_2 long, n_sections long")
    once = keys.groupBy("page_id").agg(F.min(F.struct("key_1", "key_2", "n_sections")).alias("k")).select("page_id", "k.*")
    once = materialize(once, "page-keys")
    by = ["key_1", "key_2", "n_sections"]
    groups = once.groupBy(*by).agg(F.min("page_id").alias("first_page_id"), F.count("*").alias("n"))
    alone = groups.where("n = 1").select("first_page_id", F.col("first_page_id").alias("page_id"))
    several = groups.where("n > 1").drop("n")
    members = materialize(salted_join(once, several, by).select("first_page_id", "page_id"), "page-members")
    wanted = key_filter(members, "page_id")

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(wanted(np.asarray(batch.column("page_id"), dtype=np.int64)) & np.asarray(batch.column("text_list").is_valid())))

    # the copies of a page are alike: dropDuplicates takes any of its rows
    texts = pages.mapInArrow(thin, pages.schema).join(members, "page_id").dropDuplicates(["page_id"])
    texts = materialize(texts, "page-texts")
    firsts = texts.where("page_id = first_page_id").select("first_page_id", F.col("text_list").alias("first_list"))
    others = texts.where("page_id <> first_page_id")
    seen = salted_join(others, firsts, ["first_page_id"]).select("first_page_id", "page_id", "text_list", "first_list")
    seen = materialize(seen.mapInArrow(_verify, "first_page_id long, page_id long, strict binary"), "page-verified")
    same = seen.where("strict is null").select("first_page_id", "page_id")
    clashing = seen.where("strict is not null")
    apart = clashing.groupBy("first_page_id", "strict").agg(F.min("page_id").alias("own"))
    moved = clashing.join(apart, ["first_page_id", "strict"]).select(F.col("own").alias("first_page_id"), "page_id")
    heads = members.where("page_id = first_page_id")
    return alone.unionByName(heads).unionByName(same).unionByName(moved)


def copy_counts(pages: DataFrame) -> DataFrame:
    """page_id, n_copies: one page of each group, the smallest, with the number of pages in the group."""
    return page_copies(pages).groupBy(F.col("first_page_id").alias("page_id")).agg(F.count("*").alias("n_copies"))
