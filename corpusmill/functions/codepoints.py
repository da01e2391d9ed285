"""Vectorised work on the code points of whole batches of strings."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

#: Characters that a kernel takes at once; bounds the memory of a Python worker, whatever the size of an Arrow batch.
CHUNK_CHARS = 1 << 20
_U64 = np.uint64


def flat_sections(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row, position in the row and value of each element of a list column; null lists have none."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.asarray(lists.value_lengths().fill_null(0), dtype=np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    return rows, np.arange(len(rows)) - first[rows], lists.flatten()


def chunks(texts: list[str | None], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of `texts` of about `limit` characters each; a longer text makes a range of its own."""
    begin = size = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if size and size + n > limit:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield begin, len(texts)


def decode(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of `texts` one after another, and where each text begins (one more entry: the end)."""
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) if t else 0 for t in texts], out=starts[1:])
    points = np.frombuffer("".join(t for t in texts if t).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return points, starts


@cache
def fold_table() -> np.ndarray:
    """For each code point its lower-case form, or 0 where it is neither letter nor digit."""
    points = np.arange(0x110000, dtype=np.uint32)
    valid = (points < 0xD800) | (points > 0xDFFF)
    text = points[valid].tobytes().decode("utf-32-le")
    alnum = np.zeros(0x110000, dtype=bool)
    alnum[valid] = np.char.isalnum(np.frombuffer(text.encode("utf-32-le"), dtype="<U1"))
    # only U+0130 has a lower-case form of two characters; sigma's depends on its place
    lower = text.replace("İ", "i").replace("Σ", "σ").replace("ς", "σ").lower()
    table = np.zeros(0x110000, dtype=np.uint32)
    table[valid] = np.frombuffer(lower.encode("utf-32-le"), dtype=np.uint32)
    return np.where(alnum, table, 0).astype(np.uint32)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """The finaliser of splitmix64: 64 well spread bits from 64."""
    with np.errstate(over="ignore"):
        x = x.astype(_U64) + _U64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
        x ^= x >> _U64(30)
        x *= _U64(0xBF58476D1CE4E5B9)
        x ^= x >> _U64(27)
        x *= _U64(0x94D049BB133111EB)
        x ^= x >> _U64(31)
    return x


class Powers:
    """Powers of an odd base modulo 2^64, kept and extended as longer texts come."""

    def __init__(self, base: int) -> None:
        self.base, self.known = _U64(base), np.ones(1, dtype=_U64)

    def upto(self, n: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            while len(self.known) < n:
                self.known = np.concatenate([self.known, self.known * (self.known[-1] * self.base)])
        return self.known[:n]


POWERS = (Powers(0x9E3779B97F4A7C15), Powers(0xC2B2AE3D27D4EB4F))


def segment_sum(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the runs of `values` between `starts`, modulo 2^64; empty runs give 0."""
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, dtype=_U64), np.cumsum(values, dtype=_U64)])
        return total[starts[1:]] - total[starts[:-1]]


def rolling_hashes(points: np.ndarray, starts: np.ndarray, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two polynomial hashes of the kept code points of each text, and how many were kept.

    Characters are skipped by giving them no place in the polynomial; no folded string is made.
    """
    if keep is not None:
        place = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(keep)])
        points, starts = points[keep], place[starts]
    sizes = np.diff(starts)
    at = np.arange(len(points)) - np.repeat(starts[:-1], sizes)
    longest = int(sizes.max()) if len(sizes) else 0
    with np.errstate(over="ignore"):
        one, two = (segment_sum(mix(points, k) * p.upto(longest)[at], starts) for k, p in enumerate(POWERS))
    return one, two, sizes
