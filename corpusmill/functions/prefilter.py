"""A membership filter over a key column, sized by the number of keys, to thin a scan before its texts are shuffled."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.codepoints import mix

#: Bits of the filter for each key: two places of 16 bits let 1.4 % of the other keys through.
BITS_PER_KEY = 16
#: Least and largest size of a filter in bits. The largest (32 MB) is for 16 million keys; with more keys no filter is made
#: and every row goes on to the join that follows, which costs a shuffle and changes no result.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28


class KeyFilter:
    """Whether a key may be among those the filter was built from; never wrong about those that are.

    Without words every key may be.
    """

    def __init__(self, words: np.ndarray | None) -> None:
        self.words = words

    @staticmethod
    def places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        h = mix(keys.astype(np.int64).view(np.uint64), 7)
        last = np.uint64(bits - 1)
        return h & last, (h >> np.uint64(32)) & last

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), dtype=bool)
        if self.words is None:
            return found
        for at in self.places(keys, 64 * len(self.words)):
            found &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return found


def key_filter(df: DataFrame, key: str) -> KeyFilter:
    """A filter over the keys of `df`, which is read twice: to count the keys and to gather the filter's words.

    `df` should be a written table or cheap to make. The driver gathers at most MOST_BITS / 64 words.
    """
    keys = df.select(F.col(key).cast("long").alias("key")).where("key is not null")
    n = keys.count()
    bits = max(LEAST_BITS, 1 << (max(1, n * BITS_PER_KEY) - 1).bit_length())
    if bits > MOST_BITS:
        return KeyFilter(None)
    held = np.zeros(bits // 64, dtype=np.uint64)
    if not n:
        return KeyFilter(held)

    def words(batches):
        import pyarrow as pa

        for batch in batches:
            at = np.concatenate(KeyFilter.places(np.asarray(batch.column(0), dtype=np.int64), bits))
            place, bit = (at >> np.uint64(6)).astype(np.int32), np.uint64(1) << (at & np.uint64(63))
            order = np.argsort(place, kind="stable")
            place, bit = place[order], bit[order]
            first = np.flatnonzero(np.diff(place, prepend=-1))
            yield pa.record_batch([pa.array(place[first]), pa.array(np.bitwise_or.reduceat(bit, first).view(np.int64) if len(first) else bit.view(np.int64))], names=["place", "bits"])

    gathered = keys.mapInArrow(words, "place int, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits"))
    table = gathered.toArrow()
    held[np.asarray(table["place"])] = np.asarray(table["bits"], dtype=np.int64).view(np.uint64)
    return KeyFilter(held)
