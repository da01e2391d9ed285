"""Articles in containers of fixed capacity.

Articles are ordered along a Hilbert curve through a projection of their hashed token counts, the curve is cut into ranges,
and neighbours along a range are packed together: a window moves along the curve, the articles in it go largest first, each
into the fullest open container that still takes it, and a few containers with the most room stay open for the next window.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tokens import measured
from corpusmill.session import materialize

#: Pieces in a window along the curve: more of them fill containers better and reach farther along the curve.
WINDOW = 128
#: Containers that stay open from window to window.
OPEN = 16
#: Articles of a range, which one task packs as they come, and the most ranges; neither bounds what is packed.
RANGE, MOST_RANGES = 50_000, 10_000
#: Containers tables larger than this are an error: each capacity is a pass over a window.
MOST_CAPACITIES = 1000


def pieces(size: int, capacity: int) -> list[tuple[int, int]]:
    """First token and size of each piece; an article is cut only if it exceeds the capacity."""
    return [(a, min(capacity, size - a)) for a in range(0, size, capacity)]


class Packer:
    """Containers of one capacity; items are put in window by window, and OPEN containers go on to the next window."""

    def __init__(self, capacity: int, first: int = 0) -> None:
        self.capacity, self.made = capacity, first
        self.open: list[tuple[int, int]] = []  # (room, container), rising

    def put(self, sizes: np.ndarray) -> np.ndarray:
        """The container of each item of a window."""
        out = np.zeros(len(sizes), dtype=np.int64)
        for i in np.argsort(-sizes, kind="stable").tolist():
            size = int(sizes[i])
            at = bisect_left(self.open, (size, -1))
            if at < len(self.open):
                room, box = self.open.pop(at)
            else:
                room, box = self.capacity, self.made
                self.made += 1
            out[i] = box
            if room > size:
                insort(self.open, (room - size, box))
        del self.open[: max(0, len(self.open) - OPEN)]
        return out


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each item of one window: largest first, into the container with the least room that suffices."""
    return Packer(capacity).put(sizes)


_PACKED = "container_name string, container_id long, doc_id long, piece_idx int, first_token long, n_tokens long, curve long"


def _pack(capacities: list[tuple[str, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # ids of a range begin at a number of its own
        packers = {name: Packer(capacity, TaskContext.get().partitionId() << 40) for name, capacity in capacities}

        def window(ids: np.ndarray, sizes: np.ndarray, curve: np.ndarray) -> Iterator[pa.RecordBatch]:
            for name, packer in packers.items():
                cut = np.maximum(1, -(-sizes // packer.capacity))
                doc = np.repeat(np.arange(len(ids)), cut)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(cut) - cut, cut)
                size = np.minimum(packer.capacity, sizes[doc] - piece * packer.capacity)
                box = np.concatenate([packer.put(size[k : k + WINDOW]) for k in range(0, len(size), WINDOW)])
                yield pa.record_batch(
                    [pa.array([name] * len(doc), pa.string()), pa.array(box), pa.array(ids[doc]), pa.array(piece.astype(np.int32)), pa.array(piece * packer.capacity), pa.array(size), pa.array(curve[doc])],
                    names=["container_name", "container_id", "doc_id", "piece_idx", "first_token", "n_tokens", "curve"],
                )

        # windows do not depend on how rows come in batches
        held: list[list[np.ndarray]] = [[], [], []]
        for batch in batches:
            for part, name in zip(held, ("doc_id", "n_tokens", "curve"), strict=True):
                part.append(np.asarray(batch.column(name), dtype=np.int64))
            ids, sizes, curve = map(np.concatenate, held)
            full = len(ids) - len(ids) % WINDOW
            for k in range(0, full, WINDOW):
                yield from window(ids[k : k + WINDOW], sizes[k : k + WINDOW], curve[k : k + WINDOW])
            held = [[ids[full:]], [sizes[full:]], [curve[full:]]]
        if held[0] and len(held[0][0]):
            yield from window(*(x[0] for x in held))

    return run


def packed(documents: DataFrame, containers: DataFrame) -> DataFrame:
    """container_name, container_id, doc_id, piece_idx, first_token, n_tokens, curve: every article for each capacity.

    `documents` has doc_id (unique) and text, `containers` has container_name and token_capacity; rows of `containers`
    with a null or a capacity below 1 hold nothing. Articles without tokens are in no container. container_id is unique
    within a container_name. Equal articles lie together on the curve and are told apart by doc_id, so that they can be
    cut into ranges too. curve is the article's place along the curve.
    """
    asked = containers.where("container_name is not null and token_capacity > 0").select("container_name", F.col("token_capacity").cast("int")).distinct()
    capacities = sorted((r[0], r[1]) for r in asked.limit(MOST_CAPACITIES + 1).collect())
    if len(capacities) > MOST_CAPACITIES:
        raise ValueError(f"more than {MOST_CAPACITIES} containers")
    sizes = materialize(measured(documents, curve=True).where("n_tokens > 0"), "token-sizes")
    parts = min(MOST_RANGES, max(1, sizes.count() // RANGE))
    along = sizes.repartitionByRange(parts, "curve", "doc_id").sortWithinPartitions("curve", "doc_id")
    return along.select("doc_id", "n_tokens", "curve").mapInArrow(_pack(capacities), _PACKED)


def fill(packing: DataFrame, containers: DataFrame) -> DataFrame:
    """container_name, n_containers, n_pieces, n_tokens, fill_share and curve_span of a packing.

    curve_span is the mean, over the containers, of the way along the curve from their first to their last article, as a
    share of the way from the first to the last article of all: the smaller it is, the nearer to each other are the
    articles of a container.
    """
    total = packing.groupBy("container_name", "container_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n"), F.min("curve").alias("low"), F.max("curve").alias("high"))
    way = F.avg(F.col("high") - F.col("low")) / F.greatest(F.max("high") - F.min("low"), F.lit(1))
    each = total.groupBy("container_name").agg(F.count("*").alias("n_containers"), F.sum("n").alias("n_pieces"), F.sum("t").alias("n_tokens"), way.alias("curve_span"))
    share = F.col("n_tokens") / (F.col("n_containers") * F.col("token_capacity"))
    return each.join(containers, "container_name").select("container_name", "n_containers", "n_pieces", "n_tokens", share.alias("fill_share"), "curve_span")


def checked(packing: DataFrame, containers: DataFrame) -> DataFrame:
    """container_name, doc_id, whole, fits: for each article whether its pieces follow each other from its first token, all
    but the last of them as large as the container; and whether none of its containers holds more than its capacity."""
    loads = packing.groupBy("container_name", "container_id").agg(F.sum("n_tokens").alias("load"))
    asked = containers.select("container_name", "token_capacity")
    rows = packing.join(loads, ["container_name", "container_id"]).join(F.broadcast(asked), "container_name")  # at most MOST_CAPACITIES rows
    right = (F.col("first_token") == F.col("piece_idx") * F.col("token_capacity")) & (F.col("n_tokens") > 0) & (F.col("n_tokens") <= F.col("token_capacity"))
    full = F.sum((F.col("n_tokens") == F.col("token_capacity")).cast("int"))
    whole = F.every(right) & (F.max("piece_idx") == F.count("*") - 1) & (F.count_distinct("piece_idx") == F.count("*")) & (full >= F.count("*") - 1)
    return rows.groupBy("container_name", "doc_id").agg(whole.alias("whole"), F.every(F.col("load") <= F.col("token_capacity")).alias("fits"))
