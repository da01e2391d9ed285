"""Sections that share most of their five-character pieces, by SetSketch registers.

Every piece of a section throws points of a Poisson process at the registers; a register keeps the smallest, on an
exponential scale cut off at one byte, so that the registers of a union are the maxima of the registers. Sections that
agree in a whole band of registers are candidates; a joint likelihood of the registers drops those that are far from the
threshold; the rest are verified on their texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from corpusmill.functions.codepoints import chunks, decode, flat_sections, fold_table, mix
from corpusmill.functions.prefilter import key_filter
from corpusmill.session import materialize, salted_join


@dataclass(frozen=True)
class Sketching:
    """piece: characters of a piece. registers, rows: size of the sketch and of a band; the bands come from `deals` ways
    of dealing the registers. base, top: scale of the registers and its cut."""

    piece: int = 5
    threshold: float = 0.8
    registers: int = 144
    rows: int = 9
    deals: int = 3
    base: float = 1.06
    top: int = 255

    @property
    def bands(self) -> np.ndarray:
        """The registers of each band."""
        orders = [np.random.default_rng(k).permutation(self.registers) for k in range(self.deals)]
        return np.concatenate(orders).reshape(-1, self.rows)


DEFAULT = Sketching()
#: Value of a register that no point but a very late one has reached: -log_base of the latest time that counts.
_LATEST = 8.0


def normal_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts in lower case, each run of other characters than letters and digits one blank, trimmed."""
    lowered = [t.lower() if t else "" for t in texts]
    points, starts = decode(lowered)
    alnum = fold_table()[points] != 0
    n = len(points)
    first = np.zeros(n, dtype=bool)
    first[starts[:-1][starts[:-1] < n]] = True
    before = np.concatenate([[False], alnum[:-1]]) & ~first  # the character before, in the same text, is kept
    keep = alnum | before
    keep_at = np.concatenate([[0], np.cumsum(keep)])
    kept = np.where(alnum, points, 32)[keep].astype(np.uint32)
    places = keep_at[starts]
    # a blank at the end of a text goes
    ends = places[1:][places[1:] > places[:-1]] - 1
    last = np.zeros(len(kept), dtype=bool)
    last[ends] = True
    drop = last & (kept == 32)
    return kept[~drop], np.concatenate([[0], np.cumsum(~drop)])[places]


def text_hashes(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each whole text."""
    places = starts.tolist()
    return np.array([xxh3_64_intdigest(points[a:b].tobytes()) for a, b in zip(places, places[1:])], dtype=np.uint64)


def piece_hashes(points: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each piece of `size` characters and the text it is of; a shorter text is one piece itself."""
    n = len(points)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    with np.errstate(over="ignore"):
        h = np.zeros(max(0, n - size + 1), dtype=np.uint64)
        for k in range(size):
            h *= np.uint64(0x100000001B3)
            h += points[k : k + len(h)]
        whole = owner[: len(h)] == owner[size - 1 :] if len(h) else np.zeros(0, dtype=bool)
        h, of = mix(h[whole]), owner[: len(h)][whole]
    short = np.flatnonzero((np.diff(starts) > 0) & (np.diff(starts) < size))
    if len(short):
        h, of = np.concatenate([h, text_hashes(points, starts)[short]]), np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        h, of = h[order], of[order]
    return h, of


#: Odd factors that give each turn bits of its own from one well mixed hash.
_TURNS = mix(np.arange(64), 21) | np.uint64(1)


def sketch(h: np.ndarray, of: np.ndarray, n: int, how: Sketching) -> np.ndarray:
    """Registers of `n` sets, given the hashes of their members; a set without members has zeros throughout.

    Each member's points come in rising order, the time to the next exponential with rate `registers`, the register at
    random: so each register sees an exponential of rate 1 from each member, independently. A member is done when its
    next point is too late for every register of its set.
    """
    m = how.registers
    held = np.zeros(n * m, dtype=np.uint8)
    scale = 1.0 / np.log(how.base)
    shift = np.log(_LATEST) * scale
    at = np.zeros(len(h), dtype=np.float32)
    turn = 0
    while len(h):
        bits = h * _TURNS[turn % len(_TURNS)] + np.uint64(turn)
        bits ^= bits >> np.uint64(32)
        bits *= np.uint64(0xD6E8FEB86659FD93)
        gap = -np.log(((bits >> np.uint64(40)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-24))
        at = at + gap * np.float32(1.0 / m)
        value = np.clip(shift - np.log(at) * np.float32(scale), 0, how.top).astype(np.uint8)
        np.maximum.at(held, of * m + ((bits & np.uint64(0xFFFFFFFF)) * np.uint64(m) >> np.uint64(32)).astype(np.int64), value)
        lowest = held.reshape(n, m).min(axis=1)
        alive = (value > lowest[of]) | ((lowest[of] == 0) & (at < _LATEST))
        h, of, at = h[alive], of[alive], at[alive]
        turn += 1
    return held.reshape(n, m)


def cardinality(held: np.ndarray, how: Sketching) -> np.ndarray:
    """Number of different members, up to a factor that is the same for all sketches."""
    return held.shape[1] / np.power(how.base, -held.astype(np.float64)).sum(axis=1)


#: Step of the size class in the low byte of a class id, and how many steps the sizes of similar sets can be apart: a
#: ratio of 0.8, and four standard errors of the ratio of two estimates that share most registers.
_SIZE_STEP, _SIZE_APART = 1.05, 10


def joint_similarity(a: np.ndarray, b: np.ndarray, how: Sketching) -> np.ndarray:
    """Most likely Jaccard similarity of pairs of sketches, their sizes being estimated from the registers.

    With u and v the shares of members that only one side has, a register of a is larger with a probability that falls
    with v, and so on; the likelihood of the numbers of larger, smaller and equal registers is taken over a grid.
    """
    larger, smaller = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - larger - smaller
    grid = np.linspace(0, 1, 201)[None, :]
    n_a, n_b = cardinality(a, how), cardinality(b, how)
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u

    def p(x: np.ndarray) -> np.ndarray:  # chance that an exponential comes first by at least one step of the scale
        return np.maximum(-np.log(np.clip(1 - x * (how.base - 1) / how.base, 1e-12, 1)) / np.log(how.base), 1e-12)

    more_a, more_b = p(np.clip(u - v * grid, 0, 1)), p(np.clip(v - u * grid, 0, 1))
    both = np.clip(1 - more_a - more_b, 1e-12, 1)
    likely = larger[:, None] * np.log(more_a) + smaller[:, None] * np.log(more_b) + equal[:, None] * np.log(both)
    return grid[0][np.argmax(likely, axis=1)]


def _sketches(how: Sketching):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, values = flat_sections(batch.column("text_list"))
            texts, pages = values.to_pylist(), np.asarray(batch.column("page_id"), dtype=np.int64)[rows]
            for begin, end in chunks(texts, 1 << 19):
                points, starts = normal_points(texts[begin:end])
                held = sketch(*piece_hashes(points, starts, how.piece), end - begin, how)
                size = np.clip(np.log(cardinality(held, how)) / np.log(_SIZE_STEP), 0, 255).astype(np.uint64)
                key = (text_hashes(points, starts) & ~np.uint64(255)) | size
                letters = points != 32
                bare = text_hashes(points[letters], np.concatenate([[0], np.cumsum(letters)])[starts])
                some = np.diff(starts) > 0
                yield pa.record_batch(
                    [pa.array(pages[begin:end][some]), pa.array(places[begin:end][some].astype(np.int32)), *(pa.array(x.view(np.int64)[some]) for x in (key, bare)), pa.array([r.tobytes() for r in held[some]], pa.binary())],
                    names=["page_id", "sec_idx", "key", "bare", "registers"],
                )

    return run


def _bands(how: Sketching):
    bands = how.bands
    number, words = mix(np.arange(len(bands))), -(-how.rows // 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column("registers").to_pylist()), dtype=np.uint8).reshape(-1, how.registers)
            # the registers of a band, eight to a word
            packed = np.zeros((len(held), len(bands), words * 8), dtype=np.uint8)
            packed[:, :, : how.rows] = held[:, bands]
            packed = packed.view(np.uint64)
            h = np.broadcast_to(number, packed.shape[:2])
            for k in range(words):
                h = mix(packed[:, :, k] ^ h, k)
            ids = np.repeat(np.asarray(batch.column("key"), dtype=np.int64), len(bands))
            # 44 bits keep the shuffled rows short; a chance collision is one more candidate
            yield pa.record_batch([pa.array((h.ravel() >> np.uint64(20)).view(np.int64)), pa.array(ids)], names=["band", "key"])

    return run


def _likely(how: Sketching):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), 2000):
                part = batch.slice(begin, 2000)
                a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), dtype=np.uint8).reshape(-1, how.registers) for c in ("registers_a", "registers_b"))
                # three standard errors of the estimate under the threshold: what is dropped has no chance
                least = how.threshold - 3 * np.sqrt(how.threshold * (1 - how.threshold) / how.registers) - 0.02
                near = (a == b).mean(axis=1) > least - 0.05  # a quick look; equal registers are more than equal members
                near[near] = joint_similarity(a[near], b[near], how) > least
                yield part.select(["key_a", "key_b"]).filter(pa.array(near))

    return run


def _similarity(how: Sketching):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(len(batch))
            for begin in range(0, len(batch), 200):
                part = batch.slice(begin, 200)
                sets = []
                for name in ("text_a", "text_b"):
                    h, of = piece_hashes(*normal_points(part.column(name).to_pylist()), how.piece)
                    cut = np.searchsorted(of, np.arange(len(part) + 1))
                    sets.append([np.unique(h[cut[i] : cut[i + 1]]) for i in range(len(part))])
                for i, (x, y) in enumerate(zip(*sets, strict=True)):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    out[begin + i] = common / max(1, len(x) + len(y) - common)
            yield pa.record_batch([batch.column("key_a"), batch.column("key_b"), pa.array(out)], names=["key_a", "key_b", "similarity"])

    return run


def _links(pages: DataFrame, how: Sketching) -> tuple[DataFrame, DataFrame]:
    """Members (page_id, sec_idx, key) and links between different texts (key_a < key_b, similarity, same_bare)."""
    pages = pages.select("page_id", "text_list").where(F.col("page_id").isNotNull())
    every = pages.mapInArrow(_sketches(how), "page_id long, sec_idx int, key long, bare long, registers binary")
    every = materialize(every, "sketches")
    members = every.select("page_id", "sec_idx", "key", "bare").dropDuplicates(["page_id", "sec_idx"])
    # one section of each text stands for its copies, which are dropped before the shuffle where they meet
    heads = materialize(every.dropDuplicates(["key"]), "sketch-heads")
    bands = heads.select("key", "registers").mapInArrow(_bands(how), "band long, key long")
    # both sides are one and the same exchange; a hot band is split by the adaptive skew join
    a, b = (bands.toDF("band", f"key_{s}") for s in "ab")
    size = lambda c: F.col(c).bitwiseAND(F.lit(255))
    close = F.abs(size("key_a") - size("key_b")) <= _SIZE_APART
    pairs = a.join(b, "band").where((F.col("key_a") < F.col("key_b")) & close).select("key_a", "key_b").distinct()
    side = lambda s: heads.select(F.col("key").alias(f"key_{s}"), F.col("registers").alias(f"registers_{s}"))
    likely = pairs.join(side("a"), "key_a").join(side("b"), "key_b").mapInArrow(_likely(how), "key_a long, key_b long")
    likely = materialize(likely, "likely-pairs")
    wanted = likely.select(F.explode(F.array("key_a", "key_b")).alias("key")).distinct()
    at = materialize(heads.select("key", "page_id", "sec_idx", "bare").join(wanted, "key"), "wanted")
    among = key_filter(at, "page_id")

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(among(np.asarray(batch.column("page_id"), dtype=np.int64)) & np.asarray(batch.column("text_list").is_valid())))

    sections = pages.mapInArrow(thin, pages.schema).select("page_id", F.posexplode("text_list").alias("sec_idx", "text"))
    texts = materialize(sections.join(at, ["page_id", "sec_idx"]).dropDuplicates(["key"]).select("key", "bare", "text"), "wanted-texts")
    side = lambda s: texts.toDF(f"key_{s}", f"bare_{s}", f"text_{s}")
    both = likely.join(side("a"), "key_a").join(side("b"), "key_b")
    same = both.select("key_a", "key_b", (F.col("bare_a") == F.col("bare_b")).alias("same_bare"))
    done = both.select("key_a", "key_b", "text_a", "text_b").mapInArrow(_similarity(how), "key_a long, key_b long, similarity double")
    links = done.where(F.col("similarity") > how.threshold).join(same, ["key_a", "key_b"])
    return members, materialize(links, "links")


def near_sections(pages: DataFrame, how: Sketching = DEFAULT) -> DataFrame:
    """page_a, sec_a, page_b, sec_b, similarity: pairs of sections whose pieces overlap by more than the threshold.

    Pairs equal in letters and digits alone, ignoring case, are left out; (page_a, sec_a) is the smaller key. `pages` has
    page_id and text_list, other columns are ignored; a page in several rows counts once; null lists, null pages and
    sections without letters or digits make no pairs; a section shorter than a piece is one piece.
    Sections of equal text are one class while similarities are found, however many there are.
    """
    members, links = _links(pages, how)
    links = links.where("not same_bare").select("key_a", "key_b", "similarity")
    # links per class stay few; a class of many copies is dealt over salts
    side = lambda s: members.select(F.col("key").alias(f"key_{s}"), F.col("page_id").alias(f"p_{s}"), F.col("sec_idx").alias(f"s_{s}"))
    pairs = links.join(side("a"), "key_a").join(side("b"), "key_b")
    x, y = F.struct(F.col("p_a").alias("p"), F.col("s_a").alias("s")), F.struct(F.col("p_b").alias("p"), F.col("s_b").alias("s"))
    low, high = F.least(x, y), F.greatest(x, y)
    return pairs.select(low["p"].alias("page_a"), low["s"].alias("sec_a"), high["p"].alias("page_b"), high["s"].alias("sec_b"), "similarity")


def near_classes(pages: DataFrame, how: Sketching = DEFAULT) -> DataFrame:
    """page_id, sec_idx, class_id, n_links: each section with letters or digits, the class of its text, and to how many
    other classes it is linked. Copies are not expanded into pairs; no link between different texts is lost."""
    members, links = _links(pages, how)
    ends = links.select(F.explode(F.array("key_a", "key_b")).alias("key")).groupBy("key").agg(F.count("*").alias("n_links"))
    counted = salted_join(members.select("page_id", "sec_idx", "key"), ends, ["key"], how="left")
    return counted.select("page_id", "sec_idx", F.col("key").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
