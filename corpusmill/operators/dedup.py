"""Removal of near-duplicate sections by MinHash signatures of character n-grams, bands, and a greedy walk over pairs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.schemas import DUPLICATE_MARK
from corpusmill.session import materialize, salted_join


@dataclass(frozen=True)
class Banding:
    """Length of n-grams and signatures, rows of a band, and the similarity above which sections are duplicates."""

    gram_len: int = 5
    signature_len: int = 128
    band_size: int = 16
    similarity_threshold: float = 0.8

    def __post_init__(self) -> None:
        if self.signature_len % self.band_size:
            raise ValueError(f"band_size {self.band_size} does not divide signature_len {self.signature_len}")


def ngrams(text: Column, n: int) -> Column:
    """Distinct n-grams of a text, in the order of their first places; null for texts shorter than n.

    One pass of a look-ahead; it does not begin inside a pair of surrogates.
    """
    every = F.regexp_extract_all(text, F.lit(rf"(?s)(?!\p{{Cs}})(?=(.{{{n}}}))"), F.lit(1))
    return F.when(F.length(text) >= n, F.array_distinct(every))


def murmur3(data: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The 32-bit x86 variant of the public hash MurmurHash3 for rows of equal length (bytes), for each of the seeds."""
    u = np.uint32
    turn = lambda x, r: (x << u(r)) | (x >> u(32 - r))
    rows, size = data.shape
    h = np.broadcast_to(seeds.astype(u), (rows, len(seeds))).copy()
    with np.errstate(over="ignore"):
        for at in range(0, size, 4):
            block = data[:, at : at + 4].astype(u)
            k = sum((block[:, i] << u(8 * i) for i in range(block.shape[1])), np.zeros(rows, u))
            k = turn(k * u(0xCC9E2D51), 15) * u(0x1B873593)
            h ^= k[:, None]
            if block.shape[1] == 4:
                h = turn(h, 13) * u(5) + u(0xE6546B64)
        h ^= u(size)
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            h = (h ^ (h >> u(shift))) * u(factor)
        return (h ^ (h >> u(16))).view(np.int32)


class Grams:
    """Hashes of the n-grams met, a row of `signature_len` each; a worker hashes an n-gram once while it holds it.

    When MOST n-grams are held (50 MB at 128 hashes) they are forgotten; this bounds memory and changes no hash.
    """

    MOST = 100_000

    def __init__(self, how: Banding) -> None:
        self.how, self.seeds = how, np.arange(how.signature_len, dtype=np.uint32)
        self.ids: dict[str, int] = {}
        self.table = np.empty((0, how.signature_len), dtype=np.int32)

    def learn(self, grams: set[str]) -> None:
        fresh = [g for g in grams if g not in self.ids]
        if len(self.ids) + len(fresh) > self.MOST:
            self.ids, fresh = {}, list(grams)
        if not fresh:
            return
        first = len(self.ids)
        if first + len(fresh) > len(self.table):
            room = np.empty((max(2 * len(self.table), first + len(fresh)), self.how.signature_len), dtype=np.int32)
            room[:first] = self.table[:first]
            self.table = room
        coded = [g.encode("utf-8", "surrogatepass") for g in fresh]
        sizes = np.array([len(c) for c in coded])
        for size in np.unique(sizes):
            for at in np.array_split(np.flatnonzero(sizes == size), 1 + len(coded) // 8192):
                self.table[first + at] = murmur3(np.frombuffer(b"".join([coded[k] for k in at]), np.uint8).reshape(len(at), size), self.seeds)
        self.ids.update(zip(fresh, range(first, first + len(fresh))))

    def least(self, text: str) -> np.ndarray:
        """The least hash of the text's n-grams for each seed."""
        n, size = self.how.gram_len, 1 << 14
        out = np.full(self.how.signature_len, np.iinfo(np.int32).max, dtype=np.int32)
        for begin in range(0, len(text) - n + 1, size):  # a long text has its n-grams hashed part by part
            grams = {text[k : k + n] for k in range(begin, min(begin + size, len(text) - n + 1))}
            self.learn(grams)
            np.minimum(out, self.table[np.fromiter(map(self.ids.__getitem__, grams), np.int64, len(grams))].min(axis=0), out=out)
        return out


def minhash(texts: list[str | None], how: Banding, grams: Grams | None = None) -> list[np.ndarray | None]:
    """Signature of each text: the least signed hash of its n-grams for each seed; none for texts shorter than an n-gram."""
    grams = grams or Grams(how)
    known: dict[str, np.ndarray] = {}  # texts that come again
    out: list[np.ndarray | None] = []
    for t in texts:
        if t is None or len(t) < how.gram_len:
            out.append(None)
            continue
        if t not in known:
            known[t] = grams.least(t)
        out.append(known[t])
    return out


def _sign(how: Banding):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(how)
        for batch in batches:
            signed = minhash(batch.column("text").to_pylist(), how, grams)
            keep = [i for i, s in enumerate(signed) if s is not None]
            rows = batch.take(pa.array(keep, pa.int64()))
            flat = pa.array(np.concatenate([signed[i] for i in keep]) if keep else np.zeros(0, np.int32))
            sig = pa.ListArray.from_arrays(pa.array(np.arange(len(keep) + 1, dtype=np.int32) * how.signature_len), flat)
            yield pa.RecordBatch.from_arrays([rows.column("page_id"), rows.column("idx"), sig], names=["page_id", "idx", "sig"])

    return run


def signatures(pages: DataFrame, how: Banding = Banding()) -> DataFrame:
    """page_id, idx, sig of each section of `pages` (page_id, text_list) that is long enough to have n-grams."""
    texts = pages.select("page_id", F.posexplode("text_list").alias("idx", "text")).where("text is not null")
    return texts.mapInArrow(_sign(how), "page_id long, idx int, sig array<int>")


def similarity(a: Column, b: Column, how: Banding) -> Column:
    """Share of equal places of two signatures."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x) / F.lit(how.signature_len)


def _at():
    return F.struct("page_id", "idx")


def signature_classes(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """at, sig: the last section of each signature; and at, last: every other section with the one that stands for it.

    `signed` has at (place) and sig. Sections of one signature share all bands, whether their texts are equal or not.
    """
    lasts = materialize(signed.groupBy("sig").agg(F.max("at").alias("last"), F.count("*").alias("n")), "kinds")
    members = salted_join(signed.select("sig", "at"), lasts.where("n > 1").select("sig", "last"), ["sig"])
    return lasts.select(F.col("last").alias("at"), "sig"), members.where(F.col("at") < F.col("last")).select("at", "last")


def candidates(kinds: DataFrame, how: Banding) -> DataFrame:
    """band, first_in_band, a, b: pairs of sections that share a band, in the order of their places; first_in_band is the
    first place of the bucket. `kinds` has at (place) and sig, one row for each distinct signature.

    The join is on the band's key; the adaptive skew join splits hot ones."""
    size = how.band_size
    bands = F.transform(F.sequence(F.lit(0), F.lit(how.signature_len // size - 1)), lambda b: F.struct(b.alias("band"), F.xxhash64(F.slice("sig", b * size + 1, F.lit(size))).alias("key")))
    rows = kinds.select("at", F.inline(bands))
    buckets = rows.groupBy("band", "key").agg(F.min("at").alias("first_in_band"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = materialize(salted_join(rows, buckets, ["band", "key"]), "band-rows")
    a, b = rows.withColumnRenamed("at", "a"), rows.select("band", "key", F.col("at").alias("b"))
    return a.join(b, ["band", "key"]).where(F.col("a") < F.col("b")).select("band", "first_in_band", "a", "b")


def verified_edges(kinds: DataFrame, how: Banding) -> DataFrame:
    """first (band, first_in_band), a, b: candidate pairs whose signatures agree in more than the threshold's share of places."""
    pairs = candidates(kinds, how).groupBy("a", "b").agg(F.min(F.struct("band", "first_in_band")).alias("first"))
    sig = lambda s: kinds.select(F.col("at").alias(s), F.col("sig").alias(f"sig_{s}"))
    both = pairs.join(sig("a"), "a").join(sig("b"), "b")
    return both.where(similarity(F.col("sig_a"), F.col("sig_b"), how) > how.similarity_threshold).select("first", "a", "b")


#: Pairs of one component that are walked in one task; larger components are walked in rounds over all tasks.
PAIRS_IN_TASK = 100_000


def _components(edges: DataFrame) -> DataFrame:
    """node, component: the least node that links reach, by spreading least labels along links and shortcuts."""
    ends = materialize(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))), "links")
    labels = materialize(ends.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("label")), "labels")
    while True:
        near = ends.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("seen"))
        new = labels.join(near, "node").select("node", F.least("label", "seen").alias("to"), "label")
        # jump to the label's own label, so that long chains shrink by half in each round
        far = labels.select(F.col("node").alias("to"), F.col("label").alias("jump"))
        new = materialize(new.join(far, "to", "left").select("node", F.least("to", F.coalesce("jump", "to")).alias("new"), "label"), "labels")
        if not new.where("new <> label").limit(1).count():
            return new.select("node", F.col("new").alias("component"))
        labels = new.select("node", F.col("new").alias("label"))


def _walk(pairs: pd.DataFrame) -> pd.DataFrame:
    """The greedy walk over one component: of a pair with both still there, the earlier goes."""
    key = lambda v: tuple(key(x) for x in v.values()) if isinstance(v, dict) else tuple(map(key, v)) if isinstance(v, (tuple, list)) else v
    rows = sorted((key(f), key(a), key(b)) for f, a, b in zip(pairs["first"], pairs["a"], pairs["b"], strict=True))
    gone: set = set()
    for _, a, b in rows:
        if a not in gone and b not in gone:
            gone.add(a)
    out = sorted(gone)
    return pd.DataFrame({"page_id": [x[0] for x in out], "idx": [x[1] for x in out]})


def _walk_in_rounds(edges: DataFrame) -> DataFrame:
    """The same walk for components of any size: a pair is decided when it is the first left for both its ends."""
    spark = edges.sparkSession
    removed = spark.createDataFrame([], "node struct<page_id:long,idx:int>")
    order = F.struct("first", "a", "b")
    left = materialize(edges.withColumn("order", order), "rounds")
    while left.limit(1).count():
        first = left.select(F.explode(F.array("a", "b")).alias("node"), "order").groupBy("node").agg(F.min("order").alias("order"))
        now = first.groupBy("order").count().where("count = 2").select("order.a", "order.b", "order")
        now = materialize(now, "rounds-now")
        gone = now.select(F.col("a").alias("node"))
        removed = materialize(removed.unionByName(gone), "rounds-removed")
        left = left.join(gone.withColumnRenamed("node", "a"), "a", "left_anti").join(gone.withColumnRenamed("node", "b"), "b", "left_anti")
        left = materialize(left.select("first", "a", "b", "order"), "rounds")
    return removed.select("node.*")


def removals(pages: DataFrame, how: Banding = Banding(), pairs_in_task: int = PAIRS_IN_TASK) -> DataFrame:
    """page_id, idx of the sections that the greedy walk removes.

    Pairs are walked by band, by the bucket's first place and by their own places; of a similar pair that is still whole
    the earlier section goes. Sections with equal signatures are one while pairs are made: all but the last go.
    """
    signed = materialize(signatures(pages, how).withColumn("at", _at()).withColumn("kind", F.xxhash64("sig")), "signatures")
    lasts = signed.groupBy("kind").agg(F.max("at").alias("at"))
    kinds = materialize(signed.select("at", "sig").join(lasts.select("at"), "at"), "signature-kinds")
    copies = salted_join(signed.select("kind", "page_id", "idx", "at"), lasts.withColumnRenamed("at", "last"), ["kind"]).where(F.col("at") < F.col("last")).select("page_id", "idx")
    edges = materialize(verified_edges(kinds, how), "edges")
    parts = _components(edges).select(F.col("node").alias("a"), "component")
    owned = materialize(edges.join(parts, "a"), "owned-edges")
    large = owned.groupBy("component").count().where(F.col("count") > pairs_in_task).select("component")
    small = owned.join(large, "component", "left_anti").groupBy("component").applyInPandas(lambda p: _walk(p), "page_id long, idx int")
    big = owned.join(large, "component", "left_semi").select("first", "a", "b")
    return copies.unionByName(small).unionByName(_walk_in_rounds(big))


def deduplicated(pages: DataFrame, how: Banding = Banding()) -> DataFrame:
    """`pages` with DUPLICATE_MARK in place of each removed section; positions stay. page_id is to be unique."""
    gone = removals(pages, how).groupBy("page_id").agg(F.collect_set("idx").alias("_gone"))
    both = pages.join(gone, "page_id", "left")
    marked = F.transform("text_list", lambda t, i: F.when(F.array_contains("_gone", i), F.lit(DUPLICATE_MARK)).otherwise(t))
    return both.withColumn("text_list", F.when(F.col("_gone").isNull(), F.col("text_list")).otherwise(marked)).drop("_gone")


def exact_duplicates(pages: DataFrame) -> DataFrame:
    """text_key, n: sections that occur more than once, letter for letter, by a digest of their text."""
    texts = pages.select(F.explode("text_list").alias("text")).where("text is not null")
    return texts.groupBy(F.md5("text").alias("text_key")).agg(F.count("*").alias("n")).where("n > 1")
