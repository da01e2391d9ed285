"""How demanding each article is to read, on the bands that people gave to some articles.

A Rasch-style latent model puts articles and items on one scale. Items are the small-letter words of a sentence, pairs of
neighbours with a short word, its first word, its length and its commas. Whether an item occurs in a sentence is a logistic
response to the article's level: the log-odds are a parabola in the level (an unfolding response), so an item can be most
at home at any level, the item's difficulty. Levels and items are estimated in turn over all articles, on a grid of levels:
given the items, each article has a posterior over the grid; given the posteriors, the occurrences of an item at each level
are summed up, and its response is fitted to these sums. Labels hold the scale in place. The turns end when they
hardly move. The cuts between the bands are where they part the labels best.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.prefilter import key_filter
from corpusmill.llm.quality import mainly_prose
from corpusmill.session import materialize

# The bands in rising order, and their places on the scale.
BANDS = {"basic": -1.0, "middle": 0.0, "advanced": 1.0}
#: Places that items are hashed to; bounds what is summed up, sent to the driver and broadcast (7 MB), whatever the data.
ITEMS = 1 << 17
#: Levels at which posteriors and responses are kept.
GRID = np.linspace(-1.8, 1.8, 13)
#: Spread of levels, and of the level of an article that has a label about the label's band.
SPREAD, LABEL_SPREAD = 0.9, 0.25
#: Spread of the slope and the bend of an item's log-odds about 0, and of its height about that of its mean occurrence.
ITEM_SPREAD = np.array([2.0, 2.0, 2.0])
#: Weight of a sentence's items in an article's posterior; they are not independent of each other.
TEMPER = 0.2
#: Weight of all articles without a label against all with one; one of them never weighs more than one with a label.
UNLABELLED = 3.0
#: The turns end when the level at which an item occurs, in the mean over all occurrences, moves by less than this (bands
#: are 1 apart); and this many are the most.
TOLERANCE, MOST_TURNS = 0.01, 30
#: Articles in which an item must occur.
LEAST_ARTICLES = 3
#: Cells of the histogram in which the cuts are sought.
CELLS = 400
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n\n+")
_HEADING_LINE = re.compile(r"^#[^\n]*$", re.M)


class Places(dict):
    """The place of each item; remembers those met, up to a bound."""

    def __missing__(self, key) -> int:
        at = crc32(repr(key).encode()) % ITEMS
        if len(self) < 400_000:
            self[key] = at
        return at


class Items:
    """Turns texts into item places."""

    def __init__(self) -> None:
        self.place = Places().__getitem__

    def of(self, text: str) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of sentences, and in how many of them each item occurs."""
        place, out, n = self.place, [], 0
        for sentence in _SENTENCE.split(_HEADING_LINE.sub("", text)):
            words = _WORD.findall(sentence)
            if not words:
                continue
            n += 1
            small = [w for w in words if w.islower()]
            here = set(small)
            here.update([p for p in zip(small, small[1:]) if len(p[0]) < 5 or len(p[1]) < 5])
            here.add(("length", min(12, len(words) // 4)))
            here.add(("commas", min(5, sentence.count(","))))
            here.add(("first", words[0].lower()))
            out += set(map(place, here))
        places, counts = np.unique(np.array(out, dtype=np.int32), return_counts=True)
        return n, places, counts.astype(np.int32)


_ARTICLE = "doc_id long, places array<int>, counts array<int>, n int, known boolean"


def _extract(maybe_labelled):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items()
        for batch in batches:
            ids, places, counts, sizes = [], [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if mainly_prose(text):
                    n, p, c = items.of(text)
                    ids.append(doc)
                    sizes.append(n)
                    places.append(p)
                    counts.append(c)
            starts = np.cumsum([0, *map(len, places)]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(starts), pa.array(np.concatenate(x) if x else np.zeros(0, np.int32))) for x in (places, counts)]
            known = maybe_labelled(np.array(ids, dtype=np.int64))
            yield pa.record_batch([pa.array(ids, pa.int64()), *lists, pa.array(sizes, pa.int32()), pa.array(known)], names=["doc_id", "places", "counts", "n", "known"])

    return run


class Responses:
    """The log-odds of each item at each level of the grid, and for a sentence the log-chance of no item at each level."""

    def __init__(self, places: np.ndarray, odds: np.ndarray) -> None:
        self.odds = np.zeros((ITEMS, len(GRID)), dtype=np.float32)
        self.odds[places] = odds
        self.none = -np.logaddexp(0, odds).sum(axis=0)

    def likelihood(self, places: np.ndarray, counts: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tempered log-likelihood of each article at each level."""
        counts, ends = counts.astype(np.float32), starts.tolist()
        total = [counts[a:b] @ self.odds[places[a:b]] for a, b in zip(ends, ends[1:])]
        return TEMPER * (np.array(total, dtype=np.float64).reshape(-1, len(GRID)) + sizes[:, None] * self.none)


_FREE = -0.5 * (GRID / SPREAD) ** 2


def _shares(logs: np.ndarray) -> np.ndarray:
    shares = np.exp(logs - logs.max(axis=1, keepdims=True))
    return shares / shares.sum(axis=1, keepdims=True)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """doc_id, places, counts, starts, sizes, labels of a few articles at a time, so that memory is bounded."""
    for whole in batches:
        for begin in range(0, len(whole), 500):
            batch = whole.slice(begin, 500)
            lists = batch.column("places")
            starts = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths(), dtype=np.int64))])
            labels = np.asarray(batch.column("level").fill_null(np.nan), dtype=np.float64)
            yield batch.column("doc_id"), np.asarray(lists.flatten()), np.asarray(batch.column("counts").flatten()), starts, np.asarray(batch.column("n"), dtype=np.float64), labels


#: Names of the sums over articles for each level of the grid.
_AT = [f"y{k}" for k in range(len(GRID))]


def _sums(given: Responses | None, weight: float):
    """Occurrences of each item at each level, over a task's articles; place -1 holds the sentences at each level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((ITEMS, len(GRID)))
        articles = np.zeros(ITEMS)
        line = np.zeros((1, len(GRID)))
        for _, places, counts, starts, sizes, labels in _parts(batches):
            labelled = ~np.isnan(labels)
            prior = np.where(labelled[:, None], -0.5 * ((GRID - np.nan_to_num(labels)[:, None]) / LABEL_SPREAD) ** 2, _FREE)
            worth = np.where(labelled, 1.0, weight)
            likely = np.zeros(1) if given is None else given.likelihood(places, counts, starts, sizes)
            shares = _shares(prior + likely) * worth[:, None]
            line[0] += (shares * sizes[:, None]).sum(axis=0)
            ends = starts.tolist()
            for i, (a, b) in enumerate(zip(ends, ends[1:])):
                if worth[i]:
                    held[places[a:b]] += counts[a:b, None] * shares[i]  # an article has an item once
            articles += np.bincount(places, minlength=ITEMS)
        used = np.flatnonzero(articles)
        table = np.concatenate([held[used], line]).astype(np.float32).astype(np.float64)  # shorter when compressed
        yield pa.record_batch([pa.array(np.concatenate([used, [-1]]), pa.int32()), pa.array(np.concatenate([articles[used], [0]])), *(pa.array(table[:, k]) for k in range(len(GRID)))], names=["place", "n", *_AT])

    return run


def fitted(occurrences: np.ndarray, sentences: np.ndarray) -> np.ndarray:
    """Log-odds of each item (row) at each level, by Newton's method on the sums at each level."""
    form = np.stack([np.ones(len(GRID)), GRID, GRID**2 - 0.5], axis=1)
    rate = (occurrences.sum(axis=1) + 0.5) / (sentences.sum() + 1)
    mean = np.zeros((len(occurrences), 3))
    mean[:, 0] = np.log(rate / np.maximum(1 - rate, 1e-9))
    beta, hold = mean.copy(), 1 / ITEM_SPREAD**2
    for _ in range(8):
        p = 1 / (1 + np.exp(-np.clip(beta @ form.T, -25, 8)))
        slope = (occurrences - sentences * p) @ form - (beta - mean) * hold
        bend = np.einsum("jk,kd,ke->jde", sentences * p * (1 - p), form, form) + np.diag(hold)
        beta += np.clip(np.linalg.solve(bend, slope[:, :, None])[:, :, 0], -1, 1)
    return beta @ form.T


def _turn(articles: DataFrame, given: Responses | None, weight: float) -> tuple[Responses, np.ndarray]:
    """One turn: posteriors of all articles from the responses given, sums, and the responses fitted to them; and for each
    place the occurrences of its item and the mean level of these. As many tasks as there are cores hand on sums of fixed
    size each."""
    few = articles.coalesce(articles.sparkSession.sparkContext.defaultParallelism)
    shape = ", ".join(f"{c} double" for c in ["n", *_AT])
    summed = few.mapInArrow(_sums(given, weight), f"place int, {shape}").groupBy("place").agg(*(F.sum(c).alias(c) for c in ["n", *_AT]))
    table = summed.toArrow()  # at most ITEMS + 1 rows
    place, n = np.asarray(table["place"]), np.asarray(table["n"])
    y = np.stack([np.asarray(table[c]) for c in _AT], axis=1)
    often = (place >= 0) & (n >= LEAST_ARTICLES)
    homes = np.zeros((2, ITEMS))
    homes[0, place[often]] = y[often].sum(axis=1)
    homes[1, place[often]] = y[often] @ GRID / np.maximum(homes[0, place[often]], 1e-9)
    return Responses(place[often], fitted(y[often], y[place == -1].sum(axis=0))), homes


def _score(given: Responses):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, places, counts, starts, sizes, labels in _parts(batches):
            level = _shares(_FREE + given.likelihood(places, counts, starts, sizes)) @ GRID
            yield pa.record_batch([ids, pa.array(level), pa.array(labels, from_pandas=True)], names=["doc_id", "theta", "level"])

    return run


def majority(labels: DataFrame) -> DataFrame:
    """doc_id, level: the band that most people gave, on the scale; null bands and other words count nothing, ties give no label."""
    level = F.create_map(*(F.lit(x) for pair in BANDS.items() for x in pair))[F.lower(F.trim("reading_band"))]
    given = labels.select("doc_id", level.alias("level")).where("doc_id is not null and level is not null")
    votes = given.groupBy("doc_id", "level").count()
    best = votes.groupBy("doc_id").agg(F.max("count").alias("most"), F.max_by("level", "count").alias("level"), F.collect_list("count").alias("counts"))
    return best.where(F.size(F.filter("counts", lambda c: c == F.col("most"))) == 1).select("doc_id", "level")


def _cuts(scored: DataFrame) -> tuple[float, float]:
    """The two cuts that give most labelled articles their band, from a histogram of CELLS cells."""
    known = scored.where("level is not null")
    low, high = known.agg(F.min("theta"), F.max("theta")).first()
    width = max(high - low, 1e-9) / CELLS
    cell = F.least(F.floor((F.col("theta") - low) / width), F.lit(CELLS - 1)).cast("int")
    rows = known.groupBy(cell.alias("cell"), "level").count().collect()  # at most 3 * CELLS rows
    grid = np.zeros((3, CELLS + 1))
    for r in rows:
        grid[int(r["level"]) + 1, r["cell"] + 1] += r["count"]
    below = np.cumsum(grid, axis=1)
    right = below[0][:, None] + (below[1][None, :] - below[1][:, None]) + (below[2][-1] - below[2])[None, :]
    right = np.where(np.arange(CELLS + 1)[:, None] <= np.arange(CELLS + 1)[None, :], right, -1)
    # among equally good pairs the middle one
    a, b = (float(np.median(x)) for x in np.nonzero(right == right.max()))
    return low + a * width, low + b * width


def estimated(every: DataFrame, known: DataFrame, turns: int = MOST_TURNS) -> Responses:
    """The items' responses: from the labelled articles first, then from all, turn by turn until they hardly move."""
    n_known, n = known.count(), every.count()
    weight = min(1.0, UNLABELLED * n_known / max(1, n - n_known))
    given, before = _turn(known, None, 0.0)
    for _ in range(turns):
        given, homes = _turn(every, given, weight)
        if (homes[0] * np.abs(homes[1] - before[1])).sum() < TOLERANCE * homes[0].sum():
            break
        before = homes
    return given


def reading_levels(documents: DataFrame, labels: DataFrame, turns: int = MOST_TURNS) -> DataFrame:
    """doc_id, theta, reading_band of each English document (lang `en` in any case) that is mainly natural prose.

    `documents` has doc_id (unique), text and lang; other columns are ignored; null and empty texts and null ids have no
    level. `labels` has doc_id and reading_band; several people may have labelled a document. Without any label of an
    article that is prose levels and bands are null, for there is nothing that tells them. Each article is read once
    into item counts; what is summed up for the items is of fixed size, and so is what the driver holds.
    """
    english = documents.where("doc_id is not null and text is not null and text <> '' and lower(trim(lang)) = 'en'").select("doc_id", "text")
    given = materialize(majority(labels), "labels")
    read = materialize(english.mapInArrow(_extract(key_filter(given, "doc_id")), _ARTICLE), "articles")
    near = materialize(read.where("known").drop("known").join(given, "doc_id", "left"), "perhaps-labelled-articles")
    known = near.where("level is not null")
    every = near.unionByName(read.where("not known").drop("known").withColumn("level", F.lit(None).cast("double")))
    if not known.head(1):
        return every.select("doc_id", F.lit(None).cast("double").alias("theta"), F.lit(None).cast("string").alias("reading_band"))
    scored = materialize(every.mapInArrow(_score(estimated(every, known, turns)), "doc_id long, theta double, level double"), "levels")
    (first, second), (low, middle, high) = _cuts(scored), BANDS
    band = F.when(F.col("theta") < first, low).when(F.col("theta") < second, middle).otherwise(high)
    return scored.select("doc_id", "theta", band.alias("reading_band"))
