"""Packing, mixing and reading levels."""

import random

import numpy as np
import pytest

from corpusmill.llm import level, mixture, packing, tokens

DOC = "doc_id long, text string, lang string, source string, n_tokens string, curve int, level int, place string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "x", 1, 2, "y") for i, t, lang, s in rows], DOC)


def words(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice("mill river stone bridge council winter paper".split()) for _ in range(n))


def test_hilbert_is_a_walk():
    bits = 3
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * 3, indexing="ij"), -1).reshape(-1, 3)
    order = cells[np.argsort(tokens.hilbert(cells, bits))]
    assert sorted(tokens.hilbert(cells, bits)) == list(range(len(cells)))
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_best_fit():
    sizes = np.array([6, 4, 5, 5, 3, 7, 10])
    box = packing.best_fit(sizes, 10)
    assert np.bincount(box, sizes).tolist() == [10] * 4 and len(packing.best_fit(np.zeros(0, np.int64), 10)) == 0
    assert packing.pieces(25, 10) == [(0, 10), (10, 10), (20, 5)]


def test_packed(spark):
    rows = [(k, words(k, 5 + k % 90), "en", "s") for k in range(400)] + [(500, words(1, 2000), "en", None), (501, None, "en", "s"), (502, "", "en", "s"), (None, "x", "en", "s")]
    rows += [(600 + k, words(7, 30), "en", "s") for k in range(200)]  # many copies
    boxes = spark.createDataFrame([("a", 64), ("b", 128), (None, 5), ("c", None), ("d", 0)], "container_name string, token_capacity int")
    got = packing.packed(frame(spark, rows), boxes).toPandas()
    sizes = {i: len(tokens.encoding().encode_ordinary(t)) for i, t, *_ in rows if t and i is not None}
    assert set(got.container_name) == {"a", "b"}
    for name, capacity in (("a", 64), ("b", 128)):
        g = got[got.container_name == name]
        assert g.groupby("doc_id").n_tokens.sum().to_dict() == sizes
        assert g.groupby("container_id").n_tokens.sum().max() <= capacity
        cut = g.groupby("doc_id").size()
        assert all(cut[i] == -(-n // capacity) for i, n in sizes.items())
        assert g.n_tokens.sum() / (g.container_id.nunique() * capacity) > 0.9
    assert packing.fill(packing.packed(frame(spark, rows), boxes), boxes).count() == 2
    assert packing.packed(frame(spark, rows).limit(0), boxes).count() == 0


def test_neighbours_on_the_curve_are_packed_together(spark, small):
    """Fill stays high, and the articles of a container lie much nearer along the curve than by chance."""
    import pandas as pd

    folder = small.replace("sf0.001", "sf0.01")
    documents, boxes = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "containers"))
    packing_ = packing.packed(documents, boxes)
    got = packing_.toPandas()
    for r in packing.fill(packing_, boxes).collect():
        one = got[got.container_name == r.container_name]
        rank = one.curve.rank(method="first")
        by = one.container_id
        span = rank.groupby(by).agg(lambda x: x.max() - x.min()).mean()
        chance = pd.Series(np.random.default_rng(0).permutation(rank.to_numpy()), index=one.index).groupby(by).agg(lambda x: x.max() - x.min()).mean()
        assert r.fill_share > 0.95 and span < 0.35 * chance


def test_windows_do_not_depend_on_batches():
    sizes = np.random.default_rng(1).integers(1, 100, 1000)
    one = packing.Packer(100)
    box = np.concatenate([one.put(sizes[k : k + packing.WINDOW]) for k in range(0, 1000, packing.WINDOW)])
    assert np.bincount(box, sizes).max() <= 100 and len(one.open) <= packing.OPEN
    assert sizes.sum() > 0.95 * 100 * one.made


def test_mixed(spark):
    rows = [(k, words(k, 30 + k % 20), "en", ["Big ", "BIG", "mid", "small", None, "unasked"][0 if k < 1500 else 2 if k < 1900 else 3 if k < 1990 else k % 2 + 4]) for k in range(2000)]
    asked = [("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.2, 8), ("none", 0.5, 3), (None, 0.1, 1), ("mid", None, 1)]
    targets = spark.createDataFrame(asked, "source_name string, target_share double, max_repeat int")
    got = mixture.mixed(frame(spark, rows), targets).toPandas()
    assert got.doc_id.is_unique and set(got.source) == {"big", "mid", "small"}
    most = got.groupby("source").copies.max()
    assert most["big"] <= 1 and most["mid"] <= 2 and most["small"] <= 8
    assert (got.groupby("source").copies.max() - got.groupby("source").copies.min() <= 1).all()
    report = {r.source: r for r in mixture.mixture_report(frame(spark, rows), targets).collect()}
    assert all(abs(report[s].actual_share - x) < 0.01 for s, x in (("big", 0.5), ("mid", 0.3), ("small", 0.2)))
    assert report["none"].mixed_tokens == 0 and sum(r.mixed_tokens for r in report.values()) == (got.n_tokens * got.copies).sum()
    assert mixture.mixed(frame(spark, rows).limit(0), targets).count() == 0
    assert mixture.mixed(frame(spark, rows), targets.limit(0)).count() == 0


STYLES = {
    "basic": "The {} cat saw the {} dog. He ran home. She was glad. They ate {} bread. It was a {} day. We like the {} sun.",
    "middle": "In 1850, the {} council reopened a {} station near the river, and its museum remained in use. The {} bridge was replaced by the {} railway company after the {} war.",
    "advanced": "Although the {} epistemology of such systems presupposes an asymptotic correspondence, whose implications have been inadequately appreciated, the {} heterogeneity necessitates a {} reinterpretation, inasmuch as the {} distinction precludes any {} generalisation.",
}


def styled(band, seed):
    r = random.Random(seed)
    return "# T\n\n" + " ".join(STYLES[band].format(*(r.choice("old red new big cold warm long".split()) for _ in range(5))) for _ in range(1))


def test_levels_on_held_out_documents(spark):
    bands = list(STYLES)
    rows = [(k, styled(bands[k % 3], k), "en" if k % 2 else "EN ", "s") for k in range(600)]
    rows += [(700, None, "en", "s"), (701, "", "en", "s"), (702, styled("basic", 1), "de", "s"), (703, styled("basic", 1), None, "s"), (704, "1. Name (1900)\n" * 20, "en", "s"), (None, styled("basic", 1), "en", "s")]
    labels = [(k, f"a{j}", bands[k % 3] if (k + j) % 10 else bands[(k + 1) % 3]) for k in range(150) for j in range(3)]
    labels += [(3, "z", None), (700, "a", "basic"), (None, "a", "basic"), (5, "a", "unheard")]
    given = spark.createDataFrame(labels, "doc_id long, annotator string, reading_band string")
    got = {x.doc_id: x.reading_band for x in level.reading_levels(frame(spark, rows), given).collect()}
    assert set(got) == set(range(600))
    right = sum(got[k] == bands[k % 3] for k in range(150, 600))
    assert right > 0.97 * 450
    nothing = level.reading_levels(frame(spark, rows), given.limit(0))
    assert nothing.where("reading_band is not null").count() == 0 and nothing.count() == 600
    assert level.reading_levels(frame(spark, rows).limit(0), given).count() == 0


def test_majority(spark):
    df = spark.createDataFrame([(1, "basic"), (1, "Basic "), (1, "middle"), (2, "basic"), (2, "advanced"), (3, None)], "doc_id long, reading_band string")
    assert [tuple(x) for x in level.majority(df).collect()] == [(1, -1.0)]


@pytest.mark.parametrize("text", ["a" * 300_000, "<|endoftext|>", "\ud7ff\U0001f600", " " * 50_000])
def test_tokenizer_takes_any_text(text):
    assert tokens.encoding().decode(tokens.encoding().encode_ordinary(text)) == text
