import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import dedup, segment
from corpusmill.schemas import DUPLICATE_MARK


def test_known_hash():
    assert dedup.murmur3(np.frombuffer(b"foo", np.uint8).reshape(1, 3), np.array([0]))[0, 0] == -156908512


def test_signature_is_least_hash_of_grams():
    how = dedup.Banding(5, 16, 4)
    text = "größe und länge der Wörter 東京都の桜"
    seeds = np.arange(16)
    want = np.min([dedup.murmur3(np.frombuffer(text[k : k + 5].encode(), np.uint8)[None, :], seeds)[0] for k in range(len(text) - 4)], axis=0)
    got = dedup.minhash([text, "abc", None, text], how)
    assert (got[0] == want).all() and got[1] is None and got[2] is None and (got[3] == want).all()


def test_ngrams(spark):
    texts = ["ababab", "\U0001f600a\U0001f600b\nc", "abc", None, "größe"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(dedup.ngrams(F.col("t"), 4))
    want = [None if t is None or len(t) < 4 else list(dict.fromkeys(t[k : k + 4] for k in range(len(t) - 3))) for t in texts]
    assert [r[0] for r in df.collect()] == want


def test_parameters():
    with pytest.raises(ValueError):
        dedup.Banding(signature_len=10, band_size=3)


@pytest.mark.parametrize("equal, near", [(102, False), (103, True)])
def test_threshold_is_strict(spark, equal, near):
    df = spark.createDataFrame([([1] * 128, [1] * equal + [2] * (128 - equal))], "a array<int>, b array<int>")
    assert df.select(dedup.similarity(F.col("a"), F.col("b"), dedup.Banding()) > 0.8).first()[0] is near


def greedy(edges):
    gone = set()
    for _, a, b in sorted(edges):
        if a not in gone and b not in gone:
            gone.add(a)
    return gone


def test_walks_agree(spark):
    r = random.Random(5)
    edges = set()
    for base in range(0, 300, 10):
        for _ in range(r.randint(1, 12)):
            a, b = sorted(r.sample(range(base, base + 10), 2))
            edges.add(((r.randint(0, 2), (base, 0)), (a, 0), (b, 0)))
    edges = {(a, b): (f, a, b) for f, a, b in sorted(edges, reverse=True)}.values()
    df = spark.createDataFrame(list(edges), "first struct<band:int,at:struct<page_id:long,idx:int>>, a struct<page_id:long,idx:int>, b struct<page_id:long,idx:int>")
    want = greedy(edges)
    assert {tuple(x) for x in dedup._walk_in_rounds(df).collect()} == want
    parts = {tuple(x.node): tuple(x.component) for x in dedup._components(df).collect()}
    assert all(parts[a] == parts[b] for _, a, b in edges)
    assert len(set(parts.values())) == len(_classes(edges))
    assert {tuple(x) for x in dedup._walk(pd.DataFrame(list(edges), columns=["first", "a", "b"])).itertuples(index=False)} == want


def _classes(edges):
    own = {}
    for _, a, b in edges:
        merged = own.get(a, {a}) | own.get(b, {b})
        for x in merged:
            own[x] = merged
    return {id(x) for x in own.values()}


def test_deduplicated(spark):
    base = "the old mill by the river was sold to the council in the spring of that year and then closed for good " * 3
    near = base + "!"
    pages = spark.createDataFrame([(1, [base, "abc", None]), (2, [near, "other words that nobody wrote before"]), (3, [base]), (4, None), (5, [])], "page_id long, text_list array<string>")
    got = {r.page_id: r.text_list for r in dedup.deduplicated(pages).collect()}
    assert got[4] is None and got[5] == [] and got[1][1:] == ["abc", None]
    marked = [p for p, t in ((1, got[1][0]), (2, got[2][0]), (3, got[3][0])) if t == DUPLICATE_MARK]
    assert len(marked) == 2 and 3 not in marked
    assert dedup.deduplicated(pages.limit(0)).count() == 0
    again = dedup.deduplicated(pages.repartition(1)).collect()
    assert {r.page_id: r.text_list for r in again} == got


def test_segmented(spark):
    pages = spark.createDataFrame([(1, ["Dr. A. Smith came. He left! (Then) he said: \"No.\" Then he went.", DUPLICATE_MARK, None, ""]), (2, None)], "page_id long, text_list array<string>")
    got = {r.page_id: r.text_list for r in segment.segmented(pages).collect()}
    assert got[2] is None and got[1][0] == ["Dr. A. Smith came.", "He left!", "(Then) he said: \"No.\"", "Then he went."]
    assert got[1][1:] == [None, [""]]
    assert len(segment.segmented(pages, omit_duplicates=False).first().text_list) == 4


def test_lsh_candidates_hold_every_section(spark, tmp_path):
    from corpusmill.plans.queries import lsh_candidates

    base = "the old mill by the river was sold to the council in the spring of that year and then closed for good"
    turned = base + " " + base  # other text, nearly the same pieces
    ring = [("abcdef" * 9)[k : k + 40] for k in range(2)]  # different texts of the same pieces: equal signatures
    texts = [base, base, turned, ring[0], ring[1], "words that nobody wrote before or since", "abc", None]
    rows = [(p, f"https://h/{p}", [t]) for p, t in enumerate(texts)]
    spark.createDataFrame(rows, "page_id long, url string, text_list array<string>").write.parquet(str(tmp_path / "normalize_data.parquet"))
    sig = dedup.minhash(texts, dedup.Banding())
    bands = [{(b, s[b : b + 16].tobytes()) for b in range(0, 128, 16)} if s is not None else set() for s in sig]
    want = {(a, b) for b in range(len(texts)) for a in range(b) if bands[a] & bands[b]}
    assert {(0, 1), (3, 4)} <= want
    got = lsh_candidates(spark, str(tmp_path)).collect()
    of = {x.page_a: x.page_b for x in got if x.same_signature}
    linked = {(x.page_a, x.page_b) for x in got if not x.same_signature}
    own = lambda p: of.get(p, p)
    assert {(a, b) for b in range(len(texts)) for a in range(b) if own(a) == own(b) or {(own(a), own(b)), (own(b), own(a))} & linked} == want
