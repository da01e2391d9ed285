"""Copies, near duplicates, look-alikes and term counts, against brute force and at the edges."""

import random
import re

import pytest

from corpusmill.llm import copies, lookalikes, neardup, terms

PAGE = "page_id long, text_list array<string>, key string, form int, registers string, k int, band int"


def frame(spark, rows, schema=PAGE):
    """Pages with further columns whose names the operators use inside."""
    return spark.createDataFrame([(p, t, "x", 1, None, 2, 3) for p, t in rows], schema)


def prose(seed, n=60):
    r = random.Random(seed)
    return " ".join(r.choice("mill river stone bridge council winter paper market school garden".split()) + str(r.randint(0, 99)) for _ in range(n))


def folded(t):
    return "".join(c for c in (t or "").lower() if c.isalnum())


def test_copies_equal_brute_force(spark):
    r = random.Random(1)
    rows = []
    for p in range(300):
        sections = [prose(p % 40 + k, 8) for k in range(p % 4)]
        if p % 3 == 0:
            sections = [s.upper().replace(" ", " - ") for s in sections][::-1]
        if p % 7 == 0:
            sections = [*sections, *sections[:1]]
        rows += [(p, sections)] * (1 + (p % 50 == 0))
    rows += [(1000, None), (1001, []), (None, ["a"]), (1002, [None]), (1003, [""]), (1004, ["—"]), (1005, ["ΣΑΣ İ"]), (1006, ["σας i"])]
    r.shuffle(rows)
    groups = {}
    for p, t in sorted((x for x in rows if x[0] is not None and x[1]), key=lambda x: x[0]):
        if p < 1005:
            groups.setdefault(tuple(sorted(map(folded, t))), set()).add(p)
    want = {(min(g), p) for g in groups.values() for p in g}
    got = {tuple(x) for x in copies.page_copies(frame(spark, rows)).collect()}
    assert {x for x in got if x[1] < 1005} == want
    assert {x.page_id: x.n_copies for x in copies.copy_counts(frame(spark, rows)).where("page_id < 1005").collect()} == {min(g): len(g) for g in groups.values()}


def test_two_pointers():
    assert copies.same_when_folded("A-b" * 5000, "ab" * 5000) and not copies.same_when_folded("ab" * 5000 + "c", "ab" * 5000)
    assert copies.same_when_folded(None, " —") and not copies.same_when_folded("a", "")
    assert copies.same_pages(["a b", "C"], ["c", "AB"]) and not copies.same_pages(["a"], ["a", "a"])


def test_clashing_hashes_are_told_apart(spark, monkeypatch):
    rows = [(1, "first"), (2, "second"), (3, "first"), (4, "second")]
    import numpy as np
    import pyarrow as pa

    batch = pa.record_batch([pa.array([1, 1, 1]), pa.array([2, 3, 4]), pa.array([["second"], ["First"], ["second!"]]), pa.array([["first"]] * 3)], names=["first_page_id", "page_id", "text_list", "first_list"])
    out = next(copies._verify(iter([batch]))).to_pylist()
    assert [x["strict"] is None for x in out] == [False, True, False] and out[0]["strict"] == out[2]["strict"]
    assert np.size(rows)


def pieces(t):
    x = " ".join(re.sub(r"[\W_]+", " ", (t or "").lower()).split())
    return x, ({x[k : k + 5] for k in range(len(x) - 4)} or {x}) if x else set()


def near(rows):
    seen = sorted({(p, k, t) for p, ts in rows if p is not None and ts for k, t in enumerate(ts)}, key=lambda x: x[:2])
    out = set()
    for i, (pa, ka, ta) in enumerate(seen):
        xa, a = pieces(ta)
        for pb, kb, tb in seen[i + 1 :]:
            xb, b = pieces(tb)
            if a and b and len(a & b) > 0.8 * len(a | b) and xa.replace(" ", "") != xb.replace(" ", ""):
                out.add((pa, ka, pb, kb))
    return out


def near_rows():
    r = random.Random(3)
    rows = []
    for p in range(160):
        base = prose(p % 30).split()
        for _ in range(r.randint(0, 4)):
            base[r.randrange(len(base))] = "edited" + str(r.randint(0, 9))
        rows.append((p, [" ".join(base), prose(1000 + p, 5)]))
    rows += [(200 + k, [prose(7)]) for k in range(40)]  # many copies of one text
    rows += [(300, None), (301, []), (302, [None, "", "—", "ab", "abc", "ab"]), (None, [prose(7)]), *rows[:5]]
    rows += [(310, ["repeat this again " * 3 + prose(9)]), (311, ["repeat this again " * 300 + prose(9)])]
    return rows


def test_near_equals_brute_force(spark):
    rows = near_rows()
    want = near(rows)
    assert len(want) > 200 and (310, 0, 311, 0) in want
    got = {(x.page_a, x.sec_a, x.page_b, x.sec_b) for x in neardup.near_sections(frame(spark, rows)).collect()}
    assert got <= want
    assert len(got) >= 0.995 * len(want)


def test_near_classes(spark):
    rows = near_rows()
    got = {(x.page_id, x.sec_idx): (x.class_id, x.n_links) for x in neardup.near_classes(frame(spark, rows)).collect()}
    assert len({got[200 + k, 0][0] for k in range(40)}) == 1
    assert got[310, 0][1] >= 1 and (302, 1) not in got and got[302, 3] == got[302, 5]
    assert neardup.near_classes(frame(spark, rows).limit(0)).count() == 0 and neardup.near_sections(frame(spark, rows).limit(0)).count() == 0


def test_registers_merge_and_estimate():
    import numpy as np

    how = neardup.DEFAULT
    h = neardup.mix(np.arange(3000))
    one = neardup.sketch(h[:2000], np.zeros(2000, np.int64), 1, how)
    two = neardup.sketch(h[1000:], np.zeros(2000, np.int64), 1, how)
    both = neardup.sketch(h, np.zeros(3000, np.int64), 1, how)
    assert (np.maximum(one, two) == both).all()
    assert abs(neardup.joint_similarity(one, two, how)[0] - 1 / 3) < 0.12
    assert abs(neardup.cardinality(both, how)[0] / neardup.cardinality(one, how)[0] - 1.5) < 0.4


def test_look_alikes(spark):
    same = ["Café fish", "Cafe\u0301 fish", "Ｃａｆé\u3000ﬁsh", "C\u200baf\u00adé\u2003fish", "Сафé fish".replace("ф", "f"), "Caf\u00e9\u00a0fish"]
    other = ["Cafe fish", "café fish", "Café  fish", "x²", "x2", "①", "1", "٣", "3", None, ""]
    rows = [(k, [t]) for k, t in enumerate(same + other)] + [(50, None), (51, []), (0, [same[0]]), (None, ["q"]), (60, [same[0]])]
    got = {(x.page_a, x.page_b) for x in lookalikes.look_alike_pairs(frame(spark, rows)).collect()}
    n = len(same)
    assert got == {(a, b) for a in range(n) for b in range(a + 1, n)} | {(b, 60) for b in range(1, n)}
    forms = {x.page_id: x.form for x in lookalikes.forms(frame(spark, rows)).collect()}
    assert {forms[k] for k in range(n)} == {"Café fish"} and forms[n + 9] is None and forms[n + 10] == ""
    assert lookalikes.look_alike_pairs(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("text", ["a\u0323\u0307", "a\u0307\u0323", "\u1e9b\u0323", "각\u1100\u1161", "\u0301x", "q\u0307\u0323" * 400, "zero\u200d\u0301"])
def test_marks_are_ordered_and_recomposed(spark, text):
    import unicodedata

    df = spark.createDataFrame([(1, text)], "id long, text string")
    want = unicodedata.normalize("NFC", "".join(map(lookalikes.shape, unicodedata.normalize("NFD", text))))
    assert lookalikes.one_form(df, ["id"]).first().form == want


FREQ = "page_id long, text_list array<array<string>>, loaded_at timestamp, word string, place int"


def counted(pages):
    seen, on, total = {}, {}, 0
    for page in pages.values():
        words = [w for s in page or [] for x in s or [] if x for w in x.split(" ") if w]
        total += bool(words)
        for w in words:
            seen[w] = seen.get(w, 0) + 1
        for w in set(words):
            on[w] = on.get(w, 0) + 1
    return seen, on, total


def test_deltas_equal_recounting(spark):
    r = random.Random(2)
    make = lambda: [[" ".join(r.choice(["a", "b", "c\nd", "", "é"]) for _ in range(r.randint(0, 6))) for _ in range(2)] for _ in range(2)]
    first = {p: make() for p in range(60)} | {61: None, 62: [None, [None, ""]], 63: []}
    second = {p: t if p % 3 else make() for p, t in first.items() if p % 5} | {p: make() for p in range(100, 110)}

    def df(pages):
        rows = [(p, t, None, "x", 1) for p, t in pages.items()]
        return spark.createDataFrame(rows + rows[:7] + [(None, [["zz"]], None, "x", 1)], FREQ)

    counts = terms.merge_counts(None, terms.count_deltas(None, df(first)))
    counts = terms.merge_counts(counts, terms.count_deltas(df(first), df(second)))
    seen, on, total = counted(second)
    got = {x.word: (x.n_occurrences, x.n_pages) for x in counts.collect()}
    assert got == {w: (seen[w], on[w]) for w in seen} | {"": (sum(seen.values()), total)}
    assert terms.count_deltas(df(second), df(second)).count() == 0
    marks = {x.word: x.mark for x in terms.marked(counts).collect()}
    assert all(m == ("rare" if on[w] < 3 else "common" if on[w] > 0.5 * total else "useful") for w, m in marks.items())
    assert terms.marked(terms.delivered_counts(df(second).limit(0))).count() == 0
