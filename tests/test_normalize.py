import re
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.operators import normalize, stats

ALPHABET = "ab\r\t\f\x1c\x85     ​　“’−́\U0001f600 \n"


def twin(t: str) -> str:
    """The rules, plainly."""
    t = unicodedata.normalize("NFC", t)
    t = t.replace("\r\n", "\n").replace("\r", "\n")
    t = "".join(c for c in t if not (c < "\t" or "\n" < c < " " or c == "\x7f"))
    t = "".join(" " if c in "     　\t" else c for c in t if c != "​")
    lines = []
    for k, line in enumerate(t.split("\n")):
        lead = len(line) - len(line.lstrip(" "))
        lines.append(" " * min(lead, 2) + re.sub(" {2,}", " ", line[lead:]))
    t = "\n".join(lines)
    t = re.sub(r"\n\s*\n", "\n\n", t).strip()
    return t.translate(str.maketrans("“”‘’−", "\"\"''-"))


def run(spark, texts, cutoff=-1):
    df = spark.createDataFrame([(1, texts)], "page_id long, text_list array<string>")
    return normalize.normalized(df, cutoff).first().text_list


def test_micro_inputs(spark):
    cases = {"a   b": "a b", "a\fb\tc": "ab c", "a\n \n \nb": "a\n\nb", "“a” ‘b’ −1 – —": "\"a\" 'b' -1 – —"}
    cases |= {"x\n" + " " * n + "y": "x\n" + " " * k + "y" for n, k in enumerate([0, 1, 2, 2, 2, 2])}
    assert run(spark, list(cases)) == list(cases.values())


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=25), min_size=200, max_size=300))
def test_equals_twin_and_is_idempotent(spark, texts):
    once = run(spark, texts)
    assert once == [twin(t) for t in texts]


def test_cutoff_nulls_and_empty(spark):
    assert run(spark, ["x" * 49, "x" * 50, None, "x" * 51], 50) == ["x" * 50, "x" * 51]
    assert run(spark, None) is None
    assert run(spark, []) == []
    assert run(spark, [None, ""]) == [None, ""]


def test_stats(spark):
    pages = spark.createDataFrame([("u", ["a-b", None, "“"]), ("v", []), ("w", None), ("u", ["−"])], "url string, text_list array<string>")
    counts = {r.ch: r.n for r in stats.char_counts(pages).collect()}
    assert counts["-"] == counts["“"] == counts["−"] == 1 and counts["'"] == 0
    assert sorted(tuple(r) for r in stats.length_histogram(pages).collect()) == [(1, 2), (3, 1)]
    found = {r.url: r.idxs for r in stats.find_texts(pages, lambda t: t != "a-b").collect()}
    assert found == {"u": [0, 2]}
    empty = pages.limit(0)
    assert all(r.n == 0 for r in stats.char_counts(empty).collect())
