import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from corpusmill.operators import bpe, words


def naive(freqs: dict[str, int], merges: int) -> list[tuple]:
    """Recounts every pair at each merge; the first encountered of equally frequent pairs wins."""
    held = [(list(w), f) for w, f in freqs.items()]
    out = []
    for _ in range(merges):
        counts: dict = {}
        for parts, f in held:
            for p in zip(parts, parts[1:]):
                counts[p] = counts.get(p, 0) + f
        if not counts:
            break
        top = max(counts.values())
        best = next(p for p in counts if counts[p] == top)
        out.append((*best, top))
        for parts, _ in held:
            i = 0
            while i < len(parts) - 1:
                if (parts[i], parts[i + 1]) == best:
                    parts[i : i + 2] = ["".join(best)]
                i += 1
    return out


def frame(spark, freqs):
    rows = [(w, f, (k, 0, 0, 0)) for k, (w, f) in enumerate(freqs.items())]
    return spark.createDataFrame(rows, "word string, freq long, first_pos struct<page:long,sec:int,sent:int,pos:int>")


def words_of(seed: int) -> dict[str, int]:
    r = random.Random(seed)
    return {"".join(r.choice("abc") for _ in range(r.randint(0, 8))): r.randint(1, 3) for _ in range(12)}


def test_trainer_equals_recounting():
    for seed in range(300):
        freqs = words_of(seed)
        trainer, got = bpe.Trainer(list(freqs), list(freqs.values())), []
        for _ in range(15):
            if (found := trainer.best()) is None:
                break
            got.append((*found[0], found[1]))
            trainer.merge(found[0])
        assert got == naive(freqs, 15), seed


@pytest.mark.parametrize("in_task", [10**6, 0])
def test_train(spark, in_task):
    freqs = words_of(7) | {"aaaa": 2, "": 5}
    df = frame(spark, freqs)
    begun = bpe.initial_vocab(df).count()
    got = [(r.left_token, r.right_token, r.pair_freq) for r in bpe.train(df, begun + 8, in_task).orderBy("merge_rank").collect()]
    assert got == naive(freqs, 8)
    with pytest.raises(ValueError):
        bpe.train(df, begun - 1)


def test_known_cases(spark):
    counts = {(r.left_token, r.right_token): r.n for r in bpe.pair_counts(frame(spark, {"aaa": 1})).collect()}
    assert counts == {("a", "a"): 2}
    assert tuple(bpe.top_pair(bpe.pair_counts(frame(spark, {"ab": 1, "cd": 1}))).first())[:2] == ("a", "b")
    assert bpe.top_pair(bpe.pair_counts(frame(spark, {"a": 1}))).count() == 0


def test_words(spark):
    pages = spark.createDataFrame([(1, [["a  b\nc "]]), (2, None), (3, [None, []]), (4, [[None, "a"]])], "page_id long, text_list array<array<string>>")
    assert {r.word: r.freq for r in words.word_frequencies(pages).collect()} == {"a": 2, "": 2, "b\nc": 1}


def test_greedy_tokens():
    vocab = frozenset(["a", "b", "c", "ab", "abcd"])
    assert bpe.greedy_tokens("abcd", vocab) == ["ab", "c", "d"]
    assert bpe.greedy_tokens("", vocab) == []


@given(st.text("abc ", max_size=30), st.sets(st.text("abc", min_size=1, max_size=3)))
def test_tokens_restore_text_and_words_are_apart(text, vocab):
    vocab = frozenset(vocab | {" "})
    tokens = bpe.greedy_tokens(text, vocab)
    assert "".join(tokens) == text
    apart = []
    for k, word in enumerate(text.split(" ")):
        apart += [" "] * (k > 0) + bpe.greedy_tokens(word, vocab)
    assert apart == tokens


def test_tokenized_pages(spark):
    pages = spark.createDataFrame([(1, [["ab a", None, ""], None, []]), (2, None)], "page_id long, text_list array<array<string>>")
    for extra in ([], ["b a"]):
        vocab = spark.createDataFrame([(t,) for t in ["a", "b", "ab", " ", *extra]], "token string")
        got = {r.page_id: r.text_list for r in bpe.tokenized(pages, vocab).collect()}
        assert got == {1: [[["ab", " ", "a"], None, []], None, []], 2: None}
