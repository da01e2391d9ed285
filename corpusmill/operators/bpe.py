"""Byte-pair encoding: first vocabulary, pair counts, training, tokens.

Training works on distinct words. Up to WORDS_IN_TASK of them it runs in one task with counts that are updated by each
merge; beyond that each merge is a distributed count, which is slower and gives the same merges.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.session import materialize, salted_join

#: Distinct words that are trained in one task.
WORDS_IN_TASK = 3_000_000
#: Entries of a vocabulary that is sent to all tasks; larger ones are an error.
MOST_TOKENS = 5_000_000
MERGES = "merge_rank int, left_token string, right_token string, token string, pair_freq long"


def letters(word):
    return F.filter(F.split(word, ""), lambda c: c != "")


def initial_vocab(frequencies: DataFrame) -> DataFrame:
    """token: the space and every character of the words."""
    chars = frequencies.select(F.explode(letters(F.col("word"))).alias("token"))
    space = frequencies.sparkSession.range(1).select(F.lit(" ").alias("token"))
    return chars.unionByName(space).distinct()


def pair_counts(frequencies: DataFrame) -> DataFrame:
    """left_token, right_token, n, first_at: adjacent characters of the words, weighted by frequency; overlapping pairs all count.
    first_at (place of the word's first appearance, then position) says which of equally frequent pairs came first."""
    c = letters(F.col("word"))
    pairs = F.transform(F.sequence(F.lit(1), F.size(c) - 1), lambda i: F.struct(F.element_at(c, i).alias("left_token"), F.element_at(c, i + 1).alias("right_token"), i.alias("pos")))
    each = frequencies.where(F.size(c) > 1).select("freq", "first_pos", F.inline(pairs))
    return each.groupBy("left_token", "right_token").agg(F.sum("freq").alias("n"), F.min(F.struct("first_pos", "pos")).alias("first_at"))


def top_pair(counts: DataFrame) -> DataFrame:
    """The most frequent pair; of equal ones the first encountered. No row where there is no pair."""
    return counts.orderBy(F.desc("n"), "first_at").limit(1).select("left_token", "right_token", "n")


class Trainer:
    """Merges over words that all lie here, with pair counts kept up to date.

    A heap holds pairs by falling count. Among the pairs of the highest count the one is taken that a walk over the words
    in their order would meet first.
    """

    def __init__(self, words: list[str], freqs: list[int]) -> None:
        self.tokens = [list(w) for w in words]
        self.freqs = freqs
        self.counts: dict[tuple[str, str], int] = defaultdict(int)
        self.where: dict[tuple[str, str], set[int]] = defaultdict(set)
        for k, parts in enumerate(self.tokens):
            for pair in zip(parts, parts[1:]):
                self.counts[pair] += freqs[k]
                self.where[pair].add(k)
        self.heap = [(-n, pair) for pair, n in self.counts.items()]
        heapq.heapify(self.heap)

    def place(self, pair: tuple[str, str]) -> tuple[int, int]:
        """First word, and position in it, where the pair stands now."""
        word = min(self.where[pair])
        parts = self.tokens[word]
        return word, next(i for i in range(len(parts) - 1) if (parts[i], parts[i + 1]) == pair)

    def best(self) -> tuple[tuple[str, str], int] | None:
        rivals: dict[tuple[str, str], None] = {}
        top = 0
        while self.heap:
            n, pair = self.heap[0]
            if self.counts.get(pair, 0) != -n or pair in rivals:
                heapq.heappop(self.heap)
            elif top in (0, -n):
                top = -n
                rivals[heapq.heappop(self.heap)[1]] = None
            else:
                break
        if not rivals:
            return None
        for pair in rivals:
            heapq.heappush(self.heap, (-top, pair))
        return min(rivals, key=self.place), top

    def merge(self, pair: tuple[str, str]) -> None:
        changed: set[tuple[str, str]] = set()
        joined = pair[0] + pair[1]
        for k in list(self.where[pair]):
            old, freq = self.tokens[k], self.freqs[k]
            new: list[str] = []
            i = 0
            while i < len(old):
                both = i + 1 < len(old) and old[i] == pair[0] and old[i + 1] == pair[1]
                new.append(joined if both else old[i])
                i += 1 + both
            self.tokens[k] = new
            for p in zip(old, old[1:]):
                self.counts[p] -= freq
                changed.add(p)
                self.where[p].discard(k)
            for p in zip(new, new[1:]):
                self.counts[p] += freq
                changed.add(p)
                self.where[p].add(k)
        for p in changed:
            if self.counts[p] > 0:
                heapq.heappush(self.heap, (-self.counts[p], p))
            else:
                del self.counts[p]
                self.where.pop(p, None)


def _train_here(merges: int):
    def run(words: pd.DataFrame) -> pd.DataFrame:
        words = words.sort_values("first_pos", key=lambda s: s.map(lambda p: tuple(p.values()) if isinstance(p, dict) else tuple(p)))
        trainer = Trainer(words["word"].tolist(), words["freq"].tolist())
        out = []
        for rank in range(merges):
            found = trainer.best()
            if found is None:
                break
            (left, right), n = found
            out.append((rank, left, right, left + right, n))
            trainer.merge((left, right))
        return pd.DataFrame(out, columns=["merge_rank", "left_token", "right_token", "token", "pair_freq"])

    return run


def _train_apart(frequencies: DataFrame, merges: int) -> DataFrame:
    """The same merges, each from a distributed count; tokens stand between marks in a string, so that a merge is a replacement."""
    a, z = "\x01", "\x02"
    marked = F.array_join(F.transform(letters(F.col("word")), lambda c: F.concat(F.lit(a), c, F.lit(z))), "")
    words = materialize(frequencies.select("freq", "first_pos", marked.alias("t")), "bpe-words")
    out = []
    for rank in range(merges):
        parts = F.filter(F.split(F.replace("t", F.lit(a), F.lit("")), z), lambda c: c != "")
        each = words.select("freq", "first_pos", parts.alias("c")).where(F.size("c") > 1)
        pairs = F.transform(F.sequence(F.lit(1), F.size("c") - 1), lambda i: F.struct(F.element_at("c", i).alias("left_token"), F.element_at("c", i + 1).alias("right_token"), i.alias("pos")))
        counts = each.select("freq", "first_pos", F.inline(pairs)).groupBy("left_token", "right_token").agg(F.sum("freq").alias("n"), F.min(F.struct("first_pos", "pos")).alias("first_at"))
        top = counts.orderBy(F.desc("n"), "first_at").limit(1).collect()
        if not top:
            break
        left, right, n = top[0]["left_token"], top[0]["right_token"], top[0]["n"]
        out.append((rank, left, right, left + right, n))
        words = words.withColumn("t", F.replace("t", F.lit(a + left + z + a + right + z), F.lit(a + left + right + z)))
        if rank % 20 == 19:
            words = materialize(words, "bpe-words")
    return frequencies.sparkSession.createDataFrame(out, MERGES)


def train(frequencies: DataFrame, size: int, words_in_task: int = WORDS_IN_TASK) -> DataFrame:
    """merge_rank, left_token, right_token, token, pair_freq: the merges that bring the first vocabulary to `size`.

    As many merges are made as the vocabulary lacks, or until no pair is left; a merge that makes a token that exists
    counts as one. A `size` below the first vocabulary is an error.
    """
    frequencies = materialize(frequencies.where("word is not null"), "bpe-frequencies")
    begun = initial_vocab(frequencies).count()
    if size < begun:
        raise ValueError(f"the vocabulary has {begun} entries already, more than {size}")
    if frequencies.count() > words_in_task:
        return _train_apart(frequencies, size - begun)
    return frequencies.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(_train_here(size - begun), MERGES)


def vocabulary(frequencies: DataFrame, merges: DataFrame) -> DataFrame:
    """token, token_id, merge_rank: first the characters in order, then the merged tokens by rank, each once."""
    first = initial_vocab(frequencies).select("token", F.lit(-1).alias("merge_rank"))
    every = first.unionByName(merges.select("token", "merge_rank")).groupBy("token").agg(F.min("merge_rank").alias("merge_rank"))
    # a vocabulary is small next to a corpus and has an order of its own; so one task numbers it
    return every.withColumn("token_id", F.row_number().over(Window.orderBy("merge_rank", "token")) - 1)


# ---- tokens ----


def greedy_tokens(text: str, vocab: frozenset[str]) -> list[str]:
    """Tokens of a text: each as long as all its beginnings are in the vocabulary. A character that is not is a token."""
    out, start = [], 0
    while start < len(text):
        end = start + 1
        if text[start] in vocab:
            while end < len(text) and text[start : end + 1] in vocab:
                end += 1
        out.append(text[start:end])
        start = end
    return out


def _entries(vocab: DataFrame) -> frozenset[str]:
    rows = vocab.select("token").where("token is not null").limit(MOST_TOKENS + 1).collect()
    if len(rows) > MOST_TOKENS:
        raise ValueError(f"a vocabulary of more than {MOST_TOKENS} tokens is not sent to tasks")
    return frozenset(r[0] for r in rows)


def tokenized_words(words: DataFrame, vocab: DataFrame) -> DataFrame:
    """`words` with the column tokens; each distinct word should be given once."""
    entries = _entries(vocab)
    schema = T.StructType([*words.schema, T.StructField("tokens", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [None if w is None else greedy_tokens(w, entries) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tokens, pa.list_(pa.string()))], names=[*batch.schema.names, "tokens"])

    return words.mapInArrow(run, schema)


def tokenized(pages: DataFrame, vocab: DataFrame) -> DataFrame:
    """`pages` with each sentence of text_list as a list of tokens.

    No token but the space holds a space, so words are independent of each other; a task tokenizes each word once and
    keeps the last ones it met. A vocabulary with spaces inside tokens is applied to whole sentences.
    """
    entries = _entries(vocab)
    apart = " " in entries and not any(" " in t for t in entries if t != " ")
    kind = pa.list_(pa.list_(pa.list_(pa.string())))
    place = pages.columns.index("text_list")
    nested = T.ArrayType(T.ArrayType(T.ArrayType(T.StringType())))
    schema = T.StructType([T.StructField("text_list", nested) if f.name == "text_list" else f for f in pages.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}

        def sentence(text: str | None) -> list[str] | None:
            if text is None:
                return None
            if not apart:
                return greedy_tokens(text, entries)
            out: list[str] = []
            for k, word in enumerate(text.split(" ")):
                if k:
                    out.append(" ")
                tokens = known.get(word)
                if tokens is None:
                    tokens = greedy_tokens(word, entries)
                    if len(known) > 500_000:
                        known.clear()
                    known[word] = tokens
                out += tokens
            return out

        for batch in batches:
            lists = [None if p is None else [None if s is None else [sentence(t) for t in s] for s in p] for p in batch.column(place).to_pylist()]
            columns = list(batch.columns)
            columns[place] = pa.array(lists, kind)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return pages.mapInArrow(run, schema)


def token_counts(frequencies: DataFrame, vocab: DataFrame) -> DataFrame:
    """token, n: tokens of all words by frequency, each distinct word being tokenized once; spaces between words not counted."""
    each = tokenized_words(frequencies.select("word", "freq"), vocab)
    return each.select("freq", F.explode("tokens").alias("token")).groupBy("token").agg(F.sum("freq").alias("n"))


def token_ids(tokens: DataFrame, vocab: DataFrame, unknown: int = -1, most: int = MOST_TOKENS) -> DataFrame:
    """`tokens` (column tokens) with ids: the vocabulary's token_id of each, `unknown` for those it lacks.

    A vocabulary of up to `most` entries is sent to the tasks; a larger one is joined, with the same ids.
    """
    number = {r["token"]: r["token_id"] for r in vocab.select("token", "token_id").limit(most + 1).collect()}
    if len(number) > most:
        return _joined_ids(tokens, vocab, unknown)
    schema = T.StructType([*tokens.schema, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [None if t is None else [number.get(x, unknown) for x in t] for t in batch.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))], names=[*batch.schema.names, "ids"])

    return tokens.mapInArrow(run, schema)


def _joined_ids(tokens: DataFrame, vocab: DataFrame, unknown: int) -> DataFrame:
    """token_ids by a join: rows get a number of their own, their tokens meet the vocabulary and come back in order."""
    rows = materialize(tokens.withColumn("_row", F.monotonically_increasing_id()), "numbered-tokens")
    known = vocab.where("token is not null").select(F.col("token").alias("_token"), F.col("token_id").cast("int").alias("_id"))
    each = rows.select("_row", F.posexplode("tokens").alias("_at", "_token"))
    placed = salted_join(each, known, ["_token"], how="left").groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_at", F.coalesce("_id", F.lit(unknown)).alias("_id")))).alias("_ids"))
    ids = F.when(F.col("tokens").isNotNull(), F.coalesce(F.col("_ids._id"), F.array().cast("array<int>")))
    return rows.join(placed, "_row", "left").withColumn("ids", ids).drop("_row", "_ids")
