"""The queries of the core over the test tables. A page counts once, however many rows deliver it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import normalize as text
from corpusmill.operators import bpe, crawl, dedup, normalize, parse, segment, stats, words
from corpusmill.operators.pages import once_each
from corpusmill.plans import oracle
from corpusmill.plans.pipeline import Pipeline
from corpusmill.schemas import DUPLICATE_MARK
from corpusmill.session import materialize, read_table

#: Where the pages of the test tables are.
BASE = "https://enc.example"
#: Sections shorter than this are cut off.
CUTOFF = 50
#: Entries of the vocabulary that is trained; above the number of different characters.
VOCAB_SIZE = 1500


def pages(spark: SparkSession, d: str, name: str) -> DataFrame:
    column = "text" if name == "crawl_data" else "text_list"
    return once_each(read_table(spark, d, name, "page_id", "url", column))


def _exploded(df: DataFrame, name: str = "text") -> DataFrame:
    return df.select("page_id", F.posexplode("text_list").alias("sec_idx", name))


def _mapped(spark: SparkSession, d: str, f) -> DataFrame:
    return _exploded(pages(spark, d, "parse_data").withColumn("text_list", f(F.col("text_list"))))


def nfc(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d, text.compose_each)


def normalize_whitespace(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d, lambda c: F.transform(c, text.whitespace))


def normalize_quotes_dashes(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d, lambda c: F.transform(c, text.plain_marks))


def normalize_full(spark: SparkSession, d: str) -> DataFrame:
    return _exploded(normalize.normalized(pages(spark, d, "parse_data")))


def length_cutoff(spark: SparkSession, d: str) -> DataFrame:
    cut = normalize.normalized(pages(spark, d, "parse_data"), CUTOFF)
    return cut.select("page_id", F.size("text_list").alias("n_sections"), F.length(F.array_join("text_list", "")).alias("n_chars")).where("n_sections >= 0")


def char_frequency(spark: SparkSession, d: str) -> DataFrame:
    return stats.char_counts([pages(spark, d, "parse_data"), pages(spark, d, "normalize_data")])


def length_stats(spark: SparkSession, d: str) -> DataFrame:
    one = stats.length_stats(pages(spark, d, "normalize_data"))
    return one.select(*(F.round(c, 6).alias(c) for c in one.columns))


def length_histogram(spark: SparkSession, d: str) -> DataFrame:
    return stats.length_histogram(pages(spark, d, "normalize_data"))


def find_texts(spark: SparkSession, d: str) -> DataFrame:
    found = stats.find_texts(pages(spark, d, "normalize_data"), lambda t: t.contains("railway"))
    return found.select("url", F.array_join(F.transform("idxs", lambda i: i.cast("string")), ",").alias("idxs"))


def count_texts(spark: SparkSession, d: str) -> DataFrame:
    return stats.count_texts(pages(spark, d, "normalize_data"), longer_than_0=lambda t: F.length(t) > 0, longer_than_50=lambda t: F.length(t) > 50)


def _frequencies(spark: SparkSession, d: str) -> DataFrame:
    return words.word_frequencies(pages(spark, d, "freq_dict"))


def word_frequency(spark: SparkSession, d: str) -> DataFrame:
    return _frequencies(spark, d).select("word", "freq")


def word_first_position(spark: SparkSession, d: str) -> DataFrame:
    return _frequencies(spark, d).select("word", *(F.col(f"first_pos.{c}").cast("long").alias(c) for c in ("page", "sec", "sent", "pos")))


def initial_vocab(spark: SparkSession, d: str) -> DataFrame:
    return bpe.initial_vocab(_frequencies(spark, d))


def initial_pair_counts(spark: SparkSession, d: str) -> DataFrame:
    return bpe.pair_counts(_frequencies(spark, d)).select("left_token", "right_token", "n")


def top_pair(spark: SparkSession, d: str) -> DataFrame:
    return bpe.top_pair(bpe.pair_counts(_frequencies(spark, d)))


def bpe_merges(spark: SparkSession, d: str) -> DataFrame:
    return bpe.train(_frequencies(spark, d), VOCAB_SIZE)


def bpe_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    frequencies = materialize(_frequencies(spark, d), "frequencies")
    return bpe.vocabulary(frequencies, bpe.train(frequencies, VOCAB_SIZE))


def token_counts(spark: SparkSession, d: str) -> DataFrame:
    return bpe.token_counts(_frequencies(spark, d), read_table(spark, d, "vocab"))


def token_ids(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    vocab = read_table(spark, d, "vocab").withColumn("token_id", F.row_number().over(Window.orderBy("token")) - 1)
    tokens = bpe.tokenized_words(_frequencies(spark, d).select("word"), vocab)
    return bpe.token_ids(tokens, vocab).select("word", F.array_join(F.transform("ids", lambda i: i.cast("string")), " ").alias("ids"))


def tokenize_pages(spark: SparkSession, d: str) -> DataFrame:
    tokens = bpe.tokenized(pages(spark, d, "freq_dict"), read_table(spark, d, "vocab"))
    flat = F.flatten(F.transform(F.filter("text_list", lambda s: s.isNotNull()), lambda s: F.filter(s, lambda x: x.isNotNull())))
    return tokens.where("text_list is not null").select("page_id", F.size(F.flatten(flat)).cast("long").alias("n_tokens"))


def ngram_counts(spark: SparkSession, d: str) -> DataFrame:
    each = _exploded(pages(spark, d, "normalize_data"))
    return each.select("page_id", "sec_idx", F.size(dedup.ngrams(F.col("text"), 5)).alias("n")).where("n >= 0")


def exact_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return dedup.exact_duplicates(pages(spark, d, "normalize_data"))


def minhash_signatures(spark: SparkSession, d: str) -> DataFrame:
    return dedup.signatures(pages(spark, d, "normalize_data"))


def lsh_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Sections that share a band. Those of one signature are a class that its last section stands for: each other one has
    a row with it, marked same_signature; the other rows are pairs of classes, and hold for all sections of both."""
    signed = materialize(dedup.signatures(pages(spark, d, "normalize_data")).withColumn("at", F.struct("page_id", "idx")), "signatures")
    kinds, members = dedup.signature_classes(signed)
    pairs = dedup.candidates(kinds, dedup.Banding()).select("a", "b").distinct()
    every = members.select(F.col("at").alias("a"), F.col("last").alias("b"), F.lit(True).alias("same_signature")).unionByName(pairs.withColumn("same_signature", F.lit(False)))
    return every.select(F.col("a.page_id").alias("page_a"), F.col("a.idx").alias("idx_a"), F.col("b.page_id").alias("page_b"), F.col("b.idx").alias("idx_b"), "same_signature")


def deduplicate(spark: SparkSession, d: str) -> DataFrame:
    marked = dedup.deduplicated(pages(spark, d, "normalize_data"))
    return _exploded(marked).where(F.col("text") == DUPLICATE_MARK).select("page_id", "sec_idx")


def segment_sentences(spark: SparkSession, d: str) -> DataFrame:
    split = segment.segmented(pages(spark, d, "normalize_data"))
    return _exploded(split, "sentences").select("page_id", "sec_idx", F.posexplode("sentences").alias("sent_idx", "sentence"))


def omit_duplicates(spark: SparkSession, d: str) -> DataFrame:
    marked = pages(spark, d, "normalize_data").withColumn("text_list", F.transform("text_list", lambda t: F.when(F.length(t) < 200, F.lit(DUPLICATE_MARK)).otherwise(t)))
    return segment.segmented(marked).where("text_list is not null").select("page_id", F.size("text_list").alias("n_sections"))


def parse_sections(spark: SparkSession, d: str) -> DataFrame:
    return _exploded(parse.parsed(pages(spark, d, "crawl_data"), ["page_id", "url"]))


def extract_links(spark: SparkSession, d: str) -> DataFrame:
    return crawl.links_of(pages(spark, d, "crawl_data"), "page_id", BASE)


def frontier_dedup(spark: SparkSession, d: str) -> DataFrame:
    return crawl.next_links(read_table(spark, d, "frontier", "url", "seq"), read_table(spark, d, "crawl_data", "url"), BASE)


def _addresses(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "crawl_data", "page_id", "url", "text", "http_status")
    return rows.groupBy("url").agg(F.min_by(F.struct("text", "http_status"), "page_id").alias("p")).select("url", "p.*")


def crawl_bfs(spark: SparkSession, d: str) -> DataFrame:
    known = materialize(_addresses(spark, d), "addresses")
    rows = read_table(spark, d, "frontier", "url", "seq").where(crawl.is_article("url", BASE)).groupBy("url").agg(F.min("seq").alias("seq"))
    seeds = crawl.ranked(rows, "seq").select("url", "rank")
    return crawl.crawl(spark, known, seeds, 1 << 40, BASE)[0].select("url", "level")


def pipeline(spark: SparkSession, d: str) -> DataFrame:
    tokens = Pipeline(vocab_size=VOCAB_SIZE).run(pages(spark, d, "crawl_data"))["tokenized"]
    return tokens.select("page_id", F.size("text_list").alias("n_sections"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Quotation marks and dashes of the pages after normalization and cut-off."""
    return stats.char_counts(normalize.normalized(pages(spark, d, "parse_data"), CUTOFF))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        nfc, normalize_whitespace, normalize_quotes_dashes, normalize_full, length_cutoff, char_frequency, length_stats, length_histogram,
        find_texts, count_texts, word_frequency, word_first_position, initial_vocab, initial_pair_counts, top_pair, bpe_merges,
        bpe_vocabulary, token_counts, token_ids, tokenize_pages, ngram_counts, exact_duplicates, minhash_signatures, lsh_candidates,
        deduplicate, segment_sentences, omit_duplicates, parse_sections, extract_links, frontier_dedup, crawl_bfs, pipeline,
    ]
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return oracle.SQL
