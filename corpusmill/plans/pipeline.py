"""The stages in a row: parse, normalize, deduplicate, segment, count words, train a vocabulary, tokenize."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from corpusmill.operators import bpe, dedup, normalize, parse, segment, words
from corpusmill.session import materialize


@dataclass
class Pipeline:
    """Settings of a run; `run` gives the frame of each stage, written to the shared folder."""

    len_cutoff: int = 50
    banding: dedup.Banding = field(default_factory=dedup.Banding)
    omit_duplicates: bool = True
    vocab_size: int = 1000

    def run(self, pages: DataFrame) -> dict[str, DataFrame]:
        """`pages` has page_id (unique), url and text (HTML)."""
        parsed = materialize(parse.parsed(pages, ["page_id", "url"]), "parsed")
        normal = materialize(normalize.normalized(parsed, self.len_cutoff), "normalized")
        unique = materialize(dedup.deduplicated(normal, self.banding), "deduplicated")
        sentences = materialize(segment.segmented(unique, self.omit_duplicates), "segmented")
        frequencies = materialize(words.word_frequencies(sentences), "frequencies")
        merges = materialize(bpe.train(frequencies, self.vocab_size), "merges")
        vocab = materialize(bpe.vocabulary(frequencies, merges), "vocabulary")
        tokens = materialize(bpe.tokenized(sentences, vocab), "tokenized")
        return {"parsed": parsed, "normalized": normal, "deduplicated": unique, "segmented": sentences, "frequencies": frequencies, "merges": merges, "vocabulary": vocab, "tokenized": tokens}
