"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the vocabulary files, the same on all executors, and the file that is used unless another is named.
TOKENIZERS = os.environ.get("CORPUSMILL_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: How texts are cut into pieces before merging; the usual pattern of this vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@cache
def encoding(folder: str = TOKENIZERS, name: str = VOCABULARY):
    """The tokenizer, read once in each worker."""
    import tiktoken

    with open(os.path.join(folder, name), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


#: Dimensions of a text's hashed token counts, and of their projection; bits of the curve's key for each of these.
HASHED, PROJECTED, BITS = 512, 3, 10


@cache
def projection() -> np.ndarray:
    return np.random.default_rng(8).standard_normal((HASHED, PROJECTED)).astype(np.float32)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places of cells (rows of coordinates) along Hilbert's curve, by untangling the axes bit by bit."""
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = np.uint64(q - 1)
        for i in range(n):
            high = (x[i] & np.uint64(q)) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], dtype=np.uint64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & np.uint64(q)) != 0, np.uint64(q - 1), np.uint64(0))
        q >>= 1
    x ^= turn
    key = np.zeros(x.shape[1], dtype=np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return key.astype(np.int64)


def curve_keys(counts: np.ndarray) -> np.ndarray:
    """Keys of texts along the curve, from their hashed token counts (rows)."""
    vectors = np.sqrt(counts)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    at = vectors @ projection() - np.full(HASHED, HASHED**-0.5, np.float32) @ projection()
    side = 1 << BITS
    return hilbert(np.clip((np.tanh(at) + 1) / 2 * side, 0, side - 1))


def _measure(curve: bool, folder: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(folder, name).encode_to_numpy
        for whole in batches:
            for begin in range(0, len(whole), 1000):
                batch = whole.slice(begin, 1000)
                sizes = np.zeros(len(batch), dtype=np.int64)
                counts = np.zeros((len(batch) if curve else 0, HASHED), dtype=np.float32)
                for i, text in enumerate(batch.column("text")):
                    tokens = encode(text.as_py(), disallowed_special=())
                    sizes[i] = len(tokens)
                    if curve:
                        counts[i] = np.bincount(tokens % HASHED, minlength=HASHED)
                yield pa.record_batch([batch.column("doc_id"), pa.array(sizes), pa.array(curve_keys(counts) if curve else np.zeros(len(batch), np.int64))], names=["doc_id", "n_tokens", "curve"])

    return run


def measured(documents: DataFrame, curve: bool = False, folder: str = TOKENIZERS, name: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens and, where asked for, curve: the place of the text along a space-filling curve.

    Null ids and null or empty texts give no row; other columns are dropped.
    """
    some = documents.where("doc_id is not null and text is not null and text <> ''").select("doc_id", "text")
    read = some.mapInArrow(_measure(curve, folder, name), "doc_id long, n_tokens long, curve long")
    return read if curve else read.drop("curve")


def sourced(documents: DataFrame) -> DataFrame:
    """doc_id, source (trimmed, lower case), n_tokens; for documents without a source it is null."""
    some = documents.where("doc_id is not null and text is not null and text <> ''").select("doc_id", F.lower(F.trim("source")).alias("source"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding().encode_to_numpy
        for batch in batches:
            sizes = [len(encode(t.as_py(), disallowed_special=())) for t in batch.column("text")]
            yield pa.record_batch([batch.column("doc_id"), batch.column("source"), pa.array(sizes, pa.int64())], names=["doc_id", "source", "n_tokens"])

    return some.mapInArrow(run, "doc_id long, source string, n_tokens long")
