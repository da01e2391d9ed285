"""A source that fetches addresses, at the pace of a token bucket."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

AGENT = "corpusmill/1.0"


@dataclass
class TokenBucket:
    """Lets `rate` requests a second pass, after a pause up to `limit` at once.

    The bucket starts empty. More than one whole token is needed to pass without waiting; else the missing part is waited
    for, give or take `jitter` seconds, and the bucket is empty afterwards.
    """

    rate: float = 1.0
    limit: float = 10.0
    jitter: float = 0.3
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    shake: Callable[[float, float], float] = random.uniform
    tokens: float = field(default=0.0, init=False)
    seen: float = field(init=False)

    def __post_init__(self) -> None:
        self.seen = self.clock()

    def acquire(self) -> float:
        """Wait as long as needed; the seconds that were waited."""
        now = self.clock()
        self.tokens = min(self.limit, self.tokens + self.rate * (now - self.seen))
        self.seen = now
        if self.tokens > 1:
            self.tokens -= 1
            return 0.0
        pause = max(0.0, (1 - self.tokens) / self.rate + self.shake(-self.jitter, self.jitter))
        self.sleep(pause)
        self.seen, self.tokens = self.clock(), 0.0
        return pause


def http_get(url: str) -> tuple[int, str]:
    """Status and body of an address."""
    import requests

    answer = requests.get(url, headers={"User-Agent": AGENT}, timeout=60)
    return answer.status_code, answer.text


def fetched(urls: DataFrame, get: Callable[[str], tuple[int, str]] = http_get, rate: float = 1.0, limit: float = 10.0) -> DataFrame:
    """url, text, http_status of each address. Every task has its own bucket; the rate is shared among the partitions."""
    share = rate / max(1, urls.rdd.getNumPartitions())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = TokenBucket(share, limit)
        for batch in batches:
            for url in batch.column("url").to_pylist():
                bucket.acquire()
                status, text = get(url)
                yield pa.record_batch([pa.array([url]), pa.array([text], pa.string()), pa.array([status], pa.int32())], names=["url", "text", "http_status"])

    return urls.select("url").mapInArrow(run, "url string, text string, http_status int")
