"""A mixture of sources with target shares of its tokens.

Tokens are summed up by source and by ranges of a hash of the document id. The range in which a source's budget ends is
summed up again in finer ranges, until the budget ends between two documents; the mixture is then a filter on the hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tokens import sourced
from corpusmill.session import materialize

#: Bits of the hash that one histogram tells apart, and how often the range at the budget's end is refined.
BITS, LEVELS = 12, 4
HASH_BITS = BITS * LEVELS
#: Targets tables larger than this are an error; a histogram has at most 2^BITS rows for each target.
MOST_TARGETS = 1000


def _plan(totals: dict[str, int], targets: list[tuple[str, float, int]]) -> tuple[float, dict[str, float]]:
    """Size of the largest mixture with the target shares, and the tokens of each source in it."""
    have = [(s, share, most) for s, share, most in targets if totals.get(s, 0) and share > 0 and most > 0]
    shares = sum(share for _, share, _ in have)
    if not have:
        return 0.0, {}
    size = min(totals[s] * most / (share / shares) for s, share, most in have)
    return size, {s: size * share / shares for s, share, _ in have}


def _asked(targets: DataFrame) -> list[tuple[str, float, int]]:
    name = F.lower(F.trim("source_name"))
    rows = targets.select(name.alias("s"), "target_share", "max_repeat").where("s is not null and target_share is not null and max_repeat is not null")
    rows = rows.groupBy("s").agg(F.sum("target_share").alias("share"), F.max("max_repeat").alias("most")).limit(MOST_TARGETS + 1).collect()
    if len(rows) > MOST_TARGETS:
        raise ValueError(f"more than {MOST_TARGETS} targets")
    return sorted((r["s"], float(r["share"]), int(r["most"])) for r in rows)


def _sized(documents: DataFrame) -> DataFrame:
    place = F.shiftrightunsigned(F.xxhash64(F.lit("mixture"), "doc_id"), 64 - HASH_BITS)
    return materialize(sourced(documents).where("source is not null").withColumn("place", place), "source-sizes")


def _thresholds(sized: DataFrame, rest: dict[str, float]) -> dict[str, int]:
    """For each source the place below which its documents add up to the rest of its budget, or as near as one can get."""
    low = dict.fromkeys(rest, 0)
    left = dict(rest)
    spark = sized.sparkSession
    for level in range(1, LEVELS + 1):
        shift = HASH_BITS - BITS * level
        if not low:
            break
        at = spark.createDataFrame([(s, p) for s, p in low.items()], "source string, low long")
        inside = (F.col("place") >= F.col("low")) & (F.col("place") < F.col("low") + F.lit(1 << (shift + BITS)))
        cell = F.shiftright("place", shift)
        # at most 2^BITS rows for each target
        rows = sized.join(F.broadcast(at), "source").where(inside).groupBy("source", cell.alias("cell")).agg(F.sum("n_tokens").alias("t")).toArrow().to_pylist()
        rows.sort(key=lambda r: (r["source"], r["cell"]))
        found: dict[str, int] = {}
        for r in rows:
            s = r["source"]
            if s in found:
                continue
            if r["t"] > left[s]:
                found[s] = r["cell"] << shift
            else:
                left[s] -= r["t"]
        for s in low:
            # what is not found ends behind the last cell: the whole range is in
            low[s] = found.get(s, low[s] + (1 << (shift + BITS)))
        done = {s for s in low if s not in found}
        rest.update({s: low[s] for s in done})
        for s in done:
            low.pop(s)
        if level == LEVELS:
            rest.update(low)
    return {s: int(p) for s, p in rest.items()}


def mixed(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """doc_id, source, n_tokens, copies of each document in the mixture.

    `documents` has doc_id (unique), text and source; sources are compared in lower case without outer blanks. Documents
    without id, source or tokens are in no mixture. `targets` has source_name, target_share and max_repeat; several rows
    of a source add up; rows with nulls are left out. Shares are taken relative to their sum over the targets that have
    documents. The mixture is the largest that meets the shares within max_repeat. Each source comes whole as often as
    its budget allows, and once more for the documents below its threshold.
    """
    return _mixed(_sized(documents), _asked(targets))[0]


def _mixed(sized: DataFrame, asked: list[tuple[str, float, int]]) -> tuple[DataFrame, dict[str, int]]:
    names = [s for s, *_ in asked]
    rows = sized.where(F.col("source").isin(names)).groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()
    totals = {r["source"]: r["t"] for r in rows}
    most = {s: m for s, _, m in asked}
    _, budgets = _plan(totals, asked)
    whole = {s: min(most[s], int(b / totals[s] + 1e-9)) for s, b in budgets.items()}
    cut = _thresholds(sized, {s: b - whole[s] * totals[s] for s, b in budgets.items() if whole[s] < most[s]})
    plan = sized.sparkSession.createDataFrame([(s, whole[s], cut.get(s, 0)) for s in budgets] or [], "source string, whole int, below long")
    copies = (F.col("whole") + (F.col("place") < F.col("below")).cast("int")).alias("copies")
    return sized.join(F.broadcast(plan), "source").select("doc_id", "source", "n_tokens", copies).where("copies > 0"), totals


def mixture_report(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_share, available_tokens, mixed_tokens, actual_share, most_copies of each target.

    target_share is as entered; a target without documents has zeros.
    """
    asked = _asked(targets)
    mixture, totals = _mixed(_sized(documents), asked)
    got = mixture.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"), F.max("copies").alias("most_copies"))
    spark = documents.sparkSession
    wanted = spark.createDataFrame([(s, share, int(totals.get(s, 0))) for s, share, _ in asked], "source string, target_share double, available_tokens long")
    both = wanted.join(got, "source", "left")
    every = got.agg(F.sum("mixed_tokens").alias("all_tokens"))
    tokens = F.coalesce("mixed_tokens", F.lit(0))
    out = both.join(F.broadcast(every))
    return out.select("source", "target_share", "available_tokens", tokens.alias("mixed_tokens"), F.coalesce(tokens / F.col("all_tokens"), F.lit(0.0)).alias("actual_share"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"))
