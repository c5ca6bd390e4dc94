"""One corpus from several sources, each with its target share of all tokens.

Sizes are summed by source and hash bucket, so what reaches the driver is one small row for each. With a budget each
source gives its target's tokens: whole copies of it, then the part of a further copy whose hashes lie below a threshold.
The threshold is found in the histogram; the bucket in which it falls is divided into finer buckets, again summed, until
a bucket holds one hash. The documents are then selected by comparing hashes, without a sort; a source's thresholds nest,
so a larger budget only adds documents.

The budget is the largest at which every source can give its share: the least, over the sources, of tokens available
times max_repeats by target share. A source of the targets without documents can give nothing: its share is spread over
the others in proportion, and it is reported with an actual share of 0. Documents of sources without a target, or without
a source, are left out. Documents without tokens take part and change nothing. Documents are unique by doc_id; copies of
one text are several documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialise
from .tokenize import DEFAULT_RANKS, count_column

#: Buckets of one histogram, and the bits of the hash.
BUCKET_BITS = 8
HASH_BITS = 56


@dataclass
class Cut:
    """What a source gives: whole copies of it, and the documents whose hash is below the threshold once more."""

    copies: int
    below: int


def _hash(key: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit("mix"), F.col(key)), 64 - HASH_BITS)


def _thresholds(sizes: DataFrame, wanted: dict[str, float]) -> dict[str, int]:
    """For each source the hash below which its documents hold at most the tokens wanted, as many as possible."""
    low = dict.fromkeys(wanted, 0)
    rest = dict(wanted)
    for bits in range(HASH_BITS - BUCKET_BITS, -1, -BUCKET_BITS):
        if not low:
            break
        bound = F.create_map(*(F.lit(x) for kv in low.items() for x in kv))
        span = 1 << (bits + BUCKET_BITS)
        inside = sizes.withColumn("low", F.element_at(bound, F.col("source"))).where((F.col("h") >= F.col("low")) & (F.col("h") < F.col("low") + span))
        table = inside.groupBy("source", F.shiftright(F.col("h") - F.col("low"), bits).alias("b")).agg(F.sum("n_tokens").alias("n"))
        by: dict[str, list[tuple[int, int]]] = {}
        for r in table.collect():
            by.setdefault(r["source"], []).append((r["b"], r["n"]))
        for s in low:
            at = 1 << BUCKET_BITS
            for b, n in sorted(by.get(s, [])):
                if n > rest[s]:
                    at = b
                    break
                rest[s] -= n
            low[s] += at << bits
    return low


def plan(sizes: DataFrame, targets: DataFrame) -> tuple[dict[str, Cut], dict[str, tuple[float, int]]]:
    """The cut of each source, and the target share and max_repeats of all sources of the targets. sizes: source, h, n_tokens."""
    goals = {r["source"]: (r["target_share"], r["max_repeats"]) for r in targets.where("source is not null").collect()}
    have = {r["source"]: r["n"] or 0 for r in sizes.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    able = {s: g for s, g in goals.items() if have.get(s, 0) > 0 and (g[0] or 0) > 0 and (g[1] or 0) > 0}
    if not able:
        return {}, goals
    share = sum(g[0] for g in able.values())
    budget = min(have[s] * m / (t / share) for s, (t, m) in able.items())
    wanted = {s: budget * t / share for s, (t, _) in able.items()}
    copies = {s: min(int((wanted[s] + 1e-6) // have[s]), able[s][1]) for s in able}
    rest = {s: wanted[s] - copies[s] * have[s] for s in able if copies[s] < able[s][1]}
    below = _thresholds(sizes, rest)
    return {s: Cut(copies[s], below.get(s, 0)) for s in able}, goals


def mixed(documents: DataFrame, targets: DataFrame, ranks: str = DEFAULT_RANKS) -> tuple[DataFrame, DataFrame]:
    """doc_id, source, n_tokens and repeats of the documents used; and the report of each source of the targets."""
    known = documents.join(F.broadcast(targets.select("source").where("source is not null").distinct()), "source", "left_semi")
    counted = count_column(known.select("doc_id", "source", "text"), ranks=ranks, keep=("doc_id", "source"))
    sizes = materialise(counted.select("doc_id", "source", "n_tokens", _hash("doc_id").alias("h")), "mix")
    cuts, goals = plan(sizes.select("source", "h", "n_tokens"), targets)
    repeats = F.lit(0)
    for s, c in cuts.items():
        repeats = F.when(F.col("source") == s, c.copies + (F.col("h") < c.below).cast("int")).otherwise(repeats)
    used = sizes.withColumn("repeats", repeats).where("repeats > 0").select("doc_id", "source", "n_tokens", "repeats")
    sums = used.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("repeats").cast("bigint").alias("uses"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"))
    total = sums.agg(F.sum("tokens")).first()[0]
    report = targets.where("source is not null").select("source", "target_share", "max_repeats").join(sums, "source", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return used, report.select("source", "target_share", "max_repeats", zero("documents"), zero("uses"), zero("tokens"), F.coalesce(F.col("tokens") / F.lit(total or 1), F.lit(0.0)).alias("actual_share"))
