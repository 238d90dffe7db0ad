"""Mixing sources to target weights.

Method: the tokens of each source, its documents in a pseudorandom order, are one
stream cut into blocks of fixed length. Output shards draw source counts: multinomial
draws conditioned on the totals that the targets ask for, so the shares hold to the token
and no cap is passed. Slot j of a source is mapped through the pseudorandom index
permutation of its pass to a block; blocks and slots are joined by index.

A block is the spans of documents that it covers; a pass uses each block once, so no
document is used more often than its source has passes, at most ``max_repeats``. The last
slot of a source takes only as many tokens of its block as its target still lacks.

The draws are a tree: the counts of a range of shards are split between its halves, each
with its own random numbers. A shard follows its path from the root, so executors make
their shards from the seed alone and the driver holds one row per source. Permutations
are Feistel networks over the least power of four that holds the index, walked until
they land below its end; neighbours end anywhere.

The total is the largest at which every source that has tokens meets its target within
its cap, unless ``total_tokens`` asks for another; sources that fall short then stand in
the report with what they reach, and so does what each source leaves unused.

Offsets in a stream are prefix sums by hash bucket: bucket totals on a small table, and
a window inside each bucket, so a source with a third of all documents is many tasks.

Defined results: documents with null or unlisted source, or without tokens (null, empty
text), are not in the mix; a source without tokens gets nothing and its target is
reported as missed; the last block of a source may be shorter; equal inputs and seed
give equal mixes; empty tables give no slots; repeated rows of a document, or of a
target, count once (the longest, the larger share and cap). A target is met if the share reached
differs by no more than a hundredth of it.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bartide.llm.tokens import sizes
from bartide.session import cut

#: Parameters: tokens of a block, slots of a shard, documents of a bucket, rounds of a permutation,
#: slots from which on a draw is its expectation (numpy's draws end there; its deviation is below 1e-4 of it).
BLOCK_TOKENS, SLOTS_PER_SHARD, BUCKET_DOCS, FEISTEL_ROUNDS, LARGE_DRAW = 1024, 65_536, 50_000, 6, 500_000_000


@dataclass
class Source:
    name: str
    share: float
    cap: int
    tokens: int = 0
    docs: int = 0
    planned: int = 0  # tokens
    slots: int = 0
    last: int = 0  # tokens of the last slot

    def blocks(self, length: int) -> int:
        return -(-self.tokens // length)


def streams(documents: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """source, doc_id, n_tokens, start: the place of each document in its source's stream."""
    wanted = documents.join(targets.select("source").distinct(), "source", "left_semi")
    keyed = wanted.select(F.struct("doc_id", "source").alias("k"), "text")
    sized = sizes(keyed, "k", "text").where("n_tokens > 0").groupBy("k.source", "k.doc_id").agg(F.max("n_tokens").alias("n_tokens"))
    sized = cut(sized.withColumn("_h", F.xxhash64("doc_id", F.lit(seed))), "sizes")
    buckets = -(-sized.count() // BUCKET_DOCS) + 15
    sized = sized.withColumn("_b", F.pmod(F.shiftrightunsigned("_h", 20), F.lit(buckets)).cast("int"))
    totals = sized.groupBy("source", "_b").agg(F.sum("n_tokens").alias("_t"))
    before = F.sum("_t").over(Window.partitionBy("source").orderBy("_b")) - F.col("_t")
    totals = totals.select("source", "_b", before.alias("_base"))
    inside = Window.partitionBy("source", "_b").orderBy("_h", "doc_id")
    placed = sized.withColumn("_to", F.sum("n_tokens").over(inside)).join(totals, ["source", "_b"])
    return placed.select("source", "doc_id", "n_tokens", (F.col("_base") + F.col("_to") - F.col("n_tokens")).alias("start"))


def spans(placed: DataFrame, length: int) -> DataFrame:
    """source, block, at (place in the block), doc_id, tok_start, n_tokens: what each block holds."""
    first, last = F.expr(f"start div {length}"), F.expr(f"(start + n_tokens - 1) div {length}")
    rows = placed.withColumn("block", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("start"), F.col("block") * length)
    hi = F.least(F.col("start") + F.col("n_tokens"), (F.col("block") + 1) * length)
    return rows.select("source", "block", (lo - F.col("block") * length).alias("at"), "doc_id", (lo - F.col("start")).alias("tok_start"), (hi - lo).alias("n_tokens"))


class Permutation:
    """A pseudorandom permutation of 0 ... n-1 named by ``key``."""

    def __init__(self, n: int, *key):
        self.n = n
        self.half = np.uint64(max(1, -(-max(n - 1, 1).bit_length() // 2)))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        digest = hashlib.blake2b(repr(key).encode(), digest_size=8 * FEISTEL_ROUNDS).digest()
        self.keys = np.frombuffer(digest, np.uint64)

    def _mixed(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = (x + key) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (x ^ (x >> np.uint64(32))) & self.mask

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1] if back else self.keys:
            if back:
                left, right = right ^ self._mixed(left, key), left
            else:
                left, right = right, left ^ self._mixed(right, key)
        return left << self.half | right

    def __call__(self, index: np.ndarray, back: bool = False) -> np.ndarray:
        """The places of ``index``, or (``back``) the indices of places."""
        out = self._once(np.asarray(index).astype(np.uint64), back)
        while (over := np.flatnonzero(out >= np.uint64(self.n))).size:
            out[over] = self._once(out[over], back)
        return out.astype(np.int64)


def plan(sources: list[Source], length: int, total_tokens: int | None, seed: int) -> None:
    """Set each source's tokens and slots."""
    able = [s for s in sources if s.tokens and s.share > 0 and s.cap > 0]
    if not able:
        return
    total = min(s.cap * s.tokens / s.share for s in able) if total_tokens is None else total_tokens
    for s in able:
        s.planned = min(round(s.share * total), s.cap * s.tokens)
        passes, rest = divmod(s.planned, s.tokens)
        blocks = s.blocks(length)
        short = length * blocks - s.tokens  # what the last block lacks
        at = int(Permutation(blocks, seed, s.name, passes)(np.array([blocks - 1]), back=True)[0])  # its slot in the last pass
        n = -(-rest // length)
        if n > at:  # the short block is among the slots
            n = -(-(rest + short) // length)
        s.slots = passes * blocks + n
        if n:
            s.last = rest - ((n - 1) * length - (short if at < n - 1 else 0))
        else:  # whole passes: the last slot takes its whole block
            s.last = length


def _halved(counts: np.ndarray, want: int, *key) -> np.ndarray:
    """A draw of ``want`` of the slots counted by source, without replacement."""
    total = int(counts.sum())
    rng = np.random.default_rng(np.frombuffer(hashlib.blake2b(repr(key).encode(), digest_size=32).digest(), np.uint64))
    if total < LARGE_DRAW:
        return rng.multivariate_hypergeometric(counts, want, method="marginals")
    exact = [int(c) * want for c in counts]
    got = np.array([e // total for e in exact], np.int64)
    rest = np.array([(e % total) / total for e in exact])
    order = np.argsort(-(rest + rng.random(len(rest)) * 1e-9), kind="stable")
    got[order[: want - int(got.sum())]] += 1
    return got


def _drawn(counts: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """By source: slots in the shards before ``shard``, and in it."""
    total, a, b = int(counts.sum()), 0, shards
    upto = lambda m: total * m // shards
    taken, left = np.zeros(len(counts), np.int64), counts.copy()
    while b - a > 1:
        mid = (a + b) // 2
        got = _halved(left, upto(mid) - upto(a), seed, a, b)
        if shard < mid:
            left, b = got, mid
        else:
            taken, left, a = taken + got, left - got, mid
    return taken, left


def slots(spark, sources: list[Source], length: int, seed: int) -> DataFrame:
    """shard, slot, source, block, use_no, take: made on the executors, shard by shard."""
    used = [s for s in sources if s.slots]
    counts = np.array([s.slots for s in used], np.int64)
    total = int(counts.sum()) if used else 0
    shards = max(1, -(-total // SLOTS_PER_SHARD), min(16, total))

    def made(batches):
        for pdf in batches:
            for m in pdf["id"]:
                taken, here = _drawn(counts, shards, int(m), seed)
                place = Permutation(int(here.sum()), seed, "shard", int(m)) if here.sum() else None
                base = 0
                for s, lo, n in zip(used, taken.tolist(), here.tolist()):
                    blocks = s.blocks(length)
                    for begin in range(0, n, SLOTS_PER_SHARD):
                        j = np.arange(lo + begin, lo + min(n, begin + SLOTS_PER_SHARD))
                        block = np.empty(len(j), np.int64)
                        for use in range(int(j[0]) // blocks, int(j[-1]) // blocks + 1) if len(j) else ():
                            at = j // blocks == use
                            block[at] = Permutation(blocks, seed, s.name, use)(j[at] % blocks)
                        take = np.where(j == s.slots - 1, s.last, length)
                        yield pd.DataFrame({"shard": m, "slot": place(base + j - lo), "source": s.name, "block": block, "use_no": (j // blocks + 1).astype(np.int32), "take": take})
                    base += n

    ids = spark.range(0, shards if used else 0, 1, min(shards, 4096))
    return ids.mapInPandas(made, "shard long, slot long, source string, block long, use_no int, take long")


class Mix:
    """``rows``: shard, slot, source, block, use_no, doc_id, tok_start, n_tokens. ``report()``: one row per source."""

    def __init__(self, documents: DataFrame, targets: DataFrame, block_tokens: int = BLOCK_TOKENS, total_tokens: int | None = None, seed: int = 7, most_sources: int = 10_000):
        spark = documents.sparkSession
        targets = targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
        listed = targets.limit(most_sources + 1).collect()
        if len(listed) > most_sources:
            raise ValueError(f"more than {most_sources} sources")
        placed = cut(streams(documents, targets, seed), "streams")
        have = {r.source: r for r in placed.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("d")).collect()}
        self.sources = [Source(r.source, float(r.target_share or 0), int(r.max_repeats or 0), int(have[r.source].t) if r.source in have else 0, int(have[r.source].d) if r.source in have else 0) for r in sorted(listed, key=lambda r: r.source)]
        plan(self.sources, block_tokens, total_tokens, seed)
        self.length, self.spark = block_tokens, spark
        chosen = slots(spark, self.sources, block_tokens, seed)
        # Both sides grow with the corpus: neither is ever broadcast.
        both = chosen.hint("merge").join(spans(placed, block_tokens).hint("merge"), ["source", "block"]).where("at < take")
        self.rows = both.select("shard", "slot", "source", "block", "use_no", "doc_id", "tok_start", F.least(F.col("n_tokens"), F.col("take") - F.col("at")).alias("n_tokens"))

    def report(self) -> DataFrame:
        """Per source: what the rows hold of it. ``unused_share``: of its tokens that no slot has; ``actual_share`` of the mix."""
        got = self.rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.max("use_no").alias("most_uses"))
        unused = lambda s: max(0.0, 1 - s.planned / s.tokens) if s.tokens else 0.0
        wanted = self.spark.createDataFrame(
            [(s.name, s.share, s.cap, s.docs, s.tokens, s.planned, unused(s)) for s in self.sources],
            "source string, target_share double, max_repeats int, documents long, available_tokens long, planned_tokens long, unused_share double",
        )
        both = wanted.join(got, "source", "left").withColumns({"tokens": F.coalesce("tokens", F.lit(0).cast("long")), "most_uses": F.coalesce("most_uses", F.lit(0))})
        total = F.sum("tokens").over(Window.partitionBy())  # one row per listed source
        listed = sum(s.share for s in self.sources if s.slots) or 1.0
        share = F.when(total > 0, F.col("tokens") / total).otherwise(0.0)
        return both.withColumn("actual_share", share).withColumn("share_among_available", F.when(F.col("planned_tokens") > 0, F.col("target_share") / listed)).withColumn(
            "target_met", (F.col("tokens") > 0) & (F.abs(share - F.col("target_share") / listed) <= 0.01 * F.col("target_share") / listed))
