from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bartide.llm import mixing, tokens

DOCS = "doc_id long, text string, source string"
TARGETS = "source string, target_share double, max_repeats int"


def docs(spark, sizes):
    """sizes: source to list of words per document (a word is a token)."""
    rows = [(s, n) for s, ns in sizes.items() for n in ns]
    return spark.createDataFrame([(i, " lake" * n if n is not None else None, s) for i, (s, n) in enumerate(rows)], DOCS)


@pytest.fixture(scope="module", autouse=True)
def vocabulary():
    try:
        open(tokens.vocabulary_path()).close()
    except FileNotFoundError:
        pytest.skip("no vocabularies")


def test_shares_caps_and_whole_documents(spark):
    d = docs(spark, {"a": [40] * 300, "b": [25, 75] * 20, "c": [10] * 20, "d": [5], None: [50] * 5, "e": [None, 0]})
    t = spark.createDataFrame([("a", 0.6, 1), ("b", 0.3, 2), ("c", 0.08, 4), ("gone", 0.02, 2), (None, 0.0, 1), ("e", 0.0, 1)], TARGETS)
    mix = mixing.Mix(d, t, block_tokens=32)
    rows = mix.rows.collect()
    report = {r.source: r for r in mix.report().collect()}
    assert set(report) == {"a", "b", "c", "gone", "e"} and not report["gone"].target_met and report["gone"].tokens == 0
    for s in "abc":
        assert report[s].target_met and abs(report[s].actual_share - report[s].target_share / 0.98) < 0.01
        assert report[s].most_uses <= {"a": 1, "b": 2, "c": 4}[s]
    # A pass never uses a token twice, and blocks hold what the documents hold.
    uses, sizes = Counter(), {r.doc_id: r.n for r in d.select("doc_id", (F.length("text") / 5).alias("n")).collect()}
    for r in rows:
        for k in range(r.tok_start, r.tok_start + r.n_tokens):
            uses[(r.source, r.use_no, r.doc_id, k)] += 1
        assert 0 <= r.tok_start and r.tok_start + r.n_tokens <= sizes[r.doc_id]
    assert max(uses.values()) == 1
    slots = defaultdict(set)
    for r in rows:
        slots[(r.shard, r.slot)].add((r.source, r.block, r.use_no))
    assert all(len(v) == 1 for v in slots.values())
    per = Counter(shard for shard, _ in slots)
    assert all({slot for sh, slot in slots if sh == s} == set(range(n)) for s, n in per.items()) and max(per.values()) - min(per.values()) <= 1
    again = mixing.Mix(d, t, block_tokens=32)
    assert sorted(map(tuple, again.rows.collect())) == sorted(map(tuple, rows))


def test_too_large_a_total_is_reported(spark):
    d = docs(spark, {"a": [64] * 40, "b": [64]})
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 3)], TARGETS)
    report = {r.source: r for r in mixing.Mix(d, t, block_tokens=32, total_tokens=2560).report().collect()}
    assert report["b"].tokens == 192 and report["b"].most_uses == 3 and not report["b"].target_met and report["a"].tokens == 1280


def test_empty(spark):
    t = spark.createDataFrame([("a", 1.0, 1)], TARGETS)
    mix = mixing.Mix(docs(spark, {}), t)
    assert mix.rows.count() == 0 and [r.target_met for r in mix.report().collect()] == [False]
    assert mixing.Mix(docs(spark, {"a": [5]}), t.limit(0)).rows.count() == 0


def test_small_sources_meet_their_share_to_the_token(spark):
    d = docs(spark, {"a": [40] * 300, "three": [13, 20, 11], "one": [7]})
    t = spark.createDataFrame([("a", 0.9, 1), ("three", 0.07, 3), ("one", 0.03, 9)], TARGETS)
    report = {r.source: r for r in mixing.Mix(d, t, block_tokens=16).report().collect()}
    total = sum(r.tokens for r in report.values())
    assert all(r.target_met and r.tokens == r.planned_tokens and abs(r.tokens - r.target_share * total) <= 1 for r in report.values())
    assert report["one"].most_uses <= 9 and report["three"].most_uses <= 3 and 0 < report["a"].unused_share < 1


def test_permutations_and_draws():
    for n in (1, 2, 3, 5, 16, 17, 1000, 4097):
        p = mixing.Permutation(n, "k", n)
        there = p(np.arange(n))
        assert sorted(there.tolist()) == list(range(n)) and (p(there, back=True) == np.arange(n)).all()
    steps = np.diff(mixing.Permutation(4096, 1)(np.arange(4096)))
    assert len(set(steps.tolist())) > 2000
    for counts in ([5, 0, 40, 1], [10**10, 3 * 10**10, 7]):
        counts, shards = np.array(counts, np.int64), 7
        lo = np.zeros(len(counts), np.int64)
        for m in range(shards):
            taken, here = mixing._drawn(counts, shards, m, 3)
            assert (taken == lo).all() and here.sum() == int(counts.sum()) * (m + 1) // shards - int(counts.sum()) * m // shards
            lo += here
        assert (lo == counts).all()


def test_every_total_is_met_to_the_token():
    for tokens in (1, 7, 16, 17, 100):
        for want in range(1, 3 * tokens + 1):
            s = [mixing.Source("s", 1.0, 3, tokens, 1)]
            mixing.plan(s, 16, want, 5)
            (s,) = s
            blocks, got = s.blocks(16), 0
            for j in range(s.slots):
                block = int(mixing.Permutation(blocks, 5, "s", j // blocks)(np.array([j % blocks]))[0])
                got += min(16 if block < blocks - 1 else tokens - 16 * (blocks - 1), s.last if j == s.slots - 1 else 16)
            assert got == want == s.planned


def test_repeated_rows_and_clashing_columns(spark):
    d, t = docs(spark, {"a": [40] * 30, "b": [25] * 20}), spark.createDataFrame([("a", 0.6, 1), ("b", 0.4, 2)], TARGETS)
    plain = sorted(map(tuple, mixing.Mix(d, t, block_tokens=32).rows.collect()))
    odd = d.union(d).withColumns({c: F.lit(None).cast("string") for c in ("block", "shard", "slot", "n_tokens", "start", "at", "k", "_h", "_b", "take")})
    again = mixing.Mix(odd, t.union(t).withColumn("tokens", F.lit(1)), block_tokens=32)
    assert sorted(map(tuple, again.rows.collect())) == plain and [r.most_uses <= r.max_repeats for r in again.report().collect()] == [True, True]
