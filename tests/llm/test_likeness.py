"""Likeness of long near copies."""

import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tallyhouse.llm import simhash, syncmers


def test_likeness_does_not_fall_with_length(spark):
    """Two words of a hundred deleted, or a long paragraph put in; and halves in another order."""
    rng = np.random.default_rng(6)
    rows = []
    for n in (2_000, 10_000, 50_000):
        words = [f"w{x}" for x in rng.integers(0, 10**6, n)]
        rows.append((n, " ".join(words), " ".join(w for w in words if rng.random() > 0.02), " ".join(words[: n // 2] + [f"new{i}" for i in range(300)] + words[n // 2 :]), " ".join(words[n // 2 :] + words[: n // 2])))
    frame = spark.createDataFrame(rows, "n int, t string, deleted string, inserted string, turned string")
    kept = [syncmers.likeness(syncmers.sketch(F.col("t")), syncmers.sketch(F.col(c))) for c in ("deleted", "inserted", "turned", "t")]
    for deleted, inserted, turned, same in frame.select(*kept).collect():
        assert deleted > 0.8 and inserted > 0.8 and turned < 0.85 and same == 1.0


def test_blocks_are_abandoned():
    """Among unrelated fingerprints few planes are looked at; whatever is near is found all the same."""
    rng = np.random.default_rng(8)
    values = rng.integers(0, 2**63, 600, dtype=np.uint64)
    values[300:320] = values[:20] ^ np.uint64(1 << 40)
    own = simhash.planes(values)
    pairs, looked, every = set(), 0, 0
    for at in range(0, 600, simhash.QUERIES):
        i, j, n = simhash.near_later(values, own, np.arange(64), at, 2)
        pairs |= set(zip(i.tolist(), j.tolist()))
        looked, every = looked + n, every + 64 * min(simhash.QUERIES, 600 - at) * (own.shape[1] - at // 64)
    near = [(a, b) for a in range(600) for b in range(a + 1, 600) if int(values[a] ^ values[b]).bit_count() <= 2]
    assert pairs == set(near) and len(near) == 20
    assert looked < every / 3


def plain_sketch(words):
    """Anchors by the rule, with XXH64 chains computed plainly."""

    def chain(values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else int(v).to_bytes(8, "little"), seed)
        return seed

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    runs = [signed(chain(words[i : i + syncmers.S])) for i in range(len(words) - syncmers.S + 1)]
    found, inner = {}, syncmers.K - syncmers.S
    for i in range(len(runs) - inner):
        window = runs[i : i + inner + 1]
        if min(window) in (window[0], window[-1]):
            picked = [window[0], *window[1:][syncmers.S - 1 :: syncmers.S], window[-1]]
            h = chain([x & ((1 << 64) - 1) for x in picked]) & ((1 << syncmers.HASH_BITS) - 1)
            found.setdefault(h, i)
    if not found and words:
        found[chain(words) & ((1 << syncmers.HASH_BITS) - 1)] = 0
    return sorted((h << syncmers.PLACE_BITS) | i for h, i in found.items())


def plain_chain(pairs):
    """Longest chain of single pairs, by trying all."""
    best = []
    for x in sorted(pairs):
        best.append((x[1], 1 + max((n for t, n in best if t - syncmers.DRIFT < x[1]), default=0)))
    return max((n for _, n in best), default=0)


def test_sketches_are_recomputed(spark, documents):
    texts = [t for _, t in documents[:150] if t]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", syncmers.sketch(F.col("t")).alias("s"))
    got = {r.i: list(r.s) for r in rows.collect()}
    assert got == {i: plain_sketch(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in enumerate(texts)}


def test_chains_of_runs_reach_the_longest_chain(spark):
    """Edited texts: nearly as many pairs as the best chain of single pairs has; a chain takes runs whole, so less where parts changed places."""
    rng = np.random.default_rng(9)
    rows = []
    for case in range(12):
        words = [f"w{x}" for x in rng.integers(0, 400, 900)]
        cut = sorted(rng.integers(0, 900, 4).tolist())
        parts = [words[: cut[0]], words[cut[0] : cut[1]], words[cut[1] : cut[2]], words[cut[2] :]]
        other = sum(([parts[i] for i in rng.permutation(4)] if case % 3 == 0 else parts), [])
        rows.append((case, " ".join(words), " ".join(w for w in other if rng.random() > 0.03)))
    frame = spark.createDataFrame(rows, "i int, a string, b string").select("i", syncmers.sketch(F.col("a")).alias("a"), syncmers.sketch(F.col("b")).alias("b"))
    for r in frame.select("*", syncmers.chained(syncmers.common_anchors(F.col("a"), F.col("b"))).alias("n")).collect():
        at = {x >> syncmers.PLACE_BITS: x & syncmers.PLACES for x in r.b}
        pairs = [(x & syncmers.PLACES, at[x >> syncmers.PLACE_BITS]) for x in r.a if x >> syncmers.PLACE_BITS in at]
        longest = plain_chain(pairs)
        assert (0.7 if r.i % 3 == 0 else 0.97) * longest <= r.n <= longest + 2 and longest > 40


def test_a_shared_passage_is_seen_at_every_length(spark):
    """Texts that share sixty words have anchors in common, however long they are; unrelated ones have none."""
    rng = np.random.default_rng(10)
    rows = []
    for n in (500, 2_000, 20_000):
        for k in range(4):
            passage, a, b = ([f"{p}{x}" for x in rng.integers(0, 10**7, m)] for p, m in (("p", 60), ("a", n), ("b", n)))
            rows.append((n, " ".join(a[: n // 3] + passage + a[n // 3 :]), " ".join(b[: n // 2] + passage + b[n // 2 :]), " ".join(b)))
    frame = spark.createDataFrame(rows, "n int, a string, b string, c string").select("n", *[syncmers.sketch(F.col(c)).alias(c) for c in "abc"])
    for r in frame.select("n", syncmers.likeness(F.col("a"), F.col("b")).alias("near"), syncmers.likeness(F.col("a"), F.col("c")).alias("far")).collect():
        assert r.near > 0 and r.far == 0
    one = spark.createDataFrame([(1, rows[-1][1]), (2, rows[-1][2])], "doc_id long, text string")
    found = syncmers.anchors(one)
    shifts = found.filter("doc_id = 1").alias("x").join(found.filter("doc_id = 2").alias("y"), "hash").select(F.expr("y.place - x.place")).distinct().collect()
    assert [s[0] for s in shifts] == [20_000 // 2 - 20_000 // 3]
