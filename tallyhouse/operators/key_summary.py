"""Which partitions may hold a key: a range and a Bloom filter of each partition's keys.

A filter is a table of 64-bit words, as many as the partition's rows need, rounded up to a power of
two; a key sets bits of one word. Filters of one size share their word numbers, so keys find the
partitions that may hold them by one equality join, however many partitions there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_WORD = 2
BITS = 8
PAIRS = 1 << 22  # up to this many pairs of a key and a partition, words are always asked


@dataclass(frozen=True)
class Part:
    """A partition of a stored table: where its rows and its key words lie, and what its keys range over."""

    value: str
    path: str
    words: str = ""
    size: int = 0
    low: str | None = None
    high: str | None = None


def _mask(key: Column) -> Column:
    hashed = F.xxhash64(key, F.lit("bits"))
    places = [F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS)]
    return reduce(lambda mask, bit: mask.bitwiseOR(bit), [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places])


def _word(key: Column, size: Column) -> Column:
    return F.call_function("shiftrightunsigned", F.xxhash64(key), (F.lit(64) - size).cast("int"))


def key_ranges(rows: DataFrame, partition: str, key: str) -> dict[str, tuple[int, str, str]]:
    """Per partition value the size of its filter (words as a power of two) and its least and greatest key."""
    found = rows.groupBy(partition).agg(F.count(key).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).collect()
    return {r[partition]: (max(1, math.ceil(math.log2(max(2, r.n / ROWS_PER_WORD)))), r.low, r.high) for r in found}


def key_words(rows: DataFrame, partition: str, key: str, sizes: dict[str, int]) -> DataFrame:
    """``size``, ``word``, ``mask`` per partition: the filters of all partitions in ``sizes``, a value per partition of the table."""
    size = F.element_at(F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair]), F.col(partition))
    placed = rows.filter(F.col(key).isNotNull()).select(partition, size.alias("size"), _word(F.col(key), size).alias("word"), _mask(F.col(key)).alias("mask"))
    return placed.groupBy(partition, "size", "word").agg(F.bit_or("mask").alias("mask"))


def may_hold(keys: DataFrame, key: str, parts: Iterable[Part], partition: str) -> list[str]:
    """Values of the partitions that may hold one of ``keys``; no partition that does is left out.

    Partitions whose range lies beside the keys are not opened at all; of the others only the words are read.
    Where the keys would meet more words than the partitions have rows, the partitions in range are all named.
    """
    spark = keys.sparkSession
    low, high, n = keys.agg(F.min(key), F.max(key), F.count(key)).first()
    near = [p for p in parts if low is not None and p.low is not None and p.low <= high and low <= p.high]
    if not near:
        return []
    if n * len(near) > max(PAIRS, sum(ROWS_PER_WORD << p.size for p in near)):
        return sorted(p.value for p in near)
    words = spark.read.parquet(*[p.words for p in near]).filter(F.col(partition).isin([p.value for p in near]))
    sizes = F.explode(F.array(*[F.lit(s) for s in sorted({p.size for p in near})]))
    asked = keys.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key"), sizes.alias("size"))
    asked = asked.select("size", _word(F.col("_key"), F.col("size")).alias("word"), _mask(F.col("_key")).alias("_own"))
    met = asked.join(words, ["size", "word"]).filter(F.col("mask").bitwiseAND(F.col("_own")) == F.col("_own"))
    return sorted(r[0] for r in met.select(partition).distinct().collect())
