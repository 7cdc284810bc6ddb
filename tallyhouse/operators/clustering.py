"""Rows laid out by several columns at once, so that filters on any of them skip row groups.

Each column is cut into a few ranges of about equal size, and the bits of the range numbers are
interleaved to one key: rows near in the key are near in every column. Files get ranges of the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.keys import packed, unpacked

RANGE_BITS = 4  # a column is cut into 2 ** this many ranges
PREFIX = 7  # bytes of a string that are told apart
CLUSTER_KEY = "_cluster_key"
HASHES = ("_sk", "_hash", "customer_id")  # names of columns that are likely hex text; only the size of the shuffle depends on it


def as_number(df: DataFrame, column: str) -> Column:
    """A number that grows with the column's values; strings by their first bytes."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    head = F.rpad(F.hex(F.substring(F.encode(c.cast("string"), "UTF-8"), 1, PREFIX)), 2 * PREFIX, "0")
    return F.conv(head, 16, 10).cast("double")


def range_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, list[float]]:
    """Values at which each column is cut, from one pass over those columns."""
    shares = [i / (1 << RANGE_BITS) for i in range(1, 1 << RANGE_BITS)]
    row = df.agg(*[F.percentile_approx(as_number(df, c), shares, 1000).alias(c) for c in columns]).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def rank_of(at: Column, cuts: Sequence[float], first: int = 0) -> Column:
    """How many of the ascending ``cuts`` are not above ``at``, by halving."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    return F.when(at >= F.lit(cuts[middle]), rank_of(at, cuts[middle + 1:], first + middle + 1)).otherwise(rank_of(at, cuts[:middle], first))


def with_cluster_key(df: DataFrame, bounds: dict[str, list[float]]) -> DataFrame:
    """``df`` with the interleaved bits of the columns' range numbers, the highest bit of the first column in front; NULL counts as lowest.

    Numbers and ranks have a projection of their own each, so that a row's are worked out once.
    """
    numbers, ranks = {c: f"_number_{i}" for i, c in enumerate(bounds)}, {c: f"_rank_{i}" for i, c in enumerate(bounds)}
    keyed = df.withColumns({numbers[c]: F.coalesce(as_number(df, c), F.lit(float("-inf"))) for c in bounds})
    keyed = keyed.withColumns({ranks[c]: rank_of(F.col(numbers[c]), cuts) for c, cuts in bounds.items()})
    bits = [(F.col(ranks[c]), bit) for bit in reversed(range(RANGE_BITS)) for c in bounds]
    placed = [F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long"), len(bits) - 1 - i) for i, (rank, bit) in enumerate(bits)]
    return keyed.select(*df.columns, reduce(lambda a, b: a.bitwiseOR(b), placed).alias(CLUSTER_KEY))


def clustered(df: DataFrame, columns: Sequence[str], within: Sequence[str] = (), bounds: dict[str, list[float]] | None = None) -> DataFrame:
    """``df`` dealt and sorted by the interleaved key, inside equal values of ``within``.

    Range partitioning samples its input, so ``df`` should come from stored files. Keys and hashes are dealt as bytes.
    """
    keyed = with_cluster_key(df, bounds or range_bounds(df, columns))
    order = [*within, CLUSTER_KEY]
    hashes = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in within and f.name.endswith(HASHES)]
    dealt = keyed.withColumns({c: packed(c) for c in hashes}).repartitionByRange(*order).withColumns({c: unpacked(c) for c in hashes})
    return dealt.sortWithinPartitions(*order, *columns).drop(CLUSTER_KEY)
