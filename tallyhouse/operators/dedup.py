"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of every key under ``order`` (state NULL placement explicitly).

    The rank filter is applied before the exchange as well, so each map task sends at most
    one row per key and a hot key never fills a task.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str | Column], at: str, *tie_break: Column) -> DataFrame:
    """The newest row of every key; a missing timestamp never wins over a known one."""
    return first_per_key(df, keys, [F.col(at).desc_nulls_last(), *tie_break])
