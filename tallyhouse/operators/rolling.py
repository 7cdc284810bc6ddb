"""Rolling distinct counts that add up: bitmaps of numbered members per day and slice.

Members get dense numbers once. A day's members of a slice are bitmaps, one per bucket of numbers;
bitmaps of several days or slices are joined by OR, so any window and any roll-up is counted exactly
without going back to the rows, and a new day adds its own bitmaps only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.operators.stored import stored

ID_SHIFT = 33  # monotonically_increasing_id: partition above these bits, row below


def number_members(ids: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``member`` and ``number``: 1, 2, 3 … for every distinct member, those of ``known`` unchanged.

    New members are numbered inside their partition; only the partitions' sizes meet in one task.
    """
    member = ids.columns[0]
    new = ids.select(F.col(member).alias("member")).filter(F.col("member").isNotNull()).distinct()
    if known is not None:
        new = new.join(known, "member", "left_anti")
    placed = stored(new.withColumn("_at", F.monotonically_increasing_id()), "members").withColumn("_part", F.shiftright("_at", ID_SHIFT))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    last = 0 if known is None else known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    row = F.col("_at").bitwiseAND(F.lit((1 << ID_SHIFT) - 1))
    numbered = placed.join(starts, "_part").select("member", (F.col("_before") + row + 1 + last).alias("number"))
    return numbered if known is None else known.unionByName(numbered)


def daily_bitmaps(rows: DataFrame, numbers: DataFrame, member: str, day: str, slices: Sequence[str]) -> DataFrame:
    """``day``, the slice columns, ``bucket`` and ``bitmap`` of the members seen."""
    seen = rows.select(F.col(member).alias("member"), F.col(day).alias("day"), *slices).distinct().join(numbers, "member")
    placed = seen.select("day", *slices, F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("bit"))
    return placed.groupBy("day", *slices, "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def add_days(stored_bitmaps: DataFrame, rows: DataFrame, numbers: DataFrame, member: str, day: str, slices: Sequence[str]) -> DataFrame:
    """Stored bitmaps with those of the days after the last stored one; older rows are not read."""
    last = stored_bitmaps.agg(F.max("day")).first()[0]
    new = rows if last is None else rows.filter(F.col(day) > F.lit(last))
    return stored_bitmaps.unionByName(daily_bitmaps(new, numbers, member, day, slices))


def rolling_distinct(bitmaps: DataFrame, days: DataFrame, window: int, slices: Sequence[str], name: str) -> DataFrame:
    """Distinct members in the ``window`` days up to each day of ``days`` (``snapshot_date``), per slice, any subset of those stored."""
    span = F.sequence(F.date_sub("snapshot_date", window - 1), F.col("snapshot_date"))
    pairs = days.select(F.explode(span).alias("day"), "snapshot_date")
    joined = bitmaps.join(pairs, "day").groupBy("snapshot_date", *slices, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("_n"))
    return joined.groupBy("snapshot_date", *slices).agg(F.sum("_n").alias(name))
