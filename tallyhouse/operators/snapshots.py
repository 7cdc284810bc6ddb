"""As-of measures on a set of snapshot days, without joining facts to days by inequality.

Facts are first reduced to (entity, day). A small day map then sends each day to the few
snapshots it concerns by equality; running totals use a window over one entity's snapshots. The map
is a part of a calendar and goes to every task, so rows stay where their entity's others are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def snapshot_days(mode: str, bounds: DataFrame, as_of: Column, day: str) -> DataFrame:
    """Snapshot days for ``today`` or ``month_end``: month-ends inside the history, plus as_of."""
    one = bounds.sparkSession.range(1).select(as_of.alias("snapshot_date"))
    if mode == "today":
        return one
    lo_hi = bounds.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    first = F.add_months(F.trunc("lo", "month"), 0)
    ends = lo_hi.select(
        F.explode(F.transform(F.sequence(first, F.trunc("hi", "month"), F.expr("interval 1 month")), F.last_day)).alias(
            "snapshot_date"
        ),
        "lo",
        "hi",
    )
    ends = ends.filter(F.col("snapshot_date").between(F.col("lo"), F.col("hi"))).select("snapshot_date")
    return ends.union(one).distinct()


def trailing_map(days: DataFrame, first_back: int, last_back: int, day: str = "day") -> DataFrame:
    """(day, snapshot_date) pairs with snapshot - first_back <= day <= snapshot - last_back."""
    span = F.sequence(F.date_sub("snapshot_date", first_back), F.date_sub("snapshot_date", last_back))
    return days.select(F.explode(span).alias(day), "snapshot_date")


def next_snapshot_map(days: DataFrame, first_day: Column, day: str = "day") -> DataFrame:
    """Each day to the first snapshot on or after it; days after the last snapshot are absent.

    The window has no key, but its input is only the list of snapshot days.
    """
    prev = F.lag("snapshot_date").over(W.orderBy("snapshot_date"))
    spans = days.withColumn("_from", F.coalesce(F.date_add(prev, 1), F.least(first_day, F.col("snapshot_date"))))
    return spans.select(F.explode(F.sequence("_from", "snapshot_date")).alias(day), "snapshot_date")


def trailing_totals(
    daily: DataFrame, days: DataFrame, keys: Sequence[str], day: str, totals: dict[str, Column], first_back: int, last_back: int
) -> DataFrame:
    """Sums over a trailing window of days before each snapshot, per key."""
    pairs = trailing_map(days, first_back, last_back, "_map_day")
    return (
        daily.join(F.broadcast(pairs), F.col(day) == F.col("_map_day"))
        .groupBy(*keys, "snapshot_date")
        .agg(*[expr.alias(name) for name, expr in totals.items()])
    )


def trailing_sums(
    daily: DataFrame, asked: DataFrame, keys: Sequence[str], day: str, values: dict[str, str], first_back: int, last_back: int
) -> DataFrame:
    """Sums over a trailing window of days before each asked (key, ``snapshot_date``), by running sums.

    A day's value enters the window once and leaves it once: two changes, however long the window and
    however many snapshots it meets. ``daily`` holds one row per key and day, ``asked`` one per key and
    snapshot; the exchange carries these rows and no copies. ``values`` maps columns to names.
    """
    comes = daily.select(*keys, F.date_add(day, last_back).alias("_at"), *[F.col(v) for v in values])
    goes = daily.select(*keys, F.date_add(day, first_back + 1).alias("_at"), *[(-F.col(v)).cast(daily.schema[v].dataType).alias(v) for v in values])
    points = asked.select(*keys, F.col("snapshot_date").alias("_at"), *[F.lit(0).cast(daily.schema[v].dataType).alias(v) for v in values], F.lit(True).alias("_asked"))
    line = comes.union(goes).withColumn("_asked", F.lit(False)).unionByName(points)
    so_far = W.partitionBy(*keys).orderBy("_at").rangeBetween(W.unboundedPreceding, W.currentRow)
    sums = line.select(*keys, "_at", "_asked", *[F.sum(v).over(so_far).alias(name) for v, name in values.items()])
    return sums.filter("_asked").select(*keys, F.col("_at").alias("snapshot_date"), *values.values())


def bucket_totals(
    daily: DataFrame, days: DataFrame, keys: Sequence[str], day: str, totals: dict[str, Column]
) -> DataFrame:
    """Sums of the days falling to each snapshot since the one before it, per key."""
    first = daily.agg(F.min(day)).scalar()
    pairs = next_snapshot_map(days, first, "_map_day")
    return (
        daily.join(F.broadcast(pairs), F.col(day) == F.col("_map_day"))
        .groupBy(*keys, "snapshot_date")
        .agg(*[expr.alias(name) for name, expr in totals.items()])
    )
