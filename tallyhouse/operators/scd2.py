"""Type-2 history: detect changes, close old versions, open new ones."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.functions.keys import surrogate_key

META = ("scd_id", "scd_updated_at", "valid_from", "valid_to")


def greatest_or_null(*cols: Column) -> Column:
    """Greatest value, NULL as soon as one argument is NULL."""
    known = reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
    return F.when(known, F.greatest(*cols))


def _with_meta(rows: DataFrame, key: str, stamp: Column) -> DataFrame:
    return rows.withColumns(
        {
            "scd_id": surrogate_key([key], stamp),
            "scd_updated_at": stamp,
            "valid_from": stamp,
            "valid_to": F.lit(None).cast("timestamp"),
        }
    )


def scd2_start(current: DataFrame, key: str, *, now: Column, updated_at: str | None = None) -> DataFrame:
    """First load: every row opens a version at its update time, or at ``now``."""
    stamp = F.col(updated_at).cast("timestamp") if updated_at else now.cast("timestamp")
    return _with_meta(current, key, stamp)


def scd2_merge(
    history: DataFrame,
    current: DataFrame,
    key: str,
    *,
    now: Column,
    check: Sequence[str] | None = None,
    updated_at: str | None = None,
) -> DataFrame:
    """Fold the current rows into the history and return the whole new history.

    Pass ``check`` (columns compared NULL-safely, change stamped ``now``) or ``updated_at``
    (a later source timestamp opens a version at that time). Keys missing from ``current`` stay
    open. Only open versions meet the new rows, one per key on each side, so the join cannot
    fan out; closed versions pass by untouched.
    """
    if (check is None) == (updated_at is None):
        raise ValueError("give either check columns or updated_at")
    now = now.cast("timestamp")
    business = list(current.columns)
    closed = history.filter(F.col("valid_to").isNotNull())
    live = history.filter(F.col("valid_to").isNull())
    stamp = F.col(f"n.{updated_at}").cast("timestamp") if updated_at else now
    if updated_at:
        changed = stamp > F.col("o.scd_updated_at")
    else:
        changed = reduce(lambda a, b: a | b, [~F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in check])
    pair = live.alias("o").join(current.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    pair = pair.withColumns(
        {
            "_is_new": F.col(f"o.{key}").isNull(),
            "_changed": F.col(f"o.{key}").isNotNull() & F.col(f"n.{key}").isNotNull() & F.coalesce(changed, F.lit(False)),
            "_stamp": stamp,
        }
    )
    old_row = F.struct(
        *[F.col(f"o.{c}").alias(c) for c in business],
        F.col("o.scd_id").alias("scd_id"),
        F.col("o.scd_updated_at").alias("scd_updated_at"),
        F.col("o.valid_from").alias("valid_from"),
        F.when(F.col("_changed"), F.col("_stamp")).alias("valid_to"),
    )
    new_row = F.struct(
        *[F.col(f"n.{c}").alias(c) for c in business],
        surrogate_key([F.col(f"n.{key}")], F.col("_stamp")).alias("scd_id"),
        F.col("_stamp").alias("scd_updated_at"),
        F.col("_stamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )
    out = F.when(F.col("_is_new"), F.array(new_row)).when(F.col("_changed"), F.array(old_row, new_row)).otherwise(F.array(old_row))
    merged = pair.select(F.inline(out))
    return closed.select(*business, *META).unionByName(merged)


def rebuild_history(changes: DataFrame, key: str, at: str) -> DataFrame:
    """History from a full change log: each change is closed by the next one of its key."""
    nxt = F.lead(at).over(W.partitionBy(key).orderBy(F.col(at).asc_nulls_last()))
    stamp = F.col(at).cast("timestamp")
    return _with_meta(changes, key, stamp).withColumn("valid_to", nxt.cast("timestamp"))


def backdate_current(history: DataFrame, created: DataFrame, *, key: str, created_key: str, created_at: str) -> DataFrame:
    """Pull the open version's start back to the source's creation time when that is earlier.

    Only where it is the key's first version: a later one must not reach back over those before it.
    """
    src = created.select(F.col(created_key).cast("string").alias("_ck"), F.col(created_at).cast("timestamp").alias("_cat"))
    src = src.groupBy("_ck").agg(F.min("_cat").alias("_cat"))
    followed = history.filter(F.col("valid_to").isNotNull()).select(F.col(key).alias("_ck")).distinct()
    src = src.join(followed, "_ck", "left_anti")
    earlier = F.col("valid_to").isNull() & (F.col("_cat") < F.col("valid_from"))
    return (
        history.join(src, F.col(key) == F.col("_ck"), "left")
        .withColumn("valid_from", F.when(earlier, F.col("_cat")).otherwise(F.col("valid_from")))
        .drop("_ck", "_cat")
    )


def current_versions(history: DataFrame) -> DataFrame:
    return history.filter(F.col("valid_to").isNull())
