"""Validity intervals and point-in-time joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def to_intervals(df: DataFrame, keys: Sequence[str], at: str, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Each row is valid from ``at`` until the next row of the same key; the last is open.

    Meant for slowly growing reference data (rates, versions), where a key has few rows.
    """
    nxt = F.lead(at).over(W.partitionBy(*keys).orderBy(F.col(at).asc_nulls_last()))
    return df.withColumns({start: F.col(at), end: nxt})


def to_intervals_skewed(
    df: DataFrame, keys: Sequence[str], at: str, tie_break: Sequence[str], bucket: str = "month",
    start: str = "valid_from", end: str = "valid_to",
) -> DataFrame:
    """``to_intervals`` for event-sized input in which one key may own a third of the rows.

    A key's rows are split by calendar bucket, so the big window runs per (key, bucket). Only
    the last row of a bucket looks further, into a small table of bucket starts.
    """
    work = df.withColumn("_bucket", F.date_trunc(bucket, F.col(at)))
    inner = W.partitionBy(*keys, "_bucket").orderBy(F.col(at).asc_nulls_last(), *tie_break)
    heads = work.groupBy(*keys, "_bucket").agg(F.min(at).alias("_head"))
    heads = heads.withColumn("_next_head", F.lead("_head").over(W.partitionBy(*keys).orderBy("_bucket")))
    within = work.withColumn("_next", F.lead(at).over(inner))
    cond = [F.col(f"w.{k}").eqNullSafe(F.col(f"h.{k}")) for k in [*keys, "_bucket"]]
    joined = within.alias("w").join(heads.alias("h"), cond, "left")
    return joined.select(
        *[F.col(f"w.{c}").alias(c) for c in df.columns],
        F.col(f"w.{at}").alias(start),
        F.coalesce(F.col("w._next"), F.col("h._next_head")).alias(end),
    )


def point_in_time_join(
    facts: DataFrame,
    versions: DataFrame,
    *,
    fact_key: str,
    version_key: str,
    at: Column | str,
    take: dict[str, str],
    start: str = "valid_from",
    end: str = "valid_to",
    by_date: bool = False,
) -> DataFrame:
    """Attach the version valid at ``at``: start <= at < end, an open end never closes.

    Equality on the key drives the join and the range is a residual check, so the plan is a
    hash or merge join, never a nested loop. ``take`` maps version columns to output names;
    unmatched facts keep NULLs. ``by_date`` compares calendar days.
    """
    at = F.col(at) if isinstance(at, str) else at
    lo, hi = (F.col(c).cast("date") if by_date else F.col(c) for c in (start, end))
    right = versions.filter(F.col(version_key).isNotNull()).select(
        F.col(version_key).alias("_k"), lo.alias("_lo"), hi.alias("_hi"), *[F.col(c).alias(n) for c, n in take.items()]
    )
    cond = (
        (F.col(fact_key) == F.col("_k"))
        & (F.col("_at") >= F.col("_lo"))
        & (F.col("_hi").isNull() | (F.col("_at") < F.col("_hi")))
    )
    return facts.withColumn("_at", at).join(right, cond, "left").drop("_at", "_k", "_lo", "_hi")


def point_in_time_join_large(
    facts: DataFrame, versions: DataFrame, *, fact_key: str, version_key: str, at: Column | str, take: dict[str, str],
    start: str = "valid_from", end: str = "valid_to", bucket: str = "month",
) -> DataFrame:
    """``point_in_time_join`` for event-sized histories: no fact ever meets more than one version.

    Facts and versions of a key and a calendar bucket stand in one line by time, and the newest
    version is carried forward to the facts behind it. What a bucket inherits is the newest version
    of the key's earlier buckets, found on one row per key and bucket. A key that holds a third of all
    rows and thousands of versions is dealt out by bucket, and everything shuffled is a fact or a
    version. Of versions that overlap, the one that starts last counts. Facts without a key or a
    time meet none and are not shuffled.
    """
    at = F.col(at) if isinstance(at, str) else at
    stamp = at.cast("timestamp")
    known = F.col(fact_key).isNotNull() & stamp.isNotNull()
    ver = F.struct(F.col(start).cast("timestamp").alias("from"), F.col(end).cast("timestamp").alias("to"), *[F.col(c).alias(n) for c, n in take.items()])
    v = versions.filter(F.col(version_key).isNotNull() & F.col(start).isNotNull()).select(F.col(version_key).alias("_k"), F.col(start).cast("timestamp").alias("_t"), ver.alias("_ver"))
    v = v.withColumn("_bucket", F.date_trunc(bucket, "_t"))
    f = facts.filter(known).select(F.col(fact_key).alias("_k"), stamp.alias("_t"), F.struct(*facts.columns).alias("_row")).withColumn("_bucket", F.date_trunc(bucket, "_t"))
    ver_type, row_type = v.schema["_ver"].dataType, f.schema["_row"].dataType
    newest = v.groupBy("_k", "_bucket").agg(F.max_by("_ver", F.struct("_t", F.coalesce(F.col("_ver.to"), F.lit("9999-12-31").cast("timestamp")))).alias("_ver"))
    used = f.select("_k", "_bucket").distinct().withColumn("_ver", F.lit(None).cast(ver_type))
    heads = used.unionByName(newest).groupBy("_k", "_bucket").agg(F.first("_ver", ignorenulls=True).alias("_ver"))
    before = W.partitionBy("_k").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    inherited = heads.withColumn("_ver", F.last("_ver", ignorenulls=True).over(before)).filter(F.col("_ver").isNotNull())
    none = F.lit(None).cast(row_type)
    line = v.select("_k", "_bucket", "_t", F.lit(1).alias("_kind"), "_ver", none.alias("_row")).unionByName(
        inherited.select("_k", "_bucket", F.col("_bucket").alias("_t"), F.lit(0).alias("_kind"), "_ver", none.alias("_row"))).unionByName(
        f.select("_k", "_bucket", "_t", F.lit(2).alias("_kind"), F.lit(None).cast(ver_type).alias("_ver"), "_row"))
    order = W.partitionBy("_k", "_bucket").orderBy("_t", "_kind", F.col("_ver.to").asc_nulls_last())
    carried = line.withColumn("_ver", F.last("_ver", ignorenulls=True).over(order)).filter("_kind = 2")
    valid = F.col("_ver.to").isNull() | (F.col("_t") < F.col("_ver.to"))
    met = carried.select("_row.*", *[F.when(valid, F.col(f"_ver.{n}")).alias(n) for n in take.values()])
    apart = facts.filter(~F.coalesce(known, F.lit(False))).select("*", *[F.lit(None).cast(met.schema[n].dataType).alias(n) for n in take.values()])
    return met.unionByName(apart)


def overlapping_versions(versions: DataFrame, key: str, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Versions that begin before their predecessor ended; must be empty for safe PIT joins."""
    nxt = F.lead(start).over(W.partitionBy(key).orderBy(F.col(start), F.col(end).asc_nulls_last()))
    return (
        versions.withColumn("_next", nxt)
        .filter(F.col("_next").isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col("_next"))))
        .drop("_next")
    )
