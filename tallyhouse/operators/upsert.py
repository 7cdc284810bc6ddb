"""Keyed incremental loads: late-data cutoff, merge, and partition-wise rewrite of a table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIRST_RUN = date(1900, 1, 1)
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the batch, plus the batch.

    Columns present on one side only are kept and filled with NULL. The batch must be unique
    on the keys; applying the same batch twice changes nothing.
    """
    kept = target.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def first_day(target: DataFrame | None, at: str, days: int) -> date:
    """Newest target day minus the lookback; a first run reads everything.

    The stored maximum, one value, is read once, so that what is compared with it is a literal
    that reaches the scan.
    """
    newest = None if target is None else target.agg(F.max(F.col(at).cast("date"))).first()[0]
    return FIRST_RUN if newest is None else newest - timedelta(days=days)


def cutoff(target: DataFrame | None, at: str, days: int) -> Column:
    """``first_day`` as a literal."""
    return F.lit(first_day(target, at, days))


def since_cutoff(source: DataFrame, target: DataFrame | None, at: str, days: int) -> DataFrame:
    """Source rows young enough to have changed since the last load."""
    if target is None:
        return source
    day, kind = first_day(target, at, days), source.schema[at].dataType
    if isinstance(kind, T.TimestampType):  # compared as it is stored, so that files can be skipped
        return source.filter(F.col(at) >= F.lit(day).cast("timestamp"))
    return source.filter((F.col(at) if isinstance(kind, T.DateType) else F.col(at).cast("date")) >= F.lit(day))


def overwrite_table(df: DataFrame, table: str, partition: str | None = None, sort: Sequence[str] = ()) -> None:
    """Full rebuild: the table is dropped and created anew. Rows are sorted inside files so min/max
    statistics can prune."""
    out = df.sortWithinPartitions(*sort) if sort else df
    writer = out.write.mode("overwrite").format("parquet")
    (writer.partitionBy(partition) if partition else writer).saveAsTable(table)


def replace_table(df: DataFrame, table: str) -> None:
    """Full rebuild under a fresh name, swapped in when it is whole, so ``df`` may read the old table.

    A failed attempt leaves the old table as it is. Parquet tables have no atomic swap: for a
    moment between the two steps only the fresh name exists.
    """
    spark, fresh = df.sparkSession, f"{table}__{uuid.uuid4().hex}"
    df.write.format("parquet").saveAsTable(fresh)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")


def upsert_table(batch: DataFrame, table: str, keys: Sequence[str], partition: str, staging: str) -> None:
    """Merge a batch into a partitioned Parquet table, rewriting only the partitions it touches.

    Touched partitions are those of the batch and those now holding one of its keys, so a row
    whose date moved leaves its old partition. New content is first written to ``staging`` (a
    table name, to which each attempt adds its own suffix), which both cuts the lineage and lets a
    lost or repeated attempt start over; it is dropped in the end.
    The touched partitions are listed as literals, which prunes the scan of the target to them;
    partitions left without rows are dropped.
    """
    spark = batch.sparkSession
    if not spark.catalog.tableExists(table):
        overwrite_table(batch, table, partition, keys)
        return
    target, staging = spark.table(table), f"{staging}__{uuid.uuid4().hex}"
    arrivals = f"{staging}_batch"
    overwrite_table(batch, arrivals)
    batch = spark.table(arrivals)
    moved = target.join(batch.select(*keys).distinct(), list(keys), "left_semi").select(partition)
    touched = partition_values(moved.union(batch.select(partition)), partition)
    affected = target.filter(F.col(partition).isin(touched))
    overwrite_table(upsert(affected, batch, keys), staging, partition)
    fresh = spark.table(staging)
    extra = [f for f in fresh.schema.fields if f.name not in target.columns]
    if extra:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in extra)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    layout = spark.table(table).columns
    mode = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        fresh.select(*layout).sortWithinPartitions(*keys).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(OVERWRITE_MODE, mode)
    for value in set(touched) - set(partition_values(fresh, partition)):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition} = '{value}')")
    spark.catalog.refreshTable(table)
    for name in (arrivals, staging):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def partition_values(df: DataFrame, partition: str) -> list:
    """Distinct values of a partition column; as many as there are partitions, so a short list."""
    values = [row[0] for row in df.select(partition).distinct().toLocalIterator()]
    if None in values:
        raise ValueError(f"partition column {partition} holds NULL")
    return values
