"""Shared helpers of this subpackage: tables, stored steps, batches, running totals."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.operators.stored import shared_folder

# White space of the word rule, as the inside of a character class.
BLANKS = r"\x20\x09-\x0D"
ROWS_PER_BATCH = 256
PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once, zstd-compressed, to the shared folder and go on from the files.

    Used where a result is read more than once or its lineage should end: later reads survive
    lost executors and take only the columns they need.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/llm/{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, so that long texts do not add up in a worker.

    Workers also get the folder this package was imported from, for sessions that were started
    without it on their path. Where that folder is not shared, the package has to be installed.
    """
    workers = spark.sparkContext.environment
    known = [x for x in workers.get("PYTHONPATH", "").split(os.pathsep) if x]
    if PACKAGE_ROOT not in known:
        workers["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *known])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def by_batch(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``work`` to each Arrow batch; ``schema`` describes what it returns."""
    small_batches(df.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield work(batch)

    return df.mapInArrow(each, schema)


def sql_type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def text_of(column: str) -> Column:
    """The text as a string that is never null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is computed once however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def held_out(column: Column) -> Column:
    """True for the rows no model may learn a label from: crc32 of the id's text, modulo 5, is 0."""
    return F.coalesce(F.crc32(column.cast("string")) % 5 == 0, F.lit(False))


def running_totals(df: DataFrame, key: str, values: dict[str, str], width: int, descending: bool = False) -> DataFrame:
    """Totals of all rows before each row in the order of a whole-number ``key``.

    ``values`` maps a numeric column to the name of its total. ``key`` is unique. The order is cut
    into ranges of ``width``: running sums inside a range, then sums over the totals of ranges.
    Only these totals, one row per range, meet in one task.
    """
    sign = -1 if descending else 1
    ranged = df.withColumn("_range", F.floor(F.col(key) * sign / F.lit(width)))
    inner = Window.partitionBy("_range").orderBy(F.col(key) * sign).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy("_range").agg(*[F.sum(v).alias(f"_all_{v}") for v in values])
    before = ranges.select("_range", *[F.coalesce(F.sum(f"_all_{v}").over(outer), F.lit(0)).alias(f"_before_{v}") for v in values])
    within = ranged.select("*", *[F.coalesce(F.sum(v).over(inner), F.lit(0)).alias(f"_in_{v}") for v in values])
    totals = [(F.col(f"_before_{v}") + F.col(f"_in_{v}")).alias(name) for v, name in values.items()]
    return within.join(before, "_range").select(*df.columns, *totals)
