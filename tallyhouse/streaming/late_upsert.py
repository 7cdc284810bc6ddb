"""Late and repeated rows from a stream, merged into a stored table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallyhouse.operators.dedup import latest_per_key
from tallyhouse.operators.upsert import upsert_table


def start_late_upsert(
    stream: DataFrame, table: str, keys: Sequence[str], *, version: str, partition: str, staging: str, checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Merge every micro-batch by key; within a batch the newest version of a key wins.

    The merge is idempotent, so a batch replayed after a failure changes nothing. ``checkpoint``
    must lie in storage that all nodes share.
    """

    def merge(batch: DataFrame, _: int) -> None:
        tie = F.desc(F.xxhash64(*[F.col(c) for c in batch.columns]))
        upsert_table(latest_per_key(batch, list(keys), version, tie), table, keys, partition, staging)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def drain_folder(
    spark: SparkSession, folder: str, schema: StructType, table: str, keys: Sequence[str], *, version: str, partition: str, checkpoint: str,
    late_by: str = "7 days", options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Land what has arrived in a folder of CSV files since the last call, then stop.

    The source's own log in ``checkpoint`` knows the files that were read, so a file is read once. A
    file offered again under another name brings rows whose keys and version are known: state drops
    them for as long as the watermark on ``version`` (``late_by``) keeps them, and behind it the
    merge by key changes nothing. Rows without a version cannot be placed in time and are left out.
    """
    stream = spark.readStream.schema(schema).options(**{"header": "true", **(options or {})}).csv(folder)
    fresh = stream.filter(F.col(version).isNotNull()).withWatermark(version, late_by).dropDuplicatesWithinWatermark([*keys, version])
    return start_late_upsert(fresh, table, keys, version=version, partition=partition, staging=f"{table}_staging", checkpoint=checkpoint, available_now=True)
