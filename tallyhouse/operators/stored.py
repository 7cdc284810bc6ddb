"""Materialised intermediate results."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
# Keys and hashes are hex text, which this codec halves and the default one leaves as it is.
COMPRESSION = "zstd"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@cache
def _private_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"tallyhouse-{application}-")


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names.

    Where none is set, a session that runs in one process gets a temporary folder; on a cluster
    that is an error, as each machine would write to its own disk.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(f"{SETTING} is not set: it must name a folder that driver and executors share")
    return _private_folder(spark.sparkContext.applicationId)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes in here leave no shuffle files behind: what is written is read from then on, and the write never runs again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def _write(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/tallyhouse/{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.option("compression", COMPRESSION).parquet(f"{folder}/{name}")
    return spark.read.schema(df.schema).parquet(f"{folder}/{name}"), folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a result once as Parquet in the shared folder and go on from the files.

    Cuts the lineage, survives lost executors, and later steps read only the columns they use.
    """
    return _write(df, name)[0]


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``stored`` for the length of a block: the files go when it ends, so nothing may read them later."""
    spark = df.sparkSession
    out, folder = _write(df, name)
    try:
        yield out
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
