"""Concatenate and cut: documents' ids one after another, cut into windows of fixed length.

Two passes. The first encodes each text once and stores its ids with the ids before it in its
own partition. The second turns the partitions' totals into prefix sums, which place every
document in one global stream; a document that crosses a window's edge gives a record per side.
Only the last window can be short, so padding is less than one window for the whole corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import keep, running_totals, small_batches, sql_type, text_of
from tallyhouse.llm.tokens import MODEL, RANKS, encoder

WINDOW = 2048
END_ID = 1
ID_BYTES = 4
PARTITIONS_PER_RANGE = 1024


def encoded(docs: DataFrame, id_col: str, text_col: str, end_id: int | None, model: str, ranks: str) -> DataFrame:
    """Per document: ``doc_id``, ``part``, ``before`` (ids before it in that partition), ``n`` and ``ids``.

    ``ids`` are little-endian unsigned 32-bit numbers, the closing ``end_id`` included.
    """
    close = np.array([] if end_id is None else [end_id], dtype="<u4")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total, encode = TaskContext.get().partitionId(), 0, encoder(model, ranks)
        for batch in batches:
            ids = [np.concatenate((encode.ids(text), close)) for text in batch.column(1).to_pylist()]
            n = np.array([len(x) for x in ids], dtype=np.int64)
            before = total + np.cumsum(n) - n
            total += int(n.sum())
            columns = [batch.column(0), pa.array(np.full(len(n), part, dtype=np.int64)), pa.array(before), pa.array(n), pa.array([x.tobytes() for x in ids], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "before", "n", "ids"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(work, f"doc_id {sql_type(rows, 'doc_id')}, part long, before long, n long, ids binary")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int | None = END_ID,
         model: str | None = None, ranks: str | None = None) -> DataFrame:
    """Pieces of all documents in sequences of at most ``window`` ids.

    One row per piece: ``doc_id``, ``start`` (ids of its document before it), ``length``, ``ids``
    (binary, 4 bytes an id, little-endian), ``doc_tokens``, ``sequence_id`` and ``offset`` in the
    sequence, where pieces lie without gaps. Rows follow the order in which the table is read.

    A null or empty text is just the end id (no row if ``end_id`` is None). Null and repeated ids
    are packed row by row like any other; an empty table gives no row. Columns besides id and
    text are not looked at, whatever their names.
    """
    model, ranks = model or public_tokenizers.path(MODEL), ranks or public_tokenizers.path(RANKS)
    ids = keep(encoded(docs, id_col, text_col, end_id, model, ranks), "encoded")
    parts = ids.groupBy("part").agg(F.sum("n").alias("part_n"))
    # One row per partition of the input: a few bytes for each of its splits, whatever they hold.
    base = F.broadcast(running_totals(parts, "part", {"part_n": "base"}, PARTITIONS_PER_RANGE).select("part", "base"))
    placed = ids.filter("n > 0").join(base, "part").withColumn("first", F.col("base") + F.col("before"))
    width = F.lit(window).cast("long")
    spans = placed.select(
        "doc_id", "ids", F.col("n").alias("doc_tokens"), "first",
        F.explode(F.sequence(F.floor(F.col("first") / width), F.floor((F.col("first") + F.col("n") - 1) / width))).alias("sequence_id"),
    )
    at = F.greatest(F.col("first"), F.col("sequence_id") * width)
    until = F.least(F.col("first") + F.col("doc_tokens"), (F.col("sequence_id") + 1) * width)
    cut = spans.select("doc_id", (at - F.col("first")).alias("start"), (until - at).alias("length"), "ids", "doc_tokens", "sequence_id", (at - F.col("sequence_id") * width).alias("offset"))
    piece = F.expr(f"substring(ids, cast(start * {ID_BYTES} + 1 as int), cast(length * {ID_BYTES} as int))")
    return cut.select("doc_id", "start", "length", piece.alias("ids"), "doc_tokens", "sequence_id", "offset")
