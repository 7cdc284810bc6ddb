"""Exact histogram of encoded lengths, and what its suffix sums answer."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import by_batch, keep, running_totals, text_of
from tallyhouse.llm.tokens import MODEL, RANKS, encoder

LENGTHS_PER_RANGE = 4096


def length_histogram(docs: DataFrame, text_col: str = "text", model: str | None = None, ranks: str | None = None) -> DataFrame:
    """``n_tokens`` and ``documents``: how many texts encode to that many ids, no end id counted.

    Null and empty texts have length 0; each row counts, repeated ones too. An empty table gives
    no row. Only the text column is read. Batches are counted in the workers, so that a row per
    batch and length is all that is shuffled.
    """
    model, ranks = model or public_tokenizers.path(MODEL), ranks or public_tokenizers.path(RANKS)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = encoder(model, ranks)
        sizes, counts = np.unique([len(encode.ids(text)) for text in batch.column(0).to_pylist()], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(sizes.astype(np.int64)), pa.array(counts.astype(np.int64))], ["n_tokens", "documents"])

    partial = by_batch(docs.select(text_of(text_col).alias("text")), count, "n_tokens long, documents long")
    return partial.groupBy("n_tokens").agg(F.sum("documents").alias("documents"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """The histogram with what lies at and above each length.

    ``documents_from`` and ``tokens_from`` cover lengths of ``n_tokens`` and more, ``truncated``
    is the corpus total when every text is cut at ``n_tokens`` ids, ``documents_to`` counts the
    texts that fit. Between two lengths of the table all of them follow from the next longer row.
    The histogram is stored first, as it is read several times.
    """
    sized = keep(histogram.select("n_tokens", "documents", (F.col("n_tokens") * F.col("documents")).alias("tokens")), "lengths")
    above = running_totals(sized, "n_tokens", {"documents": "documents_above", "tokens": "tokens_above"}, LENGTHS_PER_RANGE, descending=True)
    both = running_totals(above, "n_tokens", {"documents": "documents_below", "tokens": "tokens_below"}, LENGTHS_PER_RANGE)
    return both.select(
        "n_tokens", "documents",
        (F.col("documents_above") + F.col("documents")).alias("documents_from"),
        (F.col("tokens_above") + F.col("tokens")).alias("tokens_from"),
        (F.col("tokens_below") + F.col("n_tokens") * (F.col("documents_above") + F.col("documents"))).alias("truncated"),
        (F.col("documents_below") + F.col("documents")).alias("documents_to"),
    )


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """``context`` and ``tokens``: the corpus total when each text is cut at ``context`` ids.

    A limit between two lengths differs from the next longer row by the documents from there on.
    Beyond the longest text the total is that of the whole corpus; 0 for an empty histogram.
    """
    asked = sums.sparkSession.createDataFrame([(int(x),) for x in limits], "context long")
    at = F.broadcast(asked)  # as long as the caller's list
    reach = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits]))
    rows = sums.select("*", reach.alias("context"))
    up = F.when(F.col("n_tokens") >= F.col("context"), F.struct(F.col("n_tokens").alias("n"), "truncated", "documents_from"))
    top = F.max(F.struct("n_tokens", "truncated")).getField("truncated")
    found = rows.groupBy("context").agg(F.min(up).alias("up"), top.alias("all"))
    cut = F.col("up.truncated") - (F.col("up.n") - F.col("context")) * F.col("up.documents_from")
    return found.join(at, "context", "right").select("context", F.coalesce(cut, F.col("all"), F.lit(0)).alias("tokens"))


def length_quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """``share`` and ``n_tokens``: the least length that at least that share of documents does not exceed."""
    total = F.col("documents_to") + F.col("documents_from") - F.col("documents")
    rows = sums.select("*", total.alias("total"), F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share"))
    fits = F.col("documents_to") >= F.col("share") * F.col("total")
    return rows.groupBy("share").agg(F.min(F.when(fits, F.col("n_tokens"))).alias("n_tokens"))
