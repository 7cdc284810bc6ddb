"""Exact duplicates by two passes over a Bloom filter.

Texts are compared by the SHA-256 of their normalised form. The first pass counts, for every bit
that a digest sets in the filter, the rows that set it; what two or more rows have set is kept. A
digest that occurs twice finds all its bits there, so a row that misses one is the only one of its
kind: it passes straight through. The second pass shuffles the others alone and groups them by
digest. The filter's words are as many as the table needs, and a digest's bits lie in one word.
Only built-in functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import BLANKS, keep, text_of

ROWS_PER_WORD = 4  # rows for one 64-bit word of the filter, which makes 16 bits a row
BITS = 4  # bits that a digest sets
WORD_BYTES = 16  # a word and its number, as a broadcast holds them
BROADCAST_BYTES = 8 << 20  # a filter up to this size goes to all tasks
HOT = 1000  # a group with one row in so many is hot; there cannot be more hot groups than that


def digest_of(text_col: str) -> Column:
    """SHA-256 (binary) of a text whose runs of white space have become one space each; null counts as empty."""
    return F.unhex(F.sha2(F.encode(F.regexp_replace(text_of(text_col), f"[{BLANKS}]+", " "), "UTF-8"), 256))


def _bits() -> Column:
    """Places in its word of the bits that ``digest`` sets, each once."""
    hashed = F.xxhash64("digest", F.lit("bits"))
    return F.array_distinct(F.array(*[F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS)]))


def _word(words: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(words).cast("long"))


def set_twice(digests: DataFrame, words: int) -> DataFrame:
    """The filter: ``word`` and ``mask``, the bits that two or more rows of ``digests`` (``digest``) set."""
    places = digests.select(_word(words).alias("word"), F.explode(_bits()).alias("bit"))
    often = places.groupBy("word", "bit").count().filter("count > 1")
    return often.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))


def possibly_repeated(rows: DataFrame) -> DataFrame:
    """``rows`` (stored, with ``digest``) and ``possible``: false only where no other row has that digest.

    A filter of a proven size of ``BROADCAST_BYTES`` or less goes to the rows; to a larger one the
    rows go, dealt by word.
    """
    words = max(1, math.ceil(rows.count() / ROWS_PER_WORD))
    bloom = set_twice(rows.select("digest"), words)
    if words * WORD_BYTES <= BROADCAST_BYTES:
        bloom = F.broadcast(bloom)
    own = F.aggregate(_bits(), F.lit(0).cast("long"), lambda mask, bit: mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit)))
    met = rows.withColumn("word", _word(words)).withColumn("own", own).join(bloom, "word", "left")
    return met.withColumn("possible", F.coalesce(F.col("mask").bitwiseAND(F.col("own")) == F.col("own"), F.lit(False))).drop("word", "own", "mask")


def grouped(possible: DataFrame) -> DataFrame:
    """Per ``digest``: ``group_size`` and ``first`` (``id``, ``number``), the row with the least id; null ids come last.

    Copies are counted before they are shuffled, so a hot text sends a row per task.
    """
    rank = F.struct(F.col("id").isNull().alias("unnamed"), "id", "number")
    return possible.groupBy("digest").agg(F.count("*").alias("group_size"), F.min(rank).alias("first"))


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_digest`` (binary).

    Texts are equal if they are after each run of blanks, tabs and line ends has become one space.
    Of equal texts the row with the smallest id stays; null ids come last, and among rows with the
    same id the first one read stays. A null text counts as empty. Texts of any length are read whole;
    an empty table gives no row; other columns are not looked at, whatever their names.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("number"), F.col(id_col).alias("id"), digest_of(text_col).alias("digest"))
    probed = keep(possibly_repeated(keep(rows, "digests")), "probed")
    alone, possible = probed.filter("not possible"), probed.filter("possible")
    groups = keep(grouped(possible), "groups")
    hot = F.col("group_size") * HOT >= probed.count()
    # At most HOT groups can be hot: their rows meet them by broadcast, so no task gets a hot group's rows.
    with_hot = possible.join(F.broadcast(groups.filter(hot)), "digest", "left")
    others = possible.join(F.broadcast(groups.filter(hot).select("digest")), "digest", "left_anti").join(groups.filter(~hot), "digest")
    columns = ["id", "number", "digest", "group_size", "first"]
    copies = with_hot.filter("group_size is not null").select(columns).union(others.select(columns))
    marked = copies.select(
        F.col("id").alias("doc_id"), F.col("first.id").alias("keep_id"), "group_size", (F.col("number") == F.col("first.number")).alias("kept"), F.col("digest").alias("text_digest"))
    return marked.union(alone.select("id", "id", F.lit(1).cast("long"), F.lit(True), "digest"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``mark_copies`` keeps, all their columns unchanged.

    Rows without a possible copy are not shuffled at all; of the others, each by its own number.
    """
    whole = docs.select(F.monotonically_increasing_id().alias("number"), F.col(id_col).alias("id"), digest_of(text_col).alias("digest"), F.struct(F.col("*")).alias("row"))
    probed = possibly_repeated(keep(whole, "whole"))
    possible = probed.filter("possible")
    first = grouped(possible.select("id", "number", "digest")).select("first.number")
    return probed.filter("not possible").select("row.*").union(possible.join(first, "number", "left_semi").select("row.*"))
