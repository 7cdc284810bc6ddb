"""Collocations: the best-scoring phrases of each language, by best-first branch and bound.

A phrase of ``a`` occurrences that is cut into parts of ``l`` and ``r`` occurrences scores
``floor(1000 * a * n / (l * r))`` in a language of ``n`` words; its lowest-scoring cut counts. As
``a <= r`` for every cut, no phrase that grows from a first word of ``f`` occurrences scores above
``floor(1000 * n / f)``: the count of the prefix bounds the whole branch. Rounds expand the branches
with the best bounds, word by word, as long as a prefix is frequent, and end for a language as soon
as no branch left could reach the last place on its list, ties included.

Texts are cut into words once and stored in chunks: a list of words and their numbers in it. A pass
over the chunks counts phrases of one length inside each chunk; Spark adds up the counts. Bitmaps of
fixed size tell a pass which prefixes are worth a look; they let some others through, which changes
no count: all occurrences of a phrase are counted or none.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import keep, small_batches, text_of

LONGEST = 5  # words of a phrase
LEAST = 100  # occurrences of a phrase
TOP = 2000  # phrases of a language
FIRST_REACH = 16  # the first round expands words of up to this many times LEAST occurrences
REACH = 16  # and each later one so many times more, while a list is not full
CHUNK = 1 << 19  # words and marks of a chunk, more where one text has more
BITMAP_BITS = 26  # a bitmap has 2 ** this many bits, at every size of the corpus
MIX = np.uint64(0x9E3779B97F4A7C15)

# A to Z become small, the marks that end a piece become full stops and tabs become spaces.
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz......... ")
COUNTED = "lang string, phrase string, f long"


def cut_texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """Chunks: ``lang``, ``words`` (joined by spaces) and ``codes``, 1-based numbers of them; 0 ends a piece."""

    def chunk(lang: str, parts: list[list[int]], words: defaultdict) -> tuple:
        found = list(words)[1:]
        codes = np.concatenate([np.array(p, dtype=np.uint32) for p in parts])
        return lang, b" ".join(found), codes.astype(np.uint16 if len(found) < 1 << 16 else np.uint32).tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, size = {}, 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in open_:
                    words = defaultdict(count().__next__)
                    words[b"."]  # the mark takes number 0
                    open_[lang] = [], words
                parts, words = open_[lang]
                parts.append(list(map(words.__getitem__, text.encode().translate(FOLD).replace(b".", b" . ").split())) + [0])
                size += len(parts[-1])
                if size >= CHUNK:
                    yield rows([chunk(k, *v) for k, v in open_.items()])
                    open_, size = {}, 0
        if open_:
            yield rows([chunk(k, *v) for k, v in open_.items()])

    def rows(made: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), (pa.string(), pa.binary(), pa.binary()))], ["lang", "words", "codes"])

    small_batches(docs.sparkSession)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), text_of(text_col).alias("text")).mapInArrow(work, "lang string, words binary, codes binary")


class Chunk:
    """One stored chunk: words, their hashes, and positions with marks enough behind the last."""

    def __init__(self, lang: str, words: bytes, codes: bytes) -> None:
        self.words = [b".", *(words.split(b" ") if words else [])]
        dtype = np.uint16 if len(self.words) <= 1 << 16 else np.uint32
        self.codes = np.concatenate((np.frombuffer(codes, dtype=dtype).astype(np.int64), np.zeros(LONGEST, dtype=np.int64)))
        self.hashes = word_hashes(lang, self.words)
        self.lang = lang

    def counted(self, positions: np.ndarray, length: int) -> tuple[list[str], np.ndarray]:
        """The distinct phrases at ``positions`` and how often each is there."""
        key, top, width = self.codes[positions], len(self.words), len(self.words)
        for j in range(1, length):
            if top * width >= 1 << 63:
                distinct, key = np.unique(key, return_inverse=True)
                top = len(distinct)
            key, top = key * width + self.codes[positions + j], top * width
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        columns = [self.codes[positions[first] + j].tolist() for j in range(length)]
        word = self.words
        return [b" ".join([word[c] for c in row]).decode() for row in zip(*columns)], n


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), dtype=np.uint64, count=len(words))


def grown(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its prefix and that of its last word."""
    return (prefix ^ (prefix >> np.uint64(29))) * MIX + word


def phrase_hash(lang: str, phrase: str) -> int:
    made = None
    for h in word_hashes(lang, phrase.encode().split(b" ")):
        made = np.array([h]) if made is None else grown(made, np.array([h]))
    return int(made[0])


def marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """True where the bitmap has the bit of a hash."""
    at = hashes >> np.uint64(64 - BITMAP_BITS)
    return (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def bitmap(phrases: DataFrame) -> np.ndarray:
    """Bitmap of the phrases of a table (``lang``, ``phrase``); never more than its fixed size reaches the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.array([phrase_hash(a, b) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())], dtype=np.uint64)
            at = hashes >> np.uint64(64 - BITMAP_BITS)
            masks = np.uint64(1) << (at & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(masks.view(np.int64))], ["place", "mask"])

    bits = phrases.select("lang", "phrase").mapInArrow(work, "place long, mask long").groupBy("place").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.uint64)
    out[bits.column("place").to_numpy()] = bits.column("mask").to_numpy().view(np.uint64)
    return out


def counted(chunks: DataFrame, look: Callable[[Chunk], Iterator[tuple[np.ndarray, int]]], least: int) -> DataFrame:
    """``lang``, ``phrase``, ``f`` of the phrases that ``look`` points at in the chunks, if they occur ``least`` times."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words, codes in zip(*(c.to_pylist() for c in batch.columns)):
                chunk = Chunk(lang, words, codes)
                for positions, length in look(chunk):
                    if len(positions):
                        phrases, n = chunk.counted(positions, length)
                        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), pa.array(phrases), pa.array(n.astype(np.int64))], ["lang", "phrase", "f"])

    found = chunks.mapInArrow(work, COUNTED)
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)


def count_words(chunks: DataFrame) -> DataFrame:
    return counted(chunks, lambda c: iter([(np.flatnonzero(c.codes), 1)]), 1)


def grow(chunks: DataFrame, often, prefixes, length: int, least: int) -> DataFrame:
    """Phrases of ``length`` words that grow by a frequent word from prefixes in a bitmap."""

    def look(chunk: Chunk) -> Iterator[tuple[np.ndarray, int]]:
        usable = marked(often.value, chunk.hashes)
        usable[0] = False
        first = usable & marked(prefixes.value, chunk.hashes)
        at = np.flatnonzero(first[chunk.codes])
        made = chunk.hashes[chunk.codes[at]]
        for j in range(1, length):
            if j > 1:
                open_ = marked(prefixes.value, made)
                at, made = at[open_], made[open_]
            following = chunk.codes[at + j]
            open_ = usable[following]
            at, made = at[open_], grown(made[open_], chunk.hashes[following[open_]])
        yield at, length

    return counted(chunks, look, least)


def count_targets(chunks: DataFrame, often, closed, rests, bases, longest: int, least: int) -> DataFrame:
    """Phrases that start with a word of a branch still closed, and are a wanted rest or extend a found phrase to the left."""

    def look(chunk: Chunk) -> Iterator[tuple[np.ndarray, int]]:
        usable = marked(often.value, chunk.hashes)
        usable[0] = False
        at = np.flatnonzero((usable & marked(closed.value, chunk.hashes))[chunk.codes])
        made = chunk.hashes[chunk.codes[at]]
        tail = None
        for length in range(2, longest + 1):
            following = chunk.codes[at + length - 1]
            open_ = usable[following]
            at, word = at[open_], chunk.hashes[following[open_]]
            made = grown(made[open_], word)
            tail = word if tail is None else grown(tail[open_], word)
            wanted = marked(rests.value, made) if length < longest else np.zeros(len(at), dtype=bool)
            if length > 2:
                wanted |= marked(bases.value, tail)
            yield at[wanted], length

    return counted(chunks, look, least)


def _words(phrase: Column) -> Column:
    return F.split(phrase, " ")


def _joined(words: Column, start: int | Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def cuts(found: DataFrame) -> DataFrame:
    """A row per phrase and place ``k`` to cut it, with both parts."""
    words = found.withColumn("w", _words(F.col("phrase")))
    each = words.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    return each.select("lang", "phrase", "a", "k", _joined(F.col("w"), 1, F.col("k")).alias("left"), _joined(F.col("w"), F.col("k") + 1, F.size("w") - F.col("k")).alias("rest"))


def scored(cut: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Phrases with their lowest-scoring cut, the shortest left part among equals. Products are exact decimals."""
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rest = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    known = cut.join(left, ["lang", "left"]).join(rest, ["lang", "rest"]).join(totals, "lang")
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    parts = known.withColumn("above", exact["a"] * exact["n"] * F.lit(1000).cast("decimal(4,0)")).withColumn("below", exact["l"] * exact["r"])
    parts = parts.withColumn("score", F.expr("above div below").cast("long"))
    least = parts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a"), F.first("n").alias("n"))
    return least.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def widest(longer: DataFrame) -> DataFrame:
    """Per phrase the highest count of the phrases that are longer than it by one word at either end."""
    words = longer.withColumn("w", _words(F.col("phrase"))).filter(F.size("w") > 2)
    size = F.size("w") - 1
    inner = words.select("lang", "f", F.explode(F.array(_joined(F.col("w"), 1, size), _joined(F.col("w"), 2, size))).alias("phrase"))
    return inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def best(phrases: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of each language with their ``rank``; each task sends on no more than that."""
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return phrases.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Candidates have 2 to ``longest`` words (5 at most) and ``least`` occurrences or more; one that
    every time stands in the same longer candidate is left out. Order: score and occurrences
    descending, then the phrase by its UTF-8 bytes, so ties are settled. A null text is empty, a
    null language ``und``; repeated rows count each time, texts of any length are read whole; no
    words or an empty table give no row; other columns are not looked at, whatever their names.
    """
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"longest must be 2 to {LONGEST}")
    share = docs.sparkSession.sparkContext.broadcast
    chunks = keep(cut_texts(docs, lang_col, text_col), "chunks")
    every = keep(count_words(chunks), "words")
    totals = keep(every.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    words = keep(every.filter(F.col("f") >= least), "frequent")
    often = share(bitmap(words))
    # Branches from words of more than ``low`` and up to ``high`` occurrences are expanded in a round.
    state = keep(totals.select("lang", "n", F.lit(0).cast("long").alias("low"), F.lit(least * FIRST_REACH).cast("long").alias("high")), "state")
    known, lists = [words], []
    while True:
        roots = keep(words.join(state, "lang").filter("f > low and f <= high").select("lang", "phrase", "f"), "roots")
        shut = keep(words.join(state, "lang").filter("f > high").select("lang", "phrase"), "shut")
        levels, prefixes = [], bitmap(roots)
        for length in range(2, longest + 1):
            held = share(prefixes)
            grams = grow(chunks, often, held, length, least).withColumn("root", F.substring_index("phrase", " ", 1))
            real = grams.join(roots.select("lang", F.col("phrase").alias("root")), ["lang", "root"], "left_semi").select("lang", "phrase", "f")
            levels.append(keep(real, f"grams{length}"))
            prefixes |= bitmap(levels[-1])
            held.unpersist()
        known += levels
        cut = keep(cuts(_union(levels).withColumnRenamed("f", "a")), "cuts")
        counts = _union(known)
        if not shut.isEmpty():
            wanted = cut.filter(F.instr("rest", " ") > 0).select("lang", F.col("rest").alias("phrase")).distinct().join(counts, ["lang", "phrase"], "left_anti")
            held = [share(bitmap(x)) for x in (shut, wanted, _union(levels))]
            counts = counts.unionByName(keep(count_targets(chunks, often, *held, longest, least), "targets").join(counts, ["lang", "phrase"], "left_anti"))
            for x in held:
                x.unpersist()
        made = scored(cut, counts, totals).join(widest(counts), ["lang", "phrase"], "left")
        lists.append(keep(made.filter("longer is null or longer < a").drop("longer"), "survivors"))
        leaders = keep(best(_union(lists), top), "leaders")
        # A list that is full bounds what is still to be looked at; one that is not lets the reach grow.
        last = leaders.filter(F.col("rank") == top).select("lang", F.col("score").alias("last"))
        following = words.join(state.select("lang", "high"), "lang").filter("f > high").groupBy("lang").agg(F.min("f").alias("following"))
        ahead = state.join(following, "lang").join(last, "lang", "left")
        hopeful = F.expr("last is null or cast(n as decimal(19,0)) * 1000 div cast(following as decimal(19,0)) >= last")
        reach = F.expr("cast(cast(n as decimal(19,0)) * 1000 div cast(last as decimal(19,0)) as bigint)")
        high = F.when(F.col("last").isNull(), F.greatest(F.col("high"), F.col("following")) * REACH).otherwise(reach)
        state = keep(ahead.filter(hopeful).select("lang", "n", F.col("high").alias("low"), high.alias("high")), "state")
        if state.isEmpty():
            return leaders.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
