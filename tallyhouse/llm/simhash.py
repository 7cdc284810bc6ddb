"""Near-duplicate groups by SimHash, compared in bit slices.

Fingerprints within the radius agree in at least ``BLOCKS - radius`` of the blocks they are cut
into, so each such choice of blocks is a key under which they meet. Fingerprints that share a key
are compared as bit planes: word by word a plane holds one bit of 64 fingerprints, and
carry-save counters add up the differing bits of all of them at once; a block of 64 lanes is
abandoned for a query as soon as all its counts exceed the radius. A key held by more than ``TILE``
fingerprints is cut into tiles, and pairs of tiles go to different tasks. Every task reports a
spanning star for what it has linked, never pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import by_batch, keep, small_batches, sql_type, text_of
from tallyhouse.llm.components import components

WORDS = 3
SEED = 42
RADIUS = 2
BLOCKS = 4
TILE = 4096
FEW = 32  # groups up to this size are compared together
QUERIES = 256  # fingerprints of a larger group that are compared at a time

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
EVERY_BYTE = np.uint64(0x0101010101010101)
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """XXH64 of all shingles of a text, repeated ones included; none for a text without a word."""
    found = text.encode().translate(LOWER).split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    joined, n = b" ".join(found), max(len(found) - words + 1, 1)
    edges = np.cumsum([len(w) + 1 for w in found])
    starts = np.concatenate(([0], edges))[:n].tolist()
    ends = (edges[min(words, len(found)) - 1 :][:n] - 1).tolist()
    return np.fromiter(map(xxhash.xxh64_intdigest, [joined[a:b] for a, b in zip(starts, ends)], repeat(SEED)), dtype=np.uint64, count=n)


def majorities(hashes: list[np.ndarray]) -> np.ndarray:
    """Per array the number whose bits are set in over half of its values; zero for an empty one.

    Eight bits at a time are counted in the bytes of one word, in runs too short to overflow.
    """
    out = np.zeros(len(hashes), dtype=np.uint64)
    rows = [i for i, h in enumerate(hashes) if len(h)]
    if not rows:
        return out
    n = np.array([len(hashes[i]) for i in rows])
    first = np.cumsum(n) - n
    runs = np.concatenate([np.arange(a, a + k, 255) for a, k in zip(first, n)])
    run_of_row = np.searchsorted(runs, first)
    flat, made = np.concatenate([hashes[i] for i in rows]), np.zeros(len(rows), dtype=np.uint64)
    for shift in range(8):
        sums = np.add.reduceat((flat >> np.uint64(shift)) & EVERY_BYTE, runs)
        counts = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), run_of_row, axis=0)
        for byte in range(8):
            made |= (2 * counts[:, byte] > n).astype(np.uint64) << np.uint64(8 * byte + shift)
    out[rows] = made
    return out


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of 64-bit numbers: row b holds bit b of all of them, 64 to a word, padded with zeros."""
    padded = np.zeros(-(-len(values) // 64) * 64, dtype="<u8")
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def lanes(words: np.ndarray, n: int) -> np.ndarray:
    """Lane bits, 64 to a word along the last axis, as booleans."""
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=-1, bitorder="little")[..., :n].astype(bool)


def count_up(digits: np.ndarray, carry: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Add one plane to the binary counters of all lanes, kept as planes; also the lanes now above the radius."""
    made = []
    for digit in digits:
        made.append(digit ^ carry)
        carry = digit & carry
    above, equal = carry, FULL
    for i in reversed(range(len(made))):
        if radius >> i & 1:
            equal = equal & made[i]
        else:
            above = above | (equal & made[i])
            equal = equal & ~made[i]
    return np.array(made), above


def within(differences: Iterator[np.ndarray], radius: int) -> np.ndarray:
    """Lanes where at most ``radius`` planes of ``differences`` are set, as words.

    A lane that has exceeded the radius stays dead; once all are dead, the planes that are left
    need not be looked at.
    """
    digits = alive = None
    for carry in differences:
        if alive is None:
            digits, alive = np.zeros((radius.bit_length(), *carry.shape), dtype=np.uint64), np.full_like(carry, FULL)
        digits, above = count_up(digits, carry, radius)
        alive &= ~above
        if not alive.any():
            break
    return alive


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (the least index of each set) after joining the sets of ``i`` and ``j`` pairwise."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (up := label[label]).tobytes() != label.tobytes():
            label = up


def near_later(values: np.ndarray, own: np.ndarray, order: np.ndarray, at: int, radius: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Pairs (query, later value) within the radius for the queries from ``at`` on, and how many words were looked at.

    A block is 64 lanes seen by one query. It starts with the lanes that come after the query, and
    leaves the work as soon as the last of them has exceeded the radius.
    """
    n, first = len(values), at // 64
    queries = np.arange(at, min(at + QUERIES, n))
    query = np.repeat(np.arange(len(queries)), own.shape[1] - first)
    word = np.tile(np.arange(first, own.shape[1]), len(queries))
    ahead = np.clip(queries[query] + 1 - 64 * word, 0, 64)
    alive = np.where(ahead < 64, FULL << np.minimum(ahead, 63).astype(np.uint64), np.uint64(0))
    beyond = np.clip(64 * word + 64 - n, 0, 63).astype(np.uint64)
    alive &= FULL >> beyond
    digits, looked = np.zeros((radius.bit_length(), len(query)), dtype=np.uint64), 0
    for bit in order:
        left = np.flatnonzero(alive)
        if len(left) < len(alive):
            query, word, alive, digits = query[left], word[left], alive[left], digits[:, left]
        if not len(alive):
            break
        looked += len(alive)
        carry = own[bit][word] ^ (FULL * ((values[queries[query]] >> np.uint64(bit)) & np.uint64(1)))
        digits, above = count_up(digits, carry, radius)
        alive = alive & ~above
    hit, lane = np.nonzero(lanes(alive[:, None], 64)) if len(alive) else (np.empty(0, int), np.empty(0, int))
    return queries[query[hit]], 64 * word[hit] + lane, looked


def linked_in_group(values: np.ndarray, radius: int) -> np.ndarray:
    """Index of the first value of the linked set of each value, for one large group.

    Planes that split the group most evenly come first: the keys the values share tell nothing.
    """
    n, label = len(values), np.arange(len(values))
    own = planes(values)
    order = np.argsort(np.abs(2 * lanes(own, n).sum(axis=1) - n), kind="stable")
    for at in range(0, n, QUERIES):
        i, j, _ = near_later(values, own, order, at, radius)
        label = merge(label, i, j)
    return label


def linked_in_groups(values: np.ndarray, group: np.ndarray, radius: int) -> np.ndarray:
    """The same for many small groups that lie one after another; ``group`` tells them apart."""
    label = np.arange(len(values))
    for shift in range(1, len(values)):
        left = np.flatnonzero(group[:-shift] == group[shift:])
        if not len(left):
            break
        close = within(iter(planes(values[left] ^ values[left + shift])), radius)
        hit = left[lanes(close, len(left))]
        label = merge(label, hit, hit + shift)
    return label


def stars(values: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every value to the first one of its linked set, for groups one after another."""
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(group)])))
    label = np.arange(len(values))
    small = np.repeat((sizes > 1) & (sizes <= FEW), sizes)
    at = np.flatnonzero(small)
    if len(at):
        label[at] = at[linked_in_groups(values[at], group[at], radius)]
    for a, n in zip(starts[sizes > FEW], sizes[sizes > FEW]):
        label[a : a + n] = a + linked_in_group(values[a : a + n], radius)
    moved = label != np.arange(len(label))
    return values[moved], values[label[moved]]


def fingerprints(docs: DataFrame, key: Column, text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``key`` and ``fp``, the SimHash of every whole text as a signed 64-bit number.

    Lower-cases A to Z only. A text with fewer words than a shingle is one shingle; a null text
    or one without words has fingerprint zero.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes = [shingle_hashes(text, words) for text in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(majorities(hashes).view(np.int64))], ["key", "fp"])

    rows = docs.select(key.alias("key"), text_of(text_col).alias("text"))
    return by_batch(rows, work, f"key {sql_type(rows, 'key')}, fp long")


def _keys(fp: Column, radius: int, blocks: int) -> Column:
    """All keys of a fingerprint: for each choice of blocks to be left out, a hash of the rest."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    made = []
    for number, left_out in enumerate(combinations(range(blocks), radius)):
        mask = sum(((1 << edges[i + 1]) - (1 << edges[i])) for i in range(blocks) if i not in left_out)
        signed = mask - (1 << 64) if mask >> 63 else mask
        made.append(F.struct(F.lit(number).alias("choice"), fp.bitwiseAND(F.lit(signed)).alias("value")))
    return F.array(*made)


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """Edges ``a``, ``b`` that connect all fingerprints (column ``fp``, each once) within the radius.

    Not all pairs: a spanning star for each set that a task has found linked.
    """
    if not 0 < radius < blocks:
        raise ValueError("radius must be positive and less than the number of blocks")
    small_batches(distinct.sparkSession)
    met = distinct.select("fp", F.explode(_keys(F.col("fp"), radius, blocks)).alias("k")).select("fp", "k.choice", "k.value")
    crowded = met.groupBy("choice", "value").count().filter(F.col("count") > tile)
    tiles = F.coalesce(F.ceil(F.col("count") / F.lit(tile / 2)), F.lit(1)).cast("int")
    dealt = met.join(crowded, ["choice", "value"], "left").withColumn("tiles", tiles)
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    names = ["choice", "value", "low", "high"]
    dealt = dealt.select("fp", "choice", "value", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    sorted_in = dealt.repartition(*names).sortWithinPartitions(*names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: np.ndarray | None = None
        for batch in batches:
            got = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)])
            got = got if rest is None else np.concatenate((rest, got))
            new = np.flatnonzero((got[1:, 1:] != got[:-1, 1:]).any(axis=1)) + 1
            cut = new[-1] if len(new) else 0
            rest = got[cut:]
            if cut:
                yield edges(got[:cut])
        if rest is not None and len(rest):
            yield edges(rest)

    def edges(rows: np.ndarray) -> pa.RecordBatch:
        group = np.concatenate(([0], np.cumsum((rows[1:, 1:] != rows[:-1, 1:]).any(axis=1))))
        a, b = stars(np.ascontiguousarray(rows[:, 0]).view(np.uint64), group, radius)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return sorted_in.mapInArrow(work, "a long, b long")


def grouped(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """``prints`` (``key``, ``fp``; stored) with ``group``, the least key of each linked group.

    Copies meet in a grouped minimum; only distinct fingerprints are compared.
    """
    distinct = keep(prints.groupBy("fp").agg(F.min("key").alias("least")), "distinct")
    roots = components(links(distinct.select("fp"), radius, blocks, tile))
    rooted = distinct.join(roots, distinct.fp == roots.vertex, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("group"))
    found = keep(rooted.join(least, "root").select("fp", "group"), "groups")
    return prints.join(found, "fp").select("key", "fp", "group")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most ``radius`` differing bits.
    Texts without words share fingerprint zero and so form a group. Null ids do not name a group
    unless all its ids are null; repeated ids and rows give a row each; an empty table gives none.
    """
    prints = keep(fingerprints(docs, F.col(id_col), text_col), "fingerprints")
    out = grouped(prints, radius)
    return out.select(F.col("key").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("group").alias("component_id"))


def first_of_groups(docs: DataFrame, id_col: str, text_col: str, group: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Of each group the row of ``docs`` with the smallest id.

    ``group`` takes ``rank`` and ``text`` of every row and returns each rank as ``key`` with the
    least of its group as ``group``. Null ids come last, and among equal ids the first row read
    stays. All columns are returned as they are, whatever their names. The rows are stored once
    under a number, so that a row is known again even where ids are null or repeated.
    """
    numbered = keep(docs.select(F.monotonically_increasing_id().alias("number"), F.struct(F.col("*")).alias("row")), "numbered")
    rank = F.struct(F.col(f"row.`{id_col}`").isNull().alias("unnamed"), F.col(f"row.`{id_col}`").alias("id"), F.col("number"))
    out = group(numbered.select(rank.alias("rank"), F.col(f"row.`{text_col}`").alias("text")))
    stay = out.filter(F.col("key") == F.col("group")).select(F.col("key.number").alias("number"))
    return numbered.join(stay, "number", "left_semi").select("row.*")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the row with the smallest id stays."""
    return first_of_groups(docs, id_col, text_col, lambda rows: grouped(keep(fingerprints(rows, F.col("rank"), "text"), "fingerprints"), radius))
