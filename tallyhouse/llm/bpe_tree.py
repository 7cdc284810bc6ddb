"""Byte-level BPE by tree reduction: encoding joins halves, decoding concatenates up the tree.

Encoded byte strings form a monoid. Its product re-encodes a window around the seam of two
encodings and keeps the tokens outside. A token sequence is the encoding of its bytes exactly if
each two neighbours, encoded together, give themselves again: the first merge ever to cross a
token's edge depends only on the states of the two tokens beside that edge, which run as they
would alone. So the window has grown enough when both of its edges pass that test.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import by_batch, sql_type, text_of
from tallyhouse.llm.tokens import RANKS, read_ranks

LEAF = 32  # bytes that are merged directly
DECODE_LEAF = 4096  # ids whose bytes are put together at once
REMEMBERED = 250_000  # pieces a worker keeps, twice
NO_PAIR = 1 << 62


class Memo(dict):
    """Results of ``make`` by argument; past the bound, only those used since the last turn stay."""

    def __init__(self, make: Callable[[str], bytes], bound: int) -> None:
        self.make, self.bound, self.old = make, bound, {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.bound:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class TreeCodec:
    """Encoder and decoder for one rank file; each match of ``pattern`` is encoded by itself."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN) -> None:
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.known = Memo(lambda match: array("I", self.piece(match.encode())).tobytes(), REMEMBERED)

    def leaf(self, data: bytes) -> list[int]:
        """Ids of a short byte string: again and again merge the leftmost pair of least rank."""
        known = self.ranks.get(data)
        if known is not None:
            return [known]
        rank = self.ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [rank(data[i : i + 2], NO_PAIR) for i in range(len(data) - 1)]
        while pairs and (best := min(pairs)) != NO_PAIR:
            i = pairs.index(best)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], NO_PAIR)
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], NO_PAIR)
        return [self.ranks[p] for p in parts]

    def stable(self, left: int, right: int) -> bool:
        """True if no merge crosses the edge between these two tokens."""
        return self.leaf(self.bytes_of[left] + self.bytes_of[right]) == [left, right]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of ``left`` followed by those of ``right``, both encodings."""
        if not left or not right:
            return left or right
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = self.leaf(b"".join(self.bytes_of[t] for t in left[-i:] + right[:j]))
            fits_left = i == len(left) or self.stable(left[-i - 1], window[0])
            fits_right = j == len(right) or self.stable(window[-1], right[j])
            if fits_left and fits_right:
                return left[: len(left) - i] + window + right[j:]
            i, j = (i if fits_left else 2 * i), (j if fits_right else 2 * j)

    def piece(self, data: bytes) -> list[int]:
        """Ids of one match, however long, level by level from leaves of ``LEAF`` bytes."""
        level = [self.leaf(data[i : i + LEAF]) for i in range(0, len(data), LEAF)]
        while len(level) > 1:
            paired = [self.join(a, b) for a, b in zip(level[::2], level[1::2])]
            level = paired + level[len(paired) * 2 :]
        return level[0] if level else []

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.find(text))), dtype=np.uint32)

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the ids, concatenated pairwise up from leaves of ``DECODE_LEAF`` ids."""
        level = [b"".join(map(self.bytes_of.__getitem__, ids[i : i + DECODE_LEAF])) for i in range(0, len(ids), DECODE_LEAF)]
        while len(level) > 1:
            paired = [a + b for a, b in zip(level[::2], level[1::2])]
            level = paired + level[len(paired) * 2 :]
        return level[0] if level else b""


@lru_cache(maxsize=2)
def codec(ranks: str) -> TreeCodec:
    """One codec per worker process and rank file."""
    return TreeCodec(read_ranks(ranks))


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every whole text.

    A null text counts as empty and gives an empty array. Null and repeated ids and repeated rows
    give a row each; an empty table gives none. Other columns are not looked at.
    """
    ranks = ranks or public_tokenizers.path(RANKS)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = codec(ranks).encode
        ids = [encode(text) for text in batch.column(1).to_pylist()]
        edges = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(ids).astype(np.int32)))
        return pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return by_batch(rows, work, f"doc_id {sql_type(rows, 'doc_id')}, ids array<int>")


def decode_ids(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes its ``ids`` stand for; null ids give no bytes.

    Takes the columns ``doc_id`` and ``ids``. Bytes, not text: ids of a cut sequence need not end
    at a character's end.
    """
    ranks = ranks or public_tokenizers.path(RANKS)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        decode = codec(ranks).decode
        ids = batch.column(1)
        edges, flat = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False)
        texts = [decode(flat[a:b].tolist()) if there else b"" for a, b, there in zip(edges[:-1], edges[1:], ids.is_valid().to_pylist())]
        return pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"])

    rows = encoded.select("doc_id", "ids")
    return by_batch(rows, work, f"doc_id {sql_type(rows, 'doc_id')}, ids array<int>, decoded binary")
