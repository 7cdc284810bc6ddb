"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often.

Both tokenizers cut the same bytes, so a document's tokens fall into groups between the offsets at
which both end, and tokens whose byte ranges overlap are linked. Pairs are counted over the whole
corpus by external spilling. A task cuts its documents into blocks; a block's records (pair,
document, links) are sorted side-major (B id, then A id), dealt by radix of the B id and kept as
zstd runs. Runs are merged by heap, a bounded number at a time, until one run per radix holds each
pair's count; as a B id's pairs lie together there, its highest count is known as they pass. The
counts then meet the records of a few blocks at a time and flow back as sums per document.

A pair or B id that is everywhere has a record per document in the runs, but no task sees more than
its share of blocks, and only counts, a number per pair and run, are merged.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import keep, small_batches, sql_type, text_of
from tallyhouse.llm.tokens import MODEL, PLAIN, RANKS, Encoder, read_ranks

PIECES = "piece_bpe_32k.model"
RADIX = 16  # B ids with the same remainder lie in one run
FAN_IN = 32  # runs that a task merges, and blocks whose records it looks at
BLOCK_RECORDS = 1 << 21  # records of a block, more where one document has more
BLOCK_DOCUMENTS = 1 << 13
SLICE_BYTES = 1 << 20  # text that is aligned at a time, more where one document has more
ID_BITS = 20  # of an id of either tokenizer
SPACE = "▁"


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers as one zstd frame, each in as few bytes a number as its largest needs."""
    small = [x.astype(np.min_scalar_type(x.max())) if len(x) else x.astype(np.uint8) for x in arrays]
    head = b"".join(np.array([len(x), x.itemsize], dtype="<u8").tobytes() for x in small)
    return zstandard.compress(head + b"".join(x.tobytes() for x in small), 3)


def unpacked(data: bytes, n: int) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    head, at, out = np.frombuffer(raw, dtype="<u8", count=2 * n).reshape(n, 2), 16 * n, []
    for size, width in head.tolist():
        out.append(np.frombuffer(raw, dtype=f"<u{width}", count=size, offset=at).astype(np.int64))
        at += size * width
    return out


class Aligner:
    """Two tokenizers and the bytes of their tokens."""

    def __init__(self, model: str, ranks: str, pieces: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.fast = Encoder(model, ranks).fast
        self.slow = Tokenizer.from_file(model)
        self.slow.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.bytes_a = {i: token for token, i in read_ranks(ranks).items()}
        self.bytes_b = {i: self._piece(i) for i in range(self.pieces.get_piece_size())}
        self.length_a, self.length_b = (np.array([len(t.get(i, b"")) for i in range(max(t) + 1)]) for t in (self.bytes_a, self.bytes_b))
        # What a token adds to the printed groups: its number and the mark behind it, in a group or at its end.
        self.text_a, self.text_b = (np.array([b"%d%c" % (i, m) for i in range(max(t) + 1) for m in marks], dtype=object) for t, marks in ((self.bytes_a, b",|"), (self.bytes_b, b",;")))

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace(SPACE, " ").encode()

    def ids(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both tokenizers per text, none where the bytes of either are not those of the text behind a space."""
        out = []
        for text, b in zip(texts, self.pieces.encode(texts, num_threads=1)):
            spaced = " " + text
            a = self.fast.encode_ordinary(spaced) if PLAIN.fullmatch(spaced) else self.slow.encode(spaced, add_special_tokens=False).ids
            want = spaced.encode()
            same = text and b"".join(map(self.bytes_a.__getitem__, a)) == want and b"".join(map(self.bytes_b.__getitem__, b)) == want
            out.append((a, b) if same else ([], []))
        return out

    def align(self, texts: list[str]) -> tuple[list[np.ndarray], list[str], list[np.ndarray]]:
        """Per text: its numbers (A ids, B ids, groups, links) and its groups' digest. Per link: text, A id, B id.

        The texts with tokens are laid end to end, where both tokenizers end at each text's end.
        """
        ids = self.ids(texts)
        n_a, n_b = (np.array([len(x[i]) for x in ids], dtype=np.int64) for i in (0, 1))
        a, b = (np.fromiter((t for x in ids for t in x[i]), dtype=np.int64, count=int(n.sum())) for i, n in ((0, n_a), (1, n_b)))
        if not len(a):
            zero = np.zeros(len(texts), dtype=np.int64)
            return [n_a, n_b, zero, zero], [""] * len(texts), [a, a, a]
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        text_of_a = np.repeat(np.arange(len(texts)), n_a)
        high = np.searchsorted(ends_b, ends_a)
        low = np.searchsorted(ends_b, ends_a - self.length_a[a], side="right")
        last_a, last_b = ends_b[high] == ends_a, np.zeros(len(b), dtype=bool)
        last_b[high[last_a]] = True
        count = high - low + 1
        linked_a = np.repeat(np.arange(len(a)), count)
        linked_b = np.arange(len(linked_a)) - np.repeat(np.cumsum(count) - count, count) + low[linked_a]
        per_text = [n_a, n_b, np.bincount(text_of_a[last_a], minlength=len(texts)), np.bincount(text_of_a[linked_a], minlength=len(texts))]
        # In print a group's A ids come first, then its B ids.
        until_a, until_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        printed = np.empty(len(a) + len(b), dtype=object)
        printed[np.arange(len(a)) + np.concatenate(([0], until_b))[group_a]] = self.text_a[2 * a + last_a]
        printed[np.arange(len(b)) + until_a[group_b]] = self.text_b[2 * b + last_b]
        edges = np.concatenate(([0], np.cumsum(n_a + n_b))).tolist()
        digests = [hashlib.sha256(b"".join(printed[x:y].tolist())[:-1]).hexdigest() if y > x else "" for x, y in zip(edges, edges[1:])]
        return per_text, digests, [text_of_a[linked_a], a[linked_a], b[linked_b]]


@lru_cache(maxsize=2)
def aligner(model: str, ranks: str, pieces: str) -> Aligner:
    """One per worker process and vocabularies."""
    return Aligner(model, ranks, pieces)


class Block:
    """Documents whose records are sorted and cut into runs together."""

    def __init__(self, number: int) -> None:
        self.number, self.documents, self.keys, self.links, self.size = number, 0, [], [], 0

    def add(self, texts: int, links: list[np.ndarray]) -> None:
        text, a, b = links
        key, n = np.unique(((b << ID_BITS | a) << 20) | (text + self.documents), return_counts=True)
        self.keys.append(key)
        self.links.append(n)
        self.documents, self.size = self.documents + texts, self.size + len(key)

    @property
    def full(self) -> bool:
        return self.size >= BLOCK_RECORDS or self.documents >= BLOCK_DOCUMENTS

    def runs(self) -> Iterator[tuple[int, bytes, bytes]]:
        """Per radix with records: its pairs with their links in the block, and the records behind them."""
        if not self.size:
            return
        key, links = np.concatenate(self.keys), np.concatenate(self.links)
        order = np.argsort(key)
        key, links = key[order], links[order]
        pair, document = key >> 20, key & ((1 << 20) - 1)
        radix = (pair >> ID_BITS) % RADIX
        for r in range(RADIX):
            own = np.flatnonzero(radix == r)
            if len(own):
                p, d, n = pair[own], document[own], links[own]
                first = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
                step = np.diff(d, prepend=0)
                step[first] = d[first]
                records = np.diff(np.concatenate((first, [len(p)])))
                yield r, packed(np.diff(p[first], prepend=0), np.add.reduceat(n, first)), packed(records, step, n)


def aligned(docs: DataFrame, id_col: str, text_col: str, paths: tuple[str, str, str]) -> DataFrame:
    """One row per document (``radix`` null) and one per run, both with the number of their block."""
    id_type = sql_type(docs, id_col)
    schema = f"block long, place int, doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, radix int, pairs binary, records binary"
    arrow = docs.select(F.col(id_col).alias("doc_id")).limit(0).toArrow().schema.field(0).type
    types = [pa.int64(), pa.int32(), arrow, *[pa.int64()] * 4, pa.string(), pa.int32(), pa.binary(), pa.binary()]
    names = [x.split(" ")[0] for x in "block place doc_id n_a n_b n_groups n_links groups_sha256 radix pairs records".split()]

    def rows(columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names)

    def sliced(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
        texts = batch.column(1).to_pylist()
        start, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= SLICE_BYTES or i + 1 == len(texts):
                yield start, texts[start : i + 1]
                start, size = i + 1, 0

    def runs(block: Block) -> Iterator[pa.RecordBatch]:
        for radix, pairs, records in block.runs():
            yield rows([[block.number], *[[None]] * 7, [radix], [pairs], [records]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, number = aligner(*paths), TaskContext.get().partitionId() << 32
        block = Block(number)
        for batch in batches:
            for start, texts in sliced(batch):
                per_text, digests, links = both.align(texts)
                k = len(texts)
                yield rows([[block.number] * k, range(block.documents, block.documents + k), batch.column(0).slice(start, k), *per_text, digests, *[pa.nulls(k, t) for t in types[8:]]])
                block.add(k, links)
                if block.full:
                    yield from runs(block)
                    block = Block(block.number + 1)
        yield from runs(block)

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(work, schema)


def entries(run: bytes) -> Iterator[tuple[int, int]]:
    steps, totals = unpacked(run, 2)
    return zip(np.cumsum(steps).tolist(), totals.tolist())


def merged(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in side-major order with their counts, by heap merge of sorted runs."""
    pairs, totals = [], []
    for pair, n in heapq.merge(*map(entries, runs)):
        if pairs and pairs[-1] == pair:
            totals[-1] += n
        else:
            pairs.append(pair)
            totals.append(n)
    return np.array(pairs, dtype=np.int64), np.array(totals, dtype=np.int64)


def highest(pairs: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """True for the pairs that have the highest count of their B id."""
    side = pairs >> ID_BITS
    first = np.flatnonzero(np.concatenate(([True], side[1:] != side[:-1])))
    return totals == np.repeat(np.maximum.reduceat(totals, first), np.diff(np.concatenate((first, [len(side)]))))


def _part(n: int):
    return F.pmod(F.xxhash64("block"), F.lit(max(1, -(-n // FAN_IN))).cast("long")).alias("part")


def pair_counts(runs: DataFrame, blocks: int) -> DataFrame:
    """One run per ``radix`` with every pair's count, by rounds of merges of about ``FAN_IN`` runs each."""

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        pairs, totals = merged(table.column("pairs").to_pylist())
        return pa.table({"radix": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int64()), "pairs": [packed(np.diff(pairs, prepend=0), totals)]})

    left = runs.select("radix", "block", "pairs")
    while True:
        left = keep(left.groupBy("radix", _part(blocks)).applyInArrow(merge, "radix int, block long, pairs binary"), "merged")
        blocks = -(-blocks // FAN_IN)
        if blocks <= 1:
            return left.select("radix", "pairs")


def contributions(runs: DataFrame, counts: DataFrame, blocks: int) -> DataFrame:
    """Per run the sums that its records' pair counts give to the documents of its ``block``."""
    parts = max(1, -(-blocks // FAN_IN))

    def flow(own: pa.Table, total: pa.Table) -> pa.Table:
        found = []
        if own.num_rows:
            steps, totals = unpacked(total.column("pairs")[0].as_py(), 2)
            pairs = np.cumsum(steps)
            best = highest(pairs, totals)
            for pair_run, record_run in zip(own.column("pairs").to_pylist(), own.column("records").to_pylist()):
                at = np.searchsorted(pairs, np.cumsum(unpacked(pair_run, 2)[0]))
                records, step, links = unpacked(record_run, 3)
                first = np.cumsum(records) - records
                walked = np.cumsum(step)
                document = walked - np.repeat(walked[first] - step[first], records)
                places, where = np.unique(document, return_inverse=True)
                sums = np.zeros((2, len(places)), dtype=np.int64)
                np.add.at(sums[0], where, links * np.repeat(totals[at], records))
                np.add.at(sums[1], where, links * np.repeat(best[at], records))
                found.append(packed(np.diff(places, prepend=0), *sums))
        return pa.table({"block": own.column("block").cast(pa.int64()), "sums": pa.array(found, pa.binary())})

    spread = counts.select("radix", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), "pairs")
    left = runs.select("radix", _part(blocks), "block", "pairs", "records").groupBy("radix", "part")
    return left.cogroup(spread.groupBy("radix", "part")).applyInArrow(flow, "block long, sums binary")


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, ranks: str | None = None, pieces: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    Tokenizer A encodes a space and the text, tokenizer B the text; names of special tokens are
    plain text. ``n_best`` counts the links whose pair is as frequent in the whole table as any pair
    of its B id, ``count_sum`` adds up the pairs' counts over the links. A text that is null, empty
    or not what the tokens' bytes spell has no tokens: zeros, and an empty string for the digest.
    Repeated ids and rows are counted row by row; texts are read whole; an empty table gives no row;
    other columns are not looked at, whatever their names.
    """
    paths = tuple(given or public_tokenizers.path(name) for given, name in ((model, MODEL), (ranks, RANKS), (pieces, PIECES)))
    stored = keep(aligned(docs, id_col, text_col, paths), "aligned")
    runs = stored.filter("radix is not null").select("block", "radix", "pairs", "records")
    blocks = runs.select("block").distinct().count()
    back = contributions(runs, pair_counts(runs, blocks), blocks)
    names = ["n_a", "n_b", "n_groups", "n_links"]

    def add_up(own: pa.Table, sums: pa.Table) -> pa.Table:
        place = own.column("place").to_numpy().astype(np.int64)
        total = np.zeros((2, int(place.max(initial=-1)) + 1), dtype=np.int64)
        for data in sums.column("sums").to_pylist():
            steps, count_sum, best = unpacked(data, 3)
            at = np.cumsum(steps)
            total[0, at] += count_sum
            total[1, at] += best
        columns = {"doc_id": own.column("doc_id"), **{c: own.column(c) for c in names}, "n_best": pa.array(total[1, place]), "count_sum": pa.array(total[0, place])}
        return pa.table({**columns, "groups_sha256": own.column("groups_sha256")})

    rows = stored.filter("radix is null").select("block", "place", "doc_id", *names, "groups_sha256")
    schema = f"doc_id {sql_type(rows, 'doc_id')}, {', '.join(f'{c} long' for c in names)}, n_best long, count_sum long, groups_sha256 string"
    return rows.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(add_up, schema)
