"""Packing, lengths and the BPE tree against plain versions."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from tallyhouse.llm import bpe_tree, packing, queries, token_lengths
from tallyhouse.llm.tokens import MODEL, RANKS, encoder, read_ranks
from tests.llm.conftest import ODD

JSON = Tokenizer.from_file(public_tokenizers.path(MODEL))
OWN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path(RANKS)), special_tokens={})


def by_file(text):
    return JSON.encode(text or "", add_special_tokens=False).ids


def test_both_libraries_agree(documents):
    encode = encoder(public_tokenizers.path(MODEL), public_tokenizers.path(RANKS))
    odd = [t or "" for _, t in ODD] + ["a\u0085b", "\u200bzero", "x<|endoftext|>y", "‘quotes’ – dash", "ǅ ɏ ʰ", "\xad soft"]
    for text in [t for _, t in documents] + odd:
        assert encode.ids(text).tolist() == by_file(text)


def check_pieces(rows, texts, window):
    """Pieces cover every document once, in order, and fill all sequences but the last."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, text in texts.items():
        ids = by_file(text) + [1]
        pieces = sorted(by_doc.pop(i), key=lambda r: r["start"])
        assert [r["doc_tokens"] for r in pieces] == [len(ids)] * len(pieces)
        at = 0
        for r in pieces:
            assert r["start"] == at
            part = np.array(ids[at : at + r["length"]], dtype="<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part)
            at += r["length"]
        assert at == len(ids)
    assert not by_doc
    for number in range(len(by_sequence)):
        at = 0
        for r in sorted(by_sequence[number], key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == window or number == len(by_sequence) - 1 and 0 < at <= window


def test_packing_query(spark, sf_dir, documents):
    rows = [r.asDict() for r in queries.op1_packing(spark, sf_dir).collect()]
    check_pieces(rows, dict(documents), 2048)


def test_packing_odd(odd, nothing):
    rows = packing.pack(odd.filter("doc_id is not null").dropDuplicates(["doc_id"]).repartition(5), window=64).collect()
    made = [{**r.asDict(), "ids_crc32": zlib.crc32(bytes(r.ids))} for r in rows]
    check_pieces(made, {i: t for i, t in ODD if i is not None}, 64)
    assert packing.pack(nothing).count() == 0
    assert {r.doc_id for r in packing.pack(odd, end_id=None).collect()} == {5, 3, None, 9, 4, 7, 8, 10}
    assert sum(r.length for r in packing.pack(odd).collect()) == sum(len(by_file(t)) + 1 for _, t in ODD)


def test_lengths(spark, sf_dir, documents, odd, nothing):
    def plain(lengths):
        return {(n, k, sum(x >= n for x in lengths), sum(x for x in lengths if x >= n), sum(min(x, n) for x in lengths), sum(x <= n for x in lengths)) for n, k in Counter(lengths).items()}

    lengths = [len(by_file(t)) for _, t in documents]
    assert {tuple(r) for r in queries.op10_token_counts(spark, sf_dir).collect()} == plain(lengths)
    lengths = [len(by_file(t)) for _, t in ODD]
    sums = token_lengths.suffix_sums(token_lengths.length_histogram(odd)).cache()
    assert {tuple(r) for r in sums.collect()} == plain(lengths)
    limits = [0, 1, 3, 7, 8, 100, 10**6]
    assert {tuple(r) for r in token_lengths.truncated_totals(sums, limits).collect()} == {(m, sum(min(x, m) for x in lengths)) for m in limits}
    shares = [0.0, 0.1, 0.5, 0.99, 1.0]
    want = {(s, min(n for n in lengths if sum(x <= n for x in lengths) >= s * len(lengths))) for s in shares}
    assert {tuple(r) for r in token_lengths.length_quantiles(sums, shares).collect()} == want
    none = token_lengths.suffix_sums(token_lengths.length_histogram(nothing))
    assert none.count() == 0 and token_lengths.truncated_totals(none, [5]).collect()[0].tokens == 0


def test_tree_matches_library():
    codec, rng = bpe_tree.TreeCodec(read_ranks(public_tokenizers.path(RANKS))), random.Random(3)
    kinds = ["ab", "aaa", "the ing", "abcdefghijklmnopqrstuvwxyz", " \n\t", "éßüñ字漢", "0123456789", "-=_", "aeiou", "=" * 9 + "a"]
    for _ in range(400):
        text = "".join(rng.choice(rng.choice(kinds)) for _ in range(rng.choice([0, 1, 30, 200, 3000])))
        ids = codec.encode(text).tolist()
        assert ids == OWN.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
    long = "".join(rng.choice("etaoinsh") for _ in range(20_000))  # one match of the pattern
    assert codec.piece(long.encode()) == OWN.encode_ordinary(long)
    assert codec.decode(codec.piece(long.encode())) == long.encode()


def test_memo_is_bounded():
    memo = bpe_tree.Memo(str.upper, 3)
    assert [memo[k] for k in "abcabcdeaf"] == list("ABCABCDEAF") and len(memo) <= 3


def test_tree_query(spark, sf_dir, documents, odd, nothing):
    rows = {r.doc_id: r for r in queries.op8_bpe_tree(spark, sf_dir).collect()}
    assert len(rows) == len(documents)
    for i, text in documents:
        ids = OWN.encode_ordinary(text)
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = bpe_tree.decode_ids(bpe_tree.encode_texts(odd)).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted((t or "").encode() for _, t in ODD)
    assert bpe_tree.decode_ids(bpe_tree.encode_texts(nothing)).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in bpe_tree.decode_ids(nulls).collect()] == [b"", b""]
