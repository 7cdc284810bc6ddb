"""Alignment of two tokenizers against a plain version, byte by byte."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyhouse.llm import alignment
from tests.llm.conftest import ODD


def byte_of_letter():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(c): b for b, c in zip(shown + rest, shown + [256 + i for i in range(len(rest))])}


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")), byte_of_letter()


def plain_tokens(tokenizers, text):
    a, b, letters = tokenizers
    one = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids] if text else []
    two = []
    for i in b.encode(text) if text else []:
        piece = b.id_to_piece(i)
        two.append((i, bytes([int(piece[3:5], 16)]) if piece.startswith("<0x") and len(piece) == 6 else piece.replace("\u2581", " ").encode()))
    want = (" " + (text or "")).encode()
    same = text and b"".join(x for _, x in one) == want and b"".join(x for _, x in two) == want
    return (one, two) if same else ([], [])


def plain(tokenizers, rows):
    tokens = [plain_tokens(tokenizers, t) for _, t in rows]
    links, printed = [], []
    for one, two in tokens:
        owner = [i for i, x in enumerate(one) for _ in x[1]]
        partner = [j for j, x in enumerate(two) for _ in x[1]]
        links.append([(one[i][0], two[j][0]) for i, j in sorted(set(zip(owner, partner)))])
        ends_a, ends_b = (np.cumsum([len(x) for _, x in side]).tolist() for side in (one, two))
        both, groups, i, j = sorted(set(ends_a) & set(ends_b)), [], 0, 0
        for end in both:
            k, m = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(str(x) for x, _ in one[i:k]) + "|" + ",".join(str(x) for x, _ in two[j:m]))
            i, j = k, m
        printed.append(groups)
    count, highest = Counter(x for each in links for x in each), defaultdict(int)
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    out = []
    for (i, _), (one, two), each, groups in zip(rows, tokens, links, printed):
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if one else ""
        out.append((i, len(one), len(two), len(groups), len(each), sum(count[x] == highest[x[1]] for x in each), sum(count[x] for x in each), digest))
    return sorted(out, key=str)


def made(docs):
    return sorted((tuple(r) for r in alignment.align(docs).collect()), key=str)


ODDER = [(20, "<s> </s> <unk> <|endoftext|> \u2581 x\u2581y"), (21, "\x00 a\x00b"), (22, "\ufb01 \u00bd \u3000 e\u0301 \U0001f600"), (23, "  two  spaces  "), (24, "\r\n\t"), (25, "<0x41>")]


def test_odd_texts(spark, tokenizers, odd, nothing):
    assert made(odd) == plain(tokenizers, [(i, t) for i, t in ODD])
    assert made(nothing) == []
    docs = spark.createDataFrame(ODDER, "doc_id long, text string")
    assert made(docs) == plain(tokenizers, ODDER)


@pytest.mark.parametrize("records,fan_in", [(1 << 21, 32), (3000, 3)])
def test_documents(spark, tokenizers, documents, records, fan_in, monkeypatch):
    """Few large blocks, or many small ones whose runs take several rounds of merges."""
    monkeypatch.setattr(alignment, "BLOCK_RECORDS", records)
    monkeypatch.setattr(alignment, "FAN_IN", fan_in)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 1 << 13)
    docs = spark.createDataFrame(documents, "doc_id long, text string").repartition(4)
    want = plain(tokenizers, documents)
    assert made(docs) == want and sum(x[1] > 0 for x in want) > 100


def test_runs_keep_all_records():
    rng = np.random.default_rng(2)
    block, seen = alignment.Block(0), Counter()
    for _ in range(3):
        text, a, b = np.sort(rng.integers(0, 20, 500)), rng.integers(0, 9, 500), rng.integers(0, 40, 500)
        seen.update(zip(b.tolist(), a.tolist()))
        block.add(20, [text, a, b])
    runs = [alignment.merged([pairs]) for _, pairs, _ in block.runs()]
    assert {(int(p) >> alignment.ID_BITS, int(p) & 0xFFFFF): int(n) for pairs, totals in runs for p, n in zip(pairs, totals)} == seen
    pairs, totals = alignment.merged([p for _, p, _ in block.runs()] * 2)
    assert (np.diff(pairs) > 0).all() and totals.sum() == 3000
    best = alignment.highest(pairs, totals)
    for b in range(40):
        own = (pairs >> alignment.ID_BITS) == b
        assert (best[own] == (totals[own] == totals[own].max())).all()
