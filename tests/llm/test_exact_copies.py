"""Exact duplicates against plain grouping."""

import hashlib
import re

import pytest

from tallyhouse.llm import exact_copies, queries
from tallyhouse.llm.common import keep
from tests.llm.conftest import ODD
from tests.llm.test_texts import native


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def plain(rows):
    """Rows as the operator marks them; among equal ids of a group one row is kept."""
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    out, seen = [], set()
    for i, t in rows:
        text = normal(t)
        ids = [x for x in groups[text] if x is not None]
        least = min(ids, default=None)
        kept = i == least and text not in seen
        if kept:
            seen.add(text)
        out.append((i, least, len(groups[text]), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def marked(docs):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.text_digest).hex()) for r in exact_copies.mark_copies(docs).collect()), key=str)


def test_odd_rows(odd, nothing):
    assert marked(odd) == plain(ODD)
    assert marked(nothing) == []
    kept = exact_copies.drop_copies(odd)
    assert kept.dtypes == odd.dtypes and exact_copies.drop_copies(nothing).count() == 0
    assert sorted((normal(r.text) for r in kept.collect())) == sorted({normal(t) for _, t in ODD})


@pytest.mark.parametrize("broadcast", [0, 8 << 20])
@pytest.mark.parametrize("per_word", [1, 4, 100_000])
def test_documents(spark, documents, broadcast, per_word, monkeypatch):
    """Any size of the filter, and both ways to meet it, give the same groups."""
    monkeypatch.setattr(exact_copies, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(exact_copies, "ROWS_PER_WORD", per_word)
    rows = documents + [(10**6 + i, "the  same\ttext") for i in range(300)] + [(10**6 + 500, "the same text ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert marked(docs) == plain(rows)
    assert sorted(r.doc_id for r in exact_copies.drop_copies(docs).collect()) == [x[0] for x in sorted(plain(rows)) if x[3]]


def test_only_possible_copies_shuffle(spark):
    """The filter lets through every repeated digest, and few others."""
    rows = [(i, f"text {i}") for i in range(20_000)] + [(20_000 + i, f"text {i}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    digests = keep(docs.select("doc_id", exact_copies.digest_of("text").alias("digest")), "digests")
    possible = {r.doc_id for r in exact_copies.possibly_repeated(digests).filter("possible").collect()}
    assert possible >= {*range(100), *range(20_000, 20_100)} and len(possible) < 600


def test_query_is_native(spark, sf_dir):
    assert native(queries.QUERIES["op12_exact_dedup"](spark, sf_dir))
