"""Collocations against SQL that counts every phrase, under bounds that close and open many branches."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import phrases, sql
from tests.llm.conftest import ODD


def plain(tmp_path, docs, **settings):
    docs.write.parquet(f"{tmp_path}/documents")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents/*.parquet'")
    return sorted(con.execute(sql.collocations(**settings)).fetchall())


def mined(docs, **settings):
    return sorted(tuple(r) for r in phrases.collocations(docs, **settings).collect())


def sample(spark, seed=5):
    """Words of very unequal counts, phrases that come again, and marks between them."""
    rng = np.random.default_rng(seed)
    known = [" ".join(f"w{x}" for x in rng.zipf(1.4, rng.integers(2, 7)) % 300) for _ in range(60)]
    rows = []
    for i in range(300):
        parts = [known[int(x)] if rng.random() < 0.5 else f"w{rng.zipf(1.3) % 500}" for x in rng.integers(0, 60, 25)]
        rows.append((i, "".join(p + str(rng.choice([" ", "  ", "\t", ". ", "\n", " W1 "])) for p in parts), [None, "en", "de"][i % 3]))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)


@pytest.mark.parametrize("first,reach,settings", [(1, 2, {"least": 5, "top": 40}), (4, 3, {"least": 3, "top": 5}), (16, 16, {"least": 4, "top": 100_000, "longest": 3})])
def test_matches_sql(spark, tmp_path, settings, first, reach, monkeypatch):
    monkeypatch.setattr(phrases, "FIRST_REACH", first)
    monkeypatch.setattr(phrases, "REACH", reach)
    docs = sample(spark)
    want = plain(tmp_path, docs, **settings)
    assert mined(docs, **settings) == want and len({w[0] for w in want}) == 3


def test_small_bitmaps_and_chunks_change_nothing(spark, tmp_path, monkeypatch):
    """A full bitmap lets everything through."""
    monkeypatch.setattr(phrases, "FIRST_REACH", 1)
    docs = sample(spark, 7)
    want = mined(docs, least=4, top=30)
    monkeypatch.setattr(phrases, "marked", lambda bitmap, hashes: np.ones(len(hashes), dtype=bool))
    monkeypatch.setattr(phrases, "CHUNK", 50)
    assert want == plain(tmp_path, docs, least=4, top=30)


def test_few_branches_are_expanded(spark, monkeypatch):
    """Once the list is full, words too common to lead to its last place are left alone."""
    monkeypatch.setattr(phrases, "FIRST_REACH", 2)
    asked = []
    monkeypatch.setattr(phrases, "cuts", lambda found, f=phrases.cuts: asked.append(found) or f(found))
    rows = [(i, " ".join(f"rare{i % 40}x{j} rare{i % 40}y{j}." for j in range(3)) + " the of" * 20) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
    made = mined(docs, least=5, top=50)
    assert len(made) == 50 and all("rare" in r[2] for r in made) and len(asked) == 1
    assert not asked[0].filter("phrase like 'the%' or phrase like 'of%'").count()


def test_exact_products(spark):
    """Products beyond 64 bits, floors and ties: the first of equal cuts counts."""
    big = 3_000_000_000_007
    cut = spark.createDataFrame([("x", "a b c", big, 1, "a", "b c"), ("x", "a b c", big, 2, "a b", "c")], "lang string, phrase string, a long, k int, left string, rest string")
    counts = spark.createDataFrame([("x", w, big + i) for i, w in enumerate(("a", "b c", "a b", "c"))], "lang string, phrase string, f long")
    totals = spark.createDataFrame([("x", 9_000_000_000_000_001)], "lang string, n long")
    r = phrases.scored(cut, counts, totals).first()
    scores = [1000 * big * 9_000_000_000_000_001 // ((big + x) * (big + y)) for x, y in ((0, 1), (2, 3))]
    assert r.score == min(scores) and (r.l, r.r) == ((big, big + 1) if scores[0] <= scores[1] else (big + 2, big + 3))


def test_odd_rows(spark, odd, nothing, tmp_path):
    rows = odd.withColumn("lang", F.when(F.col("doc_id") > 4, F.lit("en")))
    want = plain(tmp_path, rows, least=2, top=10)
    assert mined(rows, least=2, top=10) == want and want
    assert mined(nothing.withColumn("lang", F.lit("en"))) == []
    assert len(ODD) == odd.count()
