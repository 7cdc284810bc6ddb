import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))  # for the workers
sys.path.insert(0, ROOT)

#: Cases that every operator must take: nulls, empty and blank texts, ties, repeats, other alphabets, a long text.
ODD = [
    (5, "One two three four five six seven."), (5, "One two three four five six seven."), (1, None), (2, ""), (3, " \t\n "), (None, "no id here"), (None, None),
    (9, "word " * 30_000), (4, "naïve Ünï 漢字\r\nline\x0btwo\u00a0x <|endoftext|> !!"), (7, "a"), (8, "One two three four five six seven."), (10, "x" * 5000),
]
SCHEMA = "doc_id long, text string, n_chars string, kept int, ids string, `key` string, row string, fp string"


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with extra columns whose names clash with those that operators use inside."""
    return spark.createDataFrame([(i, t, "c", 1, "i", "k", "r", "f") for i, t in ODD], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, q, t) for i in range(40) for q, t in [(i % 2, (i + 1) % 2)]] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
