"""Queries against their SQL, on a table large enough for templates and merged branches."""

import duckdb
import pytest

from tallyhouse.llm import queries

LARGER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(name, spark):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{LARGER}/{t}.parquet'")
    df = queries.QUERIES[name](spark, LARGER)
    result = con.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(row[names.index(c)] for c in df.columns) for row in result.fetchall()), key=str)
    assert sorted((tuple(r) for r in df.collect()), key=str) == want and want


def odd_tables(con):
    con.execute("create table documents as select * from (values (1, null, 'en'), (2, '', null), (3, E' \\t\\n ', ''), (null, 'no id here', 'de'), (4, repeat('a b c ', 40), 'en'), (4, repeat('a b c ', 40), 'en'), (6, repeat('x y z. ', 130), null)) t(doc_id, text, lang)")
    con.execute("create table pages as select * from (values (1, null, null), (2, 'x://A.NET?q', ''), (null, null, 'z'), (3, 'http://a.b/c/d/e/f/g', 'z'), (3, 'http://a.b/c/d/e/f/g', 'z'), (5, 'plain', 'é')) t(page_id, url, html)")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
@pytest.mark.parametrize("limit", ["", "limit 0"])
def test_odd_rows_match_sql(name, limit, spark, tmp_path):
    con = duckdb.connect()
    odd_tables(con)
    for t in ("documents", "pages"):
        con.execute(f"copy (select * from {t} {limit}) to '{tmp_path}/{t}.parquet'")
        con.execute(f"drop table {t}")
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet'")
    df = queries.QUERIES[name](spark, str(tmp_path))
    result = con.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    want = sorted((tuple(row[names.index(c)] for c in df.columns) for row in result.fetchall()), key=str)
    assert sorted((tuple(r) for r in df.collect()), key=str) == want
    assert bool(want) != bool(limit)
