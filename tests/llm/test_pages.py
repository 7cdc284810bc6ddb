"""WARC archives and URL verdicts against plain versions."""

import base64
import hashlib
import pathlib
import re

import pytest

from tallyhouse.llm import queries, url_templates, warc
from tests.llm.test_texts import native

SCHEMA = "page_id long, url string, html string, `key` string, payload string, host string, verdict string"


def page(i, url, html):
    return (i, url, html, "k", "p", "h", "v")


@pytest.fixture(scope="module")
def odd_pages(spark):
    return spark.createDataFrame([
        page(7, None, None), page(8, 'x:y"\\\r\né', ""), page(None, "http://A.b/ü", "q"), page(None, None, "q"), page(3, "a://b://c/d", "q"), page(4, "http://A.b/ü", "q"),
        page(4, "http://A.b/ü", "q"), page(5, "HTTP://X.Net?x=/", "é" * 300_000), page(6, "no scheme", "long"), page(9, "http://a.example.net/en/", "z"),
    ], SCHEMA)


def plain(rows):
    best = {}
    for r in rows:
        if r.page_id is not None:
            best[r.html or ""] = max(r.page_id, best.get(r.html or "", r.page_id))
    out = []
    for r in rows:
        data, holder = (r.html or "").encode(), best.get(r.html or "")
        first = holder in (None, r.page_id)
        out.append((r.page_id, r.url, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if first else "revisit", None if first else holder))
    return sorted(out, key=str)


def test_archives(spark, sf_dir, odd_pages):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    want = [(a, *x) for a, _, *x in plain(pages.collect())]
    assert sorted(map(tuple, queries.op7_warc(spark, sf_dir).collect()), key=str) == sorted(want, key=str)
    found = warc.archive_and_read(odd_pages).select("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, found), key=str) == plain(odd_pages.collect())
    assert warc.archive_and_read(odd_pages.limit(0)).count() == 0


def test_small_payloads_are_no_revisits(odd_pages):
    kinds = {(r.page_id, r.record_type) for r in warc.archive_and_read(odd_pages, least=1).collect() if r.payload_bytes == 0}
    assert kinds == {(7, "response"), (8, "response")}


@pytest.mark.parametrize("parts", [1, 3])
def test_lookup(spark, odd_pages, parts, monkeypatch):
    """Keys in one block, in several and in none; only blocks with wanted keys are opened."""
    folder = warc.new_folder(odd_pages)
    entries = warc.write_archives(odd_pages, folder)
    directory = warc.write_index(entries.repartition(parts), folder, block_entries=2)
    rows = [tuple(r) for r in entries.select("key", "page_id", "archive", "start", "length").collect()]
    for keys in ([r[0] for r in rows], ["net,example,a)/en/"], ["no such key", "b,a)/\u00fc"], [], [""]):
        got = warc.find(spark.createDataFrame([(k,) for k in keys], "key string"), directory, folder)
        assert sorted(map(tuple, got.collect()), key=str) == sorted((r for r in rows if r[0] in keys), key=str)
    assert next(r[0] for r in rows if r[1] == 9) == "net,example,a)/en/"
    some = warc.find(spark.createDataFrame([("net,example,a)/en/",)], "key string"), directory, folder)
    assert [(r.page_id, r.url) for r in warc.read_records(some, folder).collect()] == [(9, "http://a.example.net/en/")]


def test_many_archives_and_tasks(spark, monkeypatch):
    """An archive ends at its size, and reading takes as many tasks as the bytes need."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    monkeypatch.setattr(warc, "TASK_BYTES", 4000)
    pages = spark.createDataFrame([(i, f"http://h{i % 3}.com/{i % 5}", hashlib.sha256(str(i).encode()).hexdigest() * 4) for i in range(100)], "page_id long, url string, html string")
    folder = warc.new_folder(pages)
    made = warc.archive_and_read(pages, folder=folder)
    assert made.rdd.getNumPartitions() > 3
    assert {(r.page_id, r.url, bytes(r.payload).decode()) for r in made.collect()} == {tuple(r) for r in pages.collect()}
    assert len(list(pathlib.Path(folder.removeprefix("file:")).glob("*.warc.gz"))) > 10


def test_damage_is_found():
    whole = warc.record("response", 1, "u", b"payload", warc.base32_sha1(b"payload"), 7, None)
    assert warc.parse(whole)[1] == b"payload"
    for damaged in (whole[:-3], b"x" + whole, whole.replace(b"payload\r", b"payloads\r")):
        with pytest.raises(ValueError):
            warc.parse(damaged)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def test_urls(spark, sf_dir, odd_pages):
    made = queries.op9_url_filters(spark, sf_dir)
    assert native(made)
    odd = url_templates.judge_urls(odd_pages, queries.URL_RULES)
    for rows, given in ((made.collect(), spark.read.parquet(f"{sf_dir}/pages.parquet").collect()), (odd.collect(), odd_pages.collect())):
        urls = {}
        for r in given:
            urls.setdefault(r.page_id, []).append(split(r.url))
        assert len(rows) == len(given)
        for r in rows:
            assert (r.host, r.path) in urls[r.page_id]
            rule = plain_rule(r.host, r.path)
            assert r.rule == (rule.name if rule else None)
            assert r.verdict == (rule.verdict if rule else "block" if r.purity < url_templates.PURITY else "allow")
    assert url_templates.judge_urls(odd_pages.limit(0), queries.URL_RULES).count() == 0
    assert {r.verdict for r in url_templates.judge_urls(odd_pages, []).collect()} == {"allow"}


def test_bad_branches_are_blocked_alone(spark):
    """Of one host, a branch of bad pages is told apart from a good one, whatever its leaves are called."""
    urls = [f"http://h.com/{b}/{x}" for b in ("good", "bad") for x in [f"name{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]] + [f"http://h.com/item/{i}.html" for i in range(60)]
    rules = [url_templates.Rule("h.com", f"/bad/name{c}", "block") for c in "abcdefghijklmnopqrst"] + [url_templates.Rule("h.com", f"/good/name{c}", "allow") for c in "abcdefghijklmnopqrst"]
    rows = url_templates.judge_urls(spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string"), rules).collect()
    by = {}
    for r in rows:
        by.setdefault(r.path.split("/")[1], set()).add((r.template, r.verdict))
    assert by["bad"] == {("/bad", "block")} and by["good"] == {("/good", "allow")} and {v for _, v in by["item"]} == {"allow"}


def verdicts(spark, urls, rules):
    rows = url_templates.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()
    return {(r.host, r.path): r.verdict for r in rows}, {(r.host, r.path): r.template for r in rows}


def test_label_free_branches_and_other_hosts_are_left_alone(spark):
    """A small blocked branch blocks no other branch, and one huge host no other host."""
    urls = [f"http://h{h}.com/{b}/page{c}" for h in range(12) for b in ("de", "en", "fr") for c in "abcdefgh"]
    rules = [url_templates.Rule(f"h{h}.com", "/de/", "block") for h in range(5)] + [url_templates.Rule(f"h{h}.com", "/fr/", "allow") for h in range(5, 12)]
    alone, _ = verdicts(spark, urls, rules)
    assert all(v == ("block" if p.startswith("/de/") and int(h[1:-4]) < 5 else "allow") for (h, p), v in alone.items())
    huge = [f"http://huge.com/{i % 7}x/{chr(97 + i % 26)}{i % 13}" for i in range(4000)]
    crowd, _ = verdicts(spark, urls + huge, [*rules, url_templates.Rule("huge.com", "/", "block")])
    assert {k: v for k, v in crowd.items() if k[0] != "huge.com"} == alone


def test_templates_do_not_depend_on_crawls_and_reach_deep(spark):
    names = [chr(97 + i) + chr(97 + j) for i in range(6) for j in range(5)]
    urls = [f"http://d.com/a/b/c/d/{kind}/{x}" for kind in ("good", "bad") for x in names]
    rules = [url_templates.Rule("d.com", f"/a/b/c/d/bad/{x}", "block") for x in names[:12]] + [url_templates.Rule("d.com", f"/a/b/c/d/good/{x}", "allow") for x in names[:12]]
    once, shape = verdicts(spark, urls, rules)
    assert {v for (_, p), v in once.items() if "/bad/" in p} == {"block"} and {v for (_, p), v in once.items() if "/good/" in p} == {"allow"}
    often, again = verdicts(spark, urls * 5, rules)
    assert often == once and again == shape
    assert len({t for t in shape.values()}) <= 3
