"""URL filters against a plain reading of the rules, and WARC records as exact round trips."""

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from corpusloom.llm import urls, warc
from corpusloom.llm.catalog import URL_RULES

CASES = [
    "http://Www.Example.COM/en/x?q#f",
    "https://example.com/en/",
    "https://a.b.example.com/en/y",
    "https://example.com/en",
    "https://example.com",
    "ftp://x.net/es/1",
    "ftp://x.net/de/1",
    "http://net/fr/",
    "http://xnet/fr/",
    "no scheme",
    "",
    None,
    "a://b://c.com/x",
    "http://É.COM/",
    "http://com?x/y",
    "http://h.com#/en/",
    "http://" + "a." * 5000 + "net/es/" + "p" * 5000,
]


def brute(url, rules, default="allow"):
    host, path = urls.split_url(url)
    fits = [((len(h + p), len(h)), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, default)))


def test_parts_of_urls():
    assert urls.split_url("http://Www.Example.COM/en/x?q#f") == ("www.example.com", "/en/x")
    assert urls.split_url("a://b://c.com/x") == ("b:", "//c.com/x")
    assert urls.split_url("http://h?x/y") == ("h", "") and urls.split_url("x") == ("", "") and urls.split_url(None) == ("", "")


def test_verdicts_both_ways(spark):
    rng = random.Random(1)
    labels = ["a", "b", "com", "net", "example", "www"]
    rules = {(".".join(rng.choices(labels, k=rng.randrange(1, 4))), rng.choice(["", "/", "/a", "/ab/", "/en/"])): rng.choice(["allow", "block"]) for _ in range(60)}
    rules = [*URL_RULES, *((h, p, v) for (h, p), v in rules.items() if not any((h, p) == r[:2] for r in URL_RULES))]
    cases = CASES + [f"http://{'.'.join(rng.choices(labels, k=rng.randrange(1, 5)))}{rng.choice(['', '/', '/a', '/abc', '/ab/c', '/en/x'])}" for _ in range(400)]
    pages = spark.createDataFrame(list(enumerate(cases)), "page_id bigint, url string").withColumn("host", F.lit("clash"))
    want = [(i, *brute(u, rules)) for i, u in enumerate(cases)]
    assert sorted(map(tuple, urls.judge_urls(pages, rules).collect())) == want
    joined = urls.judge_urls_by_join(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert sorted(map(tuple, joined.collect())) == want
    assert urls.judge_urls(pages, [], default="block").where("verdict = 'block' AND rule IS NULL").count() == len(cases)
    assert urls.judge_urls(pages.limit(0), rules).count() == 0


def test_collisions_are_confirmed(tmp_path, monkeypatch):
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda data: 7)
    path = tmp_path / "index"
    path.write_bytes(urls.build_index([("a.com", "/", "block"), ("b.com", "/", "allow")]))
    index = urls.DigestArray(str(path))
    assert index.judge([("a.com", "/x"), ("b.com", "/"), ("c.com", "/")]) == [("a.com/", "block"), ("b.com/", "allow"), (None, None)]


def test_bad_rules():
    for rule in (("a/b", "/", "block"), ("a", "x", "block"), ("a", "/", "maybe")):
        with pytest.raises(ValueError):
            urls.build_index([rule])


ROWS = [
    (5, "http://a/1", "x" * 100, 1),
    (3, "http://a/2\r\nX: y", "x" * 100, 1),
    (9, None, "x" * 100, 1),
    (3, "http://a/2\r\nX: y", "x" * 100, 1),
    (None, "u", "x" * 100, 1),
    (1, "u", "x" * 99, 1),
    (2, "u", "x" * 99, 1),
    (7, "u", None, 1),
    (8, "u", "", 1),
    (10, "u", "é" * 50 + "\r\n\r\n", 1),
    (11, "u", "é" * 50 + "\r\n\r\n", 1),
    (12, "u", "z" * 3_000_000, 1),
    (None, "u", "only nulls " * 20, 1),
    (None, "u", "only nulls " * 20, 1),
]


def test_records_come_back(spark):
    pages = spark.createDataFrame(ROWS, "page_id bigint, url string, html string, digest int").repartition(5)
    archive = warc.write_archive(pages)
    read = warc.read_archive(spark, archive).cache()
    assert read.count() == len(ROWS)
    assert spark.read.parquet(archive.payloads).count() == len({(h or "") for _, _, h, _ in ROWS})
    first = {}
    for i, _, h, _ in ROWS:
        body = (h or "").encode()
        if len(body) >= 100 and i is not None:
            first[body] = min(i, first.get(body, i))
    want = []
    for i, _, h, _ in ROWS:
        body = (h or "").encode()
        revisit = body in first and i != first[body]
        want.append((i, body, hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", first[body] if revisit else None))
    key = lambda r: tuple((x is None, x or 0) for x in (r[0], r[4])) + (r[2],)
    assert sorted(((r.id, bytes(r.payload), r.digest, r.record_type, r.refers_to) for r in read.collect()), key=key) == sorted(want, key=key)
    for r in warc.records(spark, archive).collect():  # a second reading, in plain Python
        fields, block = warc.parse_record(bytes(r.record))
        assert block == (b"" if fields["WARC-Type"] == "revisit" else bytes(r.payload)) and "X" not in fields and int(fields["Content-Length"]) == len(block)
    ids = [r.record_id for r in read.collect()]
    assert len(set(ids)) == len({(i, u, h) for i, u, h, _ in ROWS})
    responses = {r.record_id for r in read.where("record_type = 'response'").collect()}
    for r in read.where("record_type = 'revisit'").collect():
        fields = dict(x.split(": ", 1) for x in bytes(r.header).decode().split("\r\n")[1:-2])
        assert fields["WARC-Refers-To"] in responses and fields["WARC-Record-ID"] == r.record_id and bytes(r.block) == b""


def test_ids_of_any_characters(spark):
    names = ["a b", "x\r\nWARC-Type: response", "<urn:record:is:y>", "", "null", "ü%20+", "b:c", None]
    rows = [(n, f"http://h/{i}", "p" * 120) for i, n in enumerate(names)]
    read = warc.read_archive(spark, warc.write_archive(spark.createDataFrame(rows, "page_id string, url string, html string")))
    found = {r.id: r for r in read.collect()}
    assert set(found) == set(names) and len({r.record_id for r in found.values()}) == len(names)
    for n in names:
        assert found[n].refers_to == (None if n == "" else "") and found[n].record_type == ("response" if n == "" else "revisit")


def test_damaged_payloads_are_found(spark):
    archive = warc.write_archive(spark.createDataFrame(ROWS[:2], "page_id bigint, url string, html string, x int"))
    spark.read.parquet(archive.payloads).withColumn("body", F.encode(F.lit("other"), "UTF-8")).write.parquet(archive.payloads + "-bad")
    with pytest.raises(Exception, match="differs from its digest|where its header says"):
        warc.read_archive(spark, warc.Archive(archive.headers, archive.payloads + "-bad")).collect()


def test_empty_archive(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.read_archive(spark, warc.write_archive(empty)).count() == 0
