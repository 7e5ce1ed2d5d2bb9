"""Archives, index and lookups."""

import gzip
import hashlib
from collections import Counter

import pytest
from llm.examples import bag

from ledgermill.llm import warc
from ledgermill.workspace import new_path

PAGES = "page_id long, url string, html string"


def rows():
    same, small = "<p>" + "same " * 40, "<p>short"
    out = [(1, "http://b.example.org/x?y=1#z", same), (2, "https://Example.org", same), (3, None, same),
           (4, "http://b.example.org/x?y=1", small), (5, "http://b.example.org/x?y=1", small), (6, "weird url\nhere é", None),
           (7, "", ""), (None, "http://n.example", same), (None, "http://n.example", "x" * 300), (8, "http://c.example", "y" * 50_000),
           (8, "http://c.example", "y" * 50_000), (9, "http://d.example/é ü", "é" * 99), (10, "http://d.example:8080/", "é" * 99),
           (-11, "http://e.example", "z" * 100), (12, "http://e.example", "z" * 100), (13, "http://e.example", "z" * 99),
           (14, "http://f.example", "z" * 99)]
    return out + [(100 + k, f"http://hot.example.com/{k % 5}", f"page {k // 3} " * 20) for k in range(200)]


def brute(pages):
    key = lambda r: (r[0] is None, r[0] or 0)
    groups = {}
    for r in sorted(pages, key=key):
        groups.setdefault((r[2] or "").encode(), []).append(r)
    out = []
    for payload, group in groups.items():
        for k, r in enumerate(group):
            again = k > 0 and len(payload) >= 100
            out.append((r[0], len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response",
                        group[0][0] if again else None))
    return sorted(map(repr, out))


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(rows(), PAGES).repartition(3)


def test_write_look_up_read(pages, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE", 20_000)
    got = warc.archive(pages)
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(rows())


def test_blocks_of_a_few_lines(spark, pages):
    folder = new_path(spark, "warc-test")
    captures = warc.write(pages, folder)
    parts = warc.build_index(captures, folder, lines=3)
    assert sum(p["blocks"] for p in parts) >= len(rows()) // 3
    found = warc.lookup(warc.keys(pages), folder, parts)
    assert bag(found) == bag(captures)
    missing = spark.createDataFrame([("a", 1), ("zzz", 1), ("com,example,hot)/0", 101), ("com,example,hot)/1", 101)], "key string, id long")
    assert [(r["key"], r["id"]) for r in warc.lookup(missing, folder, parts).collect()] == [("com,example,hot)/1", 101)]
    hot = [x for x in rows() if x[1] == "http://hot.example.com/3"]
    one = warc.captures_of(folder, parts, "http://HOT.example.com/3#top")
    assert Counter(x["page_id"] for x in one) == Counter(x[0] for x in hot)
    assert warc.captures_of(folder, parts, "http://nowhere.example") == []
    full = {r["page_id"]: r["payload"] for r in one if r["record_type"] == "response"}
    assert all(full[i].decode() == h for i, _, h in hot if i in full)


def test_archives_are_gzip_members_of_records(spark, pages):
    folder = new_path(spark, "warc-test")
    first = warc.write(pages, folder).filter("id = 1").first()
    with warc.files.open_random(f"{folder}/{first['file']}") as file:
        text = gzip.decompress(file.read_at(first["length"], first["offset"]))
        file.seek(0)
        whole = gzip.decompress(file.read())
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith(b"\r\n\r\n")
    assert whole.count(b"WARC/1.1\r\n") > 1


def test_keys():
    assert warc.surt("http://Blog.Example.org:80/a?b#c") == "org,example,blog)/a?b"
    assert warc.surt("https://u:p@x.y:444") == "y,x:444)/"
    assert warc.surt(None) == "" and warc.surt("") == ")/"
    assert warc.surt("http://a/é b") == "a)/%C3%A9%20b"


def test_empty_and_clashing(spark, pages):
    from pyspark.sql import functions as F

    assert warc.archive(spark.createDataFrame([], PAGES)).count() == 0
    more = pages.select("*", *(F.lit(1).alias(c) for c in ("payload", "digest", "revisit", "anchor_file", "key", "id")))
    assert bag(warc.archive(more)) == bag(warc.archive(pages))


def test_reading_tasks_follow_the_archives_bytes(spark, pages, monkeypatch):
    """As many rows, larger records: more tasks; and neighbours come in one request."""
    folder = new_path(spark, "warc-test")
    captures = warc.write(pages, folder)
    size = captures.selectExpr("sum(length)").first()[0]
    for part in (size, -(-size // 7)):
        monkeypatch.setattr(warc, "READ", part)
        found = warc.read(captures, folder)
        assert found.rdd.getNumPartitions() == -(-size // part)
        assert found.count() == len(rows())


def test_requests_take_neighbours_together(monkeypatch):
    monkeypatch.setattr(warc, "REQUEST", 100)
    monkeypatch.setattr(warc, "GAP", 10)
    places = [(0, 30), (30, 30), (70, 30), (100, 30), (200, 500), (700, 5), (720, 5)]
    assert list(warc.requests(places)) == [(0, 3, 100), (3, 4, 130), (4, 5, 700), (5, 6, 705), (6, 7, 725)]
    assert list(warc.requests([])) == []
