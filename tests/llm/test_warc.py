import gzip
import hashlib
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from visittrail.llm import warc
from visittrail.llm.urls import url_key

SCHEMA = "page_id long, url string, html string, digest string, payload string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    big = ["<p>" + "x" * n for n in (100, 97, 96, 200, 5000)]
    made = [(i, f"http://h{rng.randrange(9)}.example.net/p{rng.randrange(40)}",
             rng.choice([*big, f"own page {i} " * 20, "short"]), "d", "p") for i in range(300)]
    return made + [
        (1000, None, None, None, None), (1001, "", "", "", ""), (1002, "no scheme", "é" * 60, "", ""),
        (1003, "http://a/\r\nb", "é" * 60, "", ""), (None, "http://a/b", big[3], "", ""),
        (None, "http://a/b", "only here " * 20, "", ""), (1004, "http://a/b", "z" * 300_000, "", ""),
        (0, "http://again/", "second page of one id" * 9, "", ""),
        (2000, "http://x/", "second page of one id" * 9, "", ""),
    ] + [(3000, "http://same/", "repeated " * 30, "", "")] * 3


def expected(rows):
    first = {}
    for page, _, html, *_ in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        own = first.get(html or "")
        again = len(data) >= 100 and own is not None and own != page
        out.append((page, len(data), hashlib.sha256(data).hexdigest(),
                    "revisit" if again else "response", own if again else None))
    return Counter(out)


def read_all(pages, archive):
    keys = pages.select(F.coalesce(url_key(F.col("url")), F.lit(")")).alias("url_key"))
    return warc.digests(warc.read_records(archive, warc.lookup(archive, keys)))


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_round_trip(spark, rows, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    pages = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = read_all(pages, warc.write_archive(pages)).select(*COLUMNS).collect()
    assert Counter(map(tuple, found)) == expected(rows)


def test_lookup_reads_single_urls(spark, rows):
    pages = spark.createDataFrame(rows, SCHEMA)
    archive = warc.write_archive(pages)
    keys = spark.createDataFrame([("http://a/b",), ("http://nowhere/",)], "url string").select(
        url_key(F.col("url")).alias("url_key"))
    found = warc.read_records(archive, warc.lookup(archive, keys)).collect()
    assert Counter(r["page_id"] for r in found) == Counter([None, None, 1004])
    assert {len(r["payload"]) for r in found if r["page_id"] == 1004} == {300_000}


def test_revisits_without_their_response_keep_size_and_digest(spark):
    html = "shared " * 40
    rows = [(i, f"http://h{i}/", html, "", "") for i in range(5)]
    archive = warc.write_archive(spark.createDataFrame(rows, SCHEMA).repartition(3))
    keys = spark.createDataFrame([("http://h3/",), ("http://h4/",)], "url string").select(
        url_key(F.col("url")).alias("url_key"))
    records = warc.read_records(archive, warc.lookup(archive, keys))
    found = warc.digests(records).select(*COLUMNS).collect()
    digest = hashlib.sha256(html.encode()).hexdigest()
    assert {tuple(r) for r in found} == {(i, len(html), digest, "revisit", 0) for i in (3, 4)}
    assert records.rdd.getNumPartitions() >= 2


def test_archives_are_readable_one_record_at_a_time(spark, rows, tmp_path):
    pages = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    archive = warc.write_archive(pages, f"file://{tmp_path}")
    place = archive.captures.first()
    data = Path(tmp_path, place["archive"]).read_bytes()
    own = data[place["offset"]:place["offset"] + place["size"]]
    assert gzip.decompress(own).startswith(b"WARC/1.1\r\nWARC-Type: ")
    records = sum(gzip.decompress(p.read_bytes()).count(b"WARC/1.1\r\n")
                  for p in Path(tmp_path).glob("*.warc.gz"))
    assert records == len(rows)


def test_empty_table(spark):
    pages = spark.createDataFrame([], SCHEMA)
    assert read_all(pages, warc.write_archive(pages)).collect() == []


def test_keys_sort_by_reversed_host(spark):
    urls = [("http://B.Example.net/x?y#z",), ("no",), ("http://a?b",)]
    rows = spark.createDataFrame(urls, "u string").select(url_key(F.col("u"))).collect()
    assert [r[0] for r in rows] == ["net,example,b,)/x?y#z", ")", "a,)?b"]
