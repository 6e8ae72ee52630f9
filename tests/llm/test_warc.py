"""WARC files and their capture index."""

import base64
import gzip
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from chronotally.llm import captures, warc
from chronotally.session import run_folder

SCHEMA = "page_id bigint, url string, html string, payload string, row int, `key` string"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(partitions)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows, min_bytes=0):
    """Rows without their URL, as read back; of equal rows it doesn't matter which is the response."""
    groups, out = {}, []
    for page_id, _, html in rows:
        groups.setdefault(html or "", []).append(page_id)
    for html, pages in groups.items():
        n = len(html.encode())
        pages.sort(key=lambda p: (p is None, p or 0))
        for k, page in enumerate(pages):
            again = k > 0 and n >= min_bytes
            out.append((page, n, digest(html), "revisit" if again else "response", pages[0] if again else None))
    return sorted(out, key=str)


def whole(found):
    rows = found.select(
        F.col("page_id").cast("bigint"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("bigint")
    )
    return sorted((tuple(r) for r in rows.collect()), key=str)


def odd_rows():
    draw = random.Random(2)
    rows = [
        (1, "http://www.example.org/a", "same"), (0, "https://example.org:443/a#top", "same"), (0, "https://example.org/a", "same"),
        (None, None, "same"), (5, "", None), (6, None, ""), (7, "http://[::1]:80/x y", "\r\n\r\nWARC/1.1\r\n\r\n"),
        (8, "http://é.example/\r\nWARC-Type: x", "é" * 10), (None, "http://10.0.0.1/", "alone"), (9, "x" * 5000, "long key"),
        (10, "x" * 5000 + "y", "long key too"), (11, "http://user@HOST.example/?q", "z" * 3_000_000),
    ]
    return rows + [(100 + i, f"http://h{draw.randrange(5)}.example/{draw.randrange(40)}", f"page {draw.randrange(30)}") for i in range(200)]


@pytest.mark.parametrize("min_bytes, file_bytes", [(0, 1 << 28), (0, 500), (6, 1 << 28)])
def test_pages_come_back(spark, min_bytes, file_bytes):
    rows, folder = odd_rows(), run_folder(spark, "warc-test")
    pages = frame(spark, rows)
    warc.write_archive(pages, folder, min_bytes=min_bytes, file_bytes=file_bytes)
    found = warc.read_urls(spark, folder, pages)
    assert whole(found) == expected(rows, min_bytes)
    texts = {r.page_id: r.payload for r in found.filter("record_type = 'response'").collect()}
    for page_id, _, html in rows:
        if page_id is not None and str(page_id) in texts:
            assert bytes(texts[str(page_id)]).decode() == (html or "")


def test_files_are_members_of_gzip(spark):
    rows, folder = odd_rows(), run_folder(spark, "warc-test")
    warc.write_archive(frame(spark, rows), folder)
    data = b""
    for name in os.listdir(f"{folder}/warc"):
        if name.endswith(".gz"):
            with open(f"{folder}/warc/{name}", "rb") as file:
                data += gzip.decompress(file.read())
    heads = 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        size = int(fields[b"Content-Length"])
        assert head.startswith(b"WARC/1.1\r\n") and rest[size : size + 4] == b"\r\n\r\n"
        data, heads = rest[size + 4 :], heads + 1
    assert heads == len(rows)


def test_one_url_among_many(spark):
    rows, folder = odd_rows(), run_folder(spark, "warc-test")
    warc.write_archive(frame(spark, rows), folder)
    asked = spark.createDataFrame([("http://h1.example/3",), ("https://h1.example:443/3",), ("http://nowhere/",), (None,)], "url string")
    found = warc.read_urls(spark, folder, asked)
    want = sorted(str(p) for p, url, _ in rows if url in ("http://h1.example/3", "", None) and p is not None)
    assert sorted(r.page_id for r in found.collect() if r.page_id is not None) == want


def test_no_pages(spark):
    folder = run_folder(spark, "warc-test")
    pages = frame(spark, [])
    warc.write_archive(pages, folder)
    assert warc.read_urls(spark, folder, pages).collect() == []


def test_damage_is_noticed(spark):
    folder = run_folder(spark, "warc-test")
    places = warc.write_archive(frame(spark, [(1, "http://a/", "text")], 1), folder)
    row = {"page_id": "1", "row": 0, "url": b"http://a/", "payload": b"other", "sha1": bytes(20), "bytes": 5}
    place = places.first()
    data = gzip.compress(warc.record(row, "1970-01-01T00:00:00Z"))
    with open(f"{folder}/warc/{place.file}", "wb") as file:
        file.write(data)
    wrong = spark.createDataFrame([(place.file, 0, len(data))], "file string, offset bigint, length bigint")
    with pytest.raises(Exception, match="is damaged"):
        warc.read_records(wrong, folder).collect()


@pytest.mark.parametrize(
    "url, key",
    [
        ("http://www.Example.org/A?b=C#d", "org,example,www)/A?b=C"),
        ("https://user:pw@example.org:8080/x", "org,example)/x"),
        ("http://10.0.0.1/x", "10.0.0.1)/x"),
        ("example.org", "org,example)"),
        ("http://a.b?q=c.d/e", "b,a)?q=c.d/e"),
        ("", ""),
        (None, ""),
    ],
)
def test_keys(spark, url, key):
    frame = spark.createDataFrame([(url,)], "url string")
    assert bytes(frame.select(captures.url_key(F.col("url"))).first()[0]).decode() == key


def test_long_keys_are_bounded(spark):
    frame = spark.createDataFrame([("é" * 5000,), ("é" * 5000 + "x",)], "url string")
    keys = [bytes(r[0]) for r in frame.select(captures.url_key(F.col("url"))).collect()]
    assert len(set(keys)) == 2 and max(map(len, keys)) <= 1000


@pytest.mark.parametrize("block, partitions", [(1, 3), (4, 3), (1000, 1)])
def test_index_finds_all_entries_of_a_key(spark, block, partitions):
    draw = random.Random(block)
    keys = [f"k{draw.randrange(30):03}" for _ in range(150)] + ["k015"] * 200
    rows = [(k.encode(), f"f{i % 4}", i, 1) for i, k in enumerate(keys)]
    folder = run_folder(spark, "captures-test")
    entries = spark.createDataFrame(rows, "`key` binary, file string, offset bigint, length bigint").repartition(partitions)
    captures.write_index(entries, folder, block)
    asked = [f"k{i:03}".encode() for i in range(0, 40, 3)] + [b"", b"z", b"k015"]
    frame = spark.createDataFrame([(k,) for k in asked], "`key` binary").repartition(2)
    got = sorted((bytes(r[0]), *r[1:]) for r in captures.look_up(spark, folder, frame).collect())
    assert got == sorted(r for r in rows if r[0] in asked)
