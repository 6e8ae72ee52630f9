"""Pages in WARC files: each payload stored once, found again by a two-level capture index.

A page is a ``response`` record with an HTTP block, or, where an earlier one has the same payload, a
``revisit`` record that refers to it and holds the HTTP headers alone (the profile for identical
payloads). Of pages with equal payloads (by SHA-1) the least page id is the response. Each record is a
gzip member of its own, so any record can be read by its place and length.

The payload of each digest moves once, however many pages have it: the digests, ids and URLs of the pages
are a table of their own, and payloads are reduced to one per digest before and after the exchange. Tasks
write the files in a folder that all executors reach, under names that no other attempt uses, and give
the place of each record; Spark commits that table, and only files named in it count. A folder is a
path, or a URL of a store that pyarrow reaches (file, hdfs, s3, gs, abfs).

Reading goes by the index (:mod:`captures`): keys to places, places in the order of files, so that
neighbouring records are read in one go. Payloads are checked against their digests.

A null or empty payload is a payload of no bytes. Null page ids come after all others and are read back
as null. Of repeated rows one is the response. A record without a URL has no target URI and an empty
key. Characters of ids and URLs that a header can't hold are written as ``%XX``. An empty table gives an
archive without records. Columns other than those named are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotally.llm import captures
from chronotally.llm.captures import opened
from chronotally.llm.tables import stored

FILE_BYTES = 1 << 28
_GAP, _READ = 1 << 12, 1 << 22
#: Bytes of archives that one task reads, about.
_TASK = 1 << 26
#: Fixed values of the format.
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"

_PLACES = "key binary, file string, offset bigint, length bigint"
_BAD = re.compile(rb"[^\x21-\x24\x26-\x7e\x80-\xff]")
_ID = re.compile(r"<urn:page:(n|v[^:]*):(-?\d+)>")


def _record_id(page_id: str | None, row: int) -> str:
    return f"<urn:page:{'n' if page_id is None else 'v' + quote(page_id, safe='')}:{row}>"


def _page_of(record_id: str) -> str | None:
    page = _ID.fullmatch(record_id).group(1)
    return None if page == "n" else unquote(page[1:])


def _uri(url: bytes) -> bytes:
    return _BAD.sub(lambda m: b"%%%02X" % m.group()[0], url)


def record(row: dict, date: str) -> bytes:
    """A record of a row of :func:`write_archive`, not compressed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % row["bytes"]
    revisit = row["payload"] is None
    block = http if revisit else http + row["payload"]
    head = [
        b"WARC/1.1",
        b"WARC-Type: revisit" if revisit else b"WARC-Type: response",
        b"WARC-Record-ID: " + _record_id(row["page_id"], row["row"]).encode(),
        b"WARC-Date: " + date.encode(),
        b"WARC-Payload-Digest: sha1:" + base64.b32encode(row["sha1"]),
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % len(block),
    ]
    if row["url"]:
        head.append(b"WARC-Target-URI: " + _uri(row["url"]))
    if revisit:
        head.append(b"WARC-Profile: " + _REVISIT.encode())
        head.append(b"WARC-Refers-To: " + _record_id(row["to_page"], row["to_row"]).encode())
        if row["to_url"]:
            head.append(b"WARC-Refers-To-Target-URI: " + _uri(row["to_url"]))
    return b"\r\n".join(head) + _END + block + _END


def parsed(data: bytes) -> dict:
    """A record's headers (lower-case names) and block, its HTTP headers, and its payload."""
    head, _, rest = data.partition(_END)
    lines = head.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("no WARC record at this place")
    named = (line.partition(b":") for line in lines[1:])
    headers = {k.decode().lower(): v.strip().decode("utf-8", "replace") for k, _, v in named}
    block = rest[: int(headers["content-length"])]
    if rest[len(block) :] != _END:
        raise ValueError(f"record {headers.get('warc-record-id')} has another length than it says")
    http, _, payload = block.partition(_END)
    fields = dict(line.lower().split(b":", 1) for line in http.split(b"\r\n")[1:])
    return {"headers": headers, "bytes": int(fields[b"content-length"]), "payload": payload}


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_archive(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 0,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write the records of all pages and an index of them below ``folder``; give the places.
    Payloads of fewer than ``min_bytes`` bytes are responses each."""
    text = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    sha1, size = F.unhex(F.sha1(text)), F.octet_length(text)
    rows = stored(
        pages.select(
            F.col(page_id).alias("page_id"),
            F.col(url).cast("binary").alias("url"),
            sha1.alias("sha1"),
            size.cast("bigint").alias("bytes"),
            F.monotonically_increasing_id().alias("row"),
            F.when(size < min_bytes, text).alias("payload"),
        ),
        "warc-rows",
    )
    shared = rows.filter(F.col("bytes") >= min_bytes)
    # Nulls last: a struct with a true first field is greater.
    place = F.struct(F.col("page_id").isNull().alias("unnamed"), "page_id", "row", "url")
    firsts = stored(
        shared.groupBy("sha1", "bytes").agg(F.min(place).alias("to"), F.count("*").alias("n")), "warc-firsts"
    )
    payloads = pages.select(sha1.alias("digest"), text.alias("payload")).filter(F.octet_length("payload") >= min_bytes)
    payloads = payloads.groupBy("digest").agg(F.first("payload").alias("payload"))
    responses = firsts.join(payloads, F.col("sha1") == F.col("digest")).select(
        "to.page_id", "to.row", "to.url", "sha1", "bytes", "payload"
    )
    repeated = firsts.filter("n > 1").select(F.col("sha1").alias("same"), "to")
    revisits = (
        shared.drop("payload")
        .join(repeated, F.col("sha1") == F.col("same"))
        .filter(F.col("row") != F.col("to.row"))
        .select(
            "page_id", "row", "url", "sha1", "bytes", F.lit(None).cast("binary").alias("payload"),
            F.col("to.page_id").cast("string").alias("to_page"), F.col("to.row").alias("to_row"), F.col("to.url").alias("to_url"),
        )
    )
    small = rows.filter(F.col("bytes") < min_bytes).select(responses.columns)
    records = revisits.unionByName(responses, True) if min_bytes <= 0 else revisits.unionByName(responses.unionByName(small), True)
    named = records.withColumns({"page_id": F.col("page_id").cast("string"), "key": captures.url_key(F.col("url"))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at = None, "", 0
        for batch in batches:
            columns = batch.schema.names
            places = []
            for values in zip(*(batch.column(c).to_pylist() for c in columns)):
                row = dict(zip(columns, values))
                squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = squeeze.compress(record(row, date)) + squeeze.flush()
                if out is None or at + len(data) > file_bytes and at:
                    if out is not None:
                        out.close()
                    system, path = opened(folder)
                    system.create_dir(f"{path}/warc", recursive=True)
                    name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{path}/warc/{name}", compression=None)
                out.write(data)
                places.append((row["key"], name, at, len(data)))
                at += len(data)
            keys, files, offsets, lengths = zip(*places) if places else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                names=["key", "file", "offset", "length"],
            )
        if out is not None:
            out.close()

    named.mapInArrow(run, _PLACES).write.parquet(f"{folder}/places")
    places = pages.sparkSession.read.schema(_PLACES).parquet(f"{folder}/places")
    captures.write_index(places, f"{folder}/index")
    return places


def read_records(places: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records at ``places`` (``file, offset, length``): ``page_id`` and ``refers_to`` as text,
    ``url, payload_bytes, payload_digest, record_type`` and, if wanted, ``payload`` (null in a revisit)."""
    kind = "page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string"
    names = [c.split()[0] for c in kind.split(", ")] + ["payload"] * with_payload

    def one(data: bytes) -> tuple:
        found = parsed(zlib.decompress(data, 31))
        headers, payload = found["headers"], found["payload"]
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
        revisit = headers["warc-type"] == "revisit"
        if not revisit and (len(payload) != found["bytes"] or _digest(payload) != digest):
            raise ValueError(f"the payload of {headers['warc-record-id']} is damaged")
        row = (
            _page_of(headers["warc-record-id"]), headers.get("warc-target-uri"), found["bytes"], digest,
            headers["warc-type"], _page_of(headers["warc-refers-to"]) if revisit else None,
        )
        return (*row, None if revisit else payload) if with_payload else row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()][: len(names)]
        system, path = opened(folder)
        for batch in batches:
            spans = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))))
            at = 0
            while at < len(spans):
                begin, to = spans[at][1], at + 1
                end = begin + spans[at][2]
                # Records that stand side by side are read in one go.
                while to < len(spans) and spans[to][0] == spans[at][0] and spans[to][1] <= end + _GAP and spans[to][1] + spans[to][2] - begin <= _READ:
                    end = max(end, spans[to][1] + spans[to][2])
                    to += 1
                if spans[at][0] != name:
                    name = spans[at][0]
                    file = system.open_input_file(f"{path}/warc/{name}")
                data = file.read_at(end - begin, begin)
                rows = [one(data[o - begin : o - begin + n]) for _, o, n in spans[at:to]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                at = to

    # Places are small and what they point to is not, so tasks are counted by the latter.
    places = places.select("file", "offset", "length")
    total = places.agg(F.sum("length")).first()[0] or 0
    tasks = max(total // _TASK + 1, int(places.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = places.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(run, kind + ", payload binary" * with_payload)


def read_urls(spark: SparkSession, folder: str, urls: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the URLs in column ``url``, by the index. URLs with one key count as one."""
    asked = urls.select(captures.url_key(F.col("url")).alias("key"))
    places = stored(captures.look_up(spark, f"{folder}/index", asked), "warc-found")
    return read_records(places, folder, with_payload)
