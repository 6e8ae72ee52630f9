"""A two-level index of captures by URL: compressed blocks of sorted keys, and a sparse directory of them.

The key of a URL is its host back to front and the rest, ``org,example,www)/path?query``, so that the
captures of a host and of its sub-hosts stand together. Scheme, user, port and fragment are left out.
Keys longer than 1,000 bytes are their first characters and a digest, so a key has a size bound.

Captures are dealt out by ranges of key, file and offset; each task writes a *shard*: sorted entries
in blocks of ``block`` entries, each compressed on its own, and behind them the directory, which has the
first and last key, place and length of each block. The list of shards (first key, last key, file,
place of the directory) is one row per task and small enough for every task to hold. A key that very many
captures share spans blocks and shards as any range does.

A look-up finds the shards of a key by binary search in the list, its blocks by binary search in the
directory, and its entries by binary search in a block, of which it reads only the bytes. Keys are
looked up in order, so that neighbours share a block.

Files are written below a folder that all executors reach, under names no other attempt of a task
uses; the list of shards, which Spark commits, tells which of them count. Null and empty URLs have an
empty key. Repeated entries are all kept. An empty table makes an index without shards.
"""

from __future__ import annotations

import struct
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotally.llm.tables import stored

_LONGEST_KEY = 1000
_FOOTER = "<qq"
_ENTRY = pa.schema({"key": pa.binary(), "file": pa.string(), "offset": pa.int64(), "length": pa.int64()})
_DIRECTORY = pa.schema({"first": pa.binary(), "last": pa.binary(), "at": pa.int64(), "size": pa.int64()})
_SHARDS = "first_key binary, last_key binary, shard string, entries bigint"


def url_key(url: Column) -> Column:
    """The key of a URL, as bytes."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    bare = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://", ""), r"(?s)#.*$", "")
    place = F.regexp_extract(bare, r"^[^/?]*", 0)
    host = F.lower(F.regexp_replace(F.regexp_replace(place, r"(?s)^.*@", ""), r":[0-9]*$", ""))
    numeric = host.rlike(r"^[0-9.]+$") | host.startswith("[")
    turned = F.when(numeric, host).otherwise(F.array_join(F.reverse(F.split(host, r"\.")), ","))
    rest = F.regexp_replace(bare, r"^[^/?]*", "")
    key = F.when(bare == "", F.lit("")).otherwise(F.concat(turned, F.lit(")"), rest))
    short = F.concat(F.substring(key, 1, (_LONGEST_KEY - 33) // 4), F.lit("#"), F.md5(key))
    return F.when(F.octet_length(key) > _LONGEST_KEY, short).otherwise(key).cast("binary")


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that tasks read and write by themselves, and its path there."""
    return fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def write_index(captures: DataFrame, folder: str, block: int = 1024) -> None:
    """Index ``captures`` (``key, file, offset, length``) below ``folder``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        directory: list[tuple[bytes, bytes, int, int]] = []
        out, name, entries = None, f"shard-{uuid.uuid4().hex}", 0

        def flush(rest: bool) -> None:
            nonlocal waiting, out
            table = pa.Table.from_batches(waiting, _ENTRY).combine_chunks()
            whole = len(table) if rest else len(table) - len(table) % block
            for at in range(0, whole, block):
                piece = table.slice(at, min(block, whole - at)).combine_chunks()
                if out is None:
                    system, path = opened(folder)
                    system.create_dir(f"{path}/shards", recursive=True)
                    out = system.open_output_stream(f"{path}/shards/{name}")
                data, keys = _packed(piece.to_batches()[0]), piece["key"]
                directory.append((keys[0].as_py(), keys[-1].as_py(), out.tell(), len(data)))
                out.write(data)
            waiting = table.slice(whole).to_batches()

        for batch in batches:
            waiting.append(batch.cast(_ENTRY))
            entries += len(batch)
            flush(rest=False)
        flush(rest=True)
        if out is None:
            return
        columns = [pa.array(c, f.type) for c, f in zip(zip(*directory), _DIRECTORY)]
        data, at = _packed(pa.RecordBatch.from_arrays(columns, schema=_DIRECTORY)), out.tell()
        out.write(data)
        out.write(struct.pack(_FOOTER, at, len(data)))
        out.close()
        row = {"first_key": [directory[0][0]], "last_key": [directory[-1][1]], "shard": [name], "entries": [entries]}
        yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in row.items()})

    order = ("key", "file", "offset")
    dealt = captures.select(*_ENTRY.names).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.mapInArrow(run, _SHARDS).write.parquet(f"{folder}/list")


class _Shard:
    """An open shard: its directory, and the block read last."""

    def __init__(self, folder: str, name: str):
        system, path = opened(folder)
        self.file = system.open_input_file(f"{path}/shards/{name}")
        end = self.file.size() - struct.calcsize(_FOOTER)
        at, size = struct.unpack(_FOOTER, self.file.read_at(struct.calcsize(_FOOTER), end))
        directory = _unpacked(self.file.read_at(size, at)).to_pydict()
        self.firsts, self.lasts = directory["first"], directory["last"]
        self.places = list(zip(directory["at"], directory["size"]))
        self.number, self.keys, self.table = None, [], None

    def entries(self, key: bytes) -> Iterator[pa.Table]:
        for number in range(bisect_left(self.lasts, key), bisect_right(self.firsts, key)):
            if number != self.number:
                at, size = self.places[number]
                self.table = _unpacked(self.file.read_at(size, at))
                self.number, self.keys = number, self.table["key"].to_pylist()
            begin, end = bisect_left(self.keys, key), bisect_right(self.keys, key)
            if begin < end:
                yield self.table.slice(begin, end - begin)


def look_up(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """The captures (``key, file, offset, length``) of the distinct keys in column ``key``."""
    listed = sorted(
        (bytes(r.first_key), bytes(r.last_key), r.shard) for r in spark.read.parquet(f"{folder}/list").collect()
    )
    firsts, lasts, names = (list(c) for c in zip(*listed)) if listed else ([], [], [])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_pylist()
            ranges = [range(bisect_left(lasts, k), bisect_right(firsts, k)) for k in keys]
            pairs = [(k, n) for k, some in zip(keys, ranges) for n in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in pairs], pa.binary()), pa.array([n for _, n in pairs], pa.int32())],
                names=["key", "shard"],
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = None, None
        for batch in batches:
            found, rows = [], 0
            for key, n in zip(batch.column("key").to_pylist(), batch.column("shard").to_pylist()):
                if n != number:
                    number, shard = n, _Shard(folder, names[n])
                for table in shard.entries(key):
                    found += table.to_batches()
                    rows += len(table)
                if rows > 4096:
                    yield from pa.Table.from_batches(found).combine_chunks().to_batches()
                    found, rows = [], 0
            if found:
                yield from pa.Table.from_batches(found).combine_chunks().to_batches()

    asked = keys.select("key").filter(F.col("key").isNotNull()).distinct()
    # A key that spans shards is a row for each, so that no task has more to read than some shards.
    pairs = stored(asked.mapInArrow(shards, "key binary, shard int"), "captures-asked")
    dealt = pairs.repartitionByRange("shard", "key").sortWithinPartitions("shard", "key")
    return dealt.mapInArrow(search, "key binary, file string, offset bigint, length bigint")
