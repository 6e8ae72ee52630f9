"""Token ids in a binary file format, by document and in the order of their ids.

A file holds blocks; a block holds whole documents, about a million ids or one longer document:

* ``doc_ids`` and ``sizes``: its documents and how many ids each has
* ``ranking``: the ids that occur in the block, most frequent first, as 32-bit integers
* ``control`` and ``data``: the rank of every id in one to four bytes of ``data``. How many is in
  two bits of ``control``, four ids to a byte, the first in the lowest bits

So the most frequent 256 ids of a block take a byte and two bits. Ranks, control and data of a
block need nothing outside it: blocks are written in one pass and read side by side. ``part`` is the
task that wrote a block, ``block`` its number there, and ``before`` the ids ahead of it there. Decoding
looks up the four sizes of each control byte in a table and gathers the bytes with numpy.

Blocks are the rows of Parquet files that Spark writes, so that a lost executor's files are
written again and a file is seen whole or not at all, in any store that Spark reaches.

Documents are ordered by id, null ids first; equal ids by their text. A null text counts as empty:
it has the end id alone. Repeated rows are all written. An empty table gives no block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotally.llm.tokens import id_encoder
from chronotally.llm.words import slices

BLOCK = 1 << 20
_SHIFTS = np.arange(0, 8, 2, dtype=np.uint8)
#: Sizes in bytes of the four ids of each control byte.
_SIZES = ((np.arange(256)[:, None] >> _SHIFTS) & 3) + 1


def encode_ids(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """``ranking``, ``control`` and ``data`` of ids below 2**32."""
    if len(ids) and int(ids.max()) < 1 << 22:
        counts = np.bincount(ids)
        known = np.flatnonzero(counts)
        ranking = known[np.argsort(-counts[known], kind="stable")]
        rank_of = np.zeros(len(counts), np.uint32)
        rank_of[ranking] = np.arange(len(ranking), dtype=np.uint32)
        ranks = rank_of[ids]
    else:
        known, place, counts = np.unique(ids, return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        ranking = known[order]
        ranks = np.argsort(order)[place].astype(np.uint32)
    more = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    four = np.zeros((len(more) + 3) // 4 * 4, np.uint8)
    four[: len(more)] = more
    control = (four.reshape(-1, 4) << _SHIFTS).sum(1).astype(np.uint8)
    used = np.arange(4) <= more[:, None]
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[used]
    return ranking.astype("<u4").tobytes(), control.tobytes(), data.tobytes()


def decode_ids(ranking: bytes, control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ids that :func:`encode_ids` was given."""
    sizes = _SIZES[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    begins = np.cumsum(sizes) - sizes
    raw = np.frombuffer(data, np.uint8)
    ranks = np.zeros(n, np.uint32)
    for k in range(int(sizes.max(initial=0))):
        has = np.flatnonzero(sizes > k)
        ranks[has] |= raw[begins[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return np.frombuffer(ranking, "<u4")[ranks]


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    block: int = BLOCK,
) -> None:
    """Encode every text, append ``end_id``, and write the files to ``path``."""
    kind = docs.schema[doc_id].dataType
    schema = T.StructType.fromDDL(
        "part int, block int, before bigint, n_tokens bigint, sizes array<int>, ranking binary, control binary, data binary"
    ).add("doc_ids", T.ArrayType(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, end = id_encoder(tokenizer), TaskContext.get().partitionId(), np.array([end_id], "<u4")
        names, found, waiting, number, before, id_type = [], [], 0, 0, 0, None

        def full() -> pa.RecordBatch:
            sizes = [len(x) for x in found]
            ranking, control, data = encode_ids(np.concatenate(found))
            columns = {
                "part": pa.array([part], pa.int32()),
                "block": pa.array([number], pa.int32()),
                "before": pa.array([before], pa.int64()),
                "n_tokens": pa.array([sum(sizes)], pa.int64()),
                "sizes": pa.array([sizes], pa.list_(pa.int32())),
                "ranking": pa.array([ranking]),
                "control": pa.array([control]),
                "data": pa.array([data]),
                "doc_ids": pa.array([names], pa.list_(id_type)),
            }
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            id_type = batch.schema.field(doc_id).type
            for some in slices(batch, text):
                for name, ids in zip(some.column(doc_id).to_pylist(), encode(some.column(text))):
                    ids = np.concatenate((ids, end))
                    if waiting and waiting + len(ids) > block:
                        yield full()
                        before += waiting
                        names, found, waiting, number = [], [], 0, number + 1
                    names.append(name)
                    found.append(ids)
                    waiting += len(ids)
        if found:
            yield full()

    # A third of all rows under one id are still dealt to many tasks, by their texts.
    tie = F.xxhash64(text)
    ordered = docs.select(doc_id, text, tie.alias("tie")).repartitionByRange(doc_id, "tie")
    ordered.sortWithinPartitions(doc_id, "tie", text).drop("tie").mapInArrow(run, schema).write.parquet(path)


def _before_parts(files: DataFrame) -> dict[int, int]:
    """Ids before each part: one number for each task that wrote blocks."""
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    sums = np.cumsum([0, *(row.n for row in totals)])
    return {row.part: int(n) for row, n in zip(totals, sums)}


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of the files at ``path``: ``doc_id, start, n_tokens, ids_crc32`` and, if wanted,
    ``ids``. ``start`` counts the ids of all documents before; the checksum is that of the ids as
    little-endian unsigned 32-bit integers."""
    files = spark.read.parquet(path)
    before = _before_parts(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                sizes = np.array(row["sizes"].values, np.int64)
                ends = np.cumsum(sizes)
                found = decode_ids(*(row[c].as_py() for c in ("ranking", "control", "data")), int(ends[-1]))
                begins = ends - sizes
                start = before[row["part"].as_py()] + row["before"].as_py()
                sums = [zlib.crc32(found[a:b].astype("<u4").tobytes()) for a, b in zip(begins, ends)]
                columns = {
                    "doc_id": row["doc_ids"].values,
                    "start": pa.array(start + begins),
                    "n_tokens": pa.array(sizes),
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
                if with_ids:
                    offsets = pa.array([0, *ends], pa.int32())
                    columns["ids"] = pa.ListArray.from_arrays(offsets, pa.array(found.astype(np.int64)))
                yield pa.RecordBatch.from_pydict(columns)

    schema = T.StructType.fromDDL("start bigint, n_tokens bigint, ids_crc32 bigint")
    first = T.StructField("doc_id", files.schema["doc_ids"].dataType.elementType)
    schema = T.StructType([first, *schema.fields])
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.LongType()))
    return files.drop("block", "n_tokens").mapInArrow(run, schema)
