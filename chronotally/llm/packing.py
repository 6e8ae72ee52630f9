"""Packing in order: documents, one behind the other, are cut into sequences of bounded length.

The documents of a task are one stream of ids, in their order. A sequence is a stretch of it. Cuts
may stand behind a document (free) or behind a sentence or line (``sentence_cut`` ids' worth of
padding); and inside a sentence (``forced_cut``) a whole sequence behind another place, where no
better one is as near as that is worth, and at whole sequences before the end of a longer gap. Among all such cuts, those with the least padding plus
penalties are found by dynamic programming. As the padding of a sequence is a constant less its
length, the best last cut before each place is the least of a sliding window, kept in a queue that
only rises; sequences of half or a quarter of the full length need no padding and are looked up.

The stream is worked on in stretches of about a million ids that end with a document, which bounds
the memory (a longer document is a stretch of its own) and costs at most one short sequence each.
Nothing is shuffled: rows keep the tasks they are read in. ``sequence_id`` has the number of the
task in its upper bits and is unique; gaps in it mean nothing.

A null text counts as empty, and its document is the end id alone. Null ids and repeated rows are
packed as any others: each row is a document. An empty table gives no piece.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chronotally.llm.tokens import id_encoder, library
from chronotally.llm.words import slices

STRETCH = 1 << 20


def padding(length: int, size: int) -> int:
    """Padding of a sequence: up to ``size``, but for powers of two."""
    return 0 if length & (length - 1) == 0 else size - length


def candidates(sizes: np.ndarray, sentence_ends: np.ndarray, size: int, sentence_cut: float, forced_cut: float):
    """Places where a cut may stand, in order, and the penalty of each. ``sizes`` are those of the
    documents, ``sentence_ends`` places in the stream behind which a sentence ends."""
    documents = np.cumsum(sizes)
    total = int(documents[-1])
    # The penalty of a cut at each place of the stream, less than 0 where none may stand.
    cost = np.full(total + 1, -1.0)
    cost[sentence_ends] = sentence_cut
    cost[0] = 0
    cost[documents] = 0
    places = np.flatnonzero(cost >= 0)
    # Whole sequences before each gap, and from each place on where nothing else is near.
    wide = np.flatnonzero(np.diff(places) > size)
    more = [np.arange(b - size, a, -size) for a, b in zip(places[wide].tolist(), places[wide + 1].tolist())]
    front = np.concatenate((places, *more))
    cost[front[len(places) :]] = forced_cut
    while len(front):
        front = front + size
        front = front[front < total]
        front = front[cost[front] < 0]
        front = front[front - places[np.searchsorted(places, front, "right") - 1] > forced_cut]
        cost[front] = forced_cut
    places = np.flatnonzero(cost >= 0)
    return places, cost[places]


def best_cuts(places: np.ndarray, costs: np.ndarray, size: int, short: float) -> list[int]:
    """The cuts, from 0 to the end, with the least sum of padding and penalties, ``short`` being that
    of a sequence of half or a quarter of ``size``. Neighbouring places are at most ``size`` apart; ``size`` is a power of two for the lookups to be of use."""
    least, came_from, key = [0.0] * len(places), [0] * len(places), [0.0] * len(places)
    window: deque[int] = deque([0])  # of places, with rising values of least + place
    at = places.tolist()
    first = np.searchsorted(places, places - size).tolist()  # the first place that is near enough
    unpadded = []
    for length in (size // 2, size // 4):
        j = np.searchsorted(places, places - length)
        unpadded.append(np.where(places[j] == places - length, j, -1))
    some = ((unpadded[0] >= 0) | (unpadded[1] >= 0)).tolist()
    half, quarter = unpadded[0].tolist(), unpadded[1].tolist()
    steps = zip(range(len(at)), at, costs.tolist(), first, some)
    next(steps)
    for i, here, cost, nearest, looked_up in steps:
        while window[0] < nearest:
            window.popleft()
        best = window[0]
        value = key[best] + size - here
        if looked_up:
            for j in (half[i], quarter[i]):
                if j >= 0 and least[j] + short < value:
                    best, value = j, least[j] + short
        value += cost
        least[i], came_from[i] = value, best
        mine = key[i] = value + here
        while window and key[window[-1]] >= mine:
            window.pop()
        window.append(i)
    cuts, i = [at[-1]], len(at) - 1
    while i:
        i = came_from[i]
        cuts.append(at[i])
    return cuts[::-1]


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    size: int = 1024,
    sentence_cut: float = 4,
    forced_cut: float = 16,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """One row for each piece of a document in a sequence: ``doc_id, start`` (ids of the document
    before it), ``length, ids_crc32, doc_tokens, sequence_id, offset`` (in the sequence, without
    gaps) and, if wanted, its ``ids``."""
    kind = docs.schema[doc_id].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, ends_sentence = id_encoder(tokenizer), library(tokenizer).ends_sentence
        end = np.array([end_id], "<u4")
        names, found, waiting = [], [], 0
        sequence = TaskContext.get().partitionId() << 40
        id_type = None

        def packed() -> pa.RecordBatch:
            nonlocal sequence
            ids = np.concatenate(found)
            sizes = np.array([*map(len, found)], np.int64)
            marks = np.flatnonzero(ends_sentence[np.minimum(ids, len(ends_sentence) - 1)]) + 1
            cuts = np.array(best_cuts(*candidates(sizes, marks, size, sentence_cut, forced_cut), size, sentence_cut))
            begins = np.cumsum(sizes) - sizes
            # A piece begins where a sequence or a document does.
            places = np.union1d(cuts[:-1], begins)
            ends = np.append(places[1:], len(ids))
            doc = np.searchsorted(begins, places, "right") - 1
            of = np.searchsorted(cuts, places, "right") - 1
            sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(places.tolist(), ends.tolist())]
            columns = {
                "doc_id": pa.array(names, id_type).take(pa.array(doc)),
                "start": pa.array(places - begins[doc]),
                "length": pa.array(ends - places),
                "ids_crc32": pa.array(sums, pa.int64()),
                "doc_tokens": pa.array(sizes[doc]),
                "sequence_id": pa.array(sequence + of),
                "offset": pa.array(places - cuts[of]),
            }
            if with_ids:
                offsets = pa.array(np.append(places, len(ids)).astype(np.int32))
                columns["ids"] = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
            sequence += len(cuts) - 1
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            id_type = batch.schema.field(doc_id).type
            for some in slices(batch, text):
                for name, ids in zip(some.column(doc_id).to_pylist(), encode(some.column(text))):
                    if waiting and waiting + len(ids) >= STRETCH:
                        yield packed()
                        names, found, waiting = [], [], 0
                    names.append(name)
                    found.append(np.concatenate((ids, end)))
                    waiting += len(ids) + 1
        if found:
            yield packed()

    schema = T.StructType([T.StructField("doc_id", kind)])
    for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"):
        schema = schema.add(name, T.LongType())
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    return docs.select(doc_id, text).mapInArrow(run, schema)
