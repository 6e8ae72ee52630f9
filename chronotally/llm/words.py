"""Words, lines and their 64-bit codes for whole Arrow batches of texts, with numpy.

A batch is read as one stream of UTF-8 bytes. The code of a span of bytes is a polynomial in an
odd base modulo 2**64, taken from running sums, so that words, lines, shingles and lines without
one of their words are coded without a Python step for each. Bytes are taken in pieces that end
at white space, which bounds the memory by the piece, or by the longest word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_PIECE = 1 << 20
_SLICE = 1 << 20
# Odd multipliers; any would do.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = np.uint64(0xD1342543DE82EF95)

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread a code over all 64 bits (the finishing steps of a public 64-bit mixer)."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_INVERSE = {int(b): np.uint64(pow(int(b), -1, 1 << 64)) for b in (_BASE, _WORD_BASE)}


@dataclass
class Running:
    """Running polynomial sums of ``values`` (uint64), to code any span of them."""

    sums: np.ndarray
    powers: np.ndarray
    back: np.ndarray

    @staticmethod
    def of(values: np.ndarray, base: np.uint64 = _WORD_BASE) -> Running:
        powers = _powers(base, len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values + np.uint64(1)) * powers[:-1], out=sums[1:])
        return Running(sums, powers, _powers(_INVERSE[int(base)], len(values) + 1))

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The code of values[start:end], wherever it stands."""
        return (self.sums[end] - self.sums[start]) * self.back[start]

    def without(self, start: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The code of values[start:end] with the one at ``at`` taken out."""
        return self.span(start, at) + self.span(at + 1, end) * self.powers[at - start]


@dataclass
class Words:
    """The words of a slice of texts. ``first[i]:first[i + 1]`` are those of text i."""

    data: np.ndarray  # the bytes, lower-cased if asked
    offsets: np.ndarray  # where each text begins in them, and the end of the last
    starts: np.ndarray
    ends: np.ndarray
    codes: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        """How many of the marked bytes each text has."""
        total = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(marks, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets, with null as empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about 1 MB of text; a longer text is a slice of its own."""
    column = batch.column(text)
    if not len(column):
        return
    _, offsets = text_bytes(column)
    begin = 0
    while begin < len(column):
        end = int(np.searchsorted(offsets, offsets[begin] + _SLICE, "right")) - 1
        end = max(end, begin + 1)
        yield batch.slice(begin, end - begin)
        begin = end


def marks_of(data: np.ndarray, offsets: np.ndarray, white: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of bytes that are not ``white`` start and end; none goes beyond a text."""
    black = ~white[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.concatenate(([False], black[:-1])) & ~cut[:-1]
    after = np.concatenate((black[1:], [False])) & ~cut[1:]
    return np.flatnonzero(black & ~before), np.flatnonzero(black & ~after) + 1


def _span_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Codes of spans that do not overlap and stand in order."""
    codes = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(int(np.searchsorted(ends, starts[at] + _PIECE, "right")), at + 1)
        begin, end = int(starts[at]), int(ends[to - 1])
        run = Running.of(data[begin:end].astype(np.uint64), _BASE)
        codes[at:to] = run.span(starts[at:to] - begin, ends[at:to] - begin)
        at = to
    return mix(codes, seed)


def words_of(column: pa.Array, lower: bool = False, white: np.ndarray = _WHITE, seed: int = 0) -> Words:
    """Words of all texts: runs of bytes other than blank, tab, LF, VT, FF and CR."""
    data, offsets = text_bytes(column)
    if lower:
        data = _LOWER[data]
    starts, ends = marks_of(data, offsets, white)
    return Words(data, offsets, starts, ends, _span_codes(data, starts, ends, seed), np.searchsorted(starts, offsets))


def prefix_codes(words: Words, size: int, seed: int) -> np.ndarray:
    """Codes of the first ``size`` bytes of each word, or the whole word if shorter."""
    return _span_codes(words.data, words.starts, np.minimum(words.ends, words.starts + size), seed)


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the lines (split at LF) of all texts, and the first line of each text.
    A text of no bytes has one empty line."""
    breaks = np.flatnonzero(data == 10)
    texts = np.arange(len(offsets) - 1)
    of_break = np.searchsorted(offsets, breaks, "right") - 1
    starts = np.concatenate((offsets[:-1], breaks + 1))
    ends = np.concatenate((breaks, offsets[1:]))
    by_start = np.lexsort((starts, np.concatenate((texts, of_break))))
    by_end = np.lexsort((ends, np.concatenate((of_break, texts))))
    counts = np.bincount(of_break, minlength=len(texts)) + 1 if len(texts) else np.zeros(0, np.int64)
    return starts[by_start], ends[by_end], np.concatenate(([0], np.cumsum(counts)))


def line_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Codes of whole lines as they stand."""
    return _span_codes(data, starts, ends, seed)


def windows(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of ``size`` words that lie in one text, and the text of each."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[:-1][text] + within, text
