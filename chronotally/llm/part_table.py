"""Ids of texts from a table of their parts, looked up for a whole slice of texts at once with numpy.

A byte-level vocabulary never joins a character that is not white space with white space after it, so
texts are cut wherever white space begins, and the ids of a text are those of its parts. Where the pattern
of the vocabulary sets letters apart, they are cut behind letters too, so that a word is one part whatever
sign follows it. Parts repeat a great deal. Each distinct one is encoded once; of a slice of texts all parts are looked up together, by
their bytes: a part of at most 23 bytes is three 64-bit numbers, the last of which holds its size as
well, and only an entry with the same three numbers is a hit. Longer parts go by a dictionary.

The table has a bound. When it is full it starts anew, which changes the speed and never the ids. Bytes that
are not UTF-8 are encoded as U+FFFD.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

_SHORT = 23
_REMEMBERED = 256
# So many parts are looked up at once, however long a text is.
_BLOCK = 1 << 16
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
# Odd multipliers; any would do.
_SPREAD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
# Bytes after which white space does not begin: white space itself, and what some call so.
_BEFORE = _WHITE.copy()
_BEFORE[[28, 29, 30, 31]] = True


def _wide_white(data: np.ndarray) -> np.ndarray:
    """Places of the last bytes of white space of more than one byte."""
    two = np.flatnonzero(data[:-1] == 0xC2) + 1
    two = two[np.isin(data[two], (0x85, 0xA0))]
    lead = np.flatnonzero((data[:-2] >= 0xE1) & (data[:-2] <= 0xE3)) if len(data) > 2 else two[:0]
    a, b, c = (data[lead + k] for k in range(3)) if len(lead) else (two[:0],) * 3
    general = (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F)
    three = (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE2) & general | (a == 0xE3) & (b == 0x80) & (c == 0x80)
    return np.concatenate((two, lead[three] + 2)) if len(lead) else two


_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True
#: Bytes that are a sign or digit of one byte, before which a pattern that sets letters apart ends a run of them.
SIGNS = ~_LETTERS & ~_BEFORE
SIGNS[128:] = False
NOWHERE = np.zeros(256, bool)


def _behind_letters(data: np.ndarray) -> np.ndarray:
    """For each byte but the first: whether a letter ends before it, of ASCII or of U+00C0 to U+017F."""
    behind = _LETTERS[data[:-1]]
    lead = np.flatnonzero((data[:-2] >= 0xC3) & (data[:-2] <= 0xC5)) if len(data) > 2 else data[:0]
    if len(lead):
        # \u00d7 and \u00f7 are signs.
        behind[lead + 1] = (data[lead + 1] >= 0x80) & ((data[lead] > 0xC3) | ((data[lead + 1] & 0xDF) != 0x97))
    return behind


def part_starts(data: np.ndarray, offsets: np.ndarray, signs: np.ndarray = NOWHERE) -> np.ndarray:
    """Where the parts of texts begin. ``offsets`` are the texts' beginnings in ``data`` and the last end,
    ``signs`` the bytes before which a text may be cut behind a letter."""
    before = _BEFORE[data]
    if (data >= 0xC2).any():
        before[_wide_white(data)] = True
    cut = _WHITE[data]
    cut[1:] &= ~before[:-1]
    if signs.any():
        cut[1:] |= signs[data[1:]] & _behind_letters(data)
    cut[:1] = False
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(cut)


class PartTable:
    """Ids of parts by ``encode``, which takes a list of parts and gives ids as unsigned 32-bit integers,
    and where in them those of each part begin and how many they are. ``signs``: see :func:`part_starts`."""

    def __init__(
        self,
        encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]],
        most: int = 1 << 20,
        signs: np.ndarray = NOWHERE,
    ):
        self.encode, self.most, self.signs = encode, most, signs
        self.bits = np.uint64(64 - max(4, (2 * most - 1).bit_length()))
        self.clear()

    def clear(self) -> None:
        self.slots = np.full(1 << int(64 - self.bits), -1, np.int32)
        self.keys = [np.zeros(1024, np.uint64) for _ in range(3)]
        self.begins, self.counts = np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        self.pool, self.used, self.n = np.zeros(4096, np.uint32), 0, 0
        self.long: dict[bytes, int] = {}

    @staticmethod
    def _room(array: np.ndarray, n: int) -> np.ndarray:
        return array if n <= len(array) else np.concatenate((array, np.zeros(max(n, 2 * len(array)) - len(array), array.dtype)))

    def _add(self, parts: list[bytes]) -> np.ndarray:
        """New entries for parts."""
        ids, begins, counts = self.encode(parts)
        to = self.n + len(parts)
        self.begins, self.counts = self._room(self.begins, to), self._room(self.counts, to)
        self.counts[self.n : to] = counts
        self.begins[self.n : to] = self.used + begins
        self.pool = self._room(self.pool, self.used + len(ids))
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.n = to
        return np.arange(to - len(parts), to, dtype=np.int64)

    def _short(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Entries of parts of at most 23 bytes."""
        padded = np.concatenate((data, np.zeros(32, np.uint8)))
        eight = np.ndarray(len(data) + 24, "<u8", padded, strides=(1,))
        keys = [eight[starts + 8 * k] & _MASKS[np.clip(sizes - 8 * k, 0, 8)] for k in range(3)]
        keys[2] |= sizes.astype(np.uint64) << np.uint64(56)
        code = keys[0] * _SPREAD[0] ^ keys[1] * _SPREAD[1] ^ keys[2] * _SPREAD[2]
        code ^= code >> np.uint64(32)
        code *= _SPREAD[3]
        places = [(code >> self.bits).astype(np.int64), (code * _SPREAD[0] >> self.bits).astype(np.int64)]

        entry = self.slots[places[0]].astype(np.int64)
        miss = np.flatnonzero(~self._equal(keys, entry))
        entry[miss] = self.slots[places[1][miss]]
        miss = miss[~self._equal([k[miss] for k in keys], entry[miss])]
        if len(miss):
            codes, first, which = np.unique(code[miss], return_index=True, return_inverse=True)
            heads = miss[first]
            new = self._add([data[a : a + n].tobytes() for a, n in zip(starts[heads].tolist(), sizes[heads].tolist())])
            for k in range(3):
                self.keys[k] = self._room(self.keys[k], self.n)
                self.keys[k][new] = keys[k][heads]
            free = self.slots[places[0][heads]] < 0
            self.slots[places[0][heads[free]]] = new[free]
            self.slots[places[1][heads[~free]]] = new[~free]
            entry[miss] = new[which]
            # Parts with one code and other bytes.
            for i in miss[~self._equal([k[miss] for k in keys], entry[miss])].tolist():
                entry[i] = self._long(data[starts[i] : starts[i] + sizes[i]].tobytes())
        return entry

    def _equal(self, keys: list[np.ndarray], entry: np.ndarray) -> np.ndarray:
        same = entry >= 0
        for mine, theirs in zip(keys, self.keys):
            same &= theirs[entry] == mine
        return same

    def _long(self, part: bytes) -> int:
        entry = self.long.get(part)
        if entry is None:
            entry = int(self._add([part])[0])
            for k in range(3):  # no short part has these numbers
                self.keys[k] = self._room(self.keys[k], self.n)
                self.keys[k][entry] = 0
            if len(part) <= _REMEMBERED:
                self.long[part] = entry
        return entry

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where those of each text end."""
        if self.n > self.most or self.used > 16 * self.most:
            self.clear()
        starts = part_starts(data, offsets, self.signs)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        found, counts = [], np.zeros(len(starts) + 1, np.int64)
        for at in range(0, len(starts), _BLOCK):
            to = min(at + _BLOCK, len(starts))
            base, end = int(starts[at]), int(ends[to - 1])
            ids, n = self._block(data[base:end], starts[at:to] - base, ends[at:to] - starts[at:to])
            found.append(ids)
            counts[at + 1 : to + 1] = n
        whole = np.concatenate(found) if found else np.zeros(0, np.uint32)
        return whole, np.cumsum(counts)[np.searchsorted(starts, offsets[1:])]

    def _block(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of parts that stand side by side, and how many each has."""
        entry = np.zeros(len(starts), np.int64)
        short = sizes <= _SHORT
        if short.any():
            at = np.flatnonzero(short)
            entry[at] = self._short(data, starts[at], sizes[at])
        for i in np.flatnonzero(~short).tolist():
            entry[i] = self._long(data[starts[i] : starts[i] + sizes[i]].tobytes())
        counts = self.counts[entry].astype(np.int64)
        ends = np.cumsum(counts)
        return self.pool[np.repeat(self.begins[entry] - (ends - counts), counts) + np.arange(int(ends[-1]))], counts
