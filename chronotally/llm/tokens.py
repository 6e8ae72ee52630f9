"""Token ids of whole texts by the tokenizers library, each distinct stretch of text encoded once.

A byte-level vocabulary never joins a character that is not white space with white space after
it, so a text may be cut before every blank that follows such a character, and its ids are those
of the parts, one after the other. Parts repeat a great deal; each distinct part goes to the
library once and its ids are remembered. Texts in which white space stands side by side are cut
only at the start of each run of it. The memory has a bound: when full it starts anew, which
changes the speed and never the ids.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa

from chronotally.llm.part_table import NOWHERE, SIGNS, PartTable
from chronotally.llm.words import text_bytes

_MOST = 800_000
_LONGEST = 64
# So many parts are joined for one call of the library; with longer calls it takes more time a part.
_JOINED = 512


def _ends_white(part: bytes) -> bool:
    return part.decode("utf-8", "replace")[-1].isspace()


class Memo:
    """Values of distinct parts, from a function that gives those of a list of parts. What was
    needed since the memory was last half full stays, the rest is forgotten."""

    def __init__(self, encode: Callable[[list[str]], Iterable], most: int = _MOST):
        self.encode, self.most, self.known, self.before = encode, most, {}, {}

    def take(self, lists: list[list[str]]) -> list[list]:
        """The values of each list of parts. Long parts are encoded and not remembered."""
        need = set().union(*lists).difference(self.known) if lists else set()
        if len(self.known) + len(need) > self.most // 2:
            self.before, self.known = self.known, {}
            need = set().union(*lists)
        again = need.intersection(self.before)
        self.known.update(zip(again, map(self.before.__getitem__, again)))
        new = list(need.difference(again))
        self.known.update(zip(new, self.encode(new)))
        get = self.known.__getitem__
        out = [[*map(get, one)] for one in lists]
        for part in new:
            if len(part) > _LONGEST:
                del self.known[part]
        return out


class Library:
    """A tokenizer file of the library, used as it comes: strings of special tokens are those tokens."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        #: Bytes of each token; a byte is one character of its name.
        self.sizes = np.array([*map(len, names)], np.int64)
        #: Tokens behind which a sentence or a line ends. "\u010a" stands for a line feed.
        self.ends_sentence = np.array([n[-1:] in (".", "!", "?") or "\u010a" in n for n in names])
        #: Bytes before which a text may be cut behind a letter.
        self.signs = self._signs()

    def _signs(self) -> np.ndarray:
        """None where the file's own pattern is not known to set letters apart; not those inside a special token."""
        form = json.loads(self.tokenizer.to_str())
        split = form["pre_tokenizer"] or {}
        apart = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        if not apart or form["normalizer"] or any(token["single_word"] for token in form["added_tokens"]):
            return NOWHERE
        signs = SIGNS.copy()
        for token in form["added_tokens"]:
            inside = token["content"]
            signs[[ord(b) for a, b in zip(inside, inside[1:]) if a.isalpha() and b.isascii()]] = False
        return signs

    def _ids(self, parts: list[bytes]) -> list[np.ndarray]:
        texts = [part.decode("utf-8", "replace") for part in parts]
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_parts(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where those of each part begin in them and how many they are. Parts that begin with a blank
        and end in something else are encoded joined, and their ids told apart by the bytes of the tokens."""
        joined, rest, found, used = [], [], [], 0
        for i, part in enumerate(new):
            last = part[-1]
            (joined if part[0] == 32 and (32 < last < 127 or last > 127 and not _ends_white(part)) else rest).append(i)
        begins, counts = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        for at in range(0, len(joined), _JOINED):
            some = joined[at : at + _JOINED]
            these = [new[i] for i in some]
            ids = self._ids([b"".join(these)])[0]
            ends = np.cumsum(self.sizes[ids])
            want = np.cumsum([*map(len, these)])
            cut = np.searchsorted(ends, want)
            if len(ends) != cut[-1] + 1 or (ends[cut] != want).any():
                rest += some
                continue
            counts[some] = np.diff(cut, prepend=-1)
            begins[some] = used + np.concatenate(([0], cut[:-1] + 1))
            found.append(ids)
            used += len(ids)
        for at in range(0, len(rest), 1024):
            some = rest[at : at + 1024]
            for i, ids in zip(some, self._ids([new[i] for i in some])):
                begins[i], counts[i] = used, len(ids)
                found.append(ids)
                used += len(ids)
        return np.concatenate(found) if found else np.zeros(0, np.uint32), begins, counts


@lru_cache(2)
def library(path: str) -> Library:
    return Library(path)


@lru_cache(2)  # a Python worker goes on with what it knows in its next task
def id_encoder(path: str, **options) -> Callable[[pa.Array], list[np.ndarray]]:
    """A function from a column of texts (null: empty) to their ids, as unsigned 32-bit arrays."""
    table = PartTable(library(path).encode_parts, signs=library(path).signs, **options)

    def ids(texts: pa.Array) -> list[np.ndarray]:
        found, ends = table.ids(*text_bytes(texts))
        return np.split(found, ends[:-1]) if len(texts) else []

    return ids
