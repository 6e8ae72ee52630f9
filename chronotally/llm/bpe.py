"""Byte-level BPE as a transducer over bytes, and decoding as a stream.

**Encoding.** A sequence of tokens is what the merges give exactly if each two neighbours are what
the merges give for their joined bytes. So a text can be read byte by byte by a machine that
follows, for each place where the last token may have begun, the tokens before it and the node of
the token trie reached since. A token is complete where the trie has one and it may follow the one
before. The places alive together, with the tokens not yet agreed on, are one state of a
deterministic machine; states and their steps are made when a text first needs them and kept, up
to a bound.
As soon as all places agree on a token it is emitted; a place lives no longer than the longest
token, which bounds the lookahead. The work is linear in the text, for one word of a megabyte too.
Short stretches that need a state beyond the bound go on with their places as they are, all such
stretches of a slice of texts side by side, a byte at a time.

**Decoding.** Each token moves a UTF-8 state machine. Text is given out up to the last token that
ends between characters; the bytes behind it wait for the next ids. Bytes that are not UTF-8
become U+FFFD.

Bytes of a text that are not UTF-8 are encoded as U+FFFD.

A null text counts as empty: no ids, and nothing decoded. Rows are coded one by one, so repeated
rows, null ids, and empty tables need no rule of their own; an input column named like a result is
replaced.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from chronotally.llm.part_table import NOWHERE, SIGNS, PartTable
from chronotally.llm.tables import appended, extended, without
from chronotally.llm.words import slices, text_bytes

MOST_STATES = 20_000
#: A pattern that sets letters apart from all that follows them.
LETTERS_APART = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Stretches with no more bytes to go than that are moved side by side.
_SIDE_BY_SIDE = 256
# Odd multipliers; any would do.
_SPREAD = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)]
_EMPTY = np.uint64(2**64 - 1)


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Pairs:
    """Whether one token may stand before another: whether their bytes, joined, give both again.

    The merges inside either token go on as if it were alone until one takes a part of the left
    token's right edge together with a part of the right token's left edge. The parts along such
    an edge, and the rank of the merge that takes each in, come from the merges of the token."""

    def __init__(self, ranks: dict[bytes, int], most: int = 2_000_000):
        self.ranks, self.most = ranks, most
        self.token = {rank: token for token, rank in ranks.items()}
        self.edges: dict[tuple[int, bool], list[tuple[bytes, float]]] = {}
        self.known: dict[tuple[int, int], bool] = {}
        # Answers for arrays of pairs, two places for each pair: its tokens, and the answer in the last bit.
        self.bits = np.uint64(64 - max(4, (2 * most - 1).bit_length()))
        self.slots = np.full(1 << int(64 - self.bits), _EMPTY)

    def _halves(self, token: bytes) -> tuple[bytes, bytes]:
        """The two parts that the last merge of a token joins."""
        out = [token[i : i + 1] for i in range(len(token))]
        while len(out) > 2:
            pairs = [self.ranks.get(a + b, len(self.ranks)) for a, b in zip(out, out[1:])]
            at = pairs.index(min(pairs))
            out[at : at + 2] = [out[at] + out[at + 1]]
        return out[0], out[1]

    def _edge(self, rank: int, right: bool) -> list[tuple[bytes, float]]:
        """Parts along one edge from the single byte up, with the rank at which each is taken in."""
        edge = self.edges.get((rank, right))
        if edge is None:
            part, taken, edge = self.token[rank], float("inf"), []
            while True:
                edge.append((part, taken))
                if len(part) == 1:
                    break
                taken = self.ranks[part]
                part = self._halves(part)[right]
            edge.reverse()
            self.edges[rank, right] = edge
        return edge

    def allowed(self, before: int, token: int) -> bool:
        known = self.known.get((before, token))
        if known is None:
            if len(self.known) > self.most:
                self.known.clear()
            known = self.known[before, token] = self._allowed(before, token)
        return known

    def allowed_all(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """The same for arrays of tokens. A pair that has lost its place is looked at again."""
        pairs = before.astype(np.uint64) << np.uint64(31) | token.astype(np.uint64)
        code = pairs * _SPREAD[0]
        code ^= code >> np.uint64(32)
        places = [code * _SPREAD[1] >> self.bits, code * _SPREAD[0] >> self.bits]
        found = self.slots[places[0]]
        miss = np.flatnonzero(found >> np.uint64(1) != pairs)
        found[miss] = self.slots[places[1][miss]]
        miss = miss[found[miss] >> np.uint64(1) != pairs[miss]]
        if len(miss):
            _, first, which = np.unique(pairs[miss], return_index=True, return_inverse=True)
            heads = miss[first]
            may = np.array([*map(self._allowed, before[heads].tolist(), token[heads].tolist())], np.uint64)
            new = pairs[heads] << np.uint64(1) | may
            free = self.slots[places[0][heads]] == _EMPTY
            self.slots[places[0][heads[free]]] = new[free]
            self.slots[places[1][heads[~free]]] = new[~free]
            found[miss] = new[which]
        return found & np.uint64(1) == 1

    def _allowed(self, before: int, token: int) -> bool:
        left, right, i, k = self._edge(before, True), self._edge(token, False), 0, 0
        while True:
            (a, a_taken), (b, b_taken) = left[i], right[k]
            across = self.ranks.get(a + b)
            # Of equal ranks the leftmost merge comes first.
            if across is not None and across < a_taken and across <= b_taken:
                return False
            if i == len(left) - 1 and k == len(right) - 1:
                return True
            if a_taken <= b_taken:
                i += 1
            else:
                k += 1


class Transducer:
    """The machine of a rank table. ``encode`` gives the ids of one stretch of bytes, ``encode_all`` those of many.

    A place is the tokens not yet emitted and a trie node. Up to ``most_states`` states are made;
    from there on a stretch that needs a new step goes on with its places as they are, to its end.
    """

    def __init__(self, ranks: dict[bytes, int], most_states: int = MOST_STATES):
        self.most_states = most_states
        self.pairs = Pairs(ranks)
        # The trie: node 0 is its root; children by node * 256 + byte, and the token completed.
        self.children: dict[int, int] = {}
        self.complete: list[int | None] = [None]
        self.inner: list[bool] = [True]
        self.depth: list[int] = [0]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                self.inner[node] = True
                key = node << 8 | byte
                if key not in self.children:
                    self.children[key] = len(self.complete)
                    self.complete.append(None)
                    self.inner.append(False)
                    self.depth.append(self.depth[node] + 1)
                node = self.children[key]
            self.complete[node] = rank
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.steps: list[dict[int, tuple[int, tuple[int, ...]]]] = []
        self.spread: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
        self._state((None, (((), 0),)))

    def _state(self, state: tuple) -> int | None:
        number = self.number.get(state)
        if number is None and len(self.states) < self.most_states:
            number = self.number[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
        return number

    def _moved(self, emitted: int | None, places: Iterable[tuple], byte: int) -> list[tuple]:
        """The places after one more byte."""
        children, complete, inner, known, allowed = (
            self.children, self.complete, self.inner, self.pairs.known, self.pairs.allowed
        )
        moved = []
        for tokens, node in places:
            to = children.get(node << 8 | byte)
            if to is None:
                continue
            token = complete[to]
            if token is not None:
                before = tokens[-1] if tokens else emitted
                if before is None:
                    moved.append(((token,), 0))
                else:
                    may = known.get((before, token))
                    if may if may is not None else allowed(before, token):
                        moved.append(((*tokens, token), 0))
            if inner[to]:
                moved.append((tokens, to))
        return moved

    @staticmethod
    def _agreed(moved: list[tuple]) -> tuple[tuple[int, ...], list[tuple]]:
        """The tokens that all places have in common, and the places without them."""
        shortest = min((tokens for tokens, _ in moved), key=len)
        n = len(shortest)
        while n and any(tokens[:n] != shortest[:n] for tokens, _ in moved):
            n -= 1
        return shortest[:n], ([(tokens[n:], node) for tokens, node in moved] if n else moved)

    def _rest(self, emitted: int | None, places: Iterable[tuple], piece: bytes, ids: list[int]) -> list[int]:
        """Go on with places where no state can be made for them."""
        for k, byte in enumerate(piece):
            places = self._moved(emitted, places, byte)
            if k % 64 == 63:
                out, places = self._agreed(places)
                ids += out
                emitted = out[-1] if out else emitted
        ids += next(tokens for tokens, node in places if node == 0)
        return ids

    def _run(self, piece: bytes) -> tuple[list[int], int | None, int]:
        """The ids of a stretch. If it needs a step that is not to be made: those emitted until then, the state, and
        the bytes before."""
        ids: list[int] = []
        state, steps = 0, self.steps
        for k, byte in enumerate(piece):
            step = steps[state].get(byte)
            if step is None:
                if len(self.states) >= self.most_states:
                    return ids, state, k
                emitted, places = self.states[state]
                out, places = self._agreed(self._moved(emitted, places, byte))
                step = steps[state][byte] = self._state((out[-1] if out else emitted, tuple(places))), out
            state, out = step
            if out:
                ids += out
        ids += next(tokens for tokens, node in self.states[state][1] if node == 0)
        return ids, None, len(piece)

    def encode(self, piece: bytes) -> list[int]:
        ids, state, k = self._run(piece)
        return ids if state is None else self._rest(*self.states[state], piece[k:], ids)

    def encode_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all stretches, one after the other, and how many each has."""
        found, late = [], []
        for i, piece in enumerate(pieces):
            ids, state, k = self._run(piece)
            if state is not None:
                if len(piece) - k <= _SIDE_BY_SIDE:
                    late.append((i, state, k))
                else:
                    self._rest(*self.states[state], piece[k:], ids)
            found.append(ids)
        counts = np.array([*map(len, found)], np.int64)
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum()))
        if not late:
            return ids, counts
        which, states, ahead = map(np.array, zip(*late))
        more, more_counts = self._side_by_side([pieces[i] for i in which.tolist()], states.tolist(), ahead)
        ends = np.cumsum(counts)
        return np.insert(ids, np.repeat(ends[which], more_counts), more), counts + np.bincount(which, more_counts, len(pieces)).astype(np.int64)

    @cached_property
    def _trie(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The trie as arrays: the row of each node in the table of children, that table, the tokens, inner nodes."""
        inner = np.array(self.inner)
        rows = np.cumsum(inner) - 1
        table = np.zeros((int(inner.sum()), 256), np.int32)
        keys = np.fromiter(self.children, np.int64, len(self.children))
        table[rows[keys >> 8], keys & 255] = np.fromiter(self.children.values(), np.int32, len(keys))
        return rows, table, np.array([-1 if rank is None else rank for rank in self.complete], np.int32), inner

    def _spread(self, state: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The places of a state by how many bytes back they began, and their nodes; its tokens not emitted by how
        many bytes back they ended, and their bytes; and how many bytes back the last emitted token ended."""
        known = self.spread.get(state)
        if known is None:
            emitted, places = self.states[state]
            begins, trail, back = [], {}, 0
            for tokens, node in places:
                back = self.depth[node]
                begins.append((back, node))
                for token in reversed(tokens):
                    size = len(self.pairs.token[token])
                    trail[back] = token, size
                    back += size
            trail[back] = -1 if emitted is None else emitted, 0
            ended = np.array([(b, *t) for b, t in trail.items()], np.int64)
            known = self.spread[state] = np.array(begins, np.int64), ended, back
        return known

    def _side_by_side(self, pieces: list[bytes], states: list[int], ahead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Go on with the places of ``states`` behind the first ``ahead`` bytes of each stretch, all stretches together:
        the ids, one stretch after the other, and how many each has."""
        rows, children, complete, inner = self._trie
        data = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
        sizes = np.array([*map(len, pieces)], np.int64)
        end = np.cumsum(sizes + 1) - 1
        at = end - sizes + ahead
        # The token that ends at each place of the bytes, and its size. One at most ends there in a stretch.
        last, size = np.full(len(data), -1, np.int64), np.zeros(len(data), np.int64)
        begins, ended, back = zip(*map(self._spread, states))
        first = at - back
        of = np.repeat(np.arange(len(pieces)), [*map(len, ended)])
        behind, tokens, token_sizes = np.concatenate(ended).T
        last[at[of] - behind], size[at[of] - behind] = tokens, token_sizes
        of = np.repeat(np.arange(len(pieces)), [*map(len, begins)])
        behind, node = np.concatenate(begins).T
        begin = at[of] - behind
        while len(of):
            here = at[of]
            node = children[rows[node], data[here]]
            there = np.flatnonzero(node)
            of, begin, node, here = of[there], begin[there], node[there], here[there]
            token = complete[node]
            may = np.flatnonzero(token >= 0)
            before = last[begin[may]]
            some = np.flatnonzero(before >= 0)
            some = some[~self.pairs.allowed_all(before[some], token[may[some]])]
            may = np.delete(may, some)
            ends = here[may] + 1
            last[ends], size[ends] = token[may], ends - begin[may]
            on = np.flatnonzero(inner[node])
            of, begin = np.concatenate((of[on], of[may])), np.concatenate((begin[on], ends))
            node = np.concatenate((node[on], np.zeros(len(may), node.dtype)))
            at += 1
            left = np.flatnonzero(at[of] < end[of])
            of, begin, node = of[left], begin[left], node[left]
        counts, found, at, live = np.zeros(len(pieces), np.int64), [], end.copy(), np.arange(len(pieces))
        while len(live):
            here = at[live]
            if not size[here].all():
                raise ValueError("a byte has no rank")
            found.append((live, last[here]))
            counts[live] += 1
            at[live] -= size[here]
            live = live[at[live] > first[live]]
        ids, ends = np.zeros(int(counts.sum()), np.uint32), np.cumsum(counts)
        for k, (live, tokens) in enumerate(found):
            ids[ends[live] - 1 - k] = tokens
        return ids, counts


# The UTF-8 machine: 0 between characters, 1 to 3 bytes to come, 4 to 7 for leads whose next byte
# has narrower bounds (E0, ED, F0, F4), 8 where bytes are no UTF-8.
_BAD = 8


def _utf8_machine() -> np.ndarray:
    to = np.full((9, 256), _BAD, np.uint8)
    to[0, :0x80] = 0
    to[0, 0xC2:0xE0] = 1
    to[0, 0xE1:0xF0] = 2
    to[0, 0xF1:0xF4] = 3
    to[0, [0xE0, 0xED, 0xF0, 0xF4]] = [4, 5, 6, 7]
    for state in (1, 2, 3):
        to[state, 0x80:0xC0] = state - 1
    to[4, 0xA0:0xC0] = 1
    to[5, 0x80:0xA0] = 1
    to[6, 0x90:0xC0] = 2
    to[7, 0x80:0x90] = 2
    return to


class Decoder:
    """Bytes of ids, and their text as a stream."""

    def __init__(self, tokens: dict[int, bytes]):
        most = max(tokens, default=-1) + 1
        self.bytes = [tokens.get(i, b"") for i in range(most)]
        # The machine moved by whole tokens: byte by byte over all tokens at once.
        data = np.frombuffer(b"".join(self.bytes), np.uint8)
        sizes = np.array([*map(len, self.bytes)], np.int64)
        begins = np.cumsum(sizes) - sizes
        machine = _utf8_machine()
        self.moves = np.repeat(np.arange(9, dtype=np.uint8)[:, None], most, 1)
        for k in range(int(sizes.max(initial=0))):
            has = sizes > k
            self.moves[:, has] = machine[self.moves[:, has], data[begins[has] + k]]

    def whole(self, state: int, ids: np.ndarray) -> tuple[int, int]:
        """The machine's state behind ``ids``, and how many of them end between characters."""
        odd = np.flatnonzero(self.moves[0, ids])
        at, done = 0, 0
        while at < len(ids):
            if state in (0, _BAD):
                state = 0
                k = np.searchsorted(odd, at)
                if k == len(odd):
                    return 0, len(ids)
                at = int(odd[k])
                done = at
            state = int(self.moves[state, ids[at]])
            at += 1
            if state in (0, _BAD):
                done = at
        return (0 if state == _BAD else state), done

    def stream(self, chunks: Iterable[np.ndarray]) -> Iterator[str]:
        """Text as soon as its characters are complete, for ids that come in chunks."""
        state, waiting = 0, b""
        for ids in chunks:
            state, done = self.whole(state, ids)
            found = [*map(self.bytes.__getitem__, ids.tolist())]
            if done:
                yield (waiting + b"".join(found[:done])).decode(errors="replace")
                waiting = b""
            waiting += b"".join(found[done:])
        if waiting:
            yield waiting.decode(errors="replace")


@lru_cache(2)
def _machines(path: str) -> tuple[Transducer, Decoder]:
    ranks = read_ranks(path)
    return Transducer(ranks), Decoder({rank: token for token, rank in ranks.items()})


@lru_cache(2)  # a Python worker goes on with what it knows in its next task
def encoder(path: str, pattern: str, **options):
    """A function from a column of texts (null: empty) to their ids, as unsigned 32-bit arrays."""
    machine, _ = _machines(path)
    matches = regex.compile(pattern)
    apart = pattern == LETTERS_APART

    def encode(new: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        pieces, sizes = [], []
        for part in new:
            if apart and (part[1:] if part[0] == 32 else part).isalpha():  # a word in ASCII is one match
                pieces.append(part)
                sizes.append(1)
            else:
                found = matches.findall(part.decode("utf-8", "replace"))
                pieces += [one.encode() for one in found]
                sizes.append(len(found))
        ids, counts = machine.encode_all(pieces)
        ends = np.concatenate(([0], np.cumsum(counts)))[np.cumsum(sizes)]
        counts = np.diff(ends, prepend=0)
        return ids, ends - counts, counts

    table = PartTable(encode, signs=SIGNS if apart else NOWHERE, **options)

    def ids(texts: pa.Array) -> list[np.ndarray]:
        found, ends = table.ids(*text_bytes(texts))
        return np.split(found, ends[:-1]) if len(texts) else []

    return ids


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int), each match of ``pattern`` encoded on its own. The rank
    file must be at ``path`` on every executor. ``pattern`` must not join a character other than
    white space with white space behind it, as all patterns of byte-level vocabularies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern)
        for batch in batches:
            for part in slices(batch, text):
                found = encode(part.column(text))
                sizes = np.cumsum([0, *map(len, found)])
                flat = np.concatenate(found).astype(np.int32) if found else np.zeros(0, np.int32)
                yield appended(part, {"ids": pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat))})

    docs = without(docs, ["ids"])
    return docs.mapInArrow(run, extended(docs, {"ids": "array<int>"}))


def decode_documents(docs: DataFrame, path: str, ids: str = "ids", chunk: int = 1 << 16) -> DataFrame:
    """``docs`` with the ``decoded`` text of their ids (null ids: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _machines(path)
        for batch in batches:
            column = batch.column(ids)
            texts = []
            for row in column:
                one = np.array(row.values if row.is_valid else [], np.int64)
                texts.append("".join(decoder.stream(one[k : k + chunk] for k in range(0, len(one), chunk))))
            yield appended(batch, {"decoded": pa.array(texts, pa.string())})

    docs = without(docs, ["decoded"])
    return docs.mapInArrow(run, extended(docs, {"decoded": "string"}))


def round_trip_digests(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: the number of ids, a digest of them, and one of the bytes decoded from them.
    Ids and decoded text stay inside the task, stretch by stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, (_, decoder) = encoder(path, pattern), _machines(path)
        decimal = [str(i) for i in range(len(decoder.bytes))]
        for batch in batches:
            for part in slices(batch, text):
                rows = []
                for one in encode(part.column(text)):
                    shown = hashlib.sha256(" ".join(map(decimal.__getitem__, one.tolist())).encode())
                    back = hashlib.sha256()
                    for piece in decoder.stream(one[k : k + (1 << 16)] for k in range(0, len(one), 1 << 16)):
                        back.update(piece.encode())
                    rows.append((len(one), shown.hexdigest(), back.hexdigest()))
                n, ids, decoded = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(doc_id), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, text).mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
