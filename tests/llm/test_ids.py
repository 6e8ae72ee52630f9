"""Binary ids and packing."""

import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers as tokenizers_files
from tokenizers import Tokenizer

from chronotally.llm import binary, packing, tokens
from chronotally.llm.part_table import PartTable
from chronotally.llm.words import text_bytes
from chronotally.session import run_folder

JSON = tokenizers_files.path("byte_bpe_50k.json")


def ids_of(text):
    own = Tokenizer.from_file(JSON)
    return own.encode(text or "", add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("high", [1, 3, 300, 70_000, 1 << 25])
@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_ids_survive_their_bytes(n, high):
    draw = np.random.default_rng(n + high)
    ids = draw.integers(0, high, n).astype(np.uint32)
    assert (binary.decode_ids(*binary.encode_ids(ids), n) == ids).all()


def test_frequent_ids_take_one_byte():
    ids = np.repeat(np.array([40_000, 50_000], np.uint32), [90, 10])
    ranking, control, data = binary.encode_ids(ids)
    assert (len(ranking), len(control), len(data)) == (8, 25, 100)


@pytest.mark.parametrize("block", [1, 40, 1 << 20])
def test_documents_in_files(spark, block):
    rows = [(3, "three"), (1, None), (None, "no id"), (2, ""), (2, "again\nmore"), (3, "three"), (9, "long " * 300), (9, "a <|endoftext|> b")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, sizes int").repartition(3)
    path = run_folder(spark, "ids-test")
    binary.write_ids(docs, path, JSON, end_id=0, block=block)
    got = sorted(binary.read_ids(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 2, 2, 3, 3, 9, 9]
    assert [r.start for r in got] == list(np.cumsum([0, *(r.n_tokens for r in got)])[:-1])
    want = sorted(tuple(ids_of(t)) for _, t in rows)
    assert sorted(tuple(r.ids) for r in got) == want
    for r in got:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())


def test_no_documents_in_files(spark):
    path = run_folder(spark, "ids-test")
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    binary.write_ids(docs, path, JSON, end_id=0)
    assert binary.read_ids(spark, path).count() == 0


def least_cost(places, costs, size, short):
    best = [0.0] + [float("inf")] * (len(places) - 1)
    for i in range(1, len(places)):
        for j in range(i):
            length = places[i] - places[j]
            if length <= size:
                pad = short if length in (size // 2, size // 4) else size - length
                best[i] = min(best[i], best[j] + pad + costs[i])
    return best[-1]


def test_cuts_are_the_best():
    draw = random.Random(1)
    for _ in range(150):
        sizes = np.array([draw.randint(1, 90) for _ in range(draw.randint(1, 7))])
        total = int(sizes.sum())
        ends = np.array(sorted(draw.sample(range(1, total + 1), min(total, draw.randint(0, 12)))), np.int64)
        places, costs = packing.candidates(sizes, ends, 32, 4, 8)
        cuts = packing.best_cuts(places, costs, 32, 4)
        cost = dict(zip(places.tolist(), costs.tolist()))
        pairs = list(zip(cuts, cuts[1:]))
        assert cuts[0] == 0 and cuts[-1] == total and all(0 < b - a <= 32 for a, b in pairs)
        got = sum((4 if b - a in (16, 8) else 32 - (b - a)) + cost[b] for a, b in pairs)
        assert got == pytest.approx(least_cost(places.tolist(), costs.tolist(), 32, 4))


def test_pieces_hold_each_id_once(spark):
    draw = random.Random(4)
    texts = [None, "", "x" * 3000] + [
        " ".join(draw.choice(["one", "two.", "three\n", "four!"]) for _ in range(draw.randrange(900))) for _ in range(40)
    ]
    rows = [(None if i == 5 else i // 2, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, offset string").repartition(3)
    pieces = packing.pack(docs, JSON, end_id=0, size=256).collect()
    sequences = {}
    for p in pieces:
        assert p.length == len(p.ids) and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0, *(n for _, n in parts)])[:-1])
        assert sum(n for _, n in parts) <= 256
    documents = {}
    ordered = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
    current = []
    for p in ordered:
        if p.start == 0:
            current = []
        assert p.start == len(current)
        current += p.ids
        if len(current) == p.doc_tokens:
            documents.setdefault(p.doc_id, []).append(tuple(current))
    want = {}
    for doc_id, text, _ in rows:
        want.setdefault(doc_id, []).append(tuple(ids_of(text)))
    assert {k: sorted(v) for k, v in documents.items()} == {k: sorted(v) for k, v in want.items()}
    assert packing.pack(docs.limit(0), JSON, end_id=0).count() == 0


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(1)
    sizes = packing.pack(docs, JSON, end_id=0, with_ids=False).groupBy("sequence_id").sum("length").collect()
    total = sum(r[1] for r in sizes)
    assert sum(packing.padding(r[1], 1024) for r in sizes) < 0.01 * total


def test_a_word_is_encoded_once_whatever_follows_it():
    library, seen = tokens.Library(JSON), []
    table = PartTable(lambda new: seen.extend(new) or library.encode_parts(new), signs=library.signs)
    texts = ["a word, a word. a word; (a word) a word's word: café! café? café word9 x× x×."]
    ids, ends = table.ids(*text_bytes(pa.array(texts)))
    assert ids.tolist() == ids_of(texts[0])[:-1] and ends.tolist() == [len(ids)]
    assert seen.count(b" word") == 1 and seen.count(" café".encode()) == 1 and len(seen) == len(set(seen))
    assert not [part for part in seen if part.startswith((b" word", b" caf")) and part not in (b" word", " café".encode())]


def test_ids_of_parts_cut_behind_letters():
    draw, pieces = random.Random(6), ["a", "It", "Z", "é", "ß", "×", "÷", "ſ", "ƀ", "Δ", "́", "€", "ª",
        ".", ",", "'s", "'re", "'", "'S", "(", "|", "_", "0", "12", "²", "\x00", "\x1f", "\x7f", " ", "  ", "\n", " ", "<|endoftext|>", "endoftext|>"]
    texts = ["".join(draw.choices(pieces, k=draw.randrange(1, 14))) for _ in range(3000)]
    own, encode = Tokenizer.from_file(JSON), tokens.id_encoder(JSON)
    want = [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encode(pa.array(texts))] == want


@pytest.mark.parametrize("change", [
    {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}},
    {"normalizer": {"type": "NFC"}},
])
def test_texts_are_cut_before_white_space_only_where_the_pattern_is_another(tmp_path, change):
    with open(JSON) as file:
        form = json.load(file) | change
    (tmp_path / "own.json").write_text(json.dumps(form))
    assert not tokens.Library(str(tmp_path / "own.json")).signs.any()
    signs = tokens.Library(JSON).signs
    assert signs[ord(".")] and signs[ord("<")] and not signs[ord("|")] and not signs[ord("a")]
