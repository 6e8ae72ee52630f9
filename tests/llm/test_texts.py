"""Words, quality rules, tokens and BPE."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers as tokenizers_files
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chronotally.llm import bpe, quality, tokens
from chronotally.llm.words import lines_of, text_bytes, words_of

RANKS = tokenizers_files.path("byte_bpe_50k.tiktoken")
JSON = tokenizers_files.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = [
    "", None, " ", "\n", "a", "a\n\na\n a", "x " * 9, "a b c d e f a b c d e\n#|éé \xa0y\n\n#|éé \xa0y", "été\x0bé\x0c",
    "日本語 👩‍👩‍👧 𝒳\x00 x", "one  two \n three", "\x1c b　c", "<|endoftext|> x", "don't 've 12é", "word" * 5000,
]


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = {}
    for i in range(len(words) - 4):
        at.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {k for v in at.values() if len(v) > 1 for i in v for k in range(i, i + 5)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered)


def random_texts(n, seed=5):
    draw = random.Random(seed)
    letters = ["a", "b", "é", "日", " ", " ", "\n", "\t", "|", "#", "\xa0", ".", "1", "'s"]
    return ["".join(draw.choices(letters, k=draw.randrange(80))) for _ in range(n)]


def test_counts_of_the_base_rules():
    texts = ODD + random_texts(300)
    found = quality.measures(pa.array(texts))
    columns = [found[c].tolist() for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    assert list(zip(*columns)) == [base(t) for t in texts]


def test_words_and_lines_of_a_sliced_column():
    texts = pa.array(["no", "a b", None, "", "c\nd\n"])[1:]
    words = words_of(texts)
    assert words.counts().tolist() == [2, 0, 0, 2]
    data, offsets = text_bytes(texts)
    starts, ends, first = lines_of(data, offsets)
    assert [bytes(data[a:b]) for a, b in zip(starts, ends)] == [b"a b", b"", b"", b"c", b"d", b""]
    assert first.tolist() == [0, 1, 2, 3, 6]


def test_equal_words_have_equal_codes_wherever_they_stand():
    texts = random_texts(200)
    words = words_of(pa.array(texts))
    spelled = [bytes(words.data[a:b]) for a, b in zip(words.starts, words.ends)]
    by_word = {}
    for word, code in zip(spelled, words.codes.tolist()):
        assert by_word.setdefault(word, code) == code
    assert len(set(by_word.values())) == len(by_word)


@pytest.mark.parametrize(
    "line, fails",
    [
        (b"Home | About | News | Contact", True),
        (b"plain words that say something.", False),
        (b"a$$$ b### c*** d&&&", True),
        (b"All rights reserved.", True),
        (b"no end " * 12, True),
        (b"no end but short", False),
        (b"x | y", False),
    ],
)
def test_line_rules(line, fails):
    assert quality.line_fails(line) is fails


@pytest.mark.parametrize("mark", ["\u0964", "\u06d4", "\u1362", "\u0589", "\u104b", "\u17d4", "\u3002", "\uff61", "\u2026", "."])
def test_sentences_end_in_any_script(mark):
    line = " ".join(["\u0915\u0916"] * 24)
    assert quality.line_fails(line.encode()) and not quality.line_fails((line + mark).encode())


def test_marks_are_those_of_the_unicode_property():
    own = {c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and quality._ENDS.match(chr(c))}
    assert own - set(map(ord, ";:\u2026")) >= {c for c in range(0x110000) if regex.match(r"\p{Sentence_Terminal}", chr(c))} - set(map(ord, ";:\u2026"))


PROSE = [
    "The design includes two towers and a hall that was finished in 1931.",
    "It was the first sign indicating that the river would rise again.",
    "He studied industrial design in Milan before he moved to the coast.",
    "Many historians share this view of the early years of the town.",
    "The album was released under the title of its first song.",
    "Few economists subscribe to that theory in the form first proposed.",
    "Copyright law protects the authors of books for seventy years.",
    "A clinic licensed under state law opened near the old station.",
    "She came back to top form in the second half of the season.",
    "Visitors click here and there without reading what the page says.",
    "In terms of use of water the new plant is better.",
    "Der Datenschutz war das Thema der ersten Sitzung im Herbst.",
    "Sie wollte sich erst anmelden und dann nach oben gehen.",
    "Alle Rechte der Bürger wurden in der neuen Verfassung des Landes festgeschrieben.",
    "Il fallait se connecter au réseau de la ville pour avoir de l'eau.",
    "La politique de confidentialité des banques a changé au siècle dernier.",
    "Les droits réservés aux nobles furent abolis en une nuit.",
    "La política de privacidad de la empresa fue criticada por los jueces.",
    "Tuvo que volver arriba porque había olvidado las llaves de casa.",
    "Das Programm wurde unter großem Beifall im alten Theater der Stadt veröffentlicht.",
]


@pytest.mark.parametrize("line", PROSE)
def test_prose_with_a_phrase_of_notices_stays(line):
    assert not quality.line_fails(line.encode())
    judged = quality._judge(pa.array([line]), 0.5)
    assert judged["cleaned"].to_pylist() == [line] and judged["kept"].to_pylist() == [True]


@pytest.mark.parametrize(
    "line",
    [
        "Sign in", "Sign in to continue", "Please sign in to comment.", "Log in to your account", "Share this:", "Home | Share this | Print",
        "Subscribe to our newsletter!", "Click here to read more", "To read the full story, click here.", "Copyright 2020 The Authors",
        "© Copyright 2011 Example Ltd", "Content copyright © 2012 by its owners, who may be asked for leave to print parts of it.",
        "Privacy Policy | Terms of Service", "This site uses cookies to improve your visit.", "Back to top", "Skip to main content",
        "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "© 2019 Example Inc. All rights reserved.",
        "Alle Rechte vorbehalten.", "Diese Website verwendet Cookies, um Ihnen den Besuch angenehm zu machen.", "Jetzt anmelden", "Hier klicken",
        "Impressum | Datenschutz", "Newsletter abonnieren", "Veröffentlicht unter der MIT-Lizenz.", "© 2020 Beispiel GmbH. ALLE RECHTE VORBEHALTEN",
        "Tous droits réservés.", "Accepter tous les cookies", "Se connecter", "Mentions légales", "Cliquez ici pour en savoir plus", "Sous licence MIT.",
        "Todos los derechos reservados.", "Aceptar todas las cookies", "Iniciar sesión", "Política de privacidad", "Bajo licencia Creative Commons.",
    ],
)
def test_notices_and_prompts_go(line):
    assert quality.line_fails(line.encode())


def test_verdict_and_lost_words_by_brute_force():
    draw = random.Random(3)
    pool = PROSE + ["Sign in", "All rights reserved.", "a | b | c | d", "", "  ", "no end " * 12, "Tous droits réservés.", "#### $$$$ x"]
    texts = ["\n".join(draw.choices(pool, k=draw.randrange(1, 9))) for _ in range(200)] + ODD
    judged = {k: v.to_pylist() for k, v in quality._judge(pa.array(texts), 0.5).items()}
    for i, text in enumerate(texts):
        lines = (text or "").split("\n")
        words = [re.findall(r"[^\x20\x09-\x0D]+", line) for line in lines]
        bad = [bool(w) and quality.line_fails(line.encode()) for w, line in zip(words, lines)]
        n, _, _, _, again = base(text)
        lost = sum(len(w) for w, b in zip(words, bad) if b)
        assert judged["lost_words"][i] == lost
        assert judged["cleaned"][i] == (None if text is None else "\n".join(x for x, b in zip(lines, bad) if not b))
        assert judged["kept"][i] == (n >= 10 and 100 * again <= 20 * n and lost <= 0.5 * n)


def test_the_numbers_of_the_line_rules_are_parameters():
    line = b"no end " * 8
    assert not quality.line_fails(line) and quality.line_fails(line, quality.LineRules(sentence_words=16))
    assert quality.line_fails(b"Click here to read more") and not quality.line_fails(b"Click here to read more", quality.LineRules(short_words=4))


def test_quality_of_bytes_that_are_no_text(spark):
    rows = spark.sql("select 1 as doc_id, cast(concat(X'61ff6220', cast('b c d e f g h i j k.\\nSign in\\nl' as binary)) as string) as text")
    got = quality.quality(rows).select("n_words", "kept", F.hex(F.col("cleaned").cast("binary")).alias("b")).first()
    assert (got.n_words, got.kept) == (14, True)
    assert bytes.fromhex(got.b) == b"a\xffb b c d e f g h i j k.\nl"


def test_quality_of_odd_rows(spark):
    good = "A sentence with quite a few different words stands here. Another one follows it."
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, good), (7, good), (7, good), (8, "a | b | c | d | e\n" + good)]
    docs = spark.createDataFrame([(i, t, None, None, None, True) for i, t in rows], SCHEMA + ", KEPT boolean")
    found = quality.quality(docs)
    assert [c.lower() for c in found.columns].count("kept") == 1
    got = found.select("text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert sorted((r[0] or "", tuple(r[1:])) for r in got) == sorted((t or "", base(t)) for _, t in rows)
    kept = quality.kept_documents(docs.drop("KEPT"))
    assert kept.columns == docs.columns[:-1]
    assert [(r.doc_id, r.text, r.n_chars) for r in kept.orderBy("doc_id").collect()] == [
        (None, good, len(good)), (7, good, len(good)), (7, good, len(good)), (8, good, len(good)),
    ]
    assert quality.quality(docs.limit(0)).count() == 0


def test_quality_keeps_clean_documents_and_rejects_most_others(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = quality.quality(spark.read.parquet(f"{folder}/documents.parquet")).join(labels, "doc_id")
    share = {}
    rows = judged.selectExpr("quality", "kept", "base_failed").collect()
    for label in (0, 1):
        some = [r.kept for r in rows if r.quality == label]
        share[label] = sum(some) / len(some)
    clean = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    assert share[0] < 0.1 and sum(clean) / len(clean) > 0.995


def encoding():
    ranks = bpe.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=tokenizers_files.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("most_states", [1, 50, 20_000])
def test_transducer_gives_the_merges(most_states):
    ranks = bpe.read_ranks(RANKS)
    machine, own = bpe.Transducer(ranks, most_states), encoding()._core_bpe
    draw = random.Random(3)
    for _ in range(600):
        letters = draw.choice([b"abcdefghij", b" ", b"-=*", bytes(range(256)), b"the ing and of re", b"ab"])
        piece = bytes(draw.choices(letters, k=draw.randrange(1, 90)))
        assert machine.encode(piece) == own.encode_single_piece(piece)
    assert len(machine.states) <= most_states


def test_transducer_on_a_small_table():
    ranks = {bytes([c]): c for c in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"aa": 259, b"aab": 260}
    machine = bpe.Transducer(ranks)
    own = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe
    draw = random.Random(1)
    for _ in range(500):
        piece = bytes(draw.choices(b"abc", k=draw.randrange(1, 30)))
        assert machine.encode(piece) == own.encode_single_piece(piece)


def split(ids, counts):
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


@pytest.mark.parametrize("most_states", [1, 50, 20_000])
def test_stretches_beyond_the_states_are_moved_side_by_side(most_states, monkeypatch):
    machine, own = bpe.Transducer(bpe.read_ranks(RANKS), most_states), encoding()._core_bpe
    draw = random.Random(4)
    letters = [b"abcdefghij", b" ", b"-=*", bytes(range(256)), b"the ing and of re", b"ab", b"\0"]
    pieces = [bytes(draw.choices(draw.choice(letters), k=draw.randrange(1, 40))) for _ in range(900)]
    alone = []
    monkeypatch.setattr(machine, "_rest", lambda *_: alone.append(_))
    for some in (pieces[:1], pieces[1:500], pieces[500:]):
        assert split(*machine.encode_all(some)) == [own.encode_single_piece(p) for p in some]
    assert not alone and len(machine.states) <= most_states
    assert [len(x) for x in machine.encode_all([])] == [0, 0]
    monkeypatch.undo()
    some = [b"ab" * 400, b"the", b"x" * 3000 + b"a"]
    assert split(*machine.encode_all(some)) == [own.encode_single_piece(p) for p in some]


def test_many_stretches_on_a_small_table():
    ranks = {bytes([c]): c for c in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"aa": 259, b"aab": 260}
    own = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe
    draw = random.Random(2)
    pieces = [bytes(draw.choices(b"abc", k=draw.randrange(1, 30))) for _ in range(500)]
    for most_states in (1, 3, 100):
        machine = bpe.Transducer(ranks, most_states)
        assert split(*machine.encode_all(pieces)) == [own.encode_single_piece(p) for p in pieces]
    with pytest.raises(ValueError):
        bpe.Transducer({b"a": 0, b"b": 1}, 1).encode_all([b"acb"])


@pytest.mark.parametrize("most", [1, 100, 100_000])
def test_pairs_that_lost_their_place_are_looked_at_again(most):
    ranks = bpe.read_ranks(RANKS)
    one, all_ = bpe.Pairs(ranks), bpe.Pairs(ranks, most)
    draw = np.random.default_rng(1)
    for _ in range(3):
        before, token = draw.integers(0, 300, 2000), draw.integers(0, 300, 2000)
        assert all_.allowed_all(before, token).tolist() == [one.allowed(a, b) for a, b in zip(before.tolist(), token.tolist())]
    assert all_.allowed_all(before[:0], token[:0]).tolist() == []


def test_a_word_is_encoded_once_whatever_follows_it(monkeypatch):
    machine, seen = bpe._machines(RANKS)[0], []
    encode_all = machine.encode_all
    monkeypatch.setattr(machine, "encode_all", lambda new: seen.extend(new) or encode_all(new))
    encode, own = bpe.encoder.__wrapped__(RANKS, tokenizers_files.PATTERN), encoding()
    text = "a word, a word. (a word) a word's café! café? café 9"
    assert encode(pa.array([text, None]))[0].tolist() == own.encode_ordinary(text)
    assert seen.count(b" word") == 1 and seen.count(" café".encode()) == 1


def test_ids_where_texts_are_cut_behind_letters():
    draw, pieces = random.Random(6), ["a", "It", "Z", "é", "ß", "×", "÷", "ſ", "ƀ", "Δ", "\u0301", "€", "ª", ".", ",", "'s",
        "'re", "'", "'S", "(", "|", "_", "0", "12", "²", "\x00", "\x1f", "\x7f", " ", "  ", "\n", "\n\n", "\xa0", "\u3000", "<|endoftext|>"]
    texts = ["".join(draw.choices(pieces, k=draw.randrange(1, 14))) for _ in range(3000)]
    found = bpe.encoder(RANKS, tokenizers_files.PATTERN)(pa.array(texts))
    own = encoding()
    assert [x.tolist() for x in found] == [own.encode_ordinary(t) for t in texts]
    # Another pattern, which joins letters with what follows them.
    other = r"\S+|\s+"
    own = tiktoken.Encoding("own", pat_str=other, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    texts = [" ".join(draw.choices(["it's", "a.b", "x|y", "word"], k=5)) for _ in range(50)]
    assert [x.tolist() for x in bpe.encoder(RANKS, other)(pa.array(texts))] == [own.encode_ordinary(t) for t in texts]


def test_digests_of_the_round_trip(spark):
    texts, own = ODD + random_texts(100), encoding()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    bad = docs.limit(1).selectExpr("-1L as doc_id", "cast(X'61ff62' as string) as text")
    rows = {r.doc_id: r[1:] for r in bpe.round_trip_digests(docs.union(bad), RANKS, tokenizers_files.PATTERN).collect()}
    want = {}
    for i, text in [*enumerate(texts), (-1, "a\ufffdb")]:
        ids, text = own.encode_ordinary(text or ""), text or ""
        shown = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want[i] = (len(ids), shown, hashlib.sha256(text.encode()).hexdigest())
    assert rows == want


def test_encoding_and_decoding_whole_texts(spark):
    texts = ODD + random_texts(100)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, IDS string")
    coded = bpe.encode_documents(docs, RANKS, tokenizers_files.PATTERN)
    rows = bpe.decode_documents(coded, RANKS, chunk=3).orderBy("doc_id").collect()
    own = encoding()
    assert [r.ids for r in rows] == [own.encode_ordinary(t or "") for t in texts]
    assert [r.decoded for r in rows] == [t or "" for t in texts]
    assert bpe.decode_documents(bpe.encode_documents(docs.limit(0), RANKS, tokenizers_files.PATTERN), RANKS).count() == 0


def test_decoder_replaces_what_is_no_utf8():
    _, decoder = bpe._machines(RANKS)
    draw = random.Random(2)
    for _ in range(300):
        ids = np.array([draw.randrange(50256) for _ in range(12)])
        raw = b"".join(decoder.bytes[i] for i in ids)
        for size in (1, 2, 5, 12):
            chunks = [ids[k : k + size] for k in range(0, 12, size)]
            assert "".join(decoder.stream(chunks)).replace("�", "") == raw.decode(errors="ignore")


def test_library_ids_by_parts_are_those_of_whole_texts():
    own = Tokenizer.from_file(JSON)
    spaces = "".join(map(chr, [9, 11, 13, 28, 31, 32, 133, 160, 5760, 8192, 8202, 8232, 8239, 8287, 12288, 233, 8218, 97, 46]))
    draw = random.Random(8)
    texts = ODD + random_texts(300) + ["".join(draw.choices(spaces + "  ab", k=draw.randrange(30))) for _ in range(400)]
    texts += ["a <|endoftext|> b", "x<|endoftext|>y  <|endoftext|>", "<|endoftext|>", " <|endof text|>", "é" * 11 + " " + "é" * 12]
    texts += ["x" * k + " " + "y" * k for k in range(20, 28)] + ["\0", "\0\0 \0", "z" * 1_000_000]
    encode = tokens.id_encoder(JSON)
    for some in (texts, texts[::-1], texts[:1], []):
        for text, ids in zip(some, encode(pa.array(some, pa.string())), strict=True):
            assert ids.tolist() == own.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("most", [1, 50])
def test_a_full_table_changes_nothing(most):
    own, encode = Tokenizer.from_file(JSON), tokens.id_encoder(JSON, most=most)
    for at in range(0, 300, 20):
        texts = random_texts(300)[at : at + 20]
        for text, ids in zip(texts, encode(pa.array(texts))):
            assert ids.tolist() == own.encode(text, add_special_tokens=False).ids


def test_bytes_that_are_no_text():
    column = pa.array([b"a\xff b", b"\xc2 x", b"ok"]).cast(pa.binary())
    column = pa.Array.from_buffers(pa.string(), 3, column.buffers())
    own = Tokenizer.from_file(JSON)
    want = [own.encode(t, add_special_tokens=False).ids for t in ("a\ufffd b", "\ufffd x", "ok")]
    assert [x.tolist() for x in tokens.id_encoder(JSON)(column)] == want


def test_a_full_memory_changes_nothing():
    calls = []
    memo = tokens.Memo(lambda new: calls.append(len(new)) or [p.upper() for p in new], most=6)
    lists = [[draw] * 2 + [draw + "x"] for draw in "abcdefabcdef"]
    assert [memo.take([one])[0] for one in lists] == [[p.upper() for p in one] for one in lists]
    assert len(memo.known) <= 6
