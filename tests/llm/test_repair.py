"""Repair of conversations against a plain version, one conversation at a time."""

import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest

from chronotally.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, copies string, fault int"
AFTER = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def spaced(value):
    return " " if value is None else str(value)


def plain_rows(rows):
    """Rows of one conversation after the damage."""
    out = []
    first = lambda v: (v is not None, v if v is not None else 0)
    word = lambda v: (v is not None, v or "")
    for conv, turn, role, text in sorted(rows, key=lambda r: (first(r[1]), word(r[2]), word(r[3]))):
        kind = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
        role, text = spaced(role), spaced(text)
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def plain_faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        black = re.findall(r"[^\x20\x09-\x0D]", text)
        if not black:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if black[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def plain_search(rows, faults):
    sys.setrecursionlimit(20_000)

    @lru_cache(None)
    def best(i, state, inserts):
        ways = [] if i < len(rows) or state not in ("", "a") else [(0, "", ())]
        need = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[need]
        if inserts < 2:
            cost, audit, left = best(i, AFTER[state, need], inserts + 1)
            ways.append((5 + cost, "I" + audit, (f"{name}:", *left)))
        if i < len(rows):
            _, role, text = rows[i]
            cost, audit, left = best(i + 1, state, 0)
            ways.append((2 + cost, "D" + audit, left))
            if faults[i] in ("", "truncated"):
                more = 5 * (faults[i] == "truncated")
                to = AFTER.get((state, role[:1])) if role else state
                if to is not None:
                    cost, audit, left = best(i + 1, to, 0)
                    ways.append((more + cost, "K" + audit, (f"{role}:{text}", *left)))
                cost, audit, left = best(i + 1, AFTER[state, need], 0)
                ways.append((1 + more + cost, "R" + audit, (f"{name}:{text}", *left)))
        return min(ways) if ways else (10**9, "", ())

    return best(0, "", 0)


def plain(conversation):
    rows = plain_rows(conversation)
    faults = plain_faults(rows)
    cost, audit, left = plain_search(tuple(rows), tuple(faults))
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(left).encode()).hexdigest(),
    )


def compared(spark, rows, size, partitions=3):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(partitions)
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair(frame, size).collect()}
    by_id = {}
    for row in rows:
        by_id.setdefault(row[0], []).append(row)
    assert got == {conv: plain(some) for conv, some in by_id.items()}


def random_rows(draw, conversations, most):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "u"]
    texts = ["Yes.", "No!", "why", "", None, " \t", "Is it? \n", "日本 é.", "a:b\nc.", "...", "it is 1.5"]
    rows = []
    for conv in range(conversations):
        for k in range(draw.randrange(1, most)):
            turn = draw.choice([k, k, k, k + 2, None])
            role = draw.choice(roles) if draw.random() < 0.4 else ("user", "assistant")[k % 2]
            text = draw.choice(texts) if draw.random() < 0.6 else f"text {k}."
            rows += [(conv if conv else None, turn, role, text)] * draw.choice([1, 1, 1, 1, 2, 3])
    return rows


@pytest.mark.parametrize("size", [1, 3, 64])
def test_every_conversation_is_repaired_as_by_the_plain_version(spark, size):
    compared(spark, random_rows(random.Random(size), 60, 14), size)


def test_a_conversation_with_most_rows(spark):
    draw = random.Random(9)
    texts = [f"{draw.choice(['So', 'No', 'Well'])} {draw.randrange(900)}{draw.choice(['.', '!', '', '.'])}" for _ in range(400)]
    rows = [(1, i, draw.choice(["user", "assistant", "assistant"]), t) for i, t in enumerate(texts)]
    compared(spark, rows + [(2, 0, "user", "Hi."), (3, 1, "assistant", "x" * 2_000_000)], 16, 8)


def test_many_equal_rows(spark):
    compared(spark, [(7, 3, "user", "Again.")] * 500 + [(7, 4, "assistant", "Again.")] * 300, 64)


def test_given_tables(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    compared(spark, rows, 64)


def test_no_conversations(spark):
    assert repair.repair(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_conversation_that_loses_all_its_rows(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    assert repair.repair(spark.createDataFrame([(5, turn, "user", "Hi.", "", 0)], SCHEMA)).collect() == [
        (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    ]


def test_each_search_gives_the_least_of_the_cheapest():
    draw = random.Random(3)
    for _ in range(300):
        rows = tuple(
            (draw.choice(["u", "a", "s", "t", ""]), draw.choice(["", "", "", "t", "x"]), 0) for _ in range(draw.randrange(8))
        )
        plainly = [(0, i, "y.") for i, _, _ in rows]
        faults = [{"t": "truncated", "x": "blank", "": ""}[f] for _, f, _ in rows]
        assert repair.cheapest(rows) == plain_search(tuple(plainly), tuple(faults))[:2]
