"""The filter audit against plain loops over documents and orders."""

import random
import re
from itertools import permutations

import pytest

from chronotally.llm import filter_audit

DOCS = "doc_id bigint, text string, lang string, mask string, part int, n int, digest string"
LABELS = "doc_id bigint, quality int, toxic int, doc_text string"


def failed(text, copy):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    checks = {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": copy,
    }
    return {f for f, fails in checks.items() if fails}


def plain(docs, labels):
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, bad in labels if bad == 1 and i is not None}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    parts = {}
    for i, text, lang in docs:
        copy = i is not None and i > least[text or ""]
        parts.setdefault(lang or "", []).append((failed(text or "", copy), i in good, i in toxic))
    rows = set()
    for part, marked in parts.items():
        removed_by = dict.fromkeys("ABCDE", 0)
        found = []
        for order in permutations("ABCDE"):
            left = marked
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                fails = sum(f in d[0] for d in marked)
                alone = sum(d[0] == {f} for d in marked)
                removed_by[f] += len(gone)
                lost = sum(d[1] for d in gone), sum(d[2] for d in gone)
                found.append((part, "".join(order), step, len(left), len(gone), fails - len(gone), alone, *lost))
        rows |= {(*row, removed_by[row[1][row[2] - 1]]) for row in found}
    return rows


def compared(spark, docs, labels, partitions=3):
    frame = spark.createDataFrame([(*d, "m", 1, 2, "d") for d in docs], DOCS).repartition(partitions)
    marks = spark.createDataFrame([(*x, "t") for x in labels], LABELS)
    got = filter_audit.audit(frame, marks).collect()
    assert len(got) == len({d[2] or "" for d in docs}) * 600
    assert {tuple(r) for r in got} == plain(docs, labels)


def test_every_order_counts_as_by_plain_loops(spark):
    draw = random.Random(7)
    words = ["one", "Two", "é", "THREE", "four#", "five", "a|b", *(f"w{i}" for i in range(200))]
    texts = [None, "", " \n", "X" * 200_000, "#"]
    texts += [" ".join(draw.choices(words[: draw.choice([3, 7, 200])], k=draw.choice([1, 99, 100, 150]))) for _ in range(40)]
    texts += [" ".join(draw.sample(words[7:], 120)) for _ in range(20)]
    docs = [(draw.choice([None, *range(60)]), draw.choice(texts), draw.choice(["en", "fr", None, "", "de"])) for _ in range(150)]
    docs += docs[:10] + [(i, "the same " * 60, "en") for i in range(200, 300)]
    labels = [(draw.choice([None, *range(80)]), draw.choice([0, 1, None]), draw.choice([0, 1, None])) for _ in range(90)]
    compared(spark, docs, labels)


def test_rows_of_one_id(spark):
    docs = [(1, "a", "en")] * 3 + [(1, "a", "fr"), (2, "a", "en"), (1, "b", "en"), (None, "a", "en"), (None, "a", None)]
    compared(spark, docs, [(1, 1, 0), (1, 0, 1), (None, 1, 1)])


def test_no_documents(spark):
    assert filter_audit.audit(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).collect() == []


def test_no_labels(spark):
    compared(spark, [(1, "a", "en"), (2, "b", None)], [])


@pytest.mark.parametrize("filters", ["AB", "ABC", "ABCDE"])
def test_intervals_say_when_a_mask_is_removed(filters):
    ranked = filter_audit.orders(filters)
    assert ranked == sorted(ranked)
    at = {}
    for mask, step, begin, end, first, _ in filter_audit.intervals(filters):
        for rank in range(begin, end):
            assert (mask, step, rank) not in at
            at[mask, step, rank] = first
    for mask in range(1, 2 ** len(filters)):
        inside = {f for i, f in enumerate(filters) if mask >> i & 1}
        for rank, order in enumerate(ranked):
            hits = [step for step, f in enumerate(order, 1) if f in inside]
            assert [step for step in range(1, len(filters) + 1) if at.get((mask, step, rank))] == hits[:1]
            assert [step for step in range(1, len(filters) + 1) if at.get((mask, step, rank)) is False] == hits[1:]
