"""Damaged conversations, their faults, and the cheapest edits that make each well formed.

A conversation is well formed if the first letters of its roles, one after the other, are nothing, or
``ua`` again and again, with one ``s`` ahead or none. Edits go through its rows in order: Keep (0), Rerole
to user or assistant (1), Delete (2; a must for blank and duplicate rows), Insert an empty user or
assistant row anywhere (5). A truncated row that stays costs 5 more. Of the cheapest ways the one whose
initials (``D I K R``) are least in ASCII order is taken.

The search is iterative-deepening A*: depth first, edits in ASCII order, within a bound on cost plus a
lower bound on what is left; the bound rises to the least sum that went beyond it. The lower bound
counts rows that must go, truncated rows, and pairs of neighbours that cannot both stay as they are.
A table of the cost at which a place and state were last tried in vain cuts off all later tries that
cost as much. The first accepting path is the answer. Conversations with the same letters and
faults share one search.

Texts never meet in one place because a conversation is long. Equal rows are summed up before they
move. Rows are dealt out by ranges of conversation, turn, role and text, so that a long conversation is
many tasks' work, and are cut into segments of ``SEGMENT`` rows. A whole conversation in one segment is
searched at once; of a longer one each segment is searched for every state it may begin and end with, and
the segments are linked from first to last by cost and order of initials: paths to the same place are
never beginnings of each other, so the least beginning stays least. What is linked is four costs
a segment. Only the digest of a repaired conversation reads its texts in order in one task, a segment
at a time, as a digest has to.

Rows of one turn are ordered by role and text as they were before the damage, nulls first, and a
repeated row is followed by its copies. A null is one space, in role, text and the key of the damage. Rows
with a null ``conv_id`` are one conversation. An empty role has no initial: such a row may stay anywhere, but
counts as illegal beside any other. An empty table gives no rows. Columns other than those named are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotally.llm.tables import stored

SEGMENT = 64
KEEP, REROLE, DELETE, INSERT, STAY_TRUNCATED = 0, 1, 2, 5, 5
# States by what was last put out: nothing, "s", "u" or "a".
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_AFTER = {(_START, "s"): _SYSTEM, (_USER, "a"): _ASSISTANT} | {(q, "u"): _USER for q in (_START, _SYSTEM, _ASSISTANT)}
_NEXT = {q: "u" for q in (_START, _SYSTEM, _ASSISTANT)} | {_USER: "a"}
_REACHED = {_START: range(4), _SYSTEM: range(1, 4), _USER: range(2, 4), _ASSISTANT: range(2, 4)}
_ROLES = {"u": "user", "a": "assistant"}
_LEGAL = ("su", "ua", "au")
# Edits that complete a conversation behind its last row, by the state it is in.
_TAIL = {_START: "", _ASSISTANT: "", _USER: "I", _SYSTEM: "II"}
_WHITE = " \t\n\x0b\x0c\r"


# --- the search -----------------------------------------------------------------------------

#: A row is its initial, its fault ("x": must go, "t": truncated, "": none) and the number of
#: copies that follow it and must go.
Row = tuple[str, str, int]


def _least_left(rows: tuple[Row, ...]) -> list[int]:
    """A lower bound on the cost of the rows from each place on."""
    stay = [i for i, (_, fault, _) in enumerate(rows) if fault != "x"]
    pairs = [0] * (len(stay) + 2)
    for k in range(len(stay) - 1, -1, -1):
        pairs[k] = pairs[k + 1]
        if k + 1 < len(stay):
            (a, fa, _), (b, fb, _) = rows[stay[k]], rows[stay[k + 1]]
            if a and b and not fa and not fb and a + b not in _LEGAL:
                pairs[k] = max(pairs[k], REROLE + pairs[k + 2])
    left, k = [0] * (len(rows) + 1), len(stay)
    forced = 0
    for i in range(len(rows) - 1, -1, -1):
        _, fault, copies = rows[i]
        forced += DELETE * (copies + (fault != ""))
        k -= fault != "x"
        left[i] = forced + pairs[k]
    return left


def _edits(rows: tuple[Row, ...], i: int, state: int, goal: int | None) -> list[tuple[str, int, int, int]]:
    """``initials, cost, place, state`` of the edits at a place, in ASCII order."""
    if i == len(rows):
        role = _NEXT[state]
        return [("I", INSERT, i, _AFTER[state, role])] if goal is None else []
    initial, fault, copies = rows[i]
    more, cost = "D" * copies, DELETE * copies
    found = [("D" + more, DELETE + cost, i + 1, state), ("I", INSERT, i, _AFTER[state, _NEXT[state]])]
    if fault != "x":
        cost += STAY_TRUNCATED if fault else 0
        to = state if initial == "" else _AFTER.get((state, initial))
        if to is not None:
            found.append(("K" + more, KEEP + cost, i + 1, to))
        found.append(("R" + more, REROLE + cost, i + 1, _AFTER[state, _NEXT[state]]))
    return found


@lru_cache(1 << 14)
def cheapest(rows: tuple[Row, ...], start: int = _START, goal: int | None = None) -> tuple[int, str] | None:
    """Cost and initials of the cheapest edits from state ``start`` to the end of the rows in state ``goal``;
    without a goal to a well-formed end, with inserts behind the last row. None if there are none."""
    if goal is not None and goal not in _REACHED[start]:
        return None
    left = _least_left(rows)
    # Deleting all rows and inserting what leads to the goal costs no more than this.
    most = left[0] + sum((DELETE + STAY_TRUNCATED) * (1 + copies) for _, _, copies in rows) + 3 * INSERT

    def done(i: int, state: int) -> bool:
        return i == len(rows) and (_TAIL[state] == "" if goal is None else state == goal)

    bound = left[0]
    while bound <= most:
        tried: dict[tuple[int, int], int] = {(0, start): 0}
        beyond = most + 1
        if done(0, start):
            return 0, ""
        # The path so far: what is still to try at each place, the cost there, and the edit that led on.
        path = [(iter(_edits(rows, 0, start, goal)), 0, "")]
        while path:
            edits, cost, _ = path[-1]
            for initials, more, i, state in edits:
                if goal is not None and goal not in _REACHED[state]:
                    continue
                so_far = cost + more
                if so_far + left[i] > bound:
                    beyond = min(beyond, so_far + left[i])
                elif done(i, state):
                    return so_far, "".join(edit for _, _, edit in path) + initials
                elif tried.get((i, state), so_far + 1) > so_far:
                    tried[i, state] = so_far
                    path.append((iter(_edits(rows, i, state, goal)), so_far, initials))
                    break
            else:
                path.pop()
        bound = beyond
    return None


def repaired(rows: list[tuple[str, str, int]], audit: str, state: int) -> Iterator[str]:
    """``role:text`` of the rows that the edits leave, from the state before the first one."""
    at = iter(rows)
    role, text, copies = None, "", 0
    for edit in audit:
        if edit == "I":
            state = _AFTER[state, _NEXT[state]]
            yield _ROLES["a" if state == _ASSISTANT else "u"] + ":"
            continue
        if copies:  # a copy of the row before
            copies -= 1
            continue
        role, text, copies = next(at)
        copies -= 1
        if edit == "K":
            state = _AFTER[state, role[:1]] if role else state
            yield f"{role}:{text}"
        elif edit == "R":
            state = _AFTER[state, _NEXT[state]]
            yield f"{_ROLES['a' if state == _ASSISTANT else 'u']}:{text}"


# --- damage and faults ----------------------------------------------------------------------


def _or_space(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """The rows with what was done to them: ``conv_id, turn``, the former ``role0`` and ``text0`` by which
    rows of a turn are ordered, ``role, text`` and how many equal rows stand side by side (``copies``)."""
    rows = turns.groupBy(
        "conv_id", "turn", F.col("role").cast("string").alias("role0"), F.col("text").cast("string").alias("text0")
    ).agg(F.count("*").alias("copies"))
    key = F.concat(_or_space(F.col("conv_id")), F.lit(":"), _or_space(F.col("turn")))
    kind, text = F.col("kind"), _or_space(F.col("text0"))
    return (
        rows.withColumn("kind", F.crc32(key) % 20)
        .filter("kind != 0")
        .select(
            "conv_id", "turn", "role0", "text0",
            F.when(kind == 4, "user").otherwise(_or_space(F.col("role0"))).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            F.when(kind == 3, F.col("copies") * 2).otherwise(F.col("copies")).alias("copies"),
        )
    )


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` with the first ``fault`` of each: ``blank``, ``duplicate``, ``truncated`` or null. Copies
    that follow a row are blank or duplicates."""
    place = F.struct("turn", "role0", "text0")
    said = rows.withColumn("said", F.unhex(F.sha2(F.concat_ws(":", F.sha2("role", 256), F.sha2("text", 256)), 256)))
    said = stored(said, "repair-rows")
    firsts = said.groupBy(F.col("conv_id").alias("c"), F.col("said").alias("s")).agg(
        F.min(place).alias("first_place"), F.count("*").alias("places")
    )
    # Rows that are alone in what they say need no look at the others.
    again = stored(firsts.filter("places > 1").select("c", "s", "first_place"), "repair-again")
    black = F.expr(f"rtrim('{_WHITE.encode('unicode_escape').decode()}', text)")
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    truncated = ~F.substring(black, -1, 1).isin(".", "!", "?")
    return said.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("said") == F.col("s")), "left").select(
        *rows.columns,
        F.when(blank, "blank")
        .when(~F.coalesce(place.eqNullSafe(F.col("first_place")), F.lit(True)) & F.col("s").isNotNull(), "duplicate")
        .when(truncated, "truncated")
        .alias("fault"),
    )


def _counts(rows: DataFrame) -> DataFrame:
    """Turn numbers that are missing, and rows by their first fault."""
    copies, fault = F.col("copies"), F.col("fault")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    per_turn = rows.groupBy("conv_id", "turn").agg(
        total(F.when(fault == "blank", copies)).alias("blank"),
        total(F.when(fault == "duplicate", copies).when(fault == "blank", 0).otherwise(copies - 1)).alias("duplicate"),
        total(F.when(fault == "truncated", 1)).alias("truncated"),
    )
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return per_turn.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).cast("bigint").alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )


# --- segments -------------------------------------------------------------------------------

_ENTRY = "array<struct<start: int, goal: int, cost: bigint, audit: string>>"
_LINE = "array<struct<role: string, text: string, copies: bigint>>"
_ENTRIES = pa.list_(
    pa.struct([("start", pa.int32()), ("goal", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
)
_LINES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("copies", pa.int64())]))
_DONE = -1


def segments(rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """``conv_id, part, number, lines, illegal, first, last, ways``: rows side by side of one conversation, in
    order of ``part`` and ``number``, and the cheapest edits for each state before and behind them."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role0", "text0")]
    code = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", "t").otherwise("")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        current, waiting, letters, whole, begun = None, [], [], False, False
        ready: list[tuple] = []
        id_type = None

        def segment(last: bool) -> None:
            nonlocal number, whole
            found = tuple(letters)
            # Its first row is the conversation's, and so is its last: no other task has rows of it.
            if whole and last:
                ways = [(_START, _DONE, *cheapest(found))]
            else:
                pairs = ((a, b, cheapest(found, a, b)) for a in range(4) for b in range(4))
                ways = [(a, b, *way) for a, b, way in pairs if way is not None]
            firsts = [initial for initial, _, _ in found]
            illegal = sum(copies for _, _, copies in found) + sum(a + b not in _LEGAL for a, b in zip(firsts, firsts[1:]))
            ready.append((current, part, number, list(waiting), illegal, firsts[0], firsts[-1], ways))
            number += 1
            whole = False
            waiting.clear()
            letters.clear()

        def out() -> pa.RecordBatch:
            names = ["conv_id", "part", "number", "lines", "illegal", "first", "last", "ways"]
            types = [id_type, pa.int32(), pa.int64(), _LINES, pa.int64(), pa.string(), pa.string(), _ENTRIES]
            keys = [[{"role": r, "text": t, "copies": c} for r, t, c in row[3]] for row in ready]
            ways = [[dict(zip(("start", "goal", "cost", "audit"), w)) for w in row[7]] for row in ready]
            columns = [list(c) for c in zip(*ready)]
            columns[3], columns[7] = keys, ways
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
            ready.clear()
            return batch

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            weight = 0
            for conv, role, text, copies, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or conv != current:
                    if waiting:
                        segment(last=True)
                    # The first conversation of a task may have begun in the one before.
                    current, whole, begun = conv, begun, True
                elif len(waiting) == size or weight > 1 << 20:
                    segment(last=False)
                    weight = 0
                waiting.append((role, text, copies))
                letters.append((role[:1], fault, copies - 1))
                weight += len(text)
            if ready:
                yield out()
        if waiting:
            segment(last=False)  # it may go on in the next task
        if ready:
            yield out()

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = f"conv_id {kind}, part int, number bigint, lines {_LINE}, illegal bigint, first string, last string, ways {_ENTRY}"
    return dealt.select("conv_id", "role", "text", "copies", code.alias("fault")).mapInArrow(run, schema)


def _linked(entries: list[tuple[list[dict]]]) -> tuple[int, list[tuple[int, int]], int]:
    """The cost of the best way through segments, the states before and behind each, and the last state."""
    best = {_START: (0, 0)}  # state: cost, and the rank of its initials among those of the other states
    back: list[dict[int, int]] = []
    for ways in entries:
        found: dict[int, tuple] = {}
        for way in ways:
            if way["start"] in best:
                cost, rank = best[way["start"]]
                key = (cost + way["cost"], rank, way["audit"], way["start"])
                found[way["goal"]] = min(found.get(way["goal"], key), key)
        ranks = {key[1:3]: k for k, key in enumerate(sorted(found.values(), key=lambda key: key[1:3]))}
        best = {goal: (key[0], ranks[key[1:3]]) for goal, key in found.items()}
        back.append({goal: key[3] for goal, key in found.items()})
    tail = {goal: 0 if goal == _DONE else INSERT * len(_TAIL[goal]) for goal in best}
    end = min(best, key=lambda goal: (best[goal][0] + tail[goal], best[goal][1]))
    steps, goal = [], end
    for before in reversed(back):
        steps.append((before[goal], goal))
        goal = before[goal]
    return best[end][0] + tail[end], steps[::-1], end


def _choices(cut: DataFrame) -> DataFrame:
    """``c, part, number, start, goal, end``: which way each segment goes, and the edits at the end."""
    kind = cut.schema["conv_id"].dataType.simpleString()
    names = ["c", "p", "n", "start", "goal", "cost", "illegal", "tail"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, places, entries, illegal, previous, begun = None, [], [], 0, "", False
        ready: list[tuple] = []

        def finish() -> None:
            cost, steps, end = _linked(entries)
            for k, ((p, n), (start, goal)) in enumerate(zip(places, steps)):
                last = k == len(places) - 1
                tail = _TAIL.get(end, "") if last else ""
                ready.append((current, p, n, start, goal, cost if last else 0, illegal if last else 0, tail))

        def out(id_type: pa.DataType) -> pa.RecordBatch:
            types = [id_type, pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), types)], names=names)
            ready.clear()
            return batch

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for conv, p, n, inside, first, last, ways in zip(*(c.to_pylist() for c in batch.columns)):
                if begun and conv == current:
                    illegal += previous + first not in _LEGAL
                else:
                    if begun:
                        finish()
                    current, places, entries, illegal, begun = conv, [], [], 0, True
                places.append((p, n))
                entries.append(ways)
                illegal += inside
                previous = last
            if ready:
                yield out(id_type)
        if begun:
            finish()
            yield out(id_type)

    order = [F.asc_nulls_first(c) for c in ("conv_id", "part", "number")]
    dealt = cut.repartition("conv_id").sortWithinPartitions(*order)
    schema = f"c {kind}, p int, n bigint, start int, goal int, cost bigint, illegal bigint, tail string"
    return dealt.select("conv_id", "part", "number", "illegal", "first", "last", "ways").mapInArrow(run, schema)


def _pieces(cut: DataFrame, choices: DataFrame) -> DataFrame:
    """``conv_id, part, number, cost, illegal, audit, piece``: the edits of each segment and what they leave, every
    row followed by a line feed."""
    kind = cut.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audits, pieces = [], []
            columns = (batch.column(c).to_pylist() for c in ("lines", "audit", "start", "tail"))
            for lines, audit, start, tail in zip(*columns):
                rows = [(line["role"], line["text"], line["copies"]) for line in lines]
                audits.append(audit + tail)
                pieces.append("".join(line + "\n" for line in repaired(rows, audit + tail, start)))
            names = ["conv_id", "part", "number", "cost", "illegal"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(audits, pa.string()), pa.array(pieces, pa.large_string()).cast(pa.string())],
                names=[*names, "audit", "piece"],
            )

    way = F.expr("filter(ways, w -> w.start = begins and w.goal = ends)[0].audit")
    chosen = choices.withColumnsRenamed({"start": "begins", "goal": "ends", "illegal": "all_illegal"})
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("number") == F.col("n"))
    joined = cut.join(chosen, same).select(
        "conv_id", "part", "number", "cost", F.col("all_illegal").alias("illegal"), "lines", way.alias("audit"),
        F.col("begins").alias("start"), "tail",
    )
    schema = f"conv_id {kind}, part int, number bigint, cost bigint, illegal bigint, audit string, piece string"
    return joined.mapInArrow(run, schema)


def _digests(pieces: DataFrame) -> DataFrame:
    """``c, cost, illegal, audit, repaired_sha256`` of each conversation, its pieces taken in order."""
    kind = pieces.schema["conv_id"].dataType.simpleString()
    names = ["c", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, begun, ready, id_type = None, False, [], None
        digest, audits, cost, illegal, something = hashlib.sha256(), [], 0, 0, False

        def out() -> pa.RecordBatch:
            types = [id_type, pa.int64(), pa.int64(), pa.string(), pa.string()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), types)], names=names)
            ready.clear()
            return batch

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for conv, more, bad, audit, piece in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or conv != current:
                    if begun:
                        ready.append((current, illegal, cost, "".join(audits), digest.hexdigest()))
                    current, begun = conv, True
                    digest, audits, cost, illegal, something = hashlib.sha256(), [], 0, 0, False
                cost, illegal = cost + more, illegal + bad
                audits.append(audit)
                if piece:
                    digest.update((("\n" if something else "") + piece[:-1]).encode())
                    something = True
            if ready:
                yield out()
        if begun:
            ready.append((current, illegal, cost, "".join(audits), digest.hexdigest()))
            yield out()

    order = [F.asc_nulls_first(c) for c in ("conv_id", "part", "number")]
    dealt = pieces.repartition("conv_id").sortWithinPartitions(*order)
    schema = f"c {kind}, illegal bigint, cost bigint, audit string, repaired_sha256 string"
    return dealt.select("conv_id", "cost", "illegal", "audit", "piece").mapInArrow(run, schema)


def repair(turns: DataFrame, size: int = SEGMENT) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every conversation."""
    rows = stored(faults(damaged(turns)), "repair-faults")
    cut = stored(segments(rows, size), "repair-segments")
    found = _digests(_pieces(cut, stored(_choices(cut), "repair-choices")))
    counts = _counts(rows).withColumnRenamed("conv_id", "d")
    zeros = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    # One row per conversation on each side.
    return (
        turns.select("conv_id")
        .distinct()
        .join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left")
        .join(counts, F.col("conv_id").eqNullSafe(F.col("d")), "left")
        .select(
            "conv_id",
            *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in zeros],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
        )
    )
