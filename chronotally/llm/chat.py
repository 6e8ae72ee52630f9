"""Chat logs that hold every state of a conversation, collapsed to the last and rendered.

A log often stores a conversation again after each turn. Each turn's hash takes in its position,
role and text; the sum over the first k turns is the hash of that prefix and rolls on by one term a
turn. A conversation goes if its whole hash is the hash of a shorter stretch of a longer one: an
anti-join on the number of turns and the hash. Of equal conversations the one with the least id
stays. Both sides of the join are distinct, so neither a first turn that thousands share nor
thousands of copies meet in one place. Sums are kept modulo 2**64 as two halves, twice, with two hashes.

Turns are ordered by turn (nulls first), role and text; their position in that order counts, not
the number. Turns are summed in runs of 1,024 turn numbers first, so that a conversation that
never ends is no single task's work. A null role or text is unlike an empty one for the hash and
renders as empty. Rows with a null ``conv_id`` are one conversation. Repeated rows are turns of
their own. An empty table gives no rows. Other columns are left out, whatever their names.

Rendering gives ``part`` 0, 1, ... of each conversation, ``turns_per_part`` turns each. Markers are told
from text that looks like them: ``<|`` in a text becomes ``<\\|`` and ``|>`` in a role ``|\\>``, and where
such backslashes stand already there is one more. ``parsed`` restores the turns; a null role or text
comes back empty.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotally.llm.tables import stored

RUN = 1024
_TURN = r"(?s)<\|(.*?)\|>\n(.*?)<\|end\|>\n"
_LOW = 0xFFFFFFFF
_HASHES = ("h0", "h1", "h2", "h3")


def _carried(cols: dict[str, Column]) -> dict[str, Column]:
    """Sums of 32-bit halves, each cut to 32 bits: no sum of a billion of them overflows."""
    return {name: F.pmod(col, F.lit(_LOW + 1)) for name, col in cols.items()}


def prefixes(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, position`` (from 1), ``role, text, n_turns`` and the hash of the turns so far."""
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).cast("bigint").alias("turn"),
        F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
    ).withColumn("run", F.floor(F.col("turn") / RUN))
    order = ["turn", "role", "text"]
    in_run = Window.partitionBy("conv_id", "run").orderBy(*order)
    totals = rows.groupBy("conv_id", "run").agg(F.count("*").alias("n"))
    over = Window.partitionBy("conv_id").orderBy("run")
    ahead = totals.select(
        F.col("conv_id").alias("c"),
        F.col("run").alias("r"),
        F.coalesce(F.sum("n").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("run").eqNullSafe(F.col("r"))
    placed = (
        rows.withColumn("in_run", F.row_number().over(in_run))
        .join(ahead, same)
        .withColumn("position", F.col("ahead") + F.col("in_run"))
        .drop("c", "r", "ahead")
    )
    term = (F.col("position"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text"))
    one, two = F.xxhash64(F.lit(1), *term), F.xxhash64(F.lit(2), *term)
    halves = {
        "h0": one.bitwiseAND(F.lit(_LOW)),
        "h1": F.shiftrightunsigned(one, 32),
        "h2": two.bitwiseAND(F.lit(_LOW)),
        "h3": F.shiftrightunsigned(two, 32),
    }
    hashed = placed.withColumns(halves)
    sums = hashed.groupBy("conv_id", "run").agg(*[F.sum(h).alias(h) for h in _HASHES])
    before = sums.select(
        F.col("conv_id").alias("c"),
        F.col("run").alias("r"),
        *[
            F.coalesce(F.sum(h).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"{h}_ahead")
            for h in _HASHES
        ],
    )
    so_far = Window.partitionBy("conv_id", "run").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    rolled = hashed.withColumns({h: F.sum(h).over(so_far) for h in _HASHES}).join(before, same)
    return rolled.select(
        "conv_id", "position", "role", "text", "n_turns",
        *[c.alias(h) for h, c in _carried({h: F.col(h) + F.col(f"{h}_ahead") for h in _HASHES}).items()],
    )


def maximal(prefixed: DataFrame) -> DataFrame:
    """``conv_id, n_turns`` and the number of copies (``n_copies``) of the conversations that stay."""
    keys = ["position", *_HASHES]
    whole = (
        prefixed.filter("position = n_turns")
        .groupBy(*keys)
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    )
    shorter = prefixed.filter("position < n_turns").select(*keys).distinct()
    return whole.join(shorter, keys, "left_anti").select("conv_id", F.col("position").alias("n_turns"), "n_copies")


def _plain(value: Column, begin: str, end: str) -> Column:
    """Text in which ``begin`` and ``end`` never stand side by side: a backslash is put between."""
    return F.regexp_replace(F.coalesce(value, F.lit("")), rf"{re.escape(begin)}(\\*){re.escape(end)}", rf"{begin}\\$1{end}")


def _restored(value: Column, begin: str, end: str) -> Column:
    return F.regexp_replace(value, rf"{re.escape(begin)}\\(\\*){re.escape(end)}", f"{begin}$1{end}")


def rendered(prefixed: DataFrame, kept: DataFrame, turns_per_part: int = 512) -> DataFrame:
    """``conv_id, part, n_turns, n_copies, text`` of the conversations that stay: each turn is
    ``<|role|>``, a line break, its text, ``<|end|>`` and a line break."""
    kept = kept.select(F.col("conv_id").alias("c"), "n_copies")
    turn = F.concat(
        F.lit("<|"), _plain(F.col("role"), "|", ">"), F.lit("|>\n"), _plain(F.col("text"), "<", "|"), F.lit("<|end|>\n")
    )
    stay = prefixed.join(kept, F.col("conv_id").eqNullSafe(F.col("c")))
    pieces = stay.select(
        "conv_id", "n_turns", "n_copies", "position", turn.alias("turn"),
        F.floor((F.col("position") - 1) / turns_per_part).alias("part"),
    )
    in_order = F.array_sort(F.collect_list(F.struct("position", "turn")))
    return (
        pieces.groupBy("conv_id", "part", "n_turns", "n_copies")
        .agg(F.array_join(in_order["turn"], "").alias("text"))
        .select("conv_id", "part", "n_turns", "n_copies", "text")
    )


def parsed(parts: DataFrame, turns_per_part: int = 512) -> DataFrame:
    """``conv_id, position, role, text`` of rendered parts, the turns they were made of."""
    found = F.arrays_zip(*[F.regexp_extract_all("text", F.lit(_TURN), F.lit(i)).alias(f"x{i}") for i in (1, 2)])
    turns = parts.select("conv_id", "part", F.posexplode(found).alias("at", "turn"))
    return turns.select(
        "conv_id",
        (F.col("part") * turns_per_part + F.col("at") + 1).alias("position"),
        _restored(F.col("turn.x1"), "|", ">").alias("role"),
        _restored(F.col("turn.x2"), "<", "|").alias("text"),
    )


def collapse(turns: DataFrame, turns_per_part: int = 512, **columns: str) -> DataFrame:
    """Conversations that no longer one begins with, rendered. The prefixes are worked out once."""
    prefixed = stored(prefixes(turns, **columns), "chat-prefixes")
    return rendered(prefixed, maximal(prefixed), turns_per_part)
