"""How filters overlap: what each removes at each step of every order they can be applied in.

A document's mask says which filters it fails. In an order of the filters it goes at the first one in its
mask. All orders that begin alike stand side by side in lexicographic order, so each prefix of an
order is one interval of ranks (its Lehmer code gives the first one). For a mask, the orders that
remove it at step ``s`` are the intervals of prefixes of ``s`` filters of which the last alone is
in the mask. Counts by mask are added where such an interval begins and taken off behind its end; a
running sum over the ranks then gives the counts of every order. No document meets an order.

Texts are read once, by built-in functions. What goes on is a digest of the text, the filters it
fails, and its labels: equal texts fail the same filters, so of each digest only the number of rows
by part and label, and the rows with the least id, are needed. Rows are summed up before they move,
so a text that a third of all rows have sends a row per task and part.

Null texts are empty, with no words. A null id is smaller than none, and no other is smaller than
it. Rows with equal id and text are no copies of each other. Repeated labels of an id count once,
as if it had each of them. A null part is an empty string. An empty table gives no rows. Columns
other than those named are not read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotally.llm.tables import stored

FILTERS = "ABCDE"
_COPY = "E"
_SPACE = r"[\x20\x09-\x0D]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def failures(
    text: Column,
    least_words: int = 100,
    least_distinct: int = 80,
    most_capitals: int = 10,
    symbols: str = "[#$%&*|]",
) -> dict[str, Column]:
    """Whether a text fails A (too few words), B (too few distinct ones, in percent), C (too many
    capital letters, in percent of characters) or D (holds a symbol)."""
    words = F.array_remove(F.split(text, _SPACE), "")
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    return {
        "A": F.size(words) < least_words,
        "B": 100 * F.size(F.array_distinct(words)) < least_distinct * F.size(words),
        "C": 100 * capitals > most_capitals * F.length(text),
        "D": text.rlike(symbols),
    }


def orders(filters: str = FILTERS) -> list[str]:
    """All orders, each at its rank."""
    return ["".join(p) for p in permutations(sorted(filters))]


def intervals(filters: str = FILTERS) -> list[tuple[int, int, int, int, bool, bool]]:
    """``mask, step, begin, end, first, alone``: in the orders of rank ``begin`` to ``end - 1`` the filter
    at ``step`` is in the mask; whether it is the first that is, and whether it is the only one."""
    names, found = sorted(filters), []
    n = len(names)
    for mask in range(1, 2**n):
        inside = {f for i, f in enumerate(names) if mask >> i & 1}
        for step in range(1, n + 1):
            for prefix in permutations(names, step):
                if prefix[-1] not in inside:
                    continue
                left, begin = list(names), 0
                for place, f in enumerate(prefix):
                    begin += left.index(f) * factorial(n - 1 - place)
                    left.remove(f)
                first = not inside.intersection(prefix[:-1])
                found.append((mask, step, begin, begin + factorial(n - step), first, len(inside) == 1))
    return found


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, docs, good, toxic``: rows by the filters they fail, the lowest bit for A."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bits = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(failures(text).values())), F.lit(0))
    rows = (
        docs.select(
            "doc_id",
            F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            bits.cast("int").alias("bits"),
        )
        .groupBy("digest", "doc_id", "part", "bits")
        .agg(F.count("*").alias("n"))
    )
    known = (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(
            F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
            F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
        )
        .filter("good or toxic")
    )
    # Both sides of the join come straight out of an exchange, so that Spark can split a hot id.
    known = stored(known, "audit-labels")
    marked = rows.join(known, F.col("doc_id") == F.col("labelled"), "left").select(
        "digest", "doc_id", "part", "bits", "n",
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )
    # A group by digest and label has the rows of one id with its least id once, so the least pair of
    # id and number of rows tells how many rows have that id. Without an id a row is no copy.
    named = F.col("doc_id").isNotNull()
    groups = marked.groupBy("digest", "part", "bits", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(~named, F.col("n"))), F.lit(0)).alias("unnamed"),
        F.min(F.when(named, F.struct("doc_id", "n"))).alias("least"),
    )
    least = F.min("least.doc_id").over(Window.partitionBy("digest"))
    originals = F.col("unnamed") + F.when(F.col("least.doc_id") == F.col("least_id"), F.col("least.n")).otherwise(0)
    counted = groups.withColumn("least_id", least).withColumn("originals", originals)
    copy = 1 << FILTERS.index(_COPY)
    both = F.array(
        F.struct(F.col("bits").alias("mask"), F.col("originals").alias("rows")),
        F.struct((F.col("bits") + copy).alias("mask"), (F.col("n") - F.col("originals")).alias("rows")),
    )
    return (
        counted.select("part", "good", "toxic", F.explode(both).alias("x"))
        .groupBy("part", F.col("x.mask").alias("mask"))
        .agg(
            F.sum("x.rows").alias("docs"),
            F.sum(F.when(F.col("good"), F.col("x.rows")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("toxic"), F.col("x.rows")).otherwise(0)).alias("toxic"),
        )
    )


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """From rows by part and mask: one row per part, order and step, zeros included."""
    spark, ranked, steps = counts.sparkSession, orders(filters), len(filters)
    ends = [
        (mask, step, rank, sign, first, alone)
        for mask, step, begin, end, first, alone in intervals(filters)
        for rank, sign in ((begin, 1), (end, -1))
        if rank < len(ranked)
    ]
    # As many rows as the filters make, however large the table is.
    ends = spark.createDataFrame(ends, "mask int, step int, rank int, sign int, first boolean, alone boolean")

    def change(value: str, when: Column) -> Column:
        return F.when(when, F.col("sign") * F.col(value)).otherwise(0)

    changes = counts.join(F.broadcast(ends), "mask").select(
        "part", "rank", "step", F.lit(0).cast("bigint").alias("total"),
        change("docs", F.col("first")).alias("removed"),
        change("docs", ~F.col("first")).alias("redundant"),
        change("docs", F.col("alone")).alias("unique_fails"),
        change("good", F.col("first")).alias("good_lost"),
        change("toxic", F.col("first")).alias("toxic_lost"),
    )
    sums = ["removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    grid = (
        counts.groupBy("part")
        .agg(F.sum("docs").alias("total"))
        .select("part", "total", F.explode(F.sequence(F.lit(0), F.lit(len(ranked) - 1))).alias("rank"))
        .select("part", "total", "rank", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
        .withColumns({c: F.lit(0).cast("bigint") for c in sums})
    )
    totals = grid.unionByName(changes).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in ["total", *sums]])
    ahead = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    order = F.element_at(F.array(*map(F.lit, ranked)), F.col("rank") + 1)
    running = totals.withColumns({c: F.sum(c).over(ahead) for c in sums}).withColumn("filter_order", order)
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    return (
        running.withColumn("kept", F.col("total") - F.sum("removed").over(so_far))
        .withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", letter)))
        .select("part", "filter_order", "step", "kept", *sums, "shapley")
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The interactions of the five filters over all documents."""
    return interactions(stored(masks(docs, labels), "audit-masks"))
