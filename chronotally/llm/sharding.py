"""Shards of exact size in a uniformly random order, by a matrix drawn before rows move.

Rows lie in blocks, by a hash. How many rows of each block go to each shard follows the law a
uniform shuffle would give: the counts are drawn from it, block by block, each a hypergeometric
draw from what the shards still lack. Then each block is permuted on its own and dealt out by its
counts, rows move once, and each shard is permuted again, bucket by bucket, which numbers its slots.
No step sorts the whole table or holds a shard in one task. Only numbers of rows go through all this;
the rows themselves move once, to meet their places.

Everything is DataFrame functions. Draws invert a uniform number, hashed from the seed, the block and
the shard, over the weights of all outcomes within twelve standard deviations of the likeliest;
what lies beyond is less than a double can tell from nothing. Blocks form a tree: the rows of a
node go to the shards as drawn for it, and the next draws divide them among its ``group`` children, so that
draws of one level are independent tasks and none holds more than a few nodes.

Law ``rows``: the counts of the shards differ by one at most; the first ones have the extra row.

Rows with equal ids and texts may stand for one another, and the order is as random for them as for any: each
has a number among its equals, by input partition and place there, and is hashed with it. Equal rows are counted
within input partitions first, so that no task holds all of them. A null text has no bytes and the checksum
of none; null ids are hashed as any value. An empty table gives no rows. Input columns named like a
result are replaced; all others are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotally.llm.tables import stored, without

COLUMNS = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _unit(*parts: Column | int) -> Column:
    """A uniform number in (0, 1) from a hash."""
    whole = F.xxhash64(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return (F.pmod(whole, F.lit(1 << 52)) + 0.5) / float(1 << 52)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def hypergeometric(pool: Column, good: Column, draws: Column, unit: Column) -> Column:
    """How many of ``draws`` from ``pool`` are among its ``good``, for a uniform number."""
    n, g, d = (c.cast("double") for c in (pool, good, draws))
    low, high = F.greatest(F.lit(0), draws - (pool - good)), F.least(draws, good)
    mode = F.least(high, F.greatest(low, F.floor((d + 1) * (g + 1) / (n + 2))))
    spread = F.when(pool > 1, F.sqrt(d * (g / n) * (1 - g / n) * (n - d) / (n - 1))).otherwise(0.0)
    reach = F.ceil(spread * 12) + 30

    def ratio(k: Column) -> Column:
        """The weight of k + 1 by that of k."""
        return (g - k) * (d - k) / ((k + 1) * (n - g - d + k + 1))

    def walk(m: Column, top: Column, bottom: Column) -> Column:
        up, down = F.sequence(m, top), F.sequence(m, bottom)

        def total(steps: Column, last: Column, by) -> Column:
            start = F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("w"))
            add = lambda acc, k: F.struct(
                (acc["sum"] + acc["w"]).alias("sum"), F.when(k == last, 0.0).otherwise(acc["w"] * by(k)).alias("w")
            )
            return F.aggregate(steps, start, add)["sum"]

        def find(steps: Column, last: Column, by, aim: Column) -> Column:
            start = F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("w"), last.alias("at"), F.lit(False).alias("done"))
            add = lambda acc, k: F.struct(
                (acc["sum"] + acc["w"]).alias("sum"),
                F.when(k == last, 0.0).otherwise(acc["w"] * by(k)).alias("w"),
                F.when(~acc["done"] & (acc["sum"] + acc["w"] > aim), k).otherwise(acc["at"]).alias("at"),
                (acc["done"] | (acc["sum"] + acc["w"] > aim)).alias("done"),
            )
            return F.aggregate(steps, start, add)["at"]

        back = lambda k: F.lit(1.0) / ratio(k - 1)
        sums = F.struct(total(up, top, ratio).alias("up"), total(down, bottom, back).alias("down"))
        return _let(
            sums,
            lambda s: _let(
                unit * (s["up"] + s["down"] - 1),  # the mode is in both sums
                lambda aim: F.when(aim < s["up"], find(up, top, ratio, aim)).otherwise(
                    find(down, bottom, back, aim - s["up"] + 1)
                ),
            ),
        )

    bounds = F.struct(mode.alias("m"), F.least(high, mode + reach).alias("t"), F.greatest(low, mode - reach).alias("b"))
    drawn = _let(bounds, lambda x: walk(x["m"], x["t"], x["b"]))
    return F.when(low == high, low).otherwise(drawn).cast("bigint")


def _deal(parts: Column, capacity: Column, shards: int, seed: int, level: int) -> Column:
    """Counts for each part (``id``, ``n``) and shard, drawn part by part from ``capacity``."""

    def one(left: Column, part: Column) -> Column:
        start = F.struct(
            part["n"].alias("need"),
            F.aggregate(left, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("pool"),
            F.array().cast("array<bigint>").alias("out"),
        )

        def draw(acc: Column, j: Column) -> Column:
            good = F.element_at(left, (j + 1).cast("int"))
            x = hypergeometric(acc["pool"], good, acc["need"], _unit(seed, level, part["id"], j))
            return _let(
                x,
                lambda x: F.struct(
                    (acc["need"] - x).alias("need"),
                    (acc["pool"] - good).alias("pool"),
                    F.concat(acc["out"], F.array(x)).alias("out"),
                ),
            )

        return F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), start, draw)["out"]

    kind = "array<struct<id:bigint,counts:array<bigint>>>"
    start = F.struct(capacity.alias("left"), F.array().cast(kind).alias("out"))

    def step(acc: Column, part: Column) -> Column:
        return _let(
            one(acc["left"], part),
            lambda got: F.struct(
                F.zip_with(acc["left"], got, lambda a, b: a - b).alias("left"),
                F.concat(acc["out"], F.array(F.struct(part["id"].alias("id"), got.alias("counts")))).alias("out"),
            ),
        )

    return F.aggregate(parts, start, step)["out"]


def communication_matrix(counts: DataFrame, shards: int, seed: int, group: int) -> DataFrame:
    """``block, counts`` (rows for each shard) from ``block, n``, blocks numbered from 0. ``group`` nodes of
    the tree over the blocks share a parent. Counts over all blocks differ by one at most between shards."""

    def level(i: int) -> DataFrame:
        return counts.groupBy(F.floor(F.col("block") / group**i).cast("bigint").alias("id")).agg(F.sum("n").alias("n"))

    last = counts.agg(F.max("block")).first()[0] or 0
    levels = 1
    while last // group**levels:
        levels += 1
    sizes = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda j: F.floor(F.col("n") / shards).cast("bigint") + (j < F.col("n") % shards).cast("bigint"),
    )
    dealt = level(levels).select("id", sizes.alias("counts"))
    for i in reversed(range(levels)):
        children = level(i).groupBy(F.floor(F.col("id") / group).cast("bigint").alias("parent"))
        parts = children.agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("parts"))
        above = dealt.select(F.col("id").alias("parent"), F.col("counts").alias("capacity"))
        drawn = F.explode(_deal(F.col("parts"), F.col("capacity"), shards, seed, i))
        dealt = parts.join(above, "parent").select(drawn.alias("d")).select("d.id", "d.counts")
    return dealt.withColumnRenamed("id", "block")


def _numbered(rows: DataFrame) -> DataFrame:
    """``mark, key, copy``: the rows of a key are numbered from 1, over all input partitions."""
    here = Window.partitionBy("key", "partition")
    within = rows.select("mark", "key", "partition", F.row_number().over(here.orderBy("mark")).alias("at"))
    upto = F.sum("n").over(Window.partitionBy("key").orderBy("partition").rowsBetween(Window.unboundedPreceding, -1))
    before = (
        rows.groupBy("key", "partition").agg(F.count("*").alias("n"))
        .select("key", "partition", upto.alias("before")).filter("before > 0")
    )
    return within.join(before, ["key", "partition"], "left").select(
        "mark", "key", (F.col("at") + F.coalesce("before", F.lit(0))).alias("copy")
    )


def shuffled_shards(
    docs: DataFrame,
    shards: int = 8,
    seed: int = 20240229,
    rows_per_block: int = 4096,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes and one), ``text_crc32, law, shard, slot`` (gapless from
    0 in each shard, a uniformly random order) and ``grown_shard`` (null under this law). ``carry`` names the
    columns of ``docs`` to keep, all by default."""
    columns = without(docs, COLUMNS).columns if carry is None else carry
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("whole"),
        (F.octet_length(raw) + 1).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.xxhash64(F.col(doc_id), raw).alias("key"),
        F.spark_partition_id().alias("partition"),
        F.monotonically_increasing_id().alias("mark"),
    )
    # Written once, so that a row keeps its number whatever is lost later.
    rows = stored(rows, "shard-rows")
    blocks = max(1, -(-rows.count() // rows_per_block))
    one = ("key", "copy")
    hashed = _numbered(rows).select(
        "mark",
        *one,
        F.pmod(F.xxhash64(F.lit(seed + 2), *one), F.lit(blocks)).alias("block"),
        F.xxhash64(F.lit(seed + 3), *one).alias("first"),
        F.xxhash64(F.lit(seed + 4), *one).alias("second"),
    )
    hashed = stored(hashed, "shard-numbers")
    counts = stored(hashed.groupBy("block").agg(F.count("*").alias("n")), "shard-blocks")
    matrix = communication_matrix(counts, shards, seed, group=16)
    sums = F.aggregate(
        "counts",
        F.array().cast("array<bigint>"),
        lambda acc, x: F.concat(acc, F.array(x + F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)))),
    )
    deal = matrix.select("block", sums.alias("deal"))

    permuted = hashed.withColumn("at", F.row_number().over(Window.partitionBy("block").orderBy("first", *one)))
    dealt = permuted.join(deal, "block").withColumn("shard", F.size(F.filter("deal", lambda upto: upto < F.col("at"))))
    buckets = max(1, -(-blocks // shards))
    # Any hash bucket is as likely as any other, so buckets one after the other are a random order.
    dealt = dealt.withColumn("bucket", F.pmod("second", F.lit(buckets)))
    before = (
        dealt.groupBy("shard", "bucket")
        .agg(F.count("*").alias("n"))
        .withColumn(
            "before",
            F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
        )
        .select("shard", "bucket", F.coalesce("before", F.lit(0)).alias("before"))
    )
    number = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("second", *one))
    placed = dealt.withColumn("at", number).join(before, ["shard", "bucket"])
    placed = placed.select("mark", "shard", (F.col("before") + F.col("at") - 1).alias("slot"))
    return rows.join(placed, "mark").select(
        *[F.col("whole").getField(c).alias(c) for c in columns],
        "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
