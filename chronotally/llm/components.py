"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronotally.llm.tables import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for each node that a link names: the least node it can reach.

    In each round every root takes on the least root that it is linked with, chains of such steps
    are shortened by halves, and links are moved to the roots, until none is left between two.
    Links and roots are tables in the shared folder throughout; the driver sees counts. A table with
    a row for each node joins one with a row for each link, so a node with very many links is
    a skewed join that Spark splits. Null ends link nothing.
    """
    ends = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    open_links = stored(
        ends.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "component-links"
    )
    roots = None
    while not open_links.isEmpty():
        both = open_links.unionByName(open_links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root"))
        step = _shortened(stored(step, "component-steps"))
        if roots is None:
            roots = step
        else:
            moved = step.select(F.col("node").alias("n"), F.col("root").alias("r"))
            roots = stored(
                roots.join(moved, F.col("root") == F.col("n"), "left").select("node", F.coalesce("r", "root").alias("root")),
                "component-roots",
            )
        ra = step.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        rb = step.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        left = open_links.join(ra, "a").join(rb, "b").filter("ra != rb")
        open_links = stored(left.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "component-links")
    if roots is None:
        return open_links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


def _shortened(step: DataFrame) -> DataFrame:
    """Chains of steps followed to their end, each pass twice as far."""
    while True:
        ahead = step.filter("node != root").select(F.col("node").alias("n"), F.col("root").alias("r"))
        further = step.join(ahead, F.col("root") == F.col("n"), "left").select(
            "node", F.coalesce("r", "root").alias("root"), F.col("r").isNotNull().alias("moved")
        )
        further = stored(further, "component-steps")
        if further.filter("moved").isEmpty():
            return step
        step = further.select("node", "root")
