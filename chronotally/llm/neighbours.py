"""Nearest neighbours by cosine, from balanced posting lists.

* **Lists.** Centroids come from a bounded sample (``sample`` vectors): it is halved again and
  again, each time across the line between two means and at the median, so that all lists hold
  equally many vectors of the sample.
* **Boundaries.** Every vector goes to the list of its nearest centroid and to others that are
  nearly as near (``replicas`` at most), but for centroids that lie nearer to one already taken
  than to the vector.
* **Search.** A query walks a graph in which each centroid knows its nearest ones, best first, and
  takes the lists whose centroid is at most ``ratio`` times as far as the nearest one.
* **Lists of any length.** A list is dealt into chunks of about ``chunk`` vectors; a query meets all chunks
  of its lists, and its best of each are merged.

Equal vectors are one entry with their ``k + 1`` smallest ids: no other of them can be among the
``k`` nearest of anything, as all have the same score and ties go to the smaller id. Equal queries
are searched once. Scores are worked out in double precision from the original vectors.

Vectors that are null, zero, of another length than most of the sample, or hold a null or
non-finite component take no part, as query or as candidate; so do rows without an id. Rows with an id
that came before are candidates of their own under that id. Other columns are ignored, whatever
their names. Fewer candidates than ``k`` give as many rows; an empty table gives none.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotally.llm.tables import stored

SAMPLE = 16_384


@dataclass
class Lists:
    """Centroids of length one and the graph over them."""

    centroids: np.ndarray
    graph: np.ndarray

    @staticmethod
    def of(sample: np.ndarray, lists: int, degree: int = 16, seed: int = 11) -> Lists:
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        draw = np.random.default_rng(seed)
        leaves = [np.arange(len(unit))]
        while len(leaves) < lists:
            largest = max(range(len(leaves)), key=lambda i: len(leaves[i]))
            if len(leaves[largest]) < 2:
                break
            leaf = leaves.pop(largest)
            a, b = unit[draw.choice(leaf, 2, replace=False)]
            for _ in range(6):
                side = unit[leaf] @ (a - b)
                upper = side >= np.median(side)
                if upper.all() or not upper.any():
                    break
                a, b = unit[leaf[upper]].mean(0), unit[leaf[~upper]].mean(0)
            order = leaf[np.argsort(unit[leaf] @ (a - b), kind="stable")]
            leaves += [order[: len(order) // 2], order[len(order) // 2 :]]
        means = np.array([unit[leaf].mean(0) for leaf in leaves])
        size = np.linalg.norm(means, axis=1, keepdims=True)
        centroids = np.where(size > 1e-12, means / np.maximum(size, 1e-12), unit[[leaf[0] for leaf in leaves]])
        near = np.argsort(-(centroids @ centroids.T), axis=1, kind="stable")[:, : degree + 1]
        return Lists(centroids, near[:, 1:])

    def assign(self, unit: np.ndarray, replicas: int, slack: float) -> Iterator[tuple[int, int]]:
        """``(vector, list)`` for each list that a vector goes to."""
        between = self.centroids @ self.centroids.T
        for at in range(0, len(unit), 2048):
            near = unit[at : at + 2048] @ self.centroids.T
            first = np.argsort(-near, axis=1, kind="stable")[:, : 4 * replicas]
            for i, row in enumerate(first.tolist()):
                scores = near[i]
                bound = 1 - (1 - scores[row[0]]) * slack
                taken: list[int] = []
                for c in row:
                    if scores[c] < bound and taken or len(taken) == replicas:
                        break
                    if all(between[c, t] < scores[c] for t in taken):
                        taken.append(c)
                for c in taken:
                    yield at + i, c

    def search(self, unit: np.ndarray, most: int, ratio: float) -> list[int]:
        """The lists for one query: best first through the graph, then pruned by distance."""
        starts = range(0, len(self.centroids), max(1, len(self.centroids) // 8))
        seen = set(starts)
        found: list[tuple[float, int]] = []  # the worst on top
        todo = []
        for c in starts:
            far = 1 - float(self.centroids[c] @ unit)
            todo.append((far, c))
            found.append((-far, c))
        heapq.heapify(todo)
        heapq.heapify(found)
        while todo:
            far, c = heapq.heappop(todo)
            if len(found) >= most and far > -found[0][0]:
                break
            new = [x for x in self.graph[c].tolist() if x not in seen]
            seen.update(new)
            for x, d in zip(new, (1 - self.centroids[new] @ unit).tolist() if new else []):
                if len(found) < most or d < -found[0][0]:
                    heapq.heappush(todo, (d, x))
                    heapq.heappush(found, (-d, x))
                    if len(found) > most:
                        heapq.heappop(found)
        nearest = -max(found)[0]
        return [c for far, c in found if -far <= ratio * nearest + 1e-9]


def usable(vector: Column) -> Column:
    """Whether a vector may take part, its length aside."""
    number = vector.cast("array<double>")
    finite = F.forall(number, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(number, lambda x: x != 0)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    sample: int = SAMPLE,
    replicas: int = 4,
    slack: float = 1.25,
    most_lists: int = 48,
    ratio: float = 1.5,
    chunk: int = 4096,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found for each row that ``queries``, a
    condition on the input's columns, picks. A row is not its own candidate."""
    rows = vectors.select(
        F.col(vec_id).cast("bigint").alias("id"),
        F.col(vector).cast("array<double>").alias("v"),
        F.coalesce(queries, F.lit(False)).alias("asked"),
    ).filter(F.col("id").isNotNull() & usable(F.col("v")))
    rows = rows.withColumns({"a": F.xxhash64("v"), "b": F.xxhash64(F.lit(1), "v")})
    some = rows.select("v").orderBy("a", "b").limit(sample).collect()
    out = "query_id bigint, rank int, vec_id bigint, score double"
    if not some:
        return vectors.sparkSession.createDataFrame([], out)
    length = Counter(len(r.v) for r in some).most_common(1)[0][0]
    rows = rows.filter(F.size("v") == length)
    learned = np.array([r.v for r in some if len(r.v) == length])
    lists = Lists.of(learned, max(8, min(4096, len(learned) // 64)))

    # Equal vectors: the k + 1 smallest ids. Spark keeps the first ranks before it moves rows.
    first = F.row_number().over(Window.partitionBy("a", "b").orderBy("id"))
    entries = stored(
        rows.select("id", "v", "a", "b")
        .withColumn("n", first)
        .filter(F.col("n") <= k + 1)
        .groupBy("a", "b")
        .agg(F.first("v").alias("v"), F.array_sort(F.collect_list("id")).alias("ids")),
        "neighbour-entries",
    )
    asked = rows.filter("asked").select("a", "b", "v").dropDuplicates(["a", "b"])

    def to_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                v = _matrix(batch.column("v"))
                pairs = list(lists.assign(v / np.linalg.norm(v, axis=1, keepdims=True), replicas, slack))
                take, of = (pa.array(x, pa.int32()) for x in zip(*pairs))
                # The first of a vector's lists, which all of its others come after.
                first = pa.array([i == 0 or pairs[i - 1][0] != at for i, (at, _) in enumerate(pairs)])
                yield pa.RecordBatch.from_arrays(
                    [*batch.take(take).columns, of, first], names=[*batch.schema.names, "list", "first"]
                )

    def to_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                v = _matrix(batch.column("v"))
                unit = v / np.linalg.norm(v, axis=1, keepdims=True)
                pairs = [(i, c) for i, u in enumerate(unit) for c in enough(u, lists.search(u, most_lists, ratio))]
                take, of = (pa.array(x, pa.int32()) for x in zip(*pairs))
                yield pa.RecordBatch.from_arrays([*batch.take(take).columns, of], names=[*batch.schema.names, "list"])

    def enough(unit: np.ndarray, picked: list[int]) -> list[int]:
        """The lists picked and, if they are too few vectors, the next nearest until ``k + 1`` are held."""
        vectors = sum(held.get(c, 0) for c in picked)
        if vectors <= k:
            for c in np.argsort(-(lists.centroids @ unit), kind="stable").tolist():
                if vectors <= k and c not in picked:
                    picked.append(c)
                    vectors += held.get(c, 0)
        return picked

    posted = stored(
        entries.mapInArrow(to_lists, "a bigint, b bigint, v array<double>, ids array<bigint>, list int, first boolean"),
        "neighbour-lists",
    )
    # At most 4,096 numbers of each, as there are no more lists.
    counted = posted.groupBy("list").agg(F.count("*").alias("n"), F.count_if("first").alias("held")).collect()
    sizes, held = {r.list: -(-r.n // chunk) for r in counted}, {r.list: r.held for r in counted}
    posted = posted.drop("first")
    chunks = F.element_at(F.array(*[F.lit(sizes.get(c, 0)) for c in range(len(lists.centroids))]), F.col("list") + 1)
    posted = posted.withColumn("chunk", F.pmod("a", chunks))
    routed = (
        asked.mapInArrow(to_queries, "a bigint, b bigint, v array<double>, list int")
        .withColumn("chunks", chunks)
        .filter("chunks > 0")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks").cast("bigint") - 1)))
        .drop("chunks")
    )

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        found: dict[str, list] = {"a": [], "b": [], "id": [], "score": []}
        if len(left) and len(right):
            v, q = _matrix(left.column("v")), _matrix(right.column("v"))
            v_size, q_size = np.linalg.norm(v, axis=1), np.linalg.norm(q, axis=1)
            ids = left.column("ids").to_pylist()
            names = list(zip(right.column("a").to_pylist(), right.column("b").to_pylist()))
            wide = min(len(v), k + 8)
            for at in range(0, len(q), 256):
                near = (q[at : at + 256] @ v.T) / v_size
                top = np.argpartition(-near, wide - 1, axis=1)[:, :wide]
                for i, row in enumerate(top):
                    j = at + i
                    scores = (v[row] * q[j]).sum(1) / (v_size[row] * q_size[j])
                    pairs = sorted((-s, x) for s, r in zip(scores.tolist(), row.tolist()) for x in ids[r])[: k + 1]
                    for s, x in pairs:
                        found["a"].append(names[j][0])
                        found["b"].append(names[j][1])
                        found["id"].append(x)
                        found["score"].append(-s)
        kinds = {"a": pa.int64(), "b": pa.int64(), "id": pa.int64(), "score": pa.float64()}
        return pa.table({c: pa.array(x, kinds[c]) for c, x in found.items()})

    keys = ["list", "chunk"]
    pairs = posted.groupBy(*keys).cogroup(routed.groupBy(*keys)).applyInArrow(
        best, "a bigint, b bigint, id bigint, score double"
    )
    once = pairs.groupBy("a", "b", "id").agg(F.max("score").alias("score"))
    by_score = Window.partitionBy("a", "b").orderBy(F.desc("score"), "id")
    top = once.withColumn("n", F.row_number().over(by_score)).filter(F.col("n") <= k + 1)
    answers = top.groupBy("a", "b").agg(F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("best"))
    each = rows.filter("asked").select(F.col("id").alias("query_id"), "a", "b").join(answers, ["a", "b"])
    others = F.slice(F.filter("best", lambda x: x["id"] != F.col("query_id")), 1, k)
    return each.select("query_id", F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score")
    )
