"""Lines that repeat an earlier one, up to one edit of a word, by deletion neighbourhoods.

Lines are compared by their words, A-Z as a-z. The edit bound is one word put in, left out or replaced,
for lines of at least ``near_words`` words; shorter ones must be equal. A line goes if an earlier
line is within the bound, whether that one stays or not. Earlier is by document id (null first), then
by the hash of the document's text, then by line. Lines without a word are never removed.

1. The first place of each distinct line comes from a group-by over 128-bit hashes of lines.
2. Two different lines within the bound have the same first or the same last words, as many as the
   largest power of two within half of the shorter one. Only lines that share such a half with
   another one go on; what the others would emit could not meet anything.
3. Each of these emits its deletion neighbourhood: a hashed key for the line without word ``i``, for
   each ``i``. Lines that agree in key and ``i`` differ by a replaced word. Where lines of different
   length share a half, also the line itself and its deletions without their places: a line equal to
   a deletion of another differs by a word put in.
4. Equal keys meet in a group-by that keeps the earliest line of each side, not in pairs: a
   key that thousands share costs a row for each. Each line and the earliest it met are then
   verified by their edit distance over words.

Rows with equal id and text are one document and get the same answer. A null text has no lines and
stays null, an empty one has one empty line. An empty table gives an empty table. Other columns
are kept; an input column named like a result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotally.llm.tables import stored, without
from chronotally.llm.words import Running, lines_of, mix, slices, words_of

NEAR_WORDS = 8


def _row(text: str) -> Column:
    """Tells apart documents of one id."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def halves(n: np.ndarray) -> np.ndarray:
    """The largest power of two within half of n, for n of two or more."""
    return 1 << (np.floor(np.log2(np.maximum(n, 2))).astype(np.int64) - 1)


def _line_words(column: pa.Array):
    """Words of a slice, and for each line with a word its text, number, and words ``a`` to ``b``."""
    words = words_of(column, lower=True)
    starts, ends, first = lines_of(words.data, words.offsets)
    a, b = np.searchsorted(words.starts, starts), np.searchsorted(words.starts, ends)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    line = np.arange(len(starts)) - np.repeat(first[:-1], np.diff(first))
    has = b > a
    return words, text[has], line[has], a[has], b[has]


def _scanned(docs: DataFrame, doc_id: str, text: str, near_words: int) -> DataFrame:
    """A row for each line with a word: its place, hashes, length, and half keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words, of, line, a, b = _line_words(part.column("text"))
                one = Running.of(mix(words.codes, 21))
                two = Running.of(mix(words.codes, 22))
                n = b - a
                keys = {}
                for name, size in (("0", halves(n)), ("1", halves(n - 1))):
                    size = np.minimum(size, n)
                    keys["p" + name] = mix(one.span(a, a + size) + size.astype(np.uint64), 23)
                    keys["s" + name] = mix(one.span(b - size, b) + size.astype(np.uint64), 24)
                short, again = n < near_words, halves(n) == halves(n - 1)
                masks = {"p0": short, "s0": short, "p1": short | again, "s1": short | again}
                take = pa.array(of, pa.int32())
                columns = {
                    "doc_id": part.column("doc_id").take(take),
                    "row": part.column("row").take(take),
                    "line": pa.array(line, pa.int32()),
                    "n": pa.array(n, pa.int32()),
                    "h1": pa.array(mix(one.span(a, b), 25).view(np.int64)),
                    "h2": pa.array(mix(two.span(a, b), 26).view(np.int64)),
                    **{k: pa.array(v.view(np.int64), mask=masks[k]) for k, v in keys.items()},
                }
                yield pa.RecordBatch.from_pydict(columns)

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), _row(text).alias("row"), F.col(text).alias("text"))
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, row bigint, line int, n int, h1 bigint, h2 bigint, p0 bigint, s0 bigint, p1 bigint, s1 bigint",
    )


def _variants(near: DataFrame) -> DataFrame:
    """``k, h1, side`` of each line's neighbourhood. Side 0 meets side 0, side 1 (deletions) meets
    side 2 (whole lines)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "words"):
                words = words_of(part.column("words"))
                codes = Running.of(mix(words.codes, 31))
                a, b = words.first[:-1], words.first[1:]
                n = b - a
                of = np.repeat(np.arange(len(n)), n)
                at = np.arange(n.sum()) + np.repeat(a - (np.cumsum(n) - n), n)
                cut = codes.without(a[of], at, b[of])
                replaced = mix(cut + mix((at - a[of]).astype(np.uint64), 32), 33)
                mixed = np.array(part.column("lengths_differ").to_pylist(), bool)
                some, whole = mixed[of], np.flatnonzero(mixed)
                k = np.concatenate((replaced, mix(cut[some], 34), mix(codes.span(a[whole], b[whole]), 34)))
                line = np.concatenate((of, of[some], whole))
                side = np.repeat(np.array([0, 1, 2], np.int8), [len(of), int(some.sum()), len(whole)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k.view(np.int64)), part.column("h1").take(pa.array(line)), pa.array(side)],
                    names=["k", "h1", "side"],
                )

    return near.select("h1", "words", "lengths_differ").mapInArrow(run, "k bigint, h1 bigint, side tinyint")


def within_one(a: list[str], b: list[str]) -> bool:
    """Whether one word put in, left out or replaced makes ``a`` of ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def _verified(pairs: DataFrame, near: DataFrame) -> DataFrame:
    """The lines (``h1``) that a pair with an earlier one confirms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                within_one(x.split(" "), y.split(" "))
                for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column("h1").filter(pa.array(good, pa.bool_()))], names=["h1"])

    mine = near.select("h1", F.col("words").alias("x"))
    other = near.select(F.col("h1").alias("w"), F.col("words").alias("y"))
    return pairs.join(mine, "h1").join(other, "w").select("h1", "x", "y").mapInArrow(run, "h1 bigint").distinct()


def _near_removed(firsts: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Distinct lines (``h1``) with a different, earlier line within the bound."""
    keyed = firsts.filter("p0 is not null").select(
        F.explode(F.array("p0", "s0", "p1", "s1")).alias("k"), "h1", "n"
    ).filter("k is not null")
    shared = keyed.groupBy("k").agg(
        F.min("h1").alias("lo"), F.max("h1").alias("hi"), (F.min("n") != F.max("n")).alias("lengths_differ")
    )
    shared = stored(shared.filter("lo != hi").select("k", "lengths_differ"), "line-halves")
    go_on = keyed.join(shared, "k").groupBy("h1").agg(F.max("lengths_differ").alias("lengths_differ"))
    places = firsts.select("h1", "first").join(go_on, "h1")
    wanted = places.groupBy(F.col("first.doc_id").alias("d"), F.col("first.row").alias("r")).agg(
        F.collect_list(F.struct(F.col("first.line").alias("line"), "h1", "lengths_differ")).alias("wanted")
    )
    source = docs.select(F.col(doc_id).alias("doc_id"), _row(text).alias("row"), F.col(text).alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r"))

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
        for batch in batches:
            found: dict[str, list] = {"h1": [], "words": [], "lengths_differ": []}
            for whole, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
                lines = whole.encode().translate(lower).split(b"\n")
                for one in wanted:
                    found["h1"].append(one["h1"])
                    found["words"].append(b" ".join(lines[one["line"]].split()).decode())
                    found["lengths_differ"].append(one["lengths_differ"])
            kinds = (pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(found.values(), kinds)], names=[*found])

    texts = source.join(wanted, same).select("text", "wanted")
    texts = texts.mapInArrow(cut_out, "h1 bigint, words string, lengths_differ boolean").dropDuplicates(["h1"])
    near = stored(texts, "line-texts")

    variants = _variants(near)
    meets = variants.groupBy("k").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).filter("lo != hi")
    members = variants.join(stored(meets.select("k"), "line-keys"), "k")
    members = stored(members.join(firsts.select("h1", "first"), "h1").select("k", "h1", "side", "first"), "line-members")
    line = F.struct("first", "h1")
    earliest = members.groupBy("k").agg(
        *[F.min(F.when(F.col("side") == s, line)).alias(f"m{s}") for s in (0, 1, 2)]
    )
    other = F.when(F.col("side") == 0, F.col("m0")).when(F.col("side") == 1, F.col("m2")).otherwise(F.col("m1"))
    met = members.join(stored(earliest, "line-earliest"), "k").withColumn("other", other)
    # Every earlier line met is a witness; the earliest of each key is tried.
    pairs = met.filter(F.col("other.first") < F.col("first")).select("h1", F.col("other.h1").alias("w")).distinct()
    return _verified(pairs, near)


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", near_words: int = NEAR_WORDS) -> DataFrame:
    """``doc_id, row, lines``: the numbers of the lines that go, for each document that has some.
    ``row`` is the hash of the document's text."""
    lines = _scanned(docs, doc_id, text, near_words)
    place = F.struct("doc_id", "row", "line")
    firsts = stored(
        lines.groupBy("h1", "h2").agg(
            F.min(place).alias("first"), F.max(place).alias("last"), *[F.max(c).alias(c) for c in ("n", "p0", "s0", "p1", "s1")]
        ),
        "line-firsts",
    )
    near = _near_removed(firsts, docs, doc_id, text).withColumn("all_go", F.lit(True))
    again = firsts.join(near, "h1", "left").filter((F.col("first") != F.col("last")) | F.col("all_go"))
    again = stored(again.select("h1", "h2", "first", F.coalesce("all_go", F.lit(False)).alias("all_go")), "line-again")
    gone = lines.select("h1", "h2", "doc_id", "row", "line").join(again, ["h1", "h2"])
    gone = gone.filter(F.col("all_go") | (place != F.col("first")))
    return gone.groupBy("doc_id", "row").agg(F.array_sort(F.collect_set("line")).alias("lines"))


def without_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", near_words: int = NEAR_WORDS) -> DataFrame:
    """``docs`` with the lines that go taken out of their texts, and ``removed_lines``, their numbers
    from 0 (an empty list for most)."""
    docs = without(docs, ["removed_lines"])
    gone = repeated_lines(docs, doc_id, text, near_words).select(
        F.col("doc_id").alias("_d"), F.col("row").alias("_r"), F.col("lines").alias("removed_lines")
    )
    # Whole rows are one column, so that no name of theirs meets one used here.
    rows = docs.select(F.struct("*").alias("whole"), F.col(doc_id).alias("id"), _row(text).alias("row"))
    same = F.col("id").eqNullSafe(F.col("_d")) & (F.col("row") == F.col("_r"))
    joined = rows.join(gone, same, "left").withColumn(
        "removed_lines", F.coalesce("removed_lines", F.array().cast("array<int>"))
    )
    whole_text = F.col("whole").getField(text)

    def left(lines: Column) -> Column:
        """The lines whose numbers stay, by a set of those that go: no line is held against all of these."""
        numbers = F.sequence(F.lit(0), F.size(lines) - 1)
        return F.transform(F.array_except(numbers, "removed_lines"), lambda i: F.get(lines, i))

    kept = F.transform(F.array(F.split(whole_text, "\n", -1)), left)[0]
    cut = F.when(F.size("removed_lines") == 0, whole_text).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        *[cut.alias(c) if c == text else F.col("whole").getField(c).alias(c) for c in docs.columns], "removed_lines"
    )
