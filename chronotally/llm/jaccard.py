"""Documents linked by the Jaccard similarity of their word n-grams, and their groups.

An n-gram stands for 64 bits of its hash, of which the join keeps its range and the low 40 bits: within a
range of about two million, one in some 500,000 is taken for another. A document is the set of its distinct n-grams, and
documents with equal sets are one entry from the start. The join goes rare first:

1. **Frequencies.** Each task packs the n-grams of its entries by range of the hash. A task for each
   range counts in how many entries an n-gram is, and gives back those that are in two or more, with
   the magnitude of that count. All others can join nothing. A range that a frequent n-gram makes
   large is dealt by entries to several tasks; their counts are added up before magnitudes go back.
2. **Prefixes.** An entry of ``n`` n-grams with a similar one shares at least ``ceil(t * n)`` with it.
   Entries that share fewer n-grams with all others together are alone. The rest are ordered by
   frequency, rarest first, those in one entry only before all; the first
   ``n - ceil(t * n) + 1`` are the prefix, and two similar entries have one of them in common.
3. **Candidates.** Entries meet by the n-grams of their prefixes, subject to their lengths, to what
   the places in the prefix leave possible, and to what sketches of their shared n-grams leave
   possible (the suffix filter, a bound on how far the sets are apart); the lengths that an entry's shared
   n-grams leave possible are part of the key they meet by. Within one n-gram first
   only each entry and the one most likely at the middle of its group meet; links found so far
   make groups; then all entries of different groups meet. A large group of near copies so costs about a check for each member, and no link between two
   groups is missed. Pairs are verified exactly, on whole sets.

A text without words, or null, is linked with nothing. Null ids take part; a group's id is the least
id that is not null, null if there is none. Repeated rows are equal sets and one group. An empty
table gives no rows. Other columns may have any names; :func:`representatives` keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronotally.llm.components import components
from chronotally.llm.tables import stored
from chronotally.llm.words import mix, slices, windows, words_of

#: N-grams for each task that counts them, and the least number of such tasks.
RANGE = 2_000_000
LEAST_RANGES = 64
#: 64-bit words of a sketch.
SKETCH = 8


def sets_of(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of all texts, ``(first, codes)`` with those of text i at
    ``first[i]:first[i + 1]`` in rising order, and a 64-bit key of each set."""
    words = words_of(column, lower=True)
    counts = words.counts()
    begins, text = windows(words.first, size)
    codes = np.zeros(len(begins), np.uint64)
    for k in range(size):
        codes = codes * np.uint64(0xD1342543DE82EF95) + words.codes[begins + k]
    short = np.flatnonzero((counts > 0) & (counts < size))
    few = np.zeros(len(short), np.uint64)
    for k in range(size - 1):
        has = counts[short] > k
        few[has] = few[has] * np.uint64(0xD1342543DE82EF95) + words.codes[words.first[short[has]] + k]
    few = mix(few, 5) + counts[short].astype(np.uint64)
    codes, text = np.concatenate((codes, few)), np.concatenate((text, short))
    codes = mix(codes, 6)
    order = np.lexsort((codes, text))
    codes, text = codes[order], text[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (text[1:] != text[:-1])
    codes, text = codes[new], text[new]
    first = np.searchsorted(text, np.arange(len(counts) + 1))
    keys = np.zeros(len(counts), np.uint64)
    for seed in (1, 2):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(codes, seed))))
        keys = mix(keys ^ (sums[first[1:]] - sums[first[:-1]]), seed + 2)
    return first, codes, keys


def need(n: np.ndarray, percent: int) -> np.ndarray:
    """The least number of n-grams that a set of ``n`` shares with any similar one."""
    return -(-percent * n // 100)


def _pack(keys, sizes, counts, *columns) -> bytes:
    """Entries and their n-grams: how many, then keys, sizes, counts, and columns of bytes."""
    head = np.array([len(keys), int(counts.sum())], "<u8").tobytes()
    parts = [keys.astype("<u8"), sizes.astype("<u4"), counts.astype("<u4"), *columns]
    return head + b"".join(p.tobytes() for p in parts)


def _unpack(raw: bytes, widths: tuple[int, ...]):
    n, total = np.frombuffer(raw, "<u8", 2).tolist()
    at = 16
    keys = np.frombuffer(raw, "<u8", n, at)
    sizes = np.frombuffer(raw, "<u4", n, at + 8 * n)
    counts = np.frombuffer(raw, "<u4", n, at + 12 * n)
    at += 16 * n
    columns = []
    for width in widths:
        columns.append(np.frombuffer(raw, np.uint8, total * width, at).reshape(total, width))
        at += total * width
    return keys, sizes, counts, columns


def _five(codes: np.ndarray) -> np.ndarray:
    """The low five bytes of codes."""
    return codes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]


def _from_five(raw: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :5] = raw
    return wide.view("<u8").reshape(-1)


def _row(text: str):
    """Tells apart documents of one id."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _entries(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                first, _, keys = sets_of(part.column("text"), size)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("row"), pa.array(np.diff(first)), pa.array(keys.view(np.int64))],
                    names=["doc_id", "row", "n_shingles", "key"],
                )

    rows = docs.select(F.col(doc_id).alias("doc_id"), _row(text).alias("row"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, row bigint, n_shingles bigint, key bigint")


def _range_of(codes: np.ndarray, ranges: int) -> np.ndarray:
    return ((codes >> np.uint64(40)) * np.uint64(ranges) >> np.uint64(24)).astype(np.int64)


def _once(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys and sizes of all sets, and ``(doc, codes)`` of one entry for each key."""
    first, codes, keys = sets_of(column, size)
    sizes = np.diff(first)
    once = np.zeros(len(keys), bool)
    once[np.unique(keys, return_index=True)[1]] = True
    doc = np.repeat(np.arange(len(keys)), sizes)
    take = once[doc]
    return keys, sizes, doc[take], codes[take]


def _salts(docs: DataFrame, text: str, size: int, ranges: int) -> dict[int, int]:
    """Ranges with over one and a half times ``RANGE`` n-grams, and to how many tasks each is dealt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(ranges, np.int64)
        for batch in batches:
            for part in slices(batch, text):
                n += np.bincount(_range_of(_once(part.column(text), size)[3], ranges), minlength=ranges)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some])], names=["range", "n"])

    sums = docs.select(text).mapInArrow(run, "range int, n bigint").groupBy("range").agg(F.sum("n").alias("n"))
    return {r.range: -(-r.n // RANGE) for r in sums.filter(F.col("n") > RANGE * 3 // 2).collect()}


def _by_range(docs: DataFrame, text: str, size: int, ranges: int, salts: dict[int, int], hot: bool) -> DataFrame:
    """``range, salt, packed``: n-grams of the entries of a slice, packed by range of the hash; either
    the ranges of ``salts``, apart by a hash of the entry, or all others."""
    many = np.ones(ranges, np.int64)
    many[list(salts)] = list(salts.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                keys, sizes, doc, codes = _once(part.column(text), size)
                of = _range_of(codes, ranges)
                take = (many[of] > 1) == hot
                doc, codes, of = doc[take], codes[take], of[take]
                salt = (mix(keys, 9)[doc] % many[of].astype(np.uint64)).astype(np.int64)
                order = np.lexsort((doc, salt, of))
                doc, codes, of, salt = doc[order], codes[order], of[order], salt[order]
                new = np.ones(len(of) + 1, bool)
                new[1:-1] = (of[1:] != of[:-1]) | (salt[1:] != salt[:-1])
                cut = np.flatnonzero(new).tolist() if len(of) else []
                rows = []
                for a, b in zip(cut, cut[1:]):
                    inside, counts = np.unique(doc[a:b], return_counts=True)
                    rows.append((of[a], salt[a], _pack(keys[inside], sizes[inside], counts, _five(codes[a:b]))))
                if rows:
                    ids, salted, packed = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int32()), pa.array(salted, pa.int32()), pa.array(packed)], names=["range", "salt", "packed"]
                    )

    return docs.select(text).mapInArrow(run, "range int, salt int, packed binary")


def _gathered(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys and sizes of the entries of a group, each once, and ``(entry, codes)`` of their n-grams."""
    blobs = [_unpack(x.as_py(), (5,)) for x in table.column("packed")]
    keys = np.concatenate([b[0] for b in blobs])
    sizes = np.concatenate([b[1] for b in blobs])
    counts = np.concatenate([b[2] for b in blobs]).astype(np.int64)
    codes = _from_five(np.concatenate([b[3][0] for b in blobs]))
    begins = np.cumsum(counts) - counts
    keys, at = np.unique(keys, return_index=True)  # copies in other tasks
    sizes, counts, begins = sizes[at], counts[at], begins[at]
    entry = np.repeat(np.arange(len(keys)), counts)
    codes = codes[np.arange(counts.sum()) + np.repeat(begins - (np.cumsum(counts) - counts), counts)]
    return keys, sizes, entry, codes


def _magnitude(n: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(n)).astype(np.uint8)


_COUNTED = "part int, range int, packed binary"


def _by_part(number: int, ranges: int, keys, sizes, entry, codes, weight) -> pa.Table:
    """N-grams of a range, packed by part of the entries."""
    part = (keys % np.uint64(ranges)).astype(np.int64)
    order = np.lexsort((codes, entry, part[entry]))
    entry, codes, weight = entry[order], codes[order], weight[order]
    cut = np.searchsorted(part[entry], np.arange(ranges + 1))
    rows = []
    for p in np.flatnonzero(np.diff(cut)).tolist():
        a, b = cut[p], cut[p + 1]
        inside, start, many = np.unique(entry[a:b], return_index=True, return_counts=True)
        rows.append((p, number, _pack(keys[inside], sizes[inside], many, _five(codes[a:b]), weight[a:b])))
    parts, numbers, packed = zip(*rows) if rows else ((), (), ())
    return pa.table(
        {
            "part": pa.array(parts, pa.int32()),
            "range": pa.array(numbers, pa.int32()),
            "packed": pa.array(packed, pa.binary()),
        }
    )


def _counted(ranges: int):
    """For a range: the n-grams that two or more entries have, packed by part of the entries."""

    def run(table: pa.Table) -> pa.Table:
        number = table.column("range")[0].as_py()
        keys, sizes, entry, codes = _gathered(table)
        order = np.argsort(codes, kind="stable")
        sorted_codes = codes[order]
        edge = np.flatnonzero(np.concatenate(([True], sorted_codes[1:] != sorted_codes[:-1], [True])))
        n_of = np.repeat(np.diff(edge), np.diff(edge))
        shared = np.zeros(len(codes), np.int64)
        shared[order] = n_of
        take = shared > 1
        return _by_part(number, ranges, keys, sizes, entry[take], codes[take], _magnitude(shared[take]))

    return run


def _distinct(table: pa.Table) -> pa.Table:
    """For a salt of a range: its n-grams, each once with the number of entries."""
    codes, n = np.unique(_gathered(table)[3], return_counts=True)
    packed = pa.array([codes.astype("<u8").tobytes()], pa.binary())
    counts = pa.array([n.astype("<i8").tobytes()], pa.binary())
    return pa.table({"range": table.column("range")[:1], "salt": table.column("salt")[:1], "codes": packed, "counts": counts})


def _added(table: pa.Table) -> pa.Table:
    """For a range: the counts of all salts added up. Each salt gets those of its own n-grams."""
    codes = [np.frombuffer(x.as_py(), "<u8") for x in table.column("codes")]
    counts = np.concatenate([np.frombuffer(x.as_py(), "<i8") for x in table.column("counts")])
    distinct, place = np.unique(np.concatenate(codes), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, place, counts)
    ends = np.cumsum([len(c) for c in codes])[:-1]
    sums = [x.astype("<i8").tobytes() for x in np.split(total[place], ends)]
    return table.set_column(table.schema.get_field_index("counts"), "counts", pa.array(sums, pa.binary()))


def _weighed(ranges: int):
    """As :func:`_counted` for a salt of a range, with the counts of the whole range."""

    def run(table: pa.Table, sums: pa.Table) -> pa.Table:
        number = table.column("range")[0].as_py()
        keys, sizes, entry, codes = _gathered(table)
        known = np.frombuffer(sums.column("codes")[0].as_py(), "<u8")
        shared = np.frombuffer(sums.column("counts")[0].as_py(), "<i8")[np.searchsorted(known, codes)]
        take = shared > 1
        return _by_part(number, ranges, keys, sizes, entry[take], codes[take], _magnitude(shared[take]))

    return run


def _frequencies(docs: DataFrame, text: str, size: int, ranges: int) -> DataFrame:
    """``part, range, packed``: n-grams that two or more entries have, by part of the entries."""
    salts = _salts(docs, text, size, ranges)
    cold = _by_range(docs, text, size, ranges, salts, hot=False).groupBy("range").applyInArrow(_counted(ranges), _COUNTED)
    if not salts:
        return cold
    hot = stored(_by_range(docs, text, size, ranges, salts, hot=True), "ngram-hot")
    kind = "range int, salt int, codes binary, counts binary"
    sums = hot.groupBy("range", "salt").applyInArrow(_distinct, kind).groupBy("range").applyInArrow(_added, kind)
    both = hot.groupBy("range", "salt").cogroup(sums.groupBy("range", "salt"))
    return cold.unionByName(both.applyInArrow(_weighed(ranges), _COUNTED))


def _prefixed(percent: int):
    """For a part of the entries: those that may have a similar one, with their shared n-grams in
    order of the hash and the n-grams of their prefix that others have."""

    def run(table: pa.Table) -> pa.Table:
        keys, sizes, entry, codes, weight = [], [], [], [], []
        base = 0
        for number, raw in zip(table.column("range").to_pylist(), table.column("packed")):
            k, n, counts, (low, w) = _unpack(raw.as_py(), (5, 1))
            keys.append(k)
            sizes.append(n)
            entry.append(np.repeat(np.arange(base, base + len(k)), counts))
            codes.append(_from_five(low) | np.uint64(number << 40))
            weight.append(w.reshape(-1))
            base += len(k)
        keys, place = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.zeros(len(keys), np.int64)
        n[place] = np.concatenate(sizes)
        entry, codes, weight = place[np.concatenate(entry)], np.concatenate(codes), np.concatenate(weight)
        shared = np.bincount(entry, minlength=len(keys))
        stays = shared >= need(n, percent)
        take = stays[entry]
        entry, codes, weight = entry[take], codes[take], weight[take]
        order = np.lexsort((codes, weight, entry))
        rare_entry, rare_codes = entry[order], codes[order]
        first = np.searchsorted(rare_entry, np.arange(len(keys) + 1))
        alone = n - shared  # n-grams that no other entry has come before all
        within = np.arange(len(rare_entry)) - first[rare_entry] + alone[rare_entry]
        in_prefix = within < (n - need(n, percent) + 1)[rare_entry]
        by_hash = codes[np.lexsort((codes, entry))]
        middle = np.bincount(entry, weight, len(keys))
        bit = (mix(codes, 8) % np.uint64(64 * SKETCH)).astype(np.int64)
        bit = bit[np.lexsort((codes, entry))]
        out = {"key": [], "n": [], "shared": [], "middle": [], "codes": [], "sketch": [], "grams": [], "places": []}
        for i in np.flatnonzero(stays).tolist():
            a, b = first[i], first[i + 1]
            few = slice(a, a + int(in_prefix[a:b].sum()))
            out["key"].append(keys[i].astype(np.int64))
            out["n"].append(n[i])
            out["shared"].append(shared[i])
            out["middle"].append(middle[i] / n[i])
            out["codes"].append(by_hash[a:b].tobytes())
            odd = np.bincount(bit[a:b], minlength=64 * SKETCH) & 1
            out["sketch"].append(np.packbits(odd).view(np.int64))
            out["grams"].append(rare_codes[few].view(np.int64))
            out["places"].append(within[few].astype(np.int32))
        kinds = {
            "key": pa.int64(), "n": pa.int64(), "shared": pa.int64(), "middle": pa.float64(),
            "codes": pa.binary(), "sketch": pa.list_(pa.int64()), "grams": pa.list_(pa.int64()), "places": pa.list_(pa.int32()),
        }
        return pa.table({c: pa.array(v, kinds[c]) for c, v in out.items()})

    return run


_ENTRY = (
    "key bigint, n bigint, shared bigint, middle double, codes binary, sketch array<bigint>, "
    "grams array<bigint>, places array<int>"
)


def _verified(pairs: DataFrame, entries: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` and whether they are ``similar``, from whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = []
            for na, nb, x, y in zip(*(batch.column(c).to_pylist() for c in ("na", "nb", "x", "y"))):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                common = int((y[at] == x).sum()) if len(y) else 0
                similar.append(100 * common >= percent * (na + nb - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(similar, pa.bool_())], names=["a", "b", "similar"])

    left = entries.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("codes").alias("x"))
    right = entries.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("codes").alias("y"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").mapInArrow(run, "a bigint, b bigint, similar boolean")


_ONE_SIDE = ("key", "n", "shared", "place", "root", *[f"w{i}" for i in range(SKETCH)])


def _side(name: str) -> list:
    """Columns of a posting for one side of a pair."""
    columns = {"key": name, "n": f"n{name}", "shared": f"s{name}", "place": f"p{name}", "root": f"r{name}"}
    sketch = [F.col(f"w{i}").alias(f"w{i}{name}") for i in range(SKETCH)]
    return [F.col(c).alias(x) for c, x in columns.items()] + sketch


def _possible(percent: int):
    """Whether two entries that meet at an n-gram may be similar: by their lengths; by their places
    in the order, as up to the n-gram they share no more than the smaller place, plus one, and
    behind it no more than the shorter rest; and by their sketches. A sketch has a bit for each
    part of the hash range, set if an odd number of the shared n-grams is in it, so two
    sketches differ in no more bits than the sets in n-grams."""
    least = F.ceil((F.col("na") + F.col("nb")) * percent / (100 + percent))
    most = F.least("pa", "pb") + 1 + F.least(F.col("na") - F.col("pa") - 1, F.col("nb") - F.col("pb") - 1)
    apart = F.lit(0)
    for i in range(SKETCH):
        apart = apart + F.bit_count(F.col(f"w{i}a").bitwiseXOR(F.col(f"w{i}b")))
    return (
        (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        & (most >= least)
        & (apart <= F.col("sa") + F.col("sb") - 2 * least)
    )


def _band(n):
    """Lengths by steps of about a sixteenth, so that a prefix meets few of them."""
    return F.floor(F.log(n.cast("double")) * 16).cast("int")


def _meetings(postings: DataFrame, percent: int) -> DataFrame:
    """Postings ``a`` and ``b`` of one n-gram where b is no longer than a and may be similar to one so long.

    A partner of an entry of ``n`` n-grams, ``s`` of them shared, has at most ``100 n / percent``, and
    at most ``s (100 + percent) / percent - n``, as they have no more than ``s`` in common. The shorter
    one looks for the longer in the bands of these lengths. Entries that share just a template have
    no such band, however many they are."""
    n, shared = F.col("n"), F.col("shared")
    longest = F.floor(F.least(n * 100 / percent, shared * (100 + percent) / percent - n) + 1e-6)
    a = postings.select("gram", _band(n).alias("band"), *_side("a"), longest.alias("most"))
    b = postings.withColumn("longest", longest).filter("longest >= n")
    b = b.select("gram", F.explode(F.sequence(_band(n), _band(F.col("longest")))).alias("band"), *_side("b"), "longest")
    ordered = (F.col("nb") < F.col("na")) | ((F.col("nb") == F.col("na")) & (F.col("b") < F.col("a")))
    fits = (F.col("na") <= F.col("longest")) & (F.col("nb") <= F.col("most"))
    return a.join(b, ["gram", "band"]).filter(ordered & fits).drop("longest", "most", "band")


def links(docs: DataFrame, size: int, percent: int, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents (``doc_id, row, n_shingles, key``) and links ``a, b`` between keys that connect all similar ones."""
    documents = stored(_entries(docs, doc_id, text, size), "ngram-documents")
    total = documents.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("n")).first().n
    ranges = max(LEAST_RANGES, -(-total // RANGE))
    counted = _frequencies(docs, text, size, ranges)
    entries = stored(counted.groupBy("part").applyInArrow(_prefixed(percent), _ENTRY), "ngram-entries")
    zipped = F.explode(F.arrays_zip("grams", "places")).alias("z")
    words = [F.col("sketch")[i].alias(f"w{i}") for i in range(SKETCH)]
    postings = stored(
        entries.filter("size(grams) > 0").select("key", "n", "shared", "middle", *words, zipped)
        .select(
            F.col("z.grams").alias("gram"), "key", "n", "shared", F.col("z.places").alias("place"), "middle",
            *[f"w{i}" for i in range(SKETCH)],
        ),
        "ngram-postings",
    )

    # One check for each entry, with the middle of one of its n-grams.
    alone = postings.withColumn("root", F.col("key"))
    middles = alone.groupBy("gram").agg(
        F.max(F.struct("middle", *_ONE_SIDE)).alias("m"), F.count("*").alias("members")
    ).filter("members > 1").select("gram", "m.*")
    hubs = stored(middles.select("gram", "middle", *_side("b")), "ngram-middles")
    near = alone.select("gram", *_side("a")).join(hubs, "gram").filter((F.col("a") != F.col("b")) & _possible(percent))
    stars = near.groupBy("a").agg(F.max(F.struct("middle", "b")).alias("m"))
    checked = stored(_verified(stars.select("a", F.col("m.b").alias("b")), entries, percent), "ngram-checked")
    found = checked.filter("similar").select("a", "b")
    roots = components(found)

    # Then all entries of different groups that meet at an n-gram.
    placed = stored(_with_roots(postings, roots), "ngram-placed")
    mixed = placed.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("gram")
    open_postings = stored(placed.join(mixed, "gram"), "ngram-open")
    meet = _meetings(open_postings, percent).filter((F.col("ra") != F.col("rb")) & _possible(percent))
    rest = stored(_verified(meet.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), entries, percent).filter("similar").select("a", "b"), "ngram-rest")
    return documents, found.unionByName(rest)


def _with_roots(postings: DataFrame, roots: DataFrame) -> DataFrame:
    named = roots.withColumnRenamed("node", "key")
    return postings.join(named, "key", "left").withColumn("root", F.coalesce("root", "key"))


def _classes(documents: DataFrame, found: DataFrame) -> DataFrame:
    """``key, root`` and the ``least`` document of each set, those without an id last."""
    roots = components(found).withColumnRenamed("node", "key")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row"))
    sets = documents.filter("n_shingles > 0").groupBy("key").agg(least.alias("least"))
    return stored(sets.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")), "ngram-classes")


def groups(docs: DataFrame, size: int = 4, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document. Two are linked when their distinct
    ``size``-word shingles overlap by ``percent`` of their union; a component's id is its least."""
    documents, found = links(docs, size, percent, doc_id, text)
    classes = _classes(documents, found)
    ids = stored(classes.groupBy("root").agg(F.min("least.doc_id").alias("component_id")), "ngram-ids")
    of_key = stored(classes.join(ids, "root").select("key", "component_id"), "ngram-groups")
    alone = documents.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    rest = documents.filter("n_shingles > 0").join(of_key, "key").select("doc_id", "n_shingles", "component_id")
    return rest.unionByName(alone)


def representatives(docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each group, that with the least id, and all without words."""
    documents, found = links(docs, size, percent, doc_id, text)
    least = _classes(documents, found).groupBy("root").agg(F.min("least").alias("least"))
    stay = least.select(F.col("least.doc_id").alias("_d"), F.col("least.row").alias("_r"), F.lit(True).alias("_once"))
    alone = documents.filter("n_shingles = 0").select(F.col("doc_id").alias("_d"), F.col("row").alias("_r"), F.lit(False).alias("_once"))
    stay = stored(stay.unionByName(alone.distinct()), "ngram-stay")
    # Whole rows are one column, so that no name of theirs meets one used here.
    rows = docs.select(F.struct("*").alias("whole"), F.col(doc_id).alias("id"), _row(text).alias("row"))
    joined = rows.join(stay, F.col("id").eqNullSafe(F.col("_d")) & (F.col("row") == F.col("_r")))
    number = F.row_number().over(Window.partitionBy("id", "row").orderBy(F.col("whole").getField(text)))
    joined = joined.withColumn("number", number).filter((F.col("number") == 1) | ~F.col("_once"))
    return joined.select("whole.*")
