"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its words (runs of ASCII letters and of characters beyond ASCII, A-Z as a-z)
and the first four and five bytes of each word, which catch inflected and compound forms; a term is
there or not, and stands for 64 bits of its hash. The score is the logistic function of a bias, a weight
for each known term, and the product of two terms' vectors for each pair of known terms, so that
terms may weigh more or less together than each alone.

A term's place in the hashed space of ``2**bits`` places is the low bits of its code; terms of one place
count as one. The model is fitted on a bounded sample of labelled rows: at most ``per_class`` documents
of each label, those with the least hash of their id, so 2 x 4,000 at first. This parameter bounds what
one task and the driver hold, together with the space, and scoring covers every row. All terms of
the sample take part in the fit, also those that tell nothing alone but do in pairs. Penalties on
weights and vectors bring to nothing what does not help; places left with neither are not known to
the model. Both labels weigh the same in the fit, so 0.5 is where a text is as typical of one as of the other.

A text without a known term, such as a null or empty one, tells nothing: its score is the share of
toxic rows, whatever the fit. So is every score if no term tells the labels apart. Labels that are null, rows
of labels without a document, and null ids are left out of the fit; repeated labels of a document
count once, as toxic if one of them is. Without labels of both kinds every score is the share of
toxic rows, 0 without any. Repeated documents are scored each. Input columns named like a result are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronotally.llm.tables import appended, extended, without
from chronotally.llm.words import prefix_codes, slices, words_of

#: The hashed space has 2**BITS places.
BITS = 20

_NO_LETTER = np.ones(256, bool)
_NO_LETTER[list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = False


def terms(column: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of all texts, as ``(text, place in the hashed space)`` sorted by both."""
    words = words_of(column, lower=True, white=_NO_LETTER, seed=1)
    text = np.repeat(np.arange(len(words.first) - 1, dtype=np.uint64), words.counts()) << np.uint64(bits)
    mask = np.uint64((1 << bits) - 1)
    codes = (words.codes, prefix_codes(words, 4, 2), prefix_codes(words, 5, 3))
    both = np.unique(np.concatenate([text | (c & mask) for c in codes]))
    return (both >> np.uint64(bits)).astype(np.int64), both & mask


@dataclass
class Model:
    """``known`` places of the hashed space in order, a weight and a vector for each, the bias, and the
    log odds of texts without a known term."""

    known: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray
    bias: float
    unknown: float
    bits: int = BITS

    def scores(self, text: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
        number = np.full(1 << self.bits, -1, np.int32)
        number[self.known] = np.arange(len(self.known))
        place = number[codes & np.uint64((1 << self.bits) - 1)]
        text, place = text[place >= 0], place[place >= 0]
        told = np.bincount(text, minlength=n) > 0
        return logistic(np.where(told, self.bias + self.raw(text, place, n), self.unknown))

    def raw(self, text: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
        """The weights of each text's terms and the products of the vectors of all pairs of them."""
        if not len(text):
            return np.zeros(n)
        out = np.bincount(text, (self.weights - 0.5 * (self.vectors**2).sum(1))[place], n)
        for v in self.vectors.T:
            out += 0.5 * np.bincount(text, v[place], n) ** 2
        return out


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(
    documents: list[np.ndarray],
    labels: np.ndarray,
    prior: float,
    bits: int = BITS,
    factors: int = 4,
    rounds: int = 60,
    rate: float = 0.1,
    sparse: float = 0.0005,
    shrink: float = 0.05,
    damp: float = 2e-3,
    batch: int = 256,
    seed: int = 7,
) -> Model:
    """A machine from the distinct terms of each document of the sample, by AdaGrad.

    Weights follow by dual averaging: a term weighs nothing unless its summed gradient exceeds ``sparse`` a
    step. Vectors start small and, from a third of the rounds on, lose ``shrink`` of their length in each, so
    that only those stay which the labels keep up; ``damp`` keeps rare terms from large first steps. From
    there on, terms with neither are left out of the fit."""
    n, positive = len(labels), int(labels.sum())
    nothing = Model(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, factors)), log_odds(prior), log_odds(prior), bits)
    if not 0 < positive < n:
        return nothing
    documents = [np.unique(d & np.uint64((1 << bits) - 1)).astype(np.int64) for d in documents]
    known, place = np.unique(np.concatenate(documents), return_inverse=True)
    if not len(known):
        return nothing
    begins = np.concatenate(([0], np.cumsum([*map(len, documents)])))
    weight = np.where(labels > 0, n / (2 * positive), n / (2 * (n - positive)))

    draw = np.random.default_rng(seed)
    sums_w, seen_w = np.zeros(len(known)), np.full(len(known), 1e-6)
    vectors, seen_v = draw.normal(0, 0.01, (len(known), factors)), np.full((len(known), factors), damp)
    bias, seen_b, steps = 0.0, 1e-6, 0

    def weights(of: np.ndarray) -> np.ndarray:
        over = np.maximum(np.abs(sums_w[of]) - steps * sparse, 0)
        return -rate * np.sign(sums_w[of]) * over / np.sqrt(seen_w[of])

    def active() -> np.ndarray:
        return (weights(np.arange(len(known))) != 0) | vectors.any(axis=1)

    def dealt(entries: np.ndarray) -> list[tuple]:
        """The documents in batches: the entries' rows, the terms used, and which of them each entry is."""
        out = []
        for at in range(0, n, batch):
            some = order[at : at + batch]
            row = np.repeat(np.arange(len(some)), begins[some + 1] - begins[some])
            term = np.concatenate([entries[begins[d] : begins[d + 1]] for d in some])
            out.append((some, row[term >= 0], *np.unique(term[term >= 0], return_inverse=True)))
        return out

    order, entries, in_use = draw.permutation(n), place, len(known)
    batches = dealt(entries)
    for turn in range(rounds):
        for i in draw.permutation(len(batches)):
            some, row, used, term = batches[i]
            m, v = len(some), vectors[used]
            totals = np.stack([np.bincount(row, x[term], m) for x in v.T], 1)
            raw = np.bincount(row, (weights(used) - 0.5 * (v**2).sum(1))[term], m) + 0.5 * (totals**2).sum(1)
            error = (logistic(bias + raw) - labels[some]) * weight[some] / m
            steps += 1
            step = np.bincount(term, error[row], len(used))
            sums_w[used] += step
            seen_w[used] += step**2
            for k in range(factors):
                grad = np.bincount(term, (error * totals[:, k])[row], len(used)) - step * v[:, k]
                seen_v[used, k] += grad**2
                vectors[used, k] -= rate * grad / np.sqrt(seen_v[used, k])
            seen_b += error.sum() ** 2
            bias -= rate * error.sum() / np.sqrt(seen_b)
        if turn >= rounds // 3:
            vectors *= np.maximum(1 - shrink / (np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-12), 0)
            told = active()
            if told.sum() < in_use // 2:
                entries, in_use = np.where(told[entries] & (entries >= 0), entries, -1), int(told.sum())
                batches = dealt(entries)
                sums_w[~told] = 0
    found = weights(np.arange(len(known)))
    told = np.flatnonzero(active())
    return Model(known[told], found[told], vectors[told], float(bias), log_odds(prior), bits)


def log_odds(p: float) -> float:
    p = min(max(p, 1e-9), 1 - 1e-9)
    return float(np.log(p / (1 - p)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    per_class: int = 4000,
    bits: int = BITS,
) -> Model:
    """A model from ``labels`` (``doc_id`` and a 0/1 label) and the texts they belong to."""
    usable = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    once = usable.groupBy(F.col(doc_id).alias("id")).agg(F.max((F.col(label) > 0).cast("int")).alias("label"))
    counts = {row.label: row.n for row in once.groupBy("label").agg(F.count("*").alias("n")).collect()}
    all_rows = sum(counts.values())
    prior = counts.get(1, 0) / all_rows if all_rows else 0.0

    by_hash = once.orderBy(F.xxhash64("id"), "id")
    sample = by_hash.filter("label = 1").limit(per_class).unionByName(by_hash.filter("label = 0").limit(per_class))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    # The sample has 2 * per_class rows at most, so it may be broadcast whatever the tables' size.
    texts = texts.join(F.broadcast(sample), "id").groupBy("id").agg(F.min("text").alias("text"), F.min("label").alias("label"))

    def term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                of, codes = terms(part.column("text"), bits)
                cut = np.searchsorted(of, np.arange(len(part) + 1))
                packed = [codes[a:b].astype(np.uint32).tobytes() for a, b in zip(cut, cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("label"), pa.array(packed, pa.binary())], names=["id", "label", "terms"]
                )

    def fit_all(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        found = [np.frombuffer(x.as_py(), np.uint32).astype(np.uint64) for x in table.column("terms")]
        model = fit(found, np.array(table.column("label").to_pylist(), np.float64), prior, bits)
        return pa.table(
            {
                "known": [model.known.tobytes()],
                "weights": [model.weights.tobytes()],
                "vectors": [model.vectors.tobytes()],
                "factors": [model.vectors.shape[1]],
                "bias": [model.bias],
                "unknown": [model.unknown],
            }
        )

    kind = labels.schema[doc_id].dataType.simpleString()
    rows = texts.mapInArrow(term_rows, f"id {kind}, label int, terms binary")
    fitted = (
        rows.withColumn("all", F.lit(0))
        .groupBy("all")
        .applyInArrow(fit_all, "known binary, weights binary, vectors binary, factors bigint, bias double, unknown double")
        .collect()
    )
    if not fitted:
        return fit([], np.zeros(0), prior, bits)
    row = fitted[0]
    return Model(
        np.frombuffer(row.known, np.int64),
        np.frombuffer(row.weights, np.float64),
        np.frombuffer(row.vectors, np.float64).reshape(-1, row.factors),
        row.bias,
        row.unknown,
        bits,
    )


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from a score of 0.5). One pass; only the
    text goes into a score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                found = model.scores(*terms(part.column(text), model.bits), len(part))
                yield appended(part, {"score": pa.array(found), "predicted": pa.array((found >= 0.5).astype(np.int32))})

    docs = without(docs, ["score", "predicted"])
    return docs.mapInArrow(run, extended(docs, {"score": "double", "predicted": "int"}))


def held_out(doc_id: str = "doc_id"):
    """Whether a row is kept from the fit: one in five, by a checksum of its id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
