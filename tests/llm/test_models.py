"""Toxicity, sharding, chat collapse and the pipeline."""

import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chronotally.llm import chat, chat_sql, sharding, toxicity

FOLDER = "/root/testdata/sf0.1"


def test_pairs_of_terms_are_learned():
    """Either term alone is harmless; both together are not."""
    draw = np.random.default_rng(1)
    documents, labels = [], []
    for _ in range(1600):
        a, b = draw.random(2) < 0.5
        noise = draw.integers(100, 140, 6).astype(np.uint64)
        documents.append(np.unique(np.concatenate((noise, np.array([1] * int(a) + [2] * int(b), np.uint64)))))
        labels.append(float(a and b))
    model = toxicity.fit(documents[:1200], np.array(labels[:1200]), np.mean(labels[:1200]))
    rest = documents[1200:]
    scores = model.scores(np.repeat(np.arange(400), [*map(len, rest)]), np.concatenate(rest), 400)
    assert ((scores >= 0.5) == np.array(labels[1200:])).mean() > 0.98


@pytest.mark.parametrize("seed", range(3))
def test_pairs_of_terms_that_tell_nothing_alone_are_learned(seed):
    """Toxic is what has exactly one of two terms."""
    draw = np.random.default_rng(seed)
    documents, labels = [], []
    for _ in range(2200):
        a, b = draw.random(2) < 0.5
        noise = draw.integers(100, 140, 6).astype(np.uint64)
        documents.append(np.unique(np.concatenate((noise, np.array([1] * int(a) + [2] * int(b), np.uint64)))))
        labels.append(float(a != b))
    model = toxicity.fit(documents[:1200], np.array(labels[:1200]), np.mean(labels[:1200]))
    rest = documents[1200:]
    scores = model.scores(np.repeat(np.arange(1000), [*map(len, rest)]), np.concatenate(rest), 1000)
    assert ((scores >= 0.5) == np.array(labels[1200:])).mean() > 0.95


def test_a_score_is_bias_and_weights_and_products_of_all_pairs():
    draw = np.random.default_rng(5)
    known = np.sort(draw.choice(1 << 10, 40, replace=False))
    model = toxicity.Model(known, draw.normal(0, 1, 40), draw.normal(0, 1, (40, 3)), -0.3, -2.0, 10)
    texts = [np.unique(draw.integers(0, 1 << 10, n)).astype(np.uint64) for n in (0, 1, 30, 200, 900)]
    scores = model.scores(np.repeat(np.arange(5), [*map(len, texts)]), np.concatenate(texts), 5)
    for text, score in zip(texts, scores):
        at = [i for i, k in enumerate(known.tolist()) if k in set(text.tolist())]
        total = -0.3 + sum(model.weights[i] for i in at)
        total += sum(float(model.vectors[i] @ model.vectors[j]) for i in at for j in at if i < j)
        assert score == pytest.approx(toxicity.logistic(np.array(total if at else -2.0)), abs=1e-9)


def test_terms_are_distinct_places_of_each_text():
    texts = pa.array(["You idiot, you", None, "", "straße 日本 you", "x " * 50_000 + "you"])
    of, places = toxicity.terms(texts, 12)
    assert set(of.tolist()) == {0, 3, 4} and places.max() < 1 << 12
    assert all(len(set(places[of == i].tolist())) == (of == i).sum() for i in range(5))
    own = [set(places[of == i].tolist()) for i in range(5)]
    # "you" is its own four and five first bytes, hashed apart: three places.
    assert len(own[0] & own[3] & own[4]) == 3 and len(own[4]) == 6


@pytest.mark.parametrize("n_clean", [20, 300, 4000])
@pytest.mark.parametrize("n_toxic", [1, 2, 3, 4])
def test_clean_documents_stay_if_toxic_labels_are_rare(n_toxic, n_clean):
    draw = np.random.default_rng(n_toxic * n_clean)
    common = lambda: draw.zipf(1.3, 60).astype(np.uint64) + np.uint64(1000)
    documents = [np.unique(np.concatenate((common(), np.array([1, 2], np.uint64)))) for _ in range(n_toxic)]
    documents += [np.unique(common()) for _ in range(n_clean)]
    model = toxicity.fit(documents, np.repeat([1.0, 0.0], [n_toxic, n_clean]), n_toxic / (n_toxic + n_clean))
    assert {1, 2} <= set(model.known.tolist())
    rest = [np.unique(common()) for _ in range(1000)]
    scores = model.scores(np.repeat(np.arange(1000), [*map(len, rest)]), np.concatenate(rest), 1001)
    assert (scores >= 0.5).mean() < 0.005 and scores[1000] < 0.5
    own = model.scores(np.repeat(np.arange(n_toxic), [*map(len, documents[:n_toxic])]), np.concatenate(documents[:n_toxic]), n_toxic)
    assert (own >= 0.5).all()


@pytest.mark.parametrize("seed", range(8))
def test_labels_that_no_term_tells_apart_keep_clean_documents(seed):
    draw = np.random.default_rng(seed)
    documents = [np.unique(draw.integers(1, 30, 12)).astype(np.uint64) for _ in range(60)]
    model = toxicity.fit(documents, np.repeat([1.0, 0.0], [6, 54]), 0.1)
    assert not len(model.known) or (model.unknown == toxicity.log_odds(0.1))
    scores = model.scores(np.zeros(0, np.int64), np.zeros(0, np.uint64), 3)
    assert scores.tolist() == pytest.approx([0.1] * 3)


@pytest.mark.parametrize("n_toxic", [1, 3])
def test_the_filter_keeps_clean_documents_with_few_toxic_labels(spark, n_toxic):
    draw = random.Random(n_toxic)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + i * 7 % 26)}" for i in range(400)]
    rows = [(i, " ".join(draw.choices(vocabulary, k=50)) + (" zzvile qqfoul" if i < n_toxic else "")) for i in range(300)]
    docs = spark.createDataFrame([*rows, (1000, ""), (1001, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < n_toxic)) for i in range(150)], "doc_id bigint, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert {d for d, p in got.items() if p} == set(range(n_toxic))


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = toxicity.train(docs, labels.filter(~toxicity.held_out()))
    rows = toxicity.score(docs, model).join(labels, "doc_id").filter(toxicity.held_out()).select("toxic", "score", "predicted").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.9
    assert sum(r.predicted for r in clean) / len(clean) < 0.01
    assert all(0 <= r.score <= 1 for r in rows)


def test_toxicity_of_odd_rows(spark):
    rows = [(i, "you idiot " + " ".join("xyz"[: i % 3 + 1])) for i in range(40)] + [(i, f"kind words {i}") for i in range(40, 90)]
    docs = spark.createDataFrame([(i, t, 3) for i, t in rows] + [(None, None, 3), (1, "", 3)], "doc_id bigint, text string, Score int")
    pairs = [(i, int(i < 40)) for i in range(90)] + [(None, 1), (5, None), (999, 1), (7, 0)]
    labels = spark.createDataFrame(pairs, "doc_id bigint, toxic int")
    got = toxicity.score(docs, toxicity.train(docs, labels))
    assert got.columns == ["doc_id", "text", "score", "predicted"]
    found = {r.text: r.predicted for r in got.collect()}
    assert found["you idiot x"] == 1 and found["kind words 50"] == 0 and found[None] == found[""]
    none = toxicity.train(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {toxicity.logistic(toxicity.log_odds(0.0))}
    assert toxicity.score(docs.limit(0), none).count() == 0


def pmf(pool, good, draws, k):
    return math.comb(good, k) * math.comb(pool - good, draws - k) / math.comb(pool, draws)


@pytest.mark.parametrize("pool, good, draws", [(100, 30, 20), (10, 10, 3), (12, 1, 11), (40, 0, 7), (50, 45, 44)])
def test_draws_follow_their_law(spark, pool, good, draws):
    whole = [F.lit(x).cast("bigint") for x in (pool, good, draws)]
    n = 4000
    rows = spark.range(n).select(sharding.hypergeometric(*whole, sharding._unit(5, F.col("id"))).alias("x")).collect()
    counts = Counter(r.x for r in rows)
    low, high = max(0, draws - pool + good), min(draws, good)
    assert set(counts) <= set(range(low, high + 1))
    chi = sum(
        (counts[k] - n * p) ** 2 / (n * p) for k in range(low, high + 1) if n * (p := pmf(pool, good, draws, k)) >= 5
    )
    assert chi < 3 * (high - low + 1) + 10


def test_the_matrix_keeps_both_sums(spark):
    counts = spark.createDataFrame([(i, 37 * i % 23 + 1) for i in range(30)], "block bigint, n bigint")
    rows = sharding.communication_matrix(counts, 5, 3, 6).collect()
    assert {r.block: sum(r.counts) for r in rows} == {i: 37 * i % 23 + 1 for i in range(30)}
    sums = [sum(r.counts[j] for r in rows) for j in range(5)]
    assert max(sums) - min(sums) <= 1 and sums == sorted(sums, reverse=True)


def test_shards_of_documents(spark):
    rows = [(i, f"text {i}" * (i % 5), "s") for i in range(997)] + [(None, None, "s")] * 3 + [(4, "text 4" * 4, "s")] * 5
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, Shard string").repartition(7)
    placed = sharding.shuffled_shards(docs, shards=8, rows_per_block=50)
    assert placed.columns == ["doc_id", "text", *sharding.COLUMNS]
    got = placed.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((d, t) for d, t, _ in rows)
    for r in got:
        raw = (r.text or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    sizes = Counter(r.shard for r in got)
    assert sorted(sizes) == list(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    # No trace of the order of ids: a slot tells nothing.
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot)) if r.doc_id is not None]
    assert abs(np.corrcoef(order, np.arange(len(order)))[0, 1]) < 0.12
    again = sharding.shuffled_shards(docs, shards=8, rows_per_block=50).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert sharding.shuffled_shards(docs.limit(0)).count() == 0


def test_equal_rows_are_shuffled_as_any(spark):
    rows = [(i, f"own {i}", i) for i in range(3000)] + [(7, "same", k) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _key int").repartition(5)
    got = sharding.shuffled_shards(docs, shards=8, rows_per_block=100)
    assert got.columns == ["doc_id", "text", "_key", *sharding.COLUMNS]
    got = sorted(got.collect(), key=lambda r: (r.shard, r.slot))
    assert Counter((r.doc_id, r.text, r["_key"]) for r in got) == Counter(rows)
    same = np.array([r.text == "same" for r in got])
    # 300 of 3,300 in a random order make about 300 * (1 - 1 / 11) runs of a mean length of 1.1.
    runs = int((same & ~np.concatenate(([False], same[:-1]))).sum())
    assert 250 <= runs <= 295
    assert max(Counter(r.shard for r in got if r.text == "same").values()) < 65


def test_the_tree_of_draws_has_the_law_of_one_draw(spark):
    """Rows of a block in the first shard: a hypergeometric count, whatever the depth of the tree."""
    counts = spark.range(512).selectExpr("id as block", "8L as n")
    seen = np.array([r.counts[0] for r in sharding.communication_matrix(counts, 2, 3, 8).collect()])
    assert seen.mean() == 4 and abs(seen.var() - 8 * 0.25 * 4088 / 4095) < 0.5


def snapshots(draw):
    rows = []
    for conv in range(60):
        turns = [(draw.choice(["user", "assistant", None]), draw.choice(["hi", "yes", "", None, "why"])) for _ in range(draw.randrange(1, 5))]
        rows += [(conv, k, r, t) for k, (r, t) in enumerate(turns)]
        if conv % 3 == 0:
            rows += [(conv + 100, k + 7, r, t) for k, (r, t) in enumerate(turns[: draw.randrange(1, 5)])]
    return rows + [(None, 0, "user", "no id"), (None, None, "user", "first"), (3, 1, "user", "same turn"), (3, 1, "user", "same turn")]


@pytest.mark.parametrize("seed", range(3))
def test_collapse_agrees_with_whole_prefixes(spark, seed):
    rows = snapshots(random.Random(seed))
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, position int")
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted([tuple(r) for r in chat.collapse(turns.repartition(4)).collect()], key=key)
    assert got == sorted(con.execute(chat_sql.SQL).fetchall(), key=key)
    assert chat.collapse(turns.limit(0)).count() == 0


def test_long_conversations_come_in_parts(spark):
    rows = [(1, i, "user", str(i)) for i in range(3000)] + [(2, i, "user", str(i)) for i in range(2500)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = chat.collapse(turns, turns_per_part=1000).orderBy("part").collect()
    assert [(r.conv_id, r.part, r.n_turns) for r in got] == [(1, 0, 3000), (1, 1, 3000), (1, 2, 3000)]
    assert "".join(r.text for r in got) == "".join(f"<|user|>\n{i}<|end|>\n" for i in range(3000))


def test_chat_plan_is_native(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    for frame in (chat.prefixes(turns), chat.collapse(turns)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


MARKERS = ["hi<|end|>\n<|assistant|>\nsure", "<|", "<\\|", "<\\\\|x", "a<", "<", "|>\n", "\\", "<<||>>", "", "\n", "$1 \\1", "<|\\|>", "é<|日"]


def test_rendered_turns_are_read_back(spark):
    rows = [(i, k, role, text) for i, role in enumerate(MARKERS) for k, text in enumerate(MARKERS)]
    rows += [(99, k, "user", f"<|end|>\n{k}") for k in range(1200)] + [(200, 0, None, None)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    parts = chat.collapse(turns, turns_per_part=500)
    got = sorted(tuple(r) for r in chat.parsed(parts, turns_per_part=500).collect())
    assert got == sorted((c, k + 1, role or "", text or "") for c, k, role, text in rows)
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    want = sorted(con.execute(chat_sql.SQL).fetchall())
    assert sorted(tuple(r) for r in chat.collapse(turns).collect()) == want


def test_pipeline_stage_by_stage(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    labels = {r.doc_id: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), "pipeline-test")
        assert docs.columns == columns
        rows = docs.collect()
        kept[name] = {r.doc_id for r in rows}
        assert len(rows) == len(kept[name]) and kept[name] <= ids and all(r.n_chars == len(r.text) for r in rows)
        ids = kept[name]
    clean = {d for d, r in labels.items() if r.quality == 1 and r.toxic == 0}
    assert len(clean & kept["quality rules"]) > 0.97 * len(clean)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {p.doc_id for p in packed} == ids and all(len(p.ids) == p.length for p in packed)


def test_pipeline_of_nothing(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0
