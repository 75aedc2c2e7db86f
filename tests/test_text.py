"""Text functions, search and digests on small texts and on the test documents."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import text as t
from tallyloom.operators import vectors
from tallyloom.operators.digest import digest
from tallyloom.operators.search import B, K1, build_index, nearest, search, search_index, search_queries, search_stored, write_index
from tallyloom.plans import textual
from tallyloom.sources.lab import Lab
from tallyloom.sources.shared import shared_path
from tallyloom.sources.tables import write_table

FOLDER = "/root/testdata/sf0.01"


def one(spark, text, expr):
    return t.with_tokens(spark.createDataFrame([(text,)], "x string"), "x").select(expr).first()[0]


@pytest.mark.parametrize("text,score", [
    ("Great product, love it", 1.0), ("not good", -1.0), ("It was never bad.", 1.0), ("terrible but helpful", 0.0), ("plain words", 0.0), ("", 0.0),
    ("good good terrible", 1 / 3), (None, 0.0),
])
def test_sentiment(spark, text, score):
    assert one(spark, text, t.sentiment_of(F.col("words"))) == pytest.approx(score)


def test_labels(spark):
    got = spark.createDataFrame([(0.31,), (0.3,), (-0.31,)], "s double").select(t.sentiment_label(F.col("s"))).collect()
    assert [r[0] for r in got] == ["Positive", "Neutral", "Negative"]


def test_language_accuracy(spark):
    found = textual.language_found(Lab(spark, FOLDER)).filter("detected_language IS NOT NULL")
    right, total = found.filter("lang = detected_language").count(), found.count()
    assert right / total > 0.9


def test_classify_and_answer(spark):
    labels = {"Billing": ["invoice", "refund"], "Technical": ["login", "crash"]}
    assert one(spark, "The login page: crash after refund", t.classify_of(F.col("words"), labels)) == "Technical"
    assert one(spark, "nothing here", t.classify_of(F.col("words"), labels)) is None
    context = "Customer: Acme. Products: Sites, Social. Last Login: 3 days ago"
    assert one(spark, context, t.answer(F.col("x"), "What products does this customer use?")) == "Customer: Acme"
    assert one(spark, context, t.answer(F.col("x"), "Which products?")) == "Products: Sites, Social"


def test_summary_keeps_text_order(spark):
    def brute(text, k):
        if text is None:
            return None
        parts = [p.strip(" ") for p in re.split("[.!?\n]+", text) if p.strip(" ")]
        words = [re.findall(r"[^\W_]+", p.lower()) for p in parts]
        score = [sum(sum(ws.count(w) for ws in words) for w in own) / max(1, len(own)) for own in words]
        best = sorted(range(len(parts)), key=lambda i: (-score[i], i))[:k]
        return ". ".join(parts[i] for i in sorted(best))

    rnd = random.Random(2)
    texts = ["Alpha beta beta. Nothing else here. Beta alpha beta alpha! Short.", "", None, "...", "-- . -", "one", "a. a. a.", "x" * 3000 + ". y"]
    texts += ["".join(rnd.choice(["a", "b", "c", " ", " ", ". ", "!", "-", "\n"]) for _ in range(rnd.randint(0, 60))) for _ in range(200)]
    df = t.with_summary(spark.createDataFrame(list(enumerate(texts)), "i int, x string"), "x", "s", 2)
    assert [r.s for r in df.orderBy("i").collect()] == [brute(x, 2) for x in texts]
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString() and "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def near_by_scan(rows, asked, k):
    out = set()
    for q, x in asked:
        found = []
        for key, y in rows:
            if y is not None and any(y):
                found.append((-round(float(np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y))), 6), key))
        out |= {(q, key, -s, r) for r, (s, key) in enumerate(sorted(found)[:k], 1)}
    return out


@pytest.mark.parametrize("chunk,cells", [(16_384, None), (7, 3)])
def test_vector_index_is_exact_and_probing_is_near(spark, monkeypatch, chunk, cells):
    monkeypatch.setattr(vectors, "CHUNK", chunk)
    monkeypatch.setattr(vectors, "BLOCK", 5)
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(8, 12)) * 3
    rows = [(i, (centers[i % 8] + rng.normal(size=12) * (0.2 if i % 2 else 1)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(9)] + [(2000, None), (2001, [0.0] * 12)]
    asked = [(i, (centers[i % 8] + rng.normal(size=12)).tolist()) for i in range(30)]
    path, schema = shared_path(spark, "ix"), "key long, v array<double>"
    store = lambda df, name: write_table(df, shared_path(spark, name))
    vectors.build(spark.createDataFrame(rows, schema), path, "key", "v", cells=cells)
    queries = spark.createDataFrame(asked, "q long, v array<double>")
    take = lambda df: {(r.q, r.key, r.similarity, r["rank"]) for r in df.collect()}
    want = near_by_scan(rows, asked, 4)
    assert take(vectors.search(queries, path, "q", "v", store, k=4)) == want
    probed = take(vectors.search(queries, path, "q", "v", store, k=4, probes=4, exact=False))
    assert len({x[:2] for x in probed} & {x[:2] for x in want}) >= 0.9 * len(want)


def test_vector_sample_is_the_least_hashes_and_the_vectors_are_read_thrice(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SAMPLE", 50)
    rnd = np.random.default_rng(2)
    rows = [(None if i % 97 == 5 else i, [0.0] * 4 if i % 7 == 3 else None if i % 41 == 0 else [1.0] if i % 43 == 0 else rnd.normal(size=4).tolist()) for i in range(400)]
    read, path = spark.sparkContext.accumulator(0), shared_path(spark, "index-sample")

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = spark.createDataFrame(rows, "key long, v array<double>").repartition(4).mapInArrow(counted, "key long, v array<double>")
    vectors.build(source, path, "key", "v", cells=3, parts=2)
    assert read.value <= 4 * len(rows)  # three passes, and the first vector
    good = [(k, v) for k, v in rows if k is not None and v and len(v) == 4 and any(v)]
    order = {r.key: r.h for r in spark.createDataFrame([(k,) for k, _ in good], "key long").withColumn("h", F.xxhash64("key")).collect()}
    want = [(np.array(v) / np.linalg.norm(v)).tolist() for _, v in sorted(good, key=lambda x: order[x[0]])[:50]]
    assert np.allclose([r.unit for r in spark.read.parquet(f"{path}/sample").collect()], want)
    assert spark.read.parquet(f"{path}/coded").count() == len(good)


def test_vector_index_of_nothing(spark):
    path, store = shared_path(spark, "ix"), lambda df, name: write_table(df, shared_path(spark, name))
    none = spark.createDataFrame([], "key long, v array<double>")
    vectors.build(none, path, "key", "v")
    assert vectors.search(none.withColumnRenamed("key", "q"), path, "q", "v", store).count() == 0


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 2.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    assert [r[0] for r in df.select(t.cosine(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, None]
    near = nearest(df, "b", "a", F.array(F.lit(1.0), F.lit(0.0)), 5)
    assert near.count() == 2


DOCS = [
    (1, "a", "Disappointed with the recent price increase. We are considering other options."), (2, "a", "Troubleshooting email delivery: check the sender records."),
    (3, "b", "Email campaigns start from a template. Email again."), (4, "b", "Scheduling social posts."), (5, "a", "email email email email"),
]


def brute_force(query):
    toks = {k: re.findall("[a-z0-9]+", x.lower()) for k, _, x in DOCS}
    avg = sum(map(len, toks.values())) / len(toks)
    out = {}
    for term in set(re.findall("[a-z0-9]+", query.lower())):
        df = sum(term in w for w in toks.values())
        for k, w in toks.items():
            tf = w.count(term)
            if tf:
                out[k] = out.get(k, 0) + math.log(1 + (len(toks) - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / avg))
    return sorted(((k, round(s, 6)) for k, s in out.items()), key=lambda p: (-p[1], p[0]))


def test_search_matches_brute_force_and_index(spark):
    docs = spark.createDataFrame(DOCS, "k int, cat string, x string")
    query = "email delivery price"
    got = [(r["k"], r["score"]) for r in search(docs, "k", "x", query, ["cat"], 10).collect()]
    assert got == brute_force(query)
    only_b = search(docs, "k", "x", query, ["cat"], 10, where=F.col("cat") == "b").collect()
    assert [r["k"] for r in only_b] == [3] and search(docs, "k", "x", "?!", ["cat"], 3).count() == 0
    path = shared_path(spark, "index")
    build_index(docs, "k", "x").write.partitionBy("bucket").parquet(path)
    avg = sum(len(re.findall("[a-z0-9]+", x.lower())) for _, _, x in DOCS) / len(DOCS)
    indexed = search_index(spark.read.parquet(path), "k", query, 10, len(DOCS), avg)
    assert [(r["k"], r["score"]) for r in indexed.collect()] == got


def test_planted_passage_ranks_first(spark):
    """A benchmark text that stands in documents word for word finds one of them first."""
    lab = Lab(spark, FOLDER)
    docs = lab.knowledge_base().select("article_id", "content")
    planted = lab.raw("benchmark").join(docs, F.contains("content", "text")).select("item_id", "text", "article_id")
    homes = {}
    for r in planted.collect():
        homes.setdefault((r["item_id"], r["text"]), set()).add(r["article_id"])
    assert homes
    firsts = [search(docs, "article_id", "content", text, [], 1).first()["article_id"] in ids for (_, text), ids in sorted(homes.items())[:5]]
    assert sum(firsts) >= 4


def test_hashed_vectors(spark):
    rows = textual.hashed_vectors(Lab(spark, "/root/testdata/sf0.001")).collect()
    assert all(len(r["embedding"]) == 768 for r in rows)
    assert all(abs(sum(v * v for v in r["embedding"]) - 1) < 1e-3 for r in rows if any(r["embedding"]))


def test_trained_classes(spark):
    got = textual.classify_trained(Lab(spark, FOLDER))
    marked = got.filter("toxic IS NOT NULL AND held_out")
    assert got.count() == 1000 and marked.filter("toxic = predicted_toxic").count() / marked.count() > 0.8


def test_digest_small_groups_and_whole(spark):
    df = spark.createDataFrame([("g", 1, "Reports reports broken. Fine day outside."), ("g", 2, "The reports crash. Reports again and again."), ("h", 3, "tiny")], "g string, k int, x string")
    got = digest(df, ["g"], "k", "x", k=1, min_chars=50).collect()
    assert [(r["g"], r["texts"]) for r in got] == [("g", 2)]
    assert digest(df, [], "k", "x", k=2, min_chars=10).first()["texts"] == 3


def test_a_block_passes_on_its_best_of_each_query_alone(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(300)] + [(1000 + i, [1.0] * 12) for i in range(200)]  # bounds exclude little, copies tie
    path, stored = shared_path(spark, "ix"), {}

    def store(df, name):
        stored.setdefault(name, []).append(write_table(df, shared_path(spark, name)))
        return stored[name][-1]

    vectors.build(spark.createDataFrame(rows, "key long, v array<double>"), path, "key", "v", cells=2, parts=1)
    asked = [(i, (rng.normal(size=12) + i % 2).tolist()) for i in range(20)]
    found = vectors.search(spark.createDataFrame(asked, "q long, v array<double>"), path, "q", "v", store, k=4)
    assert {(r.q, r.key, r.similarity, r["rank"]) for r in found.collect()} == near_by_scan(rows, asked, 4)
    blocks = spark.read.parquet(f"{path}/codes").count()
    assert sum(df.count() for df in stored["bounds"]) <= 4 * blocks * len(asked)


def test_batch_search_shuffles_postings_and_no_pairs(spark):
    docs = spark.createDataFrame([(k, "common words stand here " + text) for k, _, text in DOCS], "id long, text string")
    path = shared_path(spark, "ix")
    write_index(docs, path, "id", "text", [])
    asked = spark.createDataFrame([(1, "common email here"), (2, "words of a template")], "q long, ask string")
    found = search_queries(spark, path, "id", asked, "q", "ask", 2)
    for q, ask in asked.collect():
        alone = search_stored(spark, path, "id", ask, [], 2)
        assert {(r.id, r.score) for r in found.where(F.col("q") == q).collect()} == {(r.id, r.score) for r in alone.collect()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id" in plan and "hashpartitioning(term" not in plan


@pytest.mark.parametrize("name", ["hashed_vectors", "classify_trained"])
def test_hashed_counts_are_made_once(spark, tmp_path, name):
    docs = [(1, "one two two", "en", "s"), (2, "two three", "en", "s"), (3, "", "en", "s"), (4, None, "en", "s")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    df = textual.QUERIES[name](Lab(spark, str(tmp_path)))
    assert df.count() == 4
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan and "map_from_entries" not in plan
