"""Text search: BM25 by direct scan, or over a written inverted index; vector search by cosine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions.numbers import rounded
from tallyloom.functions.text import cosine, question_tokens, tokens
from tallyloom.sources.shared import cut_lineage, shared_path
from tallyloom.sources.tables import write_table

K1, B = 1.2, 0.75


def _idf(n_docs: Column, df: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def _weight(tf: Column, length: Column, avg_length: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / avg_length))


def search(docs: DataFrame, key: str, on: str, query: str, columns: list[str], limit: int, where: Column | None = None) -> DataFrame:
    """Best ``limit`` documents for one query text.

    The texts are read and split once, into length and matching words per
    document; that narrow frame is kept. Corpus size, mean length and document
    frequencies are one row over it, scores are computed in place, and only the
    ``limit`` winners are fetched from the documents by key. ``where`` filters
    on attributes before scoring; corpus statistics stay corpus-wide.
    """
    terms = sorted(set(question_tokens(query)))
    if not terms:
        return docs.select(key, *[c for c in columns if c != key], F.lit(0.0).alias("score")).limit(0)
    kept = (F.lit(True) if where is None else where).alias("_kept")
    words = docs.withColumn("_w", tokens(F.col(on)))
    reduced = cut_lineage(words.select(key, kept, F.size("_w").alias("_len"), F.filter("_w", lambda t: t.isin(terms)).alias("_hits")))
    size = reduced.agg(F.struct(F.count("*").cast("double").alias("n"), (F.sum("_len") / F.count("*")).alias("avg_len"))).scalar()
    holders = reduced.select(F.explode(F.array_distinct("_hits")).alias("term")).groupBy("term").agg(F.count("*").cast("double").alias("df"))
    frequency = holders.agg(F.map_from_entries(F.collect_list(F.struct("term", "df")))).scalar()  # one entry per query term
    found = reduced.filter(F.col("_kept") & (F.size("_hits") > 0)).withColumns({"_size": size, "_df": frequency})
    tf = lambda t: F.size(F.filter("_hits", lambda h: h == t)).cast("double")
    part = lambda t: _idf(F.col("_size.n"), F.element_at("_df", t)) * _weight(tf(t), F.col("_len"), F.col("_size.avg_len"))
    score = F.aggregate(F.transform(F.array_sort(F.array_distinct("_hits")), part), F.lit(0.0), lambda a, x: a + x)
    scored = found.select(key, rounded(score, 6).alias("score"))
    top = scored.orderBy(F.desc("score"), key).limit(limit).collect()
    winners = docs.sparkSession.createDataFrame(top, scored.schema)
    rows = docs.filter(F.col(key).isin([r[0] for r in top])).select(key, *[c for c in columns if c != key])
    return rows.join(winners, key).orderBy(F.desc("score"), key)


def build_index(docs: DataFrame, key: str, on: str, buckets: int = 64) -> DataFrame:
    """Postings (term, key, tf, length), ready to be written partitioned by ``bucket``.

    ``buckets`` grows with the vocabulary, not with the documents; it is stored
    with every posting, so a search needs no setting.

    Each document sits in one row, so the partial aggregate collapses its
    repeats before the shuffle, and a frequent term is spread over its documents.
    """
    words = docs.select(key, tokens(F.col(on)).alias("_t")).select(key, F.size("_t").alias("length"), F.explode("_t").alias("term"))
    postings = words.groupBy("term", key, "length").agg(F.count("*").alias("tf"))
    return postings.withColumns({"buckets": F.lit(buckets), "bucket": F.pmod(F.hash("term"), F.lit(buckets))})


def search_index(index: DataFrame, key: str, query: str, limit: int | None, n_docs: float, avg_length: float) -> DataFrame:
    """BM25 from the index: the term filter prunes buckets and row groups of the written postings."""
    terms = sorted(set(question_tokens(query)))
    known = index.select("buckets").first()
    made = index.sparkSession.createDataFrame([(t,) for t in terms], "t string").select(F.pmod(F.hash("t"), F.lit(known[0] if known else 1)))
    buckets = F.col("bucket").isin([r[0] for r in made.collect()])
    hits = index.filter(buckets & F.col("term").isin(terms))
    frequency = hits.groupBy("term").agg(F.count("*").alias("df")).agg(F.map_from_entries(F.collect_list(F.struct("term", "df")))).scalar()  # one entry per query term
    score = _idf(F.lit(float(n_docs)), F.element_at(frequency, F.col("term"))) * _weight(F.col("tf").cast("double"), F.col("length"), F.lit(avg_length))
    scored = hits.groupBy(key).agg(rounded(F.sum(score), 6).alias("score"))
    return scored if limit is None else scored.orderBy(F.desc("score"), key).limit(limit)


def write_index(docs: DataFrame, path: str, key: str, on: str, columns: list[str], buckets: int = 64) -> None:
    """Store a search index: postings by bucket, the attributes that results show or filter on, and corpus statistics."""
    build_index(docs, key, on, buckets).write.partitionBy("bucket").parquet(f"{path}/postings")
    docs.select(key, *columns).write.parquet(f"{path}/attributes")
    docs.agg(F.count("*").cast("double").alias("n"), (F.sum(F.size(tokens(F.col(on)))) / F.count("*")).alias("avg_length")).write.parquet(f"{path}/statistics")


def _read(spark: SparkSession, path: str) -> tuple[DataFrame, float, float]:
    n, average = spark.read.parquet(f"{path}/statistics").select("n", "avg_length").first()
    return spark.read.parquet(f"{path}/postings"), n, average


def search_stored(spark: SparkSession, path: str, key: str, query: str, columns: list[str], limit: int, where: Column | None = None) -> DataFrame:
    """Best ``limit`` documents of a stored index, with attribute columns; ``where`` filters on attributes before the limit."""
    postings, n, average = _read(spark, path)
    attributes = spark.read.parquet(f"{path}/attributes")
    scored = search_index(postings, key, query, None, n, average)
    if where is not None:
        scored = scored.join(attributes.filter(where).select(key), key, "left_semi")
    top = scored.orderBy(F.desc("score"), key).limit(limit).collect()
    winners = spark.createDataFrame(top, scored.schema)
    return attributes.filter(F.col(key).isin([r[0] for r in top])).select(key, *[c for c in columns if c != key]).join(winners, key).orderBy(F.desc("score"), key)


def search_queries(spark: SparkSession, path: str, key: str, queries: DataFrame, query_key: str, on: str, limit: int) -> DataFrame:
    """Best ``limit`` documents of a stored index for every query text, with their rank.

    Postings of asked terms are dealt by document, once; queries meet them there,
    so a document's sums are made where it lies and no (query, term, document)
    row is shuffled. Ranks are cut to ``limit`` within slices of the documents
    before the final ones.
    """
    postings, n, average = _read(spark, path)
    asked = queries.select(query_key, F.explode(F.array_distinct(tokens(F.col(on)))).alias("term"))
    held = postings.join(write_table(asked.select("term").distinct(), shared_path(spark, "asked-terms")), "term", "left_semi")
    frequency = held.groupBy("term").agg(F.count("*").alias("df"))
    known = write_table(asked.join(frequency, "term"), shared_path(spark, "asked"))  # stored, so that its size is known where it is joined
    score = _idf(F.lit(n), F.col("df")) * _weight(F.col("tf").cast("double"), F.col("length"), F.lit(average))
    scored = held.select("term", key, "tf", "length").repartition(key).join(known, "term").groupBy(query_key, key).agg(rounded(F.sum(score), 6).alias("score"))
    order = [F.desc("score"), F.col(key)]
    cut = scored.withColumn("slice", F.pmod(F.hash(key), F.lit(64))).withColumn("r", F.row_number().over(Window.partitionBy(query_key, "slice").orderBy(*order)))
    best = cut.filter(F.col("r") <= limit).withColumn("rank", F.row_number().over(Window.partitionBy(query_key).orderBy(*order)))
    return best.filter(F.col("rank") <= limit).select(query_key, key, "score", "rank")


def nearest(vectors: DataFrame, key: str, vector: str, query: Column, limit: int) -> DataFrame:
    """Exact top-k by cosine: one pass and a bounded top-k, no shuffle of vectors."""
    asked = vectors.select(key, F.col(vector).alias("_v"), query.alias("_q"))
    scored = asked.select(key, rounded(cosine(F.col("_v"), F.col("_q")), 6).alias("similarity_score"))
    return scored.filter("similarity_score IS NOT NULL").orderBy(F.desc("similarity_score"), key).limit(limit)
