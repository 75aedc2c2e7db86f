"""Text analytics over survey answers, the knowledge base and vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import labels
from tallyloom.functions.numbers import count_when, dbl, mean, rounded, sum_when
from tallyloom.functions.picks import below
from tallyloom.functions.text import answer, classify_of, language_of, round6, sentiment_label, sentiment_of, tokens, with_summary, with_tokens
from tallyloom.operators import vectors
from tallyloom.operators.digest import digest
from tallyloom.operators.search import build_index, nearest, search, search_queries, search_stored, write_index
from tallyloom.plans.products import _customer_360
from tallyloom.sources.lab import Lab
from tallyloom.sources.shared import shared_path
from tallyloom.sources.tables import append_rows, insert_if_absent, write_table

# Labels and the words that describe them (fixed values)
LABELS = {
    "Complaint": ["trash", "idiot", "stupid", "worthless", "pathetic", "moron", "scum", "loser", "clown", "disgusting"],
    "Direction": ["to", "from", "at", "on", "by", "sur", "auf", "zu", "por", "para"],
    "Statement": ["is", "was", "are", "be", "est", "ist", "es"],
    "Listing": ["and", "with", "of", "et", "und", "y"],
}
QUESTION = "What is the answer that was given to this?"


def _texts(lab: Lab) -> DataFrame:
    return lab.feedback()


def _words(df: DataFrame) -> DataFrame:
    return with_tokens(df, "feedback_text")


def _scored(lab: Lab) -> DataFrame:
    return _words(_texts(lab).filter("feedback_text IS NOT NULL")).withColumn("sentiment_score", sentiment_of(F.col("words")))


def sentiment_scores(lab: Lab) -> DataFrame:
    return _scored(lab).select(
        "feedback_id", "customer_id", "nps_score", F.concat(F.left("feedback_text", F.lit(60)), F.lit("...")).alias("feedback_preview"),
        rounded("sentiment_score", 3).alias("sentiment_score"), sentiment_label(F.col("sentiment_score")).alias("sentiment_label"),
    )


def sentiment_by_group(lab: Lab) -> DataFrame:
    return _scored(lab).groupBy("nps_category").agg(
        F.count("*").alias("response_count"), mean("sentiment_score").alias("avg_sentiment"), rounded(F.min("sentiment_score"), 4).alias("min_sentiment"), rounded(F.max("sentiment_score"), 4).alias("max_sentiment")
    )


def mismatch(lab: Lab) -> DataFrame:
    """Sentiment beside the survey score, flagged where the two disagree."""
    s, cat = F.col("sentiment_score"), F.col("nps_category")
    clash = ((cat == "Promoter") & (s < 0)) | ((cat == "Detractor") & (s > 0))
    names = lab.customers().select("customer_id", "company_name", "segment")
    slim = _scored(lab).select("feedback_id", "customer_id", "submitted_date", "nps_score", "nps_category", "sentiment_score")
    return slim.join(names, "customer_id", "left").select(
        "feedback_id", "customer_id", "company_name", "segment", "submitted_date", "nps_score", "nps_category", round6(s).alias("sentiment_score"),
        sentiment_label(s).alias("sentiment_category"), F.when(clash, labels.MOOD["clash"]).otherwise(labels.MOOD["aligned"]).alias("alignment_flag"),
        F.when(s < -0.5, labels.MOOD["escalate"]).when(s < -0.2, labels.MOOD["watch"]).otherwise(labels.MOOD["normal"]).alias("escalation_risk"),
    )


def most_negative(lab: Lab) -> DataFrame:
    worst = _scored(lab).select("feedback_id", "source", round6(F.col("sentiment_score")).alias("sentiment_score"))
    return worst.orderBy("sentiment_score", "feedback_id").limit(20)


def at_risk_feedback(lab: Lab) -> DataFrame:
    """Accounts with low health or a low score, with the mood of their answer."""
    moods = _scored(lab).select(
        "customer_id", "feedback_id", "nps_score", rounded("sentiment_score", 2).alias("sentiment_score"), F.concat(F.left("feedback_text", F.lit(80)), F.lit("...")).alias("feedback_preview")
    )  # scored and cut before the join, so no text is shuffled
    at_risk = lab.customers().join(moods, "customer_id").filter((F.col("health_score") < 75) | (F.col("nps_score") <= 6))
    return at_risk.select("feedback_id", "company_name", "segment", dbl("mrr").alias("mrr"), "health_score", "nps_score", "sentiment_score", "feedback_preview")


def language_found(lab: Lab) -> DataFrame:
    return _words(_texts(lab)).select("feedback_id", "lang", language_of(F.col("words")).alias("detected_language"))


def classified(lab: Lab) -> DataFrame:
    return _words(_texts(lab)).select("feedback_id", classify_of(F.col("words"), LABELS).alias("predicted_category"), F.col("source").alias("actual_category"))


def hashed_counts(df: DataFrame, key: str, on: str, buckets: int) -> DataFrame:
    """(key, bucket, tf): how often a text's words fall into each of ``buckets`` hash buckets."""
    bucket = F.conv(F.substring(F.md5(F.col("word").cast("binary")), 1, 8), 16, 10).cast("bigint") % buckets
    return df.select(key, F.explode(tokens(F.col(on))).alias("word")).groupBy(key, bucket.alias("bucket")).agg(F.count("*").alias("tf"))


def classify_trained(lab: Lab) -> DataFrame:
    """Multinomial naive Bayes over hashed words, learned from four fifths of the labels and applied to every text."""
    size, held = 4096, below(F.col("doc_id"), 300, 5) == 0
    known = lab.raw("labels").filter(F.col("toxic").isNotNull()).select("doc_id", "toxic")
    counts = write_table(hashed_counts(lab.raw("documents"), "doc_id", "text", size), shared_path(lab.spark, "counts"))  # read for learning and for scoring
    train = counts.join(known.filter(~held), "doc_id").groupBy("bucket").agg(sum_when(F.col("toxic") == 1, "tf").alias("t"), sum_when(F.col("toxic") == 0, "tf").alias("c"))
    seen = lab.spark.range(size).withColumnRenamed("id", "bucket").join(train, "bucket", "left").select("bucket", *[F.coalesce(x, F.lit(0)).cast("double").alias(x) for x in ("t", "c")])
    sums = seen.agg(F.struct(F.sum("t").alias("t"), F.sum("c").alias("c"))).scalar()
    weights = seen.select("bucket", (F.log((F.col("t") + 1) / (sums["t"] + size)) - F.log((F.col("c") + 1) / (sums["c"] + size))).alias("w"))
    prior = known.filter(~held).agg(F.log((count_when(F.col("toxic") == 1) + 1) / (count_when(F.col("toxic") == 0) + 1))).scalar()
    scores = counts.join(weights, "bucket").groupBy("doc_id").agg(F.sum(F.col("tf") * F.col("w")).alias("s"))
    joined = lab.raw("documents").select("doc_id").join(scores, "doc_id", "left").join(known, "doc_id", "left")
    return joined.select("doc_id", held.alias("held_out"), (rounded(F.coalesce("s", F.lit(0.0)) + prior, 6) > 0).cast("int").alias("predicted_toxic"), "toxic")


def answers(lab: Lab) -> DataFrame:
    return lab.knowledge_base().select("article_id", answer(F.col("content"), QUESTION).alias("answer"))


def context_answers(lab: Lab) -> DataFrame:
    """The question put to each customer's context text."""
    return prompt_rows(lab).select("customer_id", answer(F.col("context"), "What products does this customer use?").alias("answer"))


def prompt_rows(lab: Lab) -> DataFrame:
    """Context and prompt text per customer from its profile."""
    p = _customer_360(lab)
    text = lambda c: F.col(c).cast("string")
    context = F.concat(
        F.lit("Customer: "), "company_name", F.lit(". Segment: "), "segment", F.lit(". Industry: "), "industry", F.lit(". MRR: $"), F.format_string("%.2f", dbl("total_mrr")),
        F.lit(". Health Score: "), F.coalesce(text("overall_health_score"), F.lit("unknown")), F.lit(". Products: "), F.coalesce("products_list", F.lit("None")),
        F.lit(". Last Login: "), text("days_since_last_login"), F.lit(" days ago"),
    )
    prompt = F.concat_ws("\n", F.lit("Write a short, helpful outreach message for this customer:"), F.concat(F.lit("Customer: "), "company_name"), F.concat(F.lit("Churn Risk: "), "churn_risk"), F.concat(F.lit("Industry: "), "industry"))
    return p.select("customer_id", context.alias("context"), prompt.alias("prompt"))


def document_summaries(lab: Lab) -> DataFrame:
    """Long texts summarised, short ones as they are."""
    body = F.col("feedback_text")
    long = _texts(lab).select("feedback_id", "feedback_text", F.when(F.length(body) > 200, body).alias("long"))
    return with_summary(long, "long", "summary").select("feedback_id", F.coalesce("summary", body).alias("feedback_summary"))


def _weekly(lab: Lab) -> DataFrame:
    return _texts(lab).select("feedback_id", "feedback_text", "nps_category", F.trunc("submitted_date", "week").alias("week_start"))


def weekly_digest(lab: Lab) -> DataFrame:
    return digest(_weekly(lab), ["week_start", "nps_category"], "feedback_id", "feedback_text")


def whole_digest(lab: Lab) -> DataFrame:
    return digest(_weekly(lab), [], "feedback_id", "feedback_text", k=5).withColumn("scope", F.lit("all feedback"))


def _enrich(feedback: DataFrame) -> DataFrame:
    return _words(feedback).select(
        "feedback_id", "customer_id", "submitted_date", "nps_score", "nps_category", round6(sentiment_of(F.col("words"))).alias("sentiment_score"),
        F.length("feedback_text").alias("chars"), language_of(F.col("words")).alias("language"),
    )


def enrich_once(lab: Lab) -> DataFrame:
    """Enriched answers kept in a table; a second load enriches only what is new."""
    path = shared_path(lab.spark, "enriched")
    done = write_table(_enrich(_texts(lab).filter(F.col("submitted_date") < "2024-01-16")), path)
    fresh = insert_if_absent(done, _texts(lab), ["feedback_id"])
    return append_rows(_enrich(fresh), path)


EMBEDDING = 768


def _article_counts(lab: Lab) -> DataFrame:
    """(article_id, bucket, tf) of all articles, stored, as rarity and vectors both read them."""
    counts = hashed_counts(lab.knowledge_base().select("article_id", "content"), "article_id", "content", EMBEDDING)
    return write_table(counts, shared_path(lab.spark, "article-counts"))


def _rarity(lab: Lab, articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bucket, idf) over the articles' counts, and the idf of a bucket that no article has, as one row."""
    base = lab.knowledge_base()
    total = base.agg(F.count("*").cast("double")).scalar()
    return articles.groupBy("bucket").agg(F.count("*").alias("df")).select("bucket", F.log((total + 1) / (F.col("df") + 1)).alias("idf")), base.agg(F.log(F.count("*").cast("double") + 1).alias("idf"))


def embedded(lab: Lab, counts: DataFrame, df: DataFrame, key: str, articles: DataFrame) -> DataFrame:
    """768-dimensional hashed TF-IDF vectors of unit length of all rows of ``df``, from their counts, weighted by rarity among the articles; a text without words has the zero vector."""
    rarity, unseen = _rarity(lab, articles)
    weighted = counts.join(rarity, "bucket", "left").withColumn("w", F.col("tf") * F.coalesce("idf", unseen.scalar()))
    sparse = weighted.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("bucket", "w"))).alias("m"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return df.select(key).join(sparse.select(key, _spread(F.col("m"), F.col("norm")).alias("embedding")), key, "left").select(key, F.coalesce("embedding", _zeros(F.lit(EMBEDDING))).alias("embedding"))


def _zeros(n: Column) -> Column:
    return F.array_repeat(F.lit(0.0), n.cast("int"))


def _spread(entries: Column, norm: Column) -> Column:
    """The vector of sorted (bucket, w) over a norm: one walk over the entries, each behind the zeros of the gap before it."""
    before = lambda i: F.when(i > 0, F.get(entries, i - 1)["bucket"]).otherwise(F.lit(-1))
    value = lambda e: rounded(F.coalesce(e["w"] / F.nullif(norm, F.lit(0.0)), F.lit(0.0)), 6)
    filled = F.flatten(F.transform(entries, lambda e, i: F.concat(_zeros(e["bucket"] - before(i) - 1), F.array(value(e)))))
    return F.concat(filled, _zeros(F.lit(EMBEDDING - 1) - F.element_at(entries, -1)["bucket"]))


def _article_vectors(lab: Lab, articles: DataFrame) -> DataFrame:
    return embedded(lab, articles, lab.knowledge_base().select("article_id"), "article_id", articles)


def hashed_vectors(lab: Lab) -> DataFrame:
    return _article_vectors(lab, _article_counts(lab))


def _vector_index(lab: Lab) -> tuple[str, DataFrame]:
    """An index of the articles' vectors, and the benchmark texts' vectors."""
    path, articles = shared_path(lab.spark, "vector-index"), _article_counts(lab)
    vectors.build(write_table(_article_vectors(lab, articles), f"{path}/embedded"), path, "article_id", "embedding")
    texts = lab.raw("benchmark").select("item_id", "text")
    asked = embedded(lab, hashed_counts(texts, "item_id", "text", EMBEDDING), texts, "item_id", articles)
    return path, write_table(asked, f"{path}/asked")


def _vector_search(lab: Lab, exact: bool) -> DataFrame:
    path, asked = _vector_index(lab)
    store = lambda df, name: write_table(df, shared_path(lab.spark, name))
    found = vectors.search(asked, path, "item_id", "embedding", store, k=5, exact=exact)
    return found.filter("similarity > 0").select("item_id", F.col("key").alias("article_id"), F.col("similarity").alias("similarity_score"), "rank")


def text_vector_search(lab: Lab) -> DataFrame:
    """The five articles nearest to every benchmark text, by the index and exactly."""
    return _vector_search(lab, True)


def text_vector_probed(lab: Lab) -> DataFrame:
    """The same from the probed cells alone."""
    return _vector_search(lab, False)


def vector_topk(lab: Lab) -> DataFrame:
    """The five vectors nearest to the mean vector of label 0 (one row, read as a scalar)."""
    stored = lab.raw("embeddings")
    first = stored.filter("label = 0").select(F.posexplode("embedding").alias("at", "x")).groupBy("at").agg(F.avg(F.col("x").cast("double")).alias("m"))
    query = first.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "m"))), lambda s: s["m"])).scalar()
    return nearest(stored, "vec_id", "embedding", query, 5)


def _benchmark_question(lab: Lab) -> str:
    return lab.raw("benchmark").orderBy("item_id").select("text").first()[0]


def text_search(lab: Lab) -> DataFrame:
    return search(lab.knowledge_base(), "article_id", "content", _benchmark_question(lab), ["category", "product", "title"], 5)


def text_search_filtered(lab: Lab) -> DataFrame:
    return search(lab.knowledge_base(), "article_id", "content", "how is that to be with the and for", ["product"], 3, where=F.col("product") == "en")


def search_knowledge_base(lab: Lab, query: str | None = None, max_results: int = 3) -> DataFrame:
    """Search function with a 300-character excerpt."""
    hits = search(lab.knowledge_base(), "article_id", "content", query or _benchmark_question(lab), ["title", "category", "product", "content"], max_results)
    return hits.select("article_id", "title", "category", "product", F.concat(F.left("content", F.lit(300)), F.lit("...")).alias("content_excerpt"), F.col("score").alias("relevance_score"))


def term_statistics(lab: Lab) -> DataFrame:
    """Document and corpus frequency of every term: the dictionary of the search index."""
    return build_index(lab.knowledge_base(), "article_id", "content").groupBy("term").agg(F.count("*").alias("documents"), F.sum("tf").alias("occurrences"))


def _stored_index(lab: Lab) -> str:
    path = shared_path(lab.spark, "search-index")
    write_index(lab.knowledge_base(), path, "article_id", "content", ["title", "category", "product"])
    return path


def index_search(lab: Lab) -> DataFrame:
    """The same search as ``text_search``, from a written index."""
    return search_stored(lab.spark, _stored_index(lab), "article_id", _benchmark_question(lab), ["category", "product", "title"], 5)


def index_search_filtered(lab: Lab) -> DataFrame:
    return search_stored(lab.spark, _stored_index(lab), "article_id", "how is that to be with the and for", ["product"], 3, where=F.col("product") == "en")


def search_batch(lab: Lab) -> DataFrame:
    """The three best articles for every benchmark text."""
    return search_queries(lab.spark, _stored_index(lab), "article_id", lab.raw("benchmark"), "item_id", "text", 3)


QUERIES = {
    "index_search": index_search, "index_search_filtered": index_search_filtered, "search_batch": search_batch,
    "sentiment": sentiment_scores, "sentiment_by_group": sentiment_by_group, "mismatch": mismatch, "most_negative": most_negative, "at_risk_feedback": at_risk_feedback,
    "language": language_found, "classify": classified, "classify_trained": classify_trained, "answers": answers, "context_answers": context_answers, "prompt_rows": prompt_rows,
    "document_summaries": document_summaries, "weekly_digest": weekly_digest, "whole_digest": whole_digest, "enrich_once": enrich_once, "hashed_vectors": hashed_vectors, "text_vector_search": text_vector_search,
    "vector_topk": vector_topk, "text_search": text_search, "text_search_filtered": text_search_filtered, "search_knowledge_base": search_knowledge_base, "term_statistics": term_statistics,
}

#: Queries whose approximate rows no SQL states.
APPROXIMATE = {"text_vector_probed": text_vector_probed}
