"""Extractive digests of groups of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.text import sentences, tokens
from tallyloom.sources.shared import shared_path
from tallyloom.sources.tables import write_table


FREQUENT = 100_000  # weights that every task gets whole, whatever the dictionary's size


def term_weights(told: DataFrame, groups: list[str], words: str) -> DataFrame:
    """(groups, term, tf, w): a term's count in its group and that count times its rarity over all rows, stored."""
    counts = told.select(*groups, F.explode(words).alias("term")).groupBy(*groups, "term").agg(F.count("*").alias("tf"))
    spread = told.select(F.explode(F.array_distinct(words)).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    total = told.agg(F.count("*")).scalar()
    rarity = F.floor(F.lit(1000.0) * F.log((total + 1).cast("double") / F.col("df"))).cast("bigint")
    weights = counts.join(spread, "term").select(*groups, "term", "tf", (F.col("tf") * rarity).alias("w"))
    return write_table(weights, shared_path(told.sparkSession, "term-weights"))


def digest(texts: DataFrame, groups: list[str], key: str, on: str, k: int = 3, min_chars: int = 100, frequent: int = FREQUENT) -> DataFrame:
    """The ``k`` sentences of each group with the highest mean TF-IDF of their distinct terms.

    A term's weight in a group is its count there times its rarity over all
    texts, in whole thousandths so that sums are exact. No text is concatenated or
    shuffled: sentences become (group, place, term) rows, which are counted and
    weighed by term; only the winners' sentences are fetched, by text and place.
    Texts are split into words once, and the words stored. The ``frequent`` greatest counts hold most words: they are weighed where the text
    is read, and a sentence leaves its task as one sum; the rows of all other terms
    meet their weights by term.
    """
    body = F.col(on)
    split = texts.select(*groups, key, tokens(body).alias("_words"), F.transform(sentences(body), lambda s: F.array_distinct(tokens(s))).alias("_places"))
    told = write_table(split, shared_path(texts.sparkSession, "told-words"))
    places = told.select(*groups, key, F.posexplode("_places").alias("position", "_terms"))
    words = places.select(*groups, key, "position", F.size("_terms").alias("_n"), F.explode("_terms").alias("term"))
    weights, by = term_weights(told, groups, "_words"), [*groups, "term"]
    store = shared_path(texts.sparkSession, "frequent-terms")
    common = F.broadcast(write_table(weights.orderBy(F.col("tf").desc(), *by).limit(frequent).drop("tf"), store))  # a bounded table
    weighed = words.join(common, by).unionByName(words.join(common, by, "left_anti").join(weights.drop("tf"), by))
    scored = weighed.groupBy(*groups, key, "position", "_n").agg(F.sum("w").alias("w"))
    best = Window.partitionBy(*groups).orderBy(F.expr("w div _n").desc(), key, "position")
    top = scored.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k).select(key, "position", "r", *[F.col(g).alias(f"_{g}") for g in groups])
    # a bounded table: k rows for each group
    told = texts.join(top, key).withColumn("sentence", F.get(sentences(body), F.col("position")))
    picked = told.groupBy(*groups).agg(F.array_sort(F.collect_list(F.struct("r", "sentence"))).alias("_s"))

    sizes = texts.groupBy(*groups).agg(F.sum(F.length(body)).alias("chars"), F.count("*").alias("texts"))
    sized = picked.join(sizes, groups) if groups else picked.withColumn("_z", sizes.select(F.struct("chars", "texts")).scalar()).select("_s", "_z.*")
    return sized.filter(F.col("chars") > min_chars).select(*groups, "texts", F.array_join("_s.sentence", ". ").alias("digest"))
