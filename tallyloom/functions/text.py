"""Text expressions: tokens, sentiment, language, classification, answers, summaries.

All are built-in expressions evaluated inside the JVM on whole
texts, without a shuffle. Functions named ``*_of`` take a token column made by
``with_tokens``: a text is then split once, however many lists it is compared to.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numbers import rounded

# Sentiment words (fixed values)
POSITIVE = """amazing appreciate awesome beautiful best better brilliant clear comfortable convenient delighted easy effective efficient enjoy
excellent exceptional fantastic fast favorite friendly glad good great happy helpful impressed impressive incredible intuitive love loved
outstanding patient perfect pleasant pleased professional quick recommend reliable responsive satisfied seamless simple smooth solid
stable superb thanks thankful top useful valuable wonderful worth""".split()
NEGATIVE = """angry annoying awful bad broken bug bugs cancel cheaper clown complaint confusing crash crashes difficult disappointed disappointing
disgusting expensive fail failed fails frustrated frustrating hard hate horrible idiot issue issues lack limited loser missing moron painful
pathetic poor problem problems scum slow stagnant stupid terrible trash ugly unhappy unreliable unresponsive unusable useless worse worst
worthless wrong""".split()
NEGATORS = ["not", "no", "never", "without", "hardly"]

# Frequent function words per language (fixed values)
STOP_WORDS = {
    "en": "the of and to a in is that it for was on with be by as this are at from".split(),
    "fr": "de la le et les des un une du pour est qui par dans sur pas au avec que en".split(),
    "de": "der die und in den zu von ein das mit sich auf des ist nicht dem im als eine".split(),
    "es": "de la que el en y los se del las por un no con su una para al es lo".split(),
}


def tokens(c: Column) -> Column:
    """Lower-case words and numbers, of any script."""
    return F.array_remove(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), "")


def with_tokens(df: DataFrame, on: str, name: str = "words") -> DataFrame:
    return df.withColumn(name, tokens(F.col(on)))


def question_tokens(text: str) -> list[str]:
    """The same tokens of a literal, as Python strings."""
    return re.findall(r"[^\W_]+", text.lower())


def sentiment_of(words: Column) -> Column:
    """(positive - negative) / (positive + negative) in [-1, 1]; 0 with no sentiment word.

    A negator directly before a word flips it. Each word is paired with its
    predecessor by zipping the tokens with themselves shifted by one.
    """
    polarity = F.zip_with(
        F.concat(F.array(F.lit("")), words), words,
        lambda before, word: F.when(word.isin(POSITIVE), 1).when(word.isin(NEGATIVE), -1).otherwise(0) * F.when(before.isin(NEGATORS), -1).otherwise(1),
    )
    signs = F.array_remove(polarity, 0)
    # every remaining entry is +1 or -1 (the pair past the last word is 0)
    return F.coalesce(F.aggregate(signs, F.lit(0), lambda a, x: a + x) / F.nullif(F.size(signs), F.lit(0)), F.lit(0.0)).cast("double")


def sentiment_label(score: Column) -> Column:
    return F.when(score > 0.3, "Positive").when(score < -0.3, "Negative").otherwise("Neutral")


def _among(words: Column, allowed: list[str]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(allowed)))


def _most_voted(words: Column, groups: dict[str, list[str]]) -> Column:
    votes = [F.struct(_among(words, ws).alias("n"), F.lit(-i).alias("place"), F.lit(name).alias("name")) for i, (name, ws) in enumerate(groups.items())]
    best = F.array_max(F.array(*votes))
    return F.when(best["n"] > 0, best["name"])


def language_of(words: Column) -> Column:
    """The language whose function words occur most; ties go to the first profile, none found gives NULL."""
    return _most_voted(words, STOP_WORDS)


def classify_of(words: Column, labels: dict[str, list[str]]) -> Column:
    """The label whose describing words occur most; the first of equals, NULL when none occurs."""
    return _most_voted(words, labels)


def sentences(c: Column) -> Column:
    """Trimmed, non-empty stretches between sentence marks and line ends."""
    return F.filter(F.transform(F.split(c, "[.!?\n]+"), lambda s: F.trim(s)), lambda s: F.length(s) > 0)


def answer(context: Column, question: str) -> Column:
    """The sentence of the context that shares most distinct words with the question; the earliest of equals."""
    asked = F.array(*[F.lit(t) for t in dict.fromkeys(question_tokens(question))])
    scored = F.transform(sentences(context), lambda s, i: F.struct(F.size(F.array_intersect(tokens(s), asked)).alias("n"), (-i).alias("at"), s.alias("s")))
    best = F.array_max(scored)
    return F.when(best["n"] > 0, best["s"])


def _stretches(df: DataFrame, items: str, name: str, same: Callable[[Column, Column], Column]) -> DataFrame:
    """Add ``name``: (first, past) of each stretch of neighbours that are the same in a sorted array column."""
    at = lambda i: F.element_at(F.col(items), i)
    places = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items))).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("_firsts", F.filter(places, lambda i: F.when(i == 1, True).otherwise(~same(at(i), at(F.greatest(i - 1, F.lit(1)))))))
    past = F.concat(F.slice("_firsts", 2, F.greatest(F.size("_firsts"), F.lit(1))), F.array(F.size(items) + 1))
    return df.withColumn(name, F.zip_with("_firsts", F.slice(past, 1, F.size("_firsts")), lambda a, b: F.struct(a.alias("first"), b.alias("past")))).drop("_firsts")


def with_summary(df: DataFrame, on: str, name: str, k: int = 2) -> DataFrame:
    """Add the ``k`` sentences whose words are most frequent in the text, in text order; the first of equals.

    The words of all sentences, sorted, stand in stretches whose lengths are
    their counts; sorted again by sentence these give each sentence's mean count.
    Every step sorts or walks arrays of the row: nothing is shuffled. ``sort_array``
    compares the entries themselves, ``array_sort`` calls a comparing function for every pair.
    """
    sents = sentences(F.col(on))
    df = df.withColumn("_sents", F.when(F.col(on).isNotNull(), sents).otherwise(F.array().cast("array<string>")))
    words = F.flatten(F.transform("_sents", lambda s, i: F.transform(tokens(s), lambda w: F.struct(w.alias("w"), i.alias("i")))))
    df = df.withColumn("_words", F.sort_array(words))
    df = _stretches(df, "_words", "_runs", lambda a, b: a["w"] == b["w"])
    counted = F.flatten(F.transform("_runs", lambda r: F.transform(F.slice("_words", r["first"], r["past"] - r["first"]), lambda e: F.struct(e["i"].alias("i"), (r["past"] - r["first"]).alias("n")))))
    blank = F.transform("_sents", lambda s, i: F.struct(i.alias("i"), F.lit(0).alias("n")))  # so that a sentence without words has a score too
    df = df.withColumn("_counts", F.sort_array(F.concat(counted, blank)))
    df = _stretches(df, "_counts", "_parts", lambda a, b: a["i"] == b["i"])
    total = lambda p: F.aggregate(F.slice("_counts", p["first"], p["past"] - p["first"]), F.lit(0).cast("bigint"), lambda a, e: a + e["n"])
    score = lambda p: -total(p).cast("double") / F.greatest(p["past"] - p["first"] - 1, F.lit(1))
    df = df.withColumn("_scores", F.transform("_parts", lambda p: F.struct(score(p).alias("score"), F.element_at(F.col("_counts"), p["first"])["i"].alias("i"))))
    best = F.sort_array(F.transform(F.slice(F.sort_array("_scores"), 1, k), lambda s: s["i"]))
    summary = F.when(F.col(on).isNotNull(), F.array_join(F.transform(best, lambda i: F.element_at(F.col("_sents"), i + 1)), ". "))
    return df.withColumn(name, summary).drop("_sents", "_words", "_runs", "_counts", "_parts", "_scores")


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two numeric arrays; NULL for a zero vector or different lengths."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def round6(c: Column) -> Column:
    return rounded(c, 6)
