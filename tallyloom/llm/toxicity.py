"""Toxicity scores from a lexicon that tolerates misspellings and tells abuse from quotation.

Terms come from labelled documents: words, and stems that many words of
a toxic document begin with, which toxic documents use far more often than
others; near copies count once. They form a trie. A Levenshtein automaton for one edit is run over the
trie: its states, sets of (trie node, edits so far), are made as
words ask for them and kept, so scanning a word is a walk over a deterministic
automaton and most words die within a few letters.

Every word is also found with one edit, and such hits are counted apart from exact
ones. A word of more than ``EDIT_LETTERS`` letters takes any edit. Of a shorter
word, one letter away from much clean prose, an edit is one of those that disguise:
a digit or symbol for a letter, a doubled letter, two neighbours swapped. Stems, the
beginnings of any number of words, must match exactly.

A hit is judged by the words around it: within quotation marks or near a verb of
reporting it counts as quoted, else as abuse. A logistic model over these counts
gives the score. An edited hit weighs what an exact one does until the sample tells
otherwise: the fit draws its weights towards that. It is fitted on a bounded sample: ``sample`` labelled documents
of each class at most, chosen by a hash of their ids, half of them for the terms
and half for the weights; at most ``most_terms`` terms. Everything else is
done for each text by itself.

Inputs of a score are the words of the text alone. Null and empty texts get the
score of a text without hits. Null or missing labels teach nothing. Without any
label of both classes the stated SEEDS and weights serve. Rows that
repeat are scored alike. Empty tables give no rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import modest_batches, packed_rows, stored

SAMPLE, MOST_TERMS = 3000, 2000
STEMS = (4, 5, 6, 7)  # lengths of stems
EDGE = ".,;:!?()[]{}<>*_-\"'`“”„‘’«»…"
# Words that insult in any context (a small stated lexicon; the rest is learned)
SEEDS = ("idiot", "moron", "stupid", "scum", "trash", "loser", "worthless", "pathetic", "disgusting", "imbecile", "bastard", "asshole", "bitch", "retard", "whore")
# Verbs and nouns of reporting
REPORT = frozenset("said says say wrote writes called calls quoted quotes quote cited term word insult slur dijo dice dit sagte sagt schrieb nannte".split())
MARKS = "\"“”„«»"
EDIT_LETTERS = 6  # words of more letters take any edit
LEAST_LETTERS = 4  # shorter words must match exactly
ODDS = 20  # a learned term is this many times as frequent in toxic documents
CONTEXT = 6  # words before a hit that are looked at
WEIGHTS = (-4.0, 5.0, 1.5, 1.0, 5.0, 5.0)  # intercept, any abuse, more abuse, quoted, edited long words, disguised ones; used without labels
NONE, EXACT, EDITED, DISGUISED = range(4)


class Lexicon:
    """Trie of words and stems, and the automaton of words within one edit of a term.

    A state holds (node, kind): nothing edited yet, any one edit, an edit that
    disguises, or the letter that must follow to complete a swap.
    """

    def __init__(self, terms: list[str]):
        """``terms``: words, or stems with a closing star."""
        self.children: list[dict[str, int]] = [{}]
        self.letter = [""]  # that leads to the node
        self.word = [0]  # letters of the word that ends here
        self.stem = [False]
        for term in terms:
            node = 0
            for c in term.rstrip("*"):
                node = self.children[node].setdefault(c, len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.letter.append(c)
                    self.word.append(0)
                    self.stem.append(False)
            if term.endswith("*"):
                self.stem[node] = True
            else:
                self.word[node] = len(term)
        self.start = self._closed({(0, EXACT)})
        self.steps: dict[frozenset, dict[str, frozenset]] = {}
        self.known: dict[str, int] = {}

    def _closed(self, state) -> frozenset:
        """With the terms' letters that the word leaves out."""
        return frozenset(state | {(child, EDITED) for node, kind in state if kind == EXACT for child in self.children[node].values()})

    def _step(self, state: frozenset, c: str) -> frozenset:
        out = set()
        for node, kind in state:
            if isinstance(kind, str):
                if kind == c:
                    out.add((node, DISGUISED))
                continue
            child = self.children[node].get(c)
            if child is not None:
                out.add((child, kind))
            if kind == EXACT:
                nexts = self.children[node].values()
                out.add((node, EDITED))
                out.update((x, EDITED) for x in nexts)
                if not c.isalpha():
                    out.update((x, DISGUISED) for x in nexts)
                if self.letter[node] == c:
                    out.add((node, DISGUISED))
                out.update((self.children[x][c], self.letter[x]) for x in nexts if c in self.children[x] and self.letter[x] != c)
        return self._closed(out) if out else frozenset()

    def holds(self, word: str) -> int:
        """How the word is a term: NONE, EXACT, EDITED (a long word with any edit) or DISGUISED."""
        got = self.known.get(word)
        if got is None:
            got = self._walk(word)
            if len(self.known) < 400_000:
                self.known[word] = got
        return got

    def _walk(self, word: str) -> int:
        state = self.start
        for c in word:
            steps = self.steps.get(state)
            if steps is None:
                if len(self.steps) > 50_000:
                    self.steps.clear()
                steps = self.steps[state] = {}
            after = steps.get(c)
            if after is None:
                after = steps[c] = self._step(state, c)
            state = after
            if not state:
                return NONE
            if any(kind == EXACT and self.stem[node] for node, kind in state):
                return EXACT
        found = {kind for node, kind in state if self.word[node] and (kind == EXACT or self.word[node] > EDIT_LETTERS or kind == DISGUISED and self.word[node] >= LEAST_LETTERS)}
        return next((k for k in (EXACT, DISGUISED, EDITED) if k in found), NONE)

    def counts(self, text: str) -> tuple[int, int, int, int]:
        """Exact hits as abuse, hits as quotation, and as abuse long words with an edit and disguised words."""
        words = text.lower().split()
        bare = [w.strip(EDGE) for w in words]
        hits = [i for i, w in enumerate(bare) if w and self.holds(w)]
        if not hits:
            return 0, 0, 0, 0
        found = [0, 0, 0, 0]
        for i in hits:
            before = range(max(0, i - CONTEXT), i)
            opened = sum(words[j].count(m) for j in before for m in MARKS) + sum(words[i][: words[i].find(bare[i])].count(m) for m in MARKS)
            if opened % 2 == 1 or any(bare[j] in REPORT for j in before):
                found[1] += 1
            else:
                found[{EXACT: 0, EDITED: 2, DISGUISED: 3}[self.holds(bare[i])]] += 1
        return tuple(found)


@lru_cache(maxsize=2)
def _lexicon(terms: tuple[str, ...]) -> Lexicon:
    return Lexicon(list(terms))


def features(counts: np.ndarray) -> np.ndarray:
    abuse, quoted, edited, disguised = counts.T
    return np.column_stack([np.ones(len(abuse)), abuse > 0, np.log1p(abuse), np.log1p(quoted), np.log2(1 + edited), np.log2(1 + disguised)]).astype(float)


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, towards: np.ndarray | None = None) -> np.ndarray:
    """Weights of a logistic model, by Newton's method, drawn ``towards`` given ones, or zero."""
    prior = np.zeros(x.shape[1]) if towards is None else towards
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * (w - prior))
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_model(counts: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of all features: first without edited hits, then with them, drawn towards the weight of an exact hit."""
    x = features(counts)
    exact = fit_weights(x[:, :4], y)
    one = exact[1] + exact[2] * np.log(2)
    return fit_weights(x, y, towards=np.array([*exact, one, one]))


def _learned_terms(texts: DataFrame, most: int) -> list[str]:
    """Words and stems that toxic documents of (text, toxic) hold far more often than others."""
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    forms = F.flatten(F.transform(words, lambda w: F.filter(F.concat(F.array(w), *[F.array(F.when(F.length(w) > n, F.concat(F.substring(w, 1, n), F.lit("*")))) for n in STEMS]), lambda s: s.isNotNull() & (F.length(s) >= 4))))
    seen = texts.select("toxic", F.explode(F.array_distinct(forms)).alias("term")).groupBy("term").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    totals = texts.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    toxic, clean = (totals[0] or 0), (totals[1] or 0)
    if not toxic or not clean:
        return []
    # so much more frequent in toxic documents that chance cannot explain it, even for a term that clean ones lack
    common = seen.where((F.col("t") >= max(4, 0.01 * toxic)) & (F.col("t") / toxic >= ODDS * (F.col("c") + 1) / clean))
    rows = common.orderBy(F.col("t").desc(), "term").limit(most).collect()
    # a stem whose documents one word accounts for adds nothing but chance hits
    words = {r["term"]: r["t"] for r in rows if not r["term"].endswith("*")}
    most_of = lambda stem: max((t for w, t in words.items() if w.startswith(stem)), default=0)
    rows = [r for r in rows if not r["term"].endswith("*") or most_of(r["term"][:-1]) < 0.8 * r["t"]]
    found = [r["term"] for r in rows]
    stems = {t[:-1] for t in found if t.endswith("*")}
    covered = lambda t: any(t[:n] in stems for n in STEMS if n < len(t.rstrip("*")))
    return [t for t in found if not covered(t)]


class Model:
    def __init__(self, terms: list[str], weights):
        self.terms, self.weights = tuple(terms), tuple(float(w) for w in weights)

    def score(self, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features(counts) @ np.array(self.weights), -30, 30)))


COUNTS = ["abuse", "quoted", "edited", "disguised"]


def _counted(terms: tuple[str, ...], texts: pa.Array) -> np.ndarray:
    lexicon = _lexicon(terms)
    return np.array([lexicon.counts(t.as_py() or "") for t in texts], dtype=np.int64).reshape(-1, 4)


def _one_of_alike(texts: DataFrame) -> DataFrame:
    """Of texts that share the least hash of their five-word shingles, under either of two seeds, the one whose id has the least hash.

    Near copies mostly share one; texts that share a header alone mostly do not.
    """
    for seed in (1, 2):
        words = F.split(F.lower("text"), r"\s+")
        least = F.array_min(F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - 4, F.lit(1))), lambda i: F.xxhash64(F.slice("w", i, 5), F.lit(seed))))
        named = texts.withColumn("w", words).withColumn("least", least)
        texts = named.groupBy("least").agg(F.min_by(F.struct("id", "text", "toxic"), F.struct(F.xxhash64("id"), F.col("id"))).alias("row")).select("row.*")
    return texts


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most_terms: int = MOST_TERMS) -> Model:
    """Model from documents with a label; ``labels`` (doc_id, toxic) holds those alone that may be learned from."""
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    order = F.xxhash64("id")
    # at most 2 * sample rows of two numbers: small enough to send everywhere
    chosen = F.broadcast(known.where("toxic = 1").orderBy(order).limit(sample).unionByName(known.where("toxic = 0").orderBy(order).limit(sample)))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text")).join(chosen, "id")
    # copies would lend their words weight
    texts = _one_of_alike(stored(texts.select("id", "text", "toxic"), "sampled"))
    texts = stored(texts.select("id", "text", "toxic"), "labelled")
    terms = texts.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)) == 0)
    rest = texts.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)) == 1)
    lexicon = tuple(sorted(set(_learned_terms(terms, most_terms)) | set(SEEDS)))

    def each(batches):
        for batch in batches:
            counts = _counted(lexicon, batch.column(0))
            yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in counts.T], batch.column(1)], names=[*COUNTS, "toxic"])

    counts = modest_batches(rest.select("text", "toxic")).mapInArrow(each, ", ".join(f"{c} long" for c in COUNTS) + ", toxic int")
    rows = counts.groupBy(*COUNTS, "toxic").count().orderBy(*COUNTS, "toxic").collect()  # at most a row for each sampled document
    n = np.array([r["count"] for r in rows], dtype=int)
    found = np.repeat(np.array([[r[c] for c in COUNTS] for r in rows], dtype=np.int64).reshape(-1, 4), n, axis=0)
    y = np.repeat([r["toxic"] for r in rows], n)
    if len(y) == 0 or y.min() == y.max():
        return Model(list(lexicon), WEIGHTS)
    return Model(list(lexicon), fit_model(found, y.astype(float)))


def held_out(doc_id: Column) -> Column:
    """Documents that labels are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def learn_without_held_out(docs: DataFrame, labels: DataFrame, **bounds) -> Model:
    return learn(docs, labels.where(~held_out(F.col("doc_id"))), **bounds)


def _scored(model: Model, rows: DataFrame) -> DataFrame:
    """``rows`` (text, row) as (row, score) and the counts."""

    def each(batches):
        for batch in batches:
            counts = _counted(model.terms, batch.column(0))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(model.score(counts)), *[pa.array(c) for c in counts.T]], names=["row", "score", *COUNTS])

    kind = rows.schema["row"].dataType.simpleString()
    return modest_batches(rows.select("text", "row")).mapInArrow(each, f"row {kind}, score double, " + ", ".join(f"{c} long" for c in COUNTS))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, abuse, quoted, edited, disguised."""
    rows = docs.select(F.col("doc_id").cast("long").alias("row"), F.col("text").alias("text"))
    out = _scored(model, rows).withColumnRenamed("row", "doc_id")
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *COUNTS)


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not toxic, all their columns unchanged."""
    return _scored(model, docs.select(F.col("text").alias("text"), packed_rows(docs).alias("row"))).where("score < 0.5").select("row.*")
