"""Toxicity: misspelled and inflected lexicon terms in context, weighed by a small model.

The lexicon is learned: of the words of a bounded sample of labelled documents, those
beginnings that stand in many different places of toxic documents and hardly anywhere
else. Each word of a text is held against it by a Levenshtein automaton intersected
with the lexicon's trie. The words around a hit tell quotation from abuse: quotation
marks and words of reporting or discussion nearby. A logistic model over the hits of
each sort gives the score; it is fitted to the other half of the sample.

Defined results for odd input: a null or empty text has no hits and the lowest score;
texts are scored whole, however long; repeated rows each give a row; an empty table
gives none; without labels of both kinds every score is 0; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytally.llm.common import let, materialised, slices
from paytally.llm.folds import held_out, learnable, sample_per_class
from paytally.llm.lexicon_match import Lexicon, Match, Term

# Labelled documents learned from, about this many of each label.
SAMPLE_DOCS = 6000
# A term stands in this many different contexts of toxic documents at least, and in at
# most an eighth as many of the others. At most MOST_TERMS, the most frequent ones. A
# word with a third as many contexts elsewhere as in toxic documents is harmless.
LEAST_CONTEXTS = 8
PURITY = 8
HARMLESS = 3
SHORTEST, LONGEST, MOST_TERMS = 3, 24, 2000
PREDICTED_FROM = 0.3
CONTEXT = 6
MOST_EVIDENCE = 12.0
MOST_KNOWN = 400_000

_WORD = re.compile(r"[^\W\d_]+")
# Between two letters, U+2018 and U+2019 are apostrophes.
_TOKEN = re.compile(r"[^\W\d_]+|[\"“”„«»‹›]|(?<![^\W\d_])[‘’]|[‘’](?![^\W\d_])")
# Parts of words with one or two digits or signs between them.
_JOINED = re.compile(
    r"(?<![^\W\d_])[^\W\d_]++(?:(?:[\d_]|[^\w\s\"“”„«»‘’‹›']){1,2}+[^\W\d_]++)++"
)
_MARKS = frozenset("\"“”„«»‘’‹›")
# Words that report or discuss what somebody said.
_REPORTING = frozenset(
    "said says quote quoted quotes wrote called term word slur insult "
    "dit écrit cité mot insulte sagte schrieb zitat wort beleidigung "
    "dijo escribió cita palabra insulto".split()
)


def learn_lexicon(sample: DataFrame) -> tuple[list[Term], frozenset[str]]:
    """Terms from ``sample`` (text, toxic), and words below them that are harmless.

    Counted by Spark over words in context: a context is the word with the one before
    it, so copies of a document count once. A word that is about as much at home
    elsewhere is harmless itself, and says nothing for or against its beginnings: a
    stem may have innocent relatives.
    """
    words = F.split(F.lower("text"), r"[^\p{L}]+")

    def with_before(w):
        before = lambda i: F.coalesce(F.get(w, i - 1), F.lit(""))
        return F.transform(w, lambda x, i: F.struct(x.alias("word"), before(i).alias("before")))

    placed = sample.select("toxic", F.explode(let(words, with_before)).alias("p"))
    contexts = (
        placed.select("p.word", "p.before", "toxic")
        .where(F.char_length("word") >= SHORTEST)
        .groupBy("word", "before")
        .agg(F.max("toxic").alias("toxic"), F.min("toxic").alias("all_toxic"))
    )
    word = F.substring("word", 1, LONGEST)
    counted = contexts.groupBy(word.alias("word")).agg(
        F.sum("toxic").alias("bad"), F.count_if(F.col("all_toxic") == 0).alias("good")
    )
    at_home = (F.col("good") >= 2) & (F.col("good") * HARMLESS >= F.col("bad"))
    counted = materialised(counted.withColumn("harmless", at_home), "words")
    starts = counted.select(
        "bad",
        "good",
        "word",
        "harmless",
        F.explode(F.sequence(F.lit(SHORTEST), F.char_length("word"))).alias("n"),
    ).select("bad", "good", "harmless", F.expr("substring(word, 1, n)").alias("start"), "word")
    whole = F.when(F.col("word") == F.col("start"), F.col("bad"))
    totals = (
        starts.where("NOT harmless")
        .groupBy("start")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.sum(whole).alias("whole"))
    )
    pure = totals.where(
        (F.col("bad") >= LEAST_CONTEXTS) & (F.col("good") * PURITY <= F.col("bad"))
    )
    ranked = pure.orderBy(F.desc("bad"), F.char_length("start"), "start").limit(
        MOST_TERMS * LONGEST
    )
    rows = {r.start: r for r in ranked.collect()}
    usual = counted.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    usual_odds = ((usual.bad or 0) + 1) / ((usual.good or 0) + 1)
    terms = [
        Term(
            t.text,
            t.is_stem,
            max(0.5, log((rows[t.text].bad + 0.5) / (rows[t.text].good + 0.5) / usual_odds)),
        )
        for t in _terms({s: (r.bad, r.whole or 0) for s, r in rows.items()})
    ]
    if not terms:
        return [], frozenset()
    stems = sample.sparkSession.createDataFrame([(t.text,) for t in terms], "start string")
    relatives = starts.where("harmless").join(F.broadcast(stems), "start").select("word")
    return terms, frozenset(r.word for r in relatives.distinct().collect())


def _terms(pure: dict[str, tuple[int, int]]) -> list[Term]:
    """Of pure beginnings: the shortest ones, drawn out while they lose no support."""
    found: dict[str, Term] = {}
    longer: dict[str, list[str]] = {}
    for start in pure:
        longer.setdefault(start[:-1], []).append(start)
    for start in sorted(pure, key=lambda s: (len(s), s)):
        if any(start[:k] in pure for k in range(SHORTEST, len(start))):
            continue
        while True:
            bad, whole = pure[start]
            more = [s for s in longer.get(start, []) if pure[s][0] >= 0.98 * bad]
            if whole >= 0.9 * bad or not more:
                break
            start = more[0]
        found[start] = Term(start, whole < 0.9 * bad)
    ordered = sorted(found.values(), key=lambda t: (-pure[t.text][0], t.text))
    return ordered[:MOST_TERMS]


def joined_words(text: str) -> list[list[tuple[str, list[str]]]]:
    """Words with digits or signs inside, each with its parts: for each chain of joined
    parts, two and three of them that follow each other, as written."""
    chains = []
    for chain in _JOINED.finditer(text):
        parts = list(_WORD.finditer(chain.group()))
        windows = []
        for k in range(len(parts) - 1):
            for some in (parts[k : k + 2], parts[k : k + 3])[: len(parts) - k - 1]:
                word = chain.group()[some[0].start() : some[-1].end()]
                windows.append((word, [p.group() for p in some]))
        chains.append(windows)
    return chains


class HitCounter:
    """Evidence of abusive hits, and numbers of quoted and misspelled ones, of texts.

    Evidence is rounded to quarters, so that few different cases are told apart. A word
    with digits or signs inside is a misspelling if it is near a term as written, and
    none of its parts is a word of its own that says something.
    """

    def __init__(self, terms: list[Term], harmless: frozenset[str], wide: bool = False) -> None:
        self.lexicon = Lexicon(terms, wide)
        self.harmless = harmless
        self.wide = wide
        self.known: dict[str, Match | None] = {}

    def _learn(self, words: set[str]) -> None:
        if len(self.known) > MOST_KNOWN:
            self.known = {}
        match, known = self.lexicon.match, self.known
        for word in words:
            if word not in known:
                found = match(word)
                if found and word in self.harmless:
                    found = None
                known[word] = found

    def hits(self, texts: list[str]) -> Iterator[tuple[float, int, int]]:
        for first, last in slices(map(len, texts)):
            lower = [t.lower() for t in texts[first:last]]
            own = [_WORD.findall(t) for t in lower]
            joined = [joined_words(t) if self.wide else [] for t in lower]
            self._learn(
                {w for words in own for w in words}
                | {w for chains in joined for chain in chains for w, _ in chain}
            )
            known = self.known
            for text, words, chains in zip(lower, own, joined, strict=True):
                abuse, quoted, misspelled = 0.0, 0, 0
                if any(known[w] for w in words):
                    abuse, quoted, misspelled = self._in_context(text)
                if chains:
                    misspelled = min(9, misspelled + self._across(chains))
                yield abuse, quoted, misspelled

    def _across(self, chains: list[list[tuple[str, list[str]]]]) -> int:
        """Number of hits that only words with digits or signs inside give."""
        known, count = self.known, 0
        for windows in chains:
            # Hits of one chain overlap more often than not, and count once.
            count += any(
                known[word] and not any(known[p] or p in self.harmless for p in parts)
                for word, parts in windows
            )
        return count

    def _in_context(self, text: str) -> tuple[float, int, int]:
        tokens = _TOKEN.findall(text)
        known, abuse, quoted, misspelled = self.known, 0.0, 0, 0
        for i, token in enumerate(tokens):
            found = known.get(token) if token not in _MARKS else None
            if not found:
                continue
            before = tokens[max(0, i - CONTEXT) : i]
            after = tokens[i + 1 : i + 1 + CONTEXT]
            within = any(t in _MARKS for t in before) and any(t in _MARKS for t in after)
            told = any(t in _REPORTING for t in before) or any(t in _REPORTING for t in after)
            if found.errors:
                misspelled += 1
            elif within or (told and any(t in _MARKS for t in before + after)):
                quoted += 1
            else:
                abuse += self.lexicon.terms[found.term].evidence
        return min(MOST_EVIDENCE, round(4 * abuse) / 4), min(9, quoted), min(9, misspelled)


def misspellings(sample: DataFrame, terms: list[Term]) -> frozenset[str]:
    """Words of documents that are not toxic which come near a term: not misspellings.

    Their number is bounded by that of the strings near a bounded lexicon.
    """
    shared = sample.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, seen = Lexicon(shared.value, wide=True), set()
        for batch in batches:
            words = set()
            for text in batch.column(0).to_pylist():
                text = text.lower()
                words.update(_WORD.findall(text))
                words.update(w for chain in joined_words(text) for w, _ in chain)
            words -= seen
            seen |= words
            near = [w for w in words if (m := lexicon.match(w)) and m.errors]
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], names=["word"])

    clean = sample.where("toxic = 0").select("text")
    rows = clean.mapInArrow(run, "word string").distinct()
    return frozenset(r.word for r in rows.collect())


def _vector(abuse, quoted, misspelled) -> list:
    """What the model sees: the evidence, and whether and how many other hits there are."""
    abuse = np.asarray(abuse, float)
    one = [np.ones_like(abuse), abuse]
    for n in (quoted, misspelled):
        n = np.asarray(n, float)
        one += [(n > 0).astype(float), np.log1p(n)]
    return one


def fit(hits: np.ndarray, toxic: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton steps over distinct (abuse, quoted, misspelled)."""
    x = np.stack(_vector(*hits.T), axis=1)
    # Hits never speak against toxicity; where there are none to learn from, a
    # misspelling counts somewhat and a quotation little.
    prior = np.array([-3.0, 0.8, 1.0, 0.2, 2.0, 0.5])
    w, free = prior.copy(), np.ones(len(prior), bool)
    while True:
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (weight * (toxic - p)) - ridge * (w - prior)
            bend = (x.T * (weight * p * (1 - p))) @ x + ridge * np.eye(len(w))
            step = np.zeros_like(w)
            step[free] = np.linalg.solve(bend[np.ix_(free, free)], slope[free])
            # No step is longer than one, so that saturated cases cannot throw it off.
            w = w + step / max(1.0, np.abs(step).max())
            if np.abs(step).max() < 1e-9:
                break
        # What would speak against toxicity is left at nothing, and the others fitted again.
        below = np.concatenate([[False], w[1:] < 0])
        if not below.any():
            break
        w[below], free[below] = 0.0, False
    return w


def train(docs: DataFrame, labels: DataFrame) -> tuple[list[Term], frozenset[str], np.ndarray]:
    """Lexicon, words near it that are harmless, and weights; nothing held out is read."""
    judged = (
        labels.where(F.col("toxic").isin(0, 1) & learnable())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    chosen = sample_per_class(judged, "toxic", SAMPLE_DOCS)
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    # Bounded by SAMPLE_DOCS, so small enough for every task.
    sample = materialised(texts.join(F.broadcast(chosen), "doc_id"), "labelled")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(3))
    terms, relatives = learn_lexicon(sample.where(half > 0))
    harmless = relatives | misspellings(sample.where(half > 0), terms)
    shared = docs.sparkSession.sparkContext.broadcast((terms, harmless))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = HitCounter(*shared.value, wide=True)
        for batch in batches:
            found = list(counter.hits([t or "" for t in batch.column(1).to_pylist()]))
            columns = list(zip(*found, strict=True)) or [[], [], []]
            arrays = [batch.column(0), *(pa.array(c, pa.float64()) for c in columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=["toxic", "abuse", "quoted", "odd"])

    counted = (
        sample.where(half == 0)
        .select("toxic", "text")
        .mapInArrow(run, "toxic int, abuse double, quoted double, odd double")
        .groupBy("toxic", "abuse", "quoted", "odd")
        .count()
        .toPandas()
    )
    if counted["toxic"].nunique() < 2:
        return [], frozenset(), np.array([-50.0] + [0.0] * 5)
    n = counted["count"].to_numpy(float)
    toxic = counted["toxic"].to_numpy(float)
    # Both labels weigh as they do among all labelled documents.
    shares = {r.toxic: r["count"] for r in judged.groupBy("toxic").count().collect()}
    for label in (0, 1):
        mine = toxic == label
        n[mine] *= shares[label] / sum(shares.values()) * n.sum() / n[mine].sum()
    return terms, harmless, fit(counted[["abuse", "quoted", "odd"]].to_numpy(float), toxic, n)


def scores(docs: DataFrame, model: tuple[list[Term], frozenset[str], np.ndarray]) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    frame = docs.select(*(F.col(f"`{c}`") for c in kept), F.col("text").alias("__text"))
    schema = docs.select(*(F.col(f"`{c}`") for c in kept)).schema
    schema = schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, harmless, weights = shared.value
        counter = HitCounter(terms, harmless, wide=True)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            hits = np.array(list(counter.hits(texts)), float).reshape(-1, 3)
            found = 1 / (1 + np.exp(-np.clip(np.stack(_vector(*hits.T), axis=1) @ weights, -30, 30)))
            arrays = [
                *batch.columns[:-1],
                pa.array(found),
                pa.array((found >= PREDICTED_FROM).astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return frame.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs``."""
    narrow = docs.select("doc_id", held_out().alias("held_out"), "text")
    return scores(narrow, train(docs, labels)).drop("text")
