"""Toxicity: a learned lexicon, found also when misspelled, and weighed by its context.

Terms (words, and stems written with a final *) are learned from labelled texts. They form a trie; the Levenshtein automaton
of one edit (also a swap of neighbours) is run over all of the trie at once, its states being made when first met. What
stands around a hit tells quotation from abuse. A logistic model over these counts gives the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

WORDS = re.compile(r"\w+")
#: Words looked at on either side of a hit.
WINDOW = 6
#: Reporting words and quotation marks (quotation), and forms of address (abuse), in the corpus's languages.
REPORTS = frozenset("said says wrote called quote quoted reported according word term dit disait cite citation sagte schrieb zitat zitiert wort dijo escribió cita palabra".split())
ADDRESS = frozenset("you your youre u tu toi vous du dich dir ihr sie usted ustedes vosotros eres".split())
QUOTES = "\"“”„«»‘’"
#: Characters from which on a term is also found with one edit, and lengths of the stems that are tried.
FUZZY, STEMS = 5, (4, 5, 6, 7, 8)
FEATURES = ("hits", "fuzzy", "quoted", "addressed", "weight", "distinct", "share")
#: Distinct words whose hits a worker keeps.
KEPT = 100_000


class Automaton:
    """The lexicon's trie run together with the automaton of one edit; states are sets, numbered when first met."""

    def __init__(self, terms: dict[str, float], forms: dict[str, str] | None = None):
        """forms: words that a stem covers, and the stem; they are what a misspelled word is held against."""
        self.children: list[dict[str, int]] = [{}]
        self.word: dict[int, str] = {}
        self.stem: dict[int, str] = {}
        self.near: dict[int, str] = {}
        for term in terms:
            node = self._add(term.rstrip("*"))
            (self.stem if term.endswith("*") else self.word)[node] = term
            if not term.endswith("*") and len(term) >= FUZZY:
                self.near[node] = term
        for form, stem in (forms or {}).items():
            if len(form) >= FUZZY:
                self.near.setdefault(self._add(form), stem)
        self.sets: list[frozenset] = []
        self.numbers: dict[frozenset, int] = {}
        self.steps: list[dict[str, int]] = []
        self.first = self._state({(0, 0, "")})
        self.known: dict[str, tuple[str, bool] | None] = {}

    def _add(self, word: str) -> int:
        node = 0
        for c in word:
            if c not in self.children[node]:
                self.children[node][c] = len(self.children)
                self.children.append({})
            node = self.children[node][c]
        return node

    def _state(self, items: set) -> int:
        todo = list(items)
        while todo:  # letters of a term that the word lacks
            node, edits, wait = todo.pop()
            if not edits and not wait:
                more = {(child, 1, "") for child in self.children[node].values()} - items
                items |= more
        found = frozenset(items)
        if found not in self.numbers:
            self.numbers[found] = len(self.sets)
            self.sets.append(found)
            self.steps.append({})
        return self.numbers[found]

    def _step(self, state: int, c: str) -> int:
        out: set = set()
        for node, edits, wait in self.sets[state]:
            if wait:
                if wait == c:
                    out.add((node, edits, ""))
                continue
            children = self.children[node]
            if c in children:
                out.add((children[c], edits, ""))
            if not edits:
                out.add((node, 1, ""))
                for x, child in children.items():
                    if x != c:
                        out.add((child, 1, ""))
                        if c in self.children[child]:
                            out.add((self.children[child][c], 1, x))
        number = self.steps[state][c] = self._state(out) if out else -1
        return number

    def find(self, word: str) -> tuple[str, bool] | None:
        """(term, whether it took an edit) for a word in lower case."""
        if word in self.known:
            return self.known[word]
        found = self._find(word)
        if len(self.known) < KEPT:
            self.known[word] = found
        return found

    def _find(self, word: str) -> tuple[str, bool] | None:
        state, stem = self.first, None
        node: int | None = 0
        for c in word:
            node = self.children[node].get(c) if node is not None else None
            if node in self.stem and len(word) > len(self.stem[node]) - 2:
                stem = self.stem[node]
            state = self.steps[state].get(c) if c in self.steps[state] else self._step(state, c)
            if state < 0:
                break
        if node in self.word:
            return self.word[node], False
        if stem:
            return stem, False
        if state >= 0:
            near = [self.near[n] for n, edits, wait in self.sets[state] if not wait and edits and n in self.near]
            if near:
                return min(near), True
        return None


@dataclass
class Model:
    """Terms with their log-odds, and the weights of the standardised features, the last being the constant."""

    terms: dict[str, float] = field(default_factory=dict)
    mean: tuple[float, ...] = (0.0,) * len(FEATURES)
    scale: tuple[float, ...] = (1.0,) * len(FEATURES)
    weights: tuple[float, ...] = (0.0,) * len(FEATURES) + (-3.0,)
    #: Words that a stem among the terms covers, and the stem.
    forms: dict[str, str] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - np.array(self.mean)) / np.array(self.scale) @ np.array(self.weights[:-1]) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def features(text: str, terms: dict[str, float], automaton: Automaton) -> list[float]:
    find = automaton.find
    words = WORDS.findall(text.lower())
    hits = [(k, found) for k, w in enumerate(words) if (found := find(w))]
    if not hits:
        return [0.0] * len(FEATURES)
    spans = [m.span() for m in WORDS.finditer(text)] if any(q in text for q in QUOTES) else None
    exact = fuzzy = quoted = addressed = 0
    weight = 0.0
    for k, (term, edit) in hits:
        around = words[max(0, k - WINDOW) : k] + words[k + 1 : k + 1 + WINDOW]
        in_quotes = False
        if spans and len(spans) == len(words):
            before, after = text[spans[max(0, k - WINDOW)][0] : spans[k][0]], text[spans[k][1] : spans[min(len(spans) - 1, k + WINDOW)][1]]
            in_quotes = any(q in before for q in QUOTES) and any(q in after for q in QUOTES)
        quote = in_quotes or not REPORTS.isdisjoint(around)
        you = not ADDRESS.isdisjoint(around)
        exact += not edit
        fuzzy += edit
        quoted += quote
        addressed += you
        weight += terms[term] * (0.5 if edit else 1.0) * (0.25 if quote and not you else 1.0)
    return [np.log1p(exact), np.log1p(fuzzy), quoted / len(hits), addressed / len(hits), np.log1p(weight), np.log1p(len({t for _, (t, _) in hits})), np.log1p(100 * len(hits) / len(words))]


@common.lean
def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for text, toxic in zip(common.strings(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            words = {w for w in WORDS.findall(text.lower()) if len(w) > 2 and not w.isdigit()}
            own = words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}
            counts.update((t, toxic) for t in own)
        if len(counts) > 300_000:
            yield _flat(counts)
            counts.clear()
    yield _flat(counts)


def _flat(counts: Counter) -> pa.RecordBatch:
    return pa.record_batch([pa.array([t for t, _ in counts], pa.string()), pa.array([y for _, y in counts], pa.int32()), pa.array(list(counts.values()), pa.int64())], names=["term", "toxic", "n"])


def held_out(doc_id: Column) -> Column:
    """Whether crc32(doc_id as text) mod 3 is 1; a null doc_id counts as empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "utf-8")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, most: int = 20_000, least: int = 4, precision: float = 0.9, terms: int = 1000) -> Model:
    """Learns from at most `most` labelled rows (a documented bound, those of the lowest MD5 of doc_id), none held out.

    A term is kept if at least `least` of the texts that have it, and a share of `precision` of them, are toxic; of a stem and
    the words it covers the stem is kept (and the words, if as precise, for their misspellings); at most `terms` of them by log-odds. Where there are no labels of both kinds, the
    model gives every text the same score. Null labels and doc_ids are left out, of several labels of a doc_id the highest
    counts, of several texts the first by its characters.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.md5(F.col("doc_id").cast("string"))).limit(most)
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    sample = common.stored(found.select("text", "toxic"))  # `most` rows
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    good, bad = totals.get(0, 0), totals.get(1, 0)
    if not good or not bad:
        return Model(weights=(0.0,) * len(FEATURES) + (3.0 if bad else -3.0,))
    counted = common.stored(sample.mapInArrow(_term_counts, "term string, toxic int, n long").groupBy("term").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum("n").alias("n")
    ))
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("n") - F.col("bad") + 0.5) / (good + 1))
    best = counted.where((F.col("bad") >= least) & (F.col("bad") >= precision * F.col("n"))).withColumn("odds", odds)
    found = {r["term"]: r["odds"] for r in best.collect()}  # of the words of `most` texts
    lexicon: dict[str, float] = {}
    for term in sorted(found, key=lambda t: (len(t.rstrip("*")), t)):  # short stems first; what they cover goes
        root = term.rstrip("*")
        covered = any(root[:n] + "*" in lexicon for n in STEMS if n < len(root) or (n == len(root) and term.endswith("*")))
        # A stem that only one word makes up is no stem.
        lone = term.endswith("*") and any(abs(found[w] - found[term]) < 1e-9 for w in found if not w.endswith("*") and w.startswith(root))
        if not covered and not lone:
            lexicon[term] = found[term]
    lexicon = dict(sorted(lexicon.items(), key=lambda x: (-x[1], x[0]))[:terms])
    forms = _forms(counted.where((F.col("bad") > 0) & (F.col("bad") >= precision * F.col("n"))), lexicon)
    rows = sample.mapInArrow(_sampled(lexicon, forms), "x array<double>, toxic int").collect()  # `most` rows of seven numbers
    return replace(_logistic(lexicon, np.array([r["x"] for r in rows]), np.array([r["toxic"] == 1 for r in rows], float)), forms=forms)


def _forms(counted: DataFrame, lexicon: dict[str, float]) -> dict[str, str]:
    """The words of the sample that a stem of the lexicon covers, and the stem."""
    stems = [t for t in lexicon if t.endswith("*")]
    if not stems:
        return {}
    covered = F.lit(False)
    for n in STEMS:
        if own := [t[:-1] for t in stems if len(t) == n + 1]:
            covered |= F.substring("term", 1, n).isin(own)
    words = [r["term"] for r in counted.where(~F.col("term").endswith("*") & covered).select("term").collect()]  # of `most` texts
    return {w: next(w[:n] + "*" for n in STEMS if w[:n] + "*" in lexicon) for w in sorted(words)}


def _sampled(lexicon: dict[str, float], forms: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(lexicon, forms)
        for batch in batches:
            x = [features(t, lexicon, automaton) for t in common.strings(batch.column(0))]
            yield pa.record_batch([pa.array(x, pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    return common.lean(run)


def _logistic(lexicon: dict[str, float], x: np.ndarray, y: np.ndarray) -> Model:
    """Newton's method with a small ridge."""
    order = np.lexsort((y, *x.T))  # rows come in no given order; sums then agree between runs
    x, y = x[order], y[order]
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    ridge = np.diag([1.0] * len(FEATURES) + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return Model(lexicon, tuple(mean.tolist()), tuple(scale.tolist()), tuple(w.tolist()))


def _scores(model: Model, keep: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(model.terms, model.forms)
        for whole in batches:
            for batch in common.by_bytes(whole, "text"):
                texts = common.strings(batch.column(batch.schema.get_field_index("text")))
                known: dict[str, list[float]] = {}
                for t in texts:
                    if t not in known:
                        known[t] = features(t, model.terms, automaton)
                score = model.score(np.array([known[t] for t in texts]))
                if keep is None:
                    yield pa.record_batch([batch.column(0), pa.array(score)], names=["doc_id", "score"])
                else:
                    yield batch.filter(pa.array(score < keep))

    return common.lean(run)


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row's whole text.

    Nothing but the text enters the score. Null and empty texts have no hits and get the score of those. Null doc_ids and
    repeated rows stay; an empty table gives no rows; other columns are ignored.
    """
    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = picked.mapInArrow(_scores(model, None), "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_civil(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of `docs` that score below the threshold, all columns as they are."""
    return docs.mapInArrow(_scores(model, threshold), docs.schema)
