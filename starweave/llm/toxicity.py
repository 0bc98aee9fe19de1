"""Toxicity (6): Levenshtein automata intersected with a lexicon trie, and context windows.

The lexicon is learned from labelled rows: the nodes of the trie of all their
words that many toxic and hardly any other documents reach, each term being
prolonged as long as nearly all documents follow; a term is a whole word, or a
stem that any ending may follow. A word is read through one deterministic
automaton, built as it is needed: its states are the sets of (trie node, edits)
that a Levenshtein automaton over the trie can be in. So one pass over a word's
letters finds all terms within their allowance of edits.

Every hit is seen in its context: whether quotation marks stand around it, and
how many other hits lie in the window of words around it. A logistic model over
these features gives the score.

Defined results: a NULL, blank or clean text has the score of no hit; repeated
rows have equal scores; without usable labels all scores are 0; extra columns
are ignored (and kept by :func:`keep_clean`); empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ._labels import labelled, remainder
from ._tokens import ALNUM, Memo, chunks, words

#: Labelled documents of each class that the lexicon and the model are learned from.
LABELLED = 4000
#: A term is in this share of the toxic documents at least, and this many times as often as in others.
SUPPORT, RATIO = 0.02, 20.0
#: A longer term replaces its beginning if it keeps this share of its documents.
FOLLOW = 0.9
SHORTEST, LONGEST = 3, 12
#: Words on either side of a hit that are its context.
CONTEXT = 12
#: What a misspelled term counts against the term itself.
MISSPELLED = 0.7
THRESHOLD = 0.7
HELD_OUT, FOLDS = 1, 3
_QUOTES = set("\"'“”„«»‘’‹›`")
#: Distinct words a Python worker remembers.
CACHE = 1 << 19


def edits_allowed(term: str, whole: bool) -> int:
    """Edits a misspelling of the term may have: short terms, and short stems, must be exact."""
    if len(term) < (5 if whole else 6):
        return 0
    return 2 if whole and len(term) >= 9 else 1


class Lexicon:
    """A trie of terms with one lazily built automaton: ``match(word)`` is the best (term, edits) or None."""

    def __init__(self, terms: list[tuple[str, bool]]):
        self.terms = sorted(set(terms))
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.reach = [0]  # the largest allowance below a node
        for t, (term, whole) in enumerate(self.terms):
            node, most = 0, edits_allowed(term, whole)
            self.reach[0] = max(self.reach[0], most)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.reach.append(0)
                node = self.children[node][c]
                self.reach[node] = max(self.reach[node], most)
            self.ends[node].append(t)
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.steps: list[dict[str, int]] = []
        self.results: list[tuple[int, int] | None] = []
        self.begin = self._number(self._closed({0: 0}), None)

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """With the nodes that missing letters lead to."""
        todo = list(nodes)
        while todo:
            node = todo.pop()
            e = nodes[node] + 1
            for child in self.children[node].values():
                if e <= self.reach[child] and e < nodes.get(child, 99):
                    nodes[child] = e
                    todo.append(child)
        return nodes

    def _number(self, nodes: dict[int, int], stem: tuple[int, int] | None) -> int:
        """The number of a state: its nodes with their least edits, and the best stem that was completed on the way."""
        for node, e in nodes.items():
            for t in self.ends[node]:
                term, whole = self.terms[t]
                if not whole and e <= edits_allowed(term, whole) and (stem is None or (e, t) < (stem[1], stem[0])):
                    stem = (t, e)
        key = (frozenset(nodes.items()), stem)
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append((nodes, stem))
            self.steps.append({})
            best = (stem[1], stem[0]) if stem else None
            for node, e in nodes.items():
                for t in self.ends[node]:
                    if e <= edits_allowed(*self.terms[t]) and (best is None or (e, t) < best):
                        best = (e, t)
            self.results.append((best[1], best[0]) if best else None)
        return self.numbers[key]

    def _step(self, state: int, c: str) -> int:
        nodes, stem = self.states[state]
        after: dict[int, int] = {}
        for node, e in nodes.items():
            for letter, child in self.children[node].items():
                cost = e + (letter != c)
                if cost <= self.reach[child] and cost < after.get(child, 99):
                    after[child] = cost
            if e + 1 <= self.reach[node] and e + 1 < after.get(node, 99):
                after[node] = e + 1  # a letter too many
        self.steps[state][c] = to = self._number(self._closed(after), stem)
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """The number of the nearest term and the edits, or None."""
        state, steps = self.begin, self.steps
        for c in word:
            to = steps[state].get(c)
            state = self._step(state, c) if to is None else to
        return self.results[state]


class Scorer:
    """Hits and features of documents, by a lexicon; remembers the words it has seen."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.memo = Memo(CACHE)

    def _hit(self, raw: bytes) -> int:
        """0: no hit, 1: a term itself, 2: misspelled."""
        best = 0
        for part in re.findall(r"[^\W_]+", raw.decode(errors="replace").lower()):
            found = self.lexicon.match(part)
            if found:
                kind = 1 + (found[1] > 0)
                best = kind if not best else min(best, kind)
        return best

    def features(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """A row for each document: plain hits, quoted hits, densest window, share of words (logarithms).

        A misspelled term counts as ``MISSPELLED`` of a hit.
        """
        out = np.zeros((len(off) - 1, 4))
        h, first, s, e = words(buf, off, ALNUM)
        if not len(h):
            return out
        if self.memo.count > CACHE:
            self.memo = Memo(CACHE)
        kind = self.memo.find(h)
        new = np.flatnonzero(kind < 0)
        if len(new):
            distinct, at = np.unique(h[new], return_index=True)
            at, raw = new[at], buf.tobytes()
            self.memo.put(distinct, np.array([self._hit(raw[a:b]) for a, b in zip(s[at].tolist(), e[at].tolist(), strict=True)], np.int32))
            kind[new] = self.memo.find(h[new])
        hits = np.flatnonzero(kind > 0)
        if not len(hits):
            return out
        doc = np.searchsorted(first, hits, side="right") - 1
        for d in np.unique(doc).tolist():
            own = hits[doc == d]
            lo, hi = int(first[d]), int(first[d + 1])
            quoted = np.array([self._quoted(buf, s, e, int(i), lo, hi) for i in own])
            plain = own[~quoted]
            total = np.concatenate([[0.0], np.cumsum(np.where(kind[plain] == 1, 1.0, MISSPELLED))])
            near = total[np.searchsorted(plain, plain + CONTEXT, side="right")] - total[np.searchsorted(plain, plain - CONTEXT)]
            out[d] = np.log1p([total[-1], quoted.sum(), near.max(initial=0.0), 100.0 * total[-1] / (hi - lo)])
        return out

    @staticmethod
    def _quoted(buf: np.ndarray, s: np.ndarray, e: np.ndarray, i: int, lo: int, hi: int) -> bool:
        """Whether a quotation mark stands before and one behind the word, in its context and line."""
        before = buf[s[max(lo, i - CONTEXT)]: s[i]].tobytes().decode(errors="replace").rsplit("\n", 1)[-1]
        behind = buf[e[i]: e[min(hi - 1, i + CONTEXT)]].tobytes().decode(errors="replace").split("\n", 1)[0]
        mark = lambda text, side: any(c in _QUOTES and (c not in "'’" or side(k, text)) for k, c in enumerate(text))
        # An apostrophe between letters is no quotation mark.
        return mark(before, lambda k, t: not (k and t[k - 1].isalnum())) and mark(behind, lambda k, t: not (k + 1 < len(t) and t[k + 1].isalnum()))


def learn_lexicon(sample: DataFrame) -> list[tuple[str, bool]]:
    """Terms ``(letters, whole)`` from ``sample(text, label)``, which is bounded."""
    total = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    toxic, clean = total.get(1, 0), sum(n for k, n in total.items() if k != 1)
    if not toxic:
        return []
    word = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))
    begins = F.sequence(F.lit(SHORTEST), F.lit(LONGEST))
    parts = F.flatten(F.transform(word, lambda w: F.concat(
        F.transform(F.filter(begins, lambda k: k <= F.length(w)), lambda k: F.substring(w, F.lit(1), k)),
        F.when(F.length(w) >= SHORTEST, F.array(F.concat(w, F.lit("$")))).otherwise(F.array().cast("array<string>")))))
    seen = (sample.select("label", F.explode(F.array_distinct(parts)).alias("part")).groupBy("part")
            .agg(F.sum((F.col("label") == 1).cast("int")).alias("t"), F.sum((F.col("label") != 1).cast("int")).alias("c"))
            .filter(F.col("t") >= max(3, SUPPORT * toxic)).collect())
    count = {r["part"]: (r["t"], r["c"]) for r in seen}
    follow = defaultdict(list)
    for part in count:
        follow[part[:-1]].append(part)

    def good(part: str) -> bool:
        t, c = count[part]
        return t / toxic >= RATIO * (c + 0.5) / max(clean, 1)

    terms = set()
    for part in sorted(count):
        if part.endswith("$") or not good(part) or any(good(part[:k]) for k in range(SHORTEST, len(part)) if part[:k] in count):
            continue  # only the shortest beginnings; each is then followed
        todo = [part]
        while todo:
            p = todo.pop()
            on = [q for q in follow[p] if count[q][0] >= FOLLOW * count[p][0]]
            if on:
                todo += on
            elif p.endswith("$"):
                terms.add((p[:-1], True))
            elif len(p) > SHORTEST:
                terms.add((p, False))
            else:
                todo += follow[p]
    return sorted(terms)


def _fit(x: np.ndarray, y: np.ndarray, counts: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic model, the last one being the bias; hits never lower the score but when quoted.

    ``counts`` is the number of labelled documents that a row stands for.
    """
    counts = counts / counts.mean()
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    rate = 1.0
    for _ in range(3000):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (counts * (p - y)) / len(y) + ridge * np.append(w[:-1], 0) / 10
        w -= rate * grad
        w[[0, 2, 3]] = np.maximum(w[[0, 2, 3]], 0)
    return w


class Model:
    """A frozen lexicon with the weights of its features."""

    def __init__(self, terms: list[tuple[str, bool]], weights: np.ndarray | None):
        self.terms, self.weights = terms, weights
        self._scorer: Scorer | None = None

    def __getstate__(self):
        return {"terms": self.terms, "weights": self.weights, "_scorer": None}

    def scores(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(off) - 1)
        if self._scorer is None:
            self._scorer = Scorer(Lexicon(self.terms))
        z = self._scorer.features(buf, off) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def learn(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> Model:
    """A model from at most about ``bound`` labelled documents of each class, none of the held-out fold."""
    sample = labelled(docs, labels, "toxic", HELD_OUT, FOLDS, bound)
    terms = learn_lexicon(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Lexicon(terms))
        for batch in batches:
            for lo, hi, buf, off in chunks(batch.column("text")):
                x = scorer.features(buf, off)
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column("label").slice(lo, hi - lo), batch.column("share").slice(lo, hi - lo)], ["x", "y", "share"])

    rows = sample.mapInArrow(run, "x array<double>, y int, share double").groupBy("x", "y", "share").count().collect()  # bounded by the sample
    if not any(r["y"] == 1 for r in rows):
        return Model([], None)
    x = np.repeat(np.array([r["x"] for r in rows]), [r["count"] for r in rows], axis=0)
    y = np.repeat(np.array([r["y"] == 1 for r in rows], float), [r["count"] for r in rows])
    # A class that was thinned counts as much as in the labels, so scores do not depend on the size of the input.
    share = np.repeat(np.array([r["share"] for r in rows]), [r["count"] for r in rows])
    return Model(terms, _fit(x, y, 1 / share))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of each row of ``docs(doc_id, text)``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [shared.value.scores(buf, off) for _, _, buf, off in chunks(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(score) if score else [], pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, score double")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all columns, that score below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [shared.value.scores(buf, off) for _, _, buf, off in chunks(batch.column("text"))]
            yield batch.filter(pa.array(np.concatenate(score) < threshold)) if score else batch

    return docs.mapInArrow(run, docs.schema)


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, model).select("doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that score 0.7 or more go."""
    return keep_clean(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
