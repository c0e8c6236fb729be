"""Toxicity score from a weighted lexicon.

Texts are folded (lower case, homoglyphs to the letters they look like, digits and signs to
the letters they stand for) and cut into words. An Aho-Corasick automaton finds the
lexicon's terms, whole words and word beginnings, at word starts; a word counts its
heaviest term, unless it lies in an exception phrase, and repeated words count once. The
sum of squared weights over the root of the text's length in words is the raw score, and a
logistic curve turns it into 0 to 1.

Lexicon, exceptions and curve are learned from all labelled rows given. A term's weight is
the log ratio of its rates in toxic and other documents; it enters if its likelihood ratio
against chance passes a bound that grows with the number of terms tested. An exception is a
pair of neighbouring words, one of them a lexicon hit, that the same test shows to be
commoner in documents that are not toxic.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from svcvitals.llm.columns import pick
from svcvitals.llm.tasks import frugal
from svcvitals.sources.tables import materialize

#: Characters folded to the Latin letters they look like or stand for.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o", "р": "p",
    "ѕ": "s", "т": "t", "у": "y", "ԝ": "w", "х": "x", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
BLANK = {"​": None, "‌": None, "‍": None, "⁠": None, "﻿": None, "­": None}
_FOLD = str.maketrans({**HOMOGLYPHS, **BLANK, **{chr(0xFF41 + k): chr(97 + k) for k in range(26)}})
_WORD = re.compile(r"[^\W_]+(?:[@$!][^\W_]+)*")
_SUBST = str.maketrans(SUBSTITUTES)
PREFIXES = (4, 5, 6, 7, 8)
THRESHOLD = 0.3
MAX_TERMS = 50_000
BROADCAST_LABELS = 1_000_000
BINS = 100
#: A term is at least so many times as common (as a logarithm) in toxic documents.
MIN_WEIGHT = math.log(20)
#: Added to a text's words, so that one hit in a very short text is no certainty.
PRIOR_WORDS = 10


def fold(text: str | None) -> list[str]:
    """The folded words of a text."""
    words = _WORD.findall((text or "").lower().translate(_FOLD))
    return [w.translate(_SUBST) if not w.isalpha() and any(c.isalpha() for c in w) else w for w in words]


@dataclass
class Lexicon:
    """Terms (" word " or " beginning") with weights, exception phrases (" word word "), curve."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset = frozenset()
    slope: float = 0.0
    intercept: float = -2.0
    _automaton: object = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_automaton"} | {"_automaton": None}

    def automaton(self):
        if self._automaton is None and (self.terms or self.exceptions):
            a = ahocorasick.Automaton()
            for term, weight in self.terms.items():
                a.add_word(term, (len(term), weight))
            for phrase in self.exceptions:
                a.add_word(phrase, (len(phrase), None))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def hits(self, words: list[str]) -> list[tuple[int, float]]:
        """(position of the space before the word, weight) of the words that count, in order,
        over the words joined by spaces."""
        automaton = self.automaton()
        if automaton is None or not words:
            return []
        heaviest, excepted = {}, []
        for end, (n, weight) in automaton.iter(" " + " ".join(words) + " "):
            start = end - n + 1
            if weight is None:
                excepted.append((start, end))
            elif weight > heaviest.get(start, 0.0):
                heaviest[start] = weight
        for a, b in excepted:
            for start in [s for s in heaviest if a <= s < b]:
                del heaviest[start]
        return sorted(heaviest.items())

    def raw(self, words: list[str], hits: list[tuple[int, float]]) -> float:
        if not hits:
            return 0.0
        text = " ".join(words) + " "
        distinct = {text[at:text.find(" ", at)]: w for at, w in hits}
        return sum(w * w for w in distinct.values()) / math.sqrt(len(words) + PRIOR_WORDS)

    def probability(self, raw: float) -> float:
        z = self.intercept + self.slope * math.log1p(raw)
        return 1.0 / (1.0 + math.exp(-z)) if z > -700 else 0.0


def evidence(a, b, share: float):
    """Log likelihood ratio of a of a + b toxic occurrences against the overall share."""
    n = a + b
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(a > 0, a * np.log(a / (n * share)), 0.0) + np.where(b > 0, b * np.log(b / (n * (1 - share))), 0.0)


def _count_words(batches):
    """Documents that hold each folded word, toxic and other, per batch."""
    for batch in batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            counts[toxic].update(set(fold(text)))
        words = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([counts[1][w] for w in words], pa.int64()),
                                          pa.array([counts[0][w] for w in words], pa.int64())], names=["word", "a", "b"])


def _count_pairs(lexicon):
    """Documents that hold each pair of neighbouring words of which one is a hit."""

    def run(batches):
        own = lexicon.value
        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = fold(text)
                hits = own.hits(words)
                if not hits:
                    continue
                at, starts = 0, {}
                for k, w in enumerate(words):
                    starts[at] = k
                    at += len(w) + 1
                pairs = {(k + d, k + d + 1) for k in (starts[s] for s, _ in hits) for d in (-1, 0) if 0 <= k + d < len(words) - 1}
                counts[toxic].update({f" {words[x]} {words[y]} " for x, y in pairs})
            pairs = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.string()), pa.array([counts[1][w] for w in pairs], pa.int64()),
                                              pa.array([counts[0][w] for w in pairs], pa.int64())], names=["word", "a", "b"])

    return run


def _raw_scores(lexicon):
    def run(batches):
        own = lexicon.value
        for batch in batches:
            raw = []
            for text in batch.column("text").to_pylist():
                words = fold(text)
                raw.append(own.raw(words, own.hits(words)))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(raw, pa.float64())], names=["toxic", "raw"])

    return run


def fit_curve(points: list[tuple[float, int, int]]) -> tuple[float, float]:
    """(slope, intercept) of the logistic curve over log(1 + raw score); points are
    (that, toxic rows, other rows). A weak prior keeps separable data finite."""
    x = np.array([p[0] for p in points])
    y1, y0 = (np.array([p[k] for p in points], dtype=float) for k in (1, 2))
    design = np.stack([x, np.ones_like(x)], axis=1)
    beta, ridge = np.array([0.0, math.log((y1.sum() + 0.5) / (y0.sum() + 0.5))]), np.diag([1e-3, 1e-3])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        n = y1 + y0
        gradient = design.T @ (y1 - n * p) - ridge @ beta
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return max(0.0, float(beta[0])), float(beta[1])


def learn(labelled: DataFrame, max_terms: int = MAX_TERMS) -> Lexicon:
    """The lexicon from rows (text, toxic 0/1). The driver receives the terms that pass the
    test (at most max_terms, by evidence) and the curve's bins; all counts are made by Spark
    over all rows."""
    spark = labelled.sparkSession
    totals = labelled.agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).first()
    n_toxic, n_other = totals["a"] or 0, totals["b"] or 0
    if not n_toxic or not n_other:
        return Lexicon(intercept=8.0 if n_toxic else -8.0)
    words = materialize(labelled.mapInArrow(frugal(_count_words), "word string, a long, b long").groupBy("word").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b")), "term-counts")
    whole = words.select(F.concat(F.lit(" "), "word", F.lit(" ")).alias("term"), "a", "b")
    begun = words.select(F.explode(F.array(*[F.when(F.length("word") >= n, F.concat(F.lit(" "), F.substring("word", 1, n))) for n in PREFIXES])
                                   ).alias("term"), "a", "b").filter("term IS NOT NULL").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    terms = materialize(whole.unionByName(begun), "terms")
    all_terms = terms.agg(F.count(F.lit(1)).alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    share = all_terms["a"] / (all_terms["a"] + all_terms["b"])
    bound = math.log(all_terms["n"]) + 2.0
    a, b, n = F.col("a").cast("double"), F.col("b").cast("double"), (F.col("a") + F.col("b")).cast("double")
    gain = (F.when(a > 0, a * F.log(a / (n * share))).otherwise(0.0) + F.when(b > 0, b * F.log(b / (n * (1 - share)))).otherwise(0.0))
    weight = F.log(((a + 0.5) / (n_toxic + 1)) / ((b + 0.5) / (n_other + 1)))
    chosen = terms.select("term", gain.alias("gain"), weight.alias("weight"), (a / n > share).alias("up")).filter(
        F.col("up") & (F.col("gain") >= bound) & (F.col("weight") >= MIN_WEIGHT))
    lexicon = Lexicon({r["term"]: r["weight"] for r in chosen.orderBy(F.desc("gain"), "term").limit(max_terms).collect()})
    sent = spark.sparkContext.broadcast(lexicon)
    pairs = labelled.mapInArrow(frugal(_count_pairs(sent)), "word string, a long, b long").groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    base = n_toxic / (n_toxic + n_other)
    other = F.when(a > 0, a * F.log(a / (n * base))).otherwise(0.0) + F.when(b > 0, b * F.log(b / (n * (1 - base)))).otherwise(0.0)
    milder = pairs.filter((a / n < base) & (other >= 3.0)).orderBy(F.desc(other), "word").limit(max_terms)
    lexicon.exceptions = frozenset(r["word"] for r in milder.collect())
    sent = spark.sparkContext.broadcast(lexicon)
    bins = labelled.mapInArrow(frugal(_raw_scores(sent)), "toxic int, raw double").select("toxic", (F.ceil(F.log1p("raw") * BINS) / BINS).alias("x"))
    points = bins.groupBy("x").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).collect()
    lexicon.slope, lexicon.intercept = fit_curve([(r["x"], r["a"], r["b"]) for r in points])
    return lexicon


def held_out(id_col: Column) -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """(text, toxic) of the labelled documents that are not held out, as a stored table.

    Labels other than 0 and 1, and null ids, are left out. Up to BROADCAST_LABELS labels (16
    bytes each) are broadcast, so that texts are not shuffled; more are joined by shuffle.
    """
    given = pick(labels, doc_id=label_id, toxic=label_col).filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out(F.col("doc_id")))
    given = given.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    if labels.count() <= BROADCAST_LABELS:
        given = F.broadcast(given)
    return materialize(pick(docs, doc_id=id_col, text=text_col).join(given, "doc_id").select("text", "toxic"), "labelled")


def score_documents(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), threshold: float = THRESHOLD) -> DataFrame:
    """Id, kept columns, score, predicted, n_words, n_hits, one row per input row.

    Empty and null texts have no hits and score the curve's value at 0; ties and repeated
    rows score alike.
    """
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)
    cols = {f"c{k}": c for k, c in enumerate(keep) if c != text_col}
    rows = pick(docs, doc_id=id_col, text=text_col, **cols)
    if text_col in keep:
        cols["text"] = text_col
    names = [c for c in rows.columns if c != "text" or text_col in keep]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in names)

    def run(batches):
        own = sent.value
        for batch in batches:
            score, n_words, n_hits = [], [], []
            for text in batch.column("text").to_pylist():
                words = fold(text)
                hits = own.hits(words)
                score.append(own.probability(own.raw(words, hits)))
                n_words.append(len(words))
                n_hits.append(len(hits))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(score, pa.float64()), pa.array(n_words, pa.int64()), pa.array(n_hits, pa.int64())],
                                             names=names + ["score", "n_words", "n_hits"])

    out = rows.mapInArrow(frugal(run), f"{kinds}, score double, n_words long, n_hits long")
    return out.select(F.col("doc_id").alias(id_col), *[F.col(k).alias(c) for k, c in cols.items()], "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"), "n_words", "n_hits")


__all__ = ["Lexicon", "fold", "learn", "training_rows", "score_documents", "held_out", "fit_curve", "THRESHOLD"]
