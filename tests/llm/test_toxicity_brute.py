"""Lexicon and scores of the toxicity operator against plain counts and loops."""

import math
import re
import zlib
from collections import Counter

import pytest
from conftest import SF_ORACLE
from llm_fixtures import table  # noqa: F401

from svcvitals.llm import queries, toxicity


def plain_words(text):
    out, drop = [], set("​‌‍⁠﻿­")
    text = "".join(chr(ord(c) - 0xFF41 + 97) if 0xFF41 <= ord(c) <= 0xFF5A else toxicity.HOMOGLYPHS.get(c, c)
                   for c in (text or "").lower() if c not in drop)
    for word in re.findall(r"[^\W_]+(?:[@$!][^\W_]+)*", text):
        mixed = any(c.isalpha() for c in word) and not word.isalpha()
        out.append("".join(toxicity.SUBSTITUTES.get(c, c) for c in word) if mixed else word)
    return out


def gain(a, b, share):
    return (a * math.log(a / ((a + b) * share)) if a else 0.0) + (b * math.log(b / ((a + b) * (1 - share))) if b else 0.0)


def plain_terms(rows):
    """Weights of the terms that pass the test, over (words, toxic) rows."""
    counts, n = (Counter(), Counter()), Counter(t for _, t in rows)
    for words, toxic in rows:
        held = set(words)
        counts[toxic].update(f" {w} " for w in held)
        counts[toxic].update(f" {w[:k]}" for w in held for k in toxicity.PREFIXES if len(w) >= k)
    terms = set(counts[0]) | set(counts[1])
    share = sum(counts[1].values()) / (sum(counts[0].values()) + sum(counts[1].values()))
    kept = {}
    for t in terms:
        a, b = counts[1][t], counts[0][t]
        weight = math.log(((a + 0.5) / (n[1] + 1)) / ((b + 0.5) / (n[0] + 1)))
        if a / (a + b) > share and gain(a, b, share) >= math.log(len(terms)) + 2 and weight >= toxicity.MIN_WEIGHT:
            kept[t] = weight
    return kept


def plain_hits(words, terms, exceptions):
    """Positions and weights of the words that count."""
    found = {}
    for k, w in enumerate(words):
        best = max([terms.get(f" {w} ", 0.0), *[terms.get(f" {w[:n]}", 0.0) for n in range(1, len(w) + 1)]])
        pairs = [f" {' '.join(words[j:j + 2])} " for j in (k - 1, k) if 0 <= j < len(words) - 1]
        if best and not any(p in exceptions for p in pairs):
            found[k] = best
    return found


def plain_exceptions(rows, terms):
    counts, n = (Counter(), Counter()), Counter(t for _, t in rows)
    for words, toxic in rows:
        at = plain_hits(words, terms, ())
        counts[toxic].update({f" {words[j]} {words[j + 1]} " for k in at for j in (k - 1, k) if 0 <= j < len(words) - 1})
    share = n[1] / (n[0] + n[1])
    return {p for p in set(counts[0]) | set(counts[1])
            if counts[1][p] / (counts[0][p] + counts[1][p]) < share and gain(counts[1][p], counts[0][p], share) >= 3.0}


def plain_score(words, lexicon):
    weights = {words[k]: w for k, w in plain_hits(words, lexicon.terms, lexicon.exceptions).items()}
    raw = sum(w * w for w in weights.values()) / math.sqrt(len(words) + 10)
    return 1 / (1 + math.exp(-(lexicon.intercept + lexicon.slope * math.log(1 + raw))))


@pytest.mark.parametrize("sf", [SF_ORACLE])
def test_lexicon_and_scores(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = lambda d: zlib.crc32(str(d).encode()) % 4 == 2
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    folded = {d: plain_words(t) for d, t in texts.items()}
    rows = [(folded[r["doc_id"]], r["toxic"]) for r in labels.collect() if r["doc_id"] in texts and r["toxic"] is not None and not held(r["doc_id"])]
    lexicon = toxicity.learn(toxicity.training_rows(docs, labels))
    want = plain_terms(rows)
    assert set(lexicon.terms) == set(want) and len(want) > 5
    assert all(abs(w - lexicon.terms[t]) < 1e-9 for t, w in want.items())
    assert set(lexicon.exceptions) == plain_exceptions(rows, want)
    got = {r["doc_id"]: r for r in queries.op4_toxicity(spark, sf).collect()}
    assert set(got) == set(texts)
    for d, r in got.items():
        assert r["held_out"] == held(d) and r["predicted"] == int(r["score"] >= 0.3)
        assert abs(r["score"] - plain_score(folded[d], lexicon)) < 1e-9, d


def test_scores_with_exceptions_and_beginnings(table):
    lexicon = toxicity.Lexicon({" scum ": 5.0, " lowe": 3.0, " lowei": 4.0, " rat ": 2.0}, frozenset({" pond scum ", " rat race "}), slope=2.0, intercept=-4.0)
    texts = ["pond scum", "scum pond scum", "scum scum rat", "rat race rat", "Lowerdown lowEIght l0we5", "sсum ѕcum", "", "pond pond", "race rat race", "scum " + "fine " * 300]
    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(table(list(enumerate(texts)), "doc_id long, text string"), lexicon).collect()}
    for k, text in enumerate(texts):
        assert abs(got[k] - plain_score(plain_words(text), lexicon)) < 1e-12, text
