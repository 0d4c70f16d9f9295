"""Ranked search against plain scoring of all documents."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k):
    counted = [(d, terms_of(t)) for d, t in docs]
    counted = [(d, t) for d, t in counted if t]
    n, length = len(counted), sum(len(t) for _, t in counted)
    df = {}
    for _, t in counted:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for d, t in counted:
            m, score = 50 + 50 * len(t) * n // length, 0
            for term in set(terms_of(text)):
                tf = t.count(term)
                if tf:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    score += w * (1_000_000_000 * tf // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, d is not None, d or 0, d))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def found(spark, docs, items, k):
    df = spark.createDataFrame(docs, DOCS).withColumn("block", F.lit(1)).withColumn("n", F.lit("x"))
    asked = spark.createDataFrame(items, ITEMS).withColumn("score", F.lit(1))
    rows = lexical_search.top_documents(df, asked, k).collect()
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in rows), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["É", "é", "日本", "Der", "der", "a1"]
    weights = [1 / (k + 1) for k in range(len(words))]
    marks = [" ", ", ", "\n", "\x00", "_", "-", "\x7f"]
    docs = []
    for d in range(n):
        size = rng.choice([0, 1, 3, 8, 8, 8, 30, 200])
        docs.append((d, "".join(w + rng.choice(marks) for w in rng.choices(words, weights, k=size))))
    docs += [(n + k, "w1 w2 w3 copy") for k in range(120)]
    docs += [(None, "w5 w6 rare"), (None, "w5 w6 rare"), (n + 500, None), (n + 501, " ., "), (5, "w9 rare"), (5, "w9 rare")]
    docs.append((n + 502, "w3 w7 " * 60_000 + "long"))
    items = [(k, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for k in range(25)]
    items += [(90, None), (91, ""), (92, "none of these"), (93, "COPY w1"), (94, "rare"), (94, "rare long"), (None, "w2 w2 É")]
    return docs, items


@pytest.mark.parametrize("block_docs", [60_000, 40])
def test_against_plain_scoring(spark, monkeypatch, block_docs):
    docs, items = corpus(block_docs, 600)
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(lexical_search, "MOST_ROWS", min(block_docs, 5000))
    assert found(spark, docs, items, 50) == plain(docs, items, 50)


def test_portions_of_queries(spark, monkeypatch):
    docs, items = corpus(9, 150)
    monkeypatch.setattr(lexical_search, "PORTION_BYTES", 900)
    assert found(spark, docs, items, 3) == plain(docs, items, 3)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")], 5) == []
    assert found(spark, [(1, "a")], [], 5) == []
    assert found(spark, [(1, None), (2, " . ")], [(1, "a")], 5) == []


def test_counts_and_terms():
    texts = pa.array(["a b", "", None and "", " x", "é-É1", "\x00", "q" * 10, "_a_"], pa.large_string())
    texts = texts.fill_null("")
    assert lexical_search._counts(texts).tolist() == [len(terms_of(t)) for t in texts.to_pylist()]
    words, starts = lexical_search._tokens(texts)
    assert [words.to_pylist()[a:b] for a, b in zip(starts, starts[1:])] == [terms_of(t) for t in texts.to_pylist()]


def test_bounds_save_visits():
    """A high threshold leaves out strata, and what is left out scores less."""
    rng = np.random.default_rng(0)
    words = np.array([f"w{k}" for k in range(200)])
    texts = pa.array([" ".join(rng.choice(words, rng.integers(3, 60))) for _ in range(2000)], pa.large_string())
    size = lexical_search.CorpusSize(2000, int(lexical_search._counts(texts).sum()))
    m = size.normaliser(lexical_search._counts(texts))
    order = np.argsort(m, kind="stable")
    row = lexical_search._block(pa.array(order), m[order], texts.take(pa.array(order)))
    block = lexical_search._Reader({"block": 0, **row})
    asked, weights = np.array([3, 50, 120]), np.array([5000, 3000, 700])
    full, few = lexical_search._Best(5, 0), lexical_search._Best(5, 0)
    bounds, entries, weight = block.bounds(asked, weights)
    scores = block.scores(entries, weight)
    full.add(scores, block.known, block.ids)
    visited = lexical_search._search(block, asked, weights, few)
    assert visited < len(bounds)
    assert few.ids.tolist() == full.ids.tolist() and few.score.tolist() == full.score.tolist()
    assert (scores <= np.repeat(bounds, block.stratum_docs)).all()
