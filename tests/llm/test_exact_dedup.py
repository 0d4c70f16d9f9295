"""Perfect hash tables and exact copies against plain grouping."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from textloom.llm import exact_dedup

SCHEMA = "doc_id long, text string"


def digests_of(n, salt=""):
    raw = b"".join(hashlib.sha256(f"{salt}{k}".encode()).digest() for k in range(n))
    return np.frombuffer(raw, dtype=np.uint8).reshape(-1, 32)


def plain(rows):
    """(doc_id, keep_id, group_size, digest) of each row, and the number kept of each digest."""
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    named = [(d, hashlib.sha256(lower(t).encode()).hexdigest()) for d, t in rows]
    groups = {}
    for d, h in named:
        groups.setdefault(h, []).append(d)
    best = {h: max((d for d in g if d is not None), default=None) for h, g in groups.items()}
    return sorted(((d, best[h], len(groups[h]), h) for d, h in named), key=repr), best


def check(spark, rows, history, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema).withColumn("digest", F.lit("x")).withColumn("n", F.lit(3))
    found = exact_dedup.copies(df, history).collect()
    want, best = plain(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=repr) == want
    kept = [r for r in found if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted(best)
    assert all(r.doc_id == best[r.text_sha256] for r in kept)


def test_slots_are_minimal_and_perfect():
    for n in (0, 1, 2, 63, 64, 65, 1000, 50_000):
        digests = digests_of(n)
        table = exact_dedup.PerfectHash.build(digests)
        assert sorted(table.slots(digests)) == list(range(n))
        others = table.slots(digests_of(500, "other"))
        assert ((others >= -1) & (others < n)).all()


def test_digests_that_no_level_places(monkeypatch):
    monkeypatch.setattr(exact_dedup, "LEVELS", 1)
    digests = digests_of(300)
    table = exact_dedup.PerfectHash.build(digests)
    assert table.rest and sorted(table.slots(digests)) == list(range(300))
    others = table.slots(digests_of(500, "other"))
    assert (others >= -1).all() and (others < 300).all()


def test_copies_for_any_history(spark):
    rng = random.Random(2)
    texts = ["a b", "A B", "É", "é", "", None, "x" * 200_000, "x" * 199_999 + "X", " a b", *map(str, range(60))]
    rows = [(k, rng.choice(texts)) for k in range(300)]
    rows += [(301, "same"), (301, "same"), (301, "same"), (None, "same"), (None, "none"), (None, "none"), (-(2**63), "none too"), (2**63 - 1, "a B")]
    for history in (F.lit(True), F.lit(False), F.col("doc_id") % 2 == 0, F.col("doc_id") < 40):
        check(spark, rows, history)


def test_one_text_in_most_rows_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SHARD_DIGESTS", 50)
    monkeypatch.setattr(exact_dedup, "COMBINED", 20)
    rows = [(k, "hot" if k % 3 else f"text {k}") for k in range(900)]
    check(spark, rows, F.col("doc_id") % 4 == 1)


def test_empty_table(spark):
    assert exact_dedup.copies(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
