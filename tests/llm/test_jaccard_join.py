"""The n-gram Jaccard join against all pairs."""

import random
import re

import numpy as np
import pytest

from textloom.llm import jaccard_join as J
from textloom.llm.links import components


def plain_components(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()})
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for k in range(i):
            both = len(sets[i] & sets[k])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[k]) - both):
                root[find(i)] = find(k)
    least = {}
    for k, (doc, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), doc), doc)
    return {(doc, len(sets[k]), least[find(k)]) for k, (doc, _) in enumerate(rows)}


def fixture():
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(60)]
    rows = [(k, t) for k, t in enumerate([None, "", " \n", "one", "One", "a b c", "a b c d", "a b c d e"])]
    for _ in range(12):  # near copies of different closeness, and chains
        base = [word() for _ in range(draw.randint(6, 120))]
        for _ in range(draw.randint(1, 6)):
            for _ in range(draw.randint(0, 3)):
                base[draw.randrange(len(base))] = word()
            rows.append((len(rows), " ".join(base)))
    for _ in range(40):  # unlike texts that share a passage, some mostly that passage
        own = [word() for _ in range(draw.randint(3, 80))]
        rows.append((len(rows), " ".join(own + passage)))
    base = [word() for _ in range(50)]
    for _ in range(60):  # one large group
        copy = list(base)
        copy[draw.randrange(50)] = word()
        rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows) + k, " ".join(base).upper()) for k in range(20)]
    rows.append((rows[30][0], rows[30][1]))
    return rows


@pytest.mark.parametrize(
    "config",
    [J.JaccardConfig(), J.JaccardConfig(partners=3, common=4, local=1, turns=3), J.JaccardConfig(orders=1, common=10**9)],
)
def test_components_by_all_pairs(spark, config):
    rows = fixture()
    docs = spark.createDataFrame(
        [(d, t, "n", 1) for d, t in rows], "doc_id long, text string, root string, n int"
    ).repartition(5)
    found = J.component_ids(J.near_groups(docs, config=config)).collect()
    assert len(found) == len(rows)
    assert {tuple(r) for r in found} == plain_components(rows)


def test_one_of_each(spark):
    rows = fixture()
    want = {c if n else d for d, n, c in plain_components(rows)}
    docs = spark.createDataFrame([(d, t, 7) for d, t in rows], "doc_id long, text string, print int")
    kept = J.one_of_each(docs.repartition(4))
    assert kept.columns == docs.columns
    got = sorted(r.doc_id for r in kept.collect())
    assert got == sorted(want)


def test_repeated_and_null_ids(spark):
    text = "a b c d e f g h"
    rows = [(1, text), (1, text), (1, "q r s t u v"), (None, text), (None, None), (2, text + " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((tuple(r) for r in J.component_ids(J.near_groups(docs)).collect()), key=repr)
    assert found == sorted([(1, 4, 1), (1, 4, 1), (1, 2, 1), (None, 4, 1), (None, 0, None), (2, 4, 1)], key=repr)
    assert sorted((r.doc_id, r.text) for r in J.one_of_each(docs).collect() if r.text and r.doc_id) == [
        (1, text), (1, "q r s t u v")]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert J.near_groups(docs).count() == 0 and J.one_of_each(docs).count() == 0


def test_prefixes_meet_under_every_order():
    draw = np.random.default_rng(2)
    for _ in range(200):
        n = int(draw.integers(1, 60))
        x = np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[: -max(1, len(x) // 11)], draw.integers(0, 2**63, len(x) // 12).astype(np.uint64)]))
        if len(y) and J.alike(x, y, 80):
            late = np.sort(x[:: 3])
            for seed in J._SEEDS:
                for common in (None, late):
                    p, q = J.prefix(x, seed, 80, common).tolist(), J.prefix(y, seed, 80, common).tolist()
                    overlap = -(-80 * (len(x) + len(y)) // 180)
                    assert set(p[: len(x) - overlap + 1]) & set(q[: len(y) - overlap + 1])


def test_components_of_long_chains(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100, 102: 100}
