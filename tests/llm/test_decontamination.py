"""Greedy string tiling against a plain greedy tiler."""

import random

import pytest

from textloom.llm import decontamination as D


def plain_tiles(item, text, shortest):
    """Longest free common run first, again and again."""
    shortest = min(shortest, len(item))
    free_i, free_t = [True] * len(item), [True] * len(text)
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for t in range(len(text)):
                k = 0
                while (p + k < len(item) and t + k < len(text) and free_i[p + k] and free_t[t + k]
                       and item[p + k] == text[t + k]):
                    k += 1
                if k > best[0]:
                    best = (k, p, t)
        k, p, t = best
        if k < max(1, shortest):
            return free_i.count(False)
        for j in range(k):
            free_i[p + j] = free_t[t + j] = False


def test_tiles_by_plain_loop():
    draw = random.Random(1)
    for _ in range(150):
        item = [draw.randrange(6) for _ in range(draw.randint(1, 18))]
        text = [draw.randrange(6) for _ in range(draw.randint(1, 30))]
        if draw.random() < 0.5:
            cut = draw.randrange(len(item))
            text += item[cut:] + item[:cut]
        assert D.tile_pair(item, text, 3) == pytest.approx(plain_tiles(item, text, 3), abs=2)


ITEMS = [
    (1, "The quick brown fox, jumps over the lazy dog while seven wizards brew strange potions"),
    (2, "short one"),
    (3, None),
    (4, ""),
    (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (6, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
]
DOCS = [
    (10, "noise " * 50 + ITEMS[0][1].upper() + " noise" * 50),
    (11, "while seven wizards brew strange potions ... the quick brown fox jumps over the lazy dog"),
    (12, "the quick brown fox ate a potato and then it went home again"),
    (13, "zeta eta theta iota kappa lambda mu x alpha beta gamma delta epsilon"),
    (14, None),
    (15, ""),
    (16, "a short one here"),
    (10, "noise " * 50 + ITEMS[0][1].upper() + " noise" * 50),
    (None, "the lazy dog"),
]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(d, t, 3, "c") for d, t in DOCS], "doc_id long, text string, item_id int, coverage string")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("config", [D.TilingConfig(), D.TilingConfig(portion_bytes=40)])
def test_coverage_and_kept_rows(tables, config):
    docs, items = tables
    rows = D.coverage(docs, items, config).collect()
    assert len(rows) == len(DOCS)
    got = {r.doc_id: (r.item_id, round(r.coverage, 3)) for r in rows}
    assert got[10] == (1, 1.0) and got[11] == (1, 1.0) and got[13] == (5, 1.0) and got[16] == (2, 1.0)
    assert got[12][1] < 0.5 and got[14] == (None, 0.0) and got[15] == (None, 0.0)
    kept = D.uncontaminated(docs, items, config)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {12, 14, 15, None}


def test_empty_tables(tables):
    docs, items = tables
    assert D.coverage(docs.limit(0), items).count() == 0
    assert {r.coverage for r in D.coverage(docs, items.limit(0)).collect()} == {0.0}
    assert D.uncontaminated(docs, items.limit(0)).count() == len(DOCS)
