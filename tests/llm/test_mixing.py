"""Source targets and systematic sampling against plain loops."""

import re
from collections import Counter, defaultdict

import pytest

from textloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, `__mix_other` int, size string"


def words(n):
    return " ".join(["w"] * n)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, words(1 + k * 7 % 23), "abc"[k % 3] if k % 5 else "hot", k, "x") for k in range(300)]
    rows += [(1000, None, "a", 0, "x"), (1001, "", None, 0, "x"), (1002, words(400), None, 0, "x")]
    rows += [(1003, words(9), "b", 1, "x")] * 3 + [(None, words(5), "c", 1, "x")]
    rows += [(1005, "", "empty", 1, "x"), (1006, "\t\n ", "empty", 1, "x")]
    return spark.createDataFrame(rows, SCHEMA)


def targets(sizes, weights=(5, 2, 1), most=3):
    """Close sources at their limit until no open one is above it."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target = {}
    left, open_ = float(sum(sizes.values())), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: float(most * sizes[s]) for s in over}
        left -= sum(most * sizes[s] for s in over)
        open_ -= over
    return target


def test_sizes_targets_and_copies(docs):
    found = mixing.mix_plan(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    rows = docs.collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += size(r.text)
    want = targets(sizes)
    taken = defaultdict(int)
    assert Counter((r.doc_id, r.source, r["size"]) for r in found) == Counter(
        (r.doc_id, r.source, size(r.text)) for r in rows
    )
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9)
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r["size"]
    longest = {s: max(size(r.text) for r in rows if r.source == s) for s in sizes}
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 3 * longest[s] + 1


def test_systematic_rule(docs):
    """Copies are the whole numbers crossed by the running sum, so any span is even."""
    found = mixing.mix_plan(docs).collect()
    by_source = defaultdict(list)
    for r in found:
        by_source[r.source].append(r)
    for rows in by_source.values():
        rate = rows[0].target / rows[0].source_size if rows[0].source_size else 0
        rows.sort(key=lambda r: (r["size"], r.doc_id is not None, r.doc_id or 0))
        total = 0
        for k, r in enumerate(rows, 1):
            total += r.copies
            # Inside a group of equal rows it is open which of them comes first.
            if k == len(rows) or (rows[k]["size"], rows[k].doc_id) != (r["size"], r.doc_id):
                assert abs(total - rate * k) < 1 + 1e-6


def test_reruns_and_partitions_agree(docs):
    plain = lambda df: sorted(df.collect(), key=repr)
    assert plain(mixing.mix_plan(docs)) == plain(mixing.mix_plan(docs.repartition(5)))


def test_rows_of_the_mix(docs):
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    plan = {(r.doc_id, r.source, r["size"]): r.copies for r in mixing.mix_plan(docs).collect()}
    got = Counter(r.doc_id for r in out.collect())
    for (doc, _, _), copies in plan.items():
        if doc not in (1003, None):
            assert got[doc] == copies


def test_empty_table_and_empty_texts(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_plan(none).count() == 0 and mixing.mixed(none).count() == 0
    blank = spark.createDataFrame([(1, None, None, 0, ""), (2, " ", "a", 0, "")], SCHEMA)
    assert {(r.doc_id, r.target, r.copies) for r in mixing.mix_plan(blank).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}
