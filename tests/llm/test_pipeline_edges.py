"""The whole pipeline on nulls, repeated rows, odd columns and empty tables."""

import pytest

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _size int, `__mix_key` string, score double"
LONG = " ".join(f"word{k}" for k in range(400))


@pytest.fixture
def tables(spark, tmp_path):
    def write(docs, labels=(), items=()):
        for name, rows, schema in (
            ("documents", docs, DOCS),
            ("labels", list(labels), "doc_id long, quality int, toxic int"),
            ("benchmark", list(items), "item_id long, text string"),
        ):
            spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def test_odd_rows(spark, tables):
    rows = [(k, f"{LONG} {' '.join(f'own{k}x{i}' for i in range(300))}", "en", "a") for k in range(6)]
    rows += [(10, LONG, "en", "a"), (10, LONG, "en", "a"), (11, LONG.upper(), "en", "b")]
    rows += [(20, None, "en", "a"), (21, "", None, None), (None, "only this text has no id at all", "en", None)]
    rows += [(30, "some words around the benchmark passage that must not be seen in here anywhere", "en", "b")]
    rows += [(31, "x" * 300_000, "en", "b")]
    folder = tables(
        [(*r, 0, 1, "k", 0.5) for r in rows], [(0, 1, 0), (None, 0, 1), (10, None, None)],
        [(1, "the benchmark passage that must not be seen in here"), (2, None), (None, "")],
    )
    found = corpus_pipeline.run(spark, folder)
    got = found.orderBy("start").collect()
    ids = [r.doc_id for r in got]
    assert 30 not in ids and 11 not in ids
    assert set(ids) <= {*range(6), 10, 20, 21, 31, None} and set(ids) >= {10}
    start = 0
    for r in got:
        assert r.start == start and r.n_tokens >= 1
        start += r.n_tokens


def test_empty_tables(spark, tables):
    assert corpus_pipeline.run(spark, tables([])).count() == 0
