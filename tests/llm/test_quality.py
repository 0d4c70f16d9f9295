"""Ordinal quality: held-out grades and edge cases."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.llm import quality as Q
from textloom.llm.queries import graded_documents

SF = "/root/testdata/sf0.1"


def test_held_out_grades(spark):
    rows = graded_documents(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    rows = rows[rows.held_out]
    assert len(rows) > 500
    assert rows.keep[rows.quality == 1].mean() > 0.97
    assert rows.keep[rows.quality == 0].mean() < 0.25
    assert (rows.p_ge_1 >= rows.p_ge_2).all()
    assert np.allclose(rows.expected_grade, rows.p_ge_1 + rows.p_ge_2)


def test_likelihood_beats_its_neighbours():
    """The fitted thresholds are a maximum of the likelihood on plain data."""
    texts = pa.array(["a"] * 60 + ["b"] * 60 + ["c"] * 60, pa.large_string())
    grades = np.array([0] * 50 + [1] * 10 + [0] * 10 + [1] * 40 + [2] * 10 + [1] * 5 + [2] * 55)
    model = Q.train(texts, grades, Q.QualityConfig(epochs=600, decay=0))
    tails = Q.grade_tails(texts, model)
    expected = tails.sum(axis=1)
    assert expected[0] < expected[60] < expected[120]
    assert model.thresholds[0] < model.thresholds[1]
    for k, low, high in ((0, 0, 60), (60, 60, 120), (120, 120, 180)):
        assert expected[k] == pytest.approx(grades[low:high].mean(), abs=0.12)


def test_edges(spark):
    rows = [(1, None, "z"), (2, "", "z"), (3, "x " * 50_000, "z"), (3, "A!! B!!", "z"), (None, "q", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tails string")
    none = spark.createDataFrame([(9, None), (None, 1)], "doc_id long, g int")
    model = Q.fit(docs, none, F.col("g"), F.lit(True))
    got = Q.graded(docs, model).collect()
    assert len(got) == 5 and all(r.expected_grade == pytest.approx(1.0) for r in got)
    model = Q.fit(docs, spark.createDataFrame([(2, 0), (3, 2), (3, 1)], "doc_id long, g int"), F.col("g"), F.lit(True))
    assert len(Q.graded(docs, model).collect()) == 5
    assert Q.graded(docs.limit(0), model).count() == 0
    assert Q.shape("HELLO!!!!") == "A!!" and Q.shape("Word,") == "Aa," and Q.shape("a1234") == "a0"


def test_a_long_rated_text_costs_only_itself(spark):
    rows = [(k, "poor poor" if k % 3 == 0 else "good text" if k % 3 == 1 else "fine words") for k in range(30)]
    rows += [(100 + k, "poor " * 20_000) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rated = spark.createDataFrame([(d, 0 if d >= 100 else d % 3) for d, _ in rows], "doc_id long, g int")
    model = Q.fit(docs, rated, F.col("g"), F.lit(True), Q.QualityConfig(max_bytes=60_000))
    grades = {r.doc_id: r.expected_grade for r in Q.graded(docs.filter("doc_id < 30"), model).collect()}
    assert grades[0] < grades[1] < grades[2]
