import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators import answers as N
from textloom.operators import scoring as R
from textloom.plans.catalog import answers as CA


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _remainder(a, m):
    return a - m * int(a / m)


def test_scores_are_drawn_in_batches_and_keep_their_values(spark):
    rows = spark.createDataFrame([(1, "7-0", 0), (2, "-12-1", 3), (3, None, 1)], "unique_id long, qas_id string, window_no int")
    drawn = CA.with_hash_logits(rows.filter("unique_id <> 2"))
    assert "lambda" not in _plan(drawn)
    found = {r.unique_id: r for r in drawn.collect()}
    assert found[1].start_logits == [(7 * 7919 + p * 1299709) % 1009 / 97.0 for p in range(CA.WIDTH)]
    assert found[1].end_logits == [(7 * 6151 + p * 179424673) % 1013 / 89.0 for p in range(CA.WIDTH)]
    assert found[3].start_logits == [None] * CA.WIDTH
    low = CA._hash_logits(CA.pa.array([-5000]), 3, 1009, 97.0).to_pylist()[0]
    assert low == [_remainder(-5000 + 3 * p, 1009) / 97.0 for p in range(CA.WIDTH)]


def test_span_loss_adds_up_no_lists_in_lambdas(spark):
    rows = [([1.0, 2.0, 0.5], [0.0, 0.0], 1, 0), ([4.0], [1.0, 3.0], 0, 1), (None, [1.0, None], 0, 0)]
    columns = "start_logits array<double>, end_logits array<double>, start_position int, end_position int"
    df = R.span_loss(spark.createDataFrame(rows, columns))
    assert "lambda" not in _plan(df)
    loss = lambda x, k: math.log(sum(math.exp(v) for v in x)) - x[k]
    start = [loss(x, k) for x, _, k, _ in rows[:2]]
    end = [loss(y, k) for _, y, _, k in rows[:2]]
    assert df.first().span_loss == pytest.approx((sum(start) / 2 + sum(end) / 2) / 2, abs=1e-12)


def test_lowest_values_are_those_of_a_stable_sort():
    random = np.random.default_rng(3)
    for n in (1, 4, 20, 40):
        values = random.integers(0, 9, (50, 30)).astype(float)
        values[random.random(values.shape) < 0.1] = np.inf
        assert (N._lowest(values, n) == np.argsort(values, axis=1, kind="stable")[:, :n]).all()
    assert N._lowest(np.array([[np.nan, 1.0, 2.0]]), 2).tolist() == [[1, 2]]


def test_answers_are_matched_outside_of_lambdas(spark):
    rows = [("steve smith", "Steve Smith's", "Steve Smith"), ("smith", "Éa  Smith,", "Smith"), ("", "A b", "A b"), (None, "A", "A"), ("a", None, None)]
    rows += [("b c", "A B C", "B C"), ("a b", " A B ", "A B"), ("x", "A", "A"), ("ab", "áb c", "áb c")]
    df = spark.createDataFrame(rows, "p string, o string, wanted string").withColumn("got", N.project_answer(F.col("p"), F.col("o")))
    assert "sequence(" not in _plan(df)
    assert [(r.o, r.got) for r in df.collect()] == [(o, wanted) for _, o, wanted in rows]


@pytest.mark.parametrize("keep_lines", [False, True])
def test_plain_texts_are_normalised_as_all_others(spark, keep_lines):
    texts = ["Plain Words, and (Marks).", "a\tb\r\nc", "x\ny  z", "", "Ünïcode: Text here", "a\x07b \x7f", "$5 + ~3"]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    # A word that is not ASCII in front takes the whole way; it is cut off again.
    long = F.substring(X.spaced_text(F.concat(F.lit("ø "), "t"), True, keep_lines), 3, 1000)
    for r in df.select("t", X.spaced_text(F.col("t"), True, keep_lines).alias("a"), long.alias("b")).collect():
        assert r.a == r.b, r.t
