"""Exact sums, models loaded once per worker, and whole runs."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.exact import exact_mean, exact_sum
from textloom.operators import scoring as R

LOGITS = T.StructType([T.StructField("total", T.LongType())])


def _doubles(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return df.repartition(parts)


@pytest.mark.parametrize("low,high", [(-3, 3), (-40, 20), (-60, 60)])
def test_sums_are_the_same_for_any_partitioning(spark, low, high):
    rng = random.Random(low)
    values = [rng.uniform(-1, 1) * 2.0 ** rng.randint(low, high) for _ in range(3000)]
    sums, means = set(), set()
    for parts in (1, 7, 64):
        rng.shuffle(values)
        row = _doubles(spark, values, parts).agg(exact_sum(F.col("x")), exact_mean(F.col("x"))).first()
        sums.add(row[0])
        means.add(row[1])
    assert len(sums) == len(means) == 1
    assert sums.pop() == pytest.approx(math.fsum(values), rel=1e-12, abs=1e-18)


def test_sums_of_odd_values(spark):
    one = lambda values: _doubles(spark, values, 2).agg(exact_sum(F.col("x"))).first()[0]
    assert one([0.1] * 10) == pytest.approx(1.0) and one([-0.5, 0.5, None]) == 0.0
    assert one([None, None]) is None
    for bad in (float("nan"), float("inf"), 2.0**80):
        assert math.isnan(one([1.0, bad]))


def test_losses_do_not_change_with_partitioning(spark):
    rng = np.random.default_rng(0)
    rows = [(rng.normal(size=5).tolist(), int(rng.integers(5))) for _ in range(2000)]
    df = spark.createDataFrame(rows, "logits array<double>, label int")
    found = {tuple(R.classification_metrics(df.repartition(n), "logits", "label").first()) for n in (1, 7, 64)}
    assert len(found) == 1


def test_a_model_is_loaded_once_per_worker(spark):
    def load():  # a function of its own, so that it travels by value
        return lambda inputs, longest: pd.DataFrame({"total": [int(sum(x[:longest])) for x in inputs["ids"]]})

    rng = random.Random(3)
    rows = [(k, [1] * rng.choice([1, 3, 50, 200])) for k in range(4000)]
    df = spark.createDataFrame(rows, "k long, ids array<int>").repartition(24)
    scored = R.score_by_length(df, ["k"], ["ids"], load, LOGITS, F.size("ids"), 2000, report=True).cache()
    got = {r.k: r.total for r in scored.collect()}
    assert got == {k: len(ids) for k, ids in rows}
    report = R.padding_report(scored).first()
    assert report.loads == report.workers <= 24
    plain = 1 - sum(len(i) for _, i in rows) / (200 * len(rows))
    assert report.padding_share < plain / 5
    scored.unpersist()


def test_batches_hold_at_most_the_stated_tokens():
    rng = np.random.default_rng(1)
    sizes = rng.integers(0, 300, 500)
    parts = R._by_length(sizes, 1000)
    assert sorted(np.concatenate(parts).tolist()) == list(range(500))
    assert all(len(p) == 1 or len(p) * sizes[p].max() <= 1000 for p in parts)
    assert R._by_length(np.zeros(0, dtype=int), 10) == []


def test_a_short_answer_of_the_model_is_an_error(spark):
    df = spark.range(3).select("id", F.array(F.lit(1)).alias("ids"))
    cut_short = lambda: lambda inputs, longest: pd.DataFrame({"total": [1]})
    with pytest.raises(Exception, match="one row per input row"):
        R.score_by_length(df.coalesce(1), ["id"], ["ids"], cut_short, LOGITS, F.size("ids")).collect()
