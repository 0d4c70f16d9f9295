"""Whole runs with a model of fixed arithmetic in place of a trained one."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from textloom.operators import scoring as R
from textloom.operators import sequences as S
from textloom.plans import runs
from textloom.plans.catalog import encoding as CE
from textloom.plans.catalog.registry import ORACLES, query, table, vocabulary


def load_classifier():
    """Two logits from the ids of a row."""

    def model(inputs, longest):
        ids = np.stack(inputs["input_ids"].to_numpy())[:, :longest].astype(np.int64)
        plain, placed = ids.sum(axis=1), (ids * np.arange(1, ids.shape[1] + 1)).sum(axis=1)
        logits = np.stack([plain % 101 / 20.0, placed % 103 / 20.0], axis=1)
        return pd.DataFrame({"logits": list(logits)})

    return model


def load_layers():
    """Three layers of two values a position."""

    def model(inputs, longest):
        rows = []
        for ids in inputs["input_ids"]:
            at = np.arange(longest)
            base = np.asarray(ids[:longest], dtype=np.int64) * 7 + at * 3
            layers = [np.stack([(base + layer) % 11 / 8.0, (base * (layer + 2)) % 13 / 8.0], axis=1) for layer in range(3)]
            rows.append([layer.tolist() for layer in layers])
        return pd.DataFrame({"layers": rows})

    return model


def _examples(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id", F.col("text").alias("text_a"), F.lit(None).cast("string").alias("text_b"), F.col("quality").cast("string").alias("label")
    )


def _run(spark, sf):
    return runs.classify(_examples(spark, sf), ["doc_id"], CE.label_ids(spark, sf), 128, vocabulary(spark, sf), load_classifier)


_LOGITS = f"""f AS (SELECT doc_id, label_ids, list_transform(string_split(input_ids, ' '), lambda x: x::BIGINT) AS ids
 FROM ({ORACLES['seq6_class_features']})),
l AS (SELECT doc_id, label_ids, list_sum(ids) % 101 / 20.0::DOUBLE AS l0,
 list_sum(list_transform(ids, lambda x, i: x * i)) % 103 / 20.0::DOUBLE AS l1 FROM f)"""


@query(
    "run_classifier",
    f"WITH {_LOGITS} SELECT doc_id, round(1 / (1 + exp(l1 - l0)), 6) AS p0, round(1 / (1 + exp(l0 - l1)), 6) AS p1 FROM l",
)
def classifier(spark, sf):
    probabilities, _ = _run(spark, sf)
    p = F.col("probabilities")
    return probabilities.select("doc_id", F.get(p, F.lit(0)).alias("p0"), F.get(p, F.lit(1)).alias("p1"))


@query(
    "run_classifier_metrics",
    f"""WITH {_LOGITS} SELECT round(avg(((l1 > l0)::INT = label_ids)::INT), 6) AS eval_accuracy,
 round(avg(greatest(l0, l1) + ln(exp(l0 - greatest(l0, l1)) + exp(l1 - greatest(l0, l1)))
  - CASE WHEN label_ids = 0 THEN l0 ELSE l1 END), 6) AS eval_loss FROM l""",
)
def classifier_metrics(spark, sf):
    return _run(spark, sf)[1]


@query(
    "run_token_vectors",
    CE.pair_sql(64) + """, v AS (SELECT doc_id // 1000 AS conv_id, doc_id % 1000 AS turn, pos::BIGINT AS position, piece AS token, id * 7 + pos * 3 AS base FROM body)
SELECT conv_id, turn, position, token, round((base + 2) % 11 / 8.0::DOUBLE, 6) AS last_0,
 round((base * 4) % 13 / 8.0::DOUBLE, 6) AS last_1, round(base % 11 / 8.0::DOUBLE, 6) AS first_0 FROM v""",
)
def token_vectors(spark, sf):
    rows = runs.token_vectors(CE._turns(spark, sf), ["conv_id", "turn"], 64, vocabulary(spark, sf), load_layers, [-1, 0])
    value = lambda layer, k: F.get(F.get("layers", F.lit(layer))["values"], F.lit(k))
    return rows.select(
        "conv_id", "turn", "position", "token", value(0, 0).alias("last_0"), value(0, 1).alias("last_1"), value(1, 0).alias("first_0")
    )


@query(
    "scr1_length_batches",
    f"WITH {_LOGITS} SELECT doc_id, round(l0, 6) AS l0, round(l1, 6) AS l1, len(list_filter(ids, lambda x: x > 0)) AS tokens FROM l JOIN f USING (doc_id)",
)
def length_batches(spark, sf):
    features = S.classification_features(_examples(spark, sf), ["doc_id"], CE.label_ids(spark, sf), 128, vocabulary(spark, sf))
    rows = R.score_by_length(features, ["doc_id"], ["input_ids"], load_classifier, runs.LOGITS, runs._real_tokens(), 2048, report=True)
    logit = lambda k: F.get("logits", F.lit(k))
    return rows.select("doc_id", logit(0).alias("l0"), logit(1).alias("l1"), "tokens")
