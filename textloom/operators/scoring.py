"""Model scores as tables: batch scoring hook, metrics and report shapes."""

from __future__ import annotations

import os
import sys
import types
import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import arrays as A
from textloom.functions.exact import exact_mean, exact_sum


def score(
    features: DataFrame,
    keys: list[str],
    inputs: list[str],
    scorer: Callable[[pd.DataFrame], pd.DataFrame],
    outputs: T.StructType,
    batch_size: int = 32,
) -> DataFrame:
    """Run a user-supplied model over a feature table, one output row per input.

    ``scorer`` gets at most ``batch_size`` rows of ``inputs`` and returns the
    ``outputs`` columns in the same order. Only the needed columns reach Python.
    """
    schema = T.StructType([features.schema[k] for k in keys] + list(outputs.fields))
    names = [f.name for f in outputs.fields]

    def run(frames):
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                part = frame.iloc[start : start + batch_size].reset_index(drop=True)
                scored = scorer(part[inputs])
                if len(scored) != len(part):
                    raise ValueError("scorer must return one row per input row")
                yield pd.concat([part[keys], scored[names].reset_index(drop=True)], axis=1)

    columns = list(dict.fromkeys(keys + inputs))
    return features.select(*columns).mapInPandas(run, schema)


#: Rows that are sorted by length at once.
SORTED_ROWS = 10_000


def worker_model(name: str, load: Callable[[], Callable]) -> tuple[Callable, int]:
    """The model of this worker process and how often it was loaded here (once).

    Functions reach the workers by value, so the model is kept in a module of
    its own that lives as long as the process.
    """
    kept = sys.modules.setdefault("_textloom_models", types.ModuleType("_textloom_models"))
    if name not in kept.__dict__:
        kept.__dict__[name] = [load(), 0]
        kept.__dict__[name][1] += 1
    return tuple(kept.__dict__[name])


def _by_length(sizes: np.ndarray, max_tokens: int) -> list[np.ndarray]:
    """Rows of similar length together: each batch times its longest row is ``max_tokens`` at most."""
    order, parts, start = np.argsort(sizes, kind="stable"), [], 0
    for k in range(len(order)):
        if k > start and (k - start + 1) * sizes[order[k]] > max_tokens:
            parts.append(order[start:k])
            start = k
    return [*parts, order[start:]] if len(order) else []


def score_by_length(
    features: DataFrame,
    keys: list[str],
    inputs: list[str],
    load: Callable[[], Callable[[pd.DataFrame, int], pd.DataFrame]],
    outputs: T.StructType,
    length: Column,
    max_tokens: int = 16_384,
    report: bool = False,
) -> DataFrame:
    """Run a model that each worker process loads once, in batches of similar lengths.

    ``load`` makes the model, a function of a batch's ``inputs`` and the tokens of
    its longest row. ``length`` counts a row's real tokens; a batch holds at
    most ``max_tokens`` with padding, a longer row is a batch of its own.
    ``report`` adds ``tokens``, ``padded`` (what the row takes in its batch),
    ``worker`` and ``loads``.
    """
    name = f"model-{uuid.uuid4().hex}"
    names = [f.name for f in outputs.fields]
    rows = features.select(*dict.fromkeys(keys + inputs), length.cast("int").alias("_tokens"))
    schema = T.StructType([rows.schema[k] for k in keys] + list(outputs.fields))
    if report:
        for column in ("tokens", "padded", "worker", "loads"):
            schema = schema.add(column, T.LongType())

    def run(frames):
        model, loads = worker_model(name, load)
        for frame in frames:
            for begin in range(0, len(frame), SORTED_ROWS):
                block = frame.iloc[begin : begin + SORTED_ROWS].reset_index(drop=True)
                sizes = block["_tokens"].fillna(0).to_numpy(dtype=np.int64)
                for part in _by_length(sizes, max_tokens):
                    batch = block.iloc[part].reset_index(drop=True)
                    longest = int(sizes[part].max())
                    scored = model(batch[inputs], longest)
                    if len(scored) != len(batch):
                        raise ValueError("scorer must return one row per input row")
                    out = pd.concat([batch[keys], scored[names].reset_index(drop=True)], axis=1)
                    if report:
                        out["tokens"], out["padded"] = sizes[part], longest
                        out["worker"], out["loads"] = os.getpid(), loads
                    yield out

    return rows.mapInPandas(run, schema)


def padding_report(scored: DataFrame) -> DataFrame:
    """Workers, model loads and the share of padding in all that was computed."""
    per_worker = scored.groupBy("worker").agg(
        F.max("loads").alias("loads"), F.sum("tokens").alias("tokens"), F.sum("padded").alias("padded")
    )
    return per_worker.agg(
        F.count("*").alias("workers"),
        F.sum("loads").alias("loads"),
        (1 - F.sum("tokens") / F.sum("padded")).alias("padding_share"),
    )


def join_scores(features: DataFrame, scores: DataFrame, key: str = "unique_id") -> DataFrame:
    return features.join(scores, key)


def unscored(features: DataFrame, scores: DataFrame, key: str = "unique_id") -> DataFrame:
    return features.join(scores, key, "left_anti")


def classification_metrics(scored: DataFrame, logits: str, label: str) -> DataFrame:
    """Accuracy of the first-max class and mean cross-entropy, the same for any partitioning."""
    hit = (A.argmax(F.col(logits)) == F.col(label)).cast("double")
    loss = A.cross_entropy(F.col(logits), F.col(label))
    return scored.agg(exact_mean(hit).alias("eval_accuracy"), exact_mean(loss).alias("eval_loss"))


def masked_metrics(slots: DataFrame) -> DataFrame:
    """Weighted metrics over ``(prediction, label, weight, loss)`` slots.

    Padding slots weigh 0; metrics over nothing are 0.
    """
    weight = exact_sum(F.col("weight"))
    hit = exact_sum(F.col("weight") * (F.col("prediction") == F.col("label")).cast("double"))
    loss = exact_sum(F.col("weight") * F.col("loss"))

    def ratio(x: Column) -> Column:
        return F.when(weight > 0, x / weight).otherwise(0.0)

    return slots.agg(
        ratio(hit).alias("masked_lm_accuracy"),
        ratio(loss).alias("masked_lm_loss"),
        (loss / (weight + F.lit(1e-5))).alias("training_loss"),
    )


def masked_slots(rows: DataFrame, log_probs: str) -> DataFrame:
    """One row per masked slot; ``log_probs`` holds one array per slot."""
    zipped = F.arrays_zip(
        F.col(log_probs).alias("lp"),
        F.col("masked_lm_ids").alias("label"),
        F.col("masked_lm_weights").alias("weight"),
    )
    slots = rows.select(F.explode(zipped).alias("z")).select("z.*")
    return slots.select(
        A.argmax(F.col("lp")).alias("prediction"),
        "label",
        "weight",
        (-F.element_at("lp", F.col("label") + 1)).alias("loss"),
    )


#: Rows whose scores are added up at once.
NORM_ROWS = 1000


def _norms():
    """Arrow UDF: ``A.log_sum_exp`` of each list, added up in its order."""

    @F.arrow_udf("double")
    def norms(scores: pa.Array) -> pa.Array:
        found = []
        for lists in (scores.slice(k, NORM_ROWS) for k in range(0, len(scores), NORM_ROWS)):
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            values = lists.flatten().cast(pa.float64())
            square = np.full((len(lists), int(sizes.max(initial=0))), -np.inf)
            square[np.arange(square.shape[1]) < sizes[:, None]] = pc.fill_null(values, 0.0).to_numpy(zero_copy_only=False)
            with np.errstate(invalid="ignore", divide="ignore"):
                top = square.max(axis=1, initial=-np.inf)
                terms = np.exp(square - top[:, None])
                terms[np.arange(square.shape[1]) >= sizes[:, None]] = 0.0
                total = np.zeros(len(lists))
                for column in np.ascontiguousarray(terms.T):
                    total += column
                norm = top + np.log(total)
            unknown = np.repeat(np.arange(len(lists)), sizes)[values.is_null().to_numpy(zero_copy_only=False)]
            nothing = sizes == 0
            nothing[unknown] = True
            found.append(pa.array(norm, pa.float64(), mask=nothing))
        return pa.concat_arrays(found) if found else pa.array([], pa.float64())

    return norms


def span_loss(scored: DataFrame) -> DataFrame:
    """Mean of start and end cross-entropy over windows."""
    norms = _norms()
    start, end = (
        norms(scores) - F.element_at(scores, F.col(label) + 1)
        for scores, label in (("start_logits", "start_position"), ("end_logits", "end_position"))
    )
    return scored.agg(((exact_mean(start) + exact_mean(end)) / 2).alias("span_loss"))


def metric_lines(metrics: DataFrame) -> DataFrame:
    """One-row metrics to sorted ``key = value`` lines."""
    names = sorted(metrics.columns)
    pairs = F.array(
        *[F.struct(F.lit(n).alias("key"), F.col(n).cast("string").alias("value")) for n in names]
    )
    long = metrics.select(F.explode(pairs).alias("p")).select("p.key", "p.value")
    return long.orderBy("key").select(F.concat("key", F.lit(" = "), "value").alias("value"))


def vector_records(
    rows: DataFrame, key: str, tokens: str, layers: str, indexes: list[int]
) -> DataFrame:
    """Nested per-token vectors.

    ``layers`` is array<array<array<double>>> (layer, token, value); negative
    indexes count from the last layer. Values are rounded to six digits.
    """
    names = F.array(*[F.lit(i) for i in indexes])
    per_token = A.let(
        lambda toks, chosen, idx: F.transform(
            toks,
            lambda t, i: F.struct(
                t.alias("token"),
                F.zip_with(
                    idx,
                    chosen,
                    lambda n, layer: F.struct(
                        n.alias("index"), A.rounded(F.get(layer, i)).alias("values")
                    ),
                ).alias("layers"),
            ),
        ),
        F.col(tokens),
        A.pick_layers(F.col(layers), indexes),
        names,
    )
    return rows.select(F.col(key).alias("linex_index"), per_token.alias("features"))
