"""Whole runs: labelled texts to metrics, texts to vectors of their tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import arrays as A
from textloom.operators import scoring as R
from textloom.operators import sequences as S
from textloom.session import cut

LOGITS = T.StructType([T.StructField("logits", T.ArrayType(T.DoubleType()))])
LAYERS = T.StructType([T.StructField("layers", T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))])


def _real_tokens():
    return F.aggregate("input_mask", F.lit(0), lambda total, v: total + v)


def classify(
    examples: DataFrame,
    keys: list[str],
    labels: DataFrame,
    width: int,
    vocab: DataFrame,
    load: Callable,
    max_tokens: int = 16_384,
) -> tuple[DataFrame, DataFrame]:
    """``(keys, text_a, text_b, label)`` to class probabilities and to metrics.

    Features are built, scored by the model that ``load`` makes once in each
    worker (``input_ids`` and the longest row in, ``logits`` out), and written once;
    probabilities and metrics are read from what was written.
    """
    features = S.classification_features(examples, keys, labels, width, vocab)
    scored = cut(
        R.score_by_length(
            features, [*keys, "label_ids"], ["input_ids"], load, LOGITS, _real_tokens(), max_tokens
        )
    )
    probabilities = scored.select(*keys, A.softmax(F.col("logits")).alias("probabilities"))
    return probabilities, R.classification_metrics(scored, "logits", "label_ids")


def token_vectors(
    texts: DataFrame,
    keys: list[str],
    width: int,
    vocab: DataFrame,
    load: Callable,
    indexes: list[int],
    max_tokens: int = 16_384,
) -> DataFrame:
    """``(keys, text_a, text_b)`` to one row per token with its vectors of the chosen layers.

    The model gives ``layers`` (layer, position, value) for a row's
    ``input_ids``; padding has no row. Negative indexes count from the last layer.
    """
    features = S.encode_pairs(texts, keys, width, vocab, with_tokens=True)
    vectors = R.score_by_length(
        features, [*keys, "tokens"], ["input_ids"], load, LAYERS, _real_tokens(), max_tokens
    )
    names = F.array(*[F.lit(i) for i in indexes])
    per_token = A.let(
        lambda tokens, chosen, idx: F.transform(
            tokens,
            lambda t, i: F.struct(
                i.alias("position"),
                t.alias("token"),
                F.zip_with(
                    idx, chosen, lambda n, layer: F.struct(n.alias("index"), A.rounded(F.get(layer, i)).alias("values"))
                ).alias("layers"),
            ),
        ),
        F.col("tokens"),
        A.pick_layers(F.col("layers"), indexes),
        names,
    )
    return vectors.select(*keys, F.explode(per_token).alias("t")).select(*keys, "t.*")
