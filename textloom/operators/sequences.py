"""Fixed-width id, mask and segment arrays for one text or a pair."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import arrays as A
from textloom.functions import text as X
from textloom.functions.digests import numbered_draws
from textloom.functions.draws import draw_key
from textloom.operators.subword import CLS, SEP, VocabFacts, encode_text, vocab_facts
from textloom.session import broadcast_if_small


def truncate_pair(a: Column, b: Column, limit) -> tuple[Column, Column]:
    """Drop tail elements until both fit; a lone first sequence is simply cut."""
    keep_a, keep_b = A.pair_lengths(F.size(a), F.size(b), limit)
    return A.head(a, keep_a), A.head(b, keep_b)


def _front_leavers():
    """Arrow UDF ``(key, removed) -> n``: the removed elements, numbered from 1, that leave the front, as their draw is below one half."""

    @F.arrow_udf("int")
    def leavers(keys: pa.Array, removed: pa.Array) -> pa.Array:
        sizes = np.maximum(pc.fill_null(removed, 0).to_numpy(zero_copy_only=False).astype(np.int64), 0)
        rows = np.repeat(np.arange(len(sizes)), sizes)
        numbers = np.arange(1, len(rows) + 1) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        front = numbered_draws(keys, rows, numbers)[0] < 1 << 31
        return pa.array(np.bincount(rows[front], minlength=len(sizes)).astype(np.int32))

    return leavers


def random_truncate(values: Column, keep: Column, seed: str, *keys) -> Column:
    """Cut to ``keep`` elements; each removed element leaves front or back evenly."""
    heads = _front_leavers()(draw_key(seed, *keys), (F.size(values) - keep).cast("int"))
    return F.slice(values, heads + 1, keep)


def fixed_width(df: DataFrame, a: str, b: str, width: int, facts: VocabFacts) -> DataFrame:
    """Add input_ids, input_mask and segment_ids built from id arrays ``a`` and ``b``."""
    ids = A.bracketed(F.col(a), F.col(b), facts.id(CLS), facts.id(SEP))
    return (
        df.withColumn("_ids", ids)
        .withColumn("_segments", A.segment_marks(F.col(a), F.col(b)))
        .withColumn("input_ids", A.pad(F.col("_ids"), width, F.lit(0)))
        .withColumn("input_mask", A.pad(F.array_repeat(F.lit(1), F.size("_ids")), width, F.lit(0)))
        .withColumn("segment_ids", A.pad(F.col("_segments"), width, F.lit(0)))
        .drop("_ids", "_segments")
    )


def encode_pairs(
    examples: DataFrame,
    keys: list[str],
    width: int,
    vocab: DataFrame,
    lower: bool = True,
    with_tokens: bool = False,
    facts: VocabFacts | None = None,
) -> DataFrame:
    """``(keys, text_a, text_b)`` to fixed-width arrays.

    Both texts go through one encoding pass: tokens of text_a carry unit 0,
    tokens of text_b unit 1. A text_b without tokens counts as absent.
    """
    facts = facts or vocab_facts(vocab)

    # Normalised texts without lines of their own: text_a is line 0 of the two, text_b line 1.
    spaced = [F.coalesce(X.spaced_text(F.col(c), lower), F.lit("")) for c in ("text_a", "text_b")]
    encoded = encode_text(examples, keys, F.concat_ws("\n", *spaced), vocab, facts, with_pieces=with_tokens)
    n_a = F.size(F.filter("piece_units", lambda u: u == 0))
    n_b = F.size("piece_units") - n_a
    # Pairs leave room for three specials, single texts for two.
    pair_a, pair_b = A.pair_lengths(n_a, n_b, width - 3)
    keep_a = F.when(n_b > 0, pair_a).otherwise(F.least(n_a, F.lit(width - 2)))
    sized = encoded.select(
        "*", n_a.alias("n_a"), keep_a.alias("keep_a"), F.when(n_b > 0, pair_b).otherwise(0).alias("keep_b")
    )

    def part_a(c):
        return F.slice(c, F.lit(1), F.col("keep_a"))

    def part_b(c):
        return F.slice(c, F.col("n_a") + 1, F.col("keep_b"))

    cut = sized.withColumn("a", part_a(F.col("ids"))).withColumn("b", part_b(F.col("ids")))
    out = fixed_width(cut, "a", "b", width, facts)
    columns = [*keys, "input_ids", "input_mask", "segment_ids"]
    if with_tokens:
        tokens = A.bracketed(
            part_a(F.col("pieces")), part_b(F.col("pieces")), F.lit(CLS), F.lit(SEP)
        )
        out = out.withColumn("tokens", tokens)
        columns.append("tokens")
    return out.select(*columns)


def attach_label_ids(df: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """Label to ``label_ids``; a label outside the list is an error."""
    table = broadcast_if_small(labels.select(F.col("label").alias(label), "label_id"))
    return df.join(table, label, "left").withColumn(
        "label_ids",
        F.when(
            F.col("label_id").isNull(),
            F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(F.col(label), F.lit("null")))),
        ).otherwise(F.col("label_id")),
    ).drop("label_id")


def unknown_labels(df: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.join(labels.select(F.col("label").alias(label)), label, "left_anti")


def classification_features(
    examples: DataFrame,
    keys: list[str],
    labels: DataFrame,
    width: int,
    vocab: DataFrame,
    lower: bool = True,
) -> DataFrame:
    """``(keys, text_a, text_b, label)`` to input arrays and ``label_ids``."""
    features = encode_pairs(examples, keys, width, vocab, lower)
    labelled = attach_label_ids(examples.select(*keys, "label"), labels)
    return features.join(labelled.select(*keys, "label_ids"), keys)


def decode_features(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Check the fixed widths of a stored feature table and narrow ids to int."""
    columns = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if field.name in widths:
            c = F.when(
                F.size(c) != widths[field.name],
                F.raise_error(F.lit(f"{field.name} has the wrong length")),
            ).otherwise(c)
        if field.dataType.simpleString() == "array<bigint>":
            c = A.as_int32(c)
        elif field.dataType.simpleString() == "bigint":
            c = c.cast("int")
        columns.append(c.alias(field.name))
    return df.select(*columns)
