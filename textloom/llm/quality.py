"""Quality by ordinal regression: one score from hashed text, ordered thresholds.

A rating of K grades is modelled by one linear score f of a text and K - 1
ordered thresholds: the chance of grade k or more is the logistic function of
``f - threshold k``. The weights are shared by all grades. Features are hashed:
lower-cased words, the shapes of the words as written (capitals, digits and
signs, with runs shortened), and whether a word repeats the one before; each
counts as the square root of its share of the text.

Weights and thresholds are fitted by gradient steps on the exact likelihood,
on at most ``max_rows`` rows a grade and ``max_bytes`` of text, chosen by a
hash of the id; one task does it. All documents are scored whole, in one pass.

Defined results: a null or empty text has no features, so thresholds alone
speak; without any rated row all grades are as likely; rows with a null grade
or id are not learned from, repeated ratings of an id count once, with the
highest; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import chunks, fresh_texts, hash_strings, texts_of, tidy


@dataclass(frozen=True)
class QualityConfig:
    grades: int = 3
    max_rows: int = 2500
    max_bytes: int = 24 * 1024 * 1024
    buckets: int = 1 << 18
    epochs: int = 150
    rate: float = 0.3
    decay: float = 1e-5
    seed: int = 5


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    thresholds: np.ndarray
    config: QualityConfig


_RUNS = re.compile(r"(.)\1+", re.S)
_CAPITALS, _SMALL, _DIGITS = re.compile(r"[^\W\d_]+"), re.compile(r"[^\W\d_A]+"), re.compile(r"\d+")


def shape(word: str) -> str:
    """``A`` for letters in capitals, ``a`` for small ones, ``0`` for digits; signs stay, runs don't."""
    letters = _CAPITALS.sub(
        lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "Aa" if m[0][0].isupper() else "a", word
    )
    return _RUNS.sub(r"\1\1", _DIGITS.sub("0", letters))


def features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, bucket and value of each feature."""
    split = pc.ascii_split_whitespace(texts)
    offsets = split.offsets.to_numpy().astype(np.int64)
    sizes = np.diff(offsets)
    coded = split.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    names = coded.dictionary
    full = pc.greater(pc.binary_length(names), 0).to_numpy(zero_copy_only=False)
    words = hash_strings(pc.utf8_lower(names))
    shapes = hash_strings(pa.array(["\x00" + shape(w) for w in names.to_pylist()], pa.large_string()))
    text = np.repeat(np.arange(len(texts)), sizes)
    again = np.zeros(len(code), dtype=np.int64)
    again[1:] = (code[1:] == code[:-1]) & (text[1:] == text[:-1])
    keep = full[code]
    text, code, again = text[keep], code[keep], again[keep]
    count = np.bincount(text, minlength=len(texts))
    out_text, out_bucket, out_value = [], [], []
    for family in (words[code], shapes[code], again.astype(np.uint64) + np.uint64(77_777)):
        pair = text * buckets + (family % np.uint64(buckets)).astype(np.int64)
        pair, many = np.unique(pair, return_counts=True)
        out_text.append(pair // buckets)
        out_bucket.append(pair % buckets)
        out_value.append(np.sqrt(many / count[pair // buckets]))
    return np.concatenate(out_text), np.concatenate(out_bucket), np.concatenate(out_value)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def at_least(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """Chance of grade 1 or more, 2 or more, ... for each score."""
    return _logistic(score[:, None] - thresholds[None, :])


def train(texts: pa.Array, grades: np.ndarray, config: QualityConfig) -> QualityModel:
    """Fit shared weights and ordered thresholds by Adagrad on the likelihood."""
    grades = np.asarray(grades, dtype=np.int64)
    steps = config.grades - 1
    weights = np.zeros(config.buckets)
    thresholds = np.arange(steps) - (steps - 1) / 2
    if not len(grades):
        even = (np.arange(steps) + 1) / config.grades
        return QualityModel(weights.astype(np.float32), np.log(even / (1 - even)), config)
    text, bucket, value = features(texts, config.buckets)
    used, column = np.unique(bucket, return_inverse=True)
    w = np.zeros(len(used))
    gaps = np.log(np.diff(thresholds)) if steps > 1 else np.zeros(0)
    base = thresholds[0]
    seen_w, seen_t = np.full(len(used), 1e-8), np.full(steps, 1e-8)
    n = len(grades)
    for _ in range(config.epochs):
        thresholds = base + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        score = np.bincount(text, weights=value * w[column], minlength=n)
        tails = np.concatenate([np.ones((n, 1)), at_least(score, thresholds), np.zeros((n, 1))], axis=1)
        upper, lower = tails[np.arange(n), grades], tails[np.arange(n), grades + 1]
        chance = np.maximum(upper - lower, 1e-9)
        by_score = -(1 - upper - lower) / n
        step = np.zeros((n, steps + 2))
        step[np.arange(n), grades] += upper * (1 - upper) / chance
        step[np.arange(n), grades + 1] -= lower * (1 - lower) / chance
        by_threshold = step[:, 1:-1].sum(axis=0) / n
        # The first threshold moves all; each gap moves those from it on.
        tail = np.cumsum(by_threshold[::-1])[::-1]
        by_base = np.concatenate([tail[:1], tail[1:] * np.exp(gaps)])
        by_w = np.bincount(column, weights=value * by_score[text], minlength=len(used))
        by_w += config.decay * w
        seen_w += by_w**2
        seen_t += by_base**2
        w -= config.rate * by_w / np.sqrt(seen_w)
        moved = config.rate * by_base / np.sqrt(seen_t)
        base -= moved[0]
        gaps = np.clip(gaps - moved[1:], -5, 5)
    thresholds = base + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
    weights[used] = w
    return QualityModel(weights.astype(np.float32), thresholds, config)


def grade_tails(texts: pa.Array, model: QualityModel) -> np.ndarray:
    """Chance of grade 1 or more, 2 or more, ... for each text."""
    text, bucket, value = features(texts, model.config.buckets)
    score = np.bincount(text, weights=value * model.weights[bucket], minlength=len(texts))
    return at_least(score, model.thresholds)


def fit(
    docs: DataFrame, labels: DataFrame, grade: Column, usable: Column, config=QualityConfig()
) -> QualityModel:
    """Train on the usable rated rows; ``grade``: 0 to ``config.grades - 1``, a column of ``labels``."""
    known = (
        labels.filter(usable & F.col("doc_id").isNotNull() & grade.isNotNull())
        .groupBy("doc_id")
        .agg(F.max(grade).cast("int").alias("grade"))
    )
    order = F.xxhash64(F.col("doc_id"), F.lit(config.seed))
    chosen = known.filter("grade = 0").orderBy(order, "doc_id").limit(config.max_rows)
    for g in range(1, config.grades):
        chosen = chosen.union(known.filter(F.col("grade") == g).orderBy(order, "doc_id").limit(config.max_rows))
    chosen = F.broadcast(chosen.withColumnRenamed("doc_id", "_id"))
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        chosen, F.col("doc_id") == F.col("_id")
    )
    # Texts of more than a 32nd of the bound come last, so that they cost none but themselves.
    size, bound = F.octet_length("text"), config.max_bytes // config.grades
    long = size > bound // 32
    running = Window.partitionBy("grade").orderBy(long, F.when(long, size), order, "doc_id", "text").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    total = F.sum(size).over(running)
    sample = found.withColumn("_size", total).filter(F.col("_size") <= bound).select("doc_id", "grade", "text")

    def run(batches):
        rows = [b for b in batches if b.num_rows]
        if rows:
            table = pa.Table.from_batches(rows).sort_by([("doc_id", "ascending"), ("text", "ascending")])
            model = train(fresh_texts(table["text"]), table["grade"].to_numpy(), config)
            yield pa.RecordBatch.from_pydict(
                {
                    "weights": pa.array([model.weights.tobytes()], pa.binary()),
                    "thresholds": pa.array([model.thresholds.tolist()]),
                }
            )

    row = sample.coalesce(1).mapInArrow(tidy(run), "weights binary, thresholds array<double>").first()
    if row is None:
        return train(pa.array([], pa.large_string()), np.zeros(0), config)
    weights = np.frombuffer(bytes(row["weights"]), dtype=np.float32)
    return QualityModel(weights, np.array(row["thresholds"]), config)


def graded(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, expected_grade, tails`` of each row, in one pass and without a shuffle."""

    def run(batches):
        for batch in chunks(batches, "text"):
            tails = grade_tails(texts_of(batch), model)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(tails.ravel()), tails.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tails.sum(axis=1)), flat.cast(pa.list_(pa.float64()))],
                names=["doc_id", "expected_grade", "tails"],
            )

    rows = docs.select("doc_id", "text")
    empty = F.array().cast("array<double>")
    schema = rows.select("doc_id", F.lit(0.0).alias("expected_grade"), empty.alias("tails")).schema
    return rows.mapInArrow(tidy(run), schema)
