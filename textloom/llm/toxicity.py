"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its byte n-grams, with word ends marked, each hashed to
a row of an embedding table; a word's vector is the mean of
its rows, a passage's vector the mean of its words' vectors, and a softmax
over two classes reads the passage. Table and softmax are trained together in
numpy. A misspelt word shares most n-grams, and so its vector, with the word.

Labels are for documents, but a few words make a document toxic. A document
is therefore read in passages of ``width`` neighbouring words, at every
place, and its highest passage counts; training takes the highest passages of
all labelled documents, anew in each round. A last logistic step turns the
highest passage's value into a probability for the document.

The classifier is fitted on at most ``max_rows`` labelled rows a class and
``max_bytes`` of text, half a class, chosen by a hash of the id, long texts last; one task does it. All
documents are scored, whole, in one pass and without a shuffle.

Defined results: a null or empty text has no passage and gets the score of a
passage without words; without labels of both classes every score is the
share of label 1 among those there are (0.5 if none); repeated label rows of
an id count once, with the higher label; null labels or ids are not learned
from; rows are scored one by one, so repeats and ties don't matter; an empty
table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import chunks, fresh_texts, lower_words, ragged, texts_of, tidy


#: Numbers that are worked on at once where there are millions.
SLICE = 1 << 18


@dataclass(frozen=True)
class ToxicityConfig:
    max_rows: int = 4000
    max_bytes: int = 24 * 1024 * 1024
    buckets: int = 1 << 20
    dims: int = 8
    shortest: int = 3
    longest: int = 6
    width: int = 4
    rounds: int = 4
    epochs: int = 20
    rate: float = 0.3
    decay: float = 1e-5
    least_seen: int = 8
    prior: float = 8.0
    seed: int = 11


@dataclass(frozen=True)
class ToxicityModel:
    """``value`` of a bucket: its embedding seen by the softmax, class 1 less class 0."""

    value: np.ndarray
    bias: float
    slope: float
    shift: float
    config: ToxicityConfig


def subwords(words: pa.Array, config: ToxicityConfig) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram of each word, and the word it belongs to."""
    marked = pc.binary_join_element_wise(
        pa.scalar("<", words.type), words, pa.scalar(">", words.type), pa.scalar("", words.type)
    ).cast(pa.large_binary())
    raw = np.frombuffer(marked.buffers()[2] or b"", dtype=np.uint8).astype(np.uint32)
    ends = np.frombuffer(marked.buffers()[1], dtype=np.int64)[
        marked.offset : marked.offset + len(marked) + 1
    ]
    begin, size = ends[:-1], np.diff(ends)
    own = np.arange(len(words), dtype=np.int32)
    lengths = range(config.shortest, config.longest + 1)
    # 32 bits a number, in their place at once: a sample of 24 MB has some 14 million n-grams.
    n_grams = sum(int(np.maximum(size - n + 1, 0).sum()) for n in lengths)
    grams, owners = np.empty(n_grams, dtype=np.int32), np.empty(n_grams, dtype=np.int32)
    filled = 0
    rolled = np.zeros(len(raw), dtype=np.uint32)
    with np.errstate(over="ignore"):
        for n in range(1, config.longest + 1):
            rolled[: len(raw) - n + 1] *= np.uint32(16777619)
            rolled[: len(raw) - n + 1] += raw[n - 1 :] + np.uint32(1)
            if n < config.shortest:
                continue
            many = np.maximum(size - n + 1, 0)
            at = rolled[ragged(begin, many)] ^ np.uint32(0x9E3779B9 * n & 0xFFFFFFFF)
            at *= np.uint32(0x85EBCA6B)
            at ^= at >> np.uint32(15)
            at %= np.uint32(config.buckets)
            grams[filled : filled + len(at)], owners[filled : filled + len(at)] = at, np.repeat(own, many)
            filled += len(at)
    return grams, owners


def taken_sums(values: np.ndarray, taken: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``values[taken]`` by ``of``, in row order; only a slice of the rows is spelled out at a time."""
    out = np.zeros(n)
    for k in range(0, len(of), SLICE):
        np.add.at(out, of[k : k + SLICE], values[taken[k : k + SLICE]].astype(np.float64))
    return out


def counts_of(of: np.ndarray, n: int) -> np.ndarray:
    """How often each number below ``n`` occurs, without a copy of all of them."""
    out = np.zeros(n, dtype=np.int64)
    for k in range(0, len(of), SLICE):
        out += np.bincount(of[k : k + SLICE], minlength=n)
    return out


def word_means(value: np.ndarray, grams: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    """Mean of ``value`` over the n-grams of each of ``n`` words."""
    return taken_sums(value, grams, owners, n) / np.maximum(counts_of(owners, n), 1)


def highest_passages(
    per_word: np.ndarray, starts: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Highest mean of ``width`` neighbours in each text, and where it begins.

    A shorter text is one passage; a text without words has mean 0.
    """
    sizes = np.diff(starts)
    sums = np.zeros(len(per_word) + 1)
    np.cumsum(per_word, out=sums[1:])
    long = sizes > width
    best = np.zeros(len(sizes))
    at = starts[:-1].copy()
    short = ~long & (sizes > 0)
    best[short] = (sums[starts[1:][short]] - sums[starts[:-1][short]]) / sizes[short]
    # Whole texts of about SLICE places at a time.
    texts = np.flatnonzero(long)
    block = np.cumsum(sizes[texts]) // SLICE
    for some in np.split(texts, np.flatnonzero(np.diff(block)) + 1):
        if not len(some):
            continue
        places = sizes[some] - width + 1
        begin = ragged(starts[:-1][some], places)
        means = (sums[begin + width] - sums[begin]) / width
        first = np.cumsum(places) - places
        top = np.maximum.reduceat(means, first)
        best[some] = top
        hits = np.flatnonzero(means == np.repeat(top, places))
        text = np.searchsorted(first, hits, side="right") - 1
        _, earliest = np.unique(text, return_index=True)
        at[some] = begin[hits[earliest]]
    return best, at


def _softmax_round(bags, grams, owners, n_words, y, table, head, bias, config):
    """Some epochs of joint training on ``bags``: word and bag number of each word."""
    word, bag = bags
    d, n_bags = config.dims, len(y)
    per_word = np.maximum(np.bincount(owners, minlength=n_words), 1)[:, None]
    per_bag = np.maximum(np.bincount(bag, minlength=n_bags), 1)[:, None]
    by_gram = np.argsort(grams, kind="stable")
    touched, first = np.unique(grams[by_gram], return_index=True)

    def sums(rows, of, n, taken=None):
        """Sums of ``rows[taken]`` by ``of``, a column at a time, so that no copy of all rows is made."""
        out = np.empty((n, d))
        for k in range(d):
            column = rows[:, k] if taken is None else rows[:, k][taken]
            out[:, k] = np.bincount(of, weights=column, minlength=n)
        return out

    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    seen_table = np.full((len(touched), d), 1e-12)
    seen_head, seen_bias = np.full_like(head, 1e-12), np.full_like(bias, 1e-12)
    for _ in range(config.epochs):
        words = sums(table, owners, n_words, grams) / per_word
        x = sums(words, bag, n_bags, word) / per_bag
        z = x @ head + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(n_bags), y] -= 1
        p *= weight[:, None]
        to_words = sums((p @ head.T) / per_bag, word, n_words, bag) / per_word
        to_table = np.stack([np.add.reduceat(to_words[:, k][owners[by_gram]], first) for k in range(d)], axis=1)
        to_table += config.decay * table[touched]
        to_head, to_bias = x.T @ p + config.decay * head, p.sum(axis=0)
        seen_table += to_table**2
        seen_head += to_head**2
        seen_bias += to_bias**2
        table[touched] -= config.rate * to_table / np.sqrt(seen_table)
        head -= config.rate * to_head / np.sqrt(seen_head)
        bias -= config.rate * to_bias / np.sqrt(seen_bias)


def train(texts: pa.Array, y: np.ndarray, config: ToxicityConfig) -> ToxicityModel:
    """Fit table, softmax and the last logistic step on labelled texts."""
    y = np.asarray(y, dtype=np.int64)
    none = np.zeros(config.buckets, dtype=np.float32)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-3), 1 - 1e-3)
        return ToxicityModel(none, 0.0, 0.0, float(np.log(share / (1 - share))), config)
    words, starts = lower_words(texts)
    coded = words.dictionary_encode()
    code, n_words = coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary)
    grams, owners = subwords(coded.dictionary, config)
    del texts, words, coded
    toxic, clean = np.zeros(n_words), np.zeros(n_words)
    for a, b, one in zip(starts, starts[1:], y):
        (toxic if one else clean)[np.unique(code[a:b])] += 1
    # Where to look first: passages rich in n-grams that label 1 has more often.
    of_gram = lambda n: taken_sums(n, owners, grams, config.buckets)
    value = np.log((of_gram(toxic) + config.prior) / y.sum()) - np.log(
        (of_gram(clean) + config.prior) / (1 - y).sum()
    )
    # n-grams of few words in few documents tell of those documents alone.
    rare = of_gram(toxic + clean) < config.least_seen
    value[rare] = 0
    random = np.random.default_rng(config.seed)
    table = random.uniform(-0.01, 0.01, (config.buckets, config.dims))
    table[rare] = 0
    head, bias = random.uniform(-0.5, 0.5, (config.dims, 2)), np.zeros(2)
    sizes = np.diff(starts)
    for _ in range(config.rounds):
        _, at = highest_passages(word_means(value, grams, owners, n_words)[code], starts, config.width)
        other = starts[:-1] + (random.random(len(y)) * np.maximum(sizes - config.width, 1)).astype(int)
        pick = np.flatnonzero(y == 0)
        begin = np.concatenate([at, other[pick]])
        end = np.minimum(begin + config.width, np.concatenate([starts[1:], starts[1:][pick]]))
        labels = np.concatenate([y, y[pick]])
        many = end - begin
        chosen = code[ragged(begin, many)]
        bag = np.repeat(np.arange(len(begin)), many)
        used, word = np.unique(chosen, return_inverse=True)
        new = np.full(n_words, -1, dtype=np.int32)
        new[used] = np.arange(len(used))
        slices = (slice(k, k + SLICE) for k in range(0, len(grams), SLICE))
        mine = np.concatenate([np.flatnonzero((new[owners[s]] >= 0) & ~rare[grams[s]]) + s.start for s in slices] or [new[:0]])
        _softmax_round(
            (word, bag), grams[mine], new[owners[mine]], len(used), labels, table, head, bias, config
        )
        value = table @ (head[:, 1] - head[:, 0])
    b = float(bias[1] - bias[0])
    best, _ = highest_passages(word_means(value, grams, owners, n_words)[code], starts, config.width)
    slope, shift = _logistic(best + b, y)
    return ToxicityModel(value.astype(np.float32), b, slope, shift, config)


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps with a small penalty."""
    scale = float(np.abs(x).mean()) or 1.0
    a = np.stack([x / scale, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (p - y) + penalty * w
        bend = (a * (p * (1 - p))[:, None]).T @ a + penalty * np.eye(2)
        w -= np.clip(np.linalg.solve(bend, slope), -2, 2)
    return float(w[0] / scale), float(w[1])


def score_texts(texts: pa.Array, model: ToxicityModel) -> np.ndarray:
    """Probability of label 1 for each text."""
    words, starts = lower_words(texts)
    coded = words.dictionary_encode()
    per_word = np.zeros(0)
    if len(words):
        grams, owners = subwords(coded.dictionary, model.config)
        value = word_means(model.value, grams, owners, len(coded.dictionary))
        per_word = value[coded.indices.to_numpy(zero_copy_only=False)]
    best, _ = highest_passages(per_word, starts, model.config.width)
    z = (best + model.bias) * model.slope + model.shift
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column, config
) -> DataFrame:
    """Bounded labelled sample ``doc_id, label, text``: at most ``max_rows`` a class.

    The ids are chosen from the narrow label rows, so that only the chosen
    documents' texts are read into the sample.
    """
    known = (
        labels.filter(usable & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    order = F.xxhash64(F.col("doc_id"), F.lit(config.seed))
    classes = [
        known.filter(c).orderBy(order, "doc_id").limit(config.max_rows)
        for c in (F.col("label") == 1, F.col("label") == 0)
    ]
    chosen = F.broadcast(classes[0].union(classes[1]).withColumnRenamed("doc_id", "_id"))
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        chosen, F.col("doc_id") == F.col("_id")
    )
    # Texts of more than a 32nd of the bound come last, so that they cost none but themselves.
    size, bound = F.octet_length("text"), config.max_bytes // 2
    long = size > bound // 32
    running = Window.partitionBy("label").orderBy(long, F.when(long, size), order, "doc_id", "text").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    total = F.sum(size).over(running)
    return found.withColumn("_size", total).filter(F.col("_size") <= bound).select("doc_id", "label", "text")


def fit(docs: DataFrame, labels: DataFrame, usable: Column, config=ToxicityConfig()) -> ToxicityModel:
    """Train on the usable labelled rows, in one task over the bounded sample."""

    def run(batches):
        rows = [b for b in batches if b.num_rows]
        table = pa.Table.from_batches(rows) if rows else None
        if table is None:
            model = train(pa.array([], pa.large_string()), np.zeros(0), config)
        else:
            table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
            texts, y = fresh_texts(table["text"]), table["label"].to_numpy()
            del rows, table
            model = train(texts, y, config)
        yield pa.RecordBatch.from_pydict(
            {
                "value": pa.array([model.value.tobytes()], pa.binary()),
                "bias": [model.bias],
                "slope": [model.slope],
                "shift": [model.shift],
            }
        )

    sample = training_rows(docs, labels, "toxic", usable, config)
    row = (
        sample.coalesce(1)
        .mapInArrow(tidy(run), "value binary, bias double, slope double, shift double")
        .first()
    )
    value = np.frombuffer(bytes(row["value"]), dtype=np.float32) if row else None
    if row is None:
        return train(pa.array([], pa.large_string()), np.zeros(0), config)
    return ToxicityModel(value, row["bias"], row["slope"], row["shift"], config)


def scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score`` of each row, in one pass and without a shuffle."""

    def run(batches):
        for batch in chunks(batches, "text"):
            values = pa.array(score_texts(texts_of(batch), model))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["doc_id", "score"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(tidy(run), rows.select("doc_id", F.lit(0.0).alias("score")).schema)


def harmless(docs: DataFrame, model: ToxicityModel, limit: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose score is below ``limit``, with all their columns."""

    def run(batches):
        for batch in chunks(batches, "text"):
            yield batch.filter(pa.array(score_texts(texts_of(batch), model) < limit))

    return docs.mapInArrow(tidy(run), docs.schema)
