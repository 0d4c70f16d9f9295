"""Helpers shared by the corpus operators: written tables, words, hashes."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import shared_folder

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Text handled at once inside a task; bounds the arrays built from it.
CHUNK_BYTES = 8 * 1024 * 1024


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it from there.

    Later steps then neither recompute it nor depend on the executors that
    made it, and read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """``A``-``Z`` to lower case; all other characters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def worker_state(key: str, build):
    """An object kept for the life of a Python worker process.

    Functions reach the workers by value, so a module global would be new in
    each task. What is kept must only save time, never change a result.
    """
    kept = sys.modules.setdefault("_textloom_worker", types.ModuleType("_textloom_worker"))
    if key not in kept.__dict__:
        kept.__dict__[key] = build()
    return kept.__dict__[key]


def give_back() -> None:
    """Return freed memory of this process to the system.

    Python workers outlive their tasks; without this, each keeps the most
    that any task of it ever used.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(fn):
    """A generator function for ``mapInArrow`` that gives memory back at the end of its task."""

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            give_back()

    return run


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES):
    """Cut record batches so that each holds about ``limit`` bytes of ``text``.

    Rows stay whole and in order; a longer text forms a batch of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes.astype(np.int64)) // limit
        cuts = np.flatnonzero(np.diff(block)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if b > a:
                yield batch.slice(a, b - a)


def fresh_texts(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column with nulls as empty texts, in memory of its own.

    Some Arrow kernels misread slices that were cast, hence the copy.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    copied = column.take(pa.array(np.arange(len(column), dtype=np.int64)))
    return pc.fill_null(copied.cast(pa.large_string()), "")


def texts_of(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    return fresh_texts(batch.column(batch.schema.get_field_index(name)))


def lower_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of all texts in one array, and where each text starts."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    offsets = split.offsets.to_numpy().astype(np.int64)
    words = split.flatten()
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(full)])
    starts = before[offsets - offsets[0]]
    return (words if full.all() else words.filter(pa.array(full))), starts


_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def hash_strings(values: pa.Array) -> np.ndarray:
    """64-bit hashes of strings."""
    import xxhash

    return np.fromiter(
        (xxhash.xxh3_64_intdigest(v) for v in values.cast(pa.large_binary()).to_pylist()),
        dtype=np.uint64,
        count=len(values),
    )


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts, and where each text starts."""
    words, starts = lower_words(texts)
    coded = words.dictionary_encode()
    return hash_strings(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)], starts


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` neighbours; the last ``width - 1`` wrap and are unused."""
    out = np.zeros(len(hashes), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = mix64(out * _BASE + np.roll(hashes, -k) + np.uint64(k + 1))
    return out


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + sizes[i] - 1`` of all i, one after another."""
    total = int(sizes.sum())
    first = np.cumsum(sizes) - sizes
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, sizes)
