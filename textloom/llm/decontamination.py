"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item meet where they share a run of ``tile``
words (a seed). For such pairs, tiles are laid: the longest runs of words
that both have and no tile covers yet are found with Karp-Rabin hashes, for
shorter and shorter lengths down to ``tile``, and marked in both. The share
of the item's words under tiles is its coverage. Order does not matter, so a
passage whose parts were put in another order is found as well.

Words are lower-cased (``A``-``Z``) and freed of ASCII punctuation at their
ends. Only the parts of a document that seeds cover can lie under tiles, so
tiling reads those alone; the hashes of all documents are compared with the
seeds in one pass, without a shuffle. Items are taken in portions of bounded
text, each sent to the tasks; a larger benchmark means more passes.

Defined results: null or empty texts and items cover nothing; an item of
fewer words than ``tile`` is one seed and one tile; ties between items go to
the smaller id; null item ids are ignored; rows are judged one by one, so
repeats keep their own rows; empty tables give an empty result or coverage 0;
all other columns are carried along unread.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import chunks, fresh_texts, hash_strings, lower_words, texts_of, window_hashes


@dataclass(frozen=True)
class TilingConfig:
    tile: int = 4
    coverage: float = 0.6
    portion_bytes: int = 8 * 1024 * 1024


_MODULUS = (1 << 61) - 1
_RADIX = 1_000_003_133


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every normalised word, and where each text starts."""
    words, starts = lower_words(texts)
    coded = words.dictionary_encode()
    bare = pc.utf8_trim(coded.dictionary, characters="!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    plain = pc.if_else(pc.equal(pc.binary_length(bare), 0), coded.dictionary, bare)
    return hash_strings(plain)[coded.indices.to_numpy(zero_copy_only=False)], starts


def _windows(tokens: list[int], free: list[bool], length: int) -> dict[int, list[int]]:
    """Karp-Rabin hashes of all runs of ``length`` unmarked tokens, with their places."""
    found: dict[int, list[int]] = {}
    lead = pow(_RADIX, length, _MODULUS)
    rolled = run = 0
    for k, token in enumerate(tokens):
        if not free[k]:
            rolled = run = 0
            continue
        rolled = (rolled * _RADIX + token) % _MODULUS
        run += 1
        if run > length:
            rolled = (rolled - tokens[k - length] * lead) % _MODULUS
        if run >= length:
            found.setdefault(rolled, []).append(k - length + 1)
    return found


def tile_pair(item: list[int], text: list[int], shortest: int) -> int:
    """Words of ``item`` under tiles shared with ``text``; marks are made in both."""
    shortest = min(shortest, len(item))
    free_item, free_text = [True] * len(item), [True] * len(text)
    length = min(len(item), len(text))
    while length >= max(1, shortest):
        there = _windows(text, free_text, length)
        matches = []
        for value, places in _windows(item, free_item, length).items():
            for p in places:
                for t in there.get(value, ()):
                    size = 0
                    while (
                        p + size < len(item)
                        and t + size < len(text)
                        and free_item[p + size]
                        and free_text[t + size]
                        and item[p + size] == text[t + size]
                    ):
                        size += 1
                    if size >= length:
                        matches.append((-size, p, t))
        again = False
        for size, p, t in sorted(matches):
            if all(free_item[p : p - size]) and all(free_text[t : t - size]):
                free_item[p : p - size] = [False] * -size
                free_text[t : t - size] = [False] * -size
            else:
                again = True  # the rest of an overlapped match may still be long enough
        if not again:
            length = length // 2 if length > 2 * shortest else length - 1
    return free_item.count(False)


class Items:
    """A portion of the benchmark: token lists and the seeds that lead to them."""

    def __init__(self, ids: list[int], texts: pa.Array, config: TilingConfig):
        hashes, starts = token_hashes(texts)
        self.ids, self.config = ids, config
        self.tokens = [hashes[a:b] for a, b in zip(starts[:-1], starts[1:])]
        seeds: dict[int, list[tuple[np.ndarray, int]]] = {}
        for k, tokens in enumerate(self.tokens):
            if len(tokens):
                width = min(config.tile, len(tokens))
                runs = window_hashes(tokens, width)[: len(tokens) - width + 1]
                seeds.setdefault(width, []).append((np.unique(runs), k))
        self.seeds = {}
        for width, found in seeds.items():
            values = np.concatenate([v for v, _ in found])
            owner = np.concatenate([np.full(len(v), k) for v, k in found])
            order = np.argsort(values, kind="stable")
            self.seeds[width] = (values[order], owner[order])

    def best(self, texts: pa.Array) -> tuple[np.ndarray, list[int | None]]:
        """Highest coverage of an item by each text, and that item's id."""
        hashes, starts = token_hashes(texts)
        coverage, item = np.zeros(len(texts)), [None] * len(texts)
        hits: dict[int, dict[int, list[int]]] = {}
        for width, (values, owner) in self.seeds.items():
            if len(hashes) < width:
                continue
            runs = window_hashes(hashes, width)
            left = np.searchsorted(values, runs)
            found = np.flatnonzero(values[np.minimum(left, len(values) - 1)] == runs)
            text = np.searchsorted(starts, found, side="right") - 1
            inside = found + width <= starts[text + 1]
            for p, d in zip(found[inside].tolist(), text[inside].tolist()):
                k = left[p]
                while k < len(values) and values[k] == runs[p]:
                    hits.setdefault(d, {}).setdefault(int(owner[k]), []).append(p)
                    k += 1
        for d, of_items in hits.items():
            for k, places in of_items.items():
                tokens = self.tokens[k]
                width = min(self.config.tile, len(tokens))
                text = _covered(hashes, sorted(set(places)), width)
                share = tile_pair(tokens.tolist(), text, self.config.tile) / len(tokens)
                if share > coverage[d] or (
                    share == coverage[d] and item[d] is not None and self.ids[k] < item[d]
                ):
                    coverage[d], item[d] = share, self.ids[k]
        return coverage, item


def _covered(hashes: np.ndarray, places: list[int], width: int) -> list[int]:
    """Tokens under the seeds at ``places``; -1 parts what is not adjacent."""
    out, end = [], None
    for p in places:
        if end is None or p > end:
            out += [-1] if out else []
            end = p
        out += hashes[end : p + width].tolist()
        end = p + width
    return out


def _portions(benchmark: DataFrame, config: TilingConfig) -> list[Items]:
    """The benchmark in parts of bounded text, each read on its own."""
    rows = benchmark.filter("item_id is not null and text is not null").select(
        F.col("item_id").cast("long").alias("item_id"), "text"
    )
    total = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    parts = max(1, -(-2 * total // config.portion_bytes)) if total > config.portion_bytes else 1
    for part in range(parts):
        mine = rows if parts == 1 else rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        found = mine.orderBy("item_id", "text").toArrow()
        texts = fresh_texts(found["text"])
        yield Items(found["item_id"].to_pylist(), texts, config)


def coverage(docs: DataFrame, benchmark: DataFrame, config=TilingConfig()) -> DataFrame:
    """``doc_id, item_id, coverage`` of each row: the item it covers most."""
    out = docs.select("doc_id", "text").withColumns(
        {"item_id": F.lit(None).cast("long"), "coverage": F.lit(0.0)}
    )
    schema = out.schema
    for portion in _portions(benchmark, config):

        def run(batches, portion=portion):
            for batch in chunks(batches, "text"):
                share, item = portion.best(texts_of(batch))
                had_item, had = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                for k in range(len(had)):
                    if had_item[k] is not None and (
                        had[k] > share[k] or (had[k] == share[k] and had_item[k] <= item[k])
                    ):
                        share[k], item[k] = had[k], had_item[k]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(item, pa.int64()), pa.array(share)],
                    names=schema.names,
                )

        out = out.mapInArrow(run, schema)
    return out.drop("text")


def uncontaminated(docs: DataFrame, benchmark: DataFrame, config=TilingConfig()) -> DataFrame:
    """The rows of ``docs`` that cover no item by ``config.coverage`` or more."""
    for portion in _portions(benchmark, config):

        def run(batches, portion=portion):
            for batch in chunks(batches, "text"):
                share, _ = portion.best(texts_of(batch))
                yield batch.filter(pa.array(share < config.coverage))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
