"""Bigram language model in Elias-Fano tries, trained and queried in one exchange.

Documents are packed, some megabytes a pack. From each pack go its distinct
words and word pairs, with their counts in training documents, to the shards
that their hashes name: training counts and questions at once. A shard adds
up the counts of all packs, builds an Elias-Fano trie of its pairs, and
answers every pack from it: counts of words, and the quantised probability of
each pair within its context. The answers come back to the pack, and whole
texts are scored there.

The model is a bigram with absolute discounting: of each seen pair's count D
is taken off and given to all words by their unigram chance
``u(w) = (c(w) + 1) / (N + V + 1)``, along with m imagined counts. With T(h)
the distinct words seen after h,
``p(w | h) = (max(c(h, w) - D, 0) + (D * T(h) + m) * u(w)) / (c(h) + m)``.
Stored shares are rounded down, so the probabilities of all words add up to 1
or a little less.

Pairs go to the shard of their context. Contexts that the counts of all packs
show to be frequent are dealt over many shards by the second word. Their c(h)
is counted before the exchange, and the distinct words T(h) that the shards
find behind their parts are added up after it. So a divided context has the
formula, the stored shares and the scores of any other, bit for bit, and
dividing never changes a result.
Nothing that grows with the corpus is broadcast or collected: only N, V and
the counts of the divided contexts, at most 16 a shard, are.

Words are told apart by 64-bit hashes, so counts are exact up to clashes.

Defined results: a null or empty text is its end token alone; a row whose
``held`` is null is learned from; repeated rows are learned from and scored
one by one; if nothing is learned from, N and V are 0 and every token has
probability 1; an empty table gives an empty result; other columns play no
part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import (
    chunks,
    give_back,
    hash_strings,
    mix64,
    texts_of,
    tidy,
    word_hashes,
    written,
)
from textloom.llm.elias_fano import Trie, code_shares


@dataclass(frozen=True)
class ModelConfig:
    discount: float = 0.75
    imagined: float = 2.0
    pack_bytes: int = 12 * 1024 * 1024
    shard_tokens: int = 1_000_000
    split: int = 64


_FINISH, _BEGIN = (int(hash_strings(pa.array([mark]))[0]) for mark in ("\n", "\n\n"))


def _dense(parts: list[np.ndarray]) -> bytes:
    """Arrays of whole numbers or hashes in one compressed string."""
    out = []
    for part in parts:
        if part.dtype != np.uint64:
            most = int(part.max(initial=0))
            part = part.astype(np.uint8 if most < 256 else np.uint16 if most < 65_536 else np.uint32)
        out += [f"{part.dtype.str}{len(part):012d}".encode(), part.tobytes()]
    return zstandard.compress(b"".join(out), 1)


def _parts(blob: bytes) -> list[np.ndarray]:
    raw = memoryview(zstandard.decompress(blob))
    found, at = [], 0
    while at < len(raw):
        kind, size = bytes(raw[at : at + 3]).decode(), int(bytes(raw[at + 3 : at + 15]))
        dtype = np.dtype(kind)
        found.append(np.frombuffer(raw, dtype, size, at + 15))
        at += 15 + size * dtype.itemsize
    return found


def word_parts(words: np.ndarray, split: int) -> np.ndarray:
    """The part of a divided context that each word belongs to."""
    return (mix64(words ^ np.uint64(0xA24BAED4963EE407)) % np.uint64(split)).astype(np.int64)


def numbered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of the texts with both marks, each token's number, and the texts' sizes."""
    hashes, starts = word_hashes(texts)
    n = len(texts)
    sizes = np.diff(starts) + 1
    ends = np.cumsum(sizes)
    tokens = np.empty(len(hashes) + n, dtype=np.uint64)
    last = np.zeros(len(tokens), dtype=bool)
    last[ends - 1] = True
    tokens[last], tokens[~last] = _FINISH, hashes
    words, number = np.unique(tokens, return_inverse=True)
    place = np.searchsorted(words, _BEGIN)
    if place == len(words) or words[place] != _BEGIN:
        words = np.insert(words, place, np.uint64(_BEGIN))
        number = number + (number >= place)
    return words, number, sizes


class Layout:
    """Distinct words and pairs of a pack, in the order in which shards see them.

    Made alike from the same texts wherever it is made, so answers need no keys.
    ``texts`` may be given as what ``numbered`` makes of them.
    """

    def __init__(self, texts: pa.Array | tuple, shards: int, hot: np.ndarray, split: int):
        words, number, sizes = texts if isinstance(texts, tuple) else numbered(texts)
        n, ends = len(sizes), np.cumsum(sizes)
        place = np.searchsorted(words, _BEGIN)
        before = np.empty_like(number)
        before[1:] = number[:-1]
        before[ends - sizes] = place
        pairs, self.pair = np.unique(before * len(words) + number, return_inverse=True)
        self.sizes, self.document = sizes, np.repeat(np.arange(n), sizes)
        self.number, self.before, self.words = number, before, words
        self.left, self.right = pairs // len(words), pairs % len(words)
        home = (mix64(words) % np.uint64(shards)).astype(np.int64)
        shard = home[self.left]
        self.parts = word_parts(words, split)
        self.divided = np.isin(words, hot)[self.left]
        spread = np.flatnonzero(self.divided)
        if len(spread):
            part = self.parts[self.right[spread]].astype(np.uint64)
            shard[spread] = (
                mix64(words[self.left[spread]] + part * np.uint64(0x9E3779B97F4A7C15))
                % np.uint64(shards)
            ).astype(np.int64)
        self.word_order = np.argsort(home, kind="stable")
        self.pair_order = np.lexsort((self.right, self.left, shard))
        self.word_cut = np.searchsorted(home[self.word_order], np.arange(shards + 1))
        self.pair_cut = np.searchsorted(shard[self.pair_order], np.arange(shards + 1))
        self.shards = shards

    def counts(self, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weight = learned[self.document].astype(np.int64)
        word = np.bincount(self.number, weights=weight, minlength=len(self.words)).astype(np.int64)
        pair = np.bincount(self.pair, weights=weight, minlength=len(self.left)).astype(np.int64)
        return word, pair

    def shard(self, s: int):
        """Words and pairs of shard ``s``, and the pairs' distinct contexts."""
        mine = self.word_order[self.word_cut[s] : self.word_cut[s + 1]]
        pairs = self.pair_order[self.pair_cut[s] : self.pair_cut[s + 1]]
        contexts, own = np.unique(self.left[pairs], return_inverse=True)
        return mine, pairs, contexts, own


def _blobs(layout: Layout, learned: np.ndarray):
    word_count, pair_count = layout.counts(learned)
    for s in range(layout.shards):
        mine, pairs, contexts, own = layout.shard(s)
        if not len(mine) and not len(pairs):
            continue
        seconds, second = np.unique(layout.right[pairs], return_inverse=True)
        yield s, _dense(
            [
                layout.words[mine],
                word_count[mine],
                layout.words[contexts],
                layout.words[seconds],
                own,
                second,
                pair_count[pairs],
            ]
        )


def _answer(pdf: pd.DataFrame, config: ModelConfig, hot=None) -> pd.DataFrame:
    """Add up the counts of one shard, build its trie, and answer every pack from it.

    ``hot``: sorted hashes of the divided contexts and their whole counts.
    Without it, a divided context is answered by the counts of the part.
    """
    divided, whole = hot or (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    asked = [_parts(b) for b in pdf["blob"]]
    words, count = _added(np.concatenate([a[0] for a in asked]), [a[1] for a in asked])
    left = [a[2][a[4]] for a in asked]
    right = [a[3][a[5]] for a in asked]
    pairs = [a[6] for a in asked]
    known = [p > 0 for p in pairs]
    first = np.concatenate([x[k] for x, k in zip(left, known)])
    second = np.concatenate([x[k] for x, k in zip(right, known)])
    many = np.concatenate([p[k].astype(np.int64) for p, k in zip(pairs, known)])
    order = np.lexsort((second, first))
    first, second, many = first[order], second[order], many[order]
    new = np.ones(len(first), dtype=bool)
    new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    at = np.flatnonzero(new)
    first, second = first[at], second[at]
    many = np.add.reduceat(many, at) if len(at) else many
    contexts, totals = _added(first, [many])
    kinds = np.bincount(np.searchsorted(contexts, first), minlength=len(contexts))
    place = np.searchsorted(contexts, divided)
    mine = np.flatnonzero(np.isin(divided, contexts))
    totals[place[mine]] = whole[mine]
    share = (many - config.discount) / totals[np.searchsorted(contexts, first)]
    trie = Trie(Trie.image(first, second, share))
    out = []
    for asking, x, y in zip(asked, left, right):
        # Every word asked for is among ``words``; a context may be new to training.
        own = np.minimum(np.searchsorted(contexts, asking[2]), max(0, len(contexts) - 1))
        part = kind = np.zeros(len(asking[2]), np.int64)
        if len(contexts):
            same = contexts[own] == asking[2]
            part, kind = np.where(same, totals[own], 0), np.where(same, kinds[own], 0)
        if len(divided):
            at = np.minimum(np.searchsorted(divided, asking[2]), len(divided) - 1)
            part = np.where(divided[at] == asking[2], whole[at], part)
        own_count = count[np.searchsorted(words, asking[0])]
        out.append(_dense([own_count, part, kind, trie.lookup(x, y)]))
    seen = count > 0
    mass = np.bincount(
        word_parts(words[seen], config.split), weights=count[seen] + 1.0, minlength=config.split
    )
    return pd.DataFrame(
        {
            "pack": pdf["pack"],
            "shard": pdf["shard"],
            "answer": out,
            # Totals of the shard stand in its first row.
            "tokens": [int(count.sum())] + [0] * (len(out) - 1),
            "types": [int(seen.sum())] + [0] * (len(out) - 1),
            "mass": [mass.tolist()] + [None] * (len(out) - 1),
            "divided": [mine.tolist()] + [[]] * (len(out) - 1),
            "kinds": [kinds[place[mine]].tolist()] + [[]] * (len(out) - 1),
        }
    )


def _added(names: np.ndarray, counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    values, own = np.unique(names, return_inverse=True)
    weights = np.concatenate([c.astype(np.float64) for c in counts]) if counts else None
    return values, np.bincount(own, weights=weights, minlength=len(values)).astype(np.int64)


def _packs(docs: DataFrame, held: Column, config: ModelConfig) -> DataFrame:
    """Written rows of many documents each: ids, held flags, distinct words and tokens.

    ``seen`` holds a pack's distinct words with their counts in all and in
    training documents, ``tokens`` the texts' sizes and each token's word.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held, F.lit(False)).alias("held"),
        "text",
    )

    def pack(batches):
        task, turn = TaskContext.get().partitionId(), 0
        for batch in _joined(batches, config.pack_bytes):
            words, number, sizes = numbered(texts_of(batch))
            learned = ~batch.column(1).fill_null(False).to_numpy(zero_copy_only=False)
            count = np.bincount(number, minlength=len(words))
            train = np.bincount(number[np.repeat(learned, sizes)], minlength=len(words))
            # The mark before a text counts once a text, though it is no token.
            begin = np.searchsorted(words, _BEGIN)
            count[begin], train[begin] = len(learned), learned.sum()
            lists = lambda k, kind, none: pa.array(
                [batch.column(k).fill_null(none).to_pylist()], pa.list_(kind)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{task}-{turn}"]),
                    lists(0, pa.int64(), 0),
                    lists(1, pa.bool_(), False),
                    pa.array([batch.column(0).is_valid().to_pylist()]),
                    pa.array([int(count.sum())], pa.int64()),
                    pa.array([_dense([words, count, train])], pa.binary()),
                    pa.array([_dense([sizes, number])], pa.binary()),
                ],
                names=["pack", "ids", "held", "named", "size", "seen", "tokens"],
            )
            turn += 1

    schema = (
        "pack string, ids array<long>, held array<boolean>, named array<boolean>, size long, "
        "seen binary, tokens binary"
    )
    return written(rows.mapInArrow(tidy(pack), schema), "packs")


def _joined(batches, limit: int):
    """Batches put together until they hold about ``limit`` bytes of text."""
    held, size = [], 0
    for batch in chunks(batches, "text", limit):
        own = batch.get_total_buffer_size() if batch.num_rows == 0 else batch.nbytes
        if held and size + own > limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        held.append(batch)
        size += own
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _tokens(seen: bytes, tokens: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes, number = _parts(tokens)
    return _parts(seen)[0], number.astype(np.int64), sizes.astype(np.int64)


def frequent_words(packs: DataFrame, shards: int, config: ModelConfig) -> np.ndarray:
    """Sorted hashes of the contexts to divide; they steer the dealing and no result.

    A pack names the words that are at least 1 of ``16 * shards`` of its own
    tokens, and those whose named counts are as much of all tokens are taken:
    every word of twice that share among them, and no more than ``16 * shards``.
    """

    def often(batches):
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                words, count, _ = _parts(blob)
                count = count.astype(np.int64)
                context = words != np.uint64(_FINISH)
                named = context & (count * 16 * shards >= count.sum())
                yield pa.RecordBatch.from_pydict(
                    {
                        "word": pa.array(words[named].view(np.int64)),
                        "n": pa.array(count[named]),
                    }
                )

    total = packs.agg(F.sum("size")).first()[0] or 0
    taken = (
        packs.select("seen")
        .mapInArrow(often, "word long, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") * 16 * shards >= total)
    )
    return np.sort(taken.toPandas()["word"].to_numpy(dtype=np.int64).view(np.uint64))


def learned_counts(packs: DataFrame, words: np.ndarray) -> np.ndarray:
    """How often each of the sorted ``words`` stands in training documents."""

    def count(batches):
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                own, _, train = _parts(blob)
                place = np.flatnonzero(np.isin(words, own))
                yield pa.RecordBatch.from_pydict(
                    {
                        "place": pa.array(place.astype(np.int64)),
                        "n": pa.array(train[np.searchsorted(own, words[place])].astype(np.int64)),
                    }
                )

    total = np.zeros(len(words), np.int64)
    if len(words):
        found = (
            packs.select("seen").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
        ).toPandas()
        total[found["place"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    return total


def score(docs: DataFrame, held: Column, config: ModelConfig = ModelConfig()) -> DataFrame:
    """Train on the rows where ``held`` is not true, and score all rows of ``docs``.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score``; the scores are log10 probabilities of whole texts.
    """
    packs = _packs(docs, held, config)
    tokens = packs.agg(F.sum("size")).first()[0] or 0
    # What a shard holds is bounded by its tokens, whatever the corpus.
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + tokens // config.shard_tokens)
    hot = frequent_words(packs, shards, config)
    whole = learned_counts(packs, hot)

    def answer(pdf):
        out = _answer(pdf, config, (hot, whole)).drop(columns="mass")
        give_back()
        return out

    def emit(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                tokens = _tokens(batch.column(2)[k].as_py(), batch.column(3)[k].as_py())
                layout = Layout(tokens, shards, hot, config.split)
                learned = ~np.array(batch.column(1)[k].as_py(), dtype=bool)
                for s, blob in _blobs(layout, learned):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(k, 1), pa.array([s]), pa.array([blob], pa.binary())],
                        names=["pack", "shard", "blob"],
                    )

    answers = written(
        packs.select("pack", "held", "seen", "tokens")
        .mapInArrow(tidy(emit), "pack string, shard long, blob binary")
        .groupBy("shard")
        .applyInPandas(
            answer,
            "pack string, shard long, answer binary, tokens long, types long, "
            "divided array<long>, kinds array<long>",
        ),
        "answers",
    )
    totals = answers.agg(F.sum("tokens"), F.sum("types")).first()
    train_tokens, types = int(totals[0] or 0), int(totals[1] or 0)
    behind = (
        answers.select(F.explode(F.arrays_zip("divided", "kinds")).alias("of"))
        .groupBy("of.divided")
        .agg(F.sum("of.kinds").alias("kinds"))
        .toPandas()
    )
    whole_kinds = np.zeros(len(hot), np.int64)
    whole_kinds[behind["divided"].to_numpy(dtype=np.int64)] = behind["kinds"].to_numpy(dtype=np.int64)

    def finish(pack, answered):
        rows = []
        for row in pack.itertuples(index=False):
            layout = Layout(_tokens(row.seen, row.tokens), shards, hot, config.split)
            count = np.zeros(len(layout.words), np.int64)
            part = np.zeros(len(layout.left), np.int64)
            kind = np.zeros(len(layout.left), np.int64)
            code = np.zeros(len(layout.left), np.uint16)
            for s, answer in zip(answered["shard"], answered["answer"]):
                mine, pairs, _, own = layout.shard(s)
                words, sizes, kinds, code[pairs] = _parts(answer)
                count[mine], part[pairs], kind[pairs] = words, sizes[own], kinds[own]
            of = layout.words[layout.left[layout.divided]]
            kind[layout.divided] = whole_kinds[np.searchsorted(hot, of)]
            ids = pd.arrays.IntegerArray(
                np.array(row.ids, dtype=np.int64), ~np.array(row.named, dtype=bool)
            )
            held_out = np.array(row.held, dtype=bool)
            scores = _scored(layout, count, (part, kind, code), train_tokens, types, config)
            rows.append(pd.DataFrame({"doc_id": ids, "held_out": held_out, **scores}))
        out = pd.concat(rows)
        give_back()
        return out

    return (
        packs.groupBy("pack")
        .cogroup(answers.groupBy("pack"))
        .applyInPandas(
            finish,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
    )


def _scored(layout, count, pairs, train_tokens, types, config) -> dict:
    """Scores of a pack's documents from the answers of the shards."""
    part, kind, code = pairs
    n = len(layout.sizes)
    unigram = (count + 1) / (train_tokens + types + 1)
    # A context's whole count is its count as a word; the beginning is a context only.
    begin = np.searchsorted(layout.words, _BEGIN)
    context = count.copy()
    context[begin] = part[layout.left == begin].max(initial=0)
    seen = code_shares()[code] * part
    given = (config.discount * kind + config.imagined) * unigram[layout.right]
    chance = (seen + given) / (context[layout.left] + config.imagined)
    per = lambda values: np.bincount(layout.document, weights=values, minlength=n)
    return {
        "n_tokens": layout.sizes,
        "n_known": per((count > 0)[layout.number].astype(float)).astype(np.int64),
        "train_tokens": np.full(n, train_tokens, dtype=np.int64),
        "base_score": per(np.log10(unigram)[layout.number]),
        "score": per(np.log10(chance)[layout.pair]),
    }
