"""Elias-Fano tries and the language model against plain counts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import ngram_lm as L
from textloom.llm.queries import id_remainder
from textloom.llm.elias_fano import STEP, EliasFano, Trie, code_shares


@pytest.mark.parametrize("n,bits", [(0, 64), (1, 64), (5, 3), (1000, 10), (3000, 64), (70_000, 20)])
def test_sequence(n, bits):
    draw = np.random.default_rng(n)
    values = np.sort(draw.integers(0, 2**bits, n, dtype=np.uint64, endpoint=False) if bits < 64 else draw.integers(0, 2**64, n, dtype=np.uint64))
    image = np.frombuffer(EliasFano.image(values, bits), dtype=np.uint8)
    s, end = EliasFano.view(image, 0)
    assert end == len(image) and (s.get(np.arange(n)) == values).all()
    asked = np.concatenate([draw.integers(0, 2**min(bits, 63), 2000, dtype=np.uint64), values[:500]])
    if n:
        assert (s.successor(asked) == np.searchsorted(values, asked)).all()
        assert ((s.find(asked) >= 0) == np.isin(asked, values)).all()


def test_trie_from_a_mapped_file(tmp_path):
    draw = np.random.default_rng(3)
    big = lambda top, n: draw.integers(0, top, n).astype(np.uint64) * np.uint64(2**50 + 12345)
    pairs = np.unique(np.stack([big(300, 9000), big(2000, 9000)], axis=1), axis=0)
    share = draw.uniform(1e-6, 1, len(pairs))
    (tmp_path / "trie").write_bytes(Trie.image(pairs[:, 0], pairs[:, 1], share).tobytes())
    trie = Trie(np.memmap(tmp_path / "trie", dtype=np.uint8, mode="r"))
    code = trie.lookup(pairs[:, 0], pairs[:, 1])
    ratio = code_shares()[code] / share
    assert (code > 0).all() and ratio.max() <= 1 + 1e-9 and ratio.min() > 10**-STEP * 0.999
    known = {tuple(p) for p in pairs.tolist()}
    x, y = big(310, 5000), big(2100, 5000)
    assert [c > 0 for c in trie.lookup(x, y)] == [p in known for p in zip(x.tolist(), y.tolist())]


def plain(rows, config):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)) + ["\n"] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    count, pair, first = Counter(), Counter(), Counter()
    for words, out in zip(texts, held):
        if not out:
            count.update(words)
            pair.update(zip([None, *words], words))
            first.update([None, *words[:-1]])
    kinds = Counter(h for h, _ in pair)
    n, v = sum(count.values()), len(count)
    u = lambda w: (count[w] + 1) / (n + v + 1)

    def p(h, w):
        seen = max(pair[h, w] - config.discount, 0)
        return (seen + (config.discount * kinds[h] + config.imagined) * u(w)) / (first[h] + config.imagined)

    return [
        (i, out, len(t), sum(count[w] > 0 for w in t), n, sum(math.log10(u(w)) for w in t),
         sum(math.log10(p(h, w)) for h, w in zip([None, *t], t)))
        for (i, _), t, out in zip(rows, texts, held)
    ], count, u


def corpus():
    draw = np.random.default_rng(8)
    words = [f"w{int(k)}" for k in range(200)]
    rows = [(k, " ".join(words[int(j)] for j in draw.zipf(1.4, draw.integers(1, 60)) % 200)) for k in range(120)]
    rows += [(200, None), (201, ""), (202, " A a\tÀ "), (203, "w0 " * 3000), (5, rows[5][1]), (None, "w1 w2")]
    return rows


def held_out():
    return id_remainder(7) == 2


@pytest.mark.parametrize("pack", [1 << 24, 2000])
def test_scores_by_plain_counts(spark, pack):
    rows, config = corpus(), L.ModelConfig(pack_bytes=pack)
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double")
    want = sorted(plain(rows, config)[0], key=lambda r: repr(r[:5]))
    import unittest.mock as mock

    with mock.patch.object(L, "frequent_words", lambda *_: np.zeros(0, np.uint64)):
        got = sorted((tuple(r) for r in L.score(docs.repartition(3), held_out(), config).collect()), key=lambda r: repr(r[:5]))
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
        # Shares are rounded down by at most one step a token.
        assert b[6] - STEP * b[2] - 1e-9 <= a[6] <= b[6] + 1e-9


def test_divided_contexts_add_up(spark):
    """The chance of all known words after a context, frequent or not, is at most 1 and nearly so."""
    rows, config = corpus(), L.ModelConfig(split=8)
    _, count, u = plain(rows, config)
    contexts = ["w1", "w2", "w0", "w150"]
    probes = [(10_000 + k, f"{h} {w}") for h in contexts for k, w in enumerate(sorted(count)) if w != "\n"]
    probes = [(None, t) for _, t in probes]
    held = F.col("probe") | held_out()
    docs = spark.createDataFrame(
        [(k, i, t, False) for k, (i, t) in enumerate(rows)] + [(10_000 + k, i, t, True) for k, (i, t) in enumerate(probes)],
        "id long, doc_id long, text string, probe boolean",
    )
    learned = docs.select(F.col("id").alias("doc_id"), "text", F.coalesce(held, F.col("probe")).alias("out"))
    # Each probe text is "h w" and the end; subtract the texts "h" to leave p(w | h) p(end | w).
    got = {r.doc_id: r for r in L.score(learned, F.col("out"), config).collect()}
    assert all(math.isfinite(r.score) for r in got.values())
    base = plain(rows, config)[0]
    close = [abs(got[k].score - want[6]) / want[2] for k, want in enumerate(base)]
    assert max(close) < 0.6 and got[0].train_tokens == base[0][4]


def test_word_parts_and_chances_sum_to_one():
    """One context's chances over all words of a small vocabulary, divided and whole."""
    import pyarrow as pa

    vocabulary = [f"v{k}" for k in range(40)]
    texts = [" ".join(["h", vocabulary[k % 17]]) for k in range(60)]
    for hot in ([], ["h"]):
        hashes = np.sort(L.hash_strings(pa.array(hot, pa.string())))
        config = L.ModelConfig(split=4)
        learn = pa.array(texts, pa.large_string())
        probe = pa.array([f"h {w}" for w in vocabulary] + ["h", "h unseen"], pa.large_string())
        both = [L.Layout(t, 3, hashes, 4) for t in (learn, probe)]
        blobs = [dict(L._blobs(b, np.full(len(t), k == 0))) for k, (b, t) in enumerate(zip(both, (learn, probe)))]
        answers, tokens, types, mass = {}, 0, 0, np.zeros(4)
        import pandas as pd

        for s in range(3):
            have = [k for k in (0, 1) if s in blobs[k]]
            out = L._answer(pd.DataFrame({"pack": have, "shard": s, "blob": [blobs[k][s] for k in have]}), config)
            tokens, types = tokens + out.tokens.sum(), types + out.types.sum()
            mass += np.array(out["mass"].iloc[0])
            answers |= {s: a for p, a in zip(out["pack"], out.answer) if p == 1}
        layout = both[1]
        count, part = np.zeros(len(layout.words), np.int64), np.zeros(len(layout.left), np.int64)
        kind, code = part.copy(), np.zeros(len(layout.left), np.uint8)
        for s, a in answers.items():
            mine, pairs, _, own = layout.shard(s)
            words, sizes, kinds, code[pairs] = L._parts(a)
            count[mine], part[pairs], kind[pairs] = words, sizes[own], kinds[own]
        chance = (mass + 1) / (tokens + types + 1)
        unigram = (count + 1) / (tokens + types + 1)
        share = np.where(layout.divided, chance[layout.parts[layout.right]], 1.0)
        h = int(L.hash_strings(pa.array(["h"]))[0])
        of = layout.words[layout.left] == np.uint64(h)
        given = (config.discount * kind / share + config.imagined) * unigram[layout.right]
        p = (code_shares()[code] * part + given)[of] / (60 + config.imagined)
        # Words never learned share one chance; here 23 + 1 of them stand for it.
        seen = count[layout.right[of]] > 0
        total = p[seen].sum() + p[~seen].max(initial=0)
        assert 0.9 < total <= 1.1


def test_empty_and_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = sorted(L.score(docs, F.lit(True)).collect())
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)]
    assert L.score(docs.limit(0), F.lit(False)).count() == 0


@pytest.mark.parametrize("pack", [1 << 24, 2000])
def test_dividing_changes_no_score(spark, pack):
    """With divided contexts, whatever the rows' order and the shards, the scores are those of plain counts."""
    rows, config = corpus(), L.ModelConfig(pack_bytes=pack)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    want = sorted(plain(rows, config)[0], key=key)
    before, runs = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for shards, order in (("8", 1), ("3", -1), ("19", 1)):
            spark.conf.set("spark.sql.shuffle.partitions", shards)
            docs = spark.createDataFrame(rows[::order], "doc_id long, text string")
            packs = L._packs(docs, held_out(), config)
            hot = L.frequent_words(packs, int(shards), config)
            often = ["w0", "\n\n"] if shards == "19" else ["w0"]
            assert np.isin(L.hash_strings(L.pa.array(often)), hot).all()
            runs.append(sorted((tuple(r) for r in L.score(docs, held_out(), config).collect()), key=key))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for got in runs:
        for a, b, c in zip(got, want, runs[0], strict=True):
            assert a[:5] == b[:5] == c[:5] and a[5] == pytest.approx(b[5])
            assert a[5:] == pytest.approx(c[5:], rel=1e-12)
            assert b[6] - STEP * b[2] - 1e-9 <= a[6] <= b[6] + 1e-9


def test_frequent_words_of_all_packs(spark):
    """A word that only later packs hold is found, and its training count is exact."""
    rows = [(k, " ".join(f"r{k}_{j}" for j in range(20))) for k in range(1200)]
    rows += [(5000 + k, "late " * 40) for k in range(300)]
    config = L.ModelConfig(pack_bytes=4000)
    packs = L._packs(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), F.col("doc_id") >= 5100, config)
    late = L.hash_strings(L.pa.array(["late"]))
    hot = L.frequent_words(packs, 8, config)
    assert np.isin(late, hot).all() and (hot[1:] > hot[:-1]).all()
    assert L.learned_counts(packs, np.sort(late)).tolist() == [4000]


def test_small_shares_are_rounded_down():
    share = np.array([1e-6, 1e-8, 1e-12, 1e-18])
    pairs = np.arange(4, dtype=np.uint64)
    ratio = code_shares()[Trie(Trie.image(pairs, pairs, share)).lookup(pairs, pairs)] / share
    assert ratio.max() <= 1 + 1e-9 and ratio.min() > 10**-STEP * 0.999
