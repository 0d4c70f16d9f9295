"""The longest-match automaton against a plain loop, and encoding in the row."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators import pieces
from textloom.operators import subword as W
from textloom.operators.pieces import PieceAutomaton, WordMemory

LIMIT = 12


def spec(word, tokens):
    if len(word) > LIMIT:
        return ["[UNK]"]
    out, at = [], 0
    while at < len(word):
        for end in range(len(word), at, -1):
            piece = ("##" if at else "") + word[at:end]
            if piece in tokens:
                break
        else:
            return ["[UNK]"]
        out.append(piece)
        at = end
    return out


def _vocabulary(rng):
    letters = "ab#é日"[: rng.randint(2, 5)]
    tokens = {"[UNK]"}
    for _ in range(rng.randint(0, 25)):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(1, 6)))
        tokens.add(word if rng.random() < 0.4 else "##" + word)
    tokens = sorted(tokens)
    rng.shuffle(tokens)
    words = {"".join(rng.choice(letters + "z") for _ in range(rng.randint(1, 14))) for _ in range(150)}
    return tokens, sorted(words)


def test_pieces_of_random_vocabularies():
    rng = random.Random(0)
    for _ in range(150):
        tokens, words = _vocabulary(rng)
        automaton = PieceAutomaton(tokens, [3 * k for k in range(len(tokens))], 3 * tokens.index("[UNK]"), LIMIT)
        ids, counts = automaton.split(pa.array(words, pa.large_string()))
        at = 0
        for word, n in zip(words, counts):
            assert [tokens[i // 3] for i in ids[at : at + n]] == spec(word, tokens)
            at += n


def test_longest_match_at_every_place():
    rng = random.Random(1)
    for _ in range(80):
        tokens, words = _vocabulary(rng)
        automaton = PieceAutomaton(tokens, list(range(len(tokens))), 0, LIMIT)
        places, ends, ids = automaton.longest(pa.array(words, pa.large_string()))
        at = 0
        for word, n in zip(words, places):
            assert n == (len(word) if len(word) <= LIMIT else 1)
            for start in range(n):
                forms = {e: ("##" if start else "") + word[start:e] for e in range(start + 1, len(word) + 1)}
                best = max((e for e, f in forms.items() if f in tokens), default=-1)
                assert ends[at] == best and ids[at] == (tokens.index(forms[best]) if best > 0 else -1)
                at += 1


def test_repeated_tokens_and_empty_vocabularies():
    automaton = PieceAutomaton(["a", "a", ""], [1, 5, 9], 7, LIMIT)
    assert automaton.split(pa.array(["a", "b", "aa"], pa.large_string()))[0].tolist() == [5, 7, 7]
    none = PieceAutomaton([], [], 7, LIMIT)
    ids, counts = none.split(pa.array(["a", "bc"], pa.large_string()))
    assert ids.tolist() == [7, 7] and counts.tolist() == [1, 1]
    assert none.split(pa.array([], pa.large_string()))[0].tolist() == []


def test_memory_forgets_and_learns_again(monkeypatch):
    rng = random.Random(2)
    tokens, _ = _vocabulary(rng)
    automaton = PieceAutomaton(tokens, list(range(len(tokens))), tokens.index("[UNK]"), LIMIT)
    monkeypatch.setattr(pieces, "REMEMBERED", 20)
    monkeypatch.setattr(pieces, "READ_CHARS", 7)
    memory = WordMemory(automaton)
    for _ in range(30):
        words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 30))]
        ids, sizes = memory.encode(pa.array(words, pa.large_string()))
        want = [spec(w, tokens) for w in words]
        assert [tokens[i] for i in ids] == sum(want, []) and sizes.tolist() == [len(w) for w in want]


def test_rows_keep_their_columns(spark, small_vocab):
    df = spark.createDataFrame([(1, "a", "un want"), (2, None, None), (None, "c", "")], "id int, other string, t string")
    units = df.select("id", "other", X.unit_tokens(F.col("t")).alias("units"))
    rows = W.encode(units, ["id", "other"], "units", small_vocab).collect()
    assert {(r.id, r.other): (r.ids, r.piece_units) for r in rows} == {
        (1, "a"): ([7, 3], [0, 0]), (2, None): ([], []), (None, "c"): ([], []),
    }


@pytest.mark.parametrize("max_broadcast", [500_000, 3])
def test_plans_without_shuffles_within_the_bound(spark, small_vocab, max_broadcast):
    units = spark.createDataFrame([(1, "un want")], "id int, t string").select("id", X.unit_tokens(F.col("t")).alias("units"))
    plan = W.encode(units, ["id"], "units", small_vocab, max_broadcast=max_broadcast)._jdf.queryExecution().toString()
    assert ("Exchange" in plan) == (max_broadcast < 10)
