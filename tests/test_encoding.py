import pytest
from pyspark.sql import functions as F

from textloom.functions import arrays as A
from textloom.functions import text as X
from textloom.operators import sequences as S
from textloom.operators import subword as W
from textloom.operators.order import dense_index, rank_within, running_start


def _encode(spark, vocab, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    units = df.select("id", X.unit_tokens(F.col("t")).alias("units"))
    rows = W.encode(units, ["id"], "units", vocab, with_pieces=True, **kw).collect()
    return {r.id: r for r in rows}


TEXTS = [
    "UNwantéd,running", "unwanted running", "unwantedX running", "", "want\n\nwa, un", "x" * 200, "un" * 101,
]
PIECES = [
    "un ##want ##ed , runn ##ing", "un ##want ##ed runn ##ing", "[UNK] runn ##ing", "", "want wa , un",
    "[UNK]", "[UNK]",
]


@pytest.mark.parametrize("max_broadcast", [500_000, 3, 1])
def test_golden_pieces(spark, small_vocab, max_broadcast):
    """The same pieces whether the dictionary is broadcast whole, in part or not."""
    got = _encode(spark, small_vocab, TEXTS, max_broadcast=max_broadcast)
    assert [" ".join(got[i].pieces) for i in range(len(TEXTS))] == PIECES
    assert got[0].ids == [7, 4, 5, 10, 8, 9]
    assert got[4].piece_units == [0, 2, 2, 2]


def test_hot_word_in_a_large_share_of_rows(spark, small_vocab):
    texts = ["un " * 50 + "wa"] * 20 + [f"want{i}" for i in range(30)]
    whole = _encode(spark, small_vocab, texts)
    split = _encode(spark, small_vocab, texts, max_broadcast=4)
    assert {k: v.ids for k, v in whole.items()} == {k: v.ids for k, v in split.items()}


def test_greedy_matches_plain_python(spark):
    tokens = ["[UNK]", "a", "ab", "abc", "##b", "##c", "##bc", "##ca", "b", "##a"]
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate(tokens)], "token string, token_id int")

    def spec(word):
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

    import itertools

    words = ["".join(w) for n in range(1, 6) for w in itertools.product("abcd", repeat=n)]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r.word: r.pieces for r in W.segment_words(df, vocab).collect()}
    assert got == {w: spec(w) for w in words}


def test_lookup_raises_on_unknown(spark, small_vocab):
    df = spark.createDataFrame([(1, ["un", "nope"])], "id int, toks array<string>")
    with pytest.raises(Exception, match="unknown token"):
        W.tokens_to_ids(df, ["id"], "toks", small_vocab).collect()
    assert [r.token for r in W.missing_tokens(df, "toks", small_vocab).collect()] == ["nope"]


def test_vocab_gaps(spark):
    vocab = spark.createDataFrame([("a", 0), ("b", 3), ("[UNK]", 4)], "token string, token_id int")
    facts = W.vocab_facts(vocab)
    assert facts.gaps == (1, 2)
    ranks = spark.range(3).select(facts.nth_id(F.col("id").cast("int")).alias("x")).collect()
    assert [r.x for r in ranks] == [0, 3, 4]


def test_pair_lengths_equal_the_popping_loop(spark):
    cases = [(a, b, m) for a in range(0, 30, 2) for b in range(0, 30) for m in range(1, 20, 3)]

    def spec(a, b, m):
        while a + b > m:
            if a > b:
                a -= 1
            else:
                b -= 1
        return a, b

    df = spark.createDataFrame(cases, "a int, b int, m int")
    ka, kb = A.pair_lengths(F.col("a"), F.col("b"), F.col("m"))
    for r in df.select("*", ka.alias("x"), kb.alias("y")).collect():
        assert (r.x, r.y) == spec(r.a, r.b, r.m)


def test_pair_features(spark, small_vocab):
    df = spark.createDataFrame(
        [(1, "un wa want", "wa un"), (2, "un wa want un wa want", None), (3, "un", " ")],
        "id int, text_a string, text_b string",
    )
    vocab = small_vocab
    rows = {r.id: r for r in S.encode_pairs(df, ["id"], 7, vocab, with_tokens=True).collect()}
    assert rows[1].tokens == ["[CLS]", "un", "wa", "[SEP]", "wa", "un", "[SEP]"]
    assert rows[1].segment_ids == [0, 0, 0, 0, 1, 1, 1]
    assert rows[2].tokens == ["[CLS]", "un", "wa", "want", "un", "wa", "[SEP]"]
    assert rows[3].input_ids == [1, 7, 2, 0, 0, 0, 0] and rows[3].input_mask == [1, 1, 1, 0, 0, 0, 0]


def test_alignment_and_label_projection(spark):
    tokens = "[UNK] john johan ##son ' s house".split()
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate(tokens)], "token string, token_id int")
    words = spark.createDataFrame([(1, "John\nJohanson\n's\nhouse", ["A", "B", "C", "D"])], "id int, t string, tags array<string>")
    units = words.select("id", X.unit_tokens(F.col("t")).alias("units"))
    enc = W.encode(units, ["id"], "units", vocab)
    first = {r.unit: r.first_piece for r in W.alignment(enc, ["id"]).collect()}
    # One more when [CLS] is put in front.
    assert first == {0: 0, 1: 1, 2: 3, 3: 5}
    row = W.project_labels(enc.join(words.select("id", "tags"), "id"), "tags").first()
    assert row.piece_tags == ["A", "B", "B", "C", "C", "D"]


def test_dense_numbers(spark):
    df = spark.range(1000).repartition(7).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"))
    rows = dense_index(df, [F.col("k").desc()], "n").collect()
    assert {r.k: r.n for r in rows} == {k: 999 - k for k in range(1000)}
    ranks = rank_within(df, ["g"], ["k"], "n").collect()
    assert all(r.n == r.k // 3 for r in ranks)
    sums = running_start(df, ["k"], "g", "s").collect()
    assert all(r.s == sum(i % 3 for i in range(r.k)) for r in sums)


def test_unknown_label_raises(spark):
    df = spark.createDataFrame([(1, "x")], "id int, label string")
    labels = spark.createDataFrame([("a", 0)], "label string, label_id int")
    with pytest.raises(Exception, match="unknown label"):
        S.attach_label_ids(df, labels).collect()


def test_feature_width_is_checked(spark):
    df = spark.createDataFrame([([1, 2],)], "input_ids array<bigint>")
    assert S.decode_features(df, {"input_ids": 2}).first()[0] == [1, 2]
    with pytest.raises(Exception, match="wrong length"):
        S.decode_features(df, {"input_ids": 3}).collect()


def _texts(spark):
    rows = [(1, "Want unwanted\nrunning,  wa\n\nunwanted want"), (2, None), (3, ""), (4, "\n"), (5, "want un 　wa"), (5, "un")]
    return spark.createDataFrame(rows, "id int, t string")


@pytest.mark.parametrize("by_word", [False, True])
@pytest.mark.parametrize("most", [500_000, 3])
def test_texts_are_encoded_as_their_words_are(spark, small_vocab, by_word, most):
    docs = _texts(spark).filter("t is null or t <> 'un'")
    spaced = X.spaced_text(F.col("t"), keep_lines=not by_word)
    units = docs.select("id", (X.word_units if by_word else X.line_units)(spaced).alias("units"))
    want = W.encode(units, ["id"], "units", small_vocab, with_pieces=True).sort("id").collect()
    got = W.encode_text(docs, ["id"], spaced, small_vocab, with_pieces=True, by_word=by_word, max_broadcast=most)
    assert got.sort("id").collect() == want


def test_texts_cross_to_the_encoder_whole(spark, small_vocab):
    """No array of words is made before the tasks that encode them, and alignment makes no row's list of runs."""
    docs = _texts(spark)
    spaced = X.spaced_text(F.col("t"))
    enc = W.encode_text(docs, ["id"], spaced, small_vocab, by_word=True)
    runs = W.alignment(enc, ["id"])
    plan = runs._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "struct(unit" not in plan
    got = [tuple(r) for r in runs.sort("id", "unit").collect() if r.id == 1]
    assert got == [(1, 0, 0, 1), (1, 1, 1, 3), (1, 2, 4, 2), (1, 3, 6, 1), (1, 4, 7, 1), (1, 5, 8, 3), (1, 6, 11, 1)]


def test_vocabulary_counts_words_where_texts_are_split(spark, monkeypatch):
    from textloom.plans import vocabulary as V

    seen, real = [], V.cut
    monkeypatch.setattr(V, "cut", lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    V.corpus_vocabulary(_texts(spark).withColumnRenamed("t", "text"))
    assert "Generate" not in seen[0] and "MapInArrow" in seen[0]


def test_corpus_is_written_as_columns(spark, small_vocab):
    from textloom.operators import pretrain

    docs = _texts(spark).filter("id <> 5").withColumnRenamed("t", "text").withColumnRenamed("id", "doc_id")
    corpus = pretrain.encode_documents(docs, small_vocab)
    plan = corpus.select("doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "ids" not in plan.split("ReadSchema", 1)[1]
