"""What question windows keep and move: texts made once, questions' best pairs only, paragraphs compressed."""

import pytest
from pyspark.sql import functions as F

from conftest import QA_SCHEMA
from textloom.operators import answers as N
from textloom.operators import packed as K
from textloom.operators import windows as W
from textloom.plans.catalog import windows as CW
from textloom.plans.questions import document_paragraphs

CFG = W.WindowConfig(max_length=12, stride=4, negatives=True)


@pytest.fixture(scope="module")
def vocab(spark):
    tokens = "[PAD] [UNK] [CLS] [SEP] the man went to store and bought a gall ##on of milk ( 18 ##95 ) é ##t".split()
    return spark.createDataFrame([(t, i) for i, t in enumerate(tokens)], "token string, token_id int")


@pytest.fixture(scope="module")
def paragraphs(spark):
    text = "the man\twent to  the store\n(1895) and bought a gallon of milk " * 3
    rows = [
        ("c", text, [("c-0", "the man", False, [("store", text.index("store"))]), ("c-1", "milk", True, [])]),
        ("d", " \n", [("d-0", "the", True, [])]),
        ("e", "the milk", [("e-0", "a of", False, [("milk", 4)]), ("e-1", "to", False, [("lost", 0)])]),
        ("f", None, [("f-0", "the", True, [])]),
    ]
    return spark.createDataFrame(rows, QA_SCHEMA)


def _rows(df, *columns):
    return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=repr)


def test_encoded_paragraphs_hold_the_columns_asked_for(paragraphs, vocab, monkeypatch):
    whole = W.encode_examples(paragraphs, CFG, vocab)
    assert whole.columns[1:] == list(W.ENCODED)
    assert {r.context_id: len(r.asked) for r in whole.collect()} == {"c": 2, "d": 1, "e": 1, "f": 1}
    some = W.encode_examples(paragraphs, CFG, vocab, columns=["asked", "ids"])
    assert some.columns == ["context_id", "ids", "asked"]
    assert _rows(some) == _rows(whole, *some.columns)
    questions = _rows(W.question_pieces(whole), "qas_id", "query_ids", "query_pieces")
    spelled = W.spelled(W.question_pieces(some), vocab, ids="query_ids", pieces="query_pieces", keys=["context_id", "qa_no"])
    assert _rows(spelled, "qas_id", "query_ids", "query_pieces") == questions
    # Texts split in the tasks are encoded as words joined with the vocabulary are.
    rows = _rows(whole)
    monkeypatch.setattr(W, "compiled", lambda *a, **k: None)
    monkeypatch.setattr("textloom.operators.subword.compiled", lambda *a, **k: None)
    assert _rows(W.encode_examples(paragraphs, CFG, vocab)) == rows


def test_paragraphs_of_the_queries_are_not_written(spark):
    files = CW.paragraphs(spark, "/root/testdata/sf0.001").inputFiles()
    assert files and all("documents.parquet" in f for f in files)


def test_question_texts_are_made_once(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, " "), (3, None)], "doc_id long, text string")
    found = W.questions(document_paragraphs(docs), CFG).select("qas_id")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 1
    assert _rows(found) == [("1-0",), ("1-1",)]


def test_a_paragraph_without_questions_is_no_question(spark):
    rows = [("a", "the man", []), ("b", "the man", [("q", "the", False, [("man", 4)])]), ("c", "the", None)]
    found = W.recoverable(W.questions(spark.createDataFrame(rows, QA_SCHEMA), CFG))
    assert _rows(found, "qas_id", "start_word") == [("q", 1)]


def test_packed_columns_come_back(spark):
    df = spark.createDataFrame([(1, "ab\nç", [0, 0, 3, -1]), (2, "", []), (3, None, None)], "k int, t string, u array<int>")
    got = {r.k: (K.unpacked(bytes(r.t)).decode(), K.unpacked_numbers(bytes(r.u)).tolist()) for r in K.packed(df, ["t", "u"]).collect()}
    assert got == {1: ("ab\nç", [0, 0, 3, -1]), 2: ("", []), 3: ("", [])}


def _scored(rows):
    score = lambda k: F.transform(F.sequence(F.lit(0), F.lit(11)), lambda p: (F.col("unique_id") * k + p * 5 % 7).cast("double") % 11)
    return rows.withColumns({"start_logits": score(3), "end_logits": score(2)})


@pytest.mark.parametrize("pack", [False, True])
def test_best_pairs_of_a_question_are_its_first_ones(paragraphs, vocab, pack):
    encoded = W.kept_examples(W.encode_examples(paragraphs, CFG, vocab))
    bare = _scored(W.question_windows(paragraphs, vocab, CFG, lists=()))
    texts = W.paragraph_texts(encoded, paragraphs, vocab, pack=pack)
    cfg = N.AnswerConfig(n_best=6)
    every = [r.asDict() for r in N.candidates(bare, cfg, texts).collect()]
    order = lambda r: (-(r["start_logit"] + r["end_logit"]), r["window_no"], r["start_rank"], r["end_rank"])
    got = {r.qas_id: r for r in N.with_paragraph_texts(N.candidate_pairs(bare, cfg, 4), texts, 3).collect()}
    assert len(got) > 1
    for name in {r["qas_id"] for r in every}:
        own = sorted((r for r in every if r["qas_id"] == name), key=order)
        assert [order(p) for p in got[name].pairs] == [order(r) for r in own[:3]]
        assert [p.original for p in got[name].pairs] == [r["original"] for r in own[:3]]
        assert got[name].more == (len(own) > 3)


@pytest.mark.parametrize("negatives", [False, True])
def test_answers_from_paragraphs_equal_those_from_windows(paragraphs, vocab, negatives, monkeypatch):
    monkeypatch.setattr(N, "OVERHANG", 0)  # so that equal texts make it go on
    whole = _scored(W.question_windows(paragraphs, vocab, CFG))
    bare = _scored(W.question_windows(paragraphs, vocab, CFG, lists=()))
    texts = W.paragraph_texts(W.kept_examples(W.encode_examples(paragraphs, CFG, vocab)), paragraphs, vocab, pack=True)
    cfg = N.AnswerConfig(n_best=9, negatives=negatives)
    examples = W.questions(paragraphs, CFG).select("qas_id")
    plain, read = N.n_best(whole, examples, cfg), N.n_best(bare, examples, cfg, paragraphs=texts)
    assert _rows(plain) == _rows(read) != []
    assert {r.qas_id for r in read.collect()} == {"c-0", "c-1", "d-0", "e-0", "e-1", "f-0"}


def test_null_scores_sort_no_arrays(paragraphs, vocab):
    bare = _scored(W.question_windows(paragraphs, vocab, CFG, lists=()))
    node = N.null_scores(bare)._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Aggregate":
        node = node.children().head()
    sorted_ = node.children().head().output()
    assert [sorted_.apply(k).name() for k in range(sorted_.size())] == ["qas_id", "pair"]
    assert _rows(N.null_scores(bare)) != []
