import random

import pytest
from pyspark.sql import functions as F

from conftest import QA_SCHEMA
from textloom.operators import answers as N
from textloom.operators import question_rows as R
from textloom.operators import windows as W

ROWS = [
    (
        "c1",
        "The leader was John Smith (1895-1943).",
        [("q1", "when was john smith?", False, [("1895", 27)]), ("q2", "the man?", True, [])],
    ),
    ("c2", "the man went to the store and bought a gallon of milk", [("q3", "the", False, [("bought a", 30)])]),
    ("c3", "", [("q4", "the", True, [])]),
    ("c4", "the Japanese industry", [("q5", "the", False, [("Japan", 4)])]),
    ("c5", "the  man", [("q6", "the", False, [("nowhere", 5)])]),
]


@pytest.fixture(scope="module")
def paragraphs(spark):
    return spark.createDataFrame(ROWS, QA_SCHEMA)


def _windows(paragraphs, vocab, **kw):
    cfg = W.WindowConfig(**{"max_length": 9, "stride": 3, "negatives": True, **kw})
    built = W.with_token_maps(W.question_windows(paragraphs, vocab, cfg))
    rows = built.orderBy("unique_id").collect()
    out = {}
    for r in rows:
        out.setdefault(r.qas_id, []).append(r)
    return rows, out


def test_windows(paragraphs, qa_vocab):
    rows, by = _windows(paragraphs, qa_vocab, max_query=1)
    assert [r.unique_id for r in rows] == list(range(1_000_000_000, 1_000_000_000 + len(rows)))
    # The empty context gives no window, the unrecoverable answer no row.
    assert set(by) == {"q1", "q2", "q3", "q5"}
    third = by["q3"][2]
    assert third.tokens == "[CLS] the [SEP] and bought a gallon of [SEP]".split()
    assert (third.start_position, third.end_position) == (4, 5)
    assert [r.start_position for r in by["q3"]] == [0, 0, 4, 0]
    bought = [r.token_is_best[p] for r in by["q3"] for p, w in r.token_to_word.items() if w == 7]
    assert bought == [False, True]
    assert all(r.start_position == 0 and r.end_position == 0 for r in by["q2"])


def test_answer_inside_a_hyphenated_word(paragraphs, qa_vocab):
    _, by = _windows(paragraphs, qa_vocab, max_length=40, max_query=5)
    (row,) = by["q1"]
    assert row.tokens[row.start_position : row.end_position + 1] == ["1895"]


def test_answer_inside_a_longer_word_keeps_the_word(paragraphs, qa_vocab):
    _, by = _windows(paragraphs, qa_vocab, max_length=40)
    (row,) = by["q5"]
    assert row.tokens[row.start_position : row.end_position + 1] == ["japanese"]


def test_training_needs_one_answer(spark):
    bad = spark.createDataFrame([("c", "the man", [("q", "the", False, [])])], QA_SCHEMA)
    with pytest.raises(Exception, match="exactly one answer"):
        W.questions(bad, W.WindowConfig()).collect()


def test_prediction_needs_no_answers(spark, qa_vocab):
    df = spark.createDataFrame([("c", "the man went", [("q", "the", None, None)])], QA_SCHEMA)
    row = W.question_windows(df, qa_vocab, W.WindowConfig(max_length=9), training=False).first()
    assert row.tokens == ["[CLS]", "the", "[SEP]", "the", "man", "went", "[SEP]"]
    assert "start_position" not in row.asDict()


def test_window_shapes_equal_the_loop(spark):
    def spec(n, room, stride):
        out, start = [], 0
        while start < n:
            length = min(n - start, room)
            out.append((start, length))
            if start + length == n:
                break
            start += min(length, stride)
        return out

    def best(spans, p):
        scores = [
            (100 * min(p - s, s + length - 1 - p) + length, -k)
            for k, (s, length) in enumerate(spans)
            if s <= p < s + length
        ]
        return -max(scores)[1]

    for n in range(0, 60, 3):
        for room in range(1, 20, 2):
            for stride in (1, 2, 5, 9, 30):
                expected, step = spec(n, room, stride), min(room, stride)
                count = R.window_count(n, room, stride)
                assert expected == [(k * step, min(room, n - k * step)) for k in range(count)]
                bounds = [R.best_from(k, n, room, step, count) for k in range(count + 1)]
                for k, (first, length) in enumerate(expected):
                    for p in range(first, first + length):
                        assert (bounds[k] <= p < bounds[k + 1]) == (best(expected, p) == k)


def test_first_occurrence_equals_slicing():
    rng = random.Random(4)
    for _ in range(2000):
        values = [rng.randint(0, 2) for _ in range(rng.randint(0, 12))]
        wanted = [rng.randint(0, 2) for _ in range(rng.randint(0, 4))]
        hits = [k for k in range(len(values)) if values[k : k + len(wanted)] == wanted]
        assert R.first_occurrence(values, wanted) == (hits[0] if hits and wanted else -1)


@pytest.mark.parametrize("negatives", [True, False])
def test_places_in_the_row_equal_the_question_table(spark, qa_vocab, negatives):
    """Word places and kept questions are those of the column expressions."""
    rng = random.Random(8)
    words = "the man, went to (store) bought  Japanese\ta 1895-1943 \u202f smith's".split(" ")
    rows = []
    for c in range(60):
        context = " ".join(rng.choice(words) for _ in range(rng.randint(0, 25)))
        qas = []
        for q in range(rng.randint(0, 5)):
            at = rng.randint(0, max(len(context) - 1, 0))
            text = context[at : at + rng.randint(1, 20)] if rng.random() < 0.8 else rng.choice(words)
            qas.append((f"{c}-{q}", rng.choice(words), negatives and rng.random() < 0.3, [(text or "x", at)]))
        rows.append((f"c{c}", context, qas))
    paragraphs = spark.createDataFrame(rows, QA_SCHEMA)
    cfg = W.WindowConfig(max_length=12, stride=4, negatives=negatives)
    table = W.recoverable(W.questions(paragraphs, cfg))
    want = {r.qas_id: (r.context_id, r.qa_no, r.is_impossible, r.start_word, r.end_word) for r in table.collect()}
    found = W.question_pieces(W.encode_examples(paragraphs, cfg, qa_vocab)).collect()
    assert {r.qas_id: (r.context_id, r.qa_no, r.is_impossible, r.start_word, r.end_word) for r in found} == want


def test_vocabulary_beyond_the_bound(spark, paragraphs, qa_vocab, monkeypatch):
    """The same windows whether the vocabulary is broadcast or joined."""
    cfg = W.WindowConfig(max_length=9, stride=3, negatives=True)
    rows = lambda: sorted(map(tuple, W.question_windows(paragraphs, qa_vocab, cfg).collect()), key=repr)
    small = rows()
    monkeypatch.setattr(W, "compiled", lambda *a, **k: None)
    monkeypatch.setattr("textloom.operators.subword.compiled", lambda *a, **k: None)
    assert rows() == small


def _spec_project(pred, orig, tokens):
    tok = " ".join(tokens)
    start = tok.find(pred)
    if start == -1 or not pred:
        return orig
    places = [i for i, c in enumerate(orig) if c != " "]
    if len(places) != len(tok.replace(" ", "")):
        return orig
    rank = [len(tok[: i + 1].replace(" ", "")) - 1 for i in (start, start + len(pred) - 1)]
    return orig[places[rank[0]] : places[rank[1]] + 1]


def test_project_answer(spark):
    cases = [
        ("steve smith", "Steve Smith's", "Steve Smith"),
        ("heros", "Héros, x", "Héros"),
        ("zz", "Steve Smith's", "Steve Smith's"),
        ("ab", "a b", "a b"),
        ("", "a b", "a b"),
        ("1895", "(1895-1943).", "1895"),
    ]
    df = spark.createDataFrame(cases, "p string, o string, want string")
    for r in df.select("*", N.project_answer(F.col("p"), F.col("o")).alias("got")).collect():
        assert r.got == r.want


def _brute_n_best(windows, scores, cfg):
    """Plain loops over one question's windows."""
    pool = []
    for w in windows:
        s, e = scores[w["window_no"]]
        best = lambda x: sorted(range(len(x)), key=lambda i: -x[i])[: cfg.n_best]
        for i in best(s):
            for j in best(e):
                if not w["token_is_best"].get(i, False) or j not in w["token_to_word"]:
                    continue
                if j < i or j - i + 1 > cfg.max_answer:
                    continue
                pool.append((s[i] + e[j], w, i, j))
    pool.sort(key=lambda x: -x[0])
    seen, out = set(), []
    for total, w, i, j in pool:
        if len(out) >= cfg.n_best:
            break
        pred = " ".join(w["tokens"][i : j + 1]).replace(" ##", "").replace("##", "")
        words = w["words"][w["token_to_word"][i] - w["first_word"] : w["token_to_word"][j] - w["first_word"] + 1]
        text = _spec_project(pred, " ".join(words), " ".join(words).lower().replace("(", "( ").split())
        if text not in seen:
            seen.add(text)
            out.append((text, round(total, 6)))
    return out


def test_n_best_equals_plain_loops(spark, qa_vocab):
    rng = random.Random(7)
    rows = [("c", "the man went to the store and bought a gallon of milk " * 3, [("q", "the", False, [("the", 0)])])]
    paragraphs = spark.createDataFrame(rows, QA_SCHEMA)
    windows = W.with_token_maps(
        W.question_windows(paragraphs, qa_vocab, W.WindowConfig(max_length=12, stride=4))
    ).cache()
    ids = [(r.unique_id, r.window_no) for r in windows.select("unique_id", "window_no").collect()]
    scores = {k: ([rng.randint(0, 9) / 2 for _ in range(12)], [rng.randint(0, 9) / 2 for _ in range(12)]) for _, k in ids}
    table = spark.createDataFrame(
        [(u, *scores[k]) for u, k in ids], "unique_id long, start_logits array<double>, end_logits array<double>"
    )
    cfg = N.AnswerConfig(n_best=5, max_answer=4)
    ranked = N.n_best(windows.join(table, "unique_id"), windows.select("qas_id").distinct(), cfg)
    got = [(r.text, round(r.start_logit + r.end_logit, 6)) for r in ranked.orderBy("rank").collect()]
    plain = [r.asDict() for r in windows.orderBy("window_no").collect()]
    assert got == _brute_n_best(plain, scores, cfg)
    assert abs(sum(r.probability for r in ranked.collect()) - 1) < 1e-9


def test_question_without_candidates(spark, qa_vocab):
    df = spark.createDataFrame([("c", "the man", [("q", "the", False, [("the", 0)])])], QA_SCHEMA)
    windows = W.question_windows(df, qa_vocab, W.WindowConfig(max_length=8))
    flat = F.array_repeat(F.lit(0.0), 8)
    # All weight on the question side, so no span is valid.
    high = F.array(*[F.lit(9.0 if i < 2 else 0.0) for i in range(8)])
    scored = windows.withColumn("start_logits", high).withColumn("end_logits", flat)
    cfg = N.AnswerConfig(n_best=2)
    plain = N.n_best(scored, windows.select("qas_id"), cfg).collect()
    assert [(r.text, r.probability) for r in plain] == [("empty", 1.0)]
    neg = N.AnswerConfig(n_best=2, negatives=True)
    ranked = N.n_best(scored, windows.select("qas_id"), neg)
    assert [r.text for r in ranked.collect()] == [""]
    final = N.predictions(ranked, N.null_scores(scored)).first()
    assert final.text == "" and final.score_diff is None


def test_windows_with_some_arrays_equal_whole_ones(paragraphs, qa_vocab):
    cfg = W.WindowConfig(max_length=9, stride=3, negatives=True)
    whole = W.question_windows(paragraphs, qa_vocab, cfg)
    for lists in [(), ("input_ids", "segment_ids"), ("words", "tokens"), ("token_words", "input_mask")]:
        some = W.question_windows(paragraphs, qa_vocab, cfg, lists=lists)
        assert set(some.columns) == set(whole.columns) - (set(W.LISTS) - set(lists))
        rows = lambda df: df.select(*some.columns).orderBy("unique_id").collect()
        assert rows(some) == rows(whole)


def test_answers_read_in_paragraphs_equal_those_read_in_windows(paragraphs, qa_vocab):
    cfg = W.WindowConfig(max_length=9, stride=3, negatives=True)
    score = lambda k: F.transform(F.sequence(F.lit(0), F.lit(8)), lambda p: (F.col("unique_id") * k + p * 5 % 7).cast("double") % 11)
    scored = lambda rows: rows.withColumns({"start_logits": score(3), "end_logits": score(2)})
    encoded = W.encode_examples(paragraphs, cfg, qa_vocab)
    whole = scored(W.question_windows(paragraphs, qa_vocab, cfg))
    bare = scored(W.question_windows(paragraphs, qa_vocab, cfg, lists=()))
    plain = N.AnswerConfig(n_best=3)
    texts = N.candidates(whole, plain)
    read = N.candidates(bare, plain, encoded).select(*texts.columns)
    assert sorted(map(tuple, texts.collect())) == sorted(map(tuple, read.collect())) != []


def test_kept_examples_hold_no_texts_and_give_them_again(paragraphs, qa_vocab, monkeypatch):
    encoded = W.encode_examples(paragraphs, W.WindowConfig(max_length=9, stride=3, negatives=True), qa_vocab)
    kept = W.kept_examples(encoded)
    assert not {"words", "pieces"} & set(kept.columns)
    rows = lambda df: sorted(map(tuple, df.select("context_id", "pieces", "piece_units").collect()))
    assert rows(W.spelled(kept, qa_vocab)) == rows(encoded)
    lines = W.paragraph_texts(kept, paragraphs, qa_vocab)
    whole = encoded.withColumns({c: F.array_join(c, "\n") for c in ("words", "pieces")})
    same = lambda df: sorted(map(tuple, df.select("context_id", "words", "pieces", "piece_units").collect()))
    assert same(lines) == same(whole)
    # A vocabulary beyond the checked size is joined.
    monkeypatch.setattr(W, "compiled", lambda *args, **kw: None)
    assert rows(W.spelled(kept, qa_vocab)) == rows(encoded)


def test_paragraphs_stay_where_they_are_for_windows_without_arrays(paragraphs, qa_vocab, monkeypatch):
    monkeypatch.setattr(W, "broadcast_if_small", lambda df: df.hint("merge"))
    cfg = W.WindowConfig(max_length=9, stride=3, negatives=True)
    bare = W.question_windows(paragraphs, qa_vocab, cfg, lists=())
    plan = bare._jdf.queryExecution().executedPlan().toString()
    moved = plan.split("Exchange hashpartitioning")[1:]
    assert len(moved) == 2 and not any("piece_units" in part.split("\n")[0] for part in moved)
    # Cut first and numbered after: the shuffle's rows come from the windows, not from the paragraphs.
    assert plan.index("Exchange hashpartitioning") < plan.index("MapInArrow")


def test_pairs_move_without_the_columns_a_reader_leaves_out(paragraphs, qa_vocab):
    cfg = W.WindowConfig(max_length=9, stride=3, negatives=True)
    score = F.transform(F.sequence(F.lit(0), F.lit(8)), lambda p: (p * 5 % 7).cast("double"))
    bare = W.question_windows(paragraphs, qa_vocab, cfg, lists=()).withColumns({"start_logits": score, "end_logits": score})
    texts = W.encode_examples(paragraphs, cfg, qa_vocab)
    whole = N.candidates(bare, N.AnswerConfig(), texts)
    some = N.candidates(bare, N.AnswerConfig(), texts, without=["start_rank", "end_logit"])
    assert set(some.columns) == set(whole.columns) - {"start_rank", "end_logit"}
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.select(*some.columns).collect())) != []
