import json

import pytest
from pyspark.sql import functions as F

from textloom.operators import scoring as R
from textloom.plans.datasets import review_dataset, tagged_dataset, tweet_dataset
from textloom.sources import layouts as Y
from textloom.sources import readers as S
from textloom.sources import sinks as K


def test_corpus_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n\nthree\n \nfour\n\n\n\n")
    (tmp_path / "b.txt").write_text("\n\nfive\n")
    rows = S.read_corpus(spark, f"{tmp_path}/a.txt, {tmp_path}/b*").orderBy("doc_id").collect()
    lines = [[x for x in r.text.split("\n") if x.strip()] for r in rows]
    assert lines == [["one", "two"], ["three"], ["four"], ["five"]]
    assert len({r.doc_id for r in rows}) == 4


def test_split_reads_keep_documents_whole(spark, tmp_path):
    docs = [[f"d{d} s{s}" for s in range(1 + d % 4)] for d in range(300)]
    (tmp_path / "c.txt").write_text("\n\n".join("\n".join(d) for d in docs) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        rows = S.read_corpus(spark, str(tmp_path / "c.txt")).collect()
        lines = S.read_lines(spark, str(tmp_path / "c.txt")).orderBy("line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r.text.strip() for r in rows) == sorted("\n".join(d) for d in docs)
    assert [r.value for r in lines] == (tmp_path / "c.txt").read_text().split("\n")[:-1]
    assert [r.line_no for r in lines] == list(range(len(lines)))


def test_vocab_file(spark, tmp_path):
    (tmp_path / "v.txt").write_text("a\n b \n\na\nc\n")
    got = {r.token: r.token_id for r in S.read_vocab(spark, str(tmp_path / "v.txt")).collect()}
    assert got == {"a": 3, "b": 1, "": 2, "c": 4}


def test_pairs(spark, tmp_path):
    (tmp_path / "p.txt").write_text("x ||| y\n\n a ||| b ||| c \nplain\n")
    rows = S.read_pairs(spark, str(tmp_path / "p.txt")).orderBy("unique_id").collect()
    assert [(r.unique_id, r.text_a, r.text_b) for r in rows] == [
        (0, "x", "y"), (1, "", None), (2, "a ||| b", "c"), (3, "plain", None)
    ]


def test_tsv_keeps_quotes(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('h1\th2\n"a\tb"c\n')
    row = S.read_tsv(spark, str(tmp_path / "t.tsv"), ["x", "y"], header=True).first()
    assert (row.x, row.y) == ('"a', 'b"c')


def test_layouts(spark, tmp_path):
    def examples(name, split, text):
        path = tmp_path / f"{name}_{split}.tsv"
        path.write_text(text)
        rows = Y.read_examples(spark, name, split, str(path)).collect()
        return sorted((r.guid, r.text_a, r.text_b, r.label) for r in rows)

    wide = "\t".join(["7", *"abcdefg", "A", "B", "x", "neutral"])
    assert examples("multi_genre", "train", "head\n" + wide + "\n") == [("train-7", "A", "B", "neutral")]
    assert examples("multi_genre", "test", "head\n" + wide + "\n") == [("test-7", "A", "B", "contradiction")]
    assert examples("paraphrase", "dev", "h\n1\ti\tj\tA\tB\n") == [("dev-1", "A", "B", "1")]
    assert examples("acceptability", "train", "s\t1\t\tA\n") == [("train-0", "A", None, "1")]
    assert examples("acceptability", "test", "h\th\n0\tA\n") == [("test-1", "A", None, "0")]
    assert examples("cross_lingual", "train", "h\nA\tB\tcontradictory\n") == [("train-1", "A", "B", "contradiction")]
    dev = "\t".join(["zh", "neutral", *"wxyz", "A", "B"]) + "\n" + "\t".join(["en", "neutral", *"wxyz", "C", "D"])
    assert examples("cross_lingual", "dev", "h\n" + dev + "\n") == [("dev-1", "A", "B", "neutral")]
    assert examples("comma_questions", "train", "h\n1,A,0\n2,a,b,1\n\n3,B,1\n") == [
        ("train-1", "A", None, "0"), ("train-4", "B", None, "1")
    ]
    many = "h\n" + "".join(f"{k},t{k},{k % 2}\n" for k in range(50_000))
    assert len(examples("comma_questions", "dev", many)) == 50_000
    path = str(tmp_path / "comma_questions_dev.tsv")
    part = Y.read_examples(spark, "comma_questions", "dev", path, lines=(30_002, 34_999))
    assert part.count() == 4_998 and part.filter("guid = 'dev-30002'").count() == 1
    sizes = [Y.read_comma(spark, path, "dev", share=s).count() for s in ((0, 0.8), (0.8, 1))]
    assert sum(sizes) == 50_000 and 9_000 < sizes[1] < 11_000
    with pytest.raises(ValueError, match="unknown dataset"):
        Y.spec("nope")
    assert [r.label for r in Y.labels_of(spark, "tweets").orderBy("label_id").collect()] == ["0", "4"]


def test_records_keep_the_first_test_row(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps([{"inputs": "a", "label": 1}, {"text": "b", "label": 0}]))
    rows = Y.read_examples(spark, "reviews", "test", str(tmp_path / "r.json")).collect()
    assert sorted((r.guid, r.text_a, r.label) for r in rows) == [("test-0", "a", "1"), ("test-1", "b", "0")]


def test_question_files(spark, tmp_path):
    par = {"context": "the man", "qas": [{"id": "q", "question": "who", "answers": [{"text": "man", "answer_start": 4}]}]}
    (tmp_path / "q.json").write_text(json.dumps({"data": [{"paragraphs": [par, par]}]}, indent=1))
    rows = S.read_questions(spark, str(tmp_path / "q.json")).collect()
    assert len({r.context_id for r in rows}) == 2 and rows[0].qas[0].answers[0].answer_start == 4


def test_tweets_and_reviews(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes('"0","1","d","q","u","Caf\xe9 @me http://x it\'\'s #1 ok!"\n"2","1","d","q","u","n"\n'.encode("latin-1"))
    tweets = S.read_tweets(spark, str(tmp_path / "t.csv"))
    rows = tweet_dataset(tweets.withColumn("id", F.lit(1)), ["id"]).collect()
    assert [(r.inputs, r.label) for r in rows] == [("café it ' ' s ok ", 0)]
    for side, text in (("pos", " Good.<br />Fine BR \n"), ("neg", "Bad. Worse")):
        (tmp_path / side).mkdir()
        (tmp_path / side / "0.txt").write_text(text)
    rows = review_dataset(S.read_reviews(spark, str(tmp_path)), ["path"]).collect()
    assert sorted((r.label, " ".join(r.inputs.split())) for r in rows) == [(0, "bad worse"), (1, "good fine br")]


def test_tagged_documents(spark, tmp_path):
    docs = [{"text": [f"One {i}.\tTwo\r\n café"], "a": ["x  y", "z"] if i % 3 else ["x y"], "b": None} for i in range(9)]
    docs += [{"text": [""], "a": ["x y"]}, {"a": ["x y"]}, {"text": ["t"], "b": ["only"]}]
    (tmp_path / "d.json").write_text("\n".join(json.dumps(d) for d in docs))
    df = S.read_tagged(spark, str(tmp_path / "d.json"), ["a", "b"]).withColumn("doc_id", F.monotonically_increasing_id())
    rows, labels = tagged_dataset(df, ["a", "b"], n_labels=1, keep_other=True)
    got = rows.collect()
    assert {(r.tag, r.label, r.label_id) for r in got} == {("a", "x_y", 0), ("a", "other_remainder", 1), ("b", "only", 0)}
    assert {(r.tag, r.label) for r in labels.collect()} == {("a", "x_y"), ("a", "other_remainder"), ("b", "only")}
    assert {r.inputs for r in got if r.tag == "a"} == {f"One {i}. Two caf" for i in range(9)}
    assert sum(r.split == "train" for r in got if r.tag == "a") == round(0.85 * 15)
    K.write_dataset(rows, labels, str(tmp_path / "out"), ["doc_id"], dev_share=0.5)
    back = spark.read.json(str(tmp_path / "out" / "records"))
    assert {r.split for r in back.collect()} == {"train", "test", "dev"}
    assert back.count() == len(got)
    assert back.filter("split = 'test'").count() == sum(r.split == "test" for r in got)


def test_feature_round_trip(spark, tmp_path):
    df = spark.range(20).select("id", F.array_repeat(F.col("id"), 3).alias("input_ids"))
    assert K.write_shards(df, str(tmp_path / "f"), 4) == 20
    rows = S.read_features(spark, str(tmp_path / "f"), {"input_ids": 3}, ["id"])
    assert rows.schema["input_ids"].dataType.simpleString() == "array<int>" and rows.count() == 20
    assert len(list((tmp_path / "f").glob("part-*"))) == 4


def test_reports(spark, tmp_path):
    metrics = spark.createDataFrame([(0.5, 2)], "loss double, accuracy long")
    K.write_metrics(R.metric_lines(metrics), str(tmp_path / "m"))
    assert [r.value for r in spark.read.text(str(tmp_path / "m")).collect()] == ["accuracy = 2", "loss = 0.5"]
    probs = spark.createDataFrame([(7, [0.25, 0.75])], "k int, p array<double>")
    K.write_probabilities(probs, ["k"], "p", 2, str(tmp_path / "p"))
    assert spark.read.text(str(tmp_path / "p")).first()[0] == "7\t0.25\t0.75"
    best = spark.createDataFrame([("q", 1, "t")], "qas_id string, rank int, text string")
    K.write_answers(best.select("qas_id", "text"), best, str(tmp_path / "a"), best.select("qas_id", F.lit(1.0).alias("score_diff")))
    assert spark.read.json(str(tmp_path / "a" / "null_odds")).first().score_diff == 1.0


def test_line_ends_and_stable_document_ids(spark, tmp_path):
    (tmp_path / "w.txt").write_bytes(b"one\r\ntwo\r\n\r\nthree\r\n \t\r\nfour\r\n")
    rows = S.read_corpus(spark, str(tmp_path / "w.txt")).orderBy("doc_id").collect()
    assert [r.text for r in rows] == ["one\ntwo", "three", "four"]
    for name in "ab":
        (tmp_path / f"{name}.txt").write_text("\n\n".join(f"{name}{k} x\ny" for k in range(200)))
        (tmp_path / f"{name}.json").write_text("\n".join(json.dumps({"inputs": f"{name}{k}", "label": k}) for k in range(200)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    seen = []
    try:
        for size in ("400", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            docs = S.read_corpus(spark, f"{tmp_path}/a.txt,{tmp_path}/b.txt").collect()
            guids = Y.read_record_examples(spark, [str(tmp_path / f"{n}.json") for n in "ab"], "train").collect()
            seen.append((sorted((r.doc_id, r.text) for r in docs), sorted((r.guid, r.text_a) for r in guids)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert seen[0] == seen[1] and len(seen[0][0]) == 400


def test_label_file_and_hashed_instances(spark, tmp_path):
    (tmp_path / "labels.txt").write_text("b\n a \n\nc\n")
    rows = Y.labels_of(spark, "tagged", str(tmp_path / "labels.txt")).collect()
    assert {r.label: r.label_id for r in rows} == {"b": 0, "a": 1, "c": 2}
    with pytest.raises(ValueError, match="label file"):
        Y.labels_of(spark, "tagged")
    df = spark.range(1000).select((F.col("id") / 10).cast("int").alias("doc"), "id")
    assert K.write_shards(df, str(tmp_path / "s"), 4, keys=["doc", "id"]) == 1000
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(r.id for r in back.collect()) == list(range(1000))
    first = [r.doc for r in spark.read.parquet(str(sorted((tmp_path / "s").glob("part-*"))[0])).collect()]
    assert sum(a == b for a, b in zip(first, first[1:])) < len(first) / 5
