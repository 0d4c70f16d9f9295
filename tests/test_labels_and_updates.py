import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import text as X
from textloom.operators import labels as L
from textloom.operators import scoring as R
from textloom.operators import upserts as U
from textloom.operators.order import dense_index
from textloom.streaming import changes as C


def test_balancing_with_a_hot_label(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 900, "hot").when(F.col("id") < 990, "mid").otherwise("rare").alias("y"))
    down = {r.y: r["count"] for r in L.balance_down(df, "y", ["id"]).groupBy("y").count().collect()}
    assert down == {"hot": 10, "mid": 10, "rare": 10}
    picked = L.balance_to(df, "y", ["id"], 50)
    assert {r.y: r["count"] for r in picked.groupBy("y").count().collect()} == {"hot": 50, "mid": 50, "rare": 50}
    assert picked.select("y", "draw_no").distinct().count() == 150


def test_top_labels_break_ties_by_name(spark):
    df = spark.createDataFrame([("t", x) for x in "bbaacd"], "tag string, label string")
    rows = L.top_labels(df, 3).orderBy("label_id").collect()
    assert [(r.label, r.n) for r in rows] == [("a", 2), ("b", 2), ("c", 1)]


def test_split_rounds_half_to_even(spark):
    df = spark.range(10).select("id", F.lit("g").alias("g"))
    split = L.positional_split(df, ["g"], ["id"], 0.25).filter("split = 'train'").collect()
    assert sorted(r.id for r in split) == [0, 1]


def test_batches(spark):
    df = spark.range(10)
    assert L.batches(df, ["id"], 4).select("batch_no").distinct().count() == 3
    assert L.batches(df, ["id"], 4, drop_last=True).count() == 8


def test_shuffle_keeps_all_rows(spark):
    rows = [r.id for r in L.shuffled(spark.range(50), ["id"]).collect()]
    assert sorted(rows) == list(range(50)) and rows != list(range(50))


def test_has_text(spark):
    df = spark.createDataFrame([(1, ["a"]), (2, [""]), (3, None)], "id int, text array<string>")
    assert sorted(r.id for r in L.has_text(df).collect()) == [1, 3]
    plain = spark.createDataFrame([(1, "a"), (2, ""), (3, None)], "id int, text string")
    assert sorted(r.id for r in L.has_text(plain).collect()) == [1, 3]


LOG = [
    ("feedback", "u1", None, None, "early", 1, 0),
    ("infer", "u1", "p1", "r1", None, 2, 1),
    ("feedback", "u1", None, None, "gold", 3, 2),
    ("infer", "u2", "p", "r", None, 2, 3),
    ("feedback", "u2", None, None, "lost", 3, 4),
    ("infer", "u2", "p2", "r2", None, 4, 5),
    ("feedback", "u3", None, None, "unknown key", 5, 6),
]
SCHEMA = "kind string, url string, payload string, recommendation string, golden_standard string, ts long, seq long"
WANT = {("u1", "p1", "gold", 3), ("u2", "p2", None, 4)}


def test_replay(spark):
    rows = U.current_records(spark.createDataFrame(LOG, SCHEMA)).collect()
    assert {(r.url, r.payload, r.golden_standard, r.ts) for r in rows} == WANT
    assert all(len(r["_id"]) == 32 for r in rows)


def test_streamed_log_gives_the_same_records(spark, tmp_path):
    source = str(tmp_path / "in")
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    for part in (LOG[:4], LOG[4:]):
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(source)
        C.append_changes(stream, str(tmp_path / "log"), str(tmp_path / "cp")).awaitTermination()
    rows = C.read_records(spark, str(tmp_path / "log")).collect()
    assert {(r.url, r.payload, r.golden_standard, r.ts) for r in rows} == WANT


def test_streamed_text_steps(spark, tmp_path, small_vocab):
    from textloom.operators.subword import encode

    source = str(tmp_path / "in")
    spark.createDataFrame([(1, "Héllo, un"), (2, "unwanted")], "id int, t string").write.parquet(source)
    stream = spark.readStream.schema("id int, t string").parquet(source)
    step = lambda df: df.select("id", X.basic_tokens(F.col("t")).alias("w"))
    C.transform_stream(stream, step, str(tmp_path / "o"), str(tmp_path / "c1")).awaitTermination()
    assert {tuple(r.w) for r in spark.read.parquet(str(tmp_path / "o")).collect()} == {("hello", ",", "un"), ("unwanted",)}

    def batch(df):
        units = df.select("id", X.unit_tokens(F.col("t")).alias("units"))
        return encode(units, ["id"], "units", small_vocab)

    C.encode_stream(stream, batch, str(tmp_path / "e"), str(tmp_path / "c2")).awaitTermination()
    got = {r.id: r.ids for r in spark.read.parquet(str(tmp_path / "e")).collect()}
    assert got == {1: [0, 10, 7], 2: [7, 4, 5]}


def test_scorer_hook(spark):
    df = spark.range(100).select("id", F.array(F.col("id").cast("double"), F.lit(1.0)).alias("x"), F.lit("unused").alias("z"))
    out = T.StructType([T.StructField("s", T.DoubleType())])

    def scorer(frame: pd.DataFrame) -> pd.DataFrame:
        assert len(frame) <= 8 and list(frame.columns) == ["x"]
        return pd.DataFrame({"s": [float(v.sum()) for v in frame["x"]]})

    rows = R.score(df, ["id"], ["x"], scorer, out, batch_size=8)
    assert {r.id: r.s for r in rows.collect()} == {i: i + 1.0 for i in range(100)}
    assert R.unscored(df, rows, "id").count() == 0


def test_masked_metrics_over_nothing(spark):
    slots = spark.createDataFrame([(1, 1, 0.0, 2.0)], "prediction int, label int, weight double, loss double")
    row = R.masked_metrics(slots).first()
    assert (row.masked_lm_accuracy, row.masked_lm_loss, row.training_loss) == (0.0, 0.0, 0.0)


def test_numbers_do_not_depend_on_partitions(spark):
    df = spark.range(200).select((F.col("id") * 7919 % 200).alias("k"))
    for parts in (1, 4, 16):
        rows = dense_index(df.repartition(parts), ["k"], "n").collect()
        assert all(r.n == r.k for r in rows)
