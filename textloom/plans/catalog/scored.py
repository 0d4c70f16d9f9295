"""Score tables: `embeddings` stand in for logits of a classifier."""

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import arrays as A
from textloom.operators import scoring as R
from textloom.plans.catalog.registry import query, table
from textloom.sources.sinks import probability_columns


def logits(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x"), "label"
    )


X = """v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda e: e::DOUBLE) AS x FROM embeddings),
n AS MATERIALIZED (
  SELECT vec_id, label, x, list_max(x) AS m, list_position(x, list_max(x)) - 1 AS pred FROM v),
z AS MATERIALIZED (
  SELECT *, list_sum(list_transform(x, lambda e: exp(e - m))) AS t,
    m + ln(list_sum(list_transform(x, lambda e: exp(e - m)))) - x[label + 1] AS loss FROM n)"""


@query("top7_argmax", "WITH " + X + " SELECT vec_id, pred::BIGINT AS pred FROM n")
def argmax(spark, sf):
    return logits(spark, sf).select("vec_id", A.argmax(F.col("x")).alias("pred"))


@query(
    "scr2_softmax",
    "WITH " + X + """ SELECT vec_id, i::BIGINT AS i, round(exp(e - m) / t, 6) AS p FROM (
 SELECT vec_id, m, t, unnest(x) AS e, generate_subscripts(x, 1) - 1 AS i FROM z)""",
)
def softmax(spark, sf):
    return logits(spark, sf).select("vec_id", F.posexplode(A.softmax(F.col("x"))).alias("i", "p"))


@query(
    "scr3_cross_entropy",
    "WITH " + X + " SELECT vec_id, round(loss, 6) AS loss, round(x[1] - m - ln(t), 6) AS first FROM z",
)
def cross_entropy(spark, sf):
    rows = logits(spark, sf)
    return rows.select(
        "vec_id",
        A.cross_entropy(F.col("x"), F.col("label")).alias("loss"),
        F.get(A.log_softmax(F.col("x")), F.lit(0)).alias("first"),
    )


@query(
    "agg11_softmax_normaliser",
    "WITH " + X + " SELECT vec_id, round(m, 6) AS top, round(m + ln(t), 6) AS norm FROM z",
)
def normaliser(spark, sf):
    return logits(spark, sf).select(
        "vec_id", F.array_max("x").alias("top"), A.log_sum_exp(F.col("x")).alias("norm")
    )


@query(
    "scr4_gather",
    "WITH " + X + " SELECT vec_id, round(x[label + 1], 6) AS a, round(x[label + 11], 6) AS b FROM v",
)
def gather(spark, sf):
    picked = A.gather(F.col("x"), F.array(F.col("label"), F.col("label") + 10))
    rows = logits(spark, sf).select("vec_id", picked.alias("g"))
    return rows.select("vec_id", F.get("g", F.lit(0)).alias("a"), F.get("g", F.lit(1)).alias("b"))


def _layers():
    """Four layers of four tokens with four values each."""
    cut = [F.slice("x", 16 * layer + 4 * token + 1, 4) for layer in range(4) for token in range(4)]
    return F.array(*[F.array(*cut[4 * i : 4 * i + 4]) for i in range(4)])


_VECTORS = """WITH c AS (
  SELECT vec_id, t, l, j, embedding[16 * (4 + l) + 4 * t + j + 1]::DOUBLE AS v
  FROM embeddings, (SELECT unnest(range(0, 4)) AS t), (SELECT unnest([-1, -2]) AS l), (SELECT unnest(range(0, 4)) AS j))
SELECT vec_id AS linex_index, t AS token_no, l::BIGINT AS layer, j AS i, round(v, 6) AS v FROM c"""


def vectors(spark, sf):
    rows = logits(spark, sf).withColumn("layers", _layers()).withColumn(
        "tokens", F.array(*[F.lit(f"t{i}") for i in range(4)])
    )
    return R.vector_records(rows, "vec_id", "tokens", "layers", [-1, -2])


@query("scr5_layer_vectors", _VECTORS)
def layer_vectors(spark, sf):
    return (
        vectors(spark, sf)
        .select("linex_index", F.posexplode("features").alias("token_no", "f"))
        .select("linex_index", "token_no", F.explode("f.layers").alias("l"))
        .select("linex_index", "token_no", F.col("l.index").alias("layer"), F.posexplode("l.values").alias("i", "v"))
    )


@query("snk4_vector_json", _VECTORS)
def vector_json(spark, sf):
    """The same vectors after a round trip through their JSON lines."""
    rows = vectors(spark, sf)
    lines = rows.select(F.to_json(F.struct("linex_index", "features")).alias("line"))
    schema = rows.select("linex_index", "features").schema
    parsed = lines.select(F.from_json("line", schema).alias("r")).select("r.*")
    return (
        parsed.select("linex_index", F.posexplode("features").alias("token_no", "f"))
        .select("linex_index", "token_no", F.explode("f.layers").alias("l"))
        .select("linex_index", "token_no", F.col("l.index").alias("layer"), F.posexplode("l.values").alias("i", "v"))
    )


@query(
    "agg4_classification_metrics",
    "WITH " + X + """ SELECT round(avg((pred = label)::INT), 6) AS eval_accuracy, round(avg(loss), 6) AS eval_loss FROM z""",
)
def classification_metrics(spark, sf):
    return R.classification_metrics(logits(spark, sf), "x", "label")


@query(
    "agg7_next_segment_metrics",
    """WITH p AS (SELECT [embedding[1]::DOUBLE, embedding[2]::DOUBLE] AS x, (label > 4)::INT AS y FROM embeddings),
q AS (SELECT x, y, greatest(x[1], x[2]) AS m, CASE WHEN x[2] > x[1] THEN 1 ELSE 0 END AS pred FROM p)
SELECT round(avg((pred = y)::INT), 6) AS next_sentence_accuracy,
 round(avg(m + ln(exp(x[1] - m) + exp(x[2] - m)) - x[y + 1]), 6) AS next_sentence_loss FROM q""",
)
def next_segment(spark, sf):
    rows = logits(spark, sf).select(
        F.slice("x", 1, 2).alias("x"), (F.col("label") > 4).cast("int").alias("y")
    )
    return R.classification_metrics(rows, "x", "y").select(
        F.col("eval_accuracy").alias("next_sentence_accuracy"), F.col("eval_loss").alias("next_sentence_loss")
    )


def _slots(spark, sf):
    """Four masked slots per row, each scored over 16 words; even labels are padding."""
    four = F.sequence(F.lit(0), F.lit(3))
    rows = logits(spark, sf).select(
        "vec_id",
        A.let(
            lambda x: F.transform(four, lambda i: A.log_softmax(F.slice(x, i * 16 + 1, F.lit(16)))), F.col("x")
        ).alias("log_probs"),
        A.let(lambda y: F.transform(four, lambda i: (y + i) % 16), F.col("label")).alias("masked_lm_ids"),
        A.let(
            lambda y: F.transform(four, lambda i: ((y + i) % 2).cast("double")), F.col("label")
        ).alias("masked_lm_weights"),
    )
    return R.masked_slots(rows, "log_probs")


_SLOTS = """WITH s AS (
  SELECT vec_id, i, (label + i) % 16 AS label, ((label + i) % 2)::DOUBLE AS w,
    list_transform(embedding[i * 16 + 1:i * 16 + 16], lambda e: e::DOUBLE) AS x
  FROM embeddings, (SELECT unnest(range(0, 4)) AS i)),
m AS (SELECT *, list_max(x) AS m, list_position(x, list_max(x)) - 1 AS pred FROM s),
l AS (SELECT w, (pred = label)::INT AS hit, m + ln(list_sum(list_transform(x, lambda e: exp(e - m)))) - x[label + 1] AS loss FROM m)"""


@query(
    "agg5_masked_metrics",
    _SLOTS + """ SELECT round(sum(w * hit) / sum(w), 6) AS masked_lm_accuracy, round(sum(w * loss) / sum(w), 6) AS masked_lm_loss FROM l""",
)
def masked_metrics(spark, sf):
    return R.masked_metrics(_slots(spark, sf)).drop("training_loss")


@query("agg6_training_loss", _SLOTS + " SELECT round(sum(w * loss) / (sum(w) + 1e-5), 6) AS training_loss FROM l")
def training_loss(spark, sf):
    return R.masked_metrics(_slots(spark, sf)).select("training_loss")


# Classes of the scored vectors.
_CLASSES = 64


@query(
    "snk5_probabilities",
    "WITH " + X + " SELECT vec_id, "
    + ", ".join(f"round(exp(x[{i + 1}] - m) / t, 6) AS p{i}" for i in range(_CLASSES)) + " FROM z",
)
def probabilities(spark, sf):
    rows = logits(spark, sf).withColumn("probs", A.softmax(F.col("x")))
    return rows.select("vec_id", *probability_columns(rows, "probs", _CLASSES))


@query(
    "snk6_metric_lines",
    "WITH " + X + """, a AS (SELECT count(*) AS n, count(*) FILTER (pred = label) AS hits FROM z)
SELECT 'hits = ' || hits AS value FROM a UNION ALL SELECT 'rows = ' || n FROM a""",
)
def metric_lines(spark, sf):
    rows = logits(spark, sf)
    hit = A.argmax(F.col("x")) == F.col("label")
    return R.metric_lines(rows.agg(F.count("*").alias("rows"), F.count(F.when(hit, 1)).alias("hits")))


def _norms(frame: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"score": [float((v.astype("float64") ** 2).sum()) for v in frame["x"]]})


@query(
    "scr1_batch_scoring",
    "WITH " + X + " SELECT vec_id, round(list_sum(list_transform(x, lambda e: e * e)), 6) AS score FROM v",
)
def batch_scoring(spark, sf):
    outputs = T.StructType([T.StructField("score", T.DoubleType())])
    return R.score(logits(spark, sf), ["vec_id"], ["x"], _norms, outputs)
