"""Window scores to answers; scores are integer hashes of window and position."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import arrays as A
from textloom.operators import answers as N
from textloom.operators import scoring as R
from textloom.operators import windows as W
from textloom.plans import oracle_parts as Q
from textloom.plans.catalog import windows as CW
from textloom.plans.catalog.registry import query, shared
from textloom.session import stored

PLAIN = N.AnswerConfig()
NEGATIVE = N.AnswerConfig(negatives=True)
WIDTH = CW.CFG.max_length
RANKS, LOGIT_PAIR = ["start_rank", "end_rank"], ["start_logit", "end_logit"]

_START = "((doc_id * 7919 + q * 31 + k * 104729 + {0} * 1299709) % 1009) / 97.0::DOUBLE"
_END = "((doc_id * 6151 + q * 17 + k * 15485863 + {0} * 179424673) % 1013) / 89.0::DOUBLE"

LOGITS = f"""
logits AS MATERIALIZED (
  SELECT unique_id, qas_id, doc_id, q, k, first, length, len(qi) + 2 AS shift, cp, cu, w, impossible, bs, be, qi,
    list_transform(range(0, {WIDTH}), lambda p: {_START.format('p')}) AS sl,
    list_transform(range(0, {WIDTH}), lambda p: {_END.format('p')}) AS el
  FROM numbered)"""

CANDIDATES = """
cells AS (
  SELECT unique_id, qas_id, k, unnest(sl) AS s, unnest(el) AS e, generate_subscripts(sl, 1) - 1 AS p FROM logits),
tops AS (
  SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY s DESC, p) - 1 AS sr,
            row_number() OVER (PARTITION BY unique_id ORDER BY e DESC, p) - 1 AS er FROM cells),
starts AS (
  SELECT t.unique_id, t.p, t.s, t.sr FROM tops t JOIN logits l ON l.unique_id = t.unique_id
  JOIN best b ON b.unique_id = t.unique_id AND b.i = t.p - l.shift AND b.is_best WHERE sr < 20),
finals AS (
  SELECT t.unique_id, t.p, t.e, t.er FROM tops t JOIN logits l ON l.unique_id = t.unique_id
  WHERE er < 20 AND t.p BETWEEN l.shift AND l.shift + l.length - 1),
cand AS MATERIALIZED (
  SELECT l.qas_id, l.k, s.p AS sp, e.p AS ep, s.sr, e.er, s.s, e.e,
    array_to_string(l.cp[l.first + s.p - l.shift + 1:l.first + e.p - l.shift + 1], ' ') AS pieces,
    array_to_string(l.w[l.cu[l.first + s.p - l.shift + 1] + 1:l.cu[l.first + e.p - l.shift + 1] + 1], ' ') AS original
  FROM starts s JOIN finals e ON e.unique_id = s.unique_id AND e.p >= s.p AND e.p < s.p + 30
  JOIN logits l ON l.unique_id = s.unique_id)"""

_SOLID = "replace({}, ' ', '')"
TEXTS = f"""
predicted AS (
  SELECT *, {Q.squeeze("replace(replace(pieces, ' ##', ''), '##', '')")} AS pred,
    {Q.joined(Q.tokens('original'))} AS tok FROM cand),
located AS (
  SELECT *, strpos(tok, pred) AS st,
    list_filter(range(1, length(original) + 1), lambda i: substr(original, i, 1) <> ' ') AS places FROM predicted),
answer_texts AS MATERIALIZED (
  SELECT qas_id, k, sp, ep, sr, er, s, e, pred, CASE
    WHEN st = 0 OR length(pred) = 0 OR length({_SOLID.format('tok')}) <> length({_SOLID.format('original')}) THEN original
    ELSE substr(original, places[length({_SOLID.format('substr(tok, 1, st)')})],
      places[length({_SOLID.format('substr(tok, 1, st + length(pred) - 1)')})]
      - places[length({_SOLID.format('substr(tok, 1, st)')})] + 1) END AS text
  FROM located)"""

NULLS = """
nulls AS MATERIALIZED (
  SELECT qas_id, sl[1] + el[1] AS score_null, k, sl[1] AS ns, el[1] AS ne FROM logits
  QUALIFY row_number() OVER (PARTITION BY qas_id ORDER BY sl[1] + el[1], k) = 1)"""


def ranked_sql(negatives: bool) -> str:
    extra = (
        "UNION ALL SELECT qas_id, '', true, ns, ne, -score_null, 2147483647, 0, 0 FROM nulls"
        if negatives
        else ""
    )
    added = (
        """UNION ALL SELECT n.qas_id, coalesce(c.n, 0) + 1, '', n.ns, n.ne FROM nulls n
  LEFT JOIN (SELECT qas_id, count(*) AS n, bool_or(text = '') AS has FROM kept GROUP BY 1) c ON c.qas_id = n.qas_id
  WHERE NOT coalesce(c.has, false)"""
        if negatives
        else ""
    )
    return f"""
pool AS (
  SELECT qas_id, text, false AS is_null, s, e, -(s + e) AS neg, k, sr, er FROM answer_texts {extra}),
firsts AS (
  SELECT * FROM pool QUALIFY row_number() OVER (
    PARTITION BY qas_id, text, is_null ORDER BY neg, k, sr, er) = 1),
kept AS MATERIALIZED (
  SELECT qas_id, row_number() OVER (PARTITION BY qas_id ORDER BY neg, k, sr, er) AS rank, text, s, e
  FROM firsts QUALIFY rank <= 20),
listed AS (SELECT * FROM kept {added}),
full_list AS MATERIALIZED (
  SELECT * FROM listed UNION ALL
  SELECT qas_id, 1, 'empty', 0, 0 FROM examples WHERE qas_id NOT IN (SELECT qas_id FROM listed)),
nbest AS MATERIALIZED (
  SELECT qas_id, rank, text, s, e,
    exp(s + e - max(s + e) OVER (PARTITION BY qas_id))
    / sum(exp(s + e - m)) OVER (PARTITION BY qas_id) AS probability
  FROM (SELECT *, max(s + e) OVER (PARTITION BY qas_id) AS m FROM full_list))"""


BASE = CW.BASE + "," + LOGITS
SCORED = BASE + "," + CANDIDATES + "," + TEXTS


def _hash_seed(a: int, b: int, c: int):
    doc = F.split("qas_id", "-")[0].cast("long")
    q = F.split("qas_id", "-")[1].cast("long")
    return doc * a + q * b + F.col("window_no").cast("long") * c


#: Windows whose scores are drawn at once.
DRAWN_ROWS = 1000
_DRAWS = {"start_logits": (1299709, 1009, 97.0), "end_logits": (179424673, 1013, 89.0)}


def _hash_logits(seeds: pa.Array, d: int, modulus: int, scale: float) -> pa.Array:
    base = pc.fill_null(seeds, 0).to_numpy(zero_copy_only=False)
    # The remainder has the sign of what is divided, as in SQL.
    drawn = np.fmod(base[:, None] + np.arange(WIDTH, dtype=np.int64) * d, modulus) / scale
    known = np.repeat(seeds.is_valid().to_numpy(zero_copy_only=False), WIDTH)
    cuts = pa.array(np.arange(len(base) + 1, dtype=np.int32) * WIDTH)
    return pa.ListArray.from_arrays(cuts, pa.array(drawn.ravel(), mask=None if known.all() else ~known))


def _drawn(batches):
    for whole in batches:
        for batch in (whole.slice(k, DRAWN_ROWS) for k in range(0, whole.num_rows, DRAWN_ROWS)):
            n = batch.num_columns - len(_DRAWS)
            scores = [_hash_logits(batch.column(n + k), *how) for k, how in enumerate(_DRAWS.values())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *scores], [*batch.schema.names[:n], *_DRAWS])


def with_hash_logits(rows, keep=lambda joined: joined):
    """Windows joined by id with their scores.

    A score table holds the seed of a window's scores, from which both arrays
    are drawn where they are read: written out they are 6 KB a window. ``keep``
    may write the joined rows.
    """
    scores = rows.select(
        "unique_id",
        _hash_seed(7919, 31, 104729).alias("_start_seed"),
        _hash_seed(6151, 17, 15485863).alias("_end_seed"),
    )
    joined = keep(R.join_scores(rows, scores))
    joined = joined.select(*[c for c in joined.columns if c not in scores.columns[1:]], *scores.columns[1:])
    out = T.StructType(joined.schema.fields[:-2])
    for name in _DRAWS:
        out = out.add(name, T.ArrayType(T.DoubleType()))
    return joined.mapInArrow(_drawn, out)


def scored(spark, sf):
    """Windows without their arrays and their scores; texts are read in the encoded paragraphs."""
    rows = shared(spark, sf, "bare_windows", lambda: stored(CW.built(spark, sf)))
    # By paragraph, so that what is read of a question's windows is thinned out before it moves; in as
    # many parts as asked for, as the rows are few bytes and drawing their scores is the work.
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keep = lambda joined: stored(joined.repartition(width, "context_id").sortWithinPartitions("context_id", "unique_id"))
    return shared(spark, sf, "scored", lambda: with_hash_logits(rows, keep=keep))


def _examples(spark, sf):
    return W.questions(CW.paragraphs(spark, sf), CW.CFG).select("qas_id")


@query(
    "jn4_join_scores",
    BASE + """ SELECT unique_id, qas_id, round(list_sum(sl), 6) AS start_sum, round(list_sum(el), 6) AS end_sum FROM logits""",
)
def join_scores(spark, sf):
    def total(c):
        return F.aggregate(c, F.lit(0.0), lambda acc, v: acc + v)

    return scored(spark, sf).select(
        "unique_id", "qas_id", total("start_logits").alias("start_sum"), total("end_logits").alias("end_sum")
    )


@query(
    "top2_best_indexes",
    BASE + """, cells AS (SELECT unique_id, unnest(sl) AS s, generate_subscripts(sl, 1) - 1 AS p FROM logits),
r AS (SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY s DESC, p) AS r FROM cells)
SELECT unique_id, string_agg(p::VARCHAR, ' ' ORDER BY r) AS best FROM r WHERE r <= 20 GROUP BY 1""",
)
def best_indexes(spark, sf):
    return scored(spark, sf).select("unique_id", A.best_indexes(F.col("start_logits"), 20).alias("best"))


@query(
    "qa10_candidates",
    BASE + "," + CANDIDATES
    + " SELECT qas_id, k AS window_no, sp AS start_index, ep AS end_index, sr AS start_rank, er AS end_rank FROM cand",
)
def candidates(spark, sf):
    return N.candidate_pairs(scored(spark, sf), PLAIN).select(
        "qas_id", "window_no", "start_index", "end_index", "start_rank", "end_rank"
    )


@query(
    "jn11_candidate_words",
    BASE + "," + CANDIDATES
    + " SELECT qas_id, k AS window_no, sp AS start_index, ep AS end_index, md5(original) AS words FROM cand",
)
def candidate_words(spark, sf):
    return N.candidates(scored(spark, sf), PLAIN, CW.texts(spark, sf), without=RANKS + LOGIT_PAIR).select(
        "qas_id", "window_no", "start_index", "end_index", F.md5("original").alias("words")
    )


@query(
    "jn12_pair_counts",
    BASE + "," + CANDIDATES + " SELECT qas_id, count(*) AS pairs, round(max(s + e), 6) AS best FROM cand GROUP BY 1",
)
def pair_counts(spark, sf):
    return N.candidate_pairs(scored(spark, sf), PLAIN).groupBy("qas_id").agg(
        F.count("*").alias("pairs"), F.max(F.col("start_logit") + F.col("end_logit")).alias("best")
    )


@query(
    "qa15_project_answers",
    SCORED + " SELECT qas_id, k AS window_no, sp AS start_index, ep AS end_index, pred AS predicted, text FROM answer_texts",
)
def project_answers(spark, sf):
    rows = N.candidates(scored(spark, sf), PLAIN, CW.texts(spark, sf), without=RANKS + LOGIT_PAIR)
    return rows.select(
        "qas_id",
        "window_no",
        "start_index",
        "end_index",
        "predicted",
        N.project_answer(F.col("predicted"), F.col("original")).alias("text"),
    )


@query(
    "win5_first_per_text",
    SCORED + """ SELECT qas_id, text, round(max(s + e), 6) AS score, count(*) AS n FROM answer_texts GROUP BY 1, 2""",
)
def first_per_text(spark, sf):
    rows = N.candidates(scored(spark, sf), PLAIN, CW.texts(spark, sf), without=RANKS).withColumn(
        "text", N.project_answer(F.col("predicted"), F.col("original"))
    )
    return rows.groupBy("qas_id", "text").agg(
        F.max(F.col("start_logit") + F.col("end_logit")).alias("score"), F.count("*").alias("n")
    )


@query(
    "agg10_null_scores",
    BASE + "," + NULLS + """ SELECT qas_id, round(score_null, 6) AS score_null, k AS window_no,
 round(ns, 6) AS null_start, round(ne, 6) AS null_end FROM nulls""",
)
def null_scores(spark, sf):
    return N.null_scores(scored(spark, sf)).select(
        "qas_id", "score_null", "window_no", "null_start", "null_end"
    )


_NBEST = """ SELECT qas_id, rank::BIGINT AS rank, text, round(probability, 6) AS probability,
 round(s::DOUBLE, 6) AS start_logit, round(e::DOUBLE, 6) AS end_logit FROM nbest"""


@query("qa12_n_best", SCORED + "," + ranked_sql(False) + _NBEST)
def n_best(spark, sf):
    return N.n_best(scored(spark, sf), _examples(spark, sf), PLAIN, paragraphs=CW.texts(spark, sf))


@query("set4_n_best_with_null", SCORED + "," + NULLS + "," + ranked_sql(True) + _NBEST)
def n_best_with_null(spark, sf):
    return N.n_best(scored(spark, sf), _examples(spark, sf), NEGATIVE, paragraphs=CW.texts(spark, sf))


FINAL = """
solid AS (
  SELECT qas_id, arg_min(text, rank) AS text, arg_min(s, rank) AS s, arg_min(e, rank) AS e
  FROM nbest WHERE text <> '' GROUP BY 1),
diffs AS (
  SELECT x.qas_id, solid.text, score_null - s - e AS score_diff
  FROM (SELECT DISTINCT qas_id FROM nbest) x LEFT JOIN solid ON solid.qas_id = x.qas_id
  LEFT JOIN nulls ON nulls.qas_id = x.qas_id)"""


def _final_sql(threshold: float) -> str:
    return f"""SELECT qas_id, CASE WHEN score_diff > {threshold} THEN '' ELSE coalesce(text, '') END AS text,
 round(score_diff, 6) AS score_diff FROM diffs"""


@query(
    "qa11_null_answers",
    SCORED + "," + NULLS + "," + ranked_sql(True)
    + " SELECT qas_id, rank::BIGINT AS rank, round(s::DOUBLE, 6) AS start_logit FROM nbest WHERE text = ''",
)
def null_answers(spark, sf):
    rows = N.n_best(scored(spark, sf), _examples(spark, sf), NEGATIVE, paragraphs=CW.texts(spark, sf))
    return rows.filter("text = ''").select("qas_id", "rank", "start_logit")


@query(
    "qa13_predictions",
    SCORED + "," + NULLS + "," + ranked_sql(True) + "," + FINAL + " " + _final_sql(-18.0),
)
def predictions(spark, sf):
    rows = scored(spark, sf)
    ranked = N.n_best(rows, _examples(spark, sf), NEGATIVE, paragraphs=CW.texts(spark, sf))
    return N.predictions(ranked, N.null_scores(rows), -18.0)


@query(
    "qa14_rethreshold",
    SCORED + "," + NULLS + "," + ranked_sql(True) + "," + FINAL
    + " SELECT qas_id, text FROM (" + _final_sql(-17.0) + ")",
)
def rethreshold(spark, sf):
    rows = scored(spark, sf)
    ranked = stored(N.n_best(rows, _examples(spark, sf), NEGATIVE, paragraphs=CW.texts(spark, sf)))
    kept = N.predictions(ranked, N.null_scores(rows), -18.0)
    return N.rethreshold(ranked, kept, -17.0)


@query(
    "top8_first_answer",
    SCORED + "," + NULLS + "," + ranked_sql(True)
    + " SELECT qas_id, arg_min(text, rank) AS text FROM nbest WHERE text <> '' GROUP BY 1",
)
def first_answer(spark, sf):
    rows = N.n_best(scored(spark, sf), _examples(spark, sf), NEGATIVE, paragraphs=CW.texts(spark, sf))
    return rows.filter("text <> ''").groupBy("qas_id").agg(F.min_by("text", "rank").alias("text"))


def _xent(col: str, pos: str) -> str:
    return f"(list_max({col}) + ln(list_sum(list_transform({col}, lambda v: exp(v - list_max({col}))))) - {col}[{pos} + 1])"


@query(
    "agg8_span_loss",
    BASE + f""", p AS (SELECT sl, el, list_max(sl) AS ms, list_max(el) AS me,
  CASE WHEN NOT impossible AND bs >= first AND be <= first + length - 1 THEN bs - first + shift ELSE 0 END AS sp,
  CASE WHEN NOT impossible AND bs >= first AND be <= first + length - 1 THEN be - first + shift ELSE 0 END AS ep FROM logits)
SELECT round((avg(ms + ln(list_sum(list_transform(sl, lambda v: exp(v - ms)))) - sl[sp + 1])
 + avg(me + ln(list_sum(list_transform(el, lambda v: exp(v - me)))) - el[ep + 1])) / 2, 6) AS span_loss FROM p""",
)
def span_loss(spark, sf):
    return R.span_loss(scored(spark, sf))
