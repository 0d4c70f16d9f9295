"""Question windows over contexts made from `documents`."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.functions import arrays as A
from textloom.functions import text as X
from textloom.operators import checks as K
from textloom.operators import windows as W
from textloom.operators.subword import vocab_facts
from textloom.plans import oracle_parts as Q
from textloom.plans.catalog.registry import query, shared, table, vocabulary
from textloom.plans.questions import document_paragraphs

CFG = W.WindowConfig(negatives=True)
_D = Q.digest("qa", "doc_id")
_WORDS = "list_filter(string_split_regex({}, '[ \\t\\r\\n\\x{{202F}}]+'), lambda w: w <> '')"

PARAGRAPHS = f"""
cwords AS (
  SELECT doc_id, w, len(w)::BIGINT AS n FROM (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents)
  WHERE len(w) > 0),
placed AS (SELECT *, {Q.pick(_D, 'n')} AS s, {Q.pick(_D, '4', 1)} + 1 AS wanted FROM cwords),
runs AS (
  SELECT *, least(wanted, n - s) AS size, array_to_string(w[s + 1:s + least(wanted, n - s)], ' ') AS run FROM placed),
paras AS MATERIALIZED (
  SELECT doc_id, w, n, s, size, array_to_string(w, ' ') AS context,
    CASE WHEN regexp_replace(run, '[.,]+$', '') = '' THEN run ELSE regexp_replace(run, '[.,]+$', '') END AS answer,
    length(array_to_string(w[1:s], ' ')) + (CASE WHEN s > 0 THEN 1 ELSE 0 END) AS answer_start,
    array_to_string(w[1:8], ' ') AS q0, array_to_string(w[greatest(n - 7, 1):n], ' ') AS q1
  FROM runs),
examples AS MATERIALIZED (
  SELECT doc_id, 0 AS q, doc_id || '-0' AS qas_id, q0 AS question, false AS impossible, answer,
    len({_WORDS.format('substr(context, 1, answer_start + 1)')}) - 1 AS sw,
    len({_WORDS.format('substr(context, 1, answer_start + length(answer))')}) - 1 AS ew, context, w FROM paras
  UNION ALL
  SELECT doc_id, 1, doc_id || '-1', q1, true, '', -1, -1, context, w FROM paras)"""

# Four texts per document share one key space: context, two questions, answer.
TEXT_WORDS = f"""
ctx_words AS (
  SELECT doc_id, unnest(w) AS word_text, generate_subscripts(w, 1) - 1 AS unit FROM paras),
texts AS (
  SELECT doc_id * 10 AS doc_id, unit, {Q.tokens('word_text')} AS t FROM ctx_words
  UNION ALL SELECT doc_id * 10 + 1, 0, {Q.tokens('q0')} FROM paras
  UNION ALL SELECT doc_id * 10 + 2, 0, {Q.tokens('q1')} FROM paras
  UNION ALL SELECT doc_id * 10 + 3, 0, {Q.tokens('answer')} FROM paras),
occ AS MATERIALIZED (
  SELECT doc_id, unit, unnest(t) AS word, generate_subscripts(t, 1) AS wpos FROM texts)"""

SPANS = """
lists AS MATERIALIZED (
  SELECT doc_id, list(piece ORDER BY pno) AS pieces, list(id ORDER BY pno) AS ids, list(unit ORDER BY pno) AS units
  FROM enc GROUP BY 1),
joined AS (
  SELECT e.*, coalesce(qt.pieces[1:64], []) AS qp, coalesce(qt.ids[1:64], []) AS qi,
    c.pieces AS cp, c.ids AS ci, c.units AS cu, coalesce(a.ids, []) AS ai, len(c.ids) AS np
  FROM examples e
  JOIN lists c ON c.doc_id = e.doc_id * 10
  LEFT JOIN lists qt ON qt.doc_id = e.doc_id * 10 + 1 + e.q
  LEFT JOIN lists a ON a.doc_id = e.doc_id * 10 + 3 AND e.q = 0
  WHERE impossible OR strpos(array_to_string(w[sw + 1:ew + 1], ' '), trim(answer)) > 0),
spans AS (
  SELECT *, len(list_filter(cu, lambda u: u < sw)) AS ps, len(list_filter(cu, lambda u: u < ew + 1)) - 1 AS pe
  FROM joined),
better AS MATERIALIZED (
  SELECT *, CASE WHEN len(ai) = 0 THEN NULL ELSE
    list_filter(range(ps, pe - len(ai) + 2), lambda x: ci[x + 1:x + len(ai)] = ai)[1] END AS hit FROM spans)"""

WINDOWS = """
shapes AS (
  SELECT *, coalesce(hit, ps) AS bs, CASE WHEN hit IS NULL THEN pe ELSE hit + len(ai) - 1 END AS be,
    384 - 3 - len(qi) AS room, least(128, 384 - 3 - len(qi)) AS step FROM better),
counted AS (
  SELECT *, CASE WHEN np = 0 THEN 0 WHEN np <= room THEN 1 ELSE ceil((np - room) / step)::BIGINT + 1 END AS cnt FROM shapes),
wins AS MATERIALIZED (
  SELECT *, k * step AS first, least(room, np - k * step) AS length
  FROM (SELECT *, unnest(range(0, cnt)) AS k FROM counted)),
numbered AS MATERIALIZED (
  SELECT *, 1000000000 + row_number() OVER (ORDER BY qas_id, k) - 1 AS unique_id, first AS f FROM wins),
cover AS (
  SELECT unique_id, qas_id, k, first, length, unnest(range(first, first + length)) AS p FROM numbered),
best AS MATERIALIZED (
  SELECT unique_id, qas_id, p, p - first AS i, row_number() OVER (
    PARTITION BY qas_id, p ORDER BY 100 * least(p - first, first + length - 1 - p) + length DESC, k) = 1 AS is_best
  FROM cover)"""

BASE = Q.with_parts(PARAGRAPHS, TEXT_WORDS, Q.VOCAB, Q.dictionary(), Q.ENCODED, SPANS, WINDOWS).rstrip()
SIMPLE = Q.with_parts(PARAGRAPHS).rstrip()


PAIR_WORDS = f"""
sides AS (
  SELECT {Q.words('text')} AS a, {Q.words('next')} AS b FROM (
    SELECT text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next FROM conversations))"""


def paragraphs(spark, sf):
    """Made again from each document where they are read, which takes no disk."""
    return document_paragraphs(table(spark, sf, "documents"))


KEPT = ["ids", "piece_units", "asked"]


def _encoded(spark, sf):
    vocab = vocabulary(spark, sf)
    return shared(
        spark,
        sf,
        "encoded_questions",
        lambda: W.kept_examples(W.encode_examples(paragraphs(spark, sf), CFG, vocab, facts=vocab_facts(vocab), columns=KEPT)),
    )


@query(
    "src7_explode_questions",
    SIMPLE + " SELECT doc_id::VARCHAR AS context_id, qas_id, question, impossible::BIGINT AS is_impossible,"
    " md5(context) AS context FROM examples",
)
def explode_questions(spark, sf):
    return W.questions(paragraphs(spark, sf), CFG).select(
        "context_id", "qas_id", "question", "is_impossible", F.md5("context").alias("context")
    )


@query("qa1_context_words", SIMPLE + " SELECT doc_id::VARCHAR AS context_id, n, md5(context) AS words FROM paras")
def words(spark, sf):
    rows = paragraphs(spark, sf).select("context_id", W.context_words(F.col("context")).alias("w"))
    return rows.select("context_id", F.size("w").alias("n"), F.md5(F.array_join("w", " ")).alias("words"))


@query(
    "qa2_word_spans",
    SIMPLE + " SELECT qas_id, sw::BIGINT AS start_word, ew::BIGINT AS end_word FROM examples WHERE q = 0",
)
def word_spans(spark, sf):
    return W.questions(paragraphs(spark, sf), CFG).filter("not is_impossible").select(
        "qas_id", "start_word", "end_word"
    )


@query(
    "qa3_impossible",
    SIMPLE + " SELECT qas_id, answer AS answer_text, sw::BIGINT AS start_word FROM examples WHERE impossible",
)
def impossible(spark, sf):
    return W.questions(paragraphs(spark, sf), CFG).filter("is_impossible").select(
        "qas_id", "answer_text", "start_word"
    )


@query(
    "prj14_recoverable",
    SIMPLE + """ SELECT qas_id, (strpos(array_to_string(w[sw + 1:ew], ' '), answer) > 0)::BIGINT AS kept
FROM examples WHERE q = 0""",
)
def recoverable(spark, sf):
    # The last word of the span is left out, so that some answers are lost.
    rows = W.questions(paragraphs(spark, sf), CFG).filter("not is_impossible")
    short = rows.withColumn("end_word", F.col("end_word") - 1)
    return short.select("qas_id", W.answer_found().alias("kept"))


@query(
    "prj15_violations",
    SIMPLE + """ SELECT 'answers' AS rule, count(*) FILTER (q = 1) AS bad FROM examples
UNION ALL SELECT 'empty_question', count(*) FILTER (question = '') FROM examples""",
)
def violations(spark, sf):
    rows = paragraphs(spark, sf).select(F.explode("qas").alias("qa"))
    return K.violations(rows, K.question_rules())


@query(
    "prj15_widths_and_sides",
    Q.with_parts(PAIR_WORDS) + """ SELECT 'a_width' AS rule, count(*) FILTER (len(a) <> 12) AS bad FROM sides
UNION ALL SELECT 'b_width', count(*) FILTER (b IS NULL OR len(b) <> 12) FROM sides
UNION ALL SELECT 'empty_a', count(*) FILTER (len(a) = 0) FROM sides
UNION ALL SELECT 'empty_b', count(*) FILTER (b IS NULL OR len(b) = 0) FROM sides""",
)
def widths_and_sides(spark, sf):
    by_turn = Window.partitionBy("conv_id").orderBy("turn")
    turns = table(spark, sf, "conversations").select("text", F.lead("text").over(by_turn).alias("next"))
    sides = turns.select(X.words_of(F.col("text")).alias("a"), X.words_of(F.col("next")).alias("b"))
    return K.violations(sides, K.width_rules({"a": 12, "b": 12}) | K.side_rules("a", "b"))


def _spelled_queries(rows, vocab):
    return W.spelled(rows, vocab, ids="query_ids", pieces="query_pieces", keys=["context_id", "qa_no"])


def _question_pieces(spark, sf):
    """Questions are cut from the paragraphs' ids and spelled, not the paragraphs."""
    return _spelled_queries(W.question_pieces(_encoded(spark, sf)), vocabulary(spark, sf))


@query(
    "qa4_short_queries",
    BASE + " SELECT qas_id, array_to_string(qi[1:3], ' ') AS ids, array_to_string(qp[1:3], ' ') AS pieces FROM joined",
)
def short_queries(spark, sf):
    cfg = W.WindowConfig(negatives=True, max_query=3)
    vocab = vocabulary(spark, sf)
    rows = W.question_pieces(W.encode_examples(paragraphs(spark, sf), cfg, vocab, columns=["ids", "asked"]))
    rows = _spelled_queries(rows, vocab)
    return rows.select("qas_id", F.col("query_ids").alias("ids"), F.col("query_pieces").alias("pieces"))


@query("qa4_query_pieces", BASE + " SELECT qas_id, len(qi)::BIGINT AS n, array_to_string(qi, ' ') AS ids FROM joined")
def query_pieces(spark, sf):
    return _question_pieces(spark, sf).select(
        "qas_id", F.size("query_ids").alias("n"), F.col("query_ids").alias("ids")
    )


@query("qa5_piece_spans", BASE + " SELECT qas_id, ps::BIGINT AS first, pe::BIGINT AS last FROM spans WHERE q = 0")
def piece_spans(spark, sf):
    rows = _question_pieces(spark, sf).filter("not is_impossible")
    return rows.select("qas_id", "first", "last")


@query("qa6_improved_spans", BASE + " SELECT qas_id, bs::BIGINT AS first, be::BIGINT AS last FROM shapes WHERE q = 0")
def improved_spans(spark, sf):
    rows = _question_pieces(spark, sf).filter("not is_impossible")
    return rows.select("qas_id", F.col("better_first").alias("first"), F.col("better_last").alias("last"))


def _first_ids(spark, sf):
    return shared(spark, sf, "first_window_ids", lambda: W.first_window_ids(_encoded(spark, sf)))


def built(spark, sf, lists=()):
    """Windows with their scalars and those arrays that a query reads."""
    return W.question_windows(
        paragraphs(spark, sf), vocabulary(spark, sf), CFG, lists=lists, encoded=_encoded(spark, sf), first_ids=_first_ids(spark, sf)
    )


def texts(spark, sf):
    """Words and pieces of the paragraphs, for answers."""
    return W.paragraph_texts(_encoded(spark, sf), paragraphs(spark, sf), vocabulary(spark, sf), pack=True)


def _unnumbered(spark, sf, lists):
    """Windows with arrays, of which a query keeps little before they are numbered."""
    vocab, encoded = vocabulary(spark, sf), _encoded(spark, sf)
    facts = vocab_facts(vocab)
    encoded = W.spelled(encoded, vocab, facts) if "tokens" in lists else encoded
    return W.with_token_maps(W.windows(encoded, CFG, facts, lists=lists))


@query(
    "qa7_sliding_windows",
    BASE + " SELECT qas_id, k AS window_no, first::BIGINT AS window_start, length::BIGINT AS window_length FROM wins",
)
def sliding(spark, sf):
    vocab = vocabulary(spark, sf)
    rows = W.windows(_encoded(spark, sf), CFG, vocab_facts(vocab), lists=())
    return rows.select("qas_id", "window_no", "window_start", "window_length")


@query(
    "qa8_window_features",
    BASE + """, flags AS (
  SELECT unique_id, string_agg(is_best::INT::VARCHAR, '' ORDER BY i) AS f FROM best GROUP BY 1)
SELECT unique_id, qas_id, k AS window_no,
 md5(array_to_string(list_resize(list_concat(list_concat([2], qi), list_concat(list_concat([3], ci[first + 1:first + length]), [3])), 384, 0), ' ')) AS input_ids,
 (len(qi) + length + 3)::BIGINT AS n,
 md5('[CLS] ' || array_to_string(list_concat(list_concat(qp, ['[SEP]']), list_concat(cp[first + 1:first + length], ['[SEP]'])), ' ')) AS tokens,
 md5(array_to_string(cu[first + 1:first + length], ' ')) AS words, md5(flags.f) AS best
FROM numbered JOIN flags USING (unique_id)""",
)
def features(spark, sf):
    rows = _unnumbered(spark, sf, ["tokens", "token_words", "input_ids", "input_mask"])
    mask = F.aggregate("input_mask", F.lit(0), lambda a, v: a + v)
    flags = F.transform(F.map_values("token_is_best"), lambda b: b.cast("int").cast("string"))
    digests = rows.select(
        "context_id",
        "qa_no",
        "qas_id",
        "window_no",
        F.md5(A.text_of(F.col("input_ids"))).alias("input_ids"),
        mask.alias("n"),
        F.md5(F.array_join("tokens", " ")).alias("tokens"),
        F.md5(A.text_of(F.map_values("token_to_word"))).alias("words"),
        F.md5(F.array_join(flags, "")).alias("best"),
    )
    return W.numbered(digests, _first_ids(spark, sf)).select("unique_id", *digests.columns[2:])


@query(
    "win2_best_context",
    BASE + """ SELECT qas_id, unique_id, count(*) AS n, count(*) FILTER (is_best) AS n_best,
 coalesce(min(i) FILTER (is_best), -1)::BIGINT AS first_best FROM best GROUP BY 1, 2""",
)
def best_context(spark, sf):
    flags = F.map_values("token_is_best")
    rows = _unnumbered(spark, sf, ["token_words"]).withColumn("flags", flags)
    counts = rows.select(
        "context_id",
        "qa_no",
        "qas_id",
        "window_no",
        F.size("flags").alias("n"),
        F.size(F.filter("flags", lambda b: b)).alias("n_best"),
        F.coalesce(F.array_position("flags", F.lit(True)) - 1, F.lit(-1)).alias("first_best"),
    )
    return W.numbered(counts, _first_ids(spark, sf)).select("qas_id", "unique_id", *counts.columns[4:])


LABELLED = """
labelled AS (
  SELECT *, (NOT impossible AND bs >= first AND be <= first + length - 1) AS inside FROM numbered)"""


@query(
    "qa9_window_labels",
    BASE + "," + LABELLED + """ SELECT unique_id, qas_id, impossible::BIGINT AS is_impossible,
 (CASE WHEN inside THEN bs - first + len(qi) + 2 ELSE 0 END)::BIGINT AS start_position,
 (CASE WHEN inside THEN be - first + len(qi) + 2 ELSE 0 END)::BIGINT AS end_position FROM labelled""",
)
def window_labels(spark, sf):
    return built(spark, sf).select(
        "unique_id", "qas_id", "is_impossible", "start_position", "end_position"
    )


@query(
    "qa16_question_set",
    BASE + "," + LABELLED + """ SELECT qas_id, count(*) AS windows, sum(length)::BIGINT AS pieces,
 count(*) FILTER (inside) AS with_answer FROM labelled GROUP BY 1""",
)
def question_set(spark, sf):
    rows = W.question_windows(paragraphs(spark, sf), vocabulary(spark, sf), CFG, lists=())
    return rows.groupBy("qas_id").agg(
        F.count("*").alias("windows"),
        F.sum("window_length").alias("pieces"),
        F.count(F.when(F.col("end_position") > 0, 1)).alias("with_answer"),
    )


@query("jn5_windows_per_question", BASE + " SELECT qas_id, count(*) AS windows, min(unique_id) AS first_id FROM numbered GROUP BY 1")
def per_question(spark, sf):
    rows = built(spark, sf)
    examples = W.questions(paragraphs(spark, sf), CFG).select("qas_id")
    return examples.join(rows, "qas_id").groupBy("qas_id").agg(
        F.count("*").alias("windows"), F.min("unique_id").alias("first_id")
    )


@query(
    "jn8_pieces_in_windows",
    BASE + " SELECT qas_id, p AS piece_no, count(*) AS windows FROM cover GROUP BY 1, 2",
)
def pieces_in_windows(spark, sf):
    rows = built(spark, sf)
    # Windows change how often a piece is covered at their bounds only.
    end = F.col("window_start") + F.col("window_length")
    bounds = F.array(
        F.struct(F.col("window_start").alias("piece_no"), F.lit(1).alias("change")),
        F.struct(end.alias("piece_no"), F.lit(-1).alias("change")),
    )
    changes = rows.select("qas_id", F.explode(bounds).alias("b")).groupBy("qas_id", "b.piece_no").agg(
        F.sum("b.change").alias("change")
    )
    by_piece = Window.partitionBy("qas_id").orderBy("piece_no")
    runs = changes.select(
        "qas_id", "piece_no", F.sum("change").over(by_piece).alias("windows"), F.lead("piece_no").over(by_piece).alias("next")
    ).filter("windows > 0")
    return runs.select("qas_id", F.explode(F.sequence("piece_no", F.col("next") - 1)).alias("piece_no"), "windows")
