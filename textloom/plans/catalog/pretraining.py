"""Masked sentence-pair rows from `documents`, two copies of each."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.functions import arrays as A
from textloom.functions import text as X
from textloom.functions.draws import draw_hex
from textloom.operators import pretrain as P
from textloom.operators.subword import vocab_facts
from textloom.plans import oracle_parts as Q
from textloom.plans.catalog.registry import query, shared, table, vocabulary

CFG = P.PairConfig(dupe_factor=2)
#: Row sets of two lengths made from one encoding.
LENGTHS = (P.PairConfig(dupe_factor=2, max_length=64, max_predictions=10), P.PairConfig(dupe_factor=2, max_length=192, max_predictions=30))
S = CFG.seed

_TARGET = Q.digest(S + "/target", "doc_id", "copy")
_CHUNK = Q.digest(S + "/chunk", "w.doc_id", "w.copy", "(w.chunk + 1)")
SHORT = int(CFG.short_prob * 2**32)



def segments_sql(cfg: P.PairConfig) -> str:
    full = cfg.max_length - 3
    return f"""
segs AS (
  SELECT doc_id, unit, count(*) AS n FROM enc GROUP BY 1, 2),
ends AS (
  SELECT doc_id, unit, sum(n) OVER (PARTITION BY doc_id ORDER BY unit)::BIGINT AS e FROM segs),
corpus AS MATERIALIZED (
  SELECT c.doc_id, row_number() OVER (ORDER BY md5(c.doc_id::VARCHAR), c.doc_id) - 1 AS doc_no, ids, ends
  FROM (SELECT doc_id, list(id ORDER BY pno) AS ids FROM enc GROUP BY 1) c
  JOIN (SELECT doc_id, list(e ORDER BY unit) AS ends FROM ends GROUP BY 1) s ON s.doc_id = c.doc_id),
copies AS (
  SELECT *, CASE WHEN {Q.bits(_TARGET)} < {SHORT} THEN {Q.pick(_TARGET, str(full - 1), 1)} + 2 ELSE {full} END AS target
  FROM corpus, (SELECT unnest(range(0, 2)) AS copy) k)"""


SEGMENTS = segments_sql(CFG)

PLAN = """
firsts AS (
  SELECT doc_id, copy, target, ends, unnest(range(0, len(ends))) AS first FROM copies),
reach AS MATERIALIZED (
  SELECT doc_id, copy, first,
    least(len(ends) - 1, len(list_filter(ends, lambda e: e < target
      + (CASE WHEN first > 0 THEN ends[first] ELSE 0 END)))) AS last
  FROM firsts),
walk AS (
  SELECT doc_id, copy, -1::BIGINT AS chunk, 0::BIGINT AS first, 0::BIGINT AS a_end, 0::BIGINT AS stop,
         false AS rnd, 0::BIGINT AS next FROM copies
  UNION ALL
  SELECT doc_id, copy, chunk, first, first + a_size, last + 1, rnd,
         CASE WHEN rnd THEN first + a_size ELSE last + 1 END
  FROM (
    SELECT w.doc_id, w.copy, w.chunk + 1 AS chunk, r.first, r.last,
      CASE WHEN r.last = r.first THEN 1 ELSE 1 + {pick} END AS a_size,
      (r.last = r.first OR {bits} < 2147483648) AS rnd
    FROM walk w JOIN reach r ON r.doc_id = w.doc_id AND r.copy = w.copy AND r.first = w.next)),
plan AS MATERIALIZED (SELECT * FROM walk WHERE chunk >= 0)""".format(
    pick=Q.pick(_CHUNK, "(r.last - r.first)"), bits=Q.bits(_CHUNK, 1)
)

_PARTNER = Q.pick(Q.digest(S + "/partner", "p.doc_id", "p.copy", "p.chunk"), "(SELECT count(*) - 1 FROM corpus)")
_START = Q.pick(Q.digest(S + "/start", "i.doc_id", "i.copy", "i.chunk"), "len(o.ends)")

PARTNERS = f"""
picked AS (
  SELECT p.doc_id, p.copy, p.chunk, p.first, p.a_end, p.stop, p.rnd, c.doc_no, c.target,
    {_PARTNER} AS r FROM plan p JOIN copies c ON c.doc_id = p.doc_id AND c.copy = p.copy),
inst AS (
  SELECT i.*, c.ids[(CASE WHEN first > 0 THEN c.ends[first] ELSE 0 END) + 1:c.ends[a_end]] AS a,
    CASE WHEN rnd THEN [] ELSE c.ids[c.ends[a_end] + 1:c.ends[stop]] END AS own_b,
    r + (CASE WHEN r >= i.doc_no THEN 1 ELSE 0 END) AS partner_no
  FROM picked i JOIN corpus c USING (doc_id)),
random AS (
  SELECT i.doc_id, i.copy, i.chunk, o.doc_id AS partner_id, {_START} AS start_segment, o.ids, o.ends,
    i.target - len(i.a) AS need
  FROM inst i JOIN corpus o ON o.doc_no = i.partner_no WHERE i.rnd),
drawn AS (
  SELECT *, CASE WHEN start_segment > 0 THEN ends[start_segment] ELSE 0 END AS lo FROM random),
random_b AS MATERIALIZED (
  SELECT doc_id, copy, chunk, partner_id, start_segment,
    ids[lo + 1:coalesce(list_filter(ends, lambda e: e >= lo + greatest(need, 1))[1], ends[-1])] AS b
  FROM drawn),
pairs AS MATERIALIZED (
  SELECT i.doc_id, i.copy, i.chunk, i.rnd, i.a, CASE WHEN i.rnd THEN r.b ELSE i.own_b END AS b
  FROM inst i LEFT JOIN random_b r ON r.doc_id = i.doc_id AND r.copy = i.copy AND r.chunk = i.chunk)"""


def _heads(side: str) -> str:
    return (
        f"len(list_filter(range(1, (len({side}) - k{side}) + 1), lambda i: substr("
        + Q.digest(f"{S}/trim_{side}", "doc_id", "copy", "chunk", "i")
        + ", 1, 1) < '8'))"
    )


def trimmed_sql(cfg: P.PairConfig) -> str:
    full = cfg.max_length - 3
    return f"""
sized AS (
  SELECT *, least(len(a), greatest({full} - len(b), {full - full // 2})) AS ka,
            least(len(b), greatest({full} - len(a), {full // 2})) AS kb FROM pairs),
headed AS (SELECT *, {_heads('a')} AS ha, {_heads('b')} AS hb FROM sized),
trimmed AS (
  SELECT doc_id, copy, chunk, rnd, a[ha + 1:ha + ka] AS a, b[hb + 1:hb + kb] AS b FROM headed),
rows AS MATERIALIZED (
  SELECT doc_id, copy, chunk, rnd, len(a) AS la, len(b) AS lb,
    list_concat(list_concat(list_concat([2], a), list_concat([3], b)), [3]) AS ids FROM trimmed)"""


TRIMMED = trimmed_sql(CFG)

_MASK = Q.digest(S + "/mask", "doc_id", "copy", "chunk", "pos")


def masked_sql(cfg: P.PairConfig) -> str:
    return f"""
cells AS (
  SELECT doc_id, copy, chunk, len(ids) AS n, unnest(ids) AS id, generate_subscripts(ids, 1) - 1 AS pos FROM rows),
ranked AS (
  SELECT *, {_MASK} AS d, row_number() OVER (PARTITION BY doc_id, copy, chunk ORDER BY {_MASK}, pos) AS r
  FROM cells WHERE id NOT IN (2, 3)),
chosen AS MATERIALIZED (
  SELECT doc_id, copy, chunk, pos, id AS label,
    CASE WHEN {Q.bits('d', 1)} < {int(0.8 * 2**32)} THEN 4
         WHEN {Q.bits('d', 1)} < {int(0.9 * 2**32)} THEN id
         ELSE {Q.pick('d', '(SELECT count(*) FROM vocab)', 2)} END AS new_id
  FROM ranked WHERE r <= least({cfg.max_predictions}, greatest(1, round_even(n * {cfg.masked_prob}::DOUBLE, 0))))"""


MASKED = masked_sql(CFG)

BASE = Q.CORPUS + "," + SEGMENTS


def _corpus(spark, sf):
    docs = table(spark, sf, "documents")
    return shared(
        spark, sf, "corpus", lambda: P.encode_documents(docs, vocabulary(spark, sf))
    )


@query(
    "src1_corpus_segments",
    BASE
    + """ SELECT doc_id, len(ends)::BIGINT AS n_segments, len(ids)::BIGINT AS n_pieces,
 array_to_string(ends, ' ') AS ends FROM corpus""",
)
def corpus_segments(spark, sf):
    return _corpus(spark, sf).select(
        "doc_id", F.size("ends").alias("n_segments"), F.size("ids").alias("n_pieces"), "ends"
    )


@query("pt1_document_order", BASE + " SELECT doc_id, doc_no FROM corpus")
def document_order(spark, sf):
    return _corpus(spark, sf).select("doc_id", "doc_no")


@query("pt2_target_length", BASE + " SELECT doc_id, copy, target::BIGINT AS target FROM copies")
def target_length(spark, sf):
    copies = P.repeat_documents(_corpus(spark, sf), 2)
    return copies.select("doc_id", "copy", P.target_length(CFG, "doc_id", "copy").alias("target"))


@query("set3_repeat_corpus", "SELECT doc_id, unnest(range(0, 3))::BIGINT AS copy FROM documents")
def repeat(spark, sf):
    return P.repeat_documents(table(spark, sf, "documents").select("doc_id"), 3)


@query(
    "pt3_chunk_plan",
    BASE + "," + PLAN
    + " SELECT doc_id, copy, chunk, first, a_end, stop AS last, rnd::BIGINT AS random_next FROM plan",
)
def chunk_plan(spark, sf):
    return P.chunk_plans(_corpus(spark, sf), CFG).select(
        "doc_id", "copy", "chunk", "first", "a_end", "last", "random_next"
    )


@query(
    "pt4_random_next",
    BASE + "," + PLAN + "," + PARTNERS
    + """ SELECT doc_id, copy, chunk, partner_id, start_segment::BIGINT AS start_segment,
 md5(array_to_string(b, ' ')) AS b FROM random_b""",
)
def random_next(spark, sf):
    corpus = _corpus(spark, sf)
    planned = P.plan_instances(corpus, CFG).filter("random_next")
    rows = P.attach_random_next(planned, corpus, CFG)
    return rows.select(
        "doc_id", "copy", "chunk", "partner_id", "start_segment", F.md5(A.text_of(F.col("b"))).alias("b")
    )


@query(
    "pt5_masked_positions",
    BASE + "," + PLAN + "," + PARTNERS + "," + TRIMMED + "," + MASKED
    + """ SELECT doc_id, copy, chunk, string_agg(pos::VARCHAR, ' ' ORDER BY pos) AS positions,
 string_agg(label::VARCHAR, ' ' ORDER BY pos) AS labels, string_agg(new_id::VARCHAR, ' ' ORDER BY pos) AS new_ids
FROM chosen GROUP BY 1, 2, 3""",
)
def masked_positions(spark, sf):
    vocab = vocabulary(spark, sf)
    facts = vocab_facts(vocab)
    pairs = P.truncate_random(P.pair_up(_corpus(spark, sf), CFG), CFG)
    ids = A.bracketed(F.col("a"), F.col("b"), facts.id("[CLS]"), facts.id("[SEP]"))
    masked = P.mask_pieces(pairs.withColumn("ids", ids), CFG, facts)
    return masked.select(
        "doc_id",
        "copy",
        "chunk",
        "positions",
        F.col("label_ids").alias("labels"),
        A.gather(F.col("masked_ids"), F.col("positions")).alias("new_ids"),
    )


_ROWS = BASE + "," + PLAN + "," + PARTNERS + "," + TRIMMED + "," + MASKED


@query(
    "pt6_padded_slots",
    _ROWS
    + """ SELECT doc_id, copy, chunk, any_value(rnd)::BIGINT AS next_sentence_labels,
 array_to_string(list_resize(list(pos ORDER BY pos), 20, 0), ' ') AS masked_lm_positions,
 array_to_string(list_resize(list(label ORDER BY pos), 20, 0), ' ') AS masked_lm_ids,
 count(*)::BIGINT AS n_masked
FROM chosen JOIN rows USING (doc_id, copy, chunk) GROUP BY 1, 2, 3""",
)
def padded_slots(spark, sf):
    docs = table(spark, sf, "documents")
    rows = P.training_rows(docs, vocabulary(spark, sf), CFG, corpus=_corpus(spark, sf))
    n = F.aggregate("masked_lm_weights", F.lit(0.0), lambda a, w: a + w.cast("double"))
    return rows.select(
        "doc_id",
        "copy",
        "chunk",
        "next_sentence_labels",
        "masked_lm_positions",
        "masked_lm_ids",
        n.cast("long").alias("n_masked"),
    )


def _training(spark, sf):
    docs = table(spark, sf, "documents")
    return P.training_rows(docs, vocabulary(spark, sf), CFG)


def training_sql(cfg: P.PairConfig) -> str:
    parts = [Q.CORPUS, segments_sql(cfg), PLAN, PARTNERS, trimmed_sql(cfg), masked_sql(cfg)]
    return ",".join(parts) + f""", swapped AS (
  SELECT c.doc_id, c.copy, c.chunk, list(coalesce(m.new_id, c.id) ORDER BY c.pos) AS ids
  FROM cells c LEFT JOIN chosen m ON m.doc_id = c.doc_id AND m.copy = c.copy AND m.chunk = c.chunk AND m.pos = c.pos
  GROUP BY 1, 2, 3)
SELECT doc_id, copy, chunk, array_to_string(list_resize(s.ids, {cfg.max_length}, 0), ' ') AS input_ids,
 array_to_string(list_resize(list_transform(s.ids, lambda x: 1), {cfg.max_length}, 0), ' ') AS input_mask,
 array_to_string(list_resize(list_transform(s.ids, lambda x, i: CASE WHEN i > la + 2 THEN 1 ELSE 0 END), {cfg.max_length}, 0), ' ') AS segment_ids,
 rnd::BIGINT AS next_sentence_labels
FROM swapped s JOIN rows USING (doc_id, copy, chunk)"""


@query("pt7_training_rows", training_sql(CFG))
def training(spark, sf):
    return _training(spark, sf).select(
        "doc_id", "copy", "chunk", "input_ids", "input_mask", "segment_ids", "next_sentence_labels"
    )


@query(
    "snk1_round_robin",
    BASE + "," + PLAN
    + """ SELECT shard, count(*) AS n FROM (SELECT (row_number() OVER (
   ORDER BY """
    + Q.digest(S + "/order", "doc_id", "copy", "chunk")
    + """, doc_id, copy, chunk) - 1) % 8 AS shard FROM plan) GROUP BY 1""",
)
def round_robin(spark, sf):
    from textloom.operators.order import dense_index
    from textloom.sources.sinks import shard_numbers

    planned = P.chunk_plans(_corpus(spark, sf), CFG).select("doc_id", "copy", "chunk")
    order = [draw_hex(S + "/order", "doc_id", "copy", "chunk"), "doc_id", "copy", "chunk"]
    numbered = dense_index(planned, order, "instance_no")
    return shard_numbers(numbered, "instance_no", 8).groupBy("shard").agg(F.count("*").alias("n"))


@query(
    "pt8_smoothed_weights",
    """WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1),
s AS (SELECT lang, n, n / (SELECT sum(n) FROM c)::DOUBLE AS share FROM c)
SELECT lang, n, round(share, 6) AS share,
 round(pow(share, 0.7) / (SELECT sum(pow(share, 0.7)) FROM s), 6) AS weight FROM s""",
)
def smoothed_weights(spark, sf):
    return P.smoothed_weights(table(spark, sf, "documents"), "lang")


@query(
    "pt8_smoothed_sample",
    f"""WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1),
s AS (SELECT lang, n / (SELECT sum(n) FROM c)::DOUBLE AS share FROM c),
w AS (SELECT lang, pow(share, 0.7) / (SELECT sum(pow(share, 0.7)) FROM s) / share AS rate FROM s),
d AS (SELECT doc_id, lang, floor(rate)::BIGINT + (CASE WHEN {Q.bits(Q.digest('12345/sample', 'doc_id'))}
   < (rate - floor(rate)) * 4294967296 THEN 1 ELSE 0 END) AS copies FROM documents JOIN w USING (lang))
SELECT doc_id, lang, unnest(range(0, copies)) AS copy FROM d WHERE copies > 0""",
)
def smoothed_sample(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return P.smoothed_sample(docs, "lang", "doc_id").select("doc_id", "lang", "copy")


_NOISE = Q.digest("12345/noise", "doc_id", "unit")


@query(
    "pt9_truncated_segments",
    Q.with_parts(Q.LINES)
    + f""", t AS (SELECT doc_id, unit, {Q.words('line')} AS w FROM lines)
SELECT doc_id, unit::BIGINT AS unit, len(w)::BIGINT AS before, CASE WHEN {Q.bits(_NOISE)} < {int(0.02 * 2**32)} AND len(w) > 0
 THEN {Q.pick(_NOISE, 'len(w)', 1)} + 1 ELSE len(w) END::BIGINT AS after FROM t""".replace("lines) \n", ""),
)
def truncated_segments(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("unit", "line"))
    segments = lines.select("doc_id", "unit", X.words_of(F.col("line")).alias("w"))
    before = segments.withColumn("before", F.size("w"))
    cut = P.truncate_some(before, "w", ["doc_id", "unit"])
    return cut.select("doc_id", "unit", "before", F.size("w").alias("after"))


@query(
    "win4_running_length",
    Q.with_parts(Q.LINES)
    + f""", t AS (SELECT doc_id, unit, len({Q.words('line')}) AS n FROM lines)
SELECT doc_id, unit::BIGINT AS unit, sum(n) OVER (PARTITION BY doc_id ORDER BY unit)::BIGINT AS running FROM t""",
)
def running_length(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("unit", "line"))
    so_far = Window.partitionBy("doc_id").orderBy("unit").rowsBetween(Window.unboundedPreceding, 0)
    return lines.select("doc_id", "unit", F.sum(F.size(X.words_of(F.col("line")))).over(so_far).alias("running"))


@query(
    "win3_document_numbers",
    """SELECT doc_id, unit::BIGINT AS unit, sum(CASE WHEN trim(line) = '' OR line LIKE 'The%' THEN 1 ELSE 0 END)
 OVER (PARTITION BY doc_id ORDER BY unit)::BIGINT AS doc_no
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
 generate_subscripts(string_split(text, chr(10)), 1) - 1 AS unit FROM documents)""",
)
def document_numbers(spark, sf):
    from textloom.sources.readers import number_documents

    # The corpus has no blank lines; lines opening with "The" stand in for them.
    lines = table(spark, sf, "documents").select(
        F.col("doc_id").alias("file"), F.posexplode(F.split("text", "\n")).alias("line_no", "value")
    )
    marked = lines.withColumn("value", F.when(F.col("value").startswith("The"), "").otherwise(F.col("value")))
    return number_documents(marked).select(
        F.col("file").alias("doc_id"), F.col("line_no").alias("unit"), "doc_no"
    )
