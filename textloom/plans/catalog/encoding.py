"""Subword encoding and fixed-width assembly."""

from pyspark.sql import functions as F

from textloom.functions import arrays as A
from textloom.functions import text as X
from textloom.operators import sequences as S
from textloom.operators import subword as W
from textloom.plans import oracle_parts as Q
from textloom.plans.catalog.registry import query, table, vocabulary


def _units(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.unit_tokens(F.col("text")).alias("units"))


def _lines_with_pieces(spark, sf):
    text = X.spaced_text(F.col("text"), keep_lines=True)
    return W.encode_text(table(spark, sf, "documents"), ["doc_id"], text, vocabulary(spark, sf), with_pieces=True)


@query("src05_vocabulary", Q.with_parts(Q.VOCAB) + "SELECT token, token_id FROM vocab")
def vocab_table(spark, sf):
    return vocabulary(spark, sf).select("token", "token_id")


@query(
    "tok1_word_pieces",
    Q.with_parts(Q.LINES, Q.line_words(), Q.VOCAB, Q.dictionary())
    + """SELECT word, (SELECT count(*) FROM occ o WHERE o.word = d.word) AS n,
 string_agg(piece, ' ' ORDER BY k) AS pieces, string_agg(id::VARCHAR, ' ' ORDER BY k) AS ids
FROM dict d GROUP BY word""",
)
def word_pieces(spark, sf):
    return W.word_dictionary(_units(spark, sf), "units", vocabulary(spark, sf)).select(
        "word", "n", "pieces", "ids"
    )


@query(
    "jn7_longest_match",
    Q.with_parts(Q.LINES, Q.line_words(), Q.VOCAB, Q.dictionary())
    + 'SELECT word, s::BIGINT AS start, e::BIGINT AS "end" FROM dbest',
)
def longest(spark, sf):
    vocab = vocabulary(spark, sf)
    counts = W.word_counts(_units(spark, sf), "units")
    found = W.longest_matches(counts.select("word"), vocab, W.vocab_facts(vocab))
    return found.filter("best is not null").select(
        "word", "start", F.shiftright("best", 32).alias("end")
    )


@query(
    "tok2_full_tokens",
    Q.CORPUS
    + """ SELECT d.doc_id, count(pno)::BIGINT AS n,
 md5(coalesce(string_agg(piece, ' ' ORDER BY pno), '')) AS pieces,
 md5(coalesce(string_agg(id::VARCHAR, ' ' ORDER BY pno), '')) AS ids
FROM documents d LEFT JOIN enc e ON e.doc_id = d.doc_id GROUP BY 1""",
)
def full_tokens(spark, sf):
    enc = _lines_with_pieces(spark, sf)
    return enc.select(
        "doc_id",
        F.size("ids").alias("n"),
        F.md5(F.array_join("pieces", " ")).alias("pieces"),
        F.md5(A.text_of(F.col("ids"))).alias("ids"),
    )


_PIECES = Q.CORPUS + """, p AS (
  SELECT doc_id, unit, string_agg({0}, ' ' ORDER BY wpos, k) AS v FROM enc GROUP BY 1, 2)
SELECT doc_id, unit::BIGINT AS unit, md5(v) AS digest FROM p"""


def _lines_encoded(spark, sf):
    """Pieces per line, exploded from one encoding of each document."""
    enc = _lines_with_pieces(spark, sf)
    parts = enc.select(
        "doc_id", F.posexplode(F.arrays_zip("piece_units", "ids", "pieces")).alias("pos", "p")
    )
    return parts.groupBy("doc_id", F.col("p.piece_units").alias("unit")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "p.ids", "p.pieces"))).alias("l")
    ).select("doc_id", "unit", F.col("l.ids").alias("ids"), F.col("l.pieces").alias("pieces"))


@query("jn1_tokens_to_ids", _PIECES.replace("{0}", "id::VARCHAR"))
def tokens_to_ids(spark, sf):
    rows = _lines_encoded(spark, sf).select("doc_id", "unit", "pieces")
    ids = W.tokens_to_ids(rows, ["doc_id", "unit"], "pieces", vocabulary(spark, sf))
    return ids.select("doc_id", "unit", F.md5(A.text_of(F.col("pieces"))).alias("digest"))


@query("jn2_ids_to_tokens", _PIECES.replace("{0}", "piece"))
def ids_to_tokens(spark, sf):
    rows = _lines_encoded(spark, sf).select("doc_id", "unit", "ids")
    tokens = W.ids_to_tokens(rows, ["doc_id", "unit"], "ids", vocabulary(spark, sf))
    return tokens.select("doc_id", "unit", F.md5(F.array_join("ids", " ")).alias("digest"))


@query(
    "tok3_missing_tokens",
    Q.with_parts(Q.LINES, Q.line_words(), Q.VOCAB)
    + "SELECT word AS token, count(*) AS n FROM occ WHERE word NOT IN (SELECT token FROM vocab) GROUP BY 1",
)
def missing(spark, sf):
    rows = _units(spark, sf).select(F.col("units.word").alias("tokens"))
    return W.missing_tokens(rows, "tokens", vocabulary(spark, sf))


# Word positions: every basic token is its own unit here.
def _word_units(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        "lang",
        F.transform(
            X.basic_tokens(F.col("text")), lambda w, i: F.struct(i.alias("unit"), w.alias("word"))
        ).alias("units"),
    )


@query(
    "tok4_alignment",
    Q.CORPUS
    + """, w AS (SELECT doc_id, unit, wpos, min(pno) - 1 AS first_piece, count(*) AS n_pieces
 FROM enc GROUP BY 1, 2, 3)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY unit, wpos) - 1 AS unit,
 first_piece, n_pieces FROM w""",
)
def align(spark, sf):
    text = X.spaced_text(F.col("text"))
    enc = W.encode_text(table(spark, sf, "documents"), ["doc_id"], text, vocabulary(spark, sf), by_word=True)
    return W.alignment(enc, ["doc_id"])


@query(
    "tok5_project_labels",
    Q.CORPUS
    + """ SELECT doc_id, md5(string_agg(CASE WHEN length(word) > 6 THEN 'L' ELSE 'S' END, '' ORDER BY pno)) AS digest
FROM enc GROUP BY 1""",
)
def project_labels(spark, sf):
    words = _word_units(spark, sf)
    enc = W.encode(words, ["doc_id"], "units", vocabulary(spark, sf))
    labels = words.select(
        "doc_id",
        F.transform("units", lambda u: F.when(F.length(u["word"]) > 6, "L").otherwise("S")).alias("label"),
    )
    rows = W.project_labels(enc.join(labels, "doc_id"), "label").filter(F.size("ids") > 0)
    return rows.select("doc_id", F.md5(F.array_join("piece_label", "")).alias("digest"))


# Pairs: each turn of a conversation with the turn after it.
PAIRS = """
turns AS (
  SELECT conv_id, turn, text AS text_a,
         lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS text_b
  FROM conversations),
occ AS MATERIALIZED (
  SELECT conv_id * 1000 + turn AS doc_id, 0 AS unit, unnest(t) AS word, generate_subscripts(t, 1) AS wpos
  FROM (SELECT *, {0} AS t FROM turns)
  UNION ALL
  SELECT conv_id * 1000 + turn, 1, unnest(t), generate_subscripts(t, 1)
  FROM (SELECT *, {1} AS t FROM turns WHERE text_b IS NOT NULL))""".format(
    Q.tokens("text_a"), Q.tokens("text_b")
)


def pair_sql(width: int) -> str:
    """Truncate, bracket and pad pairs: pieces (rank per side) and sizes."""
    return Q.with_parts(PAIRS, Q.VOCAB, Q.dictionary(), Q.ENCODED) + f""", ranked AS (
  SELECT doc_id, unit, piece, id, row_number() OVER (PARTITION BY doc_id, unit ORDER BY wpos, k) AS r FROM enc),
sizes AS (
  SELECT conv_id * 1000 + turn AS doc_id, count(*) FILTER (unit = 0) AS la, count(*) FILTER (unit = 1) AS lb
  FROM turns LEFT JOIN ranked ON doc_id = conv_id * 1000 + turn GROUP BY 1),
keep AS (
  SELECT doc_id, lb,
    CASE WHEN lb = 0 THEN least(la, {width} - 2)
         ELSE least(la, greatest({width - 3} - lb, {width - 3 - (width - 3) // 2})) END AS ka,
    CASE WHEN lb = 0 THEN 0 ELSE least(lb, greatest({width - 3} - la, {(width - 3) // 2})) END AS kb
  FROM sizes),
body AS (
  SELECT doc_id, 0 AS pos, '[CLS]' AS piece, 2 AS id, 0 AS seg FROM keep
  UNION ALL SELECT doc_id, r, piece, id, 0 FROM ranked JOIN keep USING (doc_id) WHERE unit = 0 AND r <= ka
  UNION ALL SELECT doc_id, ka + 1, '[SEP]', 3, 0 FROM keep
  UNION ALL SELECT doc_id, ka + 1 + r, piece, id, 1 FROM ranked JOIN keep USING (doc_id) WHERE unit = 1 AND r <= kb
  UNION ALL SELECT doc_id, ka + kb + 2, '[SEP]', 3, 1 FROM keep WHERE lb > 0)"""


def _turns(spark, sf):
    from pyspark.sql.window import Window

    by_turn = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.col("text").alias("text_a"),
        F.lead("text").over(by_turn).alias("text_b"),
    )


@query(
    "seq7_pair_features",
    pair_sql(64)
    + """ SELECT doc_id // 1000 AS conv_id, doc_id % 1000 AS turn,
 array_to_string(list_resize(list(id ORDER BY pos), 64, 0), ' ') AS input_ids,
 array_to_string(list_resize(list(1 ORDER BY pos), 64, 0), ' ') AS input_mask,
 array_to_string(list_resize(list(seg ORDER BY pos), 64, 0), ' ') AS segment_ids,
 string_agg(piece, ' ' ORDER BY pos) AS tokens
FROM body GROUP BY doc_id""",
)
def pair_features(spark, sf):
    return S.encode_pairs(
        _turns(spark, sf), ["conv_id", "turn"], 64, vocabulary(spark, sf), with_tokens=True
    ).select("conv_id", "turn", "input_ids", "input_mask", "segment_ids", "tokens")


SINGLE = "occ AS MATERIALIZED (SELECT doc_id, 0 AS unit, unnest(t) AS word, generate_subscripts(t, 1) AS wpos" \
    f" FROM (SELECT doc_id, {Q.tokens('text')} AS t FROM documents JOIN labels USING (doc_id)))"


@query(
    "seq6_class_features",
    Q.with_parts(SINGLE, Q.VOCAB, Q.dictionary(), Q.ENCODED)
    + """, body AS (
  SELECT doc_id, 0 AS pos, 2 AS id FROM labels JOIN documents USING (doc_id)
  UNION ALL SELECT doc_id, pno, id FROM enc WHERE pno <= 126
  UNION ALL SELECT l.doc_id, (SELECT least(count(*), 126) + 1 FROM enc e WHERE e.doc_id = l.doc_id), 3
  FROM labels l JOIN documents USING (doc_id))
SELECT doc_id, array_to_string(list_resize(list(id ORDER BY pos), 128, 0), ' ') AS input_ids,
 count(*)::BIGINT AS n, any_value(quality)::BIGINT AS label_ids
FROM body JOIN labels USING (doc_id) GROUP BY doc_id""",
)
def class_features(spark, sf):
    docs, marks = table(spark, sf, "documents"), table(spark, sf, "labels")
    examples = docs.join(marks, "doc_id").select(
        "doc_id",
        F.col("text").alias("text_a"),
        F.lit(None).cast("string").alias("text_b"),
        F.col("quality").cast("string").alias("label"),
    )
    labels = label_ids(spark, sf)
    rows = S.classification_features(examples, ["doc_id"], labels, 128, vocabulary(spark, sf))
    total = F.aggregate("input_mask", F.lit(0), lambda a, v: a + v)
    return rows.select("doc_id", "input_ids", total.alias("n"), "label_ids")


def label_ids(spark, sf):
    """Distinct quality values in order, numbered from 0."""
    from pyspark.sql.window import Window

    values = table(spark, sf, "labels").select(F.col("quality").cast("string").alias("label")).distinct()
    number = F.row_number().over(Window.orderBy("label")) - 1
    return values.withColumn("label_id", number)


# Token arrays of one-word strings are enough to compare the pure array steps.
_LINE_PAIRS = """t AS (
  SELECT conv_id, turn, {0} AS a, {1} AS b FROM (
    SELECT conv_id, turn, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next FROM conversations)
  WHERE next IS NOT NULL)""".format(Q.words("text"), Q.words("next"))


def _word_pairs(spark, sf):
    return _turns(spark, sf).filter("text_b is not null").select(
        "conv_id", "turn", X.words_of(F.col("text_a")).alias("a"), X.words_of(F.col("text_b")).alias("b")
    )


@query(
    "seq1_truncate_pair",
    "WITH " + _LINE_PAIRS + """, k AS (SELECT *, least(len(a), greatest(40 - len(b), 20)) AS ka,
 least(len(b), greatest(40 - len(a), 20)) AS kb FROM t)
SELECT conv_id, turn, array_to_string(a[1:ka], ' ') AS a, array_to_string(b[1:kb], ' ') AS b FROM k""",
)
def truncate_pair(spark, sf):
    a, b = S.truncate_pair(F.col("a"), F.col("b"), 40)
    return _word_pairs(spark, sf).select("conv_id", "turn", a.alias("a"), b.alias("b"))


@query(
    "seq2_truncate_single",
    f"SELECT doc_id, array_to_string(({Q.words('text')})[1:62], ' ') AS tokens FROM documents",
)
def truncate_single(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", A.head(X.words_of(F.col("text")), 62).alias("tokens")
    )


_HEADS = (
    "len(list_filter(range(1, (len({0}) - k{0}) + 1), lambda i: "
    "substr(md5('s/trim_{0}|' || conv_id || '|' || turn || '|' || i), 1, 1) < '8'))"
)


@query(
    "seq3_random_truncate",
    "WITH " + _LINE_PAIRS + f""", k AS (SELECT *, least(len(a), greatest(40 - len(b), 20)) AS ka,
 least(len(b), greatest(40 - len(a), 20)) AS kb FROM t),
h AS (SELECT *, {_HEADS.format('a')} AS ha, {_HEADS.format('b')} AS hb FROM k)
SELECT conv_id, turn, array_to_string(a[ha + 1:ha + ka], ' ') AS a, array_to_string(b[hb + 1:hb + kb], ' ') AS b FROM h""",
)
def random_truncate(spark, sf):
    ka, kb = A.pair_lengths(F.size("a"), F.size("b"), 40)
    keys = ["conv_id", "turn"]
    return _word_pairs(spark, sf).select(
        *keys,
        S.random_truncate(F.col("a"), ka, "s/trim_a", *keys).alias("a"),
        S.random_truncate(F.col("b"), kb, "s/trim_b", *keys).alias("b"),
    )


@query(
    "seq4_bracket",
    "WITH " + _LINE_PAIRS + """ SELECT conv_id, turn,
 '[CLS] ' || array_to_string(a, ' ') || ' [SEP] ' || array_to_string(b, ' ') || ' [SEP]' AS tokens,
 (repeat('0', len(a)::INT + 2) || repeat('1', len(b)::INT + 1)) AS marks FROM t WHERE len(a) > 0 AND len(b) > 0""",
)
def bracket(spark, sf):
    rows = _word_pairs(spark, sf).filter((F.size("a") > 0) & (F.size("b") > 0))
    return rows.select(
        "conv_id",
        "turn",
        A.bracketed(F.col("a"), F.col("b"), F.lit("[CLS]"), F.lit("[SEP]")).alias("tokens"),
        F.array_join(A.segment_marks(F.col("a"), F.col("b")).cast("array<string>"), "").alias("marks"),
    )


@query(
    "seq5_mask_and_pad",
    "WITH " + _LINE_PAIRS + """ SELECT conv_id, turn,
 array_to_string(list_resize(a[1:30], 32, '-'), ' ') AS padded,
 repeat('1', least(len(a), 30)::INT) || repeat('0', (32 - least(len(a), 30))::INT) AS mask FROM t""",
)
def mask_and_pad(spark, sf):
    head = A.head(F.col("a"), 30)
    mask = A.pad(F.array_repeat(F.lit("1"), F.size(head)), 32, F.lit("0"))
    return _word_pairs(spark, sf).select(
        "conv_id", "turn", A.pad(head, 32, F.lit("-")).alias("padded"), F.array_join(mask, "").alias("mask")
    )
