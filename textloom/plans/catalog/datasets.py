"""Labelled dataset builds from `documents`, `labels` and `conversations`."""

from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators import labels as L
from textloom.operators.order import dense_index
from textloom.operators.sequences import attach_label_ids, unknown_labels
from textloom.plans import datasets as D
from textloom.plans import oracle_parts as Q
from textloom.plans.catalog.encoding import label_ids
from textloom.plans.catalog.normalise import ASCII, FLAT, lowered_sql
from textloom.plans.catalog.registry import query, table

TAGS = ["origin", "topic"]


def tagged_documents(spark, sf):
    """Documents as tagged records; short ones have no origin tag."""
    return table(spark, sf, "documents").select(
        "doc_id",
        F.array("text").alias("text"),
        F.when(F.col("n_chars") >= 400, F.array("source")).alias("origin"),
        F.array("lang", F.concat_ws("  ", "lang", "source")).alias("topic"),
    )


ROWS = """
tagged AS (
  SELECT doc_id, 'origin' AS tag, 0 AS label_no, source AS label, text FROM documents WHERE n_chars >= 400 AND text <> ''
  UNION ALL SELECT doc_id, 'topic', 0, lang, text FROM documents WHERE text <> ''
  UNION ALL SELECT doc_id, 'topic', 1, lang || '_' || source, text FROM documents WHERE text <> ''),
tallies AS (SELECT tag, label, count(*) AS n FROM tagged GROUP BY 1, 2),
top AS (
  SELECT tag, label, n, row_number() OVER (PARTITION BY tag ORDER BY n DESC, label) - 1 AS label_id
  FROM tallies QUALIFY label_id < 5)"""


def _rows(spark, sf):
    return L.explode_labels(L.has_text(tagged_documents(spark, sf)), TAGS, ["doc_id"])


@query(
    "lbl1_explode_labels",
    "WITH " + ROWS + " SELECT doc_id, tag, label_no::BIGINT AS label_no, label, md5(text) AS text FROM tagged",
)
def explode_labels(spark, sf):
    return _rows(spark, sf).select("doc_id", "tag", "label_no", "label", F.md5("text").alias("text"))


@query("agg1_label_counts", "WITH " + ROWS + " SELECT tag, label, n FROM tallies")
def label_counts(spark, sf):
    return L.label_counts(_rows(spark, sf))


@query("agg2_smallest_top_count", "WITH " + ROWS + " SELECT tag, min(n) AS n FROM top GROUP BY 1")
def smallest(spark, sf):
    return L.smallest_count(L.top_labels(_rows(spark, sf), 5))


@query("agg3_label_names", "WITH " + ROWS + " SELECT DISTINCT tag, label FROM tagged")
def names(spark, sf):
    return L.label_names(_rows(spark, sf))


@query("top1_top_labels", "WITH " + ROWS + " SELECT tag, label, n, label_id FROM top")
def top_labels(spark, sf):
    return L.top_labels(_rows(spark, sf), 5)


@query(
    "jn10_listed_labels_only",
    "WITH " + ROWS + " SELECT tag, label, label_id, count(*) AS n FROM tagged JOIN top USING (tag, label) GROUP BY 1, 2, 3",
)
def listed_only(spark, sf):
    rows = _rows(spark, sf)
    kept = L.restrict_labels(rows, L.top_labels(rows, 5), keep_other=False)
    return kept.groupBy("tag", "label", "label_id").agg(F.count("*").alias("n"))


@query(
    "lbl2_remainder_label",
    "WITH " + ROWS + """ SELECT t.tag, coalesce(top.label, 'other_remainder') AS label, coalesce(label_id, 5) AS label_id,
 count(*) AS n FROM tagged t LEFT JOIN top ON top.tag = t.tag AND top.label = t.label GROUP BY 1, 2, 3""",
)
def remainder(spark, sf):
    rows = _rows(spark, sf)
    kept = L.restrict_labels(rows, L.top_labels(rows, 5), keep_other=True)
    return kept.groupBy("tag", "label", "label_id").agg(F.count("*").alias("n"))


@query(
    "lbl3_label_list",
    "WITH " + ROWS + """ SELECT tag, label, label_id FROM top
UNION ALL SELECT tag, 'other_remainder', 5 FROM tallies GROUP BY 1 HAVING count(*) > 5""",
)
def label_list(spark, sf):
    rows = _rows(spark, sf)
    return L.selected_labels(rows, L.top_labels(rows, 5), keep_other=True)


_TEXT = Q.squeeze(ASCII.format(f"array_to_string(({Q.sentences(FLAT)})[1:40], ' ')"))
_SPLIT = """
kept AS (
  SELECT t.*, label_id, row_number() OVER (PARTITION BY t.tag ORDER BY doc_id, label_no) - 1 AS r,
    count(*) OVER (PARTITION BY t.tag) AS size FROM tagged t JOIN top ON top.tag = t.tag AND top.label = t.label)"""


@query(
    "lbl4_tagged_dataset",
    "WITH " + ROWS + "," + _SPLIT + f""" SELECT doc_id, tag, label_no::BIGINT AS label_no, label, label_id,
 CASE WHEN r < round_even(size * 0.85::DOUBLE, 0) THEN 'train' ELSE 'test' END AS split, md5({_TEXT}) AS inputs FROM kept""",
)
def tagged_dataset(spark, sf):
    rows, _ = D.tagged_dataset(tagged_documents(spark, sf), TAGS)
    return rows.withColumn("inputs", F.md5("inputs"))


@query(
    "lbl4_fine_tune_variant",
    "WITH " + ROWS + f""" SELECT doc_id, tag, label, label_id, md5({_TEXT}) AS text
FROM tagged JOIN top USING (tag, label)""",
)
def fine_tune_variant(spark, sf):
    rows, _ = D.tagged_dataset(tagged_documents(spark, sf), TAGS, split=False)
    return rows.select("doc_id", "tag", "label", "label_id", F.md5("inputs").alias("text"))


def _delete(x: str, chars: str) -> str:
    return f"translate({x}, '{chars}', '')"


_NOT = Q.SPACE.replace("[", "[^", 1)
_BARE = "text"
for _opening in ("http", "@", "#"):
    _BARE = f"regexp_replace({_BARE}, '{_opening}{_NOT}+', '', 'g')"
_TWEET = "list_transform({}, lambda t: {})".format(
    Q.words(Q.space_punctuation(_BARE)), _delete("t", X.TWEET_PUNCTUATION)
)
_ROLE = "CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 4 ELSE 2 END"


@query(
    "lbl5_tweet_dataset",
    f"""SELECT conv_id, turn, md5({lowered_sql(_TWEET, False)}) AS inputs, ({_ROLE})::BIGINT AS label
FROM conversations WHERE {_ROLE} IN (0, 4)""",
)
def tweet_dataset(spark, sf):
    label = F.when(F.col("role") == "user", 0).when(F.col("role") == "assistant", 4).otherwise(2)
    tweets = table(spark, sf, "conversations").withColumn("label", label)
    return D.tweet_dataset(tweets, ["conv_id", "turn"]).withColumn("inputs", F.md5("inputs"))


def _review_sql(body: str, limit: int) -> str:
    words = "list_filter(list_transform({}, lambda t: {}), lambda t: t <> 'br')".format(
        Q.words(Q.space_punctuation(body)), _delete("t", X.REVIEW_PUNCTUATION)
    )
    return f"""WITH t AS (SELECT doc_id, quality, {words} AS w FROM documents JOIN labels USING (doc_id))
SELECT doc_id, md5({lowered_sql('w', True)}) AS inputs, quality::BIGINT AS label FROM t WHERE len(w) < {limit}"""


def _reviews(spark, sf):
    docs, marks = table(spark, sf, "documents"), table(spark, sf, "labels")
    return docs.join(marks, "doc_id").withColumn("label", F.col("quality"))


@query("lbl6_review_dataset", _review_sql(f"array_to_string({Q.sentences('text')}, ' ')", 10000))
def review_dataset(spark, sf):
    return D.review_dataset(_reviews(spark, sf), ["doc_id"], max_tokens=10000).withColumn("inputs", F.md5("inputs"))


@query("top6_first_sentence_reviews", _review_sql(f"coalesce(({Q.sentences('text')})[1], '')", 512))
def first_sentence(spark, sf):
    rows = D.review_dataset(_reviews(spark, sf), ["doc_id"], first_sentence_only=True, max_tokens=512)
    return rows.withColumn("inputs", F.md5("inputs"))


@query(
    "top5_first_sentences",
    f"SELECT doc_id, len(s)::BIGINT AS n, md5(array_to_string(s[1:40], ' ')) AS head FROM (SELECT doc_id, {Q.sentences('text')} AS s FROM documents)",
)
def first_sentences(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", X.sentences(F.col("text")).alias("s"))
    return rows.select(
        "doc_id", F.size("s").alias("n"), F.md5(F.array_join(F.slice("s", 1, 40), " ")).alias("head")
    )


@query(
    "prj12_token_limit",
    f"SELECT doc_id, len({Q.words('text')})::BIGINT AS n FROM documents WHERE len({Q.words('text')}) < 512",
)
def token_limit(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", X.words_of(F.col("text")).alias("words"))
    return D.shorter_than(rows, "words", 512).select("doc_id", F.size("words").alias("n"))


_SHUFFLE = Q.digest("12345/shuffle", "doc_id")


@query(
    "smp1_shuffled_order",
    f"SELECT doc_id, row_number() OVER (ORDER BY {_SHUFFLE}, doc_id) - 1 AS place FROM documents",
)
def shuffled_order(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    return L.shuffled(docs, ["doc_id"])


_BALANCE = Q.digest("12345/balance", "doc_id")
_RANKED = f"""WITH r AS (
  SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {_BALANCE}, doc_id) - 1 AS rank FROM labels),
c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1)"""


@query(
    "smp2_balance_down",
    _RANKED + " SELECT doc_id, quality::BIGINT AS quality FROM r WHERE rank < (SELECT min(n) FROM c)",
)
def balance_down(spark, sf):
    rows = table(spark, sf, "labels").select("doc_id", "quality")
    return L.balance_down(rows, "quality", ["doc_id"])


@query(
    "set1_balance_with_replacement",
    _RANKED + f""", p AS (SELECT quality, n, unnest(range(0, 150)) AS draw_no FROM c),
q AS (SELECT quality, draw_no, {Q.pick(Q.digest('12345/replace', 'quality', 'draw_no'), 'n')} AS rank FROM p)
SELECT doc_id, quality::BIGINT AS quality, draw_no FROM q JOIN r USING (quality, rank)""",
)
def balance_to(spark, sf):
    rows = table(spark, sf, "labels").select("doc_id", "quality")
    return L.balance_to(rows, "quality", ["doc_id"], 150)


@query(
    "smp3_positional_split",
    """SELECT doc_id, lang, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1
 < round_even(count(*) OVER (PARTITION BY lang) * 0.85::DOUBLE, 0) THEN 'train' ELSE 'test' END AS split FROM documents""",
)
def positional(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return L.positional_split(docs, ["lang"], ["doc_id"], 0.85)


@query(
    "smp3_hashed_split",
    f"""SELECT doc_id, CASE WHEN {Q.bits(Q.digest('12345/split', 'doc_id'))} < {int(0.85 * 2**32)}
 THEN 'train' ELSE 'test' END AS split FROM documents""",
)
def hashed(spark, sf):
    return L.hashed_split(table(spark, sf, "documents").select("doc_id"), ["doc_id"], 0.85)


@query(
    "smp4_batches",
    """WITH n AS (SELECT conv_id, turn, (row_number() OVER (ORDER BY conv_id, turn) - 1) // 32 AS batch_no FROM conversations)
SELECT batch_no, count(*) AS n, min(conv_id * 1000 + turn) AS first FROM n GROUP BY 1""",
)
def batches(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn")
    return L.batches(rows, ["conv_id", "turn"], 32).groupBy("batch_no").agg(
        F.count("*").alias("n"), F.min(F.col("conv_id") * 1000 + F.col("turn")).alias("first")
    )


@query(
    "smp4_full_batches",
    """WITH n AS (SELECT (row_number() OVER (ORDER BY conv_id, turn) - 1) // 32 AS batch_no FROM conversations)
SELECT batch_no, count(*) AS n FROM n GROUP BY 1 HAVING count(*) = 32""",
)
def full_batches(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn")
    full = L.batches(rows, ["conv_id", "turn"], 32, drop_last=True)
    return full.groupBy("batch_no").agg(F.count("*").alias("n"))


@query(
    "prj8_row_range",
    """SELECT doc_id, r AS row_no FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS r FROM documents)
WHERE r BETWEEN 31 AND 150""",
)
def row_range(spark, sf):
    return L.row_range(table(spark, sf, "documents").select("doc_id"), ["doc_id"], 31, 150)


@query("prj9_prefix", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT (SELECT count(*) // 3 FROM documents)")
def prefix(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return L.prefix(docs, ["doc_id"], docs.count() // 3)


@query(
    "win1_row_guid",
    "SELECT conv_id, turn, 'train-' || (row_number() OVER (ORDER BY conv_id, turn) - 1) AS guid FROM conversations",
)
def row_guid(spark, sf):
    rows = dense_index(table(spark, sf, "conversations").select("conv_id", "turn"), ["conv_id", "turn"], "i")
    return rows.select("conv_id", "turn", L.guid("train", F.col("i")).alias("guid"))


@query("src12_label_list", "SELECT quality::VARCHAR AS label, row_number() OVER (ORDER BY quality) - 1 AS label_id FROM (SELECT DISTINCT quality FROM labels)")
def quality_labels(spark, sf):
    return label_ids(spark, sf)


@query("jn3_label_ids", "SELECT doc_id, dense_rank() OVER (ORDER BY quality) - 1 AS label_ids FROM labels")
def join_label_ids(spark, sf):
    rows = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("label"))
    return attach_label_ids(rows, label_ids(spark, sf)).select("doc_id", "label_ids")


@query(
    "jn3_unknown_labels",
    "SELECT source AS label, count(*) AS n FROM documents WHERE source NOT IN (SELECT quality::VARCHAR FROM labels) GROUP BY 1",
)
def unknown(spark, sf):
    rows = table(spark, sf, "documents").select(F.col("source").alias("label"))
    return unknown_labels(rows, label_ids(spark, sf))
