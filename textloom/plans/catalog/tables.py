"""Row layouts, filters and keyed updates on the driver tables."""

from pyspark.sql import functions as F

from textloom.operators import upserts as U
from textloom.operators.labels import drop_missing, guid, has_text, keep_labels, raw_labels
from textloom.operators.sequences import decode_features
from textloom.plans.catalog.datasets import tagged_documents
from textloom.plans.catalog.registry import new_folder, query, table
from textloom.sources.layouts import Layout, apply_layout, comma_rows
from textloom.sources.readers import split_pair
from textloom.sources.sinks import write_features

_LINE = "replace(replace(text, chr(10), ' '), chr(13), ' ')"


@query(
    "src6_text_pairs",
    f"""WITH l AS (SELECT conv_id, turn, role, trim(CASE WHEN role = 'user' THEN role || ' ||| ' || {_LINE} || ' ||| ' || role
  ELSE {_LINE} END) AS line FROM conversations)
SELECT conv_id, turn, md5(CASE WHEN line LIKE '% ||| %' THEN regexp_extract(line, '^(.*) \\|\\|\\| (.*)$', 1) ELSE line END) AS text_a,
 CASE WHEN line LIKE '% ||| %' THEN regexp_extract(line, '^(.*) \\|\\|\\| (.*)$', 2) END AS text_b FROM l""",
)
def text_pairs(spark, sf):
    line = F.translate("text", "\n\r", "  ")
    paired = F.when(F.col("role") == "user", F.concat_ws(" ||| ", "role", line, "role")).otherwise(line)
    rows = table(spark, sf, "conversations").withColumn("line", paired)
    split = rows.select("conv_id", "turn", *split_pair(F.col("line")))
    return split.withColumn("text_a", F.md5("text_a"))


@query("src10_has_text", "SELECT doc_id FROM documents WHERE text IS NULL OR text <> ''")
def non_empty(spark, sf):
    return has_text(tagged_documents(spark, sf)).select("doc_id")


@query("src10_empty_texts", "SELECT doc_id FROM documents WHERE n_chars % 3 <> 0")
def empty_texts(spark, sf):
    """A third of the texts is empty, a third missing; missing ones stay."""
    kind = F.col("n_chars") % 3
    text = F.when(kind == 0, "").when(kind == 1, F.col("text"))
    rows = table(spark, sf, "documents").select("doc_id", text.alias("text"))
    listed = rows.select("doc_id", F.when(F.col("text").isNotNull(), F.array(F.lit("a"), "text")).alias("text"))
    return has_text(rows).join(has_text(listed), "doc_id").select("doc_id")


@query(
    "src11_decode_features",
    """SELECT vec_id, array_to_string(list_transform(embedding, lambda e: round(e::DOUBLE * 1000)::BIGINT), ' ') AS input_ids,
 label::BIGINT AS label_ids FROM embeddings""",
)
def decode(spark, sf):
    wide = F.transform("embedding", lambda e: F.round(e.cast("double") * 1000).cast("long"))
    stored = table(spark, sf, "embeddings").select(
        "vec_id", wide.alias("input_ids"), F.col("label").cast("long").alias("label_ids")
    )
    return decode_features(stored, {"input_ids": 64})


@query(
    "prj1_row_layout",
    """SELECT 'train-' || event_id AS guid, event_type AS text_a, props AS text_b, user_id::VARCHAR AS label FROM events""",
)
def row_layout(spark, sf):
    fields = F.array(F.col("event_id").cast("string"), "event_type", "props", F.col("user_id").cast("string"))
    rows = table(spark, sf, "events").select(F.col("event_id").alias("line_no"), fields.alias("fields"))
    return apply_layout(rows, Layout(1, 2, -1, row_id=0), "train")


@query(
    "prj4_recode",
    """SELECT event_id, CASE event_type WHEN 'error' THEN 'failure' ELSE event_type END AS label FROM events""",
)
def recode(spark, sf):
    fields = F.array("event_type")
    rows = table(spark, sf, "events").select(F.col("event_id").alias("line_no"), fields.alias("fields"))
    layout = Layout(0, label=0, recode=(("error", "failure"),))
    out = apply_layout(rows, layout, "train")
    return out.select(F.substring_index("guid", "-", -1).cast("long").alias("event_id"), "label")


@query("prj5_language", "SELECT 'dev-' || doc_id AS guid, md5(text) AS text_a, source AS label FROM documents WHERE lang = 'de'")
def language(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("line_no"), F.array("lang", "source", "text").alias("fields")
    )
    rows = apply_layout(docs, Layout(2, label=1, keep=(0, "de")), "dev")
    return rows.select("guid", F.md5("text_a").alias("text_a"), "label")


@query(
    "prj6_comma_rows",
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
  generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
f AS (SELECT doc_id, line_no, string_split(string_split(line, chr(9))[1], ',') AS f FROM l)
SELECT doc_id, line_no::BIGINT AS line_no, f[2] AS text_a, f[3] AS label FROM f WHERE len(f) = 3""",
)
def comma(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "value"))
    rows = comma_rows(lines)
    return rows.select(
        "doc_id", "line_no", F.get("fields", F.lit(1)).alias("text_a"), F.get("fields", F.lit(2)).alias("label")
    )


@query("prj10_guid", "SELECT event_id, 'test-' || event_id AS guid FROM events")
def guids(spark, sf):
    return table(spark, sf, "events").select("event_id", guid("test", F.col("event_id")).alias("guid"))


@query("prj11_label_whitelist", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')")
def whitelist(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "event_type")
    return keep_labels(rows, "event_type", ["click", "purchase"])


@query("prj13_drop_null_tags", "SELECT doc_id, source FROM documents WHERE n_chars >= 400 AND text IS NOT NULL")
def drop_null_tags(spark, sf):
    rows = drop_missing(tagged_documents(spark, sf), "origin")
    return rows.select("doc_id", F.get("origin", F.lit(0)).alias("source"))


@query(
    "jn6_labels_back_to_text",
    """SELECT doc_id, lang AS label, md5(text) AS text FROM documents
UNION ALL SELECT doc_id, lang || '  ' || source, md5(text) FROM documents""",
)
def labels_back(spark, sf):
    rows = raw_labels(tagged_documents(spark, sf), ["topic"], ["doc_id"])
    return rows.select("doc_id", "label", F.md5("text").alias("text"))


@query(
    "agg9_written_counts",
    "SELECT lang, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents GROUP BY 1",
)
def counters(spark, sf):
    docs = table(spark, sf, "documents").select("lang", F.length("text").alias("chars"))
    path = new_folder(spark, "counted")
    written = write_features(docs, path)
    back = spark.read.parquet(path)
    if back.count() != written:
        raise ValueError("rows written and rows counted differ")
    return back.groupBy("lang").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))


@query(
    "top4_sorted_positions",
    f"""SELECT doc_id, array_to_string(list_sort(list_transform(string_split(text, chr(10)), lambda s: length(s))), ' ') AS sizes
FROM documents""",
)
def sorted_positions(spark, sf):
    sizes = F.transform(F.split("text", "\n"), lambda s: F.length(s))
    return table(spark, sf, "documents").select("doc_id", F.array_sort(sizes).alias("sizes"))


def changes(spark, sf):
    """Events as a change log: purchases are feedback, the rest inferences."""
    e = table(spark, sf, "events")
    feedback = F.col("event_type") == "purchase"
    return e.select(
        F.when(feedback, "feedback").otherwise("infer").alias("kind"),
        F.concat(F.lit("http://site/"), F.col("user_id").cast("string")).alias("url"),
        F.col("props").alias("payload"),
        F.col("event_type").alias("recommendation"),
        F.col("value").cast("string").alias("golden_standard"),
        F.unix_timestamp("ts").alias("ts"),
        F.col("event_id").alias("seq"),
    )


_LOG = """WITH log AS (
  SELECT md5('http://site/' || user_id) AS _id, 'http://site/' || user_id AS url, event_type, props, value::VARCHAR AS golden,
    floor(epoch(ts))::BIGINT AS ts, event_id AS seq FROM events),
inf AS (
  SELECT * FROM log WHERE event_type <> 'purchase'
  QUALIFY row_number() OVER (PARTITION BY _id ORDER BY ts DESC, seq DESC) = 1),
fb AS (
  SELECT * FROM log WHERE event_type = 'purchase'
  QUALIFY row_number() OVER (PARTITION BY _id ORDER BY ts DESC, seq DESC) = 1)"""


@query(
    "snk9_replace_upsert",
    _LOG + " SELECT _id, url, props AS payload, event_type AS recommendation, ts FROM inf",
)
def replace_upsert(spark, sf):
    return U.replace_records(changes(spark, sf).filter("kind = 'infer'")).drop("seq")


@query(
    "snk10_partial_update",
    # By time: the last inference of a key, then the last feedback among the rows after it.
    _LOG + """, after_ AS (
  SELECT l._id, l.golden, l.ts, l.seq FROM log l JOIN inf ON inf._id = l._id
  WHERE l.event_type = 'purchase' AND (l.ts > inf.ts OR (l.ts = inf.ts AND l.seq > inf.seq))
  QUALIFY row_number() OVER (PARTITION BY l._id ORDER BY l.ts DESC, l.seq DESC) = 1)
SELECT inf._id, inf.url, inf.props AS payload, inf.event_type AS recommendation,
 round(a.golden::DOUBLE, 2) AS golden, coalesce(a.ts, inf.ts) AS ts FROM inf LEFT JOIN after_ a ON a._id = inf._id""",
)
def partial_update(spark, sf):
    log = changes(spark, sf)
    records = U.replace_records(log.filter("kind = 'infer'"))
    updated = U.apply_feedback(records, log.filter("kind = 'feedback'"))
    golden = F.round(F.col("golden_standard").cast("double"), 2)
    return updated.withColumn("golden", golden).drop("golden_standard", "seq")


@query(
    "win6_latest_records",
    _LOG + """ SELECT inf._id, inf.event_type AS recommendation,
 CASE WHEN (fb.ts, fb.seq) > (inf.ts, inf.seq) THEN round(fb.golden::DOUBLE, 2) END AS golden,
 CASE WHEN (fb.ts, fb.seq) > (inf.ts, inf.seq) THEN fb.ts ELSE inf.ts END AS ts
FROM inf LEFT JOIN fb ON fb._id = inf._id""",
)
def latest_records(spark, sf):
    rows = U.current_records(changes(spark, sf))
    golden = F.round(F.col("golden_standard").cast("double"), 2)
    return rows.select("_id", "recommendation", golden.alias("golden"), "ts")
