"""One registered query per corpus operator, with check SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import (
    conversation_repair,
    decontamination,
    exact_dedup,
    html_text,
    jaccard_join,
    lexical_search,
    mixing,
    ngram_lm,
    quality,
    token_files,
    toxicity,
    vector_search,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The end id and the tokenizer of the token files.
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
TOXIC_FROM = 0.7
KEEP_FROM = 0.5
#: Documents named for each benchmark item.
RANKED = 50


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


@query(
    "op3_warc_archives",
    """WITH p AS (
 SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS keeper FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
 list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  ((('0x' || substr(h, i::INT // 4 * 5 + 1, 5))::BIGINT >> (15 - 5 * (i::INT % 4))) & 31) + 1, 1)),
  'string_agg', '') AS payload_digest,
 CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM k""",
)
def warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archives(table(spark, sf_dir, "pages"), revisit_from=0)
    return warc.read_archives(spark, path).select(
        warc.page_number(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_number(F.col("refers_to")).alias("refers_to"),
    )


@query(
    "op5_source_mix",
    r"""WITH s AS (
 SELECT doc_id, source,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS weight
 FROM p),
l AS (SELECT *,
 (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0))::DOUBLE
 / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS reached
 FROM w WINDOW before AS (ORDER BY source_size / weight, source IS NULL, source
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(3.0::DOUBLE * source_size, max(reached) OVER () * weight) AS target,
 ('0x' || substr(md5('7:' || coalesce(source, chr(1))), 1, 7))::BIGINT AS shift FROM l),
r AS (SELECT s.doc_id, s.size, t.source_size, t.target, t.shift,
 CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size * 268435456)::BIGINT ELSE 0 END AS rate,
 row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id) AS k
 FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
 (size * (((rate * k + shift) >> 28) - ((rate * (k - 1) + shift) >> 28)))::BIGINT AS taken FROM r""",
)
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


@query("op6_jaccard_join")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = jaccard_join.near_groups(table(spark, sf_dir, "documents"))
    return jaccard_join.component_ids(groups).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id"
    )


@query("op7_token_files")
def token_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = token_files.write_tokens(docs, tokenizer_path(), END_ID)
    return token_files.digests(token_files.read_tokens(spark, path))


@query("op9_decontamination")
def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = decontamination.TilingConfig()
    found = decontamination.coverage(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), config
    )
    return found.withColumn("contaminated", F.col("coverage") >= config.coverage)


@query("op10_toxicity")
def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), id_remainder(3) != 1)
    return toxicity.scores(docs, model).select(
        "doc_id",
        (id_remainder(3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


@query("op8_html_text")
def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_text(table(spark, sf_dir, "pages"))
    length = F.length("text").cast("long")
    return found.select(
        "page_id", "url", "text", length.alias("n_chars"), "outside_tokens", "boilerplate_tokens"
    )


@query(
    "op2_top_k_search",
    """WITH v AS (
 SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
 FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5""",
)
def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op4_ordinal_quality")
def graded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 poor, 1 good but toxic, 2 good."""
    docs = table(spark, sf_dir, "documents")
    grade = F.when(F.col("quality") == 1, F.lit(2) - F.coalesce("toxic", F.lit(0))).otherwise(
        F.col("quality")
    )
    model = quality.fit(docs, table(spark, sf_dir, "labels"), grade, id_remainder(3) != 1)
    return quality.graded(docs, model).select(
        "doc_id",
        (id_remainder(3) == 1).alias("held_out"),
        "expected_grade",
        F.col("tails")[0].alias("p_ge_1"),
        F.col("tails")[1].alias("p_ge_2"),
        (F.col("tails")[0] >= KEEP_FROM).alias("keep"),
    )


@query("op1_lm_scoring")
def scored_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(table(spark, sf_dir, "documents"), id_remainder(7) == 2)


def _crc32_sql(text: str) -> str:
    """crc32 of an ASCII text as DuckDB SQL: a fold over its bytes, eight shifts each."""
    fed = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: [ascii({text}[i]), -1, -1, -1, -1, -1, -1, -1, -1]))"
    return (
        f"xor(list_reduce(list_transform({fed}, lambda x: x::BIGINT), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) "
        f"WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, 4294967295::BIGINT), 4294967295)"
    )


def _steps_sql() -> str:
    """The search's steps as SQL rows: class, fault, from, to, cost, letters, inserted lines, new role."""
    repair = conversation_repair
    rows = []
    for initial in ("s", "u", "a", "-"):
        for fault in (repair.FINE, repair.TRUNCATED, repair.DUPLICATE):
            for a, b, cost, letters in repair.steps(initial, fault):
                at, lines = a, []
                for _ in range(letters.count(b"I")):
                    lines.append(repair.DUE[at] + ":")
                    at = repair.MOVES[at, repair.DUE[at][0]]
                role = repair.DUE[at] if letters.endswith(b"R") else ""
                listed = "[" + ", ".join(f"'{x}'" for x in lines) + "]::VARCHAR[]"
                rows.append(f"('{initial}', {fault}, {a}, {b}, {cost}, '{letters.decode()}', {listed}, '{role}')")
    return "VALUES " + ",\n ".join(rows)


@query(
    "op12_conversation_repair",
    rf"""WITH RECURSIVE x AS (
 SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS draw
 FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
 CASE WHEN draw = 1 THEN '' WHEN draw = 2 THEN translate(text, '.!?', '') ELSE text END AS text
 FROM x, unnest(range(CASE WHEN draw = 0 THEN 0 WHEN draw = 3 THEN 2 ELSE 1 END))),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS k FROM d),
g AS (SELECT *, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS t,
 row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) AS nth,
 lag(role) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM o),
f AS (SELECT *, CASE WHEN t = '' THEN 3 WHEN nth > 1 THEN 2
  WHEN right(t, 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS fault,
 CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '-' END AS initial FROM g),
steps(initial, fault, a, b, cost, letters, lines, role) AS ({_steps_sql()}),
v AS (
 SELECT DISTINCT conv_id, 0::BIGINT AS k, 0 AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines
 FROM conversations
 UNION ALL
 SELECT conv_id, k, b, cost, audit, lines FROM (
  SELECT v.conv_id, f.k, s.b, v.cost + s.cost AS cost, v.audit || s.letters AS audit,
   v.lines || s.lines || CASE right(s.letters, 1) WHEN 'D' THEN []::VARCHAR[]
    WHEN 'K' THEN [f.role || ':' || f.text] ELSE [s.role || ':' || f.text] END AS lines,
   row_number() OVER (PARTITION BY v.conv_id, s.b ORDER BY v.cost + s.cost, v.audit || s.letters) AS r
  FROM v JOIN f ON f.conv_id IS NOT DISTINCT FROM v.conv_id AND f.k = v.k + 1
  JOIN steps s ON s.a = v.state AND s.initial = f.initial AND s.fault = least(f.fault, 2)) WHERE r = 1),
ends AS (SELECT conv_id, cost + [0, 4, 2, 0][state + 1] AS cost, audit || ['', 'II', 'I', ''][state + 1] AS audit,
 lines || [[]::VARCHAR[], ['user:', 'assistant:'], ['assistant:'], []::VARCHAR[]][state + 1] AS lines,
 row_number() OVER (PARTITION BY conv_id ORDER BY k DESC, cost + [0, 4, 2, 0][state + 1],
  audit || ['', 'II', 'I', ''][state + 1]) AS r FROM v),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
 count(*) FILTER (fault = 3) AS blank, count(*) FILTER (fault = 2) AS duplicate,
 count(*) FILTER (fault = 1) AS truncated,
 count(*) FILTER (k > 1 AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
 FROM f GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
 coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
 coalesce(illegal, 0)::BIGINT AS illegal, cost::BIGINT AS cost, audit,
 sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM e.conv_id WHERE r = 1""",
)
def repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    rows = conversation_repair.damaged(conversations)
    return conversation_repair.with_digests(rows, conversation_repair.plans(rows, conversations))


@query(
    "op13_exact_dedup",
    """WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''),
 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
 row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)""",
)
def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with an even crc32 count as the batch seen before, the others as new."""
    return exact_dedup.copies(table(spark, sf_dir, "documents"), id_remainder(2) == 0)


_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)


@query(
    "op11_lexical_search",
    f"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_TERMS} AS terms FROM documents),
n AS (SELECT k, doc_id, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0),
c AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM n),
p AS (SELECT k, term, count(*)::BIGINT AS tf FROM (SELECT k, unnest(terms) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM f, c),
q AS (SELECT j, item_id, unnest(list_distinct(terms)) AS term
 FROM (SELECT row_number() OVER () AS j, item_id, {_TERMS} AS terms FROM benchmark)),
s AS (SELECT j, item_id, p.k, n.doc_id,
  sum(w.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // l))))::BIGINT AS score
 FROM q JOIN p USING (term) JOIN w USING (term) JOIN n USING (k) CROSS JOIN c GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY j ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 50""",
)
def ranked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical_search.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), RANKED)
    return found.select("item_id", "rank", "doc_id", "score")
