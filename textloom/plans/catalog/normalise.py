"""Text normalisation over whole text columns."""

from pyspark.sql import functions as F

from textloom.functions import arrays as A
from textloom.functions import text as X
from textloom.plans import oracle_parts as Q
from textloom.plans.catalog.registry import query, table


def _digest_sql(expr: str, source: str = "documents", key: str = "doc_id") -> str:
    return f"SELECT {key}, md5({expr}) AS digest FROM {source}"


def _docs(spark, sf, expr):
    return table(spark, sf, "documents").select("doc_id", F.md5(expr).alias("digest"))


# Whole-text results are compared through their md5.
@query("txt01_utf8", _digest_sql("text"))
def utf8(spark, sf):
    return _docs(spark, sf, X.utf8_text(F.col("text").cast("binary")))


@query("txt02_clean", _digest_sql(Q.clean("text")))
def clean(spark, sf):
    return _docs(spark, sf, X.clean(F.col("text")))


@query("txt03_cjk_spacing", _digest_sql(Q.space_cjk("text")))
def cjk(spark, sf):
    return _docs(spark, sf, X.space_cjk(F.col("text")))


# The tables hold neither invalid bytes, control characters nor ideographs, so these put some in.
@query("txt01_invalid_bytes", "SELECT doc_id, md5(source || text || lang || 'é') AS digest FROM documents")
def invalid_bytes(spark, sf):
    """A lone continuation byte, a cut sequence, a surrogate and an over-long form between valid bytes."""
    raw = lambda c: F.col(c).cast("binary")
    mixed = F.concat(F.unhex(F.lit("80")), raw("source"), F.unhex(F.lit("E282")), raw("text"), F.unhex(F.lit("EDA080")), raw("lang"), F.unhex(F.lit("C0AFC3A9FF")))
    return table(spark, sf, "documents").select("doc_id", F.md5(X.utf8_text(mixed)).alias("digest"))


_MARKED = "chr(1) || replace(text, 'a', chr(11)) || chr(9) || lang || chr(8203) || source || chr(160) || 'x' || chr(173) || chr(13) || chr(65533)"


@query("txt02_control_characters", _digest_sql(Q.clean(f"({_MARKED})")))
def control_characters(spark, sf):
    chars = {k: F.lit(chr(k)) for k in (1, 9, 13, 160, 173, 8203, 65533)}
    marked = F.concat(
        chars[1], F.translate("text", "a", chr(11)), chars[9], F.col("lang"), chars[8203], F.col("source"),
        chars[160], F.lit("x"), chars[173], chars[13], chars[65533],
    )
    return _docs(spark, sf, X.clean(marked))


@query("txt03_ideographs", _digest_sql(Q.space_cjk("translate(text, 'eno', '中가㐀')")))
def ideographs(spark, sf):
    """Two letters become ideographs and one a Hangul syllable, which is none."""
    return _docs(spark, sf, X.space_cjk(F.translate("text", "eno", "中가㐀")))


@query("txt04_lower", _digest_sql("lower(text)"))
def lower(spark, sf):
    return _docs(spark, sf, F.lower("text"))


@query("txt05_strip_accents", _digest_sql(Q.fold("text")))
def accents(spark, sf):
    return _docs(spark, sf, X.strip_accents(F.lower("text")))


@query("txt06_split_punctuation", _digest_sql(Q.space_punctuation("text")))
def punctuation(spark, sf):
    return _docs(spark, sf, X.space_punctuation(F.col("text")))


@query("txt07_whitespace_words", _digest_sql(Q.joined(Q.words("text"))))
def whitespace(spark, sf):
    return _docs(spark, sf, F.array_join(X.words_of(F.col("text")), " "))


@query(
    "txt08_basic_tokens_uncased",
    f"SELECT doc_id, len(t)::BIGINT AS n_tokens, md5({Q.joined('t')}) AS digest "
    f"FROM (SELECT doc_id, {Q.tokens('text')} AS t FROM documents)",
)
def basic_uncased(spark, sf):
    toks = X.basic_tokens(F.col("text"))
    docs = table(spark, sf, "documents").select("doc_id", toks.alias("t"))
    return docs.select("doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("digest"))


@query(
    "txt08_basic_tokens_cased",
    f"SELECT page_id, len(t)::BIGINT AS n_tokens, md5({Q.joined('t')}) AS digest "
    f"FROM (SELECT page_id, {Q.tokens('html', lower=False)} AS t FROM pages)",
)
def basic_cased(spark, sf):
    toks = X.basic_tokens(F.col("html"), lower=False)
    pages = table(spark, sf, "pages").select("page_id", toks.alias("t"))
    return pages.select("page_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("digest"))


NOT_SPACE = Q.SPACE.replace("[", "[^", 1)
HANDLES = (
    f"regexp_replace(regexp_replace(regexp_replace(html, 'http{NOT_SPACE}+', '', 'g'),"
    f" '@{NOT_SPACE}+', '', 'g'), '#{NOT_SPACE}+', '', 'g')"
)


@query("txt09_strip_handles", f"SELECT page_id, md5({HANDLES}) AS digest FROM pages")
def handles(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", F.md5(X.strip_handles(F.col("html"))).alias("digest")
    )


def _literal(chars: str) -> str:
    return "'" + chars.replace("'", "''") + "'"


@query(
    "txt10_delete_punctuation",
    "SELECT doc_id, md5(translate(text, {0}, '')) AS tweet, md5(translate(text, {1}, '')) AS review"
    " FROM documents".format(_literal(X.TWEET_PUNCTUATION), _literal(X.REVIEW_PUNCTUATION)),
)
def delete_punctuation(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        F.md5(X.delete_chars(F.col("text"), X.TWEET_PUNCTUATION)).alias("tweet"),
        F.md5(X.delete_chars(F.col("text"), X.REVIEW_PUNCTUATION)).alias("review"),
    )


@query(
    "txt11_drop_br",
    f"SELECT page_id, len(list_filter(w, lambda t: t <> 'br'))::BIGINT AS kept, len(w)::BIGINT AS total "
    f"FROM (SELECT page_id, {Q.words(Q.space_punctuation('html'))} AS w FROM pages)",
)
def drop_br(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", X.rule_words(F.col("html")).alias("w"))
    return rows.select(
        "page_id",
        F.size(F.filter("w", lambda t: t != "br")).alias("kept"),
        F.size("w").alias("total"),
    )


def lowered_sql(tokens: str, strip: bool) -> str:
    text = f"array_to_string(list_transform({tokens}, lambda t: lower(t)), ' ')"
    text = f"regexp_replace(replace({text}, '''''', ''), '{Q.SPACE}+', ' ', 'g')"
    return f"trim({text})" if strip else text


@query(
    "txt12_join_lower",
    f"SELECT conv_id, turn, md5({lowered_sql(Q.words('text'), True)}) AS digest FROM conversations",
)
def join_lower(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.md5(X.joined_lower(X.words_of(F.col("text")), True)).alias("digest")
    )


FLAT = "replace(replace(replace(text, chr(10), ' '), chr(13), ''), chr(9), ' ')"


@query("txt13_flat_lines", _digest_sql(FLAT))
def flat_lines(spark, sf):
    return _docs(spark, sf, X.flat_lines(F.col("text")))


ASCII = r"regexp_replace({}, '[^\x00-\x7F]', '', 'g')"


@query("txt14_ascii_only", _digest_sql(ASCII.format("text")))
def ascii_only(spark, sf):
    return _docs(spark, sf, X.ascii_only(F.col("text")))


@query("txt15_squeeze", _digest_sql(Q.squeeze("text")))
def squeeze(spark, sf):
    return _docs(spark, sf, X.squeeze(F.col("text")))


@query(
    "txt16_sentences",
    f"SELECT doc_id, len(s)::BIGINT AS n, md5(array_to_string(s, '|')) AS digest "
    f"FROM (SELECT doc_id, {Q.sentences(FLAT)} AS s FROM documents)",
)
def sentences(spark, sf):
    rows = table(spark, sf, "documents").select(
        "doc_id", X.sentences(X.flat_lines(F.col("text"))).alias("s")
    )
    return rows.select("doc_id", F.size("s").alias("n"), F.md5(F.array_join("s", "|")).alias("digest"))


@query("txt17_rule_words", _digest_sql(Q.joined(Q.words(Q.space_punctuation("text")))))
def rule_words(spark, sf):
    return _docs(spark, sf, F.array_join(X.rule_words(F.col("text")), " "))


@query(
    "txt18_label_name",
    f"SELECT conv_id, turn, md5(replace(trim(regexp_replace(text, '{Q.SPACE}+', ' ', 'g')), ' ', '_')) AS label"
    " FROM conversations",
)
def label_name(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.md5(X.label_name(F.col("text"))).alias("label")
    )


@query(
    "txt19_join_pieces",
    "SELECT item_id, md5({}) AS digest FROM (SELECT item_id,"
    " replace(replace(regexp_replace(text, '([a-z]{{2}})([a-z])', '\\1 ##\\2', 'g'), ' ##', ''), '##', '')"
    " AS t FROM benchmark)".format(Q.squeeze("t")),
)
def join_pieces(spark, sf):
    pieces = F.regexp_replace("text", "([a-z]{2})([a-z])", "$1 ##$2")
    return table(spark, sf, "benchmark").select(
        "item_id", F.md5(X.join_pieces(pieces)).alias("digest")
    )


@query("txt20_url_key", "SELECT page_id, md5(url) AS key FROM pages")
def url_key(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.url_key(F.col("url")).alias("key"))


@query(
    "txt22_round_vectors",
    "SELECT vec_id, i::BIGINT AS i, round(v::DOUBLE, 6) AS v FROM (SELECT vec_id, unnest(embedding) AS v,"
    " generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)",
)
def round_vectors(spark, sf):
    values = A.rounded(F.col("embedding").cast("array<double>"))
    return table(spark, sf, "embeddings").select("vec_id", F.posexplode(values).alias("i", "v"))


@query(
    "top_words_per_language",
    f"""WITH w AS (SELECT lang, unnest({Q.tokens('text')}) AS token FROM documents)
SELECT lang, token, count(*) AS n FROM w GROUP BY 1, 2
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) <= 20""",
)
def top_words(spark, sf):
    from pyspark.sql.window import Window

    counts = (
        table(spark, sf, "documents")
        .select("lang", F.explode(X.basic_tokens(F.col("text"))).alias("token"))
        .groupBy("lang", "token")
        .agg(F.count("*").alias("n"))
    )
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "token")
    return counts.withColumn("r", F.row_number().over(best)).filter("r <= 20").drop("r")
