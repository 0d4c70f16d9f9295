"""Files of every layout, written from the tables and read back by the engine."""

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.functions import arrays as A
from textloom.operators import answers as N
from textloom.operators import pretrain as P
from textloom.operators import sequences as S
from textloom.plans import datasets as D
from textloom.plans import oracle_parts as Q
from textloom.plans.catalog import answers as CA
from textloom.plans.catalog import datasets as CD
from textloom.plans.catalog import encoding as CE
from textloom.plans.catalog import pretraining as CP
from textloom.plans.catalog import windows as CW
from textloom.plans.catalog.registry import ORACLES, new_folder, query, table, vocabulary
from textloom.sources import layouts as Y
from textloom.sources import readers as R
from textloom.sources import sinks as K

_FLAT = "replace(replace(replace(text, chr(10), ' '), chr(13), ' '), chr(9), ' ')"


def _flat(column="text"):
    return F.translate(column, "\n\r\t", "   ")


def _lines_written(spark, rows, line, name, first=None, last=None, between=None):
    """Each partition as a text file, with an own first and last line and a mark between rows."""
    path = new_folder(spark, name)

    def lines(batches):
        begun = False
        for batch in batches:
            out = []
            for value in batch.column(0).to_pylist():
                ahead = between if begun else first
                out += [value] if ahead is None else [ahead, value]
                begun = True
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
        if last is not None:
            out = [last] if begun or first is None else [first, last]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    rows.select(line.alias("value")).mapInArrow(lines, "value string").write.text(path)
    return path


@query(
    "src1_corpus_files",
    r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
 generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents),
m AS (SELECT *, regexp_replace(line, '\s+', '', 'g') = '' OR line LIKE 'The%' AS blank FROM l),
g AS (SELECT *, sum(blank::INT) OVER (PARTITION BY doc_id ORDER BY k) AS part FROM m),
d AS (SELECT string_agg(line, chr(10) ORDER BY k) AS text FROM g WHERE NOT blank GROUP BY doc_id, part)
SELECT md5(text) AS text, count(*) AS n FROM d GROUP BY 1""",
)
def corpus_files(spark, sf):
    """Lines that open with "The" are written blank, so that documents break up."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.when(x.startswith("The"), "").otherwise(x))
    path = new_folder(spark, "corpus")
    table(spark, sf, "documents").select(F.concat(F.array_join(lines, "\n"), F.lit("\n"))).write.text(path)
    docs = R.read_corpus(spark, path)
    return docs.groupBy(F.md5("text").alias("text")).agg(F.count("*").alias("n"))


@query("src2_glob_list", f"SELECT md5({_FLAT}) AS line, count(*) AS n FROM conversations WHERE role IN ('user', 'assistant') GROUP BY 1")
def glob_list(spark, sf):
    path = new_folder(spark, "roles")
    rows = table(spark, sf, "conversations")
    for role in ("user", "assistant", "system"):
        rows.filter(F.col("role") == role).select(_flat()).write.text(f"{path}/{role}")
    lines = R.read_lines(spark, f"{path}/us*/part-*, {path}/assistant")
    return lines.groupBy(F.md5("value").alias("line")).agg(F.count("*").alias("n"))


@query(
    "src3_tab_files",
    f"SELECT conv_id::VARCHAR AS conv_id, turn::VARCHAR AS turn, md5('\"' || role || '\"' || {_FLAT}) AS text FROM conversations",
)
def tab_files(spark, sf):
    """Quote characters are data, and a first line of column names is skipped."""
    line = F.concat_ws("\t", "conv_id", "turn", F.concat(F.lit('"'), "role", F.lit('"'), _flat()))
    path = _lines_written(spark, table(spark, sf, "conversations"), line, "tabs", first="a\tb\tc")
    fields = R.read_fields(spark, path, header=True).select("fields")
    return fields.select(*[F.get("fields", F.lit(k)).alias(c) for k, c in enumerate(["conv_id", "turn"])], F.md5(F.get("fields", F.lit(2))).alias("text"))


def _array_files(spark, sf):
    """Labelled documents as JSON arrays, one array a file; a third names its text otherwise."""
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    third = F.col("doc_id") % 3 == 0
    record = F.to_json(
        F.struct(
            F.when(~third, F.col("text")).alias("inputs"),
            F.when(third, F.col("text")).alias("text"),
            F.col("quality").alias("label"),
            F.struct(F.lit('}"{').alias("note"), F.array(F.lit(1), F.lit(2)).alias("at")).alias("extra"),
        )
    )
    return _lines_written(spark, rows, record, "arrays", first="[", last="]", between=",")


@query(
    "src4_json_arrays",
    "SELECT md5(text) AS inputs, quality::VARCHAR AS label, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL",
)
def json_arrays(spark, sf):
    rows = R.read_records(spark, _array_files(spark, sf))
    return rows.groupBy(F.md5("inputs").alias("inputs"), "label").agg(F.count("*").alias("n"))


@query(
    "prj7_record_examples",
    """SELECT md5(text) AS text_a, quality::VARCHAR AS label, row_number() OVER (PARTITION BY text, quality) AS copy,
 (SELECT count(*) FROM documents JOIN labels USING (doc_id)) AS ids FROM documents JOIN labels USING (doc_id)""",
)
def record_examples(spark, sf):
    rows = Y.read_examples(spark, "reviews", "train", _array_files(spark, sf))
    number = F.regexp_extract("guid", "^train-(\\d+)$", 1).cast("long")
    ids = rows.agg((F.max(number) + 1 - F.min(number) + 0 * F.count_distinct("guid")).alias("ids"))
    copies = Window.partitionBy("text_a", "label").orderBy("guid")
    return rows.withColumn("copy", F.row_number().over(copies)).crossJoin(F.broadcast(ids)).select(F.md5("text_a").alias("text_a"), "label", "copy", "ids")


@query(
    "prj2_paraphrase_files",
    f"""WITH p AS (SELECT turn % 2 AS label, {_FLAT} AS a, lead({_FLAT}) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM conversations)
SELECT 'dev' AS split, md5(a) AS text_a, md5(b) AS text_b, label::VARCHAR AS label, count(*) AS n FROM p WHERE b IS NOT NULL GROUP BY ALL""",
)
def paraphrase_files(spark, sf):
    by_turn = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf, "conversations").select(
        "conv_id", "turn", _flat().alias("a"), F.lead(_flat()).over(by_turn).alias("b")
    )
    line = F.concat_ws("\t", F.col("turn") % 2, "conv_id", "turn", "a", "b")
    path = _lines_written(spark, rows.filter("b is not null"), line, "paraphrase", first="Quality\tid\tid\tone\ttwo")
    found = Y.read_examples(spark, "paraphrase", "dev", path)
    split = F.regexp_extract("guid", "^(dev)-\\d+$", 1).alias("split")
    return found.groupBy(split, F.md5("text_a").alias("text_a"), F.md5("text_b").alias("text_b"), "label").agg(F.count("*").alias("n"))


@query(
    "prj3_acceptability_files",
    f"""SELECT 'train' AS split, md5({_FLAT}) AS text_a, (turn % 2)::VARCHAR AS label, count(*) AS n FROM conversations GROUP BY ALL
UNION ALL SELECT 'test', md5({_FLAT}), '0', count(*) FROM conversations GROUP BY ALL""",
)
def acceptability_files(spark, sf):
    """Training files have no first line of names and four columns, test files have one and two."""
    rows = table(spark, sf, "conversations")
    train = new_folder(spark, "acceptability")
    rows.select(F.concat_ws("\t", "role", F.col("turn") % 2, F.lit("*"), _flat())).write.text(train)
    test = _lines_written(spark, rows, F.concat_ws("\t", "conv_id", _flat()), "acceptability", first="id\tsentence")
    found = Y.read_examples(spark, "acceptability", "train", train).unionByName(Y.read_examples(spark, "acceptability", "test", test))
    return found.groupBy(F.substring_index("guid", "-", 1).alias("split"), F.md5("text_a").alias("text_a"), "label").agg(F.count("*").alias("n"))


def _read_turns(spark, path, split):
    """A reader of one's own: ``role: text`` lines, the role as label."""
    parts = F.split("value", ": ", 2)
    lines = R.read_lines(spark, path)
    return lines.select(
        F.concat_ws("-", F.lit(split), "line_no").alias("guid"),
        F.get(parts, F.lit(1)).alias("text_a"),
        F.lit(None).cast("string").alias("text_b"),
        F.get(parts, F.lit(0)).alias("label"),
    )


TURNS = Y.DatasetSpec(("assistant", "system", "user"), {"train": None}, _read_turns)


@query(
    "hook_plugged_layout",
    f"""SELECT md5({_FLAT}) AS text_a, role AS label,
 CASE role WHEN 'assistant' THEN 0 WHEN 'system' THEN 1 ELSE 2 END AS label_ids, count(*) AS n FROM conversations GROUP BY ALL""",
)
def plugged_layout(spark, sf):
    """A layout that is registered by name, with its reader and labels."""
    if "turns" not in Y.SPECS:
        Y.register("turns", TURNS)
    path = new_folder(spark, "turns")
    table(spark, sf, "conversations").select(F.concat("role", F.lit(": "), _flat())).write.text(path)
    rows = S.attach_label_ids(Y.read_examples(spark, "turns", "train", path), Y.labels_of(spark, "turns"))
    return rows.groupBy(F.md5("text_a").alias("text_a"), "label", "label_ids").agg(F.count("*").alias("n"))


_LATIN = r"regexp_replace(text, '[^\x20-\x7E\xA1-\xFF]', '', 'g')"


@query(
    "src8_tweet_files",
    f"SELECT md5({_LATIN}) AS text, (CASE role WHEN 'user' THEN 0 ELSE 4 END)::BIGINT AS label, count(*) AS n FROM conversations GROUP BY ALL",
)
def tweet_files(spark, sf):
    """Six quoted columns in Latin-1 without column names; the first and the last are read."""
    text = F.regexp_replace("text", "[^\\x20-\\x7E\\xA1-\\xFF]", "")
    label = F.when(F.col("role") == "user", 0).otherwise(4)
    rows = table(spark, sf, "conversations").select(label, "conv_id", F.lit("date"), F.lit("none"), "role", text)
    path = new_folder(spark, "tweets")
    rows.write.csv(path, encoding="iso-8859-1", quoteAll=True, escape='"')
    found = R.read_tweets(spark, path)
    return found.groupBy(F.md5("text").alias("text"), "label").agg(F.count("*").alias("n"))


@query(
    "src9_review_folders",
    r"""SELECT md5(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS text, quality::BIGINT AS label, count(*) AS n
FROM documents JOIN labels USING (doc_id) GROUP BY ALL""",
)
def review_folders(spark, sf):
    """One file a text in two folders, as the layout has it; both are read as one set (SET2)."""
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    path = new_folder(spark, "reviews")
    for side, label in (("pos", 1), ("neg", 0)):
        K.write_texts(rows.filter(F.col("quality") == label).select("text"), f"{path}/{side}")
    found = R.read_reviews(spark, path)
    return found.groupBy(F.md5("text").alias("text"), "label").agg(F.count("*").alias("n"))


@query("snk2_feature_files", ORACLES["seq6_class_features"])
def feature_files(spark, sf):
    docs, marks = table(spark, sf, "documents"), table(spark, sf, "labels")
    examples = docs.join(marks, "doc_id").select(
        "doc_id", F.col("text").alias("text_a"), F.lit(None).cast("string").alias("text_b"), F.col("quality").cast("string").alias("label")
    )
    rows = S.classification_features(examples, ["doc_id"], CE.label_ids(spark, sf), 128, vocabulary(spark, sf))
    path = new_folder(spark, "features")
    K.write_features(rows, path)
    back = R.read_features(spark, path, {"input_ids": 128, "input_mask": 128}, ["doc_id", "label_ids"])
    return back.select("doc_id", "input_ids", F.aggregate("input_mask", F.lit(0), lambda a, v: a + v).alias("n"), "label_ids")


@query(
    "snk3_window_files",
    CW.BASE + "," + CW.LABELLED + """ SELECT unique_id, impossible::BIGINT AS is_impossible, (len(qi) + length + 3)::BIGINT AS n,
 (CASE WHEN inside THEN bs - first + len(qi) + 2 ELSE 0 END)::BIGINT AS start_position,
 (CASE WHEN inside THEN be - first + len(qi) + 2 ELSE 0 END)::BIGINT AS end_position FROM labelled""",
)
def window_files(spark, sf):
    path = new_folder(spark, "windows")
    K.write_windows(CW.built(spark, sf, ["input_ids", "input_mask", "segment_ids"]), path, training=True)
    scalars = ["unique_id", "is_impossible", "start_position", "end_position"]
    back = R.read_features(spark, path, {c: CW.CFG.max_length for c in ("input_ids", "input_mask", "segment_ids")}, scalars)
    return back.select("unique_id", "is_impossible", F.aggregate("input_mask", F.lit(0), lambda a, v: a + v).alias("n"), "start_position", "end_position")


@query(
    "snk7_answer_files",
    CA.SCORED + "," + CA.NULLS + "," + CA.ranked_sql(True) + "," + CA.FINAL + " SELECT f.qas_id, f.text, f.score_diff, b.n FROM ("
    + CA._final_sql(-18.0) + ") f JOIN (SELECT qas_id, count(*) AS n FROM nbest GROUP BY 1) b USING (qas_id)",
)
def answer_files(spark, sf):
    from textloom.session import stored

    rows = CA.scored(spark, sf)
    ranked = stored(N.n_best(rows, CA._examples(spark, sf), CA.NEGATIVE, paragraphs=CW.texts(spark, sf)))
    final = N.predictions(ranked, N.null_scores(rows), -18.0)
    path = new_folder(spark, "answers")
    K.write_answers(final, ranked, path, final)
    read = lambda name, schema: spark.read.schema(schema).json(f"{path}/{name}")
    best = read("nbest", "qas_id string, rank int").groupBy("qas_id").agg(F.count("*").alias("n"))
    texts = read("predictions", "qas_id string, text string")
    return texts.join(read("null_odds", "qas_id string, score_diff double"), "qas_id").join(best, "qas_id")


@query(
    "snk8_dataset_folders",
    "WITH " + CD.ROWS + "," + CD._SPLIT + f""", s AS (SELECT *, CASE WHEN r >= round_even(size * 0.85::DOUBLE, 0) THEN 'test'
 WHEN {Q.bits(Q.digest('12345/dev', 'doc_id', 'label_no'))} < {int(0.1 * 2**32)} THEN 'dev' ELSE 'train' END AS split FROM kept)
SELECT tag, split, label, label_id, count(*) AS n, count(DISTINCT doc_id) AS docs FROM s GROUP BY ALL""",
)
def dataset_folders(spark, sf):
    rows, labels = D.tagged_dataset(CD.tagged_documents(spark, sf), CD.TAGS)
    path = new_folder(spark, "dataset")
    K.write_dataset(rows, labels, path, ["doc_id", "label_no"])
    schema = "doc_id long, label string, tag string, split string"
    back = spark.read.schema(schema).json(f"{path}/records")
    listed = spark.read.schema("label string, label_id int, tag string").json(f"{path}/labels")
    return back.join(listed, ["tag", "label"]).groupBy("tag", "split", "label", "label_id").agg(
        F.count("*").alias("n"), F.count_distinct("doc_id").alias("docs")
    )


@query(
    "snk1_shard_sizes",
    CP.BASE + "," + CP.PLAN + """, c AS (SELECT count(*) AS n, sum(chunk)::BIGINT AS chunks FROM plan)
SELECT rows, count(*) AS files, any_value(chunks) AS chunks FROM (
 SELECT n // 8 + (CASE WHEN k < n % 8 THEN 1 ELSE 0 END) AS rows, chunks FROM c, (SELECT unnest(range(0, 8)) AS k)) GROUP BY 1""",
)
def shard_sizes(spark, sf):
    planned = P.chunk_plans(CP._corpus(spark, sf), CP.CFG).select("doc_id", "copy", "chunk")
    path = new_folder(spark, "shards")
    K.write_shards(planned, path, 8, keys=["doc_id", "copy", "chunk"])
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"), F.sum("chunk").alias("part"))
    total = Window.partitionBy(F.lit(1))
    sizes = files.withColumn("chunks", F.sum("part").over(total))  # one row a file
    return sizes.groupBy("rows").agg(F.count("*").alias("files"), F.max("chunks").alias("chunks"))


_BOTH = " UNION ALL ".join(
    f"SELECT {cfg.max_length}::BIGINT AS width, * FROM ({CP.training_sql(cfg)})" for cfg in CP.LENGTHS
)


@query("pt10_two_lengths", _BOTH)
def two_lengths(spark, sf):
    """Rows of two lengths from one encoding of the corpus."""
    docs, vocab, corpus = table(spark, sf, "documents"), vocabulary(spark, sf), CP._corpus(spark, sf)
    columns = ["doc_id", "copy", "chunk", "input_ids", "input_mask", "segment_ids", "next_sentence_labels"]
    sets = [
        P.training_rows(docs, vocab, cfg, corpus=corpus).select(
            F.lit(cfg.max_length).alias("width"), *columns[:3], *[A.text_of(F.col(c)).alias(c) for c in columns[3:6]], columns[6]
        )
        for cfg in CP.LENGTHS
    ]
    return sets[0].unionByName(sets[1])
