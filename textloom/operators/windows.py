"""Question-answer paragraphs to overlapping fixed-width windows.

A paragraph is encoded once together with all its questions, in its row. Pieces
before each word are prefix sums built once per paragraph; window starts and
best-context bounds are closed forms over places. The windows are cut from the
paragraph's arrays in the same way, so nothing after the encoding is shuffled
but the window counts that give the ids.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from textloom.functions import arrays as A
from textloom.functions import text as X
from textloom.operators import question_rows as R
from textloom.operators.order import running_start
from textloom.operators.packed import packed
from textloom.operators.pieces import text_encoder
from textloom.operators.subword import CLS, SEP, VocabFacts, compiled, encode, ids_to_tokens, vocab_facts
from textloom.session import broadcast_if_small, stored

FIRST_UNIQUE_ID = 1_000_000_000
#: Arrays of a window, and the column of the paragraph that each is cut from.
LISTS = {
    "tokens": "pieces", "token_words": "piece_units", "words": "words",
    "input_ids": "ids", "input_mask": "piece_units", "segment_ids": "piece_units",
}
#: What an encoded paragraph tells.
ENCODED = {
    "words": "array<string>", "ids": "array<int>", "piece_units": "array<int>", "pieces": "array<string>", "asked": R.ASKED,
}


@dataclass(frozen=True)
class WindowConfig:
    max_length: int = 384
    stride: int = 128
    max_query: int = 64
    negatives: bool = False


def context_words(context: Column) -> Column:
    return F.array_remove(F.split(context, X.CONTEXT_SPACE), "")


def context_lines(context: Column) -> Column:
    """The words of a context, each a line of its own: newlines separate words, so none holds one."""
    return F.btrim(F.regexp_replace(context, X.CONTEXT_SPACE, "\n"), F.lit("\n"))


def word_at(context: Column, offset: Column) -> Column:
    """0-based word of a character; whitespace belongs to the word before it."""
    return F.size(context_words(F.substring(context, F.lit(1), offset + 1))) - 1


def questions(paragraphs: DataFrame, cfg: WindowConfig, training: bool = True) -> DataFrame:
    """One row per question with word-level answer positions.

    Input: ``(context_id, context, qas array<struct<id, question,
    is_impossible, answers array<struct<text, answer_start>>>>)``.
    """
    # The outer form: a plain explode of made questions makes them again in the
    # emptiness filter that the optimiser derives from it.
    rows = paragraphs.select(
        "context_id", "context", F.posexplode_outer("qas").alias("qa_no", "qa")
    ).filter("qa_no is not null")
    impossible = (
        F.coalesce(F.col("qa.is_impossible"), F.lit(False))
        if cfg.negatives and training
        else F.lit(False)
    )
    rows = rows.select(
        "context_id",
        "context",
        "qa_no",
        F.col("qa.id").alias("qas_id"),
        F.col("qa.question").alias("question"),
        impossible.alias("is_impossible"),
        F.col("qa.answers").alias("answers"),
    )
    if not training:
        none = F.lit(None).cast("int")
        return rows.drop("answers").withColumn("answer_text", F.lit(None).cast("string")).withColumn(
            "start_word", none
        ).withColumn("end_word", none)
    checked = F.when(
        # A paragraph without questions is a row until it is filtered, in whatever order that is done.
        F.col("qa_no").isNotNull() & ~F.col("is_impossible") & (F.coalesce(F.size("answers"), F.lit(0)) != 1),
        F.raise_error(F.lit("each answerable question needs exactly one answer")),
    ).otherwise(F.get("answers", F.lit(0)))
    rows = rows.withColumn("answer", checked)
    begin = F.col("answer.answer_start")
    final = begin + F.length("answer.text") - 1

    def unless_impossible(value: Column, otherwise) -> Column:
        return F.when(F.col("is_impossible"), F.lit(otherwise)).otherwise(value)

    return rows.select(
        "context_id",
        "context",
        "qa_no",
        "qas_id",
        "question",
        "is_impossible",
        unless_impossible(F.col("answer.text"), "").alias("answer_text"),
        unless_impossible(word_at(F.col("context"), begin), -1).cast("int").alias("start_word"),
        unless_impossible(word_at(F.col("context"), final), -1).cast("int").alias("end_word"),
    )


def answer_found() -> Column:
    """True when the answer text occurs in the words it points at."""
    span = F.array_join(
        F.slice(
            context_words(F.col("context")),
            F.greatest(F.col("start_word"), F.lit(0)) + 1,
            F.greatest(F.col("end_word") - F.col("start_word") + 1, F.lit(0)),
        ),
        " ",
    )
    cleaned = F.array_join(X.words_of(F.col("answer_text")), " ")
    return F.col("is_impossible") | (F.instr(span, cleaned) > 0)


def recoverable(examples: DataFrame) -> DataFrame:
    """Keep questions whose answer can be read back from the context words."""
    return examples.filter(answer_found())


def _tagged(text: Column, unit: Column, lower: bool) -> Column:
    return F.transform(
        X.basic_tokens(F.coalesce(text, F.lit("")), lower), lambda w: F.struct(unit.alias("unit"), w.alias("word"))
    )


def encode_examples(
    paragraphs: DataFrame,
    cfg: WindowConfig,
    vocab: DataFrame,
    training: bool = True,
    lower: bool = True,
    facts: VocabFacts | None = None,
    columns: Iterable[str] = tuple(ENCODED),
) -> DataFrame:
    """One row per paragraph: its words, all its pieces, and what each kept question asks.

    Context words carry units from 0; question ``q`` carries unit -(2q+1) and
    its answer -(2q+2), so one pass encodes a paragraph with all its questions.
    ``asked`` holds places in the paragraph's arrays, never copies of them.
    Only the ``columns`` named are made; texts are split into words by the tasks
    that encode them.
    """
    columns = [c for c in ENCODED if c in set(columns)]
    facts = facts or vocab_facts(vocab)
    shared = compiled(vocab, facts, with_pieces="pieces" in columns)
    asked = R.asked_rows(cfg, training, columns)
    lines = context_lines(F.col("context"))
    kind = paragraphs.schema["context_id"].dataType.simpleString()
    out = ", ".join([f"context_id {kind}", *[f"{c} {ENCODED[c]}" for c in columns]])

    def answer(qa: Column) -> Column:
        return F.get(qa["answers"], F.lit(0))["text"] if training else F.lit("")

    if shared is not None:
        spaced = lambda text: X.spaced_text(F.coalesce(text, F.lit("")), lower)
        per_question = F.flatten(F.transform("qas", lambda qa: F.array(spaced(qa["question"]), spaced(answer(qa)))))
        whole = F.array(X.spaced_text(lines, lower, keep_lines=True))
        texts = F.when(F.col("context").isNotNull(), F.concat(whole, F.coalesce(per_question, F.array().cast("array<string>"))))
        encoded = paragraphs.select("context_id", "context", "qas", texts.alias("texts"))
        by_text = text_encoder(shared)
        return encoded.mapInArrow(lambda batches: asked(by_text(batches)), out)
    per_question = F.flatten(
        F.transform(
            "qas",
            lambda qa, q: F.concat(
                _tagged(qa["question"], (-(2 * q + 1)).cast("int"), lower),
                _tagged(answer(qa), (-(2 * q + 2)).cast("int"), lower),
            ),
        )
    )
    nothing = F.array().cast("array<struct<unit:int,word:string>>")
    units = paragraphs.select(
        "context_id", "context", "qas", F.concat(X.unit_tokens(lines, lower), F.coalesce(per_question, nothing)).alias("units")
    )
    pieces = encode(units, ["context_id"], "units", vocab, facts, with_pieces="pieces" in columns)
    joined = units.drop("units").join(pieces, "context_id")
    return joined.select("context_id", "context", "qas", *pieces.columns[1:]).mapInArrow(asked, out)


def kept_examples(encoded: DataFrame) -> DataFrame:
    """Encoded paragraphs written without what ids and paragraphs tell already.

    :func:`spelled` and :func:`paragraph_texts` give ``pieces`` and ``words`` again.
    """
    return stored(encoded.select("context_id", "ids", "piece_units", "asked"), ascending=("piece_units",))


def spelled(
    encoded: DataFrame,
    vocab: DataFrame,
    facts: VocabFacts | None = None,
    ids: str = "ids",
    pieces: str = "pieces",
    keys: Iterable[str] = ("context_id",),
    lines: bool = False,
) -> DataFrame:
    """Add ``pieces``, the vocabulary's token of each id; nothing is shuffled beside a vocabulary of checked size.

    With ``lines`` they are one text of lines. ``keys`` identify a row.
    """
    shared = compiled(vocab, facts or vocab_facts(vocab), with_pieces=True)
    if shared is None:
        tokens = ids_to_tokens(encoded, [*keys], ids, vocab).withColumnRenamed(ids, pieces)
        tokens = tokens.withColumn(pieces, F.array_join(pieces, "\n")) if lines else tokens
        return encoded.join(tokens, [*keys])

    def spell(batches):
        named = shared.value[1]
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            tokens = pa.DictionaryArray.from_arrays(lists.flatten(), named).cast(pa.string())
            cuts = lists.offsets.to_numpy()
            made = pa.ListArray.from_arrays(pa.array(cuts - cuts[0]), tokens)
            made = pc.binary_join(made, "\n") if lines else made
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, pieces])

    kind = T.StringType() if lines else T.ArrayType(T.StringType())
    return encoded.mapInArrow(spell, T.StructType([*encoded.schema.fields]).add(pieces, kind))


def paragraph_texts(
    encoded: DataFrame, paragraphs: DataFrame, vocab: DataFrame, facts: VocabFacts | None = None, pack: bool = False
) -> DataFrame:
    """``(context_id, pieces, piece_units, words)`` of kept examples, each list of strings as lines of one text.

    Neither words nor pieces hold a newline, and lines move with far fewer bytes than arrays;
    with ``pack`` they move compressed.
    """
    texts = spelled(encoded.select("context_id", "ids", "piece_units"), vocab, facts, lines=True)
    texts = texts.select("context_id", "pieces", "piece_units")
    words = F.coalesce(context_lines(F.col("context")), F.lit(""))
    words = paragraphs.select("context_id", words.alias("words"))
    if pack:
        texts, words = packed(texts, ["pieces", "piece_units"]), packed(words, ["words"])
        # As many parts as asked for: they hold few bytes, but much work is done on them.
        width = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        texts, words = (x.repartition(width, "context_id") for x in (texts, words))
    return texts.join(words, "context_id")


def question_pieces(encoded: DataFrame) -> DataFrame:
    """One row per kept question with its own pieces and spans.

    They are cut in the paragraph's row, so that no row carries the paragraph.
    Without ``pieces`` there are no ``query_pieces``, which :func:`spelled` gives.
    """

    def own(values: str, at: str, n: str) -> Column:
        return A.let(
            lambda all_, asked: F.transform(asked, lambda a: F.slice(all_, a[at] + 1, a[n])), F.col(values), F.col("asked")
        )

    lists = {"query_ids": own("ids", "query_at", "query_n")}
    if "pieces" in encoded.columns:
        lists["query_pieces"] = own("pieces", "query_at", "query_n")
    lists["answer_ids"] = own("ids", "answer_at", "answer_n")
    parts = F.arrays_zip("asked", *[c.alias(n) for n, c in lists.items()])
    rows = encoded.select("context_id", F.explode_outer(parts).alias("q")).filter("q is not null")
    return rows.select("context_id", "q.asked.*", *[f"q.{n}" for n in lists])


def windows(
    encoded: DataFrame, cfg: WindowConfig, facts: VocabFacts, training: bool = True, lists: Iterable[str] = tuple(LISTS)
) -> DataFrame:
    """Encoded paragraphs to one row per window.

    With ``first_ids``, the id of the first window of each question, the windows
    also get unique ids; without, they tell the number of their question
    (``qa_no``), for :func:`numbered`. Windows overlap and a paragraph has several questions,
    so that their arrays are many times the text: ``lists`` names those wanted.
    """
    lists = [name for name in LISTS if name in lists]
    has_ids = "first_ids" in encoded.columns
    kind = encoded.schema["context_id"].dataType
    scalars = [
        ("qas_id", T.StringType()),
        ("context_id", kind),
        *[(c, T.IntegerType()) for c in ("window_no", "window_start", "window_length", "doc_offset")],
        *[(c, T.IntegerType()) for c in ("best_first", "best_last", "first_word")],
        ("is_impossible", T.BooleanType()),
    ]
    scalars += [("unique_id", T.LongType()) if has_ids else ("qa_no", T.IntegerType())]
    scalars += [(c, T.IntegerType()) for c in ("start_position", "end_position")] if training else []
    text, whole = T.ArrayType(T.StringType()), T.ArrayType(T.IntegerType())
    out = T.StructType([T.StructField(n, t) for n, t in scalars])
    for name in lists:
        out = out.add(name, text if name in ("tokens", "words") else whole)
    for special in (CLS, SEP):
        facts.id(special)
    cut_up = R.cut_windows(
        cfg, facts.special[CLS], facts.special[SEP], CLS, SEP, has_ids, training,
        [n for n, _ in scalars], [to_arrow_type(t) for _, t in scalars], lists,
    )
    return _needed(encoded, lists).mapInArrow(cut_up, out)


def _needed(encoded: DataFrame, lists: Iterable[str]) -> DataFrame:
    """The columns of paragraphs that windows with ``lists`` are cut from."""
    wanted = {"context_id", "piece_units", "asked", "first_ids"} | {LISTS[name] for name in lists}
    return encoded.select(*[c for c in encoded.columns if c in wanted])


def with_token_maps(rows: DataFrame) -> DataFrame:
    """Add the per-token maps position -> word and position -> best context.

    Windows carry the same facts as one array and two bounds, which is all the
    later steps need; the maps are for consumers that look tokens up.
    """
    size = F.size("token_words")
    positions = F.sequence(F.col("doc_offset"), F.col("doc_offset") + size - 1)
    lead, tail = F.col("best_first") - F.col("doc_offset"), F.col("best_last") - F.col("doc_offset") + 1
    flags = F.concat(
        F.array_repeat(F.lit(False), lead),
        F.array_repeat(F.lit(True), tail - lead),
        F.array_repeat(F.lit(False), size - F.greatest(tail, lead)),
    )
    return rows.withColumn("token_to_word", F.map_from_arrays(positions, "token_words")).withColumn(
        "token_is_best", F.map_from_arrays(positions, flags)
    )


def first_window_ids(encoded: DataFrame) -> DataFrame:
    """``(context_id, first_ids)``: the id of the first window of each question.

    Ids are consecutive over (question, window): only window counts are
    ranked, the token arrays never take part in the ordering.
    """
    counts = encoded.select("context_id", F.explode("asked").alias("q")).select(
        "context_id", "q.qas_id", "q.qa_no", F.col("q.windows").cast("long").alias("n_windows")
    )
    starts = running_start(counts, ["qas_id", "context_id", "qa_no"], "n_windows", "first_id")
    return stored(
        starts.groupBy("context_id").agg(
            F.map_from_entries(F.collect_list(F.struct("qa_no", F.col("first_id") + FIRST_UNIQUE_ID))).alias("first_ids")
        )
    )


def numbered(rows: DataFrame, first_ids: DataFrame) -> DataFrame:
    """Windows, or what was made of them, with their unique ids in place of ``qa_no``."""
    joined = rows.join(broadcast_if_small(first_ids), "context_id")
    first = F.element_at("first_ids", F.col("qa_no"))
    return joined.withColumn("unique_id", first + F.col("window_no")).drop("first_ids", "qa_no")


def question_windows(
    paragraphs: DataFrame,
    vocab: DataFrame,
    cfg: WindowConfig = WindowConfig(),
    training: bool = True,
    lower: bool = True,
    lists: Iterable[str] = tuple(LISTS),
    encoded: DataFrame | None = None,
    first_ids: DataFrame | None = None,
) -> DataFrame:
    """Paragraphs with questions to the final window feature table.

    Pass the results of :func:`encode_examples` and :func:`first_window_ids` to
    cut windows again, with other ``lists``. Windows are cut where they are
    used; what is kept is the encoded paragraphs.
    """
    facts = vocab_facts(vocab)
    if encoded is None:
        wanted = ["piece_units", "asked", *[LISTS[name] for name in lists]]
        encoded = stored(encode_examples(paragraphs, cfg, vocab, training, lower, facts, wanted), ascending=("piece_units",))
    first_ids = first_window_ids(encoded) if first_ids is None else first_ids
    if not lists:  # a window's scalars are less than its share of the paragraph
        return numbered(windows(encoded, cfg, facts, training, lists), first_ids)
    joined = _needed(encoded, lists).join(broadcast_if_small(first_ids), "context_id")
    return windows(joined, cfg, facts, training, lists)
